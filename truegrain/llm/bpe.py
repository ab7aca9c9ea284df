"""BPE encoding by a segment tree over the ranks of adjacent pairs, and decoding.

The leaves of a word's tree are its adjacent pairs, by position; a leaf holds
``rank * width + position`` or ``NONE`` if the pair never merges. The root is then the
leftmost pair of lowest rank. Merging it changes three leaves (the pair before, the
pair itself and the pair that disappears), and each is carried up in logarithmic time,
until the root is ``NONE``. Trees of equal width are worked on together, one row of a
matrix each, so that numpy does what a loop over words would.

Cases: a NULL or empty text has no ids and decodes to the empty text; repeated rows are
encoded each; ties of rank go to the leftmost pair; words of any length are one tree.
Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm import common
from truegrain.llm.pretokens import TextEncoder, WordBpe

NONE = np.int64(1) << np.int64(62)
#: Trees of a batch have about this many nodes together.
BATCH_NODES = 1 << 19
#: Words of at least so many bytes are worked on one by one, all leaves of a rank at once.
LONG = 1 << 10


class PairRanks:
    """Rank of a pair of ids, and the id that the merge of a rank makes."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        pairs = np.array(merges, np.int64).reshape(-1, 3)
        keys = (pairs[:, 0] << 32) | pairs[:, 1]
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.merged = pairs[:, 2]
        #: Whether a pair that holds a merged token always ranks behind the merge that made it.
        ranks = np.arange(len(pairs))
        first = np.full(int(pairs.max(initial=0)) + 1, len(pairs))
        for side in (0, 1):
            np.minimum.at(first, pairs[:, side], ranks)
        self.in_order = bool((first[self.merged] > ranks).all())

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, -1 where the pair has none."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)


class PairTrees:
    """One segment tree for each row of ``symbols``; ``lengths`` of each row count."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, ranks: PairRanks):
        rows, self.size = symbols.shape
        self.width = width = 1 << max(0, (self.size - 2).bit_length())
        places = np.arange(self.size)
        self.ranks, self.lengths = ranks, lengths
        self.symbols = symbols.ravel()
        self.after = np.tile(places + 1, rows)
        self.before = np.tile(places - 1, rows)
        self.alive = (places < lengths[:, None]).ravel()
        tree = np.full((rows, 2 * width), NONE, np.int64)
        pairs = places[:-1] < (lengths[:, None] - 1)
        leaves = self._leaf(symbols[:, :-1], symbols[:, 1:], places[:-1])
        tree[:, width : width + self.size - 1] = np.where(pairs, leaves, NONE)
        level = width
        while level > 1:
            row = tree[:, level : 2 * level]
            tree[:, level // 2 : level] = np.minimum(row[:, 0::2], row[:, 1::2])
            level //= 2
        self.tree = tree.ravel()

    def _leaf(self, left, right, place) -> np.ndarray:
        rank = self.ranks(left, right)
        return np.where(rank < 0, NONE, rank * self.width + place)

    def _put(self, row: np.ndarray, place: np.ndarray, value) -> None:
        """Set a leaf of each row, and what stands above it."""
        top = row * (2 * self.width)
        node = place + self.width
        self.tree[top + node] = value
        level = self.width
        while level > 1:
            node >>= 1
            level >>= 1
            below = top + 2 * node
            self.tree[top + node] = np.minimum(self.tree.take(below), self.tree.take(below + 1))

    def merge_all(self) -> None:
        row = np.flatnonzero(self.tree[1 :: 2 * self.width] < NONE)
        while len(row):
            best = self.tree.take(row * (2 * self.width) + 1)
            rank, place = np.divmod(best, self.width)
            base = row * self.size
            gone = self.after.take(base + place)
            then = self.after.take(base + gone)
            merged = self.ranks.merged.take(rank)
            self.symbols[base + place] = merged
            self.after[base + place] = then
            self.alive[base + gone] = False
            has_next = then < self.lengths.take(row)
            self.before[(base + then)[has_next]] = place[has_next]
            following = self.symbols.take(base + np.where(has_next, then, 0))
            self._put(row, place, np.where(has_next, self._leaf(merged, following, place), NONE))
            if has_next.any():
                self._put(row[has_next], gone[has_next], NONE)
            first = self.before.take(base + place)
            has_first = first >= 0
            if has_first.any():
                r, p = row[has_first], first[has_first]
                self._put(r, p, self._leaf(self.symbols.take(base[has_first] + p), merged[has_first], p))
            row = row[self.tree.take(row * (2 * self.width) + 1) < NONE]

    def merge_ranks(self) -> None:
        """As :meth:`merge_all`, by all leaves of the lowest rank that do not overlap, for one long row.

        Right where no merge makes a pair of its own or a lower rank, so that the root
        would give these leaves next to each other, from the left.
        """
        while (best := int(self.tree[1])) < NONE:
            rank = best // self.width
            node, limit = np.ones(1, np.int64), (rank + 1) * self.width
            while node[0] < self.width:  # down to the leaves of that rank, in order
                node = np.repeat(2 * node, 2)
                node[1::2] += 1
                node = node[self.tree[node] < limit]
            place = node - self.width
            touches = np.concatenate([[False], self.after[place[:-1]] == place[1:]])
            index = np.arange(len(place))
            place = place[(index - np.maximum.accumulate(np.where(touches, 0, index))) % 2 == 0]
            gone = self.after[place]
            then = self.after[gone]
            self.symbols[place] = self.ranks.merged[rank]
            self.after[place] = then
            self.alive[gone] = False
            inside = then < self.lengths[0]
            self.before[then[inside]] = place[inside]
            first = self.before[place]
            changed = np.unique(np.concatenate([place, first[first >= 0]]))
            changed = changed[self.alive[changed]]
            following = self.after[changed]
            has_next = following < self.lengths[0]
            leaf = self._leaf(self.symbols[changed], self.symbols[np.where(has_next, following, 0)], changed)
            self.tree[self.width + changed] = np.where(has_next, leaf, NONE)
            self.tree[self.width + gone] = NONE
            node = np.concatenate([changed, gone]) + self.width
            while node[0] > 1:
                node = np.unique(node >> 1)
                self.tree[node] = np.minimum(self.tree[2 * node], self.tree[2 * node + 1])


class Encoder(TextEncoder):
    """Ids of words, and of texts, under a BPE file, and the texts that these decode to."""

    def __init__(self, path: str):
        bpe = WordBpe(path)
        self.ranks = PairRanks(bpe.merges)
        self.inner = np.array(bpe.byte_ids, np.int64)
        self.last = np.array(bpe.last_byte_ids, np.int64)
        self.names = [bpe.tokens[i] for i in range(max(bpe.tokens) + 1)]
        super().__init__(bpe)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, by a segment tree over its pairs."""
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.array([len(b) for b in raw], np.int64)
        if self.bpe.special:
            for i, word in enumerate(words):
                if word in self.bpe.special:
                    found[i], lengths[i] = np.array([self.bpe.special[word]], np.int64), 0
        width = np.where(lengths > 0, 1 << np.ceil(np.log2(np.maximum(lengths, 2))).astype(np.int64), 0)
        for size in np.unique(width[width > 0]):
            group = np.flatnonzero(width == size)
            step = 1 if size >= LONG and self.ranks.in_order else max(1, BATCH_NODES // int(size))
            for begin in range(0, len(group), step):
                some = group[begin : begin + step]
                n = lengths[some]
                symbols = np.zeros((len(some), int(size)), np.int64)
                place = np.arange(int(size)) < n[:, None]
                symbols[place] = self.inner[np.frombuffer(b"".join(raw[i] for i in some), np.uint8)]
                ends = np.array([raw[i][-1] for i in some])
                symbols[np.arange(len(some)), n - 1] = self.last[ends]
                trees = PairTrees(symbols, n, self.ranks)
                if size >= LONG and self.ranks.in_order:
                    trees.merge_ranks()
                else:
                    trees.merge_all()
                counts = trees.alive.reshape(len(some), -1).sum(axis=1)
                ids, ends = trees.symbols[trees.alive], np.cumsum(counts)
                for i, a, b in zip(some.tolist(), (ends - counts).tolist(), ends.tolist()):
                    found[i] = ids[a:b]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([np.zeros(0, np.int64), *found]), counts

    def _forget(self) -> None:
        super()._forget()
        self.decoded: list[str] = []

    def learned(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        names, ends = list(map(self.names.__getitem__, ids.tolist())), np.cumsum(counts)
        self.decoded += [" ".join(names[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """As the file has no decoder: its tokens, with a space between."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of all texts one after another, how many each has, and each decoded."""
        ids, counts, places, words = self.encode_all(texts)
        names, ends = list(map(self.decoded.__getitem__, places.tolist())), np.cumsum(words)
        decoded = [" ".join(names[a:b]) for a, b in zip((ends - words).tolist(), ends.tolist())]
        return ids, counts, decoded


@lru_cache(1)
def worker_encoder(path: str) -> Encoder:
    """One encoder for all tasks that a worker runs one after another."""
    return Encoder(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (array of int) and ``decoded`` (string) of every row of ``df``."""
    source = df.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def work(piece: pa.RecordBatch, encoder: Encoder):
        ids, counts, decoded = encoder.encode_texts(common.texts_of(piece, "text"))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return {
            id_col: piece.column("key"),
            "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())),
            "decoded": pa.array(decoded, pa.string()),
        }

    return common.map_texts(
        source, "text", f"`{id_col}` {kind}, ids array<int>, decoded string", work, lambda: worker_encoder(path)
    )


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of ids, and digests of the ids in decimal and of the decoded text."""
    return encoded.select(
        id_col,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
