"""Token ids of documents packed into as few sequences of a fixed capacity as can be found.

A document is its ids and an end id. Longer ones are cut into pieces of the capacity; all
others are one piece. Pieces of equal length are alike for packing, so the plan is made from
the number of pieces of each length, which is never larger than the capacity:

1. Martello and Toth's reduction: going down the lengths, the sets of up to three pieces that
   hold one of this length are compared. Where one set dominates all others (whatever another
   set holds can be exchanged for its pieces, item by item or several for one), it is fixed as
   a sequence, as often as its lengths last. This shrinks the instance, and passes repeat
   until nothing more is fixed. No optimal packing is lost.
2. What remains goes by best fit, longest first: sequences that are equally full are one group
   with a count, so a step places many pieces.

The plan says which ranks of a length go where. A piece's rank among those of its length is
its number within its task plus the number of such pieces in the tasks before: pieces are
written once, tasks are counted, and no length, however frequent, meets in one task. The plan
has at most a few rows for each length and sequence pattern, whatever the data.

Cases: a NULL or empty text is the end id alone; repeated rows and NULL ids are packed each;
ties between pieces of equal length go by task and place; a piece of the full capacity is a
sequence of its own; an empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truegrain.llm import common
from truegrain.llm.library import library_encoder

CAPACITY = 2_048
END_ID = 0
ID = np.dtype("<u4")
#: A pattern: lengths and how often each stands in a sequence.
Pattern = tuple[tuple[int, int], ...]


def _smallest(counts: np.ndarray, above: int, how_many: int) -> list[int]:
    """The smallest lengths over ``above`` with their repetitions, at most so many."""
    found: list[int] = []
    for length in np.flatnonzero(counts[above + 1 :])[:how_many] + above + 1:
        found += [int(length)] * min(how_many - len(found), int(counts[length]))
    return found


def _largest(counts: np.ndarray, most: int) -> int:
    """The greatest length up to ``most``, or 0."""
    there = np.flatnonzero(counts[: most + 1])
    return int(there[-1]) if len(there) else 0


def _best_pair(counts: np.ndarray, room: int) -> int:
    """The greatest sum of two pieces that fits ``room``."""
    lengths = np.flatnonzero(counts[:room])
    best = 0
    for a in lengths[::-1].tolist():
        counts[a] -= 1
        b = _largest(counts, min(a, room - a))
        counts[a] += 1
        best = max(best, a + b if b else 0)
    return best


def dominating(counts: np.ndarray, capacity: int, piece: int) -> tuple[int, ...] | None:
    """A set with one ``piece`` that dominates all sets with it, of at most three pieces, or None."""
    others = counts.copy()
    others[piece] -= 1
    room = capacity - piece
    small = _smallest(others[: room + 1], 0, 3)
    if not small:
        return (piece,)
    first = _largest(others, room)
    if first == room or sum(small[:2]) > room or len(small) == 1:
        return (piece, first)
    if len(small) == 3 and sum(small) <= room:
        return None  # sets of four and more would have to be compared
    if _best_pair(others, room) <= first:
        return (piece, first)
    others[first] -= 1
    second = _largest(others, room - first)
    others[first] += 1
    if not second:
        return None
    # Pairs that are not exchanged one for one hold two pieces over ``second``.
    above = _smallest(others[: room + 1], second, 2)
    if len(above) < 2 or sum(above) > room:
        return (piece, first, second)
    return None


def reduce(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Sets fixed by dominance and how often; their pieces are taken from ``counts``."""
    fixed: list[tuple[Pattern, int]] = []
    changed = True
    while changed:
        changed = False
        for piece in np.flatnonzero(counts)[::-1].tolist():
            while counts[piece]:
                chosen = dominating(counts, capacity, piece)
                if chosen is None:
                    break
                pattern = tuple((length, chosen.count(length)) for length in sorted(set(chosen), reverse=True))
                times = min(int(counts[length]) // n for length, n in pattern)
                for length, n in pattern:
                    counts[length] -= n * times
                fixed.append((pattern, times))
                changed = True
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """All pieces by best fit, longest first; equal sequences together."""
    rooms: list[int] = []  # free space of the groups that have some, ascending
    groups: dict[int, list[list]] = {}  # by free space: [pattern, count]
    done: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, times: int, room: int) -> None:
        if not room:
            done.append((pattern, times))
        elif room in groups:
            groups[room].append([pattern, times])
        else:
            groups[room] = [[pattern, times]]
            insort(rooms, room)

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                room, pattern, there = capacity, (), left
            else:
                room = rooms[at]
                pattern, there = groups[room][-1]
            each = min(room // length, left)
            times = min(there, left // each)
            if pattern:
                groups[room][-1][1] -= times
                if not groups[room][-1][1]:
                    groups[room].pop()
                    if not groups[room]:
                        del groups[room], rooms[at]
            put((*pattern, (length, each)), times, room - each * length)
            left -= each * times
    return done + [(pattern, times) for room in rooms for pattern, times in groups[room]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Sequences for so many pieces of each length: patterns and how often each is used."""
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    return reduce(counts, capacity) + best_fit(counts, capacity)


class Places:
    """Where the pieces of each length and rank go."""

    def __init__(self, patterns: list[tuple[Pattern, int]]):
        ranks: dict[int, int] = {}
        rows, sequence = [], 0
        for pattern, times in patterns:
            offset = 0
            for length, each in pattern:
                rank = ranks.get(length, 0)
                rows.append((self._key(length, rank), length, rank, each, sequence, offset))
                ranks[length] = rank + each * times
                offset += each * length
            sequence += times
        rows.sort()
        self.keys, self.lengths, self.ranks, self.each, self.sequences, self.offsets = (
            np.array(column, np.int64) for column in (zip(*rows) if rows else [[]] * 6)
        )

    @staticmethod
    def _key(length, rank):
        return (length << 44) | rank

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and rank."""
        at = np.searchsorted(self.keys, self._key(lengths, ranks), side="right") - 1
        turn, place = np.divmod(ranks - self.ranks[at], self.each[at])
        return self.sequences[at] + turn, self.offsets[at] + place * lengths


def pieces(
    df: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and on request ``ids`` of every piece.

    ``part`` and ``nth`` number the pieces of a length within the task that made them; they
    hold for a result that is written once and read from there.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        encoder, part, so_far = library_encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in common.slices(batches, "text"):
            ids, counts = encoder.encode_texts(common.texts_of(batch, "text"))
            ids = np.insert(ids, np.cumsum(counts), end_id).astype(ID)
            counts = counts + 1
            each = -(-counts // capacity)
            owner = np.repeat(np.arange(len(counts)), each)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
            start = number * capacity
            length = np.minimum(counts[owner] - start, capacity)
            begin = (np.cumsum(counts) - counts)[owner] + start
            raw = memoryview(ids.tobytes())
            order = np.argsort(length, kind="stable")
            inside = np.arange(len(order)) - np.searchsorted(length[order], length[order])
            nth = np.empty_like(inside)
            nth[order] = inside
            made = {
                "id": batch.column("id").take(pa.array(owner)),
                "piece": pa.array(number, pa.int32()),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array(
                    [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())], pa.int64()
                ),
                "part": pa.array(np.full(len(owner), part), pa.int32()),
                "nth": pa.array(so_far[length] + nth),
            }
            so_far += np.bincount(length, minlength=capacity + 1)
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                made["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(made)

    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
    return source.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def packed(
    df: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and its ``offset`` there."""
    made = common.stored(pieces(df, tokenizer, capacity, end_id, id_col, text_col, with_ids), "pieces")
    by_task = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Stored, so that the join below has two plain scans and a frequent length can be split.
    starts = common.stored(
        by_task.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "starts"
    )
    # One row for each length: at most ``capacity``.
    histogram = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(histogram, capacity))
    ranked = made.join(starts.drop("n"), ["length", "part"]).select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        *(["ids"] if with_ids else []),
        (F.col("before") + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )

    def run(batches):
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "sequence_id"))
            found = dict(zip(("sequence_id", "offset"), map(pa.array, places.of(lengths, ranks))))
            yield pa.RecordBatch.from_pydict({c: found.get(c, batch.column(c)) for c in batch.schema.names})

    return ranked.mapInArrow(run, ranked.schema)


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """``sequence_id``, its ``ids`` (array of int, at most the capacity) and ``n_pieces``; needs ``ids``."""
    row = F.struct("offset", "ids")
    together = packed_pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return together.select(
        "sequence_id", F.flatten(F.col("rows.ids")).alias("ids"), F.size("rows").cast("bigint").alias("n_pieces")
    )
