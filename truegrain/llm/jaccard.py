"""Exact similarity join of documents by the Jaccard similarity of their word n-grams.

Documents link when ``under * |both| >= over * |either|`` (0.9: 9 and 10). Result: a row
per document with the least id that it reaches by links.

1. Equal n-gram sets are one *class*, found by two 64-bit digests of the set.
2. Classes that can link meet. The difference of two linking sets is at most ``d``
   elements, for the size class of the smaller; the elements are dealt by hash into more
   than ``d`` boxes, so of ``e`` boxes that are not empty at least ``e - d`` are equal in
   both. Each class may therefore forget its ``e - d - 1`` most frequent boxes (in one
   global order) and still keep one in common with every partner: the rarest they share.
   So passages that many documents share connect nothing, as long as the rest differs.
   (Sets that fill no more than ``d`` boxes forget none and are also matched on empty
   ones.) A set uses the boxes of its own size class and of the class below, as linking
   sets are of the same or of neighbouring classes. Classes with an equal box are
   connected; components of this are *families*.
3. The sets of a family, each sorted in one global order (long n-grams first, which are
   rare, then by hash), go into a prefix tree, and each is searched in it (``prefixtree``).
   A large family is cut into blocks; each pair of blocks is a task, so none is unbounded
   and no pair is lost. Tasks return one link to the least linked document for each, not
   all pairs.
4. Components of the links.

N-grams are compared by 58 bits of hash and their length. Only documents in families have
their texts shuffled.

Cases: words are split and lower-cased as in ``common.words_of``; fewer words than an
n-gram make one n-gram; a NULL or empty text has none and links with nothing; repeated
rows are one class; a row with a NULL id has a NULL component; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truegrain.llm import common
from truegrain.llm.components import components
from truegrain.llm.prefixtree import PrefixTree
from truegrain.session import settle

#: Elements of the sets in one block of a family.
BLOCK_ELEMENTS = 400_000


def boxes_of(differ: np.ndarray) -> np.ndarray:
    """Boxes for sets that may differ by so many elements: some more, which may be forgotten."""
    return differ + 3 + 3 * differ // 20


def size_classes(over: int, under: int, most: int) -> np.ndarray:
    """Greatest size of each class; sizes that can link are in the same or in neighbouring classes."""
    tops, low = [], 1
    while low <= most:
        tops.append(low * under // over)
        low = tops[-1] + 1
    return np.array(tops, np.int64)


def ordered_sets(texts: list[str], gram: int) -> list[np.ndarray]:
    """The n-gram set of each text in the global order."""
    hashes, starts, size = common.shingles(texts, gram, lengths_too=True)
    rank = np.uint64(63) - np.minimum(size, 63).astype(np.uint64)
    tokens = (rank << np.uint64(58)) | (hashes >> np.uint64(6))
    return [np.unique(tokens[a:b]) for a, b in zip(starts[:-1], starts[1:])]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[ends[1:]] - total[ends[:-1]]


def set_digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    one = common.mix(_sums(common.mix(flat), ends) + sizes.astype(np.uint64))
    two = common.mix(_sums(common.mix(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5)), ends) - sizes.astype(np.uint64))
    return sizes, one, two


def box_marks(sets: list[np.ndarray], over: int, under: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of the boxes of all sets, the set of each, and twice how many of its kind the set may forget.

    The last number is odd for boxes of the size class below the set's own. Sets ascend.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    tops = size_classes(over, under, max(1, int(sizes.max(initial=0))))
    own = np.searchsorted(tops, sizes)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    place = common.mix(flat ^ np.uint64(0x5DEECE66D)) >> np.uint64(32)
    value = common.mix(flat)
    low_half, high_half = (value & np.uint64(0xFFFFFFFF)).astype(np.float64), (value >> np.uint64(32)).astype(np.float64)
    found = []
    for step in (0, 1):
        kind = np.maximum(own - step, 0)
        differ = tops[kind] * (under - over) // over
        boxes = np.where((sizes > 0) & (own >= step), boxes_of(differ), 0)
        base = np.cumsum(boxes) - boxes
        inside = np.repeat(boxes > 0, sizes)
        box = (place * np.repeat(boxes, sizes).astype(np.uint64)) >> np.uint64(32)
        at = (box.astype(np.int64) + np.repeat(base, sizes))[inside]
        total = int(boxes.sum())
        low = np.bincount(at, low_half[inside], total).astype(np.uint64)
        high = np.bincount(at, high_half[inside], total).astype(np.uint64)
        filled = np.bincount(at, minlength=total)
        owner = np.repeat(np.arange(len(sets)), boxes)
        number = np.arange(total) - np.repeat(base, boxes)
        spare = np.bincount(owner, filled > 0, len(sets)).astype(np.int64) - differ - 1
        use = (filled > 0) | (spare[owner] < 0)
        name = common.mix((kind[owner].astype(np.uint64) << np.uint64(32)) | number.astype(np.uint64))
        mark = common.mix(common.mix(low ^ name) + high * np.uint64(0x9E3779B97F4A7C15) + filled.astype(np.uint64))
        found.append((mark[use], owner[use], 2 * np.maximum(spare, 0)[owner[use]] + step))
    marks, owners, slack = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(owners, kind="stable")
    return marks[order], owners[order], slack[order]


def _members(source: DataFrame, gram: int) -> DataFrame:
    def work(piece: pa.RecordBatch):
        sizes, one, two = set_digests(ordered_sets(common.texts_of(piece, "text"), gram))
        return {
            "id": piece.column("id"),
            "tie": piece.column("tie"),
            "n": pa.array(sizes),
            "one": pa.array(one.view(np.int64)),
            "two": pa.array(two.view(np.int64)),
        }

    return common.map_texts(source, "text", "id bigint, tie bigint, n bigint, one bigint, two bigint", work)


def _families(source: DataFrame, gram: int, over: int, under: int) -> DataFrame:
    """``one`` (digest of a class) and ``family`` of all classes that share a box with another."""

    def work(piece: pa.RecordBatch):
        sets = ordered_sets(common.texts_of(piece, "text"), gram)
        _, one, _ = set_digests(sets)
        marks, owner, slack = box_marks(sets, over, under)
        return {
            "mark": pa.array(marks.view(np.int64)),
            "one": pa.array(one[owner].view(np.int64)),
            "slack": pa.array(slack.astype(np.int32)),
        }

    marked = common.map_texts(source, "text", "mark bigint, one bigint, slack int", work)
    same = Window.partitionBy("mark")
    # Copies are one class: their rows count once.
    shared = marked.withColumns({"uses": F.count("*").over(same), "low": F.min("one").over(same), "high": F.max("one").over(same)})
    shared = shared.where("low <> high").select("mark", "one", "slack", "uses").distinct()
    frequent = Window.partitionBy("one", "slack").orderBy(F.desc("uses"), "mark")
    kept = shared.withColumn("place", F.row_number().over(frequent)).where(F.col("place") > F.floor(F.col("slack") / 2))
    least = kept.select("mark", "one", F.min("one").over(same).alias("low"))
    edges = least.where("one <> low").select(F.col("one").alias("a"), F.col("low").alias("b"))
    return components(edges).select(F.col("node").alias("one"), F.col("root").alias("family"))


def _linked(rows: DataFrame, over: int, under: int) -> DataFrame:
    """``id``, ``root`` (least document linked in the task) and ``links`` for every task and document."""

    def join(group: list[tuple]) -> pa.RecordBatch | None:
        tokens = [r[4] for r in group]
        universe, flat = np.unique(np.concatenate(tokens), return_inverse=True)
        sets = np.split(flat.astype(np.int64), np.cumsum([len(t) for t in tokens])[:-1])
        own, other = group[0][1:3]
        left = [i for i, r in enumerate(group) if r[3] == own]
        right = [i for i, r in enumerate(group) if r[3] == other] if own != other else left
        tree = PrefixTree([sets[i] for i in left], len(universe))
        root = list(range(len(group)))
        links = [0] * len(group)

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in right:
            for place in tree.similar(sets[i], over, under).tolist():
                j = left[place]
                if i == j:
                    continue
                links[i] += 1
                if own != other:
                    links[j] += 1
                a, b = top(i), top(j)
                if a != b:
                    root[b] = a
        ids = [r[5] for r in group]
        least: dict[int, int] = {}
        for i in range(len(group)):
            t = top(i)
            least[t] = min(least.get(t, ids[i]), ids[i])
        some = [i for i in range(len(group)) if links[i]]
        if not some:
            return None
        return pa.RecordBatch.from_pydict(
            {
                "id": pa.array([ids[i] for i in some], pa.int64()),
                "root": pa.array([least[top(i)] for i in some], pa.int64()),
                "links": pa.array([links[i] for i in some], pa.int64()),
            }
        )

    def run(batches):
        group: list[tuple] = []
        for batch in batches:
            lists = batch.column("tokens")
            flat, ends = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            keys = [batch.column(c).to_pylist() for c in ("family", "p", "q", "block", "id")]
            for i, (family, p, q, block, key) in enumerate(zip(*keys)):
                if group and group[-1][:3] != (family, p, q):
                    if len(group) > 1 and (made := join(group)) is not None:
                        yield made
                    group = []
                group.append((family, p, q, block, flat[ends[i] : ends[i + 1]].copy(), key))
        if len(group) > 1 and (made := join(group)) is not None:
            yield made

    return rows.mapInArrow(run, "id bigint, root bigint, links bigint")


def linked_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = 3, over: int = 9, under: int = 10
) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` and ``n_links`` of every row.

    ``n_links`` counts the other different n-gram sets that a document's set links with.
    """
    if not 0 < over <= under:
        raise ValueError("similarity: over / under, above 0 and at most 1")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = df.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    members = settle(_members(source, gram))
    families = _families(source, gram, over, under)
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "tie")))
    classes = members.where("n > 0").groupBy("one", "two").agg(first.alias("f"), F.first("n").alias("n"))
    classes = settle(classes.where("f is not null").select("one", "two", "n", F.col("f.id").alias("rep"), F.col("f.tie").alias("tie")))
    placed = classes.join(families, "one")
    whole = placed.groupBy("family").agg(F.sum("n").alias("elements"), F.count("*").alias("sets")).where("sets > 1")
    blocks = F.ceil(F.col("elements") / BLOCK_ELEMENTS).cast("int")
    wanted = placed.join(whole, "family").select(
        F.col("rep").alias("id"), "tie", "family", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block")
    )
    wanted = settle(wanted)
    few = common.sieved(source, wanted, ["id", "tie"])
    texts = few.join(wanted.hint("shuffle_hash"), ["id", "tie"]).dropDuplicates(["id", "tie"])

    def work(piece: pa.RecordBatch):
        sets = ordered_sets(common.texts_of(piece, "text"), gram)
        ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        made = {c: piece.column(c) for c in ("id", "family", "blocks", "block")}
        return made | {"tokens": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))}

    sets = common.map_texts(
        texts.select("id", "family", "blocks", "block", "text"),
        "text",
        "id bigint, family bigint, blocks int, block int, tokens array<bigint>",
        work,
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = sets.select("id", "family", "block", "tokens", partner.alias("partner")).select(
        "family", F.least("block", "partner").alias("p"), F.greatest("block", "partner").alias("q"), "block", "id", "tokens"
    )
    tasks = tasks.repartition("family", "p", "q").sortWithinPartitions("family", "p", "q")
    links = settle(_linked(tasks, over, under))
    roots = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    degrees = links.groupBy(F.col("id").alias("node")).agg(F.sum("links").alias("n_links"))
    named = (
        classes.select("one", "two", F.col("rep").alias("node"))
        .join(roots, "node", "left")
        .join(degrees, "node", "left")
        .select("one", "two", F.coalesce("root", "node").alias("root"), "n_links")
    )
    return members.join(named, ["one", "two"], "left").select(
        F.col("id").cast(df.schema[id_col].dataType).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).cast(df.schema[id_col].dataType).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = 5, over: int = 8, under: int = 10) -> DataFrame:
    """``df`` with one row of each component: the least id's, of equal ids that of the least text hash, NULL last.

    Rows are told apart by id and text; of rows with equal id and text one stays. Texts
    without a word link with nothing. Nodes are hashes of id and text, of 64 bits.
    """
    number, text = F.col(id_col).cast("bigint"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(number.isNull(), F.coalesce(number, F.lit(0)), F.xxhash64(text))
    rows = settle(df.select(number.alias("id"), F.xxhash64(text).alias("tie"), key.alias("_key")))
    nodes = rows.groupBy("id", "tie", "_key").agg(F.count("*").alias("rows"))
    found = linked_components(df.select(key.alias("_key"), F.col(text_col)), "_key", text_col, gram, over, under)
    found = settle(nodes.join(found.select("_key", "component_id").distinct(), "_key"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "tie", "_key")
    stays = found.groupBy("component_id").agg(F.min(order).alias("f")).select(F.col("f._key").alias("_key"))
    gone = common.stored(found.select("_key").join(stays, "_key", "left_anti").distinct(), "gone")
    again = common.stored(found.where("rows > 1").select("_key").join(stays, "_key", "left_semi").distinct(), "again")
    left = df.withColumn("_key", key).join(gone, "_key", "left_anti")
    # Only repeated rows have to meet.
    single = left.join(again, "_key", "left_anti")
    met = left.join(again, "_key", "left_semi").dropDuplicates(["_key"])
    return single.unionByName(met).select(*df.columns)
