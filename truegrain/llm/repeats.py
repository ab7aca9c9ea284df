"""Removal of passages that repeat: a suffix array over the places that can repeat.

A byte goes if it is in a string of ``length`` bytes that also starts anywhere else. Of
all suffixes of a corpus only those can matter that share ``GRAM`` bytes with another,
at a place that both choose alike:

1. *Anchors.* Among the ``GRAM``-byte strings inside a window of ``length`` bytes the one
   of least hash, leftmost of equals, is the window's anchor. Equal windows have equal
   anchors in the same place. Windows in a row with the same anchor make a *span*.
2. Spans whose anchor string occurs once are done: nothing in them repeats. Equal spans
   are counted together, before the shuffle too, so a passage of a third of all documents
   is one row. Where all spans of an anchor string are equal, all their windows repeat.
3. The different spans of an anchor string meet in a task, which sorts the suffixes at
   all their window starts by deep-shallow sorting (``suffixes``). Neighbours with
   ``length`` equal bytes repeat. Spans of an anchor string with more than ``TOGETHER``
   different ones are cut again, by the places of further anchors (the least strings under
   other hashes, more of them for larger groups): equal windows agree in all of these, so
   their parts meet again, in groups that are smaller the more anchors there are. Most parts
   of near copies lie between two changes and are equal; they are counted together.
   Should a group still be larger, it is dealt over several tasks and the digests of its
   windows are counted over all of these, so that a repeat in two tasks is found.
4. Spans go back to their documents as ranges of bytes; each document drops their union.

Work and shuffles grow with the bytes divided by the mean span (about 80), plus one
shuffle of the texts for step 3 and one for step 4.

Cases: a NULL or empty text keeps its 0 bytes; texts shorter than ``length`` stay whole;
a repeated row repeats every window, so both copies go; in a text of a short period equal
spans in a row are one row; rows are told apart by id and text, never by id alone; an empty table gives no rows; names of other columns cannot
clash, as they are not read (``kept_documents`` hands them on untouched).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm import common
from truegrain.llm.suffixes import suffix_classes
from truegrain.session import settle

LENGTH = 200
GRAM = 40
#: Different spans of one anchor string that are sorted in one task.
TOGETHER = 1_000
#: A further anchor leaves about this share of the different parts of a group together.
LEFT_TOGETHER = 0.75
MOST_ANCHORS = 12
#: Bytes of spans, of one anchor string or of several, that are sorted in one go.
SORTED_BYTES = 400_000

_VALUES = (common.byte_values(11), common.byte_values(12))
_POWERS = (common.Powers(0x2545F4914F6CDD1D), common.Powers(0x9E6C63D0876A9A47 | 1))
KEY = ["id", "tie"]


class Prefixes:
    """Hashes of any substring of ``raw`` from sums over its prefixes."""

    def __init__(self, raw: np.ndarray, which: int):
        size = len(raw)
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_VALUES[which][raw] * _POWERS[which].up(size), out=self.sums[1:])
        self.down = _POWERS[which].down(size)

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return common.mix((self.sums[stops] - self.sums[starts]) * self.down[starts] + stops.astype(np.uint64) - starts.astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The leftmost place of the least value, by its upper half, of every window of ``width``."""
    best = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


def spans(raw: bytes, length: int) -> tuple[np.ndarray, ...]:
    """Of every span of a text: anchor hash, first window, windows, two digests, anchor (from the
    first window on), and how many bytes further the last of equal spans in a row begins."""
    size = len(raw)
    if size < length:
        none, nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return none, nothing, nothing, none, none, nothing, nothing
    data = np.frombuffer(raw, np.uint8)
    gram = min(GRAM, length)
    one, two = Prefixes(data, 0), Prefixes(data, 1)
    grams = one.of(np.arange(size - gram + 1), np.arange(gram, size + 1))
    anchors = _least(grams, length - gram + 1)
    first = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
    count = np.diff(np.append(first, len(anchors)))
    stop = first + count - 1 + length
    found = [grams[anchors[first]], first, count, one.of(first, stop), two.of(first, stop), anchors[first] - first]
    same = np.concatenate([[False], *[np.logical_and.reduce([found[i][1:] == found[i][:-1] for i in (0, 2, 3, 4, 5)])]])
    begin = np.flatnonzero(~same)
    last = np.append(begin[1:], len(first)) - 1
    return (*(f[begin] for f in found), first[last] - first[begin])


def parts(raw: bytes, lead: int, lots: int, length: int) -> tuple[np.ndarray, ...]:
    """A span cut by the places of further anchors: key of the group, first window, windows, two digests of every part.

    Equal windows of one anchor string, which is at ``lead`` here, have equal keys.
    """
    data = np.frombuffer(raw, np.uint8)
    gram = min(GRAM, length)
    one, two = Prefixes(data, 0), Prefixes(data, 1)
    grams = one.of(np.arange(len(raw) - gram + 1), np.arange(gram, len(raw) + 1))
    further = min(MOST_ANCHORS, math.ceil(math.log(lots) / -math.log(LEFT_TOGETHER)))
    places = [_least(common.mix(grams + np.uint64(k)), length - gram + 1) for k in range(1, further + 1)]
    changes = np.logical_or.reduce([p[1:] != p[:-1] for p in places])
    first = np.concatenate([[0], np.flatnonzero(changes) + 1])
    count = np.diff(np.append(first, len(places[0])))
    key = np.zeros(len(first), np.uint64)
    for p in places:
        own = p[first]
        key = common.mix(key + grams[own]) + (own - lead).astype(np.uint64)
    stop = first + count - 1 + length
    return key, first, count, one.of(first, stop), two.of(first, stop)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text")).withColumn("tie", F.xxhash64("text"))


def _span_rows(source: DataFrame, length: int, whole: bool) -> DataFrame:
    """A row for each span; only the anchor and a digest unless ``whole``."""

    def work(piece: pa.RecordBatch):
        texts = [t.encode("utf-8", "surrogatepass") for t in common.texts_of(piece, "text")]
        made = [spans(t, length) for t in texts]
        anchor, first, count, one, two, lead, run = (np.concatenate(x) for x in zip(*made))
        found = {"anchor": _signed(anchor), "one": _signed(one), "times": pa.array(1 + (run > 0), pa.int32())}
        if whole:
            each = [len(m[0]) for m in made]
            at = np.repeat(np.arange(len(texts)), each)
            found |= {
                "id": piece.column("id").take(pa.array(at)),
                "tie": piece.column("tie").take(pa.array(at)),
                "two": _signed(two),
                "first": pa.array(first.astype(np.int32)),
                "windows": pa.array(count.astype(np.int32)),
                "lead": pa.array(lead.astype(np.int32)),
                "run": pa.array(run.astype(np.int32)),
            }
        return found

    schema = "anchor bigint, one bigint, times int"
    if whole:
        schema += ", id bigint, tie bigint, two bigint, first int, windows int, lead int, run int"
    return common.map_texts(source, "text", schema, work)


def _sorted_repeats(classes: DataFrame, length: int) -> DataFrame:
    """For each class of spans with its text: which of its windows repeat, by suffix sorting.

    ``runs`` are ranges of windows that also occur in another span of the same task, or twice
    in this one. For anchors dealt over several tasks, ``digests`` has two numbers for every
    different window of the task, at the first class that has it; ``at`` is its place.
    """
    schema = (
        "anchor bigint, one bigint, two bigint, runs array<struct<low: int, high: int>>, at array<int>, digest1 array<bigint>, digest2 array<bigint>"
    )

    def lists(values: np.ndarray | pa.Array, owner: np.ndarray, count: int) -> pa.Array:
        """A list for each owner of its values; owners ascend."""
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), values if isinstance(values, pa.Array) else pa.array(values))

    def sort_groups(rows: list[tuple], group: np.ndarray) -> pa.RecordBatch:
        anchors, _, one, two, texts, times, lots, leads = zip(*rows)
        count = len(rows)
        begins = np.cumsum([0, *map(len, texts)])
        windows = np.diff(begins) - length + 1
        owner = np.repeat(np.arange(count), windows)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        raw = b"".join(texts)
        places = begins[owner] + offset
        # Equal windows have their anchor in the same place, so only those are sorted together.
        buckets = group[owner] * (2 * length + 1) + (offset - np.array(leads)[owner]) + length
        order, numbers = suffix_classes(raw, places, length, buckets)
        again = (np.bincount(numbers)[numbers] > 1) | (np.array(times) > 1)[owner]
        of, at = owner[again], offset[again]
        # Windows in a row as one range.
        breaks = np.flatnonzero((of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)) if len(at) else np.zeros(0, np.int64)
        low = np.concatenate([[0], breaks + 1])[: len(at)].astype(np.int64)
        high = np.append(breaks, len(at) - 1)[: len(at)]
        made = (pa.array(at[x].astype(np.int32)) for x in (low, high))
        runs = lists(pa.StructArray.from_arrays(list(made), ["low", "high"]), of[low], count)
        # One window of each class, for the count over several tasks.
        first = np.zeros(len(owner), bool)
        first[np.unique(numbers, return_index=True)[1]] = True
        first &= (np.array(lots) > 1)[owner]
        data, at = np.frombuffer(raw, np.uint8), places[first]
        digests = [Prefixes(data, w).of(at, at + length).view(np.int64) if len(at) else np.zeros(0, np.int64) for w in (0, 1)]
        return pa.RecordBatch.from_pydict(
            {
                "anchor": pa.array(anchors, pa.int64()),
                "one": pa.array(one, pa.int64()),
                "two": pa.array(two, pa.int64()),
                "runs": runs,
                "at": lists(offset[first].astype(np.int32), owner[first], count),
                "digest1": lists(digests[0], owner[first], count),
                "digest2": lists(digests[1], owner[first], count),
            }
        )

    def run(batches):
        rows: list[tuple] = []
        group: list[int] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                new = not rows or rows[-1][:2] != row[:2]
                if new and size > SORTED_BYTES:
                    yield sort_groups(rows, np.array(group))
                    rows, group, size = [], [], 0
                group.append(group[-1] + new if group else 0)
                rows.append(row)
                size += len(row[4])
        if rows:
            yield sort_groups(rows, np.array(group))

    columns = ["anchor", "lot", "one", "two", "span", "n", "lots", "lead"]
    dealt = classes.repartition("anchor", "lot").sortWithinPartitions("anchor", "lot")
    return dealt.select(*columns).mapInArrow(run, schema)


CLASS = ["anchor", "one", "two"]


def _runs_of(classes: DataFrame, length: int) -> DataFrame:
    """For each class of spans, with its text: ``runs``, ranges of its windows that repeat.

    ``classes`` have ``anchor``, ``one``, ``two``, ``n``, ``lead``, ``span``, ``lots`` and ``lot``.
    A class may have several rows.
    """
    results = settle(_sorted_repeats(classes, length))
    zipped = F.explode(F.arrays_zip("at", "digest1", "digest2")).alias("w")
    windows = results.where(F.size("at") > 0).select(*CLASS, zipped).select(
        *CLASS, F.col("w.at").alias("start"), F.col("w.digest1").alias("d1"), F.col("w.digest2").alias("d2")
    )
    # Each task names a window once, so a window counted twice is in two tasks, and the
    # classes named are those in which it was alone or first.
    across = (
        windows.groupBy("anchor", "d1", "d2")
        .agg(F.collect_list(F.struct("one", "two", "start")).alias("where"))
        .where(F.size("where") > 1)
        .select("anchor", F.explode("where").alias("w"))
        .select("anchor", "w.one", "w.two", F.array(F.struct(F.col("w.start").alias("low"), F.col("w.start").alias("high"))).alias("runs"))
    )
    return results.where(F.size("runs") > 0).select(*CLASS, "runs").union(across)


def _dealt(classes: DataFrame) -> DataFrame:
    """``classes`` with ``lots``, over how many tasks their anchor string is dealt, and ``lot``, their own."""
    per_anchor = classes.groupBy("anchor").agg(F.count("*").alias("spans"))
    lots = F.ceil(F.col("spans") / TOGETHER).cast("int")
    return classes.join(per_anchor, "anchor").select(
        *classes.columns, lots.alias("lots"), F.pmod(F.col("two"), lots).cast("int").alias("lot")
    )


def _runs_of_many(classes: DataFrame, length: int) -> DataFrame:
    """As :func:`_runs_of`, for classes of anchor strings that have many: their parts are searched instead."""
    schema = "anchor bigint, one bigint, two bigint, n bigint, lead int, first int, key bigint, part1 bigint, part2 bigint, span binary"

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                key, first, count, one, two = parts(row["span"], row["lead"], row["lots"], length)
                size = len(key)
                texts = [row["span"][a : a + c - 1 + length] for a, c in zip(first.tolist(), count.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        **{c: pa.array([row[c]] * size, pa.int64()) for c in (*CLASS, "n")},
                        "lead": pa.array((row["lead"] - first).astype(np.int32)),
                        "first": pa.array(first.astype(np.int32)),
                        "key": _signed(key),
                        "part1": _signed(one),
                        "part2": _signed(two),
                        "span": pa.array(texts, pa.binary()),
                    }
                )

    wanted = classes.select(*CLASS, "n", "lead", "lots", "span")
    own = F.xxhash64("anchor", "key")
    made = settle(wanted.mapInArrow(cut, schema).withColumn("group", own).drop("key"))
    alike = made.groupBy(F.col("group").alias("anchor"), F.col("part1").alias("one"), F.col("part2").alias("two")).agg(
        F.sum("n").alias("n"), F.min(F.struct("lead", "span")).alias("sample")
    )
    runs = _runs_of(_dealt(settle(alike.select(*CLASS, "n", "sample.*"))), length)
    found = common.stored(runs.select(*(F.col(c).alias(f"part_{c}") for c in CLASS), "runs"), "runs")
    met = (F.col("group") == F.col("part_anchor")) & (F.col("part1") == F.col("part_one")) & (F.col("part2") == F.col("part_two"))
    moved = F.transform(
        "runs", lambda r: F.struct((r["low"] + F.col("first")).alias("low"), (r["high"] + F.col("first")).alias("high"))
    )
    return made.drop("span").join(found, met).select(*CLASS, moved.alias("runs"))


def repeated_ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id``, ``tie`` (hash of the text), ``from`` and ``to``: ranges of bytes that repeat, not yet united."""
    source = _texts(df, id_col, text_col)
    anchors = (
        _span_rows(source, length, whole=False)
        .groupBy("anchor")
        .agg(F.sum("times").alias("times"), (F.min("one") != F.max("one")).alias("mixed"))
        .where("times > 1")
        .select("anchor", "mixed")
    )
    # Stored, so that the join stands right on two shuffles and its hot anchors can be split.
    anchors = common.stored(anchors, "anchors")
    # The side of the spans streams past the anchors that repeat: no sort of either.
    found = settle(_span_rows(source, length, whole=True).join(anchors.hint("shuffle_hash"), "anchor"))
    classes = found.groupBy(*CLASS, "mixed").agg(
        F.sum("times").alias("n"), F.min(F.struct("id", "tie", "first", "windows", "lead")).alias("sample")
    )
    located = settle(_dealt(settle(classes.where("mixed").select(*CLASS, "n", "sample.*"))))
    many = not located.where("lots > 1").isEmpty()
    by_text = located.groupBy(*KEY).agg(
        F.collect_list(F.struct(*CLASS, "n", "lots", "lot", "first", "windows", "lead")).alias("spans")
    )
    texts = source.alias("s").join(
        by_text.hint("shuffle_hash").alias("b"),
        F.col("s.id").eqNullSafe(F.col("b.id")) & (F.col("s.tie") == F.col("b.tie")),
    )
    raw = F.encode(F.col("s.text"), "UTF-8")
    with_text = (
        texts.select(raw.alias("raw"), F.explode("b.spans").alias("span_"))
        .select("span_.*", F.expr(f"substring(raw, span_.first + 1, span_.windows + {length - 1})").alias("span"))
        # A row that occurs twice brings its sample twice; one text of a class is enough.
        .dropDuplicates(CLASS)
    )
    if many:
        with_text = settle(with_text)
        runs = _runs_of(with_text.where("lots = 1"), length).union(_runs_of_many(with_text.where("lots > 1"), length))
    else:
        runs = _runs_of(with_text, length)
    # One row of each class; stored, so that the spans of a frequent one can be split in the join.
    ranges = common.stored(runs.groupBy(*CLASS).agg(F.flatten(F.collect_list("runs")).alias("runs")), "ranges")
    start = F.col("first")
    plain = found.where("not mixed").select(
        *KEY, start.alias("from"), (start + F.col("run") + F.col("windows") - 1 + length).alias("to")
    )
    # Where a span has equal ones behind it, all its windows repeat.
    partly = found.where("mixed").join(ranges, CLASS).select(*KEY, "first", "run", F.explode("runs").alias("r")).select(
        *KEY, (start + F.col("r.low")).alias("from"), (start + F.col("run") + F.col("r.high") + length).alias("to")
    )
    return plain.union(partly)


def unite(ranges: list[dict]) -> list[tuple[int, int]]:
    """Ranges that touch or overlap as one, in order."""
    found: list[list[int]] = []
    for r in sorted((r["from"], r["to"]) for r in ranges):
        if found and r[0] <= found[-1][1]:
            found[-1][1] = max(found[-1][1], r[1])
        else:
            found.append([r[0], r[1]])
    return [tuple(r) for r in found]


def _with_ranges(df: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``df`` with ``_ranges``, a list of its repeated ranges or NULL."""
    ranges = (
        repeated_ranges(df, id_col, text_col, length)
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("from", "to")).alias("_ranges"))
        .select(F.col("id").alias("_id"), F.col("tie").alias("_tie"), "_ranges")
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    met = F.col(id_col).cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_tie"))
    return df.join(ranges.hint("shuffle_hash"), met, "left").drop("_id", "_tie")


def _cut(text: str | None, ranges: list[dict] | None) -> tuple[bytes, list[bytes]]:
    """The bytes that stay, and the removed runs."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    kept, gone, at = [], [], 0
    for start, stop in unite(ranges or []):
        kept.append(raw[at:start])
        gone.append(raw[start:stop])
        at = stop
    return b"".join([*kept, raw[at:]]), gone


def removed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: ``id_col``, ``kept`` (binary: the bytes that stay), ``n_bytes``, ``spans`` (removed runs, from and length)."""
    joined = _with_ranges(df.select(id_col, text_col), id_col, text_col, length)
    kind = df.schema[id_col].dataType.simpleString()
    source = joined.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"), "_ranges")

    def work(piece: pa.RecordBatch):
        ranges = piece.column("_ranges").to_pylist()
        texts = common.texts_of(piece, "text")
        united = [unite(r or []) for r in ranges]
        return {
            id_col: piece.column("key"),
            "kept": pa.array([_cut(t, r)[0] for t, r in zip(texts, ranges)], pa.binary()),
            "n_bytes": pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
            "spans": pa.array(
                [[{"from": a, "length": b - a} for a, b in u] for u in united],
                pa.list_(pa.struct([("from", pa.int32()), ("length", pa.int32())])),
            ),
        }

    schema = f"`{id_col}` {kind}, kept binary, n_bytes bigint, spans array<struct<`from`:int, length:int>>"
    return common.map_texts(source, "text", schema, work)


def digests(cut: DataFrame, id_col: str = "doc_id") -> DataFrame:
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["length"])
    return cut.select(
        id_col,
        "n_bytes",
        gone.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def kept_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", length: int = LENGTH
) -> DataFrame:
    """``df`` with what is left of each text; rows whose whole text went are dropped.

    A character of which a byte went goes whole. ``chars_col`` is counted anew.
    """
    joined = _with_ranges(df, id_col, text_col, length)
    names = df.columns
    at = names.index(text_col)

    def run(batches):
        for piece in common.slices(batches, text_col):
            texts, ranges = piece.column(text_col).to_pylist(), piece.column("_ranges").to_pylist()
            left = [t if not r else _cut(t, r)[0].decode("utf-8", "ignore") for t, r in zip(texts, ranges)]
            keep = pa.array([bool(t) or not r for t, r in zip(left, ranges)])
            columns = [piece.column(c) for c in names]
            columns[at] = pa.array(left, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(keep)

    done = joined.select(*names, "_ranges").mapInArrow(run, df.schema)
    if chars_col and chars_col in df.columns:
        count = F.when(F.col(text_col).isNull(), F.col(chars_col)).otherwise(F.length(text_col))
        done = done.withColumn(chars_col, count.cast(df.schema[chars_col].dataType))
    return done
