"""Document fingerprints: all shingle hashes below a fixed fraction of the hash range.

The share of hashes kept is the same for every document, so sketches of very unequal
documents compare without loss and the sketch of a union is the union of the sketches.
A short document would often keep nothing; its ``LEAST`` smallest hashes are therefore
kept too, and a sketch knows up to which hash it is whole (``Sketch.whole_to``). Sketches
are compared on the range where both are whole.

Shingles are five words (a shorter text is one shingle), words are runs without white
space, A-Z in lower case. A fingerprint is ``count:`` and the kept hashes in ascending
order, each as 16 hexadecimal digits; equal texts have equal fingerprints.

Cases: a NULL or empty text has no shingle, the fingerprint ``0:`` and likeness 0 to
everything but the same fingerprint, to which it is 1; ties of id go by the hash of the
text; a NULL id comes last in descending order; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from truegrain.llm import common

SHINGLE = 5
#: Hashes kept of the whole range: one in ``SCALE``.
SCALE = 8
LEAST = 32
_TOP = (1 << 64) - 1


@dataclass
class Sketch:
    count: int  # different shingles of the document
    hashes: np.ndarray  # kept, ascending

    @property
    def whole_to(self) -> int:
        """All hashes of the document up to here were kept."""
        if len(self.hashes) == self.count:
            return _TOP
        return max(_TOP // SCALE, int(self.hashes[-1]))

    def text(self) -> str:
        return f"{self.count}:" + self.hashes.astype(">u8").tobytes().hex()


def parse(fingerprint: str) -> Sketch:
    count, _, digits = fingerprint.partition(":")
    return Sketch(int(count), np.frombuffer(bytes.fromhex(digits), ">u8").astype(np.uint64))


def merge(one: Sketch, other: Sketch) -> Sketch:
    """The sketch of both documents together, on the range where both are whole.

    Its count is exact if both sketches hold all hashes, and an estimate otherwise.
    """
    to = np.uint64(min(one.whole_to, other.whole_to))
    both = np.union1d(one.hashes, other.hashes)
    both = both[both <= to]
    whole = one.whole_to == other.whole_to == _TOP
    return Sketch(len(both) if whole else max(len(both) + 1, round(len(both) * (_TOP / int(to)))), both)


def _common(one: Sketch, other: Sketch) -> tuple[int, int, int]:
    to = np.uint64(min(one.whole_to, other.whole_to))
    a = one.hashes[: np.searchsorted(one.hashes, to, side="right")]
    b = other.hashes[: np.searchsorted(other.hashes, to, side="right")]
    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    return int((b[at] == a).sum()) if len(b) else 0, len(a), len(b)


def likeness(one: Sketch, other: Sketch) -> float:
    """Estimate of the Jaccard similarity of the two shingle sets."""
    shared, a, b = _common(one, other)
    if not a + b:
        return float(one.count == other.count == 0)
    return shared / (a + b - shared)


def containment(one: Sketch, other: Sketch) -> float:
    """Estimate of the share of the first document's shingles that the second has."""
    shared, a, _ = _common(one, other)
    return shared / a if a else 0.0


def sketches(texts: list[str]) -> list[Sketch]:
    hashes, owner = common.shingles(texts, SHINGLE)
    found = []
    for i in range(len(texts)):
        own = np.unique(hashes[owner[i] : owner[i + 1]])
        keep = max(int(np.searchsorted(own, np.uint64(_TOP // SCALE), side="right")), min(LEAST, len(own)))
        found.append(Sketch(len(own), own[:keep].copy()))
    return found


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _ranges(df: DataFrame, wanted: int) -> DataFrame:
    """``df`` with ``bucket``, a range of ids, and ``helps``.

    Buckets descend as ids do. A row of ``helps`` is a copy of the first row of the next
    bucket, for the last row of this one to see. Bounds come from the ids alone, so they
    are the same however often a task is repeated.
    """
    bounds = df.agg(
        F.percentile_approx("id", F.array(*[F.lit(i / wanted) for i in range(1, wanted)]), 20 * wanted).alias("b")
    ).first()["b"]
    bounds = sorted(set(bounds or []), reverse=True)
    if bounds:
        steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
        cuts = F.array(*[F.lit(b) for b in bounds])
        # The number of bounds that are greater than the id, by halving; NULL comes last.
        number = F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda low, step: F.when(
                (low + step <= len(bounds))
                & (F.element_at(cuts, F.least(low + step, F.lit(len(bounds)))) > F.col("id")),
                low + step,
            ).otherwise(low),
        )
        bucket = F.when(F.col("id").isNull(), F.lit(len(bounds))).otherwise(number)
    else:
        bucket = F.lit(0)
    rows = df.withColumn("bucket", bucket.cast("int"))
    # The first row of each bucket, by (id descending, NULL last, tie descending).
    first = rows.groupBy("bucket").agg(F.max(F.struct(F.col("id").isNotNull(), "id", "tie")).alias("top"))
    ordered = Window.orderBy("bucket")
    before = F.lag("bucket").over(ordered)
    last = F.max("bucket").over(Window.partitionBy())
    helpers = first.select(
        F.coalesce(before, last).alias("helped"), F.col("top.id").alias("hid"), F.col("top.tie").alias("htie")
    )
    met = rows.join(
        F.broadcast(helpers), F.col("id").eqNullSafe(F.col("hid")) & (F.col("tie") == F.col("htie")), "left"
    )
    both = F.when(
        F.col("helped").isNotNull(),
        F.array(
            F.struct(F.col("bucket"), F.lit(False).alias("helps")),
            F.struct(F.col("helped").alias("bucket"), F.lit(True).alias("helps")),
        ),
    ).otherwise(F.array(F.struct(F.col("bucket"), F.lit(False).alias("helps"))))
    return met.select("id", "text", "tie", F.explode(both).alias("to")).select(
        "id", "text", "tie", F.col("to.bucket").alias("bucket"), F.col("to.helps").alias("helps")
    )


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, that of its edited text, and its likeness to that and to the next row.

    The next row is the one with the next smaller id, a number; after the last comes the first.
    """
    kind = df.schema[id_col].dataType.simpleString()
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = _ranges(source.withColumn("tie", F.xxhash64("text")), wanted)
    placed = rows.repartition(wanted, "bucket").sortWithinPartitions(
        "bucket", "helps", F.col("id").desc_nulls_last(), F.col("tie").desc()
    )

    arrow_kind = to_arrow_type(df.schema[id_col].dataType)

    def flush(ids, texts, nexts, own, next_own):
        changed = [edited(t, n) for t, n in zip(texts, nexts)]
        other = sketches(changed)
        return pa.RecordBatch.from_pydict(
            {
                id_col: pa.array(ids, arrow_kind),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "edited_sha256": [hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed],
                "fingerprint": [s.text() for s in own],
                "edited_fingerprint": [s.text() for s in other],
                "near_edited": [likeness(a, b) for a, b in zip(own, other)],
                "near_next": [likeness(a, b) for a, b in zip(own, next_own)],
            }
        )

    def run(batches):
        held = None  # the last row seen: its id, text, sketch and bucket wait for the next row
        for piece in common.slices(batches, "text"):
            texts = common.texts_of(piece, "text")
            own = sketches(texts)
            ids, nexts = piece.column("id").to_pylist(), piece.column("bucket").to_pylist()
            helps = piece.column("helps").to_pylist()
            rows = list(zip(ids, texts, own, nexts, helps))
            if held is not None:
                rows.insert(0, held)
            pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:]) if not a[4]]
            if any(a[3] != b[3] for a, b in pairs):
                raise RuntimeError("a bucket has no row to follow its last")
            held = rows[-1]
            if pairs:
                now, then = zip(*pairs)
                yield flush(*([r[i] for r in now] for i in (0, 1)), [r[1] for r in then], [r[2] for r in now], [r[2] for r in then])

    schema = (
        f"`{id_col}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return placed.mapInArrow(run, schema)

