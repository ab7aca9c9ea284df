"""Codes of vectors by product quantisation; nearest entries by Orchard's search.

Vectors become integers, are cut into parts, and each part is replaced by the index of the
nearest entry of its codebook. Codebooks start from the vectors of the smallest ids and are
refined over whole rounds; every sum is of integers, so no order of rows or tasks shows.

Orchard's search keeps, for every entry, all entries sorted by their distance from it. From a
current entry it walks that list; a nearer entry (or an equal one of lower index) becomes the
current one, whose list is walked from its begin; entries once visited are passed over, and
the walk ends beyond twice the current distance, where no entry can be as near.

A round reads the table once and sends a row per part, entry and position from each task.
Codebooks are as large as their parameters and are all that passes the driver.

Cases: vectors that are NULL or hold NULL, NaN or infinity are dropped, and so are those that
are not as long as the one of the smallest id. NULL ids come last, ties of ids go by the
vector. With fewer vectors than entries, codebooks have so many entries. A length that the
parts do not divide is filled with zeros. Repeated rows count each. An empty table has no
rows. Components of 2^16 and more are an error, as 64 bits could not hold the distances.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm import common

SCALE = 4_096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Sizes of integer components, so that squares of differences can be summed in 64 bits.
LIMIT = 1 << 28
#: Vectors that are searched together.
TOGETHER = 8_192


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, index and position (int64), for vectors of ``length`` components."""

    entries: np.ndarray
    length: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def as_integers(vectors: pa.Array, length: int, scale: int = SCALE, parts: int = PARTS) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are whole vectors of ``length``, and these as integers, by row, part and position."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.asarray(vectors.value_lengths().fill_null(-1))
    right = sizes == length
    flat = vectors.filter(pa.array(right)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, length)
    whole = np.isfinite(values).all(axis=1)
    kept = np.zeros(len(vectors), bool)
    kept[np.flatnonzero(right)[whole]] = True
    scaled = np.floor(values[whole] * scale)
    if np.abs(scaled).max(initial=0) > LIMIT:
        raise ValueError(f"a component times {scale} is greater than {LIMIT}")
    wide = -(-length // parts) * parts
    found = np.zeros((len(scaled), wide), np.int64)
    found[:, :length] = scaled
    return kept, found.reshape(len(found), parts, wide // parts)


def neighbours(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of a codebook: all entries by distance from it, and these squared distances."""
    apart = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
    order = np.argsort(apart, axis=1, kind="stable")
    return order, np.take_along_axis(apart, order, axis=1)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point (of equal ones the lowest), and its squared distance."""
    order, apart = neighbours(entries)
    count = len(points)
    current = np.zeros(count, np.int64)
    best = ((points - entries[0]) ** 2).sum(axis=1)
    visited = np.zeros((count, len(entries)), bool)
    visited[:, 0] = True
    place = np.ones(count, np.int64)  # an entry is the first of its own list
    going = np.arange(count)
    while len(going):
        going = going[place[going] < len(entries)]
        # |current - other| > 2 |current - point|, all squared
        going = going[apart[current[going], place[going]] <= 4 * best[going]]
        other = order[current[going], place[going]]
        place[going] += 1
        fresh = ~visited[going, other]
        rows, other = going[fresh], other[fresh]
        visited[rows, other] = True
        distance = ((points[rows] - entries[other]) ** 2).sum(axis=1)
        better = (distance < best[rows]) | ((distance == best[rows]) & (other < current[rows]))
        rows, other = rows[better], other[better]
        current[rows], best[rows], place[rows] = other, distance[better], 0
    return current, best


def assigned(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of integer vectors: the entry of each part, and the squared distance of the whole."""
    codes = np.zeros(vectors.shape[:2], np.int64)
    errors = np.zeros(len(vectors), np.int64)
    for begin in range(0, len(vectors), TOGETHER):
        some = slice(begin, begin + TOGETHER)
        for part in range(vectors.shape[1]):
            codes[some, part], distance = nearest(vectors[some, part], books[part])
            errors[some] += distance
    return codes, errors


def _first_books(df: DataFrame, id_col: str, vector_col: str, scale: int, parts: int, entries: int) -> Codebooks | None:
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    source = df.select(F.col(id_col).alias("id"), vector.alias("vector")).where(F.coalesce(fine, F.lit(False)))
    order = [F.col("id").asc_nulls_last(), "vector"]
    first = source.orderBy(*order).limit(1).select(F.size("vector").alias("n")).collect()
    if not first:
        return None
    length = first[0]["n"]
    rows = source.where(F.size("vector") == length).orderBy(*order).limit(entries).collect()
    seeds = as_integers(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), length, scale, parts)[1]
    return Codebooks(np.ascontiguousarray(seeds.transpose(1, 0, 2)), length)


def _sums(df: DataFrame, vector_col: str, books: Codebooks, scale: int) -> list:
    """By part, entry and position: how many vectors have the entry, and the sum of their components."""
    parts, entries, width = books.entries.shape

    def run(batches):
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            vectors = as_integers(batch.column(0), books.length, scale, parts)[1]
            codes, _ = assigned(vectors, books.entries)
            for part in range(parts):
                count[part] += np.bincount(codes[:, part], minlength=entries)
                np.add.at(total[part], codes[:, part], vectors[:, part])
        part, entry, position = np.nonzero(np.repeat(count[:, :, None] > 0, width, axis=2))
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(part, pa.int32()),
                "entry": pa.array(entry, pa.int32()),
                "position": pa.array(position, pa.int32()),
                "n": pa.array(count[part, entry], pa.int64()),
                "total": pa.array(total[part, entry, position], pa.int64()),
            }
        )

    made = df.select(F.col(vector_col).cast("array<double>").alias("vector")).mapInArrow(
        run, "part int, entry int, position int, n bigint, total bigint"
    )
    wide = "decimal(38,0)"
    return (
        made.groupBy("part", "entry", "position")
        .agg(F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("total").cast(wide)).alias("total"))
        .collect()
    )


def learn(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks after so many rounds over all vectors; None if there are no vectors.

    A round that changes nothing ends the work, as all later ones would change nothing.
    """
    books = _first_books(df, id_col, vector_col, scale, parts, entries)
    for _ in range(rounds if books else 0):
        refined = books.entries.copy()
        for row in _sums(df, vector_col, books, scale):
            refined[row["part"], row["entry"], row["position"]] = int(row["total"]) // int(row["n"])
        if (refined == books.entries).all():
            break
        books = Codebooks(refined, books.length)
    return books


def codes(
    df: DataFrame,
    books: Codebooks | None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    scale: int = SCALE,
) -> DataFrame:
    """``id``, ``label``, ``codes`` (array of int) and ``error`` of every whole vector.

    ``error`` is the squared distance from the vector to what its codes stand for.
    """
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    source = df.select(
        F.col(id_col).alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    schema = f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error bigint"

    def run(batches):
        for batch in batches if books else ():
            parts = len(books.entries)
            kept, vectors = as_integers(batch.column("vector"), books.length, scale, parts)
            found, errors = assigned(vectors, books.entries)
            mask = pa.array(kept)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id").filter(mask),
                    "label": batch.column("label").filter(mask),
                    "codes": pa.ListArray.from_arrays(
                        pa.array(np.arange(len(found) + 1, dtype=np.int32) * parts), pa.array(found.ravel(), pa.int32())
                    ),
                    "error": pa.array(errors, pa.int64()),
                }
            )

    return source.mapInArrow(run, schema)


def rebuilt(coded: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """``id`` and ``vector`` (array of double): what the codes stand for."""

    def run(batches):
        for batch in batches:
            chosen = batch.column("codes").flatten().to_numpy().reshape(-1, len(books.entries))
            found = np.concatenate([books.entries[p][chosen[:, p]] for p in range(len(books.entries))], axis=1)
            values = found[:, : books.length] / scale
            ends = np.arange(len(values) + 1, dtype=np.int32) * books.length
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "vector": pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))}
            )

    kind = coded.schema["id"].dataType.simpleString()
    return coded.select("id", "codes").mapInArrow(run, f"id {kind}, vector array<double>")


def digests(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Every vector's code in hexadecimal, its error, the error of its label, and a digest of the codebooks."""
    books = learn(df, id_col, vector_col)
    coded = common.stored(codes(df, books, id_col, vector_col, label_col), "codes")
    wide = F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint")
    # Stored, so that the join's sides are plain scans: a label of many rows can be split.
    labels = common.stored(coded.groupBy(F.col("label").alias("of")).agg(wide.alias("label_error")), "labels")
    code = F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))))
    return coded.join(labels, coded["label"].eqNullSafe(labels["of"])).select(
        F.col("id").alias(id_col),
        code.alias("code"),
        "error",
        "label_error",
        F.lit(books.digest() if books else "").alias("codebooks_sha256"),
    )
