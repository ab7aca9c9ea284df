"""Token ids in files of bit or byte planes.

A file row is a segment: whole documents in order, their ids one after another. The ids
are cut into blocks of a fixed size; a block is transposed, so that all first bytes (or
bits) of its ids stand together, then all second ones, and so on; each plane is
compressed by zstandard. The chunk index of a segment holds the compressed length of
every plane of every block, so that any block can be read alone. Segments are rows of a
Parquet folder: Spark writes and commits them, and any store that Spark reaches will do.

Documents are in ascending order of id, NULL first, ties in the order of a hash of their
text. Segments are numbered by (``part``, ``segment``); parts are ranges of the order.

Cases: a NULL or empty text is the end id alone (or nothing without one); repeated rows
are written each; an empty table makes an empty folder that reads back as no rows; other
columns of the input are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from truegrain.llm import common
from truegrain.llm.library import library_encoder

#: Ids in a block.
BLOCK = 1 << 16
ID = np.dtype("<u4")

SCHEMA = (
    "part int, segment int, planes string, block int, doc_ids array<bigint>, counts array<bigint>, "
    "chunk_index array<int>, payload binary"
)


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of one block, lowest first."""
    rows = np.ascontiguousarray(ids, ID).view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        return [p.tobytes() for p in np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1)]
    return [p.tobytes() for p in np.ascontiguousarray(rows.T)]


def from_planes(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    if kind == "bit":
        bits = np.unpackbits(np.frombuffer(b"".join(planes), np.uint8).reshape(32, -1), axis=1, count=count)
        rows = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        rows = np.frombuffer(b"".join(planes), np.uint8).reshape(4, count).T
    return np.ascontiguousarray(rows).view(ID).ravel()


def pack(ids: np.ndarray, kind: str, block: int = BLOCK, level: int = 3) -> tuple[list[int], bytes]:
    """Chunk index and payload of a segment."""
    press = zstandard.ZstdCompressor(level=level)
    chunks = [press.compress(p) for b in range(0, len(ids), block) for p in to_planes(ids[b : b + block], kind)]
    return [len(c) for c in chunks], b"".join(chunks)


def unpack(index: list[int], payload: bytes, total: int, kind: str, block: int = BLOCK) -> np.ndarray:
    """All ids of a segment."""
    each = 32 if kind == "bit" else 4
    press, at, blocks = zstandard.ZstdDecompressor(), 0, []
    for b in range(0, total, block):
        planes = []
        for length in index[b // block * each : (b // block + 1) * each]:
            planes.append(press.decompress(payload[at : at + length]))
            at += length
        blocks.append(from_planes(planes, min(block, total - b), kind))
    return np.concatenate(blocks) if blocks else np.zeros(0, ID)


def write(
    df: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 1,
    kind: str = "byte",
    block: int = BLOCK,
) -> None:
    """Encode every whole text of ``df`` and write the ids to ``path``."""
    if kind not in ("bit", "byte"):
        raise ValueError("kind: bit or byte")
    spark = df.sparkSession
    source = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["id", F.xxhash64("text")]
    ordered = source.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches):
        encoder, part, segment = library_encoder(tokenizer), TaskContext.get().partitionId(), 0
        for piece in common.slices(batches, "text"):
            ids, counts = encoder.encode_texts(common.texts_of(piece, "text"))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
            index, payload = pack(ids, kind, block)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "segment": pa.array([segment], pa.int32()),
                    "planes": [kind],
                    "block": pa.array([block], pa.int32()),
                    "doc_ids": pa.array([piece.column("id").to_pylist()], pa.list_(pa.int64())),
                    "counts": pa.array([counts.tolist()], pa.list_(pa.int64())),
                    "chunk_index": pa.array([index], pa.list_(pa.int32())),
                    "payload": pa.array([payload], pa.binary()),
                }
            )
            segment += 1

    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def _segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each segment, from the counts alone: first over the parts, then within each."""
    sizes = spark.read.parquet(path).select(
        "part", "segment", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("size")
    )
    before = F.coalesce(F.sum("part_size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("size").alias("part_size")).select("part", before.alias("part_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(parts, "part").select(
        "part", "segment", (F.col("part_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("segment_start")
    )


def read(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per document, from the files: its id, ``start``, ``n_tokens``, ``ids_crc32``, ``ids``.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is of its ids as
    little-endian unsigned 32-bit integers. ``ids`` (array of bigint) is left out on request.
    """
    schema = "part int, segment int, id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ends = np.concatenate([[0], np.cumsum(counts)])
                ids = unpack(row["chunk_index"], row["payload"], int(ends[-1]), row["planes"], row["block"])
                raw = ids.tobytes()
                made = {
                    "part": pa.array([row["part"]] * len(counts), pa.int32()),
                    "segment": pa.array([row["segment"]] * len(counts), pa.int32()),
                    "id": pa.array(row["doc_ids"], pa.int64()),
                    "within": pa.array(ends[:-1]),
                    "n_tokens": pa.array(counts),
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64()),
                }
                if with_ids:
                    made["ids"] = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_pydict(made)

    found = spark.read.parquet(path).mapInArrow(run, schema + (", ids array<bigint>" if with_ids else ""))
    return found.join(_segment_starts(spark, path), ["part", "segment"]).select(
        F.col("id").alias(id_col),
        (F.col("segment_start") + F.col("within")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )
