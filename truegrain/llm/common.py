"""Helpers that several operators share: tables, Arrow batches and hashing of words."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.session import new_shared_path

#: Text bytes that a task holds at once, beside single rows that are longer.
SLICE_BYTES = 2 << 20
SLICE_ROWS = 2_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the supplied tables, by a path that only Spark needs to reach."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read from there, so that its true size is known to joins."""
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of a sieve: its table has at most a 64th of them as rows, about 4 MB, at any size of data.
SIEVE_BITS = 1 << 24


def sieved(df: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` without most rows whose ``columns`` are not among ``keys``, before a shuffle of it.

    A bit for each key, by hash, in a table of bounded size that is broadcast. Rows of a
    key are never lost; others pass as far as bits fall together, so a join has to follow.
    """
    place = F.pmod(F.xxhash64(*columns), F.lit(SIEVE_BITS))
    word, bit = F.floor(place / 64), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    words = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    met = df.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(words), "_word")
    return met.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*df.columns)


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``SLICE_BYTES`` of ``column``, at most ``SLICE_ROWS`` long."""
    for batch in batches:
        values = batch.column(column)
        if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type):
            kind = np.int64
        else:
            kind = np.int32
        if not len(batch):
            continue
        ends = np.frombuffer(values.buffers()[1], dtype=kind)[values.offset : values.offset + len(batch) + 1]
        start = 0
        while start < len(batch):
            stop = int(np.searchsorted(ends, ends[start] + SLICE_BYTES, side="right")) - 1
            stop = min(max(stop, start + 1), start + SLICE_ROWS, len(batch))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Whole texts, NULL as empty."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def map_texts(
    df: DataFrame, column: str, schema: str, work: Callable[[pa.RecordBatch], dict[str, list]], setup=None
) -> DataFrame:
    """Rows that ``work`` makes of each slice of ``df``, as columns of ``schema``.

    ``setup`` is called once in a task and its value is given to ``work``.
    """

    def run(batches):
        state = setup() if setup else None
        for piece in slices(batches, column):
            made = work(piece, state) if setup else work(piece)
            if made is not None:
                yield pa.RecordBatch.from_pydict(made)

    return df.mapInArrow(run, schema)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (finalizer of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as far as they were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._up = self._down = np.ones(1, np.uint64)

    def up(self, count: int) -> np.ndarray:
        if len(self._up) < count:
            self._up = _powers(self.base, max(count, 1 << 12))
        return self._up[:count]

    def down(self, count: int) -> np.ndarray:
        if len(self._down) < count:
            self._down = _powers(self.inverse, max(count, 1 << 12))
        return self._down[:count]


def byte_values(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)


_BYTES = byte_values(7)
_WORDS = Powers(0x5851F42D4C957F2D)
#: The separators of words: space and \t to \r.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts: the hash and the length of each word, and where each text's words begin.

    Words are runs of bytes other than white space, A-Z in lower case. The last array
    has an entry more than there are texts.
    """
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts])
    space = _SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(raw) and not space[0]:
        edges = np.concatenate([[0], edges])
    starts, stops = edges[0::2], edges[1::2]
    lengths = stops - starts
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    at = np.arange(len(raw))
    at[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(raw))))
    values = _BYTES[_LOWER[raw]]
    values *= _WORDS.up(int(lengths.max()) + 1)[np.minimum(at, int(lengths.max()))]
    values[space] = 0
    hashes = mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64) * _ODD)
    return hashes, lengths, np.concatenate([[0], np.searchsorted(starts, ends)])


_ORDER = [pow(0xD6E8FEB86659FD93, i, 1 << 64) for i in range(64)]


def shingles(texts: list[str], size: int, lengths_too: bool = False):
    """Hashes of all runs of ``size`` words of each text, and where each text's begin.

    A text with fewer words, but not without any, is one run. With ``lengths_too`` also
    the bytes of the words of each run.
    """
    hashes, lengths, bounds = words_of(texts)
    n = np.diff(bounds)
    runs = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    starts = np.concatenate([[0], np.cumsum(runs)])
    total = int(starts[-1])
    at = np.arange(total) + np.repeat(bounds[:-1] - starts[:-1], runs)
    last = np.repeat(bounds[1:], runs)
    found, bytes_in = np.zeros(total, np.uint64), np.zeros(total, np.int64)
    for i in range(size):
        inside = at + i < last
        place = np.where(inside, at + i, 0)
        if len(hashes):
            found += np.where(inside, hashes[place] * np.uint64(_ORDER[i + 1]), np.uint64(i + 1))
            bytes_in += np.where(inside, lengths[place], 0)
    return (mix(found), starts, bytes_in) if lengths_too else (mix(found), starts)


def is_letter(char: str) -> bool:
    return unicodedata.category(char)[0] == "L"
