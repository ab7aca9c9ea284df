"""Exact histogram of encoded lengths, with suffix sums for every context limit.

Documents are counted by their number of ids, so everything after the first aggregation
is as large as the number of different lengths. Suffix sums are taken in two steps, over
ranges of lengths and inside each range, so that no task needs the whole histogram.

Cases: a NULL or empty text has length 0; a NULL length is left out; an empty table has
an empty histogram; repeated rows count each.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truegrain.llm import common
from truegrain.llm.library import LibraryEncoder, library_encoder
from truegrain.session import settle

#: Lengths in a range.
RANGE = 1_024


def encoded_lengths(df: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``length`` of every row: the number of ids of its whole text."""

    def work(piece: pa.RecordBatch, encoder: LibraryEncoder):
        return {"length": pa.array(encoder.encode_texts(common.texts_of(piece, "text"))[1], pa.int64())}

    source = df.select(F.col(text_col).cast("string").alias("text"))
    return common.map_texts(source, "text", "length bigint", work, lambda: library_encoder(tokenizer))


def histogram(lengths: DataFrame, length_col: str = "length") -> DataFrame:
    """One row per length: documents of it, and sums over all at least as long.

    ``n_docs`` and ``n_tokens`` of the length itself; ``docs_from``, ``tokens_from`` of
    this and greater lengths; ``docs_total``, ``tokens_total`` of all;
    ``truncated_total``: ids that remain if every document is cut to this length.
    """
    # Settled, as it is read twice and the texts behind it must not be encoded twice.
    counted = settle(
        lengths.where(F.col(length_col).isNotNull())
        .groupBy(F.col(length_col).cast("bigint").alias("length"))
        .agg(F.count("*").alias("n_docs"))
        .withColumn("n_tokens", F.col("length") * F.col("n_docs"))
        .withColumn("range", F.floor(F.col("length") / RANGE))
    )
    ranges = counted.groupBy("range").agg(F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens"))
    later = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranges = ranges.select(
        "range",
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("docs").over(everything).alias("docs_total"),
        F.sum("tokens").over(everything).alias("tokens_total"),
    )
    inside = Window.partitionBy("range").orderBy(F.desc("length"))
    return (
        counted.join(ranges, "range")
        .withColumn("docs_from", F.col("docs_later") + F.sum("n_docs").over(inside))
        .withColumn("tokens_from", F.col("tokens_later") + F.sum("n_tokens").over(inside))
        .withColumn(
            "truncated_total", F.col("tokens_total") - F.col("tokens_from") + F.col("length") * F.col("docs_from")
        )
        .select(
            "length", "n_docs", "n_tokens", "docs_from", "tokens_from", "docs_total", "tokens_total", "truncated_total"
        )
    )


def _one_row_each(found: DataFrame, name: str, values: list, kind: str, of) -> DataFrame:
    """A row for each value with its aggregate ``of(value)``, all in one pass."""
    wanted = [F.struct(F.lit(v).cast(kind).alias(name), of(v).cast("bigint").alias("result")) for v in values]
    return found.agg(F.array(*wanted).alias("rows")).select(F.inline("rows"))


def quantiles(found: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest ``length`` that at least each ``share`` of the documents does not exceed."""
    up_to = F.col("docs_total") - F.col("docs_from") + F.col("n_docs")

    def reached(share: float):
        return F.min(F.when(up_to >= F.greatest(F.lit(1), F.ceil(F.lit(share) * F.col("docs_total"))), F.col("length")))

    return _one_row_each(found, "share", shares, "double", reached).withColumnRenamed("result", "length")


def truncated_totals(found: DataFrame, limits: list[int]) -> DataFrame:
    """Ids that remain if every document is cut to each ``limit``, also one between lengths.

    Answered from the suffix sums of the first length above the limit: what is below it
    stays whole, and every document from it on keeps ``limit`` ids.
    """

    def kept(limit: int):
        above = F.col("length") > F.lit(limit)
        whole = F.coalesce(F.max("tokens_total"), F.lit(0))
        cut = F.min(F.when(above, F.struct("length", "tokens_from", "docs_from")))
        return F.when(cut.isNull(), whole).otherwise(
            whole - cut["tokens_from"] + F.lit(limit) * cut["docs_from"]
        )

    return _one_row_each(found, "limit", limits, "bigint", kept).withColumnRenamed("result", "truncated_total")
