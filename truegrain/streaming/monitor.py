"""Continuous monitoring: the fused scalar checks on every micro-batch of a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from truegrain.operators.scalar import ScalarCheck, evaluate

BuildChecks = Callable[[DataFrame], Sequence[ScalarCheck]]


def monitor(
    stream: DataFrame,
    build_checks: BuildChecks,
    output: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Start judging a stream; results go to ``output``, one folder per micro-batch.

    A batch that is repeated after a failure replaces its own folder, so each batch
    counts once. ``every`` is the time between batches; without it the query takes
    what is there and ends.
    """

    def judge(batch: DataFrame, batch_id: int) -> None:
        evaluate(batch, build_checks(batch)).write.mode("overwrite").parquet(
            f"{output.rstrip('/')}/batch_id={batch_id}"
        )

    writer = stream.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_results(spark: SparkSession, output: str) -> DataFrame:
    """The results of all batches so far, with their ``batch_id``."""
    return spark.read.parquet(output)


def failures(results: DataFrame) -> DataFrame:
    """(test, tested_field, batches, violations): what failed, over all batches."""
    return (
        results.where(F.col("status") == "Failed")
        .groupBy("test", "tested_field")
        .agg(F.count(F.lit(1)).alias("batches"), F.sum("violations").alias("violations"))
    )
