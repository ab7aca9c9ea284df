"""The one result record every check produces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASSED = "Passed"
FAILED = "Failed"
ERROR = "Error"
SKIPPED = "Skipped"

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("tcid", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("test", T.StringType()),
        T.StructField("tested_field", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("violations", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)

_LARGEST = 2**63 - 1


class Label:
    """Which test case of which file a check belongs to; both unknown by default."""

    __slots__ = ("tcid", "file_name")

    def __init__(self, tcid: str | None = None, file_name: str | None = None):
        self.tcid = tcid
        self.file_name = file_name


def result_columns(
    test: str,
    field: str | None,
    passed: Column,
    violations: Column,
    message: Column,
    label: Label | None = None,
) -> list[Column]:
    label = label or Label()
    return [
        F.lit(label.tcid).cast("string").alias("tcid"),
        F.lit(label.file_name).cast("string").alias("file_name"),
        F.lit(test).alias("test"),
        F.lit(field).cast("string").alias("tested_field"),
        F.when(passed, PASSED).otherwise(FAILED).alias("status"),
        bounded_count(violations).alias("violations"),
        message.alias("message"),
    ]


def bounded_count(count: Column) -> Column:
    """A count as bigint. One too large for it (pairs of a join) is NULL; the message has it in full."""
    return F.when(count <= F.lit(_LARGEST), count.cast("bigint"))


def fixed_results(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Results known without running anything: errors and skipped rules."""
    return spark.createDataFrame(rows, RESULT_SCHEMA)
