"""Sinks: CSV, status reports, and the clean and rejected parts of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.errors import RuleError
from truegrain.functions.columns import free_name, ref

LIST_SEPARATOR = "|"
_VERDICT = "verdict"
_FAILED = "truegrain.failed_rules"


def _joined(items):
    """Items as one text; those with a separator in them are marked, so they can be told apart."""
    marked = F.transform(items.cast("array<string>"), lambda i: F.regexp_replace(i, r"([\\|])", r"\\$1"))
    return F.array_join(marked, LIST_SEPARATOR)


def write_csv(df: DataFrame, path: str, byte_order_mark: bool = False) -> None:
    """CSV with a header; arrays of text are joined by ``|``.

    Texts survive a round trip, blanks, line breaks and empty texts included, if they
    are read with ``multiline`` and ``keep_empty``. In list items ``|`` and the backslash are
    written with a backslash before. ``byte_order_mark`` marks the header of each file for
    spreadsheet programs.
    """
    flat = df.select(
        *[
            _joined(ref(f.name)).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else ref(f.name)
            for f in df.schema.fields
        ]
    )
    if byte_order_mark and flat.columns:
        first = flat.columns[0]
        flat = flat.withColumnRenamed(first, "\ufeff" + first)
    (
        flat.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_lists(df: DataFrame, *columns: str) -> DataFrame:
    """Turn list columns written by :func:`write_csv` back into arrays."""
    for column in columns:
        # A separator is a | after an even number of marks.
        parts = F.regexp_extract_all(F.concat(ref(column), F.lit("|")), F.lit(r"((?:[^\\|]|\\.)*)\|"), F.lit(1))
        df = df.withColumn(column, F.transform(parts, lambda i: F.regexp_replace(i, r"\\(.)", "$1")))
    return df


# Headings of the status report.
STATUS_HEADINGS = {
    "tcid": "Test Case ID",
    "file_name": "File",
    "test": "Test",
    "status": "Status",
    "message": "Message",
}


def write_status(results: DataFrame, path: str) -> None:
    """The status report: one line per test case, in a single small CSV file.

    A report has one row per rule, so one file holds it at any table size.
    """
    report = results.select(*[F.col(c).alias(h) for c, h in STATUS_HEADINGS.items()])
    write_csv(report.coalesce(1), path)


def marked_failed(rules: Column, name: str) -> Column:
    """A column of the rules a row failed, marked so that it is found again whatever it is called."""
    return rules.alias(name, metadata={_FAILED: True})


def failed_column(df: DataFrame) -> str:
    """The column that :func:`marked_failed` made, in a table of judged rows."""
    found = [f.name for f in df.schema.fields if f.metadata.get(_FAILED)]
    if len(found) != 1:
        raise RuleError("the table has no column of failed rules")
    return found[0]


def write_split(judged: DataFrame, path: str) -> None:
    """Store clean and rejected rows in one pass over the table.

    ``judged`` carries the array of failed rules per row, as ``row_verdicts`` gives it. The
    rows go to the subfolders ``verdict=clean`` and ``verdict=rejected`` without a shuffle.
    A table that has a column of that name keeps it: the subfolders then get another.
    """
    verdict = free_name(judged, _VERDICT)
    (
        judged.withColumn(
            verdict, F.when(F.size(ref(failed_column(judged))) == 0, "clean").otherwise("rejected")
        )
        .write.mode("overwrite")
        .partitionBy(verdict)
        .parquet(path)
    )


def _stored(spark: SparkSession, path: str, verdict: str) -> tuple[DataFrame, str]:
    stored = spark.read.parquet(path)
    # The column that names the subfolders comes last.
    name = stored.columns[-1]
    return stored.where(ref(name) == verdict).drop(name), failed_column(stored)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """The clean rows of a split table, with its columns; the rejected files are not opened."""
    rows, failed = _stored(spark, path, "clean")
    return rows.drop(failed)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The rejected rows with the rules each one failed."""
    return _stored(spark, path, "rejected")[0]
