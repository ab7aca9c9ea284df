"""Checks on files: repeated files and stale files."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.errors import RuleError
from truegrain.functions.columns import moment_literal
from truegrain.messages import MISSING_FILE, message_for
from truegrain.results import FAILED, Label, fixed_results, result_columns
from truegrain.sources.readers import file_listing


def duplicate_files(files: DataFrame) -> DataFrame:
    """Files whose name and size an earlier path already has; the first is not reported.

    The first path of each name and size is an aggregate, joined back, so a name
    shared by very many files is not gathered in one task.
    """
    repeated = (
        files.groupBy("file_name", "length")
        .agg(F.min("path").alias("first_path"), F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )
    return files.join(repeated, ["file_name", "length"]).where(
        F.col("path") > F.col("first_path")
    )


def check_duplicate_files(
    spark: SparkSession, path: str, recursive: bool = True, label: Label | None = None
) -> DataFrame:
    test = "duplicated_files_by_name_and_size" if recursive else "duplicated_files_current_path"
    listed = file_listing(spark, path, recursive)
    repeated = duplicate_files(listed).select("path", F.lit(True).alias("repeats"))
    # Every repeated file is named, as the report asks for; they are few in a sound folder.
    found = listed.join(repeated, "path", "left").agg(
        F.count(F.lit(1)).alias("files"),
        F.count("repeats").alias("bad"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("repeats"), F.col("path")))), ", ").alias("paths"),
    )
    # A listing without any file says nothing, so it does not pass.
    passed = (F.col("bad") == 0) & (F.col("files") > 0)
    values = {"violations": F.col("bad"), "first": F.when(F.col("files") == 0, F.lit("no file found")).otherwise(F.col("paths"))}
    return found.select(
        *result_columns(test, path, passed, F.col("bad"), message_for(test, passed, values), label)
    )


def _hours(value) -> float:
    if isinstance(value, bool) or not isinstance(value, (int, float)) or value < 0:
        raise RuleError(f"hours must be a non-negative number, not {value!r}")
    return value


def stale_files(
    files: DataFrame, hours: float = 24, as_of: str | date | datetime | None = None
) -> DataFrame:
    """Every file with its ``is_stale`` flag; an age of exactly ``hours`` is still fresh."""
    allowed = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(_hours(hours) * 3600))
    age = moment_literal(as_of, T.TimestampType()) - F.col("modificationTime")
    return files.withColumn("is_stale", age > allowed)


def check_file_timeliness(
    spark: SparkSession,
    path: str,
    hours: float = 24,
    as_of: str | date | datetime | None = None,
    label: Label | None = None,
) -> DataFrame:
    """Fails if a file under ``path`` (a file, folder or glob) is older than ``hours``."""
    _hours(hours)
    try:
        listed = file_listing(spark, path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        label = label or Label()
        return fixed_results(
            spark,
            [
                (
                    label.tcid,
                    label.file_name,
                    "file_timeliness",
                    path,
                    FAILED,
                    1,
                    MISSING_FILE.format(path=path),
                )
            ],
        )
    found = stale_files(listed, hours, as_of).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if("is_stale").alias("bad"),
        F.max("modificationTime").alias("newest"),
        F.min("modificationTime").alias("oldest"),
    )
    passed = (F.col("bad") == 0) & (F.col("files") > 0)
    values = {
        "violations": F.col("bad"),
        "files": F.col("files"),
        "newest": F.col("newest"),
        "oldest": F.col("oldest"),
        "hours": hours,
    }
    return found.select(
        *result_columns(
            "file_timeliness",
            path,
            passed,
            F.col("bad"),
            message_for("file_timeliness", passed, values),
            label,
        )
    )
