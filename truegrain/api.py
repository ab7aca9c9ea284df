"""One call per check: each gives a result row, lazily.

The names and argument orders are those a rule table uses. To run many checks on a
table in one pass, pass the builders of ``truegrain.operators.scalar`` to
``evaluate`` or write rules and use ``run_suite``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from truegrain.operators import scalar
from truegrain.operators.columns import compute_column_checksum, find_duplicate_columns
from truegrain.operators.consistency import check_consistency
from truegrain.operators.files import check_duplicate_files, check_file_timeliness
from truegrain.operators.outliers import check_outliers as detect_outliers
from truegrain.operators.references import check_foreign_key
from truegrain.operators.trend import check_moving_average as moving_average
from truegrain.operators.uniqueness import check_duplicates

__all__ = [
    "check_consistency",
    "check_duplicates",
    "check_foreign_key",
    "check_nulls",
    "compute_column_checksum",
    "count_records",
    "detect_outliers",
    "dtype_consistency",
    "duplicated_files_by_name_and_size",
    "duplicated_files_current_path",
    "file_timeliness",
    "find_duplicate_columns",
    "moving_average",
    "validate_allowed_values",
    "validate_date_format",
    "validate_date_range",
    "validate_numeric_range",
    "validate_sum",
    "validate_values_length",
]


def check_nulls(df: DataFrame, column_name: str) -> DataFrame:
    return scalar.evaluate(df, [scalar.nulls(df, column_name)])


def count_records(df: DataFrame, expected_records_num: int) -> DataFrame:
    return scalar.evaluate(df, [scalar.record_count(df, expected_records_num)])


def dtype_consistency(
    df: DataFrame, column_name: str, expected_type: str | T.DataType
) -> DataFrame:
    return scalar.evaluate(df, [scalar.castable(df, column_name, expected_type)])


def validate_numeric_range(df: DataFrame, column: str, min_value, max_value) -> DataFrame:
    return scalar.evaluate(df, [scalar.numeric_range(df, column, min_value, max_value)])


def validate_values_length(
    df: DataFrame, column_name: str, data_type: str, strict: bool = False
) -> DataFrame:
    return scalar.evaluate(df, [scalar.declared_length(df, column_name, data_type, strict)])


def validate_allowed_values(
    df: DataFrame, column_name: str, allowed_values: Sequence
) -> DataFrame:
    return scalar.evaluate(df, [scalar.allowed_values(df, column_name, allowed_values)])


def validate_date_format(
    df: DataFrame, column: str, expected_format: str, ignore_nulls: bool = False
) -> DataFrame:
    return scalar.evaluate(df, [scalar.date_format(df, column, expected_format, ignore_nulls)])


def validate_date_range(
    df: DataFrame,
    column: str,
    duration: int,
    time_unit: str,
    as_of: str | date | datetime | None = None,
) -> DataFrame:
    return scalar.evaluate(df, [scalar.date_range(df, column, duration, time_unit, as_of)])


def validate_sum(
    df: DataFrame, column: str, expected_sum, tolerance=0, scale: int = 12
) -> DataFrame:
    return scalar.evaluate(df, [scalar.control_sum(df, column, expected_sum, tolerance, scale)])


def file_timeliness(
    spark: SparkSession,
    file_path: str,
    hours_threshold: float = 24,
    as_of: str | date | datetime | None = None,
) -> DataFrame:
    return check_file_timeliness(spark, file_path, hours_threshold, as_of)


def duplicated_files_by_name_and_size(spark: SparkSession, path: str) -> DataFrame:
    return check_duplicate_files(spark, path, recursive=True)


def duplicated_files_current_path(spark: SparkSession, path: str) -> DataFrame:
    return check_duplicate_files(spark, path, recursive=False)
