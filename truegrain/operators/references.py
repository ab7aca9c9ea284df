"""Foreign keys."""

from __future__ import annotations

from collections.abc import Hashable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions.columns import column_of, exact_text, field_of, is_text, mixed_numbers
from truegrain.messages import message_for
from truegrain.operators.keyed import KeyedCheck, Side, same_type
from truegrain.results import Label, result_columns


def _key_columns(
    df_fk: DataFrame, column_fk: str, df_ref: DataFrame, ref_column: str
) -> tuple[Column, Column]:
    """Both keys in one type.

    Text against another type is compared as text; whole numbers and floats are too, in
    a form that is exact.
    """
    fk, ref = column_of(df_fk, column_fk), column_of(df_ref, ref_column)
    fk_kind, ref_kind = field_of(df_fk, column_fk).dataType, field_of(df_ref, ref_column).dataType
    if mixed_numbers(fk_kind, ref_kind):
        return exact_text(fk, fk_kind), exact_text(ref, ref_kind)
    if is_text(fk_kind) != is_text(ref_kind):
        return fk.cast("string"), ref.cast("string")
    return fk, ref


def orphan_values(
    df_fk: DataFrame, column_fk: str, df_ref: DataFrame, ref_column: str
) -> DataFrame:
    """Each foreign key value the reference lacks, with its number of rows.

    One aggregation over both columns together replaces the join: partial counts
    shrink a hot foreign key to one row per task, repeated reference values too, and
    a small reference means few distinct values to shuffle. NULL foreign keys do not
    count, NULL reference values are ignored.
    """
    fk, ref = _key_columns(df_fk, column_fk, df_ref, ref_column)
    used = df_fk.select(fk.alias("value"), F.lit(1).alias("n"), F.lit(False).alias("known"))
    listed = df_ref.select(ref.alias("value"), F.lit(0).alias("n"), F.lit(True).alias("known"))
    return (
        used.union(listed)
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.sum("n").alias("n"), F.bool_or("known").alias("known"))
        .where(~F.col("known"))
        .select(F.col("value").alias(column_fk), F.col("n").alias("row_count"))
    )


def orphan_rows(
    df_fk: DataFrame, column_fk: str, df_ref: DataFrame, ref_column: str
) -> DataFrame:
    """The rows of ``df_fk`` whose foreign key the reference lacks.

    A plain anti join: a reference known to be small is broadcast by the optimizer,
    and in a sort-merge join the adaptive skew split divides a hot foreign key.
    """
    fk, ref = _key_columns(df_fk, column_fk, df_ref, ref_column)
    listed = df_ref.select(ref.alias("__ref")).where(F.col("__ref").isNotNull())
    keyed = df_fk.withColumn("__fk", fk).where(F.col("__fk").isNotNull())
    return keyed.join(listed, F.col("__fk") == F.col("__ref"), "left_anti").drop("__fk")


def _keyed(tables: tuple[Hashable, Hashable], df: DataFrame, column: str, df_ref: DataFrame, ref_column: str, finish):
    fk, ref = _key_columns(df, column, df_ref, ref_column)
    fk, ref, _ = same_type(df, fk, df_ref, ref)
    return KeyedCheck(
        Side(tables[0], df, [fk], present=fk.isNotNull()),
        Side(tables[1], df_ref, [ref], present=ref.isNotNull()),
        finish,
    )


def keyed_foreign_key(
    tables: tuple[Hashable, Hashable], df_fk: DataFrame, column_fk: str, df_ref: DataFrame, ref_column: str
) -> KeyedCheck:
    """The check as one of many over a single reading of both tables, called ``tables``."""
    return _keyed(
        tables, df_fk, column_fk, df_ref, ref_column, lambda m, label: _foreign_key_result(column_fk, m["orphans"], label)
    )


def keyed_allowed_in_table(
    tables: tuple[Hashable, Hashable], df: DataFrame, column: str, df_ref: DataFrame, ref_column: str
) -> KeyedCheck:
    """The check as one of many over a single reading of both tables, called ``tables``."""
    return _keyed(
        tables, df, column, df_ref, ref_column, lambda m, label: _allowed_result(column, ref_column, m["orphans"], label)
    )


def _foreign_key_result(column: str, bad: Column, label: Label | None) -> list[Column]:
    passed = bad == 0
    message = message_for("check_foreign_key", passed, {"field": column, "violations": bad})
    return result_columns("check_foreign_key", column, passed, bad, message, label)


def _allowed_result(column: str, ref_column: str, bad: Column, label: Label | None) -> list[Column]:
    passed = bad == 0
    values = {"field": column, "violations": bad, "allowed": f"the values of {ref_column}"}
    message = message_for("validate_allowed_values", passed, values)
    return result_columns("validate_allowed_values", column, passed, bad, message, label)


def _orphan_count(df: DataFrame, column: str, df_ref: DataFrame, ref_column: str) -> DataFrame:
    return orphan_values(df, column, df_ref, ref_column).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("bad")
    )


def check_foreign_key(
    df_fk: DataFrame,
    column_fk: str,
    df_ref: DataFrame,
    ref_column: str,
    label: Label | None = None,
) -> DataFrame:
    """Violations are rows whose foreign key is not among the reference values."""
    counted = _orphan_count(df_fk, column_fk, df_ref, ref_column)
    return counted.select(*_foreign_key_result(column_fk, F.col("bad"), label))


def check_allowed_in_table(
    df: DataFrame,
    column: str,
    df_ref: DataFrame,
    ref_column: str,
    label: Label | None = None,
) -> DataFrame:
    """Violations are rows whose value a reference table does not list; for lists too long to write down."""
    counted = _orphan_count(df, column, df_ref, ref_column)
    return counted.select(*_allowed_result(column, ref_column, F.col("bad"), label))
