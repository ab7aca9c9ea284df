"""Whole-table column operators: profiles, checksums, duplicate columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.errors import RuleError
from truegrain.functions.columns import canonical, column_of, field_of, ref
from truegrain.functions.fingerprints import checksum, portable_checksum, row_bound_checksum
from truegrain.messages import message_for
from truegrain.operators.scalar import AGGREGATES_PER_PASS
from truegrain.results import Label, result_columns


def per_column(df: DataFrame, columns: Sequence[str], aggregate, value_as: str) -> DataFrame:
    """(column_name, value): one aggregate for every column, all in one pass."""
    frames = []
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for start in range(0, len(columns), AGGREGATES_PER_PASS):
        part = columns[start : start + AGGREGATES_PER_PASS]
        row = df.agg(*[aggregate(canonical(ref(c), kinds[c])).alias(f"__a{i}") for i, c in enumerate(part)])
        frames.append(
            row.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(c).alias("column_name"), F.col(f"__a{i}").alias(value_as)
                            )
                            for i, c in enumerate(part)
                        ]
                    )
                )
            )
        )
    if not frames:
        raise RuleError("the table has no columns to aggregate")
    return reduce(DataFrame.unionByName, frames)


def non_null_profile(df: DataFrame) -> DataFrame:
    """(column_name, non_null): the number of values of every column."""
    return per_column(df, df.columns, F.count, "non_null")


def empty_columns(df: DataFrame) -> DataFrame:
    return non_null_profile(df).where(F.col("non_null") == 0).select("column_name")


def column_checksums(df: DataFrame, portable: bool = False) -> DataFrame:
    """(column_name, checksum) of every column; independent of the row order."""
    return per_column(
        df, df.columns, portable_checksum if portable else checksum, "checksum"
    )


def compute_column_checksum(df: DataFrame, column: str) -> DataFrame:
    value = canonical(column_of(df, column), field_of(df, column).dataType)
    return df.agg(checksum(value).alias("checksum"))


def _groups(marks: dict[str, object]) -> list[list[str]]:
    by_mark: dict[object, list[str]] = {}
    for column, mark in marks.items():
        by_mark.setdefault(mark, []).append(column)
    return [columns for columns in by_mark.values() if len(columns) > 1]


def _one_row(df: DataFrame, aggregates: dict[str, Column]) -> dict[str, object]:
    """The aggregates by name: one row reaches the driver, whatever the table's size."""
    values: dict[str, object] = {}
    items = list(aggregates.items())
    for start in range(0, len(items), AGGREGATES_PER_PASS):
        part = items[start : start + AGGREGATES_PER_PASS]
        row = df.agg(*[column.alias(f"__a{i}") for i, (_, column) in enumerate(part)]).first()
        values.update({name: row[i] for i, (name, _) in enumerate(part)})
    return values


def duplicate_column_groups(df: DataFrame, verify: bool = True) -> list[list[str]]:
    """Groups of columns with the same values, in column order.

    Without ``verify`` the order-insensitive checksum alone decides: a permuted
    column counts as a copy. With it the fingerprint also binds each value to its row, and
    every member of a group is then compared with the first member row by row.
    Each pass is one aggregation; columns are compared with one representative,
    never pairwise.
    """
    names = df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    df = df.select(*[canonical(ref(n), kinds[n]).alias(n) for n in names])
    if not verify:
        return _groups(_one_row(df, {n: checksum(ref(n)) for n in names}))
    row_hash = F.xxhash64(*[ref(n) for n in names])
    fixed = df.select(*[ref(n) for n in names], row_hash.alias("__row"))
    marks = _one_row(fixed, {n: row_bound_checksum(ref(n), F.col("__row")) for n in names})
    candidates = _groups({n: (marks[n], kinds[n].simpleString()) for n in names})
    confirmed: list[list[str]] = []
    while candidates:
        compared = {
            (group[0], other): F.count_if(~ref(group[0]).eqNullSafe(ref(other)))
            for group in candidates
            for other in group[1:]
        }
        differing = _one_row(df, compared)
        left_over = []
        for group in candidates:
            same = [o for o in group[1:] if differing[(group[0], o)] == 0]
            if same:
                confirmed.append([group[0], *same])
            rest = [o for o in group[1:] if o not in same]
            if len(rest) > 1:
                left_over.append(rest)
        candidates = left_over
    order = {n: i for i, n in enumerate(names)}
    return sorted(confirmed, key=lambda g: order[g[0]])


def find_duplicate_columns(df: DataFrame, verify: bool = True) -> DataFrame:
    """(column_name, duplicate_of): each repeated column and the first column it repeats."""
    rows = [
        (other, group[0]) for group in duplicate_column_groups(df, verify) for other in group[1:]
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, duplicate_of string")


def check_duplicate_columns(
    df: DataFrame, verify: bool = True, label: Label | None = None
) -> DataFrame:
    """Violations are columns that repeat an earlier one."""
    groups = duplicate_column_groups(df, verify)
    repeats = sum(len(g) - 1 for g in groups)
    shown = "; ".join(", ".join(g) for g in groups)
    passed = F.lit(repeats == 0)
    return df.sparkSession.range(1).select(
        *result_columns(
            "find_duplicate_columns",
            None,
            passed,
            F.lit(repeats),
            message_for("find_duplicate_columns", passed, {"groups": shown}),
            label,
        )
    )


def name_drift(df: DataFrame, column: str, original: str) -> DataFrame:
    """Rows where two columns differ; a pair with a NULL side counts as different."""
    differs = F.coalesce(column_of(df, column) != column_of(df, original), F.lit(True))
    return df.agg(F.count_if(differs).alias("violations"))
