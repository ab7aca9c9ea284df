"""The same fact in two tables: do rows that share a key agree?"""

from __future__ import annotations

from collections.abc import Hashable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.errors import RuleError
from truegrain.functions.columns import canonical, column_of, comparable, field_of
from truegrain.messages import message_for
from truegrain.operators.keyed import KeyedCheck, Side, same_type
from truegrain.operators.uniqueness import key_names
from truegrain.results import Label, result_columns

_PAIRS = "decimal(38,0)"


def _compared(df1: DataFrame, df2: DataFrame, pairs: list[tuple[str, str]]) -> list[tuple[Column, Column]]:
    """Both columns of each pair in a form in which they can be compared."""
    return [
        comparable(column_of(df1, a), field_of(df1, a).dataType, column_of(df2, b), field_of(df2, b).dataType)
        for a, b in pairs
    ]


def _both_sides(
    df1: DataFrame, df2: DataFrame, keys: list[str], column: str, column2: str
) -> tuple[DataFrame, list[str]]:
    """The rows of both tables as (keys, value, in1, in2), under common types."""
    names = [f"__k{i}" for i in range(len(keys))] + ["__value"]
    both = _compared(df1, df2, [*((k, k) for k in keys), (column, column2)])
    left = [one.alias(name) for (one, _), name in zip(both, names)]
    right = [two.alias(name) for (_, two), name in zip(both, names)]
    first = df1.select(*left, F.lit(1).alias("in1"), F.lit(0).alias("in2"))
    second = df2.select(*right, F.lit(0).alias("in1"), F.lit(1).alias("in2"))
    return first.union(second), names[:-1]


def mismatches_by_key(
    df1: DataFrame,
    df2: DataFrame,
    key: str | Sequence[str],
    column: str,
    column2: str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Per key, how many of the pairs an inner join would form disagree.

    The pairs are counted, not formed: a key with n1 and n2 rows has n1 * n2 pairs,
    of which the sum of c1(v) * c2(v) over its values agree. Both steps combine
    before they shuffle, so neither a hot key nor a hot value gathers in one task.
    A pair with a NULL side is ignored unless ``null_safe``.
    """
    keys = key_names(key)
    rows, names = _both_sides(df1, df2, keys, column, column2 or column)
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    if not null_safe:
        present = present & F.col("__value").isNotNull()
    by_value = (
        rows.where(present)
        .groupBy(*names, "__value")
        .agg(F.sum("in1").alias("c1"), F.sum("in2").alias("c2"))
    )
    # Plain numbers as long as they can be; only the products need the width of a decimal.
    c1, c2 = F.col("c1").cast("decimal(19,0)"), F.col("c2").cast("decimal(19,0)")
    agreeing = F.when((F.col("c1") > 0) & (F.col("c2") > 0), (c1 * c2).cast(_PAIRS))
    per_key = (
        by_value.groupBy(*names)
        .agg(
            F.sum("c1").alias("n1"),
            F.sum("c2").alias("n2"),
            F.coalesce(F.sum(agreeing), F.lit(0)).alias("agreeing"),
        )
        .where((F.col("n1") > 0) & (F.col("n2") > 0))
    )
    pairs = (F.col("n1").cast("decimal(19,0)") * F.col("n2").cast("decimal(19,0)")).cast(_PAIRS)
    return per_key.select(
        *[F.col(name).alias(k) for name, k in zip(names, keys)],
        (pairs - F.col("agreeing")).cast(_PAIRS).alias("mismatched_pairs"),
    ).where(F.col("mismatched_pairs") > 0)


def check_consistency(
    df1: DataFrame,
    df2: DataFrame,
    key: str | Sequence[str],
    column: str,
    column2: str | None = None,
    null_safe: bool = False,
    label: Label | None = None,
) -> DataFrame:
    """Violations are joined pairs whose values differ; keys of one table only are ignored."""
    if "mismatched_pairs" in key_names(key):
        raise RuleError("a key column must not be called 'mismatched_pairs'")
    counted = mismatches_by_key(df1, df2, key, column, column2, null_safe).agg(
        F.coalesce(F.sum("mismatched_pairs"), F.lit(0)).cast(_PAIRS).alias("pairs")
    )
    return counted.select(*_result(_shown(column, column2), F.col("pairs"), label))


def _shown(column: str, column2: str | None) -> str:
    return column if column2 in (None, column) else f"{column}, {column2}"


def _result(shown: str, pairs: Column, label: Label | None) -> list[Column]:
    passed = pairs == 0
    message = message_for("check_consistency", passed, {"field": shown, "pairs": pairs})
    return result_columns("check_consistency", shown, passed, pairs, message, label)


def keyed_consistency(
    tables: tuple[Hashable, Hashable],
    df1: DataFrame,
    df2: DataFrame,
    key: str | Sequence[str],
    column: str,
    column2: str | None = None,
    null_safe: bool = False,
) -> KeyedCheck:
    """The check as one of many over a single reading of both tables, called ``tables``."""
    keys = key_names(key)
    both = _compared(df1, df2, [*((k, k) for k in keys), (column, column2 or column)])
    typed = [same_type(df1, one, df2, two) for one, two in both]
    sides = []
    for place, (table, df) in enumerate(zip(tables, (df1, df2))):
        columns = [pair[place] for pair in typed]
        needed = columns[:-1] if null_safe else columns
        present = reduce(lambda a, b: a & b, [c.isNotNull() for c in needed])
        values = [canonical(columns[-1], typed[-1][2])]
        sides.append(Side(table, df, columns[:-1], values, present))
    return KeyedCheck(*sides, lambda m, label: _result(_shown(column, column2), m["pairs"], label))
