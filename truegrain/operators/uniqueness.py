"""Duplicate keys."""

from __future__ import annotations

from collections.abc import Hashable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.errors import RuleError
from truegrain.functions.columns import canonical, column_of, field_of, ref
from truegrain.messages import message_for
from truegrain.operators.keyed import KeyedCheck, Side
from truegrain.results import Label, result_columns


def key_names(keys: str | Sequence[str]) -> list[str]:
    names = [keys] if isinstance(keys, str) else list(keys)
    if not names:
        raise RuleError("at least one key column is required")
    return names


# Types of a fixed, small width; keys of any other type are first searched by digest.
_NARROW = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def duplicate_groups(
    df: DataFrame, keys: str | Sequence[str], count_as: str = "copies"
) -> DataFrame:
    """Each key that occurs more than once, with its number of rows.

    NULL keys form a group of their own. Counting starts before the shuffle, so a
    hot key sends one partial count per task, not its rows. Of wide keys, such as whole
    texts, two 64-bit digests are counted first, and a table of bits, of bounded size and
    broadcast, says which digests repeat: only these rows are then grouped by the keys
    themselves, so next to no text that occurs once leaves its task.
    """
    names = key_names(keys)
    if count_as in names:
        raise RuleError(f"'{count_as}' is a key column; choose another name for the count")
    rows = df.select(*[column_of(df, n).alias(n) for n in names])
    if not all(isinstance(f.dataType, _NARROW) for f in rows.schema.fields):
        rows = _rows_that_may_repeat(rows, names)
    return (
        rows.groupBy(*[ref(n) for n in names])
        .agg(F.count(F.lit(1)).alias(count_as))
        .where(ref(count_as) > 1)
    )


#: Bits of that table: at most a 64th of them are rows, about 4 MB.
_TABLE_BITS = 1 << 24


def _rows_that_may_repeat(rows: DataFrame, names: list[str]) -> DataFrame:
    """All rows whose digest another row has too, and others as far as bits of their digests fall together."""
    values = [canonical(ref(n), rows.schema[n].dataType) for n in names]
    one, two = F.xxhash64(*values), F.xxhash64(F.lit(1), *values[::-1], F.lit(2))
    repeated = rows.groupBy(one.alias("one"), two.alias("two")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")

    def place(first: Column, second: Column) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(first, second), F.lit(_TABLE_BITS))
        return F.floor(at / 64), F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))

    word, bit = place(F.col("one"), F.col("two"))
    bits = repeated.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    word, bit = place(one, two)
    met = rows.withColumns({"__at": word, "__bit": bit}).join(F.broadcast(bits), F.col("__at") == F.col("__word"))
    return met.where(F.col("__bits").bitwiseAND(F.col("__bit")) != 0).select(*[ref(n) for n in names])


def keyed_duplicates(table: Hashable, df: DataFrame, keys: str | Sequence[str]) -> KeyedCheck:
    """The check as one of many over a single reading of its table."""
    names = key_names(keys)
    values = [canonical(column_of(df, n), field_of(df, n).dataType) for n in names]
    shown = ", ".join(names)
    return KeyedCheck(Side(table, df, values), None, lambda found, label: _result(shown, found, label))


def check_duplicates(
    df: DataFrame, keys: str | Sequence[str], label: Label | None = None
) -> DataFrame:
    """Violations are key groups with more than one row; surplus rows go to the message."""
    names = key_names(keys)
    found = duplicate_groups(
        df.select(*[column_of(df, n).alias(f"__k{i}") for i, n in enumerate(names)]),
        [f"__k{i}" for i in range(len(names))],
    ).agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus"),
    )
    counted = {n: F.col(n) for n in ("groups", "surplus")}
    return found.select(*_result(", ".join(names), counted, label))


def _result(shown: str, found: Mapping[str, Column], label: Label | None) -> list[Column]:
    passed = found["groups"] == 0
    values = {"field": shown, "violations": found["groups"], "surplus": found["surplus"]}
    message = message_for("check_duplicates", passed, values)
    return result_columns("check_duplicates", shown, passed, found["groups"], message, label)
