"""Row predicates: true exactly on the rows a check counts as violations.

Every predicate is two-valued (never NULL), so its negation selects the good
rows. How NULL is treated is part of each definition, because it differs from
check to check.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal, InvalidOperation
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.errors import RuleError
from truegrain.functions.casting import try_parse, try_read
from truegrain.functions.columns import (
    FRACTIONAL,
    INTEGRAL,
    TEMPORAL,
    as_moment,
    as_number,
    column_of,
    field_of,
    is_text,
    moment_literal,
)
from truegrain.functions.declared import parse_declared

INTERVAL_UNITS = ("SECOND", "MINUTE", "HOUR", "DAY", "WEEK", "MONTH", "YEAR")


def _certain(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def null_row(df: DataFrame, column: str) -> Column:
    """NULL counts; the empty text and NaN do not."""
    return column_of(df, column).isNull()


def uncastable_row(df: DataFrame, column: str, expected_type: str | T.DataType) -> Column:
    """A value that cannot be read as ``expected_type``; NULL does not count."""
    value = column_of(df, column)
    kind = field_of(df, column).dataType
    return value.isNotNull() & try_read(value, kind, expected_type).isNull()


class OutOfRange(NamedTuple):
    below: Column
    above: Column

    @property
    def either(self) -> Column:
        return self.below | self.above


def _bound(value, label: str):
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        raise RuleError(f"{label} must be a number, not {value!r}")
    return F.lit(value)


def out_of_range_row(df: DataFrame, column: str, min_value, max_value) -> OutOfRange:
    """A number outside the closed range; NaN is above every bound, NULL never counts."""
    value = as_number(column_of(df, column), field_of(df, column).dataType)
    return OutOfRange(
        _certain(value < _bound(min_value, "min")), _certain(value > _bound(max_value, "max"))
    )


def wrong_length_row(df: DataFrame, column: str, declared: str, strict: bool = False) -> Column:
    """A value that does not fit the declared type.

    CHAR(n): more than n characters; NULL does not count.
    DECIMAL(p,s): the text form is longer than p (sign and point included), or the
    number does not fit; NULL counts. ``strict`` tests the digits instead: the value
    must be representable as DECIMAL(p,s) without rounding.
    SMALLINT, INTEGER: the value cannot be read as a 32-bit integer; NULL counts.
    ``strict`` uses the 16-bit range for SMALLINT.
    """
    wanted = parse_declared(declared)
    value, kind = column_of(df, column), field_of(df, column).dataType
    if wanted.kind == "CHAR":
        return _certain(F.length(value.cast("string")) > wanted.size)
    if wanted.kind == "DECIMAL":
        target = f"decimal({wanted.size},{wanted.scale})"
        if strict:
            fitted = try_read(value, kind, target)
            wide = "decimal(38,18)"
            rounded = fitted.try_cast(wide) != try_read(value, kind, wide)
            return fitted.isNull() | _certain(rounded)
        too_long = _certain(F.length(value.cast("string")) > wanted.size)
        whole = T.DecimalType(10, 0)
        return too_long | try_read(try_read(value, kind, whole), whole, target).isNull()
    width = "smallint" if strict and wanted.kind == "SMALLINT" else "int"
    return try_read(value, kind, width).isNull()


def _as_kind(entry, kind: T.DataType):
    """A listed number as a value of the column's type, or None if no value of it is equal."""
    try:
        number = Decimal(str(entry).strip())
    except InvalidOperation:
        return None
    if isinstance(kind, FRACTIONAL):
        return float(number)
    if not number.is_finite():
        return None
    if isinstance(kind, INTEGRAL):
        whole = int(number)
        return whole if whole == number and -(2**63) <= whole < 2**63 else None
    return number


def disallowed_row(df: DataFrame, column: str, allowed: Sequence) -> Column:
    """A value missing from the list; neither NULL values nor NULL entries count."""
    kind = field_of(df, column).dataType
    value = column_of(df, column)
    entries = [a for a in allowed if a is not None]
    if is_text(kind):
        literals = [F.lit(str(a)) for a in entries]
    elif isinstance(kind, T.NumericType):
        literals = [F.lit(n) for a in entries if (n := _as_kind(a, kind)) is not None]
    else:
        literals = [F.lit(a).try_cast(kind) if isinstance(a, str) else F.lit(a) for a in entries]
    if not literals:
        return value.isNotNull()
    return value.isNotNull() & ~_certain(value.isin(*literals))


def is_timestamp_pattern(pattern: str) -> bool:
    """Patterns with a 24-hour or minute part are parsed as timestamps, others as dates."""
    return "HH" in pattern or "mm" in pattern


def unparsable_row(df: DataFrame, column: str, pattern: str, ignore_nulls: bool = False) -> Column:
    """Text that does not follow the pattern; NULL counts unless ``ignore_nulls``."""
    kind = field_of(df, column).dataType
    if not (is_text(kind) or isinstance(kind, TEMPORAL)):
        raise RuleError(f"type {kind.simpleString()} has no date format")
    value = column_of(df, column)
    bad = try_parse(value, kind, pattern, is_timestamp_pattern(pattern)).isNull()
    return value.isNotNull() & bad if ignore_nulls else bad


class OutOfTime(NamedTuple):
    late: Column
    future: Column

    @property
    def either(self) -> Column:
        return self.late | self.future


def interval(duration: int, unit: str) -> Column:
    singular = str(unit).strip().upper().removesuffix("S")
    if singular not in INTERVAL_UNITS:
        raise RuleError(f"unknown time unit '{unit}'")
    if isinstance(duration, bool) or not isinstance(duration, int):
        raise RuleError(f"duration must be a whole number, not {duration!r}")
    return F.expr(f"INTERVAL {duration} {singular}")


def out_of_time_row(
    df: DataFrame,
    column: str,
    duration: int,
    unit: str,
    as_of: str | date | datetime | None = None,
) -> OutOfTime:
    """A moment before ``as_of`` minus the duration, or after ``as_of``; NULL never counts."""
    kind = field_of(df, column).dataType
    value = as_moment(column_of(df, column), kind)
    now = moment_literal(as_of, kind)
    return OutOfTime(_certain(value < now - interval(duration, unit)), _certain(value > now))
