"""Reading values as another type, NULL where that is impossible.

The engine's own ``try_cast`` gives the same results, but a value it cannot read
costs about a hundred times a readable one, and tables under test may be full of
them. A cheap test in front turns most such values away. The tests only ever reject
what the cast would reject too; whatever they let through is still cast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLANK = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
# Decimals may be written in the digits of any script.
_NUMBER = rf"\p{{Nd}}|^{_BLANK}[+-]?(?i:inf|nan)"
_FLAG = rf"^{_BLANK}(?i:t|true|y|yes|1|f|false|n|no|0){_BLANK}$"

_WIDTHS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def try_read(value: Column, kind: T.DataType, target: str | T.DataType) -> Column:
    """``value`` of type ``kind`` as ``target``, or NULL."""
    wanted = T.DataType.fromDDL(target) if isinstance(target, str) else target
    possible = _possible(value, kind, wanted)
    read = value.try_cast(wanted)
    return read if possible is None else F.when(possible, read)


def _possible(value: Column, kind: T.DataType, wanted: T.DataType) -> Column | None:
    if isinstance(kind, T.StringType):
        if type(wanted) in _WIDTHS:
            return value.rlike(_WHOLE)
        if isinstance(wanted, (T.FloatType, T.DoubleType, T.DecimalType)):
            return value.rlike(_NUMBER)
        if isinstance(wanted, T.BooleanType):
            return value.rlike(_FLAG)
        return None
    if not isinstance(kind, T.NumericType) or type(kind) is type(wanted) in _WIDTHS:
        return None
    # Both bounds lie just outside what fits, and comparing in double keeps their order.
    if isinstance(wanted, T.DecimalType):
        return F.abs(value.cast("double")) <= F.lit(float(10 ** (wanted.precision - wanted.scale)))
    if type(wanted) in _WIDTHS:
        return F.abs(value.cast("double")) <= F.lit(float(2 ** (_WIDTHS[type(wanted)] - 1) + 1))
    return None


_PARTS = {
    "yyyy": "[+-]?[0-9]{4,10}",
    "MM": "[0-9]{2}",
    "dd": "[0-9]{2}",
    "HH": "[0-9]{2}",
    "mm": "[0-9]{2}",
    "ss": "[0-9]{2}",
}


def text_shape(pattern: str) -> str | None:
    """What every text of a plain numeric date pattern looks like; None for other patterns."""
    pieces = re.findall(r"([A-Za-z])(\1*)|([-/.:, ]+)|(.)", pattern)
    shape = ""
    for first, more, separators, unknown in pieces:
        if unknown or (first and first + more not in _PARTS):
            return None
        shape += _PARTS[first + more] if first else re.escape(separators)
    return f"^{shape}$"


def try_parse(value: Column, kind: T.DataType, pattern: str, timestamp: bool) -> Column:
    """Text of a date pattern as a timestamp or date, or NULL."""
    parsed = (
        F.try_to_timestamp(value, F.lit(pattern)) if timestamp else F.try_to_date(value, pattern)
    )
    shape = text_shape(pattern) if isinstance(kind, T.StringType) else None
    return parsed if shape is None else F.when(value.rlike(shape), parsed)
