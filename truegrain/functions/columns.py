"""Resolving column names and types of the table under test."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.errors import RuleError
from truegrain.functions.casting import try_read

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType)
TEXT = (T.StringType, T.CharType, T.VarcharType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def quoted(name: str) -> str:
    """``name`` in backticks, so blanks, dots and hyphens are part of the name."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str, side: str | None = None) -> Column:
    return F.col(f"{side}.{quoted(name)}" if side else quoted(name))


def _named(fields: list[T.StructField], name: str, df: DataFrame) -> list[T.StructField]:
    """The fields called ``name``: an exact match first, then ignoring case."""
    found = [f for f in fields if f.name == name]
    if not found and df.sparkSession.conf.get("spark.sql.caseSensitive") != "true":
        found = [f for f in fields if f.name.lower() == name.lower()]
    return found


def _path_of(df: DataFrame, name: str) -> list[T.StructField]:
    """The fields from the column down to the one called ``name``.

    A column of that name comes first; else dots lead into structs.
    """
    if not isinstance(name, str) or not name:
        raise RuleError("a column name is required")
    found = _named(df.schema.fields, name, df)
    path = [found] if found else []
    if not found and "." in name:
        fields = df.schema.fields
        for part in name.split("."):
            found = _named(fields, part, df)
            path.append(found)
            if len(found) != 1:
                break
            fields = found[0].dataType.fields if isinstance(found[0].dataType, T.StructType) else []
    if not path or any(len(step) != 1 for step in path):
        problem = "is ambiguous" if any(len(step) > 1 for step in path) else "does not exist"
        raise RuleError(f"column '{name}' {problem}")
    return [step[0] for step in path]


def field_of(df: DataFrame, name: str) -> T.StructField:
    """The field called ``name``, which may be inside a struct."""
    return _path_of(df, name)[-1]


def column_of(df: DataFrame, name: str) -> Column:
    return F.col(".".join(quoted(f.name) for f in _path_of(df, name)))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores behind it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def canonical(column: Column, kind: T.DataType) -> Column:
    """The value with every map in it as its entries in order, so it can be hashed and compared."""
    if isinstance(kind, T.MapType):
        entries = F.map_entries(column)
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        if has_map(kind.valueType):
            entries = F.transform(entries, lambda e: canonical(e, entry))
        return F.array_sort(entries)
    if not has_map(kind):
        return column
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda e: canonical(e, kind.elementType))
    fields = [canonical(column.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(column.isNotNull(), F.struct(*fields))


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def is_text(kind: T.DataType) -> bool:
    return isinstance(kind, TEXT)


def type_class(kind: T.DataType) -> str:
    """numeric, string, temporal or other."""
    if isinstance(kind, T.NumericType):
        return "numeric"
    if is_text(kind):
        return "string"
    return "temporal" if isinstance(kind, TEMPORAL) else "other"


def as_number(column: Column, kind: T.DataType) -> Column:
    """Numbers stay as they are; text that is no number becomes NULL, not an error."""
    if isinstance(kind, T.NumericType):
        return column
    if is_text(kind) or isinstance(kind, T.BooleanType):
        return try_read(column, kind, "double")
    raise RuleError(f"type {kind.simpleString()} is not numeric")


def as_moment(column: Column, kind: T.DataType) -> Column:
    """Dates and timestamps stay; text that is no timestamp becomes NULL."""
    if isinstance(kind, TEMPORAL):
        return column
    if is_text(kind):
        return column.try_cast("timestamp")
    raise RuleError(f"type {kind.simpleString()} is not a date or timestamp")


def moment_literal(as_of: str | date | datetime | None, kind: T.DataType) -> Column:
    """``as_of`` (default: now) in the clock of a column of type ``kind``.

    Timestamps without a zone are compared in local time, the others as instants.
    """
    target = "timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp"
    if as_of is None:
        return F.current_timestamp().cast(target)
    if isinstance(as_of, str):
        try:
            as_of = datetime.fromisoformat(as_of)
        except ValueError:
            raise RuleError(f"'{as_of}' is not an ISO date or timestamp") from None
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        return F.lit(as_of.isoformat()).cast("timestamp").cast(target)
    return F.lit(as_of.isoformat()).cast(target)


def comparable(left: Column, left_kind: T.DataType, right: Column, right_kind: T.DataType) -> tuple[Column, Column]:
    """Both columns in a type they can be compared in.

    Text against another type is read as that type, and text that cannot be read
    is NULL. Whole numbers and floats are compared exactly, by their decimal text, as
    a float has no room for every whole number. Other pairs widen as the engine does.
    """
    if is_text(left_kind) and not is_text(right_kind):
        return try_read(left, left_kind, right_kind), right
    if is_text(right_kind) and not is_text(left_kind):
        return left, try_read(right, right_kind, left_kind)
    if mixed_numbers(left_kind, right_kind):
        return exact_text(left, left_kind), exact_text(right, right_kind)
    return left, right


def mixed_numbers(left: T.DataType, right: T.DataType) -> bool:
    """Whether one type is of whole numbers and the other of floats."""
    return (isinstance(left, INTEGRAL) and isinstance(right, FRACTIONAL)) or (
        isinstance(left, FRACTIONAL) and isinstance(right, INTEGRAL)
    )


def exact_text(column: Column, kind: T.DataType) -> Column:
    """A number as text: whole ones as digits, whatever their type."""
    if isinstance(kind, INTEGRAL):
        return column.cast("string")
    value = column.cast("double")
    # Beyond these no bigint is near; NaN is greater than all.
    whole = (F.abs(value) <= F.lit(2.0**63)) & (value == F.rint(value))
    return F.when(whole, value.try_cast("decimal(20,0)").cast("string")).otherwise(value.cast("string"))
