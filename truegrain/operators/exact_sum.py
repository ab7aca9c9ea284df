"""Exact sums of floats, whatever their size and order.

A finite double is a whole number of at most 53 bits times a power of two. Numbers whose
exponents are in the same 32 are added as whole numbers, in a decimal that holds 10^12 of
them; the at most 64 sums of a column are then put together without rounding. So the result
does not depend on how rows are dealt to tasks, and nothing cancels or is lost beside larger
numbers. All columns share one reading of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.functions.columns import as_number, column_of, field_of
from truegrain.messages import message_for
from truegrain.operators.outliers import images
from truegrain.operators.scalar import exact_number
from truegrain.results import Label, result_columns

#: Exponents that are added together.
_TOGETHER = 5
_MANTISSA = (1 << 52) - 1
#: A double is its whole number times two to the power of its exponent field less this.
_LEAST = 1075


def exact_sums(df: DataFrame, columns: Sequence[str]) -> list[Fraction | None]:
    """The sum of each column; None where there is no number, or one that is NaN or infinite."""
    numbers = [as_number(column_of(df, c), field_of(df, c).dataType).cast("double") for c in columns]
    known = [F.col(f"n{i}") for i in range(len(columns))]
    bits = images(df, numbers, keep=True)
    records = []
    for i in range(len(columns)):
        size = F.abs(F.col(f"v{i}"))
        field = F.shiftright(size, 52)
        whole = size.bitwiseAND(F.lit(_MANTISSA)) + F.when(field > 0, F.lit(_MANTISSA + 1)).otherwise(F.lit(0))
        exponent = F.greatest(field, F.lit(1)).cast("int")
        sign = F.when(F.col(f"v{i}") < 0, -1).otherwise(1)
        shift = F.call_function("shiftleft", F.lit(1).cast("bigint"), exponent.bitwiseAND(F.lit((1 << _TOGETHER) - 1)))
        addend = (whole * sign).cast("decimal(17,0)") * shift.cast("decimal(10,0)")
        record = F.struct(
            F.lit(i).alias("col"),
            F.when(size.isNull(), -1).otherwise(F.shiftright(exponent, _TOGETHER)).alias("bin"),
            addend.cast("decimal(38,0)").alias("addend"),
        )
        records.append(F.when(known[i].isNotNull(), record))
    found = bits.select(F.inline(F.array(*records))).where(F.col("col").isNotNull())
    sums: dict[int, Fraction | None] = {}
    for row in found.groupBy("col", "bin").agg(F.sum("addend").alias("total")).collect():
        if row["bin"] < 0:
            sums[row["col"]] = None  # NaN or infinity
        elif sums.get(row["col"], 0) is not None:
            power = (row["bin"] << _TOGETHER) - _LEAST
            part = Fraction(int(row["total"])) * (Fraction(2) ** power)
            sums[row["col"]] = sums.get(row["col"], Fraction(0)) + part
    return [sums.get(i) for i in range(len(columns))]


def check_exact_sum(df: DataFrame, column: str, expected, tolerance=0, label: Label | None = None) -> DataFrame:
    """The exact sum of the column, rounded once to a double, against a control value.

    It passes if both are the same double, or no further apart than the tolerance. NULL and
    text that is no number are left out; a column without a number, or with NaN or an infinity,
    has no sum and fails.
    """
    wanted, allowed = exact_number(expected, "expected"), exact_number(tolerance, "tolerance")
    total = exact_sums(df, [column])[0]
    try:
        actual = None if total is None else float(total)
    except OverflowError:
        actual = None
    passed = actual is not None and (actual == float(wanted) or abs(total - Fraction(wanted)) <= Fraction(allowed))
    values = {"field": column, "actual": F.lit(actual), "expected": expected}
    flag = F.lit(passed)
    message = message_for("validate_sum", flag, values)
    row = df.sparkSession.range(1)
    return row.select(*result_columns("validate_sum", column, flag, F.lit(int(not passed)), message, label))
