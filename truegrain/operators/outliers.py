"""Exact quantiles of any size of table by radix selection, and the fences built from them.

Every finite number has a 64-bit image of the same order (for a double its own bits, less for
negative ones). A round counts, for all columns and ranks at once, the 16 bits after those
already known of each wanted value; the counts say which 16 bits come next. Four rounds give
the exact values. Counts add up in any order, and a round sends at most 65,536 of them for a
column and rank, so nothing grows with the table and no value is ever collected or sorted.

NaN and infinities take no part in quantiles. Beside fences, which are finite, each of them is
an outlier.
"""

from __future__ import annotations

import math
import struct
import sys
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.errors import RuleError
from truegrain.functions.columns import as_number, column_of, field_of
from truegrain.messages import message_for
from truegrain.results import Label, result_columns

_ROUNDS, _BITS = 4, 16
_SMALLEST_NORMAL = 2.0**-1022
#: Fences stay finite, so that infinities are always beyond them.
_LARGEST = sys.float_info.max
#: Columns whose counts one pass takes.
COLUMNS_PER_PASS = 50


def _number(df: DataFrame, column: str) -> Column:
    return as_number(column_of(df, column), field_of(df, column).dataType).cast("double")


def _is_finite(value: Column) -> Column:
    return F.abs(value) < F.lit(math.inf)  # NaN is greater than all


def images(df: DataFrame, numbers: Sequence[Column], keep: bool = False, beside: Sequence[str] = ()) -> DataFrame:
    """Columns ``v0``, ``v1`` ... : a bigint for each finite double that orders them as their values
    do, its bits, negated for negative ones; NULL for all else. With ``keep`` also the numbers,
    as ``n0``, ``n1`` ...; ``beside`` are columns of ``df`` to keep too, before these.

    Steps are selections of their own, as each is used several times by the next.
    """
    places = range(len(numbers))
    v, size, guess, scaled = ([F.col(f"{name}{i}") for i in places] for name in ("v", "a", "g", "s"))
    found = df.select(*beside, *[n.alias(f"v{i}") for i, n in enumerate(numbers)])
    own = [v[i].alias(f"n{i}") for i in places] if keep else []
    found = found.select(*beside, *[F.when(_is_finite(v[i]), v[i]).alias(f"v{i}") for i in places], *own)
    found = found.select("*", *[F.abs(v[i]).alias(f"a{i}") for i in places])
    exponents = [F.greatest(F.least(F.floor(F.log2(size[i])), F.lit(1023)), F.lit(-1022)).cast("int") for i in places]
    found = found.select("*", *[e.alias(f"g{i}") for i, e in enumerate(exponents)])
    found = found.select("*", *[(size[i] * F.pow(F.lit(2.0), -guess[i])).alias(f"s{i}") for i in places])

    def bits(i: int) -> Column:
        # The logarithm may be one off next to a power of two.
        over, under = scaled[i] >= 2, scaled[i] < 1
        exponent = guess[i] + F.when(over, 1).when(under, -1).otherwise(0)
        digits = F.when(over, scaled[i] / 2).when(under, scaled[i] * 2).otherwise(scaled[i])
        normal = (exponent + 1022).cast("bigint") * F.lit(2**52) + (digits * F.lit(2.0**52)).cast("bigint")
        subnormal = (size[i] * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")
        whole = F.when(size[i] < F.lit(_SMALLEST_NORMAL), subnormal).otherwise(normal)
        return whole * F.when(v[i] < 0, -1).otherwise(1)

    return found.select(*beside, *[bits(i).alias(f"v{i}") for i in places], *([f"n{i}" for i in places] if keep else []))


def value_of(bits: int) -> float:
    """The double that an image stands for."""
    found = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -found if bits < 0 else found


def _digit(bits: Column, place: int) -> Column:
    shift = 64 - _BITS * (place + 1)
    # The first digit keeps its sign.
    return F.shiftright(bits, shift) if place == 0 else F.shiftright(bits, shift).bitwiseAND(F.lit(0xFFFF))


def _single(df: DataFrame, numbers: Sequence[Column]) -> DataFrame:
    """(col, v0): the image of each finite value of any of the columns, a row for each.

    One value at a time, so that the code of an image is there once: that of many columns is
    longer than the engine's compiler takes, and runs many times slower.
    """
    single = df.select(F.posexplode(F.array(*numbers)).alias("col", "n"))
    return images(single.where(_is_finite(F.col("n"))), [F.col("n")], beside=["col"])


def _round(values: DataFrame, place: int, wanted: Mapping[int, Sequence[int]], columns: int) -> DataFrame:
    """(col, prefix, digit, n): how many values of a column have the digit behind a wanted prefix."""
    bits = F.col("v0")
    prefix = F.lit(0).cast("bigint") if place == 0 else F.shiftright(bits, 64 - _BITS * place)
    record = F.struct("col", prefix.alias("prefix"), _digit(bits, place).alias("digit"))
    if place:
        listed = [F.array(*[F.lit(int(p)) for p in wanted.get(i, ())]).cast("array<bigint>") for i in range(columns)]
        record = F.when(F.array_contains(F.get(F.array(*listed), F.col("col")), prefix), record)
    # A filter of its own would be moved below the steps of the images, and repeat them.
    found = values.select(F.inline(F.array(record))).where(F.col("col").isNotNull())
    return found.groupBy("col", "prefix", "digit").agg(F.count(F.lit(1)).alias("n"))


def _ranks(total: int, probabilities: Sequence[float]) -> list[tuple[int, int, float]]:
    """For each probability the two ranks around it, and the share of the way from one to the other."""
    places = [(total - 1) * p for p in probabilities]
    return [(math.floor(p), math.ceil(p), p - math.floor(p)) for p in places]


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> list[list[float | None]]:
    """For each column its quantiles with linear interpolation, over its finite values; None without any.

    Four readings of the table for up to 50 columns, whatever the number of ranks.
    """
    if len(columns) > COLUMNS_PER_PASS:
        middle = COLUMNS_PER_PASS
        return quantiles(df, columns[:middle], probabilities) + quantiles(df, columns[middle:], probabilities)
    numbers = [_number(df, c) for c in columns]
    values = _single(df, numbers)
    group = Window.partitionBy("col", "prefix")
    running = group.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    # Of each column: by rank its prefix so far, and how many values are below that prefix.
    known: dict[int, dict[int, tuple[int, int]]] = {}
    totals: dict[int, int] = {}
    for place in range(_ROUNDS):
        wanted = {i: sorted({p for p, _ in ranks.values()}) for i, ranks in known.items()}
        if place and not wanted:
            break
        counted = _round(values, place, wanted, len(columns)).withColumns(
            {"before": F.coalesce(F.sum("n").over(running), F.lit(0)), "total": F.sum("n").over(group)}
        )
        if place == 0:
            tests = []
            for p in probabilities:
                position = (F.col("total") - 1) * F.lit(float(p))
                tests += [F.floor(position), F.ceil(position)]
            asked = [(F.col("before") <= t) & (t < F.col("before") + F.col("n")) for t in tests]
            for row in counted.where(reduce(Column.__or__, asked)).collect():
                totals[row["col"]] = row["total"]
                for low, high, _ in _ranks(row["total"], probabilities):
                    for rank in (low, high):
                        if row["before"] <= rank < row["before"] + row["n"]:
                            known.setdefault(row["col"], {})[rank] = (row["digit"], row["before"])
            continue
        inside: dict[tuple[int, int], list[int]] = {}
        for i, ranks in known.items():
            for rank, (prefix, below) in ranks.items():
                inside.setdefault((i, prefix), []).append(rank - below)
        asked = [
            (F.col("col") == i) & (F.col("prefix") == prefix) & (F.col("before") <= r) & (r < F.col("before") + F.col("n"))
            for (i, prefix), places in inside.items()
            for r in sorted(set(places))
        ]
        picked = counted.where(reduce(Column.__or__, asked)).collect()
        for i, ranks in known.items():
            for rank, (prefix, below) in list(ranks.items()):
                row = next(
                    r
                    for r in picked
                    if (r["col"], r["prefix"]) == (i, prefix) and r["before"] <= rank - below < r["before"] + r["n"]
                )
                ranks[rank] = ((prefix << _BITS) | row["digit"], below + row["before"])
    found: list[list[float | None]] = []
    for i in range(len(columns)):
        own: list[float | None] = []
        for low, high, share in _ranks(totals[i], probabilities) if i in totals else []:
            one, two = (value_of(known[i][r][0]) for r in (low, high))
            own.append(one if share == 0 or one == two else one + (two - one) * share)
        found.append(own or [None] * len(probabilities))
    return found


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float | None]:
    """The quantiles of one column; NULL, NaN and infinities are left out."""
    return quantiles(df, [column], probabilities)[0]


def _factor(k) -> float:
    if isinstance(k, bool) or not isinstance(k, (int, float)) or not 0 <= k < math.inf:
        raise RuleError(f"k must be a non-negative number, not {k!r}")
    return k


def all_fences(df: DataFrame, columns: Sequence[str], k: Sequence[float]) -> list[tuple[float, float] | None]:
    """Lower and upper limit of each column: its ``k`` interquartile ranges beyond its quartiles."""
    factors = [_factor(f) for f in k]
    limits: list[tuple[float, float] | None] = []
    for (first, third), factor in zip(quantiles(df, columns, [0.25, 0.75]), factors):
        if first is None:
            limits.append(None)
        else:
            range_ = factor * (third - first)
            limits.append((max(first - range_, -_LARGEST), min(third + range_, _LARGEST)))
    return limits


def require_outliers(df: DataFrame, column: str, k: float = 1.5) -> None:
    """Reject a column or factor that the check cannot work with."""
    _number(df, column)
    _factor(k)


def fences(df: DataFrame, column: str, k: float = 1.5) -> tuple[float, float] | None:
    return all_fences(df, [column], [k])[0]


def evaluate_outliers(
    df: DataFrame, columns: Sequence[str], k: Sequence[float] | None = None, labels: Sequence[Label | None] | None = None
) -> DataFrame:
    """A result row for each column, from five readings of the table for all of them.

    Violations are finite values outside the fences, NaN and infinities; NULL is none. A
    column without a finite value has no fences, and a table without values passes.
    """
    k = k or [1.5] * len(columns)
    labels = labels or [None] * len(columns)
    limits = [found or (0.0, 0.0) for found in all_fences(df, columns, k)]
    counts = []
    for i, (column, (low, high)) in enumerate(zip(columns, limits)):
        value = _number(df, column)
        counts.append(F.count_if((value < F.lit(low)) | (value > F.lit(high))).alias(f"__bad{i}"))
    results = []
    for i, (column, (low, high), label) in enumerate(zip(columns, limits, labels)):
        bad = F.col(f"__bad{i}")
        values = {"field": column, "violations": bad, "lower": low, "upper": high}
        message = message_for("detect_outliers", bad == 0, values)
        results.append(F.struct(*result_columns("detect_outliers", column, bad == 0, bad, message, label)))
    return df.agg(*counts).select(F.inline(F.array(*results)))


def check_outliers(df: DataFrame, column: str, k: float = 1.5, label: Label | None = None) -> DataFrame:
    """Violations are values outside the fences; a table without values passes."""
    return evaluate_outliers(df, [column], [k], [label])
