"""Deviation from a trailing mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truegrain.errors import RuleError
from truegrain.functions.columns import as_moment, as_number, column_of, field_of
from truegrain.messages import message_for
from truegrain.operators.scalar import exact_number
from truegrain.results import Label, result_columns
from truegrain.session import settle

_VALUE, _KEY, _WHEN = "__value", "__key", "__when"


def trailing_mean(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    result_as: str,
) -> DataFrame:
    """``df`` with the mean of ``value`` over the current and ``size`` earlier rows of its key.

    One range sort deals the rows of all keys over the tasks, so a key of any size is in as
    many slices as it fills. A row needs the ``size`` rows before it, and these are in its own
    slice but for the first rows of a slice: so the last ``size`` rows of every slice are sent
    on as a halo to the slices that begin within their reach. Which those are follows from
    the number of rows of each slice, the only thing that is gathered. A slice with its halo
    then is a window of its own.
    """
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # Written out, because the slices must be the same when they are counted and when they are read.
    numbered = settle(ranged).withColumn("__seq", F.monotonically_increasing_id())
    numbered = numbered.withColumn("__slice", F.shiftrightunsigned("__seq", 33))
    if not size:
        dealt = numbered.withColumn("__to", F.col("__slice"))
    else:
        place = F.col("__seq").bitwiseAND(F.lit((1 << 33) - 1))
        # A row for each slice: no more than tasks.
        slices = numbered.groupBy("__slice").agg(F.count(F.lit(1)).alias("__rows"))
        reaches = _reaches(slices, size)
        sent = F.filter("__reaches", lambda r: r["start"] - (F.col("__start") + place) <= size)
        dealt = numbered.join(F.broadcast(reaches), "__slice").withColumn(
            "__to", F.explode(F.concat(F.array("__slice"), F.transform(sent, lambda r: r["slice"])))
        )
    own = Window.partitionBy("__to", *keys).orderBy("__seq").rowsBetween(-size, 0)
    return (
        dealt.withColumn(result_as, F.avg(value).over(own))
        .where(F.col("__to") == F.col("__slice"))
        .select(*df.columns, result_as)
    )


def _reaches(slices: DataFrame, size: int) -> DataFrame:
    """For each slice the rows before it, and the later slices that its last row reaches, with the rows before these."""
    everything = Window.orderBy("__slice")
    before = F.sum("__rows").over(everything.rowsBetween(Window.unboundedPreceding, -1))
    placed = slices.withColumn("__start", F.coalesce(before, F.lit(0).cast("bigint")))
    near = F.collect_list(F.struct(F.col("__slice").alias("slice"), F.col("__start").alias("start")))
    # Slices that begin within ``size`` rows of the begin of this one: for the slice before, those in reach.
    own = near.over(Window.orderBy("__start").rangeBetween(0, size - 1))
    reached = F.lead("__own", 1).over(everything)
    return placed.withColumn("__own", own).select(
        "__slice", "__start", F.coalesce(reached, F.filter("__own", lambda r: F.lit(False))).alias("__reaches")
    )


def deviations(
    df: DataFrame,
    column: str,
    partitioned_column: str,
    date_column: str,
    window_size: int,
    order: Sequence[str] = (),
) -> DataFrame:
    """Each row's distance from its trailing mean, in percent of the mean.

    Gives the columns named in ``order`` plus ``moving_avg`` and ``deviation``.
    ``order`` breaks ties between equal dates; without it their order is arbitrary.
    The deviation is 0 where the mean is NULL or 0, NULL where only the value is.
    """
    if isinstance(window_size, bool) or not isinstance(window_size, int) or window_size < 0:
        raise RuleError(f"window must be a whole number of rows, not {window_size!r}")
    ties = list(order)
    if {"moving_avg", "deviation"} & set(ties):
        raise RuleError("order columns must not be called 'moving_avg' or 'deviation'")
    rows = df.select(
        column_of(df, partitioned_column).alias(_KEY),
        as_moment(column_of(df, date_column), field_of(df, date_column).dataType).alias(_WHEN),
        as_number(column_of(df, column), field_of(df, column).dataType).alias(_VALUE),
        *[column_of(df, t).alias(f"__tie{i}") for i, t in enumerate(ties)],
    )
    names = [f"__tie{i}" for i in range(len(ties))]
    averaged = trailing_mean(
        rows, _VALUE, [_KEY], [_WHEN, *names], window_size, "__mean"
    )
    mean, value = F.col("__mean"), F.col(_VALUE)
    percent = F.when(
        mean.isNotNull() & (mean != 0), F.abs(value - mean) / F.abs(mean) * 100
    ).otherwise(F.lit(0.0))
    return averaged.select(
        *[F.col(n).alias(t) for n, t in zip(names, ties)],
        mean.alias("moving_avg"),
        percent.alias("deviation"),
    )


def measured_deviation(
    df: DataFrame,
    column: str,
    partitioned_column: str,
    date_column: str,
    tolerance_deviation: float,
    window_size: int,
    order: Sequence[str] = (),
) -> DataFrame:
    """``highest`` deviation and ``bad``, the rows with more than the tolerance."""
    allowed = float(exact_number(tolerance_deviation, "tolerance"))
    deviation = F.col("deviation")
    return deviations(
        df, column, partitioned_column, date_column, window_size, order
    ).agg(
        F.max(deviation).alias("highest"),
        F.count_if(deviation > F.lit(allowed)).alias("bad"),
    )


def check_moving_average(
    df: DataFrame,
    column: str,
    partitioned_column: str,
    date_column: str,
    tolerance_deviation: float,
    window_size: int,
    order: Sequence[str] = (),
    label: Label | None = None,
) -> DataFrame:
    """Fails if a deviation exceeds the tolerance; violations are the rows that do."""
    measured = measured_deviation(
        df, column, partitioned_column, date_column, tolerance_deviation, window_size, order
    )
    passed = F.col("bad") == 0
    values = {"field": column, "deviation": F.format_number("highest", 2)}
    return measured.select(
        *result_columns(
            "moving_average",
            column,
            passed,
            F.col("bad"),
            message_for("moving_average", passed, values),
            label,
        )
    )
