"""Checks that are aggregates over one table, and their fused evaluation.

Any number of these checks on a table share one scan and one aggregation: each
contributes named aggregate columns, and the single row of aggregates is turned
into one result row per check.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field as dataclass_field
from datetime import date, datetime
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.errors import RuleError
from truegrain.functions import predicates as P
from truegrain.functions.casting import try_read
from truegrain.functions.columns import FRACTIONAL, INTEGRAL, column_of, field_of, is_text, ref
from truegrain.messages import message_for
from truegrain.results import Label, result_columns
from truegrain.sources.readers import malformed_column

# Beyond this many aggregates in one stage the generated code gets too long to compile.
AGGREGATES_PER_PASS = 200


@dataclass(frozen=True)
class ScalarCheck:
    """One check: what to aggregate, and how to judge the aggregates.

    ``verdict`` receives the finished aggregates by name and returns the passed
    flag, the number of violations and further values for the message.
    """

    test: str
    field: str | None
    metrics: Mapping[str, Column]
    verdict: object
    facts: Mapping[str, object] = dataclass_field(default_factory=dict)
    bad_row: Column | None = None

    def result(self, metrics: Mapping[str, Column], label: Label | None) -> list[Column]:
        passed, violations, more = self.verdict(metrics)
        values = {"field": self.field, "violations": violations, **self.facts, **more}
        return result_columns(
            self.test, self.field, passed, violations, message_for(self.test, passed, values), label
        )


def _row_check(test: str, column: str, bad_row: Column, **facts) -> ScalarCheck:
    return ScalarCheck(
        test,
        column,
        {"bad": F.count_if(bad_row)},
        lambda m: (m["bad"] == 0, m["bad"], {}),
        facts,
        bad_row,
    )


def nulls(df: DataFrame, column: str) -> ScalarCheck:
    return _row_check("check_nulls", column, P.null_row(df, column))


def record_count(df: DataFrame, expected: int) -> ScalarCheck:
    if isinstance(expected, bool) or not isinstance(expected, int):
        raise RuleError(f"expected must be a whole number, not {expected!r}")
    return ScalarCheck(
        "count_records",
        None,
        {"actual": F.count(F.lit(1))},
        lambda m: (m["actual"] == expected, F.abs(m["actual"] - F.lit(expected)), {"actual": m["actual"]}),
        {"expected": expected},
    )


def malformed_lines(df: DataFrame) -> ScalarCheck:
    """Lines of a CSV file that did not fit its columns; for tables read with ``keep_malformed``."""
    bad_row = ref(malformed_column(df)).isNotNull()
    return ScalarCheck("check_malformed", None, {"bad": F.count_if(bad_row)}, lambda m: (m["bad"] == 0, m["bad"], {}), {}, bad_row)


def castable(df: DataFrame, column: str, expected_type: str | T.DataType) -> ScalarCheck:
    shown = expected_type if isinstance(expected_type, str) else expected_type.simpleString()
    return _row_check(
        "dtype_consistency", column, P.uncastable_row(df, column, expected_type), expected=shown
    )


def numeric_range(df: DataFrame, column: str, min_value, max_value) -> ScalarCheck:
    outside = P.out_of_range_row(df, column, min_value, max_value)
    return ScalarCheck(
        "validate_numeric_range",
        column,
        {
            "bad": F.count_if(outside.either),
            "below": F.count_if(outside.below),
            "above": F.count_if(outside.above),
        },
        lambda m: (m["bad"] == 0, m["bad"], {"below": m["below"], "above": m["above"]}),
        {"min": min_value, "max": max_value},
        outside.either,
    )


def declared_length(df: DataFrame, column: str, declared: str, strict: bool = False) -> ScalarCheck:
    return _row_check(
        "validate_values_length", column, P.wrong_length_row(df, column, declared, strict)
    )


def allowed_values(df: DataFrame, column: str, allowed: Sequence) -> ScalarCheck:
    return _row_check(
        "validate_allowed_values",
        column,
        P.disallowed_row(df, column, allowed),
        allowed=list(allowed),
    )


def date_format(
    df: DataFrame, column: str, pattern: str, ignore_nulls: bool = False
) -> ScalarCheck:
    return _row_check(
        "validate_date_format",
        column,
        P.unparsable_row(df, column, pattern, ignore_nulls),
        format=pattern,
        kind="timestamp" if P.is_timestamp_pattern(pattern) else "date",
    )


def date_range(
    df: DataFrame,
    column: str,
    duration: int,
    unit: str,
    as_of: str | date | datetime | None = None,
) -> ScalarCheck:
    outside = P.out_of_time_row(df, column, duration, unit, as_of)
    return ScalarCheck(
        "validate_date_range",
        column,
        {"late": F.count_if(outside.late), "future": F.count_if(outside.future)},
        lambda m: (
            (m["late"] == 0) & (m["future"] == 0),
            m["late"] + m["future"],
            {"late": m["late"], "future": m["future"]},
        ),
        {"duration": duration, "unit": str(unit).lower()},
        outside.either,
    )


def exact_number(value, label: str) -> Decimal:
    try:
        number = Decimal(str(value))
    except InvalidOperation:
        raise RuleError(f"{label} must be a number, not {value!r}") from None
    if isinstance(value, bool) or not number.is_finite():
        raise RuleError(f"{label} must be a finite number, not {value!r}")
    return number


def exact_addend(df: DataFrame, column: str, scale: int) -> Column:
    """The column as a decimal, so that the sum does not depend on the row order."""
    kind = field_of(df, column).dataType
    value = column_of(df, column)
    if isinstance(kind, T.DecimalType):
        return value
    if isinstance(kind, INTEGRAL):
        return value.cast("decimal(20,0)")
    if isinstance(kind, FRACTIONAL) or is_text(kind):
        return try_read(value, kind, f"decimal(38,{scale})")
    raise RuleError(f"type {kind.simpleString()} has no sum")


def control_sum(
    df: DataFrame, column: str, expected, tolerance=0, scale: int = 12
) -> ScalarCheck:
    """The sum of the column against a control value.

    The sum is exact at ``scale`` decimals, to which every float is rounded; the expected
    value is not rounded. Text that is no number is left out, as
    NULL is; NaN, infinities and floats beyond the decimal range fail the check,
    because no sum exists. A table without any number never matches.
    """
    if not isinstance(scale, int) or not 0 <= scale <= 18:
        raise RuleError(f"scale must be a whole number from 0 to 18, not {scale!r}")
    wanted, allowed = exact_number(expected, "expected"), exact_number(tolerance, "tolerance")
    addend = exact_addend(df, column, scale)
    has_no_sum = (
        column_of(df, column).isNotNull() & addend.isNull()
        if isinstance(field_of(df, column).dataType, FRACTIONAL)
        else F.lit(False)
    )

    def verdict(m):
        gap = F.abs(m["actual"] - F.lit(wanted))
        passed = F.coalesce(gap <= F.lit(allowed), F.lit(False)) & (m["unsummable"] == 0)
        return passed, F.when(passed, 0).otherwise(1), {"actual": m["actual"]}

    # A sum beyond the widest decimal is NULL, which fails the check and nothing else.

    return ScalarCheck(
        "validate_sum",
        column,
        {"actual": F.try_sum(addend), "unsummable": F.count_if(has_no_sum)},
        verdict,
        {"expected": expected},
    )


def evaluate(
    df: DataFrame, checks: Iterable[ScalarCheck], labels: Sequence[Label] | None = None
) -> DataFrame:
    """One result row per check, from one pass over ``df`` per 200 aggregates."""
    pairs = list(zip(checks, labels)) if labels is not None else [(c, None) for c in checks]
    if not pairs:
        raise RuleError("no checks to evaluate")
    total = sum(len(check.metrics) for check, _ in pairs)
    passes = math.ceil(total / AGGREGATES_PER_PASS)
    per_pass = math.ceil(len(pairs) / passes)
    frames = [
        _evaluate_pass(df, pairs[start : start + per_pass])
        for start in range(0, len(pairs), per_pass)
    ]
    return reduce(DataFrame.unionByName, frames)


def _evaluate_pass(df: DataFrame, pairs: Sequence[tuple[ScalarCheck, Label | None]]) -> DataFrame:
    aggregates, results = [], []
    for position, (check, label) in enumerate(pairs):
        names = {metric: f"__{position}_{metric}" for metric in check.metrics}
        aggregates += [column.alias(names[metric]) for metric, column in check.metrics.items()]
        finished = {metric: F.col(name) for metric, name in names.items()}
        results.append(F.struct(*check.result(finished, label)))
    return df.agg(*aggregates).select(F.inline(F.array(*results)))


def control_sums(df: DataFrame, control: DataFrame, scale: int = 12, tolerance=0) -> DataFrame:
    """Every row (column_name, expected_sum) of a control table against ``df``.

    All sums come from one pass. Names the table does not have give an Error row.
    """
    allowed = F.lit(exact_number(tolerance, "tolerance"))
    summable = [
        f.name
        for f in df.schema.fields
        if is_text(f.dataType) or isinstance(f.dataType, (*INTEGRAL, *FRACTIONAL, T.DecimalType))
    ]
    wanted = {
        row["column_name"]
        for row in control.select("column_name")
        .where(F.col("column_name").isin(summable))
        .distinct()
        .collect()
    }
    names = [n for n in summable if n in wanted]
    wide = f"decimal(38,{scale})"
    if names:
        sums = (
            df.agg(*[F.try_sum(exact_addend(df, n, scale)).try_cast(wide).alias(n) for n in names])
            .select(
                F.inline(
                    F.array(
                        *[
                            F.struct(F.lit(n).alias("column_name"), column_of(df, n).alias("actual"))
                            for n in names
                        ]
                    )
                )
            )
            .withColumn("known", F.lit(True))
        )
    else:
        sums = df.sparkSession.createDataFrame(
            [], f"column_name string, actual {wide}, known boolean"
        )
    joined = control.select(
        "column_name", F.col("expected_sum").try_cast("decimal(38,18)").alias("expected")
    ).join(sums, "column_name", "left")
    passed = F.coalesce(F.abs(F.col("actual") - F.col("expected")) <= allowed, F.lit(False))
    values = {"field": F.col("column_name"), "actual": F.col("actual"), "expected": F.col("expected")}
    return joined.select(
        F.lit(None).cast("string").alias("tcid"),
        F.lit(None).cast("string").alias("file_name"),
        F.lit("validate_sum").alias("test"),
        F.col("column_name").alias("tested_field"),
        F.when(F.col("known").isNull(), "Error")
        .when(passed, "Passed")
        .otherwise("Failed")
        .alias("status"),
        F.when(passed, 0).otherwise(1).cast("bigint").alias("violations"),
        F.when(F.col("known").isNull(), F.lit("column does not exist or has no sum"))
        .otherwise(message_for("validate_sum", passed, values))
        .alias("message"),
    )


def measure(df: DataFrame, check: ScalarCheck) -> DataFrame:
    """The bare aggregates of one check, by metric name."""
    return df.agg(*[column.alias(metric) for metric, column in check.metrics.items()])
