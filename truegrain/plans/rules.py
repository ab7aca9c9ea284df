"""The tests a rule can name, their parameters, and how a rule becomes a check."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.errors import RuleError
from truegrain.functions.casting import try_parse
from truegrain.functions.predicates import is_timestamp_pattern
from truegrain.operators import columns, consistency, exact_sum, files, keyed, outliers, references, scalar, trend, uniqueness
from truegrain.results import Label


@dataclass(frozen=True)
class Rule:
    tcid: str
    file_name: str
    critical: bool
    test: str
    tested_field: str | None
    expected_value: str | None

    @property
    def label(self) -> Label:
        return Label(self.tcid, self.file_name)


@dataclass(frozen=True)
class Context:
    """What a rule may refer to besides its own table."""

    spark: SparkSession
    table: Callable[[str], DataFrame]


Params = Mapping[str, object]


@dataclass(frozen=True)
class Test:
    """A test: its dimension, its parameters, and its builder.

    ``scalar`` builds a check that shares the aggregation of its table; ``frame``
    builds a result row from a plan of its own. A single required parameter may be
    given bare, without the enclosing JSON object. ``instead`` are parameters that may
    take the place of the required ones; the rule then is a frame. ``keyed`` builds a
    check that shares one reading of each table with all others of its kind; ``frame``
    then is the plan of its own for digests that clash. ``together`` gives the results of
    all rules of the test on a table, each of which ``require`` has accepted.
    """

    dimension: str
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    needs_field: bool = True
    needs_table: bool = True
    instead: tuple[str, ...] = ()
    scalar: Callable[[DataFrame, str, Params], scalar.ScalarCheck] | None = None
    frame: Callable[[Context, DataFrame | None, Rule, Params], DataFrame] | None = None
    keyed: Callable[[Context, DataFrame, Rule, Params], keyed.KeyedCheck] | None = None
    require: Callable[[DataFrame, Rule, Params], None] | None = None
    together: Callable[[DataFrame, Sequence[Rule], Sequence[Params]], DataFrame] | None = None


def _some(params: Params, **names: str) -> dict[str, object]:
    """The given optional parameters, under the argument names of a function."""
    return {argument: params[name] for argument, name in names.items() if name in params}


def _list(value) -> list:
    return list(value) if isinstance(value, (list, tuple)) else [value]


def _text_list(value, label: str) -> list:
    if not isinstance(value, (list, tuple)):
        raise RuleError(f"{label} must be a list, not {value!r}")
    return list(value)


def _consistency(context: Context, df: DataFrame, rule: Rule, p: Params) -> DataFrame:
    return consistency.check_consistency(
        df,
        context.table(p["other_table"]),
        _list(p["key"]),
        rule.tested_field,
        **_some(p, column2="column2", null_safe="null_safe"),
        label=rule.label,
    )


def _keyed_consistency(context: Context, df: DataFrame, rule: Rule, p: Params) -> keyed.KeyedCheck:
    return consistency.keyed_consistency(
        (rule.file_name, p["other_table"]),
        df,
        context.table(p["other_table"]),
        _list(p["key"]),
        rule.tested_field,
        **_some(p, column2="column2", null_safe="null_safe"),
    )


def _keyed_reference(build):
    def made(context: Context, df: DataFrame, rule: Rule, p: Params) -> keyed.KeyedCheck:
        tables = (rule.file_name, p["ref_table"])
        return build(tables, df, rule.tested_field, context.table(p["ref_table"]), p["ref_column"])

    return made


def _foreign_key(context: Context, df: DataFrame, rule: Rule, p: Params) -> DataFrame:
    return references.check_foreign_key(
        df, rule.tested_field, context.table(p["ref_table"]), p["ref_column"], rule.label
    )


def _allowed_in_table(context: Context, df: DataFrame, rule: Rule, p: Params) -> DataFrame:
    return references.check_allowed_in_table(
        df, rule.tested_field, context.table(p["ref_table"]), p["ref_column"], rule.label
    )


def _duplicate_keys(rule: Rule, p: Params) -> list:
    keys = p.get("keys") or rule.tested_field
    if not keys:
        raise RuleError("a tested field or the parameter keys is required")
    return _list(keys)


def _duplicates(context: Context, df: DataFrame, rule: Rule, p: Params) -> DataFrame:
    return uniqueness.check_duplicates(df, _duplicate_keys(rule, p), rule.label)


def _keyed_duplicates(context: Context, df: DataFrame, rule: Rule, p: Params) -> keyed.KeyedCheck:
    return uniqueness.keyed_duplicates(rule.file_name, df, _duplicate_keys(rule, p))


def _moving_average(context: Context, df: DataFrame, rule: Rule, p: Params) -> DataFrame:
    return trend.check_moving_average(
        df,
        rule.tested_field,
        p["partition"],
        p["date"],
        p["tolerance"],
        p["window"],
        _list(p.get("order", [])),
        rule.label,
    )


def _duplicate_files(recursive: bool):
    def build(context: Context, df, rule: Rule, p: Params) -> DataFrame:
        return files.check_duplicate_files(
            context.spark, p["path"], p.get("recursive", recursive), rule.label
        )

    return build


def _timeliness(context: Context, df, rule: Rule, p: Params) -> DataFrame:
    return files.check_file_timeliness(
        context.spark, p["path"], **_some(p, hours="hours", as_of="as_of"), label=rule.label
    )


def _duplicate_columns(context: Context, df: DataFrame, rule: Rule, p: Params) -> DataFrame:
    return columns.check_duplicate_columns(df, **_some(p, verify="verify"), label=rule.label)


def _require_outliers(df: DataFrame, rule: Rule, p: Params) -> None:
    outliers.require_outliers(df, rule.tested_field, **_some(p, k="k"))


def _outliers(df: DataFrame, rules: Sequence[Rule], params: Sequence[Params]) -> DataFrame:
    return outliers.evaluate_outliers(
        df, [r.tested_field for r in rules], [p.get("k", 1.5) for p in params], [r.label for r in rules]
    )


def _exact_sum(context: Context, df: DataFrame, rule: Rule, p: Params) -> DataFrame:
    if "scale" in p:
        raise RuleError("an exact sum has no scale")
    return exact_sum.check_exact_sum(
        df, rule.tested_field, p["expected"], **_some(p, tolerance="tolerance"), label=rule.label
    )


_SUM = Test(
    "Accuracy",
    ("expected",),
    ("tolerance", "scale", "exact"),
    frame=_exact_sum,
    scalar=lambda df, f, p: scalar.control_sum(
        df, f, p["expected"], **_some(p, tolerance="tolerance", scale="scale")
    ),
)

# The names rules use, and the dimension each test reports under.
TESTS: Mapping[str, Test] = {
    "check_nulls": Test("Completeness", scalar=lambda df, f, p: scalar.nulls(df, f)),
    "check_malformed": Test("Completeness", needs_field=False, scalar=lambda df, f, p: scalar.malformed_lines(df)),
    "count_records": Test(
        "Completeness",
        ("expected",),
        needs_field=False,
        scalar=lambda df, f, p: scalar.record_count(df, p["expected"]),
    ),
    "check_duplicates": Test(
        "Uniqueness", (), ("keys",), needs_field=False, frame=_duplicates, keyed=_keyed_duplicates
    ),
    "duplicated_files_by_name_and_size": Test(
        "Uniqueness",
        ("path",),
        ("recursive",),
        needs_field=False,
        needs_table=False,
        frame=_duplicate_files(True),
    ),
    "duplicated_files_current_path": Test(
        "Uniqueness",
        ("path",),
        needs_field=False,
        needs_table=False,
        frame=_duplicate_files(False),
    ),
    "find_duplicate_columns": Test(
        "Uniqueness", (), ("verify",), needs_field=False, frame=_duplicate_columns
    ),
    "check_consistency": Test(
        "Consistency",
        ("other_table", "key"),
        ("column2", "null_safe"),
        frame=_consistency,
        keyed=_keyed_consistency,
    ),
    "dtype_consistency": Test(
        "Consistency", ("type",), scalar=lambda df, f, p: scalar.castable(df, f, p["type"])
    ),
    "check_foreign_key": Test(
        "Foreign Key",
        ("ref_table", "ref_column"),
        frame=_foreign_key,
        keyed=_keyed_reference(references.keyed_foreign_key),
    ),
    "validate_numeric_range": Test(
        "Validations",
        ("min", "max"),
        scalar=lambda df, f, p: scalar.numeric_range(df, f, p["min"], p["max"]),
    ),
    "validate_values_length": Test(
        "Validations",
        ("type",),
        ("strict",),
        scalar=lambda df, f, p: scalar.declared_length(df, f, p["type"], **_some(p, strict="strict")),
    ),
    "validate_allowed_values": Test(
        "Validations",
        ("values",),
        instead=("ref_table", "ref_column"),
        frame=_allowed_in_table,
        keyed=_keyed_reference(references.keyed_allowed_in_table),
        scalar=lambda df, f, p: scalar.allowed_values(df, f, _text_list(p["values"], "values")),
    ),
    "validate_date_format": Test(
        "Validations",
        ("format",),
        ("ignore_nulls",),
        scalar=lambda df, f, p: scalar.date_format(
            df, f, p["format"], **_some(p, ignore_nulls="ignore_nulls")
        ),
    ),
    "file_timeliness": Test(
        "Freshness",
        ("path",),
        ("hours", "as_of"),
        needs_field=False,
        needs_table=False,
        frame=_timeliness,
    ),
    "validate_date_range": Test(
        "Freshness",
        ("duration", "unit"),
        ("as_of",),
        scalar=lambda df, f, p: scalar.date_range(
            df, f, p["duration"], p["unit"], **_some(p, as_of="as_of")
        ),
    ),
    "validate_sum": _SUM,
    "check_sum": _SUM,
    "moving_average": Test(
        "Accuracy", ("partition", "date", "tolerance", "window"), ("order",), frame=_moving_average
    ),
    "detect_outliers": Test("Accuracy", (), ("k",), require=_require_outliers, together=_outliers),
}


def parameters(rule: Rule) -> dict[str, object]:
    """The parameters of a rule, checked against what its test takes."""
    test = TESTS.get(rule.test)
    if test is None:
        raise RuleError(f"unknown test '{rule.test}'")
    text = (rule.expected_value or "").strip()
    if not text:
        given: dict[str, object] = {}
    else:
        try:
            value = json.loads(text)
        except json.JSONDecodeError:
            if len(test.required) != 1:
                raise RuleError(f"expected_value is not valid JSON: {text}") from None
            value = text
        if isinstance(value, dict):
            given = value
        elif len(test.required) == 1:
            given = {test.required[0]: value}
        else:
            raise RuleError(f"expected_value must be a JSON object: {text}")
    replaced = bool(test.instead) and any(name in given for name in test.instead)
    wanted = test.instead if replaced else test.required
    if missing := [name for name in wanted if given.get(name) is None]:
        raise RuleError(f"missing parameter: {', '.join(missing)}")
    if unknown := sorted(set(given) - {*wanted, *test.optional}):
        raise RuleError(f"unknown parameter: {', '.join(unknown)}")
    if "tolerance" in given:
        scalar.exact_number(given["tolerance"], "tolerance")
    for flag in ("strict", "ignore_nulls", "verify", "null_safe", "recursive", "exact"):
        if flag in given and not isinstance(given[flag], bool):
            raise RuleError(f"{flag} must be true or false, not {given[flag]!r}")
    if test.needs_field and not rule.tested_field:
        raise RuleError("a tested field is required")
    return given


def is_scalar(rule: Rule, params: Params) -> bool:
    """Whether the rule shares the aggregation of its table."""
    test = TESTS[rule.test]
    return test.scalar is not None and not params.get("exact") and not any(name in params for name in test.instead)


def require_pattern(spark: SparkSession, pattern: str) -> None:
    """Reject a date pattern the engine cannot use, before a whole table runs into it."""
    text = F.lit("2000-01-01")
    parsed = try_parse(text, T.DateType(), pattern, is_timestamp_pattern(pattern))
    spark.sql("SELECT 1 AS one").select(parsed).collect()


def build_scalar(df: DataFrame, rule: Rule, params: Params) -> scalar.ScalarCheck:
    """The check of a scalar rule, not yet seen by the analyser."""
    try:
        check = TESTS[rule.test].scalar(df, rule.tested_field, params)
        if rule.test == "validate_date_format":
            require_pattern(df.sparkSession, params["format"])
    except RuleError:
        raise
    except (PySparkException, TypeError, ValueError, AttributeError) as error:
        raise RuleError(first_line(error)) from error
    return check


def analyser_objects(df: DataFrame, checks: Sequence[scalar.ScalarCheck]) -> str | None:
    """Why the checks cannot run on ``df`` together, or None if they can."""
    metrics = [m for check in checks for m in check.metrics.values()]
    try:
        df.agg(*metrics)
    except PySparkException as error:
        return first_line(error)
    return None


def _built(build: Callable, context: Context, df: DataFrame | None, rule: Rule, params: Params):
    try:
        return build(context, df, rule, params)
    except RuleError:
        raise
    except (PySparkException, TypeError, ValueError, AttributeError) as error:
        raise RuleError(first_line(error)) from error


def build_frame(context: Context, df: DataFrame | None, rule: Rule, params: Params) -> DataFrame:
    def checked(*args):
        result = TESTS[rule.test].frame(*args)
        result.schema
        return result

    return _built(checked, context, df, rule, params)


def require_together(context: Context, df: DataFrame, rule: Rule, params: Params) -> None:
    _built(lambda _, *args: TESTS[rule.test].require(*args), context, df, rule, params)


def build_keyed(context: Context, df: DataFrame, rule: Rule, params: Params) -> keyed.KeyedCheck:
    def checked(*args):
        check = TESTS[rule.test].keyed(*args)
        check.require_columns()
        return check

    return _built(checked, context, df, rule, params)


def first_line(error: Exception) -> str:
    return (str(error).strip() or type(error).__name__).splitlines()[0]


def dimension_of(test: Column) -> Column:
    """The dimension of a test name, as a column."""
    chain = None
    for name, spec in TESTS.items():
        chain = F.when(test == name, spec.dimension) if chain is None else chain.when(test == name, spec.dimension)
    return chain
