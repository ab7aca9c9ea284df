"""Deriving tests for the columns of a table from its data dictionary.

Every step takes and gives a lazy DataFrame, so the whole chain is one plan; the
table itself is only read for the profile of empty columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions.columns import ref
from truegrain.functions.keywords import with_class_of
from truegrain.functions.text import first_class, normalised_name
from truegrain.operators.columns import non_null_profile
from truegrain.operators.similarity import best_matches
from truegrain.sources.readers import schema_table

# Category names and the description keywords that select them, in
# order of precedence.
BUSINESS_CATEGORIES: Sequence[tuple[str, Sequence[str]]] = (
    ("loan_info", ("loan", "application", "purpose", "policy")),
    ("credit_info", ("fico", "delinq", "inq", "credit", "risk")),
    ("financial_metrics", ("income", "amount", "balance", "funded", "bc_util", "cur_bal")),
    ("payment_info", ("pymnt", "installment", "total", "rec", "out_prncp")),
    ("employment_info", ("emp", "job", "employer", "title")),
    ("dates", ("date", "month", "issue", "last", "start", "end")),
    ("geographic_info", ("state", "zip", "addr")),
    ("special_cases", ("hardship", "settlement", "debt", "deferral")),
)
DESCRIPTION_CLASSES: Sequence[tuple[str, Sequence[str]]] = (
    ("funds", ("income", "amount", "balance")),
    ("customer details", ("employer", "job", "title")),
    ("status", ("status", "default", "delinquency")),
    ("dates", ("date", "month")),
    ("geographic location", ("state", "zip")),
)
OTHER = "other"

# Tests per column, by kind of type and by category.
GENERAL_TESTS = ("check_nulls", "check_consistency", "dtype_consistency", "count_records")
TESTS_BY_KIND: Mapping[str, Sequence[str]] = {
    "numeric": ("validate_numeric_range", "validate_sum", "check_duplicates"),
    "string": ("validate_allowed_values", "validate_values_length"),
}
TESTS_BY_CATEGORY: Mapping[str, Sequence[str]] = {
    "dates": ("validate_date_format", "validate_date_range", "file_timeliness"),
    "financial_metrics": ("moving_average",),
    "loan_info": ("check_foreign_key",),
    "credit_info": ("check_duplicates",),
    "special_cases": ("duplicated_files_by_name_and_size", "find_duplicate_columns"),
}

# Test types per column.
GENERAL_TYPES = ("stability", "completeness")
TYPES_BY_CATEGORY: Mapping[str, Sequence[str]] = {
    "dates": ("date_format_validation", "timeliness"),
    "loan_info": ("accuracy",),
    "credit_info": ("credit_score_consistency",),
    "employment_info": ("consistency",),
    "special_cases": ("custom_validation",),
    "other": ("basic_validation",),
}
FUNDS = "funds"
FUNDS_NUMERIC_TYPES = ("uniqueness", "validity")
FUNDS_OTHER_TYPES = ("validity",)
NUMERIC_TYPES = ("range_check",)
CRITICAL_MARK = "validation"

# The type names the mapping rules know.
STRICT_NUMERIC = ("int", "double")
WIDE_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def combine_sheets(*sheets: DataFrame) -> DataFrame:
    """The dictionary sheets as one table, in the order given; nothing is dropped."""
    columns = ("column_name", "Description", "source_sheet")
    return reduce(DataFrame.unionByName, [sheet.select(*columns) for sheet in sheets])


def normalise_names(df: DataFrame, column: str = "column_name") -> DataFrame:
    return df.withColumn(column, normalised_name(ref(column)))


def attach_types(dictionary: DataFrame, schema: DataFrame) -> DataFrame:
    """Add ``column_type`` by name, and whether it was found or is missing."""
    types = schema.select("column_name", "column_type")
    return dictionary.join(types, "column_name", "left").withColumn(
        "type_status", F.when(F.col("column_type").isNotNull(), "found").otherwise("missing")
    )


def missing_names(attached: DataFrame) -> DataFrame:
    return attached.where(F.col("column_type").isNull()).select("column_name").distinct()


def fix_names(attached: DataFrame, schema: DataFrame, threshold: int = 90) -> DataFrame:
    """Add ``column_name_fixed``: the most similar column for names without a type."""
    order = "position" if "position" in schema.columns else None
    matches = best_matches(
        missing_names(attached), "column_name", schema, "column_name", threshold, order
    ).select(F.col("name").alias("column_name"), F.col("matched").alias("__matched"))
    return (
        attached.join(matches, "column_name", "left")
        .withColumn("column_name_fixed", F.coalesce("__matched", "column_name"))
        .drop("__matched")
    )


def reattach_types(fixed: DataFrame, schema: DataFrame) -> DataFrame:
    """Replace ``column_type`` by the type of the fixed name; the status stays as it was."""
    types = schema.select(F.col("column_name").alias("column_name_fixed"), "column_type")
    return fixed.drop("column_type").join(types, "column_name_fixed", "left")


def map_types(dictionary: DataFrame, schema: DataFrame, threshold: int = 90) -> DataFrame:
    """Names normalised on both sides, types attached, misspelt names fixed."""
    columns = normalise_names(schema)
    attached = attach_types(normalise_names(dictionary), columns)
    return reattach_types(fix_names(attached, columns, threshold), columns)


def flag_required(
    mapping: DataFrame, profile: DataFrame, name: str = "column_name_fixed"
) -> DataFrame:
    """Add ``is_required``: the table has the column and the column has a value.

    ``profile`` is (column_name, non_null). The fixed name is looked up; with
    ``name="column_name"`` misspelt names stay unrequired.
    """
    filled = (
        normalise_names(profile)
        .groupBy("column_name")
        .agg(F.max(F.col("non_null") > 0).alias("__filled"))
        .withColumnRenamed("column_name", "__known")
    )
    return (
        mapping.join(filled, F.col(name) == F.col("__known"), "left")
        .withColumn("is_required", F.coalesce("__filled", F.lit(False)))
        .drop("__known", "__filled")
    )


def categorise(
    mapping: DataFrame,
    classes: Sequence[tuple[str, Sequence[str]]] | DataFrame = BUSINESS_CATEGORIES,
    description: str = "Description",
    result_as: str = "business_category",
) -> DataFrame:
    """Add the first class one of whose keywords is in the description; none gives other.

    ``classes`` may be a table (class, priority, pattern) of any number of keywords; least
    priority comes first.
    """
    if isinstance(classes, DataFrame):
        return with_class_of(mapping, F.lower(ref(description)), classes, OTHER, result_as)
    lowered = mapping.withColumn("__lowered", F.lower(ref(description)))
    return lowered.withColumn(
        result_as, first_class(F.col("__lowered"), classes, OTHER)
    ).drop("__lowered")


def _kind(column_type: Column, strict_types: bool) -> Column:
    if strict_types:
        numeric = column_type.isin(*STRICT_NUMERIC)
    else:
        numeric = column_type.isin(*WIDE_NUMERIC) | column_type.startswith("decimal")
    return F.when(numeric, "numeric").when(column_type == "string", "string")


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _lookup(key: Column, lists: Mapping[str, Sequence[str]]) -> Column:
    """The list stored under the key, else an empty one.

    A map is looked up once per row, however costly the key is to compute.
    """
    entries = F.create_map(*[c for name, values in lists.items() for c in (F.lit(name), _texts(values))])
    return F.coalesce(F.try_element_at(entries, key), _texts(()))


def test_functions(category: Column, column_type: Column, strict_types: bool = True) -> Column:
    """The tests of a column, each once and in alphabetical order."""
    kind = _kind(column_type, strict_types)
    tests = F.concat(
        _texts(GENERAL_TESTS), _lookup(kind, TESTS_BY_KIND), _lookup(category, TESTS_BY_CATEGORY)
    )
    return F.sort_array(F.array_distinct(tests))


def test_types(category: Column, column_type: Column, strict_types: bool = True) -> Column:
    """The kinds of test of a column, in order: general, by category, by type."""
    numeric = F.coalesce(_kind(column_type, strict_types) == "numeric", F.lit(False))
    funds = F.when(numeric, _texts(FUNDS_NUMERIC_TYPES)).otherwise(_texts(FUNDS_OTHER_TYPES))
    by_category = F.when(category == FUNDS, funds).otherwise(_lookup(category, TYPES_BY_CATEGORY))
    by_type = F.when(numeric, _texts(NUMERIC_TYPES)).otherwise(_texts(()))
    return F.concat(_texts(GENERAL_TYPES), by_category, by_type)


def assign_tests(mapping: DataFrame, strict_types: bool = True) -> DataFrame:
    """Add ``test_function`` and ``test_type``.

    Strict types know int, double and string only; otherwise every numeric type
    counts as numeric.
    """
    category, kind = F.col("business_category"), F.col("column_type")
    return mapping.withColumns(
        {
            "test_function": test_functions(category, kind, strict_types),
            "test_type": test_types(category, kind, strict_types),
        }
    )


def focus(mapping: DataFrame) -> DataFrame:
    """The required columns, with what the operational table needs."""
    return mapping.where("is_required").select(
        "column_name", "column_type", "business_category", "test_function", "test_type"
    )


def having_test(mapping: DataFrame, test: str) -> DataFrame:
    return mapping.where(F.array_contains("test_function", test))


def operational_table(focused: DataFrame) -> DataFrame:
    """One row per column and test; critical where a test type is a validation.

    The outer form of explode keeps a column without tests, and spares the filter on
    the list that the inner form puts in front, which would compute the list twice.
    """
    critical = F.exists("test_type", lambda kind: F.contains(kind, F.lit(CRITICAL_MARK)))
    return focused.select(
        "column_name",
        "column_type",
        "business_category",
        F.explode_outer("test_function").alias("test_function"),
        "test_type",
        F.lit(True).alias("enabled"),
        critical.alias("critical"),
    )


def to_rules(
    operational: DataFrame, file_name: str, expected: DataFrame | None = None
) -> DataFrame:
    """Rules for the suite from an operational table.

    ``expected`` gives the parameters as (column_name, test_function,
    expected_value); a rule that needs one and has none ends as Error.
    """
    keys = ["column_name", "test_function"]
    if expected is None:
        joined = operational.withColumn("expected_value", F.lit(None).cast("string"))
    else:
        joined = operational.join(expected.select(*keys, "expected_value"), keys, "left")
    return joined.select(
        F.concat_ws(".", F.lit(file_name), "column_name", "test_function").alias("tcid"),
        F.lit(file_name).alias("file_name"),
        F.col("enabled").alias("is_active"),
        "critical",
        F.col("test_function").alias("test"),
        F.col("column_name").alias("tested_field"),
        "expected_value",
    )


def full_mapping(
    table: DataFrame, *sheets: DataFrame, threshold: int = 90, strict_types: bool = True
) -> DataFrame:
    """Every step from dictionary sheets and a table to the mapping with its tests."""
    typed = map_types(combine_sheets(*sheets), schema_table(table), threshold)
    required = flag_required(typed, non_null_profile(table))
    return assign_tests(categorise(required), strict_types)
