from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from truegrain.errors import RuleError
from truegrain.functions.keywords import with_class
from truegrain.plans import dictionary as D
from truegrain.sources.readers import schema_table


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, 10.5, None, "x"), (2, None, None, "y")],
        "loan_amnt int, annual_inc double, Desc string, zip_code string",
    )


@pytest.fixture
def sheets(spark):
    schema = "column_name string, Description string, source_sheet string, original string"
    first = spark.createDataFrame(
        [("annualInc", "Reported income", "one", ""), ("Desc ", "Loan description", "one", "")], schema
    )
    second = spark.createDataFrame(
        [
            ("loan_amnt ", "Listed AMOUNT", "two", ""),
            ("unknown", None, "two", ""),
            ("zip_code", "First digits", "two", ""),
        ],
        schema,
    )
    return first, second


def test_combine_keeps_every_row_in_order(sheets):
    combined = D.combine_sheets(*sheets)
    assert combined.columns == ["column_name", "Description", "source_sheet"]
    assert [r["source_sheet"] for r in combined.collect()] == ["one", "one", "two", "two", "two"]


def test_types_status_and_fixed_names(table, sheets):
    mapped = D.map_types(D.combine_sheets(*sheets), schema_table(table))
    found = {
        r["column_name"]: (r["column_name_fixed"], r["column_type"], r["type_status"])
        for r in mapped.collect()
    }
    assert found == {
        "annualinc": ("annual_inc", "double", "missing"),
        "desc": ("desc", "string", "found"),
        "loan_amnt": ("loan_amnt", "int", "found"),
        "unknown": ("unknown", None, "missing"),
        "zip_code": ("zip_code", "string", "found"),
    }


def test_required_by_fixed_or_original_name(table, sheets):
    mapping = D.full_mapping(table, *sheets)
    required = {r["column_name"]: r["is_required"] for r in mapping.collect()}
    assert required == {
        "annualinc": True, "desc": False, "loan_amnt": True, "unknown": False, "zip_code": True,
    }
    from truegrain.operators.columns import non_null_profile

    strict = D.flag_required(mapping.drop("is_required"), non_null_profile(table), "column_name")
    assert not strict.where("column_name = 'annualinc'").first()["is_required"]


@pytest.mark.parametrize(
    ("description", "category", "description_class"),
    [
        ("Loan amount", "loan_info", "funds"),
        ("The FICO range", "credit_info", "other"),
        ("Annual INCOME", "financial_metrics", "funds"),
        ("Record of things", "payment_info", "other"),
        ("Job", "employment_info", "customer details"),
        ("The month", "dates", "dates"),
        ("zip", "geographic_info", "geographic location"),
        ("hardship", "special_cases", "other"),
        ("xyz", "other", "other"),
        (None, "other", "other"),
    ],
)
def test_categories(spark, description, category, description_class):
    df = spark.createDataFrame([(description,)], "Description string")
    assert D.categorise(df).first()["business_category"] == category
    by_class = D.categorise(df, D.DESCRIPTION_CLASSES, result_as="c")
    assert by_class.first()["c"] == description_class


GENERAL = {"check_nulls", "check_consistency", "dtype_consistency", "count_records"}


@pytest.mark.parametrize(
    ("category", "kind", "tests", "types"),
    [
        ("credit_info", "int", {"validate_numeric_range", "validate_sum", "check_duplicates"},
         ["credit_score_consistency", "range_check"]),
        ("dates", "string", {"validate_allowed_values", "validate_values_length", "validate_date_format",
                             "validate_date_range", "file_timeliness"}, ["date_format_validation", "timeliness"]),
        ("financial_metrics", "bigint", {"moving_average"}, []),
        ("special_cases", "date", {"duplicated_files_by_name_and_size", "find_duplicate_columns"},
         ["custom_validation"]),
        ("funds", "double", {"validate_numeric_range", "validate_sum", "check_duplicates"},
         ["uniqueness", "validity", "range_check"]),
        ("funds", "string", {"validate_allowed_values", "validate_values_length"}, ["validity"]),
        ("loan_info", None, {"check_foreign_key"}, ["accuracy"]),
        ("employment_info", "boolean", set(), ["consistency"]),
        (None, None, set(), []),
    ],
)
def test_tests_of_a_column(spark, category, kind, tests, types):
    df = spark.createDataFrame([(category, kind)], "business_category string, column_type string")
    row = D.assign_tests(df).first()
    assert row["test_function"] == sorted(GENERAL | tests)
    assert row["test_type"] == ["stability", "completeness", *types]


def test_wide_types_count_as_numeric(spark):
    df = spark.createDataFrame([("other", "decimal(10,2)")], "business_category string, column_type string")
    assert "validate_sum" in D.assign_tests(df, strict_types=False).first()["test_function"]
    assert "validate_sum" not in D.assign_tests(df).first()["test_function"]


def test_operational_table_and_rules(spark, table, sheets):
    focused = D.focus(D.full_mapping(table, *sheets))
    operational = D.operational_table(focused)
    assert operational.count() == sum(len(r["test_function"]) for r in focused.collect())
    # annualinc: reported income; zip_code: first digits, so other; both differ in critical.
    critical = {r["column_name"]: r["critical"] for r in operational.collect()}
    assert critical == {"annualinc": False, "loan_amnt": False, "zip_code": True}
    assert [r[0] for r in D.having_test(focused, "moving_average").select("column_name").orderBy("column_name").collect()] == ["annualinc", "loan_amnt"]
    expected = spark.createDataFrame(
        [("loan_amnt", "validate_sum", "3")], "column_name string, test_function string, expected_value string"
    )
    rules = D.to_rules(operational, "loans", expected)
    chosen = rules.where("tcid = 'loans.loan_amnt.validate_sum'").first()
    assert (chosen["test"], chosen["tested_field"], chosen["expected_value"], chosen["is_active"]) == (
        "validate_sum", "loan_amnt", "3", True,
    )
    assert rules.where(F.col("expected_value").isNotNull()).count() == 1


def test_keywords_by_index_as_by_search(spark):
    pick = random.Random(2)
    letters = "abcdé "
    keywords = sorted({(pick.randrange(5), pick.choice("xyz"), "".join(pick.choices(letters, k=pick.randrange(1, 7)))) for _ in range(400)})
    texts = ["".join(pick.choices("abcdefé ", k=pick.randrange(0, 60))) for _ in range(300)] + ["", "a", "ab", None, "😀é", "ffff" * 3_000]
    for some in (keywords, keywords[::40], [(1, "x", "é")], []):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, __text string")
        found = {r["i"]: r["c"] for r in with_class(df, F.col("__text"), some, "none", "c").collect()}
        for i, text in enumerate(texts):
            there = [(p, c) for p, c, k in some if k in (text or "")]
            assert found[i] == (min(there)[1] if there else "none")


def test_categories_from_a_table(spark):
    rules = spark.createDataFrame([("b", 2, "Rate"), ("a", 1, "INTEREST"), ("c", 3, None), (None, 0, "x"), ("d", 0, "")], "class string, priority int, pattern string")
    df = spark.createDataFrame([("Interest rate",), ("rate",), ("x",), (None,)], "Description string")
    found = D.categorise(df, rules)
    assert found.columns == ["Description", "business_category"]
    assert [r["business_category"] for r in found.collect()] == ["a", "b", "other", "other"]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(RuleError):
        D.categorise(df, rules.drop("priority"))


def test_large_tables_of_keywords_are_joined(spark, monkeypatch):
    """As by the index, without collecting the keywords; before, all of them were."""
    from truegrain.functions import keywords

    pick = random.Random(4)
    rules = [(pick.choice("xyz"), pick.randrange(9), "".join(pick.choices("abcé# ", k=pick.randrange(1, 9)))) for _ in range(300)]
    rules += [("one", 3, "ABC#"), ("two", 3, "abc#"), ("none", None, "a"), (None, 1, "a"), ("empty", 0, ""), ("empty", 0, None), ("long", -1, "b" * 40 + "c")]
    texts = ["".join(pick.choices("abcé# ", k=pick.randrange(0, 12))) for _ in range(150)] + [None, "", "B" * 41 + "C", "B" * 40] * 2
    df = spark.createDataFrame([(t, "kept") for t in texts], "Description string, __key string")
    table = spark.createDataFrame(rules, "class string, priority int, pattern string")
    expected = D.categorise(df, table).collect()
    monkeypatch.setattr(keywords, "LISTED", 10)
    collected = []
    monkeypatch.setattr(keywords, "with_class", lambda *args: collected.append(args))
    found = D.categorise(df, table)
    assert not collected and found.columns == ["Description", "__key", "business_category"]
    assert sorted(map(str, found.collect())) == sorted(map(str, expected))
    assert {r["business_category"] for r in expected} >= {"x", "other", "long"}
