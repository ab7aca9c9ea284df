from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import truegrain as tg
from truegrain.operators import scalar


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_nulls_leave_out_empty_text_and_nan(spark, outcome):
    df = spark.createDataFrame([(None, math.nan), ("", 1.0), ("a", None)], "s string, d double")
    assert outcome(tg.check_nulls(df, "s")) == ("Failed", 1)
    assert outcome(tg.check_nulls(df, "d")) == ("Failed", 1)
    assert outcome(tg.check_nulls(df.where("s is not null"), "s")) == ("Passed", 0)


def test_column_names_may_hold_blanks_dots_and_backticks(spark, outcome):
    df = spark.createDataFrame([(None,), (1,)], "v int")
    for name in ("Debt-To-Income Ratio", "a.b", "a`b", "100%"):
        named = df.withColumnRenamed("v", name)
        result = tg.check_nulls(named, name)
        assert outcome(result) == ("Failed", 1)
        assert result.first()["message"] == f"Column '{name}' contains 1 null value(s)."


def test_missing_column_is_an_error(spark):
    with pytest.raises(tg.RuleError):
        tg.check_nulls(text(spark, "a"), "w")


def test_record_count(spark, outcome):
    df = text(spark, "a", None, "c")
    assert outcome(tg.count_records(df, 3)) == ("Passed", 0)
    assert outcome(tg.count_records(df, 5)) == ("Failed", 2)
    assert outcome(tg.count_records(df.limit(0), 0)) == ("Passed", 0)


@pytest.mark.parametrize(
    ("kind", "bad"), [("int", 2), ("smallint", 3), ("double", 1), ("string", 0), ("date", 4)]
)
def test_castable_ignores_null(spark, outcome, kind, bad):
    # 40000 reads as a date too: a bare year may have five digits.
    df = text(spark, "abc", "3.7", " 5 ", "40000", None, "7")
    status = "Failed" if bad else "Passed"
    assert outcome(tg.dtype_consistency(df, "v", kind)) == (status, bad)


def test_numeric_range_is_closed_and_ignores_null(spark, outcome):
    df = spark.createDataFrame([(0.0,), (10.0,), (math.nan,), (None,), (-0.5,)], "v double")
    result = tg.validate_numeric_range(df, "v", 0, 10)
    assert outcome(result) == ("Failed", 2)
    assert "minimum (0): 1" in result.first()["message"]
    assert outcome(tg.validate_numeric_range(df.where("v between 0 and 10"), "v", 0, 10)) == ("Passed", 0)


def test_numeric_range_on_text_skips_what_is_no_number(spark, outcome):
    assert outcome(tg.validate_numeric_range(text(spark, "abc", "5", "50"), "v", 0, 10)) == ("Failed", 1)


def test_char_length_ignores_null(spark, outcome):
    assert outcome(tg.validate_values_length(text(spark, "abc", "abcd", None), "v", "CHAR(3)")) == ("Failed", 1)


def test_decimal_length_counts_sign_point_and_null(spark, outcome):
    df = text(spark, "12.345", "123.4", "12345", "-12.34", "abc", None)
    # Too long: 12.345 and -12.34; no number: abc and NULL; 12345 leaves no room for decimals.
    assert outcome(tg.validate_values_length(df, "v", "DECIMAL(5,2)")) == ("Failed", 5)
    strict = tg.validate_values_length(df, "v", "DECIMAL(5,2)", strict=True)
    # Strict: -12.34 fits, 12.345 has too many decimals.
    assert outcome(strict) == ("Failed", 4)


def test_integer_length_counts_null(spark, outcome):
    df = text(spark, "abc", "3.7", "40000", None, "7")
    assert outcome(tg.validate_values_length(df, "v", "INTEGER")) == ("Failed", 3)
    assert outcome(tg.validate_values_length(df, "v", "SMALLINT")) == ("Failed", 3)
    assert outcome(tg.validate_values_length(df, "v", "SMALLINT", strict=True)) == ("Failed", 4)


@pytest.mark.parametrize("kind", ["VARCHAR(3)", "char(3)", "DECIMAL(3,5)", "", "CHAR"])
def test_unknown_declared_type_is_an_error(spark, kind):
    with pytest.raises(tg.RuleError):
        tg.validate_values_length(text(spark, "a"), "v", kind)


def test_allowed_values(spark, outcome):
    df = text(spark, "a", "b", None)
    assert outcome(tg.validate_allowed_values(df, "v", ["a"])) == ("Failed", 1)
    assert outcome(tg.validate_allowed_values(df, "v", ["a", None])) == ("Failed", 1)
    assert outcome(tg.validate_allowed_values(df, "v", [])) == ("Failed", 2)
    assert outcome(tg.validate_allowed_values(df, "v", ["a", "b"])) == ("Passed", 0)
    numbers = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert outcome(tg.validate_allowed_values(numbers, "v", [1.5, "1", "x"])) == ("Failed", 1)


def test_date_format_counts_null_unless_told(spark, outcome):
    df = text(spark, "2020-01-31", "31/01/2020", "2020-02-30", None)
    assert outcome(tg.validate_date_format(df, "v", "yyyy-MM-dd")) == ("Failed", 3)
    assert outcome(tg.validate_date_format(df, "v", "yyyy-MM-dd", ignore_nulls=True)) == ("Failed", 2)
    assert outcome(tg.validate_date_format(text(spark, "Jan-95"), "v", "MMM-yy")) == ("Passed", 0)
    times = text(spark, "2020-01-31 23:59", "2020-01-31 24:59", "2020-01-31")
    assert outcome(tg.validate_date_format(times, "v", "yyyy-MM-dd HH:mm")) == ("Failed", 2)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_date_range_limits_are_inside(spark, outcome, kind):
    moments = ["2024-01-03 00:00:00", "2024-01-10 00:00:00", None, "2024-01-02 23:59:59", "2024-01-10 00:00:01"]
    df = text(spark, *moments).select(F.col("v").cast(kind).alias("v"))
    for as_of in ("2024-01-10", date(2024, 1, 10), datetime(2024, 1, 10)):
        result = tg.validate_date_range(df, "v", 7, "days", as_of)
        assert outcome(result) == ("Failed", 2)
    assert outcome(tg.validate_date_range(df.limit(3), "v", 1, "WEEK", "2024-01-10")) == ("Passed", 0)
    with pytest.raises(tg.RuleError):
        tg.validate_date_range(df, "v", 7, "fortnights")


def test_date_range_defaults_to_now(spark, outcome):
    df = spark.sql("SELECT current_timestamp() AS v UNION ALL SELECT TIMESTAMP '2000-01-01'")
    assert outcome(tg.validate_date_range(df, "v", 30, "DAYS")) == ("Failed", 1)


def test_sum(spark, outcome):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v double")
    assert outcome(tg.validate_sum(df, "v", 0.3)) == ("Passed", 0)
    assert outcome(tg.validate_sum(df, "v", 0.4)) == ("Failed", 1)
    assert outcome(tg.validate_sum(df, "v", 0.4, tolerance=0.1)) == ("Passed", 0)
    assert outcome(tg.validate_sum(df.limit(0), "v", 0)) == ("Failed", 1)
    assert outcome(tg.validate_sum(df.where("v is null"), "v", 0)) == ("Failed", 1)
    assert outcome(tg.validate_sum(text(spark, "1", "x", "2"), "v", 3)) == ("Passed", 0)
    unsummable = spark.createDataFrame([(1.0,), (math.nan,)], "v double")
    assert outcome(tg.validate_sum(unsummable, "v", 1)) == ("Failed", 1)


def test_sum_of_large_integers_does_not_overflow(spark, outcome):
    df = spark.createDataFrame([(2**62,)] * 4, "v bigint")
    assert outcome(tg.validate_sum(df, "v", 2**64)) == ("Passed", 0)


def test_control_table(spark):
    df = spark.createDataFrame([(1, 0.5, "x"), (2, 0.25, "y")], "a int, b double, c string")
    control = spark.createDataFrame(
        [("a", 3.0), ("b", 1.0), ("zz", 1.0)], "column_name string, expected_sum double"
    )
    found = {r["tested_field"]: r["status"] for r in scalar.control_sums(df, control).collect()}
    assert found == {"a": "Passed", "b": "Failed", "zz": "Error"}


def test_fused_results_equal_single_results(spark):
    df = spark.createDataFrame(
        [(i, None if i % 3 == 0 else str(i), i * 1.5) for i in range(50)], "a int, b string, c double"
    )
    checks = [
        scalar.nulls(df, "b"),
        scalar.record_count(df, 49),
        scalar.numeric_range(df, "c", 10, 40),
        scalar.declared_length(df, "b", "INTEGER"),
        scalar.castable(df, "b", "date"),
        scalar.allowed_values(df, "a", [1, 2]),
        scalar.control_sum(df, "c", 1837.5),
    ]
    fused = scalar.evaluate(df, checks).collect()
    single = [scalar.evaluate(df, [c]).first() for c in checks]
    assert fused == single


def test_many_checks_take_few_passes(spark):
    df = spark.createDataFrame([tuple(range(150))], ", ".join(f"c{i} int" for i in range(150)))
    checks = [scalar.numeric_range(df, c, 0, 100) for c in df.columns]
    results = scalar.evaluate(df, checks).collect()
    assert [r["tested_field"] for r in results] == df.columns
    assert sum(r["violations"] for r in results) == 49


def test_one_scan_for_all_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id * 2 AS twice", "id * 3 AS unused").write.parquet(path)
    df = spark.read.parquet(path)
    plan = scalar.evaluate(
        df, [scalar.nulls(df, "id"), scalar.numeric_range(df, "twice", 0, 9), scalar.record_count(df, 1)]
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "unused" not in plan


@pytest.mark.parametrize("allowed", [["9007199254740992"], [9007199254740992, 2.5], ["x", 9007199254740992.0]])
def test_listed_numbers_are_compared_as_the_column_is(spark, outcome, allowed):
    df = spark.createDataFrame([(9007199254740993,), (9007199254740992,)], "v bigint")
    assert outcome(tg.validate_allowed_values(df, "v", allowed)) == ("Failed", 1)


def test_small_floats_add_up(spark, outcome):
    df = spark.createDataFrame([(1e-7,)] * 10, "v double")
    assert outcome(tg.validate_sum(df, "v", "0.000001")) == ("Passed", 0)
    control = spark.createDataFrame([("v", 3.0000001)], "column_name string, expected_sum double")
    assert scalar.control_sums(spark.createDataFrame([(3.0,)], "v double"), control).first()["status"] == "Failed"
