"""Checks that need a plan of their own."""

from __future__ import annotations

import math
import random
import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

import truegrain as tg
from truegrain.operators import columns, consistency, exact_sum, outliers, references, trend, uniqueness


def test_duplicates_count_groups_and_null_keys(spark, outcome):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (1,), (2,)], "count int")
    result = tg.check_duplicates(df, "count")
    assert outcome(result) == ("Failed", 2)
    assert "Surplus rows: 3" in result.first()["message"]
    assert outcome(tg.check_duplicates(df.where("count = 2"), ["count"])) == ("Passed", 0)
    found = {(r["count"], r["copies"]) for r in uniqueness.duplicate_groups(df, "count").collect()}
    assert found == {(None, 2), (1, 3)}


def pairs_that_differ(left, right, null_safe):
    total = 0
    for k1, v1 in left:
        for k2, v2 in right:
            if k1 is None or k1 != k2:
                continue
            if null_safe:
                total += v1 != v2
            else:
                total += v1 is not None and v2 is not None and v1 != v2
    return total


@pytest.mark.parametrize("null_safe", [False, True])
def test_consistency_counts_the_pairs_of_a_join(spark, outcome, null_safe):
    random.seed(7)
    def rows(n):
        # Key 1 holds a third of all rows on both sides.
        return [
            (random.choice([None, 1, 1, 2, 3, 4]), random.choice([None, "a", "b", "c"]))
            for _ in range(n)
        ]
    left, right = rows(60), rows(40) + [(9, "z")]
    df1 = spark.createDataFrame(left, "k int, v string")
    df2 = spark.createDataFrame(right, "k bigint, v string")
    expected = pairs_that_differ(left, right, null_safe)
    assert expected > 0
    assert outcome(consistency.check_consistency(df1, df2, "k", "v", null_safe=null_safe)) == ("Failed", expected)
    assert outcome(consistency.check_consistency(df1.limit(0), df2, "k", "v")) == ("Passed", 0)


def test_consistency_of_differently_named_columns_and_types(spark, outcome):
    df1 = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, a int")
    df2 = spark.createDataFrame([(1, "10"), (2, "21"), (3, "x")], "k int, b string")
    assert outcome(tg.check_consistency(df1, df2, "k", "a", "b")) == ("Failed", 1)


def test_consistency_with_several_keys(spark, outcome):
    df1 = spark.createDataFrame([(1, "x", 5), (1, "y", 6)], "k int, l string, v int")
    df2 = spark.createDataFrame([(1, "x", 5), (1, "y", 7)], "k int, l string, v int")
    assert outcome(tg.check_consistency(df1, df2, ["k", "l"], "v")) == ("Failed", 1)
    row = consistency.mismatches_by_key(df1, df2, ["k", "l"], "v").first()
    assert (row["k"], row["l"], row["mismatched_pairs"]) == (1, "y", 1)


def test_consistency_counts_beyond_bigint(spark, outcome):
    many = spark.range(1).select(F.lit(1).alias("k"), F.lit("a").alias("v"))
    other = many.withColumn("v", F.lit("b"))
    by_key = consistency.mismatches_by_key(many, other, "k", "v")
    assert dict(by_key.dtypes)["mismatched_pairs"] == "decimal(38,0)"


def test_foreign_key_ignores_null_on_both_sides(spark, outcome):
    fk = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "fk int")
    ref = spark.createDataFrame([(1,), (1,), (None,)], "id bigint")
    assert outcome(tg.check_foreign_key(fk, "fk", ref, "id")) == ("Failed", 2)
    assert outcome(tg.check_foreign_key(fk, "fk", ref.limit(0), "id")) == ("Failed", 4)
    assert outcome(tg.check_foreign_key(fk.where("fk = 1"), "fk", ref, "id")) == ("Passed", 0)
    assert sorted(r["fk"] for r in references.orphan_rows(fk, "fk", ref, "id").collect()) == [2, 3]
    values = references.orphan_values(fk, "fk", ref.limit(0), "id").collect()
    assert {(r["fk"], r["row_count"]) for r in values} == {(1, 2), (2, 1), (3, 1)}


def test_foreign_key_compares_text_with_numbers_as_text(spark, outcome):
    fk = spark.createDataFrame([("1",), ("abc",)], "fk string")
    ref = spark.createDataFrame([(1,)], "id int")
    assert outcome(tg.check_foreign_key(fk, "fk", ref, "id")) == ("Failed", 1)


def test_profile_and_empty_columns(spark):
    df = spark.createDataFrame([(1, None, ""), (None, None, "x")], "a int, `b c` string, d string")
    found = {r["column_name"]: r["non_null"] for r in columns.non_null_profile(df).collect()}
    assert found == {"a": 1, "b c": 0, "d": 2}
    assert [r[0] for r in columns.empty_columns(df).collect()] == ["b c"]


def test_checksum_of_nulls_and_order(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 1)], "n string, a int, b int")
    sums = {r["column_name"]: int(r["checksum"]) for r in columns.column_checksums(df).collect()}
    assert sums["n"] == 84
    assert sums["a"] == sums["b"] == int(tg.compute_column_checksum(df, "a").first()[0])


def test_duplicate_columns(spark, outcome):
    rows = [(1, 1, 2, 1, None, None, "1"), (2, 2, 1, 2, None, None, "2")]
    df = spark.createDataFrame(rows, "a int, same int, permuted int, wide bigint, n1 string, n2 string, t string")
    assert columns.duplicate_column_groups(df) == [["a", "same"], ["n1", "n2"]]
    assert columns.duplicate_column_groups(df, verify=False) == [["a", "same", "permuted"], ["n1", "n2"]]
    assert outcome(columns.check_duplicate_columns(df)) == ("Failed", 2)
    assert columns.duplicate_column_groups(df.select("a", "permuted")) == []
    empty = df.limit(0).select("a", "same", "t")
    assert columns.duplicate_column_groups(empty) == [["a", "same"]]
    assert columns.duplicate_column_groups(empty, verify=False) == [["a", "same", "t"]]


def test_duplicate_columns_in_a_table_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, 2, 1), (1, 2, 1), (2, 1, 2), (2, 1, 2)], "a int, b int, c int")
    assert columns.duplicate_column_groups(df) == [["a", "c"]]


def test_name_drift_counts_null_pairs(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "A"), (None, None)], "n string, o string")
    assert columns.name_drift(df, "n", "o").first()["violations"] == 2


def trend_rows(spark, n=400):
    random.seed(3)
    rows = []
    for i in range(n):
        # One key holds more than a third of the rows, and dates have many ties.
        key = random.choice(["hot", "hot", "b", "c", None])
        value = None if random.random() < 0.05 else round(random.uniform(-5, 20), 2)
        rows.append((i, key, f"2024-01-{random.randint(1, 9):02d}", value))
    return rows, spark.createDataFrame(rows, "id int, k string, d string, v double")


def expected_deviation(rows, size):
    found = {}
    for key in {r[1] for r in rows}:
        seen = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        for i, row in enumerate(seen):
            window = [r[3] for r in seen[max(0, i - size) : i + 1] if r[3] is not None]
            mean = sum(window) / len(window) if window else None
            if not mean:
                found[row[0]] = 0.0
            elif row[3] is None:
                found[row[0]] = None
            else:
                found[row[0]] = abs(row[3] - mean) / abs(mean) * 100
    return found


@pytest.mark.parametrize("slices", [1, 7, 150])
@pytest.mark.parametrize("size", [0, 3, 60, 1000])
def test_deviation_over_any_slices(spark, slices, size):
    """A key over many slices, slices of a few rows, and halos that reach past several of them."""
    rows, df = trend_rows(spark)
    coalesced, parts = "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"
    before = spark.conf.get(parts)
    spark.conf.set(coalesced, "false")
    spark.conf.set(parts, slices)
    try:
        found = {r["id"]: r["deviation"] for r in trend.deviations(df, "v", "k", "d", size, ["id"]).collect()}
    finally:
        spark.conf.unset(coalesced)
        spark.conf.set(parts, before)
    expected = expected_deviation(rows, size)
    assert len(found) == len(expected)
    for row_id, value in expected.items():
        assert found[row_id] == (None if value is None else pytest.approx(value, rel=1e-9))


def test_moving_average_check(spark, outcome):
    df = spark.createDataFrame(
        [("a", "2024-01-01", -10.0, "m"), ("a", "2024-01-02", -30.0, "m"), ("b", "2024-01-01", 0.0, "m")],
        "k string, d string, v double, moving_avg string",
    )
    # The mean is -20, so the deviation is 50 percent although the mean is negative.
    assert outcome(tg.moving_average(df, "v", "k", "d", 49, 1)) == ("Failed", 1)
    assert outcome(tg.moving_average(df, "v", "k", "d", 50, 1)) == ("Passed", 0)
    assert outcome(tg.moving_average(df.limit(0), "v", "k", "d", 50, 1)) == ("Passed", 0)
    with pytest.raises(tg.RuleError):
        tg.moving_average(df, "v", "k", "d", 50, -1)


def by_sorting(values, p):
    ordered = sorted(v for v in values if v is not None and math.isfinite(v))
    at = (len(ordered) - 1) * p
    low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
    return low if low == high or at == math.floor(at) else low + (high - low) * (at - math.floor(at))


EDGES = [
    0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.0, math.nextafter(1.0, 0), math.nextafter(2.0, 0), 2.0, 4.0,
    math.nextafter(4.0, 9), 1e308, -1e308, 1.7976931348623157e308, 0.1, -3.0, 2.0**53, 2.0**-537, math.nextafter(2.0**1000, 0),
]


def test_images_are_the_bits_of_the_values(spark):
    random.seed(8)
    values = EDGES + [random.choice([-1, 1]) * random.random() * 2.0 ** random.randrange(-1074, 1023) for _ in range(3_000)]
    values += [s * 2.0**e for e in range(-1074, 1024) for s in (1, -1)]
    df = outliers.images(spark.createDataFrame([(v,) for v in values], "v double").coalesce(1), [F.col("v")])
    found = [r["v0"] for r in df.collect()]
    assert [outliers.value_of(i) for i in found] == values
    assert sorted(values) == [outliers.value_of(i) for i in sorted(found)]


def test_exact_quantiles(spark):
    random.seed(5)
    columns = {
        "a": [7.5] * 300 + [random.gauss(0, 100) for _ in range(500)],
        "b": [random.choice(EDGES) for _ in range(800)],
        "c": [3.0] * 800,
        "d": [random.choice([math.nan, math.inf, -math.inf, None, 1.0, 2.0]) for _ in range(800)],
        "e": [math.nan, None] * 400,
        "f": [random.random() * 1e-300 for _ in range(799)] + [None],
    }
    names = list(columns)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{n} double" for n in names)).repartition(3)
    shares = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]
    found = dict(zip(names, outliers.quantiles(df, names, shares)))
    assert found.pop("e") == [None] * len(shares)
    for name, own in found.items():
        assert own == [by_sorting(columns[name], p) for p in shares], name
    assert outliers.quantiles(df.where("a > 1e9"), names, [0.5]) == [[None]] * len(names)


def test_all_columns_share_their_readings(spark, tmp_path):
    df = spark.range(500).selectExpr(*[f"cast(id * {i} % 97 as double) as c{i}" for i in range(1, 13)])
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    jobs = []
    for columns in (["c1"], df.columns):
        name = f"quantiles-{len(columns)}"
        context.setJobGroup(name, name)
        limits = outliers.all_fences(df, columns, [1.5] * len(columns))
        jobs.append(len(tracker.getJobIdsForGroup(name)))
        assert None not in limits
    context.setJobGroup("", "")
    assert jobs[0] == jobs[1]


def test_outliers_at_nan_and_infinity(spark, outcome):
    def of(values, **more):
        return outcome(tg.detect_outliers(spark.createDataFrame([(float(v),) for v in values], "v double"), "v", **more))

    assert of([1, 2, 3] + [math.nan] * 4) == ("Failed", 4)
    assert of([1, 2, 3, 4] + [math.inf] * 11) == ("Failed", 11)
    assert of([1, 2, 3, 4, -math.inf]) == ("Failed", 1)
    assert of([math.nan, math.inf]) == ("Failed", 2)
    assert of([1e308, -1e308, 0, 1, 2, math.inf], k=1e308) == ("Failed", 1)
    assert of([5] * 9) == ("Passed", 0)
    with pytest.raises(tg.RuleError):
        of([1], k=-1)


def test_outliers(spark, outcome):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,), (None,)], "v double")
    assert outcome(tg.detect_outliers(df, "v")) == ("Failed", 1)
    assert outcome(tg.detect_outliers(df.limit(0), "v")) == ("Passed", 0)


def test_fixture_is_skewed():
    random.seed(3)
    keys = Counter(random.choice(["hot", "hot", "b", "c", None]) for _ in range(400))
    assert keys["hot"] > 400 / 3


def test_sums_of_floats_are_exact(spark, outcome):
    random.seed(11)
    values = [random.choice([1e-13, 1e30, -1e30, 0.1, 3.0, 5e-324, 1e280, -1e280]) * random.random() for _ in range(3_000)]
    values += [1e30, 1e-13, -1e30, 0.1] * 50 + [v for v in EDGES if abs(v) < 1e307]
    df = spark.createDataFrame([(v, 0.1, float("nan") if i == 7 else v, None) for i, v in enumerate(values)], "a double, b float, c double, d double")
    found = exact_sum.exact_sums(df.repartition(5), ["a", "b", "c", "d"])
    assert float(found[0]) == math.fsum(values)
    assert float(found[1]) == math.fsum([float(struct.unpack("f", struct.pack("f", 0.1))[0])] * len(values))
    assert found[2:] == [None, None]
    assert found == exact_sum.exact_sums(df.orderBy("a"), ["a", "b", "c", "d"])
    small = spark.createDataFrame([(0.1,), (0.2,), (1e16,), (-1e16,), (None,)], "v double")
    assert outcome(exact_sum.check_exact_sum(small, "v", 0.3)) == ("Failed", 1)
    assert outcome(exact_sum.check_exact_sum(small, "v", math.fsum([0.1, 0.2]))) == ("Passed", 0)
    assert outcome(exact_sum.check_exact_sum(small, "v", 0.3, tolerance="1e-16")) == ("Passed", 0)
    assert outcome(exact_sum.check_exact_sum(small.limit(0), "v", 0)) == ("Failed", 1)


def test_map_columns_take_part(spark):
    rows = [({"a": 1, "b": 2}, {"b": 2, "a": 1}, {"a": 9}), (None, None, None)]
    df = spark.createDataFrame(rows, "m map<string,int>, n map<string,int>, o map<string,int>").selectExpr(
        "m", "n", "o", "array(m) as p", "named_struct('x', n) as q"
    )
    assert {r["column_name"] for r in columns.column_checksums(df).collect()} == {"m", "n", "o", "p", "q"}
    assert columns.duplicate_column_groups(df) == [["m", "n"]]
    assert {'m', 'n'} <= set(columns.duplicate_column_groups(df, verify=False)[0])


def test_whole_numbers_and_floats_are_compared_exactly(spark, outcome):
    whole = spark.createDataFrame([(9007199254740993,), (5,), (None,)], "k bigint")
    floats = spark.createDataFrame([(9007199254740992.0,), (5.0,), (1e300,), (float("nan"),)], "k double")
    assert outcome(references.check_foreign_key(whole, "k", floats, "k")) == ("Failed", 1)
    assert outcome(references.check_foreign_key(floats, "k", whole, "k")) == ("Failed", 3)
    left = spark.createDataFrame([(1, 9007199254740993), (2, 5)], "i int, v bigint")
    right = spark.createDataFrame([(1, 9007199254740992.0), (2, 5.0)], "i int, v double")
    assert outcome(consistency.check_consistency(left, right, "i", "v")) == ("Failed", 1)


def test_images_of_many_columns_are_coded_once(spark):
    """Code that grows with the columns is not compiled, and took 2 microseconds for a value."""
    df = spark.range(10).selectExpr(*[f"cast(id + {i} as double) as c{i}" for i in range(20)])

    def logarithms(columns):
        plan = outliers._round(outliers._single(df, [F.col(c) for c in columns]), 0, {}, len(columns))
        return plan._jdf.queryExecution().optimizedPlan().toString().count("LOG2")

    assert logarithms(df.columns) == logarithms(df.columns[:1]) > 0
