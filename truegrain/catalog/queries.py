"""One query per operator."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from truegrain.catalog.inputs import Source
from truegrain.operators import (
    columns,
    consistency,
    exact_sum,
    outliers,
    references,
    scalar,
    similarity,
    trend,
    uniqueness,
)
from truegrain.plans import dictionary as D
from truegrain.plans import suite
from truegrain.session import new_shared_path
from truegrain.sources import publish, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-01-25 00:00:00"


def query(build: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Source(spark, folder))
    return build


def _violations(df: DataFrame, check: scalar.ScalarCheck) -> DataFrame:
    return scalar.evaluate(df, [check]).select("violations", "status")


@query
def null_count(s: Source) -> DataFrame:
    df = s.orders_with_gaps()
    return _violations(df, scalar.nulls(df, "o_custkey"))


@query
def row_count(s: Source) -> DataFrame:
    df = s.lineitem
    return _violations(df, scalar.record_count(df, 50_000))


@query
def duplicate_keys(s: Source) -> DataFrame:
    return uniqueness.duplicate_groups(s.lineitem, ["l_orderkey", "l_linenumber"]).agg(
        F.count(F.lit(1)).alias("dup_groups"), F.sum(F.col("copies") - 1).alias("surplus_rows")
    )


@query
def duplicate_check(s: Source) -> DataFrame:
    return uniqueness.check_duplicates(s.orders, ["o_custkey", "o_orderdate"]).select(
        "violations", "status"
    )


@query
def duplicate_key_groups(s: Source) -> DataFrame:
    return uniqueness.duplicate_groups(s.documents, ["text", "lang"])


@query
def column_fingerprint(s: Source) -> DataFrame:
    return columns.column_checksums(s.lineitem, portable=True).select(
        "column_name", F.col("checksum").cast("string").alias("fp")
    )


@query
def column_checksum_hash(s: Source) -> DataFrame:
    return columns.column_checksums(s.orders).select(
        "column_name", F.col("checksum").cast("string").alias("checksum")
    )


@query
def duplicate_columns(s: Source) -> DataFrame:
    return columns.find_duplicate_columns(s.orders_with_copies())


@query
def duplicate_columns_any_order(s: Source) -> DataFrame:
    return columns.find_duplicate_columns(s.orders_with_copies(), verify=False)


@query
def consistency_check(s: Source) -> DataFrame:
    return consistency.check_consistency(
        s.orders, s.orders_corrected(), "o_orderkey", "o_orderstatus"
    ).select("violations", "status")


@query
def consistency_two_columns(s: Source) -> DataFrame:
    return consistency.check_consistency(
        s.customer, s.customers_moved(), "c_custkey", "c_nationkey", "home_nation"
    ).select("violations", "status")


@query
def consistency_many_to_many(s: Source) -> DataFrame:
    return consistency.mismatches_by_key(
        s.lineitem, s.lineitem, "l_orderkey", "l_returnflag"
    ).select("l_orderkey", F.col("mismatched_pairs").cast("bigint").alias("mismatched_pairs"))


@query
def consistency_with_nulls(s: Source) -> DataFrame:
    return consistency.check_consistency(
        s.orders, s.orders_with_gaps(), "o_orderkey", "o_custkey", null_safe=True
    ).select("violations", "status")


@query
def foreign_key(s: Source) -> DataFrame:
    return references.check_foreign_key(
        s.orders, "o_custkey", s.solvent_customers(), "c_custkey"
    ).select("violations", "status")


@query
def foreign_key_values(s: Source) -> DataFrame:
    return references.orphan_values(s.orders, "o_custkey", s.solvent_customers(), "c_custkey")


@query
def foreign_key_rows(s: Source) -> DataFrame:
    return references.orphan_rows(
        s.orders, "o_custkey", s.solvent_customers(), "c_custkey"
    ).select("o_orderkey", "o_custkey")


@query
def foreign_key_mixed_types(s: Source) -> DataFrame:
    """Keys as whole numbers against keys as floats, half of them a little off."""
    customers = s.customer.select(
        (F.col("c_custkey") + F.when(F.col("c_custkey") % 2 == 0, 0.25).otherwise(0.0)).alias("key")
    )
    return references.orphan_values(s.orders, "o_custkey", customers, "key").select(
        F.col("o_custkey").cast("bigint").alias("o_custkey"), "row_count"
    )


@query
def allowed_values_table(s: Source) -> DataFrame:
    """The allowed values stand in a table."""
    return references.check_allowed_in_table(
        s.lineitem, "l_partkey", s.part.where("p_size > 10"), "p_partkey"
    ).select("violations", "status")


@query
def nested_nulls(s: Source) -> DataFrame:
    """A field inside a struct."""
    orders = s.orders_with_gaps().select(F.struct("o_custkey", "o_orderkey").alias("order"))
    return _violations(orders, scalar.nulls(orders, "order.o_custkey"))


@query
def checksum_groups(s: Source) -> DataFrame:
    """Which columns have equal checksums, whatever these are."""
    equal = Window.partitionBy("checksum")
    sums = columns.column_checksums(s.orders_with_copies()).withColumn("members", F.count(F.lit(1)).over(equal))
    return sums.where("members > 1").select("column_name", F.min("column_name").over(equal).alias("same_as"))


@query
def dtype_consistency(s: Source) -> DataFrame:
    df = s.part_sizes()
    return _violations(df, scalar.castable(df, "p_size", "int"))


@query
def numeric_range(s: Source) -> DataFrame:
    df = s.orders
    return scalar.measure(df, scalar.numeric_range(df, "o_totalprice", 2000, 400000)).select(
        "below", "above", F.col("bad").alias("violations")
    )


@query
def char_length(s: Source) -> DataFrame:
    df = s.customer
    return _violations(df, scalar.declared_length(df, "c_mktsegment", "CHAR(9)"))


@query
def decimal_length(s: Source) -> DataFrame:
    df = s.lineitem
    return _violations(df, scalar.declared_length(df, "l_extendedprice", "DECIMAL(7,2)"))


@query
def integer_length(s: Source) -> DataFrame:
    df = s.orders_with_gaps().withColumn("o_custkey", F.col("o_custkey").cast("string"))
    return _violations(df, scalar.declared_length(df, "o_custkey", "INTEGER"))


@query
def allowed_values(s: Source) -> DataFrame:
    df = s.events
    return _violations(df, scalar.allowed_values(df, "event_type", ["click", "view", "purchase"]))


@query
def date_format(s: Source) -> DataFrame:
    df = s.orders_with_text_dates()
    return _violations(df, scalar.date_format(df, "o_orderdate", "yyyy-MM-dd"))


@query
def date_format_ignoring_nulls(s: Source) -> DataFrame:
    df = s.orders_with_text_dates()
    return _violations(df, scalar.date_format(df, "o_orderdate", "yyyy-MM-dd", ignore_nulls=True))


@query
def timestamp_format(s: Source) -> DataFrame:
    df = s.events_with_text_times()
    return _violations(df, scalar.date_format(df, "ts", "yyyy-MM-dd HH:mm:ss"))


@query
def date_range(s: Source) -> DataFrame:
    df = s.events
    return scalar.measure(df, scalar.date_range(df, "ts", 7, "days", AS_OF)).select(
        "late", "future", (F.col("late") + F.col("future")).alias("violations")
    )


@query
def control_sum(s: Source) -> DataFrame:
    df = s.lineitem
    check = scalar.control_sum(df, "l_extendedprice", 1_000_000, scale=2)
    return scalar.measure(df, check).select(
        F.col("actual").cast("double").alias("actual"),
        F.when(F.col("actual") == 1_000_000, "Passed").otherwise("Failed").alias("status"),
    )


@query
def control_table(s: Source) -> DataFrame:
    """Column sums against a control table made from per-order subtotals."""
    money = "decimal(38,2)"
    subtotals = s.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast(money)).alias("q"),
        F.sum(F.col("l_tax").cast(money)).alias("t"),
    )
    control = subtotals.agg(F.sum("q").alias("q"), F.sum("t").alias("t")).select(
        F.inline(
            F.array(
                F.struct(F.lit("l_quantity").alias("column_name"), F.col("q").alias("expected_sum")),
                F.struct(
                    F.lit("l_tax").alias("column_name"),
                    (F.col("t") + 1).cast(money).alias("expected_sum"),
                ),
            )
        )
    )
    return scalar.control_sums(s.lineitem, control, scale=2).select("tested_field", "status")


@query
def moving_average(s: Source) -> DataFrame:
    return trend.deviations(
        s.orders, "o_totalprice", "o_custkey", "o_orderdate", 3, ["o_orderkey"]
    ).select(
        "o_orderkey",
        F.round("moving_avg", 4).alias("moving_avg"),
        F.round("deviation", 6).alias("deviation"),
    )


@query
def moving_average_check(s: Source) -> DataFrame:
    return trend.check_moving_average(
        s.orders, "o_totalprice", "o_custkey", "o_orderdate", 150, 3, ["o_orderkey"]
    ).select("violations", "status")


@query
def highest_deviation(s: Source) -> DataFrame:
    return trend.measured_deviation(
        s.orders, "o_totalprice", "o_custkey", "o_orderdate", 150, 3, ["o_orderkey"]
    ).select(F.round("highest", 6).alias("highest"), "bad")


@query
def iqr_outliers(s: Source) -> DataFrame:
    return outliers.check_outliers(s.lineitem, "l_extendedprice", 0.75).select(
        "violations", "status"
    )


@query
def exact_float_sum(s: Source) -> DataFrame:
    """Sums of floats of very different sizes, exact to the last bit, as whole multiples of a small power of two."""
    spread = F.col("l_extendedprice") * F.pow(F.lit(2.0), 5 * (F.col("l_linenumber") - 4))
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    found = exact_sum.exact_sums(s.lineitem.select(spread.alias("spread"), signed.alias("signed")), ["spread", "signed"])
    rows = [(n, None if f is None else str(f * 2**60)) for n, f in zip(("spread", "signed"), found)]
    return s.spark.createDataFrame(rows, "column_name string, units string")


#: The numeric columns of line items.
LINEITEM_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def iqr_fences_all(s: Source) -> DataFrame:
    """Fences of every numeric column, from four readings."""
    found = outliers.all_fences(s.lineitem, LINEITEM_NUMBERS, [1.5] * len(LINEITEM_NUMBERS))
    rows = [(c, *(f or (None, None))) for c, f in zip(LINEITEM_NUMBERS, found)]
    return s.spark.createDataFrame(rows, "column_name string, low double, high double")


@query
def iqr_fences_nan(s: Source) -> DataFrame:
    """Outliers where some prices are NaN or infinite."""
    odd = (
        F.when(F.col("l_linenumber") == 7, F.lit(float("nan")))
        .when(F.col("l_linenumber") == 6, F.lit(float("inf")))
        .when((F.col("l_linenumber") == 5) & (F.col("l_returnflag") == "R"), F.lit(float("-inf")))
        .otherwise(F.col("l_extendedprice"))
    )
    found = outliers.check_outliers(s.lineitem.withColumn("price", odd), "price", 0.75)
    return found.select("status", "violations")


@query
def iqr_fences(s: Source) -> DataFrame:
    low, high = outliers.fences(s.orders, "o_totalprice") or (None, None)
    return s.orders.agg(
        F.lit(low).alias("lower"),
        F.lit(high).alias("upper"),
        F.count_if((F.col("o_totalprice") < low) | (F.col("o_totalprice") > high)).alias("n"),
    ).select(F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


@query
def non_null_profile(s: Source) -> DataFrame:
    return columns.non_null_profile(s.orders_with_gaps())


@query
def empty_columns(s: Source) -> DataFrame:
    return columns.empty_columns(s.orders_with_gaps())


@query
def schema_catalog(s: Source) -> DataFrame:
    df = s.lineitem
    return readers.schema_table(df).join(columns.non_null_profile(df), "column_name")


@query
def name_drift(s: Source) -> DataFrame:
    return columns.name_drift(s.part_sheet(), "column_name", "original")


def _dictionary(s: Source) -> DataFrame:
    return D.combine_sheets(s.part_sheet(), s.supplier_sheet(), s.customer_sheet())


@query
def dictionary_union(s: Source) -> DataFrame:
    return D.normalise_names(_dictionary(s))


@query
def type_status(s: Source) -> DataFrame:
    return D.attach_types(D.normalise_names(_dictionary(s)), s.customer_schema())


@query
def missing_names(s: Source) -> DataFrame:
    return D.missing_names(D.attach_types(D.normalise_names(_dictionary(s)), s.customer_schema()))


@query
def fuzzy_match(s: Source) -> DataFrame:
    return similarity.best_matches(s.part_labels(), "label", s.part_columns(), "label").select(
        "name", "matched", F.round("score", 6).alias("score")
    )


@query
def fixed_types(s: Source) -> DataFrame:
    return D.map_types(s.supplier_sheet(), s.supplier_schema()).select(
        "column_name", "column_name_fixed", "column_type", "type_status"
    )


@query
def required_flag(s: Source) -> DataFrame:
    return D.flag_required(s.event_mapping(), columns.non_null_profile(s.event_columns()))


@query
def business_category(s: Source) -> DataFrame:
    return (
        D.categorise(s.documents, description="text", result_as="category")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def category_rules_table(s: Source) -> DataFrame:
    """The business category of every document, and of names by a table with a keyword for each customer."""
    rows = [(c, i, k.upper()) for i, (c, keywords) in enumerate(D.BUSINESS_CATEGORIES) for k in keywords]
    rules = s.spark.createDataFrame([*rows, ("never", 0, None), ("never", 0, "")], "class string, priority int, pattern string")
    documents = D.categorise(s.documents, rules, description="text", result_as="category")
    named = s.customer.select(
        F.col("c_nationkey").cast("string").alias("class"), F.col("c_custkey").alias("priority"), F.col("c_name").alias("pattern")
    )
    greeting = s.customer.select("c_custkey", F.concat(F.lit("Dear "), "c_name", F.lit(", hello")).alias("text"))
    letters = D.categorise(greeting, named, description="text", result_as="category")
    return documents.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "category").union(
        letters.select(F.lit("letter"), "c_custkey", "category")
    )


@query
def description_class(s: Source) -> DataFrame:
    return D.categorise(
        s.documents, D.DESCRIPTION_CLASSES, description="text", result_as="category"
    ).select("doc_id", "category")


def _tested(s: Source) -> DataFrame:
    return D.assign_tests(D.categorise(s.document_mapping()))


@query
def test_functions(s: Source) -> DataFrame:
    return _tested(s).select("column_name", F.explode_outer("test_function").alias("test_function"))


@query
def test_types(s: Source) -> DataFrame:
    return _tested(s).select("column_name", F.array_join("test_type", ",").alias("test_types"))


@query
def focused_mapping(s: Source) -> DataFrame:
    return D.focus(_tested(s)).select("column_name", "column_type", "business_category")


@query
def columns_with_test(s: Source) -> DataFrame:
    return D.having_test(D.focus(_tested(s)), "check_duplicates").select("column_name")


@query
def operational_table(s: Source) -> DataFrame:
    return D.operational_table(D.focus(_tested(s))).select(
        "column_name", "test_function", "enabled", "critical"
    )


def _rules(s: Source, *rows: tuple) -> DataFrame:
    return s.spark.createDataFrame(
        [(t, f, a, c, n, c2, json.dumps(e) if e is not None else None) for t, f, a, c, n, c2, e in rows],
        "tcid string, file_name string, is_active boolean, critical boolean, test string, "
        "tested_field string, expected_value string",
    )


def _suite_rules(s: Source, critical: bool = False) -> DataFrame:
    return _rules(
        s,
        ("T01", "orders", True, critical, "check_nulls", "o_custkey", None),
        ("T02", "orders", True, False, "count_records", None, 15_000),
        ("T03", "orders", True, False, "check_duplicates", "o_orderkey", None),
        ("T04", "orders", True, False, "validate_numeric_range", "o_totalprice", {"min": 2000, "max": 400000}),
        ("T05", "orders", True, False, "validate_allowed_values", "o_orderstatus", {"values": ["F", "O", "P"]}),
        ("T06", "orders", True, False, "check_foreign_key", "o_custkey", {"ref_table": "customer", "ref_column": "c_custkey"}),
        ("T07", "orders", True, False, "validate_date_range", "o_orderdate", {"duration": 52, "unit": "WEEKS", "as_of": "2000-01-01"}),
        ("T08", "orders", False, False, "check_nulls", "o_orderstatus", None),
        ("T09", "customer", True, False, "validate_values_length", "c_mktsegment", "CHAR(9)"),
        ("T10", "customer", True, False, "validate_sum", "c_acctbal", {"expected": 1, "scale": 2}),
        ("T11", "customer", True, False, "dtype_consistency", "c_name", "int"),
        ("T12", "customer", True, True, "check_nulls", "c_custkey", None),
        ("T13", "customer", True, False, "check_nulls", "c_missing", None),
        ("T14", "customer", True, False, "no_such_test", "c_name", None),
        ("T15", "lineitem", True, False, "check_consistency", "l_returnflag", {"other_table": "lineitem", "key": "l_orderkey"}),
        ("T16", "lineitem", True, False, "validate_numeric_range", "l_discount", {"min": 0, "max": 0.08}),
    )


def _without_message(results: DataFrame) -> DataFrame:
    """Results without their text, and -1 where nothing was counted."""
    return results.drop("message").withColumn(
        "violations", F.coalesce("violations", F.lit(-1).cast("bigint"))
    )


def _suite(s: Source, critical: bool = False) -> DataFrame:
    tables = {"orders": s.orders_with_gaps(), "customer": s.customer, "lineitem": s.lineitem}
    return suite.run_suite(s.spark, _suite_rules(s, critical), tables)


@query
def status_table(s: Source) -> DataFrame:
    return _without_message(_suite(s))


@query
def status_table_stopped(s: Source) -> DataFrame:
    return _without_message(_suite(s, critical=True))


@query
def dimension_rollup(s: Source) -> DataFrame:
    return suite.dimension_rollup(_suite(s))


@query
def clean_rows(s: Source) -> DataFrame:
    return suite.clean_rows(s.orders_with_gaps(), _suite_rules(s), "orders").select("o_orderkey")


@query
def rejected_rows(s: Source) -> DataFrame:
    return suite.rejected_rows(s.orders_with_gaps(), _suite_rules(s), "orders").select(
        "o_orderkey", F.array_join("failed_rules", ",").alias("failed_rules")
    )


@query
def stored_split_clash(s: Source) -> DataFrame:
    """The clean rows of a table whose own columns are called like those of the split."""
    path = new_shared_path(s.spark, "split")
    orders = s.orders_with_gaps().withColumns(
        {"verdict": F.col("o_orderstatus"), "failed_rules": F.col("o_orderkey") * 2, "Failed_Rules_": F.lit("own")}
    )
    writers.write_split(suite.row_verdicts(orders, _suite_rules(s), "orders"), path)
    return writers.read_clean(s.spark, path).select("o_orderkey", "verdict", "failed_rules", F.col("Failed_Rules_").alias("own"))


@query
def observed_split(s: Source) -> DataFrame:
    """A published run: the status of its rules, and how many rows it stored as clean and rejected."""
    path = new_shared_path(s.spark, "published")
    found = suite.publish_job(s.spark, _suite_rules(s), path, {"orders": s.orders_with_gaps(), "customer": s.customer, "lineitem": s.lineitem})
    data = f"{publish.current(s.spark, path, with_data=True)}/data/orders"
    counts = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("tcid"), F.lit("stored").alias("status"), "violations")
        for name, rows in (("clean", writers.read_clean(s.spark, data)), ("rejected", writers.read_rejected(s.spark, data)))
    ]
    return _without_message(found).select("tcid", "status", "violations").union(counts[0]).union(counts[1])


@query
def stored_split(s: Source) -> DataFrame:
    """Clean and rejected rows after a trip through Parquet."""
    path = new_shared_path(s.spark, "split")
    writers.write_split(suite.row_verdicts(s.orders_with_gaps(), _suite_rules(s), "orders"), path)
    clean = writers.read_clean(s.spark, path).select("o_orderkey", F.lit("clean").alias("verdict"))
    rejected = writers.read_rejected(s.spark, path).select(
        "o_orderkey", F.lit("rejected").alias("verdict")
    )
    return clean.union(rejected)


@query
def suite_with_faults(s: Source) -> DataFrame:
    """Rules that break, and rules of equal ids, beside sound ones: each has its own row."""
    rules = _rules(
        s,
        ("T1", "orders", True, False, "check_nulls", "o_custkey", None),
        ("T1", "lineitem", True, False, "check_nulls", "l_orderkey", None),
        (None, "orders", True, False, "check_nulls", "o_custkey", None),
        ("T2", "orders", True, False, "validate_sum", "huge", 1),
        ("T3", "orders", True, False, "moving_average", "o_totalprice",
         {"partition": "o_custkey", "date": "o_orderdate", "tolerance": "abc", "window": 2}),
        ("T4", "orders", True, False, "check_nulls", "broken", None),
        ("T5", "orders", True, False, "validate_values_length", "o_orderstatus", "VARCHAR(3)"),
        ("T6", "lineitem", True, False, "check_sum", "l_quantity", {"expected": 1, "scale": 2}),
        ("T7", "lineitem", True, False, "validate_allowed_values", "l_partkey", {"ref_table": "parts", "ref_column": "p_partkey"}),
    )
    orders = s.orders_with_gaps().withColumns(
        {
            "huge": F.lit("9" * 38).cast("decimal(38,0)"),
            "broken": F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("broken")).cast("int")),
        }
    )
    tables = {"orders": orders, "lineitem": s.lineitem, "parts": s.part.where("p_size > 10")}
    found = _without_message(suite.run_suite(s.spark, rules, tables))
    return found.withColumn("tcid", F.coalesce("tcid", F.lit("none")))


#: Keyed rules of one table: twenty keys, twenty references, five comparisons.
SHARED_KEYS = [
    ["l_orderkey"], ["l_partkey"], ["l_suppkey"], ["l_linenumber"], ["l_quantity"], ["l_shipdate"], ["l_returnflag"],
    ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey"], ["l_orderkey", "l_suppkey"], ["l_partkey", "l_suppkey"],
    ["l_partkey", "l_linenumber"], ["l_suppkey", "l_linenumber"], ["l_orderkey", "l_shipdate"], ["l_partkey", "l_shipdate"],
    ["l_orderkey", "l_quantity"], ["l_orderkey", "l_extendedprice"], ["l_returnflag", "l_linestatus"],
    ["l_orderkey", "l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber", "l_shipdate"],
]
SHARED_REFERENCES = [
    (column, table, key)
    for column in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    for table, key in (
        ("orders", "o_custkey"), ("part", "p_partkey"), ("supplier", "s_suppkey"), ("customer", "c_custkey"), ("orders", "l_orderkey"),
    )
]
SHARED_VALUES = [
    ("l_linestatus", "o_orderstatus"), ("l_returnflag", "o_orderstatus"), ("l_extendedprice", "o_totalprice"),
    ("l_shipdate", "o_orderdate"), ("l_partkey", "o_custkey"),
]


def shared_scan_rules(s: Source) -> tuple[DataFrame, dict[str, DataFrame]]:
    """45 rules on the keys of line items, and the five tables that they name."""
    rules = [
        *[("check_duplicates", None, {"keys": keys}) for keys in SHARED_KEYS],
        *[("check_foreign_key", c, {"ref_table": t, "ref_column": k}) for c, t, k in SHARED_REFERENCES],
        *[
            ("check_consistency", c, {"other_table": "orders", "key": "l_orderkey", "column2": c2})
            for c, c2 in SHARED_VALUES
        ],
    ]
    listed = [(f"K{i:02d}", "lineitem", True, False, *rule) for i, rule in enumerate(rules)]
    tables = {t: getattr(s, t) for t in ("lineitem", "part", "supplier", "customer")}
    return _rules(s, *listed), tables | {"orders": s.orders.withColumnRenamed("o_orderkey", "l_orderkey")}


@query
def suite_shared_scan(s: Source) -> DataFrame:
    """All keyed rules of a table by readings of each table that they share."""
    return _without_message(suite.run_suite(s.spark, *shared_scan_rules(s)))


@query
def key_verdicts(s: Source) -> DataFrame:
    """Rows rejected for their keys: repeated ones, orphans, and those that differ in a second table."""
    rules = _rules(
        s,
        ("T1", "orders", True, False, "check_duplicates", None, {"keys": ["o_custkey", "o_orderdate"]}),
        ("T2", "orders", True, False, "check_foreign_key", "o_custkey", {"ref_table": "customer", "ref_column": "c_custkey"}),
        ("T3", "orders", True, False, "check_consistency", "o_orderstatus", {"other_table": "corrected", "key": "o_orderkey"}),
        ("T4", "orders", True, False, "check_nulls", "o_custkey", None),
        ("T5", "orders", True, False, "check_duplicates", "o_orderkey", None),
    )
    tables = {"customer": s.solvent_customers(), "corrected": s.orders_corrected()}
    found = suite.rejected_rows(s.orders_with_gaps(), rules, "orders", tables)
    return found.select("o_orderkey", F.concat_ws(",", F.array_sort("failed_rules")).alias("failed_rules"))


@query
def status_report(s: Source) -> DataFrame:
    """The written report, read back with its messages."""
    path = new_shared_path(s.spark, "status")
    rules = _rules(
        s,
        ("T1", "lineitem", True, False, "check_nulls", "l_orderkey", None),
        ("T2", "lineitem", True, False, "count_records", None, 1),
        ("T3", "lineitem", True, False, "no_such_test", "l_orderkey", None),
    )
    writers.write_status(suite.run_suite(s.spark, rules, {"lineitem": s.lineitem}), path)
    report = readers.read_csv(s.spark, path, multiline=True)
    return report.select(
        F.col("`Test Case ID`").alias("tcid"), F.col("File").alias("file_name"),
        F.col("Test").alias("test"), F.col("Status").alias("status"), F.col("Message").alias("message"),
    )


@query
def csv_suite(s: Source) -> DataFrame:
    """Counts and nulls of whole texts are the same from CSV, line breaks and all."""
    folder = new_shared_path(s.spark, "suite")
    writers.write_csv(s.documents, f"{folder}/documents.csv")
    rules = _rules(
        s,
        ("T1", "documents.csv", True, False, "count_records", None, 1),
        ("T2", "documents.csv", True, False, "check_nulls", "text", None),
        ("T3", "documents.csv", True, False, "check_duplicates", "text", None),
    )
    options = {"multiline": True, "keep_empty": True}
    return suite.run_suite(s.spark, rules, base_path=folder, csv=options).select("tcid", "status", "violations")


@query
def csv_malformed(s: Source) -> DataFrame:
    """A file with lines of too many and too few cells: what the rules say, and the lines that are rejected."""
    folder = new_shared_path(s.spark, "malformed")
    cells = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus")
    short = F.concat_ws(",", "o_orderkey", "o_custkey")
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    line = F.when(urgent, F.concat(cells, F.lit(",more"))).when(high, short).otherwise(cells)
    lines = s.orders.select(line.alias("o_orderkey,o_custkey,o_orderstatus"))
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(f"{folder}/orders.csv")
    rules = _rules(
        s,
        ("T1", "orders.csv", True, False, "check_malformed", None, None),
        ("T2", "orders.csv", True, False, "count_records", None, 1),
        ("T3", "orders.csv", True, False, "check_nulls", "o_orderstatus", None),
    )
    found = _without_message(suite.run_suite(s.spark, rules, base_path=folder, csv={"keep_malformed": True}))
    table = readers.read_csv(s.spark, f"{folder}/orders.csv", keep_malformed=True)
    rejected = suite.rejected_rows(table, rules.where("tcid = 'T1'"), "orders.csv")
    return found.select("tcid", F.concat_ws(" ", "status", "violations").alias("value")).union(
        rejected.select(F.lit("line"), "malformed_line")
    )


@query
def csv_roundtrip(s: Source) -> DataFrame:
    """Whole texts, line breaks and quotes included, through a CSV dictionary."""
    path = new_shared_path(s.spark, "csv")
    writers.write_csv(s.documents, path)
    return readers.read_csv(s.spark, path, multiline=True, keep_empty=True)


@query
def csv_inferred(s: Source) -> DataFrame:
    path = new_shared_path(s.spark, "csv")
    writers.write_csv(s.orders, path)
    return readers.read_csv(s.spark, path, infer_types=True).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_totalprice",
        "o_orderstatus",
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
    )
