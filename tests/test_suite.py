from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from truegrain import publish_job, run_job, run_suite
from truegrain.operators import keyed
from truegrain.operators.keyed import evaluate_keyed
from truegrain.plans import suite
from truegrain.plans.rules import TESTS, Context, build_frame, parameters
from truegrain.sources import publish, readers, writers

RULE = "tcid string, file_name string, is_active boolean, critical boolean, test string, tested_field string, expected_value string"


def rules_of(spark, *rows):
    return spark.createDataFrame(
        [
            (f"T{i:02d}", file, True, critical, test, field, expected if expected is None or isinstance(expected, str) else json.dumps(expected))
            for i, (file, critical, test, field, expected) in enumerate(rows)
        ],
        RULE,
    )


@pytest.fixture
def loans(spark):
    return spark.createDataFrame(
        [(1, "A", 10.0, "2024-01-01"), (2, None, 20.0, "2024-01-02"), (3, "C", None, "bad"), (3, "A", 900.0, None)],
        "id int, grade string, amount double, day string",
    )


def test_every_test_runs_from_a_rule(spark, loans, tmp_path):
    (tmp_path / "f.txt").write_text("x")
    folder = str(tmp_path)
    expected = {
        "check_nulls": ("grade", None),
        "count_records": (None, 4),
        "check_duplicates": ("id", None),
        "duplicated_files_by_name_and_size": (None, {"path": folder}),
        "duplicated_files_current_path": (None, folder),
        "find_duplicate_columns": (None, {"verify": False}),
        "check_consistency": ("grade", {"other_table": "other", "key": "id"}),
        "dtype_consistency": ("day", "date"),
        "check_foreign_key": ("id", {"ref_table": "other", "ref_column": "id"}),
        "validate_numeric_range": ("amount", {"min": 0, "max": 100}),
        "validate_values_length": ("grade", "CHAR(1)"),
        "validate_allowed_values": ("grade", ["A", "B"]),
        "validate_date_format": ("day", {"format": "yyyy-MM-dd", "ignore_nulls": True}),
        "file_timeliness": (None, {"path": folder, "hours": 1}),
        "validate_date_range": ("day", {"duration": 1, "unit": "DAY", "as_of": "2024-01-02"}),
        "validate_sum": ("amount", 930),
        "check_sum": ("amount", {"expected": 931, "tolerance": 1}),
        "moving_average": ("amount", {"partition": "grade", "date": "day", "tolerance": 5, "window": 2}),
        "detect_outliers": ("amount", None),
    }
    assert {*expected, "check_malformed"} == set(TESTS)  # that one needs a file
    rules = rules_of(spark, *[("loans", False, t, f, e) for t, (f, e) in expected.items()])
    tables = {"loans": loans, "other": loans.where("id < 3")}
    found = {
        test: status
        for test, status in zip(expected, [r["status"] for r in run_suite(spark, rules, tables).orderBy("tcid").collect()])
    }
    failed = {
        "check_nulls", "check_duplicates", "dtype_consistency", "check_foreign_key",
        "validate_numeric_range", "validate_allowed_values", "validate_date_format", "moving_average",
    }
    assert {t for t, s in found.items() if s == "Failed"} == failed
    assert {t for t, s in found.items() if s == "Passed"} == set(expected) - failed


@pytest.mark.parametrize(
    ("test", "field", "expected", "part"),
    [
        ("no_such_test", "grade", None, "unknown test"),
        ("check_nulls", "no_such_column", None, "does not exist"),
        ("check_nulls", None, None, "tested field"),
        ("validate_numeric_range", "amount", {"min": 1}, "missing parameter: max"),
        ("validate_numeric_range", "amount", {"min": 1, "max": "9"}, "must be a number"),
        ("validate_numeric_range", "amount", "{bad json", "not valid JSON"),
        ("validate_numeric_range", "amount", {"min": 1, "max": 2, "maxx": 3}, "unknown parameter: maxx"),
        ("validate_values_length", "grade", "VARCHAR(3)", "unknown type"),
        ("dtype_consistency", "amount", "date", "DATATYPE_MISMATCH"),
        ("dtype_consistency", "amount", "no_type", ""),
        ("validate_date_format", "day", "YYYY-qq", ""),
        ("validate_date_range", "day", {"duration": 1, "unit": "DECADE"}, "unknown time unit"),
        ("validate_date_range", "amount", {"duration": 1, "unit": "DAY"}, "not a date"),
        ("check_foreign_key", "id", {"ref_table": "nowhere", "ref_column": "id"}, "unknown file"),
        ("check_consistency", "id", {"other_table": "loans", "key": "nothing"}, "does not exist"),
        ("validate_allowed_values", "grade", {"values": "A"}, "must be a list"),
        ("validate_values_length", "grade", {"type": "CHAR(1)", "strict": "no"}, "true or false"),
    ],
)
def test_a_broken_rule_is_an_error_and_disturbs_nothing(spark, loans, test, field, expected, part):
    rules = rules_of(spark, ("loans", False, test, field, expected), ("loans", False, "check_nulls", "grade", None))
    broken, sound = run_suite(spark, rules, {"loans": loans}).orderBy("tcid").collect()
    assert broken["status"] == "Error" and broken["violations"] is None
    assert part in broken["message"]
    assert (sound["status"], sound["violations"]) == ("Failed", 1)


def test_inactive_rules_do_not_run(spark, loans):
    rules = rules_of(spark, ("loans", False, "check_nulls", "grade", None)).withColumn("is_active", F.lit(False))
    assert run_suite(spark, rules, {"loans": loans}).count() == 0


def test_a_failed_critical_rule_stops_the_rest(spark, loans):
    rules = rules_of(
        spark,
        ("loans", False, "check_nulls", "id", None),
        ("loans", True, "check_nulls", "grade", None),
        ("loans", True, "check_nulls", "id", None),
    )
    statuses = [r["status"] for r in run_suite(spark, rules, {"loans": loans}).orderBy("tcid").collect()]
    assert statuses == ["Skipped", "Failed", "Passed"]
    passing = rules.where("tcid <> 'T01'")
    assert [r["status"] for r in run_suite(spark, passing, {"loans": loans}).collect()] == ["Passed", "Passed"]


ROW_RULES = (
    ("loans", False, "check_nulls", "grade", None),
    ("loans", False, "validate_numeric_range", "amount", {"min": 0, "max": 100}),
    ("loans", False, "validate_date_format", "day", "yyyy-MM-dd"),
    ("loans", False, "count_records", None, 4),
    ("other", False, "check_nulls", "amount", None),
)


def test_clean_and_rejected_rows_are_all_rows(spark, loans):
    rules = rules_of(spark, *ROW_RULES)
    clean = suite.clean_rows(loans, rules, "loans")
    rejected = suite.rejected_rows(loans, rules, "loans")
    assert clean.columns == loans.columns
    assert clean.count() + rejected.count() == loans.count()
    assert [tuple(r["failed_rules"]) for r in rejected.orderBy("id", "amount").collect()] == [
        ("T00",), ("T02",), ("T01", "T02"),
    ]
    judged = suite.row_verdicts(loans, rules, "loans")
    assert "Exchange" not in judged._jdf.queryExecution().executedPlan().toString()


def test_job_writes_report_and_split(spark, loans, tmp_path):
    rules = rules_of(spark, *ROW_RULES[:4])
    results = run_job(spark, rules, str(tmp_path / "out"), {"loans": loans})
    assert [r["status"] for r in results.orderBy("tcid").collect()] == ["Failed", "Failed", "Failed", "Passed"]
    report = readers.read_csv(spark, str(tmp_path / "out/status_table"))
    assert report.columns == ["Test Case ID", "File", "Test", "Status", "Message"]
    assert report.count() == 4
    stored = str(tmp_path / "out/data/loans")
    assert [r["id"] for r in writers.read_clean(spark, stored).collect()] == [1]
    assert writers.read_rejected(spark, stored).count() == 3


def test_job_withholds_rows_after_a_critical_failure(spark, loans, tmp_path):
    rules = rules_of(spark, ("loans", True, "check_nulls", "grade", None))
    run_job(spark, rules, str(tmp_path / "out"), {"loans": loans})
    assert (tmp_path / "out/status_table").exists()
    assert not (tmp_path / "out/data").exists()


def test_dimensions(spark, loans):
    rules = rules_of(spark, *ROW_RULES[:4])
    found = {(r["dimension"], r["status"]): r["n"] for r in suite.dimension_rollup(run_suite(spark, rules, {"loans": loans})).collect()}
    assert found == {("Completeness", "Failed"): 1, ("Completeness", "Passed"): 1, ("Validations", "Failed"): 2}


def test_rules_and_tables_from_files(spark, loans, tmp_path):
    loans.write.parquet(str(tmp_path / "loans.parquet"))
    writers.write_csv(loans, str(tmp_path / "loans.csv"))
    (tmp_path / "rules_csv.csv").write_text(
        "File_Name,TCID,Enabled,test,tested_field,expected_value\n"
        "loans.parquet,A,1,check_nulls,grade,\n"
        'loans.csv,B,True,validate_numeric_range,amount,"{""min"":0,""max"":100}"\n'
        "loans.csv,C,0,check_nulls,grade,\n"
        "gone.parquet,D,1,check_nulls,grade,\n"
    )
    rules = readers.read_rules(spark, str(tmp_path / "rules_csv.csv"))
    found = run_suite(spark, rules, base_path=str(tmp_path)).orderBy("tcid").collect()
    assert [(r["tcid"], r["status"]) for r in found] == [("A", "Failed"), ("B", "Failed"), ("D", "Error")]
    assert "cannot read" in found[2]["message"]


def stored_files(output):
    return sorted(p.name for p in (output / "data").iterdir()) if (output / "data").exists() else []


def named_rules(spark, *rows):
    return spark.createDataFrame(
        [(t, f, True, c, test, field, e if e is None or isinstance(e, str) else json.dumps(e)) for t, f, c, test, field, e in rows], RULE
    )


def test_equal_ids_of_two_files_do_not_hide_a_critical_failure(spark, loans, tmp_path):
    rules = named_rules(
        spark,
        ("T1", "f", True, "check_nulls", "grade", None),
        ("T1", "g", True, "check_nulls", "id", None),
        ("T2", "g", False, "check_nulls", "id", None),
    )
    found = run_job(spark, rules, str(tmp_path / "out"), {"f": loans, "g": loans}).collect()
    assert sorted((r["tcid"], r["file_name"], r["status"]) for r in found) == [
        ("T1", "f", "Failed"), ("T1", "g", "Passed"), ("T2", "g", "Skipped"),
    ]
    assert stored_files(tmp_path / "out") == []


@pytest.mark.parametrize("tcid", [None, "", "  "])
def test_a_rule_without_id_is_an_error_and_stores_nothing(spark, loans, tmp_path, tcid):
    rules = named_rules(
        spark,
        (tcid, "f", False, "validate_numeric_range", "amount", {"min": 0, "max": 100}),
        ("T2", "g", False, "check_nulls", "grade", None),
    )
    found = run_job(spark, rules, str(tmp_path / "out"), {"f": loans, "g": loans}).collect()
    assert {r["file_name"]: r["status"] for r in found} == {"f": "Error", "g": "Failed"}
    assert stored_files(tmp_path / "out") == ["g"]
    with pytest.raises(suite.RuleError):
        suite.clean_rows(loans, rules, "f").count()


def test_an_error_rule_of_one_file_leaves_the_others_stored(spark, loans, tmp_path):
    rules = named_rules(
        spark,
        ("T1", "f", False, "check_nulls", "no_such_column", None),
        ("T1", "g", False, "check_nulls", "grade", None),
    )
    run_job(spark, rules, str(tmp_path / "out"), {"f": loans, "g": loans})
    assert stored_files(tmp_path / "out") == ["g"]
    assert readers.read_table(spark, str(tmp_path / "out" / "data" / "g")).count() == loans.count()


def test_a_sum_beyond_the_widest_decimal_fails_alone(spark):
    big = spark.createDataFrame([("9" * 38,), ("9" * 38,)], "t string").selectExpr("cast(t as decimal(38,0)) as v", "t")
    rules = named_rules(
        spark,
        ("T1", "f", False, "validate_sum", "v", 5),
        ("T2", "f", False, "check_nulls", "v", None),
    )
    found = {r["tcid"]: r["status"] for r in run_suite(spark, rules, {"f": big}).collect()}
    assert found == {"T1": "Failed", "T2": "Passed"}


def test_tolerance_must_be_a_number(spark, loans):
    rules = named_rules(
        spark,
        ("T1", "f", False, "moving_average", "amount", {"partition": "grade", "date": "day", "tolerance": "abc", "window": 2}),
        ("T2", "f", False, "check_nulls", "id", None),
    )
    found = {r["tcid"]: (r["status"], r["message"]) for r in run_suite(spark, rules, {"f": loans}).collect()}
    assert found["T1"][0] == "Error" and "tolerance" in found["T1"][1]
    assert found["T2"][0] == "Passed"


def test_a_failure_while_running_is_one_error_row(spark, loans):
    broken = loans.withColumn("boom", F.when(F.col("id") > 2, F.raise_error(F.lit("no luck")).cast("int")).otherwise(1))
    rules = named_rules(
        spark,
        ("T1", "f", False, "check_nulls", "boom", None),
        ("T2", "f", False, "check_nulls", "id", None),
        ("T3", "f", False, "check_duplicates", "boom", None),
        ("T4", "f", False, "check_duplicates", "id", None),
        ("T5", "g", False, "check_nulls", "id", None),
    )
    found = {r["tcid"]: r["status"] for r in run_suite(spark, rules, {"f": broken, "g": loans}).collect()}
    assert found == {"T1": "Error", "T2": "Passed", "T3": "Error", "T4": "Failed", "T5": "Passed"}


def test_a_suite_leaves_no_folders(spark, loans):
    from pathlib import Path

    from truegrain.session import shared_folder

    def digests():
        return list(Path(shared_folder(spark).removeprefix("file:")).glob("digests-*"))

    before = digests()
    rules = named_rules(spark, ("T1", "f", False, "check_duplicates", "grade", None))
    assert run_suite(spark, rules, {"f": loans}).first()["violations"] == 1
    assert digests() == before


def keyed_rules(spark, count):
    keys = ["grade", "amount", "day", "id"]
    rows = [("loans", False, "check_duplicates", None, {"keys": keys[: 1 + i % 4]}) for i in range(count)]
    rows += [("loans", False, "check_foreign_key", keys[i % 4], {"ref_table": "other", "ref_column": keys[i % 4]}) for i in range(count)]
    rows += [("loans", False, "check_consistency", keys[i % 3], {"other_table": "other", "key": "id"}) for i in range(count)]
    return rules_of(spark, *rows)


def test_keyed_rules_read_each_table_once(spark, loans, tmp_path):
    loans.write.parquet(str(tmp_path / "a"))
    loans.where("id < 3").write.parquet(str(tmp_path / "b"))
    tables = {"loans": spark.read.parquet(str(tmp_path / "a")), "other": spark.read.parquet(str(tmp_path / "b"))}
    context = Context(spark, suite.table_lookup(spark, tables, None))
    for count in (1, 9):
        planned = [suite._plan(r, context) for r in suite.active_rules(keyed_rules(spark, count))]
        assert len(planned) == 3 * count and all(p.keyed for p in planned)
        plan = evaluate_keyed([p.keyed for p in planned])
        plan.collect()
        final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan") == 2


def test_keyed_rules_agree_with_plans_of_their_own(spark, loans):
    odd = loans.union(loans.where("id > 2")).withColumns({"n": F.when(F.col("id") % 2 == 0, F.col("id")), "f": F.col("id") / 2})
    other = loans.selectExpr("cast(id as int) id", "grade", "cast(amount as string) amount", "day", "cast(id as double) f", "id n")
    rules = rules_of(
        spark,
        *[("loans", False, "check_duplicates", None, {"keys": k}) for k in (["id"], ["n"], ["grade", "n"], ["n", "grade"], ["f"])],
        *[("loans", False, "check_foreign_key", c, {"ref_table": "other", "ref_column": r}) for c, r in (("id", "id"), ("n", "f"), ("f", "n"), ("amount", "amount"), ("id", "amount"))],
        *[("loans", False, "validate_allowed_values", c, {"ref_table": "other", "ref_column": r}) for c, r in (("grade", "grade"), ("n", "f"))],
        *[("loans", False, "check_consistency", c, {"other_table": "other", "key": k, "null_safe": s}) for c, k, s in (("grade", "id", True), ("amount", "id", False), ("f", ["id", "grade"], False), ("n", "f", True))],
    )
    tables = {"loans": odd, "other": other}
    context = Context(spark, suite.table_lookup(spark, tables, None))
    listed = suite.active_rules(rules)
    found = sorted(map(tuple, run_suite(spark, rules, tables).collect()))
    alone = [build_frame(context, odd, r, parameters(r)).collect()[0] for r in listed]
    assert found == sorted(map(tuple, alone)) and len(found) == 16


def test_digests_that_clash_are_counted_by_the_rule_itself(spark, loans, monkeypatch):
    monkeypatch.setattr(keyed, "_hashes", lambda columns: (F.lit(7).cast("bigint"), F.lit(7).cast("bigint"), F.xxhash64(*keyed._marked(columns))))
    rules = rules_of(spark, ("loans", False, "check_duplicates", "id", None), ("loans", False, "check_duplicates", "grade", None))
    found = {r["tested_field"]: r["violations"] for r in run_suite(spark, rules, {"loans": loans}).collect()}
    groups = loans.groupBy("grade").count().where("count > 1").count()
    assert found == {"id": loans.groupBy("id").count().where("count > 1").count(), "grade": groups}


def test_a_rule_that_breaks_costs_few_passes(spark, loans):
    broken = loans.withColumn("bad", F.when(F.col("id") >= 0, F.raise_error(F.lit("broken")).cast("int")))
    rules = rules_of(spark, *[("loans", False, "check_nulls", "grade", None)] * 20, ("loans", False, "check_nulls", "bad", None))
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("fallback", "fallback")
    found = run_suite(spark, rules, {"loans": broken}).collect()
    jobs = len(tracker.getJobIdsForGroup("fallback"))
    context.setJobGroup("", "")
    assert sorted(r["status"] for r in found) == ["Error"] + ["Failed"] * 20
    assert jobs < 20  # a pass takes two; one for each rule took 46


def test_columns_called_like_those_of_the_split(spark, loans, tmp_path):
    named = loans.withColumns({"verdict": F.lit("mine"), "Failed_Rules": F.col("id") * 2})
    rules = rules_of(spark, *ROW_RULES[:4])
    assert suite.clean_rows(named, rules, "loans").columns == named.columns
    assert suite.rejected_rows(named, rules, "loans").columns == [*named.columns, "failed_rules_"]
    with pytest.raises(suite.RuleError):
        suite.row_verdicts(named, rules, "loans", "failed_rules")
    run_job(spark, rules, str(tmp_path / "out"), {"loans": named})
    stored = str(tmp_path / "out/data/loans")
    clean = writers.read_clean(spark, stored)
    assert clean.columns == named.columns
    assert [tuple(r) for r in clean.select("id", "verdict", "Failed_Rules").collect()] == [(1, "mine", 2)]
    rejected = writers.read_rejected(spark, stored)
    assert rejected.columns == [*named.columns, "failed_rules_"]
    assert {r["verdict"] for r in rejected.collect()} == {"mine"} and rejected.count() == 3


def test_the_split_is_judged_while_it_is_written(spark, loans, tmp_path, monkeypatch):
    rules = rules_of(spark, *ROW_RULES[:3], ("loans", True, "count_records", None, 4), ("loans", False, "validate_sum", "amount", 930))
    expected = sorted(map(tuple, run_suite(spark, rules, {"loans": loans}).collect()))
    monkeypatch.setattr(suite, "evaluate", None)  # nothing else reads the table
    found = run_job(spark, rules, str(tmp_path / "out"), {"loans": loans})
    assert sorted(map(tuple, found.collect())) == expected
    assert stored_files(tmp_path / "out") == ["loans"]


def test_a_failed_critical_rule_leaves_no_data(spark, loans, tmp_path):
    out = tmp_path / "out"
    for rule in (("loans", True, "check_nulls", "grade", None), ("loans", True, "check_duplicates", "id", None)):
        rules = rules_of(spark, ("loans", False, "check_nulls", "id", None), rule)
        found = run_job(spark, rules, str(out), {"loans": loans}).orderBy("tcid").collect()
        assert [r["status"] for r in found] == ["Skipped", "Failed"]
        assert sorted(p.name for p in out.iterdir()) == ["status_table"]


def test_a_run_that_fails_leaves_the_version_before(spark, loans, tmp_path, monkeypatch):
    out, rules = str(tmp_path / "out"), rules_of(spark, *ROW_RULES[:4])
    publish_job(spark, rules, out, {"loans": loans})
    before = publish.current(spark, out)

    def broken(*args):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(suite, "replace_folder", broken)
        with pytest.raises(OSError):
            publish_job(spark, rules, out, {"loans": loans.where("id = 1")})
    assert publish.current(spark, out) == before
    assert writers.read_clean(spark, f"{before}/data/loans").count() == 1
    stopping = rules_of(spark, ("loans", True, "check_nulls", "grade", None))
    publish_job(spark, stopping, out, {"loans": loans})
    assert publish.current(spark, out) != before == publish.current(spark, out, with_data=True)
    publish_job(spark, rules, out, {"loans": loans.where("id = 1")})
    after = publish.current(spark, out, with_data=True)
    assert readers.read_csv(spark, f"{after}/status_table").count() == 4
    assert publish.retire(spark, out, keep=1) == 2
    assert publish.current(spark, out) == after and writers.read_clean(spark, f"{after}/data/loans").count() == 1
    with pytest.raises(suite.RuleError):
        publish.current(spark, str(tmp_path / "nothing"))


def test_rows_with_broken_keys_are_rejected(spark, loans):
    named = loans.withColumns({"n": F.when(F.col("id") > 1, F.col("id")), "__broken9": F.lit(1)})
    rules = rules_of(
        spark,
        ("loans", False, "check_duplicates", "id", None),
        ("loans", False, "check_foreign_key", "n", {"ref_table": "other", "ref_column": "id"}),
        ("loans", False, "check_consistency", "grade", {"other_table": "other", "key": "id"}),
        ("loans", False, "check_nulls", "grade", None),
        ("other", False, "check_duplicates", "id", None),
    )
    other = spark.createDataFrame([(1, "B"), (2, "x"), (2, "y")], "id bigint, grade string")
    found = suite.row_verdicts(named, rules, "loans", tables={"other": other})
    assert found.columns == [*named.columns, "failed_rules"]
    by_id = sorted((r["id"], r["grade"] or "", sorted(r["failed_rules"])) for r in found.collect())
    assert by_id == [(1, "A", ["T02"]), (2, "", ["T03"]), (3, "A", ["T00", "T01"]), (3, "C", ["T00", "T01"])]
    assert suite.clean_rows(named, rules, "loans", {"other": other}).count() == 0
    assert suite.clean_rows(named, rules, "loans").count() == 3
    with pytest.raises(suite.RuleError):
        suite.row_verdicts(named, rules, "loans", tables={})


def many_keyed_rules(spark):
    keys = (["a"], ["b"], ["t"], ["f"], ["a", "b"], ["b", "a"], ["a", "t"], ["t", "f"], ["f", "n"], ["a", "b", "t"])
    links = (("a", "a"), ("a", "n"), ("b", "a"), ("n", "b"), ("t", "t"), ("f", "a"))
    values = (("t", "a", False), ("b", "a", True), ("f", "t", False), ("n", ["a", "t"], True))
    return rules_of(
        spark,
        *[("loans", False, "check_duplicates", None, {"keys": k}) for k in keys],
        *[("loans", False, "check_foreign_key", c, {"ref_table": "other", "ref_column": r}) for c, r in links],
        *[("loans", False, "check_consistency", c, {"other_table": "other", "key": k, "null_safe": s}) for c, k, s in values],
    )


@pytest.mark.parametrize("hot_least", [3, 10, 10_000])
def test_dealt_rules_agree_with_plans_of_their_own(spark, monkeypatch, hot_least):
    monkeypatch.setattr(keyed, "DEAL_FROM", 1)
    monkeypatch.setattr(keyed, "_HOT_LEAST", hot_least)
    monkeypatch.setattr(keyed, "_FEW", 1)
    rows = spark.range(400).selectExpr(
        "if(id % 3 = 0, null, id % 90) a", "cast(id % 7 as int) b", "if(id % 11 = 0, null, concat('t', id % 50)) t",
        "if(id % 13 = 0, double('nan'), id % 40 - 0.0) f", "if(id % 5 = 0, null, cast(id % 60 as int)) n",
    )
    other = rows.where("a > 20 or t > 't3'").selectExpr("a + 1 a", "b", "t", "f * 2 f", "n").union(rows.limit(9))
    tables = {"loans": rows, "other": other}
    rules = many_keyed_rules(spark)
    context = Context(spark, suite.table_lookup(spark, tables, None))
    alone = [build_frame(context, rows, r, parameters(r)).collect()[0] for r in suite.active_rules(rules)]
    assert sorted(map(tuple, run_suite(spark, rules, tables).collect())) == sorted(map(tuple, alone))


def test_rows_are_sent_once_for_the_rules_of_a_column(spark, monkeypatch, tmp_path):
    """What is sent grows with the rows, not with rules on keys that share a column."""
    spark.range(60_000).selectExpr("id a", "hash(id) b", "xxhash64(id) c", "id * 7 d").write.parquet(str(tmp_path / "loans"))
    tables = {"loans": spark.read.parquet(str(tmp_path / "loans"))}
    keys = (["a"], ["a", "b"], ["a", "c"], ["a", "d"], ["a", "b", "c"], ["a", "b", "d"], ["a", "c", "d"], ["a", "b", "c", "d"])
    monkeypatch.setattr(keyed, "DEAL_FROM", 1)
    rules = rules_of(spark, *[("loans", False, "check_duplicates", None, {"keys": k}) for k in keys])
    context = Context(spark, suite.table_lookup(spark, tables, None))
    checks = [suite._plan(r, context).keyed for r in suite.active_rules(rules)]
    plan = evaluate_keyed(checks)
    assert {r["violations"] for r in plan.collect()} == {0}
    # No record is sent for a rule: all rules are dealt by the one column, each row once.
    tables = keyed._tables(checks)
    (deal,) = keyed._deals(tables)
    assert deal.checks == set(range(len(keys))) and not deal.hot
    assert keyed._combined(tables, [deal], (4, 0)) is None
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("REPARTITION_BY_NUM") == 1
