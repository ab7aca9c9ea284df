from __future__ import annotations

import os
from datetime import datetime, timezone

import pytest

import truegrain as tg
from truegrain.operators import files
from truegrain.session import new_shared_path, shared_folder
from truegrain.sources import readers, writers


@pytest.fixture
def folder(tmp_path):
    for name, text in (
        ("a.txt", "one"), ("b.txt", "two"), ("sub/a.txt", "ONE"), ("sub/deep/a.txt", "eno"),
        ("sub/b.txt", "longer"), ("sub/c.txt", "one"),
    ):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return tmp_path


def test_repeated_files_all_but_the_first(spark, folder, outcome):
    found = files.duplicate_files(readers.file_listing(spark, str(folder))).collect()
    assert sorted(r["path"].removeprefix(f"file:{folder}/") for r in found) == ["sub/a.txt", "sub/deep/a.txt"]
    result = tg.duplicated_files_by_name_and_size(spark, str(folder))
    assert outcome(result) == ("Failed", 2)
    assert outcome(tg.duplicated_files_current_path(spark, str(folder))) == ("Passed", 0)


def test_listing_of_one_folder_only(spark, folder):
    names = {r["file_name"] for r in readers.file_listing(spark, str(folder), recursive=False).collect()}
    assert names == {"a.txt", "b.txt"}
    assert readers.file_listing(spark, str(folder)).count() == 6


def test_listing_reads_no_contents(spark, folder):
    plan = readers.file_listing(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_timeliness(spark, folder, outcome):
    target = folder / "a.txt"
    written = datetime(2024, 1, 1, 12, tzinfo=timezone.utc).timestamp()
    os.utime(target, (written, written))
    path = str(target)
    assert outcome(tg.file_timeliness(spark, path, 24, "2024-01-02 12:00:00")) == ("Passed", 0)
    assert outcome(tg.file_timeliness(spark, path, 24, "2024-01-02 12:00:01")) == ("Failed", 1)
    assert outcome(tg.file_timeliness(spark, path)) == ("Failed", 1)
    assert outcome(tg.file_timeliness(spark, str(folder / "sub"))) == ("Passed", 0)
    assert outcome(tg.file_timeliness(spark, str(folder / "*.txt"), 1)) == ("Failed", 1)
    missing = tg.file_timeliness(spark, str(folder / "gone"))
    assert outcome(missing) == ("Failed", 1)
    assert "does not exist" in missing.first()["message"]


def test_csv_keeps_breaks_quotes_blanks_and_nulls(spark, tmp_path):
    rows = [("a\nb", ' "x", y '), ("c,d", "\\e"), (None, "é")]
    df = spark.createDataFrame(rows, "t string, u string")
    path = str(tmp_path / "t")
    writers.write_csv(df, path)
    assert sorted(map(str, readers.read_dictionary(spark, path).collect())) == sorted(map(str, df.collect()))
    writers.write_csv(spark.createDataFrame([("", "x")], "t string, u string"), path)
    assert tuple(readers.read_dictionary(spark, path).first()) == (None, "x")


def test_csv_with_mark_and_windows_line_ends(spark, tmp_path):
    df = spark.createDataFrame([("x", ["p", "q"])], "n string, l array<string>")
    path = str(tmp_path / "marked")
    writers.write_csv(df, path, byte_order_mark=True)
    back = readers.read_dictionary(spark, path)
    assert back.columns == ["n", "l"]
    assert writers.read_lists(back, "l").first()["l"] == ["p", "q"]
    (tmp_path / "w.csv").write_bytes("﻿a,b\r\n1,\"x\r\ny\"\r\n2,z\r\n".encode())
    read = readers.read_dictionary(spark, str(tmp_path / "w.csv"))
    assert read.columns == ["a", "b"] and read.count() == 2


def test_csv_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y\n")
    path = str(tmp_path / "t.csv")
    assert dict(readers.read_csv(spark, path).dtypes) == {"a": "string", "b": "string"}
    assert dict(readers.read_csv(spark, path, infer_types=True).dtypes)["a"] == "int"
    assert dict(readers.read_csv(spark, path, schema="a bigint, b string").dtypes)["a"] == "bigint"
    assert dict(readers.read_table(spark, path).dtypes)["a"] == "string"


def test_schema_table(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert [tuple(r) for r in readers.schema_table(df).collect()] == [("a", "int", 0), ("b", "string", 1)]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert new_shared_path(spark, "x").startswith(named)


def test_lists_and_empty_texts_survive_csv(spark, tmp_path):
    rows = [(1, ["a|b", "c\\", "", "d\\|e"], ""), (2, ["x"], None), (3, ["line\nbreak"], "t\nu")]
    path = str(tmp_path / "t.csv")
    writers.write_csv(spark.createDataFrame(rows, "i int, l array<string>, t string"), path)
    read = writers.read_lists(readers.read_csv(spark, path, multiline=True, keep_empty=True), "l")
    assert sorted((int(r["i"]), r["l"], r["t"]) for r in read.collect()) == rows
    assert readers.read_csv(spark, path, multiline=True).where("t is null").count() == 2


def test_suite_reads_csv_with_breaks_and_empty_texts(spark, tmp_path):
    rows = [("1", "a\nb"), ("2", ""), ("3", None)]
    writers.write_csv(spark.createDataFrame(rows, "i string, t string"), str(tmp_path / "t.csv"))
    rules = spark.createDataFrame(
        [("T1", "t.csv", "count_records", None, "3"), ("T2", "t.csv", "check_nulls", "t", None)],
        "tcid string, file_name string, test string, tested_field string, expected_value string",
    )
    options = {"multiline": True, "keep_empty": True}
    found = tg.run_suite(spark, rules, base_path=str(tmp_path), csv=options).orderBy("tcid").collect()
    assert [(r["status"], r["violations"]) for r in found] == [("Passed", 0), ("Failed", 1)]


def test_malformed_lines_are_counted_and_kept(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,malformed_line\n1,2,x\n3,4,5,6\n7\n8,,y\n")
    path = str(tmp_path / "t.csv")
    df = readers.read_csv(spark, path, keep_malformed=True)
    assert df.columns == ["a", "b", "malformed_line", "malformed_line_"]
    assert [r["malformed_line_"] for r in df.orderBy("a").collect()] == [None, "3,4,5,6", "7", None]
    assert df.where("malformed_line_ is not null").count() == 2 and df.count() == 4
    rules = spark.createDataFrame(
        [("T1", "t.csv", "check_malformed"), ("T2", "p", "check_malformed")], "tcid string, file_name string, test string"
    )
    df.drop("malformed_line_").write.parquet(str(tmp_path / "p"))
    out = str(tmp_path / "out")
    found = tg.run_job(spark, rules, out, base_path=str(tmp_path), csv={"keep_malformed": True}).orderBy("tcid").collect()
    assert [(r["status"], r["violations"]) for r in found] == [("Failed", 2), ("Error", None)]
    rejected = writers.read_rejected(spark, f"{out}/data/t.csv")
    assert sorted(r["malformed_line_"] for r in rejected.collect()) == ["3,4,5,6", "7"]
    typed = readers.read_csv(spark, path, schema="a int, b int, c string", keep_malformed=True)
    assert [r["malformed_line"] for r in typed.orderBy("a").collect()] == [None, "3,4,5,6", "7", None]
    with pytest.raises(tg.RuleError):
        readers.read_csv(spark, path, infer_types=True, keep_malformed=True)


def test_no_file_is_no_pass(spark, tmp_path, outcome, monkeypatch):
    (tmp_path / "empty").mkdir()
    assert outcome(tg.file_timeliness(spark, str(tmp_path / "empty")))[0] == "Failed"
    assert outcome(tg.duplicated_files_by_name_and_size(spark, str(tmp_path / "empty")))[0] == "Failed"


def test_listing_of_odd_paths(spark, folder):
    for path in (f"{folder}/sub/..", f"{folder}/.", str(folder) + "*", f"{folder}/*.txt"):
        names = {r["file_name"] for r in readers.file_listing(spark, path, recursive=False).collect()}
        assert names == {"a.txt", "b.txt"}, path
