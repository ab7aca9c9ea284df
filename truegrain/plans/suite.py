"""Running a table of rules: fused checks, critical stops, reports, clean rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from truegrain.errors import RuleError
from truegrain.functions.columns import free_name, ref
from truegrain.operators.keyed import KeyedCheck, evaluate_keyed, marked_rows
from truegrain.operators.scalar import AGGREGATES_PER_PASS, ScalarCheck, evaluate
from truegrain.plans.rules import (
    TESTS,
    Context,
    Rule,
    analyser_objects,
    build_frame,
    build_keyed,
    build_scalar,
    dimension_of,
    first_line,
    is_scalar,
    parameters,
    require_together,
)
from truegrain.results import ERROR, PASSED, RESULT_SCHEMA, SKIPPED, fixed_results
from truegrain.session import delete_folder, folder_exists, replace_folder, scratch
from truegrain.sources.publish import new_run, publish
from truegrain.sources.readers import as_rules, read_table
from truegrain.sources.writers import marked_failed, write_split, write_status

Tables = Mapping[str, DataFrame]
_STATUS = RESULT_SCHEMA.fieldNames().index("status")


@dataclass(frozen=True)
class _Planned:
    rule: Rule
    check: ScalarCheck | None = None
    keyed: KeyedCheck | None = None
    together: Mapping[str, object] | None = None
    frame: DataFrame | None = None
    problem: str | None = None


def active_rules(rules: DataFrame) -> list[Rule]:
    """The active rules. A rule table is configuration: a few lines per tested column."""
    rows = as_rules(rules).where("is_active").orderBy("tcid", "file_name", "test").collect()
    return [
        Rule(
            r["tcid"],
            r["file_name"],
            bool(r["critical"]),
            (r["test"] or "").strip(),
            r["tested_field"],
            r["expected_value"],
        )
        for r in rows
    ]


def table_lookup(
    spark: SparkSession, tables: Tables | None, base_path: str | None, csv: Mapping[str, object] | None = None
) -> Callable[[str], DataFrame]:
    """Tables by name: those given first, else a file under ``base_path``."""
    known: dict[str, DataFrame] = dict(tables or {})

    def find(name: str) -> DataFrame:
        if name not in known:
            if base_path is None:
                raise RuleError(f"unknown file '{name}'")
            try:
                known[name] = read_table(spark, f"{base_path.rstrip('/')}/{name}", **(csv or {}))
            except AnalysisException as error:
                raise RuleError(f"cannot read '{name}': {error.getCondition()}") from error
        return known[name]

    return find


def _plan(rule: Rule, context: Context) -> _Planned:
    try:
        if not (rule.tcid or "").strip():
            raise RuleError("a rule needs a test case id")
        params = parameters(rule)
        test = TESTS[rule.test]
        table = context.table(rule.file_name) if test.needs_table else None
        if is_scalar(rule, params):
            return _Planned(rule, check=build_scalar(table, rule, params))
        if test.keyed is not None:
            return _Planned(rule, keyed=build_keyed(context, table, rule, params))
        if test.together is not None:
            require_together(context, table, rule, params)
            return _Planned(rule, together=params)
        return _Planned(rule, frame=build_frame(context, table, rule, params))
    except RuleError as error:
        return _Planned(rule, problem=str(error))


def _runnable(items: list[_Planned], table: DataFrame) -> list[_Planned]:
    """The same rules, those the analyser rejects turned into problems.

    They are tried together; only if that fails is each tried on its own.
    """
    if analyser_objects(table, [i.check for i in items]) is None:
        return items
    reasons = [analyser_objects(table, [i.check]) for i in items]
    return [_Planned(i.rule, problem=r) if r else i for i, r in zip(items, reasons)]


@dataclass(frozen=True)
class _Unit:
    """Rules that run together: ``rows`` gives their result rows."""

    items: list[_Planned]
    rows: Callable[[list[_Planned]], list[tuple]]


def _units(planned: list[_Planned], context: Context) -> tuple[list[_Unit], list[tuple]]:
    """The rules by what they share, and the rows of those that cannot run.

    Scalar rules of a file are one aggregation, keyed rules of all files are one, rules of
    some tests share their passes over a file, any other rule has a plan of its own.
    """
    problems = [i for i in planned if i.problem is not None]
    by_file: dict[str, list[_Planned]] = {}
    for item in planned:
        if item.check is not None:
            by_file.setdefault(item.rule.file_name, []).append(item)
    units = []
    for name, items in by_file.items():
        table = context.table(name)
        tried = _runnable(items, table)
        problems += [i for i in tried if i.problem is not None]
        if sound := [i for i in tried if i.check is not None]:
            units.append(_Unit(sound, lambda some, table=table: _scalar_rows(some, table)))
    if by_key := [i for i in planned if i.keyed is not None]:
        units.append(_Unit(by_key, lambda some: _keyed_rows(some, context)))
    alike: dict[tuple[str, str], list[_Planned]] = {}
    for item in planned:
        if item.together is not None:
            alike.setdefault((item.rule.file_name, item.rule.test), []).append(item)
    units += [_Unit(items, lambda some: _together_rows(some, context)) for items in alike.values()]
    units += [_Unit([i], lambda some: _rows(some[0].frame)) for i in planned if i.frame is not None]
    rows = [
        (i.rule.tcid, i.rule.file_name, i.rule.test, i.rule.tested_field, ERROR, None, i.problem) for i in problems
    ]
    return units, rows


def _rows(frame: DataFrame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]


def _scalar_rows(items: list[_Planned], table: DataFrame) -> list[tuple]:
    return _rows(evaluate(table, [i.check for i in items], [i.rule.label for i in items]))


def _together_rows(items: list[_Planned], context: Context) -> list[tuple]:
    rules = [i.rule for i in items]
    return _rows(TESTS[rules[0].test].together(context.table(rules[0].file_name), rules, [i.together for i in items]))


def _keyed_rows(items: list[_Planned], context: Context) -> list[tuple]:
    """All keyed rules together; one whose digests clash is counted by its own plan."""
    found = []
    for row in evaluate_keyed([i.keyed for i in items], [i.rule.label for i in items]).collect():
        if row["clashed"]:
            rule = items[row["number"]].rule
            found += _rows(build_frame(context, context.table(rule.file_name), rule, parameters(rule)))
        else:
            found.append(tuple(row)[1:-1])
    return found


def _collected(planned: list[_Planned], context: Context) -> list[tuple]:
    """The result rows, one per rule. A rule that fails while it runs is an Error row."""
    units, rows = _units(planned, context)
    for unit in units:
        rows += _isolated(unit, unit.items, known_to_fail=False)[0]
    return rows


def _isolated(unit: _Unit, items: list[_Planned], known_to_fail: bool) -> tuple[list[tuple], bool]:
    """The rows of some rules of a unit, and whether one of them failed while it ran.

    Rules run together. If that fails they are halved, and a half is not tried as a whole if
    the other's success shows that the failure is in it: a rule that fails costs about as
    many passes as halvings, not one for each rule beside it.
    """
    if not known_to_fail or len(items) == 1:
        try:
            return unit.rows(items), False
        except (PySparkException, Py4JJavaError) as error:
            if len(items) == 1:
                rule = items[0].rule
                reason = f"failed while running: {first_line(error)}"
                return [(rule.tcid, rule.file_name, rule.test, rule.tested_field, ERROR, None, reason)], True
    middle = len(items) // 2
    first, failed = _isolated(unit, items[:middle], False)
    second, _ = _isolated(unit, items[middle:], not failed)
    return first + second, True


def _run(
    spark: SparkSession,
    listed: list[Rule],
    tables: Tables | None,
    base_path: str | None,
    csv: Mapping[str, object] | None,
) -> tuple[list[tuple], bool]:
    """All result rows, and whether a critical rule stopped the run."""
    context = Context(spark, table_lookup(spark, tables, base_path, csv))
    critical = [r for r in listed if r.critical]
    others = [r for r in listed if not r.critical]
    with scratch(spark):
        found = _collected([_plan(r, context) for r in critical], context)
        stopped = [row for row in found if row[_STATUS] != PASSED]
        if stopped:
            reason = f"skipped: critical rule {stopped[0][0]} did not pass"
            skipped = [(r.tcid, r.file_name, r.test, r.tested_field, SKIPPED, None, reason) for r in others]
            return found + skipped, True
        return found + _collected([_plan(r, context) for r in others], context), False


def run_suite(
    spark: SparkSession,
    rules: DataFrame,
    tables: Tables | None = None,
    base_path: str | None = None,
    csv: Mapping[str, object] | None = None,
) -> DataFrame:
    """The results of all active rules, a row for each.

    All single-table scalar checks of a file share one aggregation, all checks on keys
    share few readings of each table; the others have plans of their own. Critical rules run first: if one
    does not pass, the others are reported as Skipped and never planned. A rule that
    cannot work (no test case id, unknown test or column, bad parameters, a failure
    while it runs) is an Error row and does not disturb the rest. ``csv`` has options of
    ``read_csv`` for the CSV files under ``base_path``, such as ``multiline``.
    """
    found, _ = _run(spark, active_rules(rules), tables, base_path, csv)
    return fixed_results(spark, found)


def dimension_rollup(results: DataFrame) -> DataFrame:
    """(dimension, status, n) over the results."""
    return (
        results.groupBy(dimension_of(F.col("test")).alias("dimension"), "status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def row_verdicts(
    df: DataFrame,
    rules: DataFrame | list[Rule],
    file_name: str,
    failed_as: str | None = None,
    tables: Tables | None = None,
) -> DataFrame:
    """``df`` with the ids of the rules each row breaks, as the last column.

    It is called ``failed_rules``, with underscores behind if ``df`` has such a column.
    Rules that judge single rows take part: nulls, castability, range, length, allowed
    values, date format, date range and malformed lines. These need no shuffle.

    With ``tables``, where the files that rules refer to are found, rules on keys take part
    too: a row breaks one if its key repeats, lacks its reference, or stands for a pair that
    differs. These need a join for each such rule that some key breaks.
    """
    listed = active_rules(rules) if isinstance(rules, DataFrame) else rules
    if failed_as is None:
        failed_as = free_name(df, "failed_rules")
    elif free_name(df, failed_as) != failed_as:
        raise RuleError(f"the table has a column '{failed_as}'; choose another name for the failed rules")
    marks, by_key = [], []
    context = Context(df.sparkSession, table_lookup(df.sparkSession, {**tables, file_name: df}, None)) if tables is not None else None
    for rule in listed:
        test = TESTS.get(rule.test)
        if rule.file_name == file_name and context is not None and test is not None and test.keyed is not None:
            planned = _plan(rule, context)
            if planned.problem:
                raise RuleError(f"{rule.tcid}: {planned.problem}")
            if planned.keyed is not None:
                by_key.append((rule, planned.keyed))
                continue
        if rule.file_name != file_name or test is None or test.scalar is None:
            continue
        if not (rule.tcid or "").strip():
            raise RuleError("a rule needs a test case id")
        params = parameters(rule)
        if not is_scalar(rule, params):
            continue
        check = build_scalar(df, rule, params)
        if problem := analyser_objects(df, [check]):
            raise RuleError(f"{rule.tcid}: {problem}")
        if check.bad_row is not None:
            marks.append(F.when(check.bad_row, F.lit(rule.tcid)))
    names = df.columns
    if by_key:
        broken = [f"__broken{i}" for i in range(len(by_key))]
        df = marked_rows(df, [check for _, check in by_key], broken)
        marks += [F.when(ref(mark), F.lit(rule.tcid)) for (rule, _), mark in zip(by_key, broken)]
    failed = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")
    return df.select(*[ref(n) for n in names], marked_failed(failed, failed_as))


def clean_rows(
    df: DataFrame, rules: DataFrame | list[Rule], file_name: str, tables: Tables | None = None
) -> DataFrame:
    """The rows that break no rule."""
    judged = row_verdicts(df, rules, file_name, tables=tables)
    failed = judged.columns[-1]
    return judged.where(F.size(ref(failed)) == 0).drop(failed)


def rejected_rows(
    df: DataFrame, rules: DataFrame | list[Rule], file_name: str, tables: Tables | None = None
) -> DataFrame:
    """The rows that break a rule, with the ids of all rules they break."""
    judged = row_verdicts(df, rules, file_name, tables=tables)
    return judged.where(F.size(ref(judged.columns[-1])) > 0)


def _observed_split(
    table: DataFrame, judged: DataFrame, items: list[_Planned], path: str
) -> list[tuple]:
    """Write the split of a table, and take the results of its scalar rules, in order, in the same pass."""
    taken = [(f"m{i}_{name}", column) for i, item in enumerate(items) for name, column in item.check.metrics.items()]
    if not taken:
        write_split(judged, path)
        return []
    observation = Observation()
    write_split(judged.observe(observation, *[column.alias(name) for name, column in taken]), path)
    found = observation.get
    kinds = table.agg(*[column.alias(name) for name, column in taken]).schema
    row = table.sparkSession.createDataFrame([tuple(found[f.name] for f in kinds.fields)], kinds)
    results = []
    for i, item in enumerate(items):
        finished = {name: F.col(f"m{i}_{name}") for name in item.check.metrics}
        results.append(F.struct(*item.check.result(finished, item.rule.label)))
    return _rows(row.select(F.inline(F.array(*results))))


def _split_tables(listed: list[Rule], context: Context, staging: str) -> tuple[dict[int, tuple], dict[str, str]]:
    """Write the split of each file that has rules: its folder by file, and the results of its scalar
    rules by their place in ``listed``.

    A file is left out if a rule of it cannot work or fails while it runs: its scalar rules
    are then run as in a suite.
    """
    results: dict[int, tuple] = {}
    folders: dict[str, str] = {}
    by_file: dict[str, list[int]] = {}
    for place, rule in enumerate(listed):
        if rule.test in TESTS and TESTS[rule.test].needs_table:
            by_file.setdefault(rule.file_name, []).append(place)
    for name, places in sorted(by_file.items()):
        planned = {place: _plan(listed[place], context) for place in places}
        scalar = {place: item for place, item in planned.items() if item.check is not None}
        if any(i.problem for i in planned.values()):
            continue
        table, items = context.table(name), list(scalar.values())
        metrics = sum(len(i.check.metrics) for i in items)
        if metrics > AGGREGATES_PER_PASS or any(i.problem for i in _runnable(items, table)):
            continue
        folder = f"{staging}/{len(folders):04d}"
        try:
            rows = _observed_split(table, row_verdicts(table, [listed[p] for p in places], name), items, folder)
        except (PySparkException, Py4JJavaError):
            continue
        results |= dict(zip(scalar, rows))
        folders[name] = folder
    return results, folders


def run_job(
    spark: SparkSession,
    rules: DataFrame,
    output: str,
    tables: Tables | None = None,
    base_path: str | None = None,
    csv: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run the suite, write the status report, and store clean and rejected rows.

    Writes ``output/status_table`` (CSV) and, unless a critical rule stopped the
    run, one split table per file under ``output/data``. A file of which a rule is an
    Error is not stored: nobody can say which of its rows are clean. Returns the
    results. Rules are told apart by their place in the table, so two files may use
    the same test case id.

    The scalar rules of a file are judged in the pass that writes its split to a staging
    folder, so that one reading serves both. Critical rules that need more than that run
    before; the split takes its place only when all rules have been judged.
    """
    listed = active_rules(rules)
    output = output.rstrip("/")
    staging = f"{output}/_staging-{uuid.uuid4().hex}"
    context = Context(spark, table_lookup(spark, tables, base_path, csv))
    try:
        with scratch(spark):
            found, folders = _judged_while_writing(listed, context, staging)
        results = fixed_results(spark, found)
        write_status(results.orderBy("tcid", "file_name", "test"), f"{output}/status_table")
        for name, folder in folders.items():
            replace_folder(spark, folder, f"{output}/data/{name}")
    finally:
        delete_folder(spark, staging)
    return results


def _judged_while_writing(
    listed: list[Rule], context: Context, staging: str
) -> tuple[list[tuple], dict[str, str]]:
    """All result rows, and by file the folder of its split; none if a critical rule stopped the run."""

    def run(places: list[int]) -> list[tuple]:
        return _collected([_plan(listed[p], context) for p in places], context)

    def is_wide(rule: Rule) -> bool:
        return rule.test in TESTS and TESTS[rule.test].scalar is None

    critical = [p for p, r in enumerate(listed) if r.critical]
    others = [p for p, r in enumerate(listed) if not r.critical]
    first = [p for p in critical if is_wide(listed[p])]
    found = run(first)
    observed: dict[int, tuple] = {}
    folders: dict[str, str] = {}
    if all(row[_STATUS] == PASSED for row in found):
        observed, folders = _split_tables(listed, context, staging)

    def judged(places: list[int]) -> list[tuple]:
        return [observed[p] for p in places if p in observed] + run([p for p in places if p not in observed])

    found += judged([p for p in critical if p not in first])
    stopped = [row for row in found if row[_STATUS] != PASSED]
    if stopped:
        reason = f"skipped: critical rule {stopped[0][0]} did not pass"
        rules = [listed[p] for p in others]
        return found + [(r.tcid, r.file_name, r.test, r.tested_field, SKIPPED, None, reason) for r in rules], {}
    found += judged(others)
    broken = {row[1] for row in found if row[_STATUS] == ERROR}
    return found, {name: folder for name, folder in folders.items() if name not in broken}


def publish_job(
    spark: SparkSession,
    rules: DataFrame,
    output: str,
    tables: Tables | None = None,
    base_path: str | None = None,
    csv: Mapping[str, object] | None = None,
) -> DataFrame:
    """:func:`run_job` as a version: see ``sources.publish``.

    A run that fails on the way leaves the version before as it is. ``publish.current``
    names the folder with ``status_table`` and ``data``.
    """
    run = new_run(output)
    results = run_job(spark, rules, run, tables, base_path, csv)
    publish(spark, output, run, folder_exists(spark, f"{run}/data"))
    return results
