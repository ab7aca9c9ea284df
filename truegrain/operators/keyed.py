"""Checks on keys, any number of them in few passes over each table.

Duplicate keys, foreign keys, lists of allowed values and consistency of two tables all ask
the same of a key: how many rows of the one side have it, how many of the other, and with
which values. So every row stands for one small record for each check that reads its table:
(check, digest of the key, digest of the value, side), and records of all checks and tables
are counted together. They get there in two ways, each of which reads a table once, however
many checks name it:

- Keys of few values are counted in part before their shuffle, where a hot key or value is one
  record of a task.
- Keys of many values would send nearly every record. Checks that have a column in common are
  dealt by it instead: a row is sent once for all of them, as it is, and its records are made
  and counted where it arrives. So what is sent grows with the rows, not with the checks.

A first reading counts the columns in buckets of their hashes. It says which columns may deal:
values of a bucket with far more than its share of the rows are always counted the first way.
Small tables have no other.

A digest is three 64-bit hashes of the typed values, NULL marked; two group, and the third
tells if a group holds different keys after all. Such a check is reported as clashed and has
to be counted by its own plan, so digests never decide a result that they could falsify.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.results import Label
from truegrain.session import new_shared_path

_WIDE = "decimal(38,0)"
#: Checks whose records one pass makes of a row; more take another pass.
CHECKS_PER_PASS = 60
#: Records from which checks are dealt by a column, and records of a task there.
DEAL_FROM, DEALT_PER_TASK = 1_000_000, 500_000
#: Buckets of a column, and of these the ones that hold more than a share of the rows, and so many, are hot.
_BUCKETS, _HOT_SHARE, _HOT_LEAST = 1 << 16, 1 << 12, 1_000
#: A column with fewer filled buckets deals nothing for checks of that column alone: these combine well.
_FEW = 1 << 12


@dataclass(frozen=True)
class Side:
    """Rows of a table as keys, and values to compare; ``table`` names it, equal names are read once."""

    table: Hashable
    df: DataFrame
    keys: Sequence[Column]
    values: Sequence[Column] = ()
    present: Column | None = None


@dataclass(frozen=True)
class KeyedCheck:
    """One check: its sides, and a result row from what was counted.

    ``finish`` gets by name, for the whole check: ``groups`` and ``surplus`` (keys that the
    first side has more than once, and their rows beyond the first), ``orphans`` (rows of the
    first side whose key the second lacks) and ``pairs`` (pairs of an inner join on the key
    whose values differ).
    """

    first: Side
    second: Side | None
    finish: Callable[[dict[str, Column], Label | None], list[Column]]

    def broken(self) -> Column:
        """Whether a counted key breaks the check: its rows repeat, lack a reference, or differ."""
        n1, n2 = F.col("n1"), F.col("n2")
        if self.second is None:
            return n1 > 1
        if not self.first.values:
            return (n1 > 0) & (n2 == 0)
        return (n1 > 0) & (n2 > 0) & (_pairs() > F.col("agreeing"))

    def require_columns(self) -> None:
        """Let the analyser reject what a side does not have."""
        for side in (self.first, self.second):
            if side is not None:
                side.df.select(*_hashes([*side.keys, *side.values]))


def same_type(df1: DataFrame, one: Column, df2: DataFrame, two: Column) -> tuple[Column, Column, T.DataType]:
    """Both columns in the type that the engine would compare them in, as hashes depend on the type."""
    kinds = [df.select(c.alias("c")).schema[0].dataType for df, c in ((df1, one), (df2, two))]
    if kinds[0] == kinds[1]:
        return one, two, kinds[0]
    wide = df1.select(one.alias("c")).union(df2.select(two.alias("c"))).schema[0].dataType
    one, two = (c if kind == wide else c.cast(wide) for c, kind in zip((one, two), kinds))
    return one, two, wide


def _marked(columns: Sequence[Column]) -> list[Column]:
    return [part for c in columns for part in (c.isNull(), c)]


def _hashes(columns: Sequence[Column]) -> tuple[Column, Column, Column]:
    """Three hashes of some values; equal values have equal ones, in any table."""
    marked = _marked(columns)
    return (
        F.xxhash64(*marked),
        F.xxhash64(F.lit(1), *marked[::-1], F.lit(2)),
        F.xxhash64(F.lit(3), *marked, F.lit(len(marked))),
    )


def _digest(which: int, parts: Sequence[Column]) -> Column:
    """One hash of a key from those of its columns; parts that are NULL do not count."""
    return F.xxhash64(F.lit(which), *parts)


@dataclass(frozen=True)
class _Spec:
    """How a check makes a record of a row: places of its key, its values and its condition in what was read."""

    check: int
    is_first: bool
    keys: tuple[int, ...]
    values: tuple[int, ...]
    present: int | None


@dataclass
class _Table:
    """The distinct expressions that all checks read of one table."""

    df: DataFrame
    expressions: list[Column] = field(default_factory=list)
    specs: list[_Spec] = field(default_factory=list)
    _known: dict[int, list[tuple[DataFrame, int]]] = field(default_factory=dict)

    def place(self, expression: Column) -> int:
        frame = self.df.select(expression.alias("c"))
        alike = self._known.setdefault(frame.semanticHash(), [])
        for other, place in alike:
            if frame.sameSemantics(other):
                return place
        self.expressions.append(expression)
        alike.append((frame, len(self.expressions) - 1))
        return len(self.expressions) - 1


def _tables(checks: Sequence[KeyedCheck]) -> dict[Hashable, _Table]:
    tables: dict[Hashable, _Table] = {}
    for number, check in enumerate(checks):
        for side, first in ((check.first, True), (check.second, False)):
            if side is not None:
                table = tables.setdefault(side.table, _Table(side.df))
                keys, values = (tuple(table.place(c) for c in some) for some in (side.keys, side.values))
                present = None if side.present is None else table.place(side.present)
                table.specs.append(_Spec(number, first, keys, values, present))
    return tables


@dataclass(frozen=True)
class _Deal:
    """Checks that a column deals: where each table has it, and the buckets too large for that."""

    checks: frozenset[int]
    at: Mapping[Hashable, frozenset[int]]
    hot: tuple[int, ...]
    rows: int


def _bucket(expression: Column) -> Column:
    return F.pmod(_hashes([expression])[0], F.lit(_BUCKETS)).cast("int")


def _deals(tables: Mapping[Hashable, _Table]) -> list[_Deal]:
    """The columns that deal rows, those first that serve most checks; none for small tables."""
    firsts = {s.check: (name, s) for name, t in tables.items() for s in t.specs if s.is_first}
    seconds = {s.check: (name, s) for name, t in tables.items() for s in t.specs if not s.is_first}
    columns: dict[tuple[Hashable, int], int] = {}
    at: dict[int, dict[Hashable, set[int]]] = {}
    serves: dict[int, set[int]] = {}
    for number, (name, spec) in firsts.items():
        for i, key in enumerate(spec.keys):
            column = columns.setdefault((name, key), len(columns))
            at.setdefault(column, {}).setdefault(name, set()).add(key)
            serves.setdefault(column, set()).add(number)
            if number in seconds:
                other, second = seconds[number]
                at[column].setdefault(other, set()).add(second.keys[i])
    frames = []
    for name, table in tables.items():
        listed = [(column, key) for column, places in at.items() for key in sorted(places.get(name, ()))]
        if listed:
            buckets = table.df.select(F.posexplode(F.array(*[_bucket(table.expressions[key]) for _, key in listed])).alias("i", "bucket"))
            numbers = F.array(*[F.lit(column) for column, _ in listed])
            frames.append(buckets.select(F.get(numbers, F.col("i")).alias("column"), "bucket"))
    counted = reduce(DataFrame.union, frames).groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("n"))
    is_hot = F.col("n") > F.greatest(F.col("rows") / _HOT_SHARE, F.lit(_HOT_LEAST))
    found = counted.withColumn("rows", F.sum("n").over(Window.partitionBy("column"))).groupBy("column").agg(
        F.max("rows").alias("rows"),
        F.count(F.lit(1)).alias("filled"),
        F.coalesce(F.sum(F.when(is_hot, F.col("n"))), F.lit(0)).alias("hot_rows"),
        F.collect_list(F.when(is_hot, F.col("bucket"))).alias("hot"),
    )
    rows = {r["column"]: r for r in found.collect()}
    usable = {c: 1 - r["hot_rows"] / r["rows"] for c, r in rows.items() if 64 * (r["rows"] - r["hot_rows"]) > r["rows"]}
    left, deals = set(firsts), []
    wide = {number for number, (_, spec) in firsts.items() if len(spec.keys) > 1}
    while useful := [c for c in usable if serves[c] & left & (left if rows[c]["filled"] >= _FEW else wide)]:
        best = max(useful, key=lambda c: (len(serves[c] & left) * usable[c], -c))
        deals.append((best, frozenset(serves[best] & left)))
        left -= serves[best]
    if sum(len(own) * rows[c]["rows"] for c, own in deals) < DEAL_FROM:
        return []
    return [
        _Deal(own, {n: frozenset(p) for n, p in at[c].items()}, tuple(sorted(rows[c]["hot"])), rows[c]["rows"]) for c, own in deals
    ]


def _listed(specs: Sequence[_Spec], of: Callable[[int], int], conditions: Sequence[int | None], widths: tuple[int, int]) -> Column:
    """The specifications as a literal, keys and values in as many places as the longest needs."""

    def places(some: Sequence[int], width: int, name: str) -> list[Column]:
        return [F.lit(of(some[i]) if i < len(some) else -1).alias(f"{name}{i}") for i in range(width)]

    made = [
        F.struct(
            F.lit(s.check).alias("check"),
            F.lit(s.is_first).alias("is_first"),
            F.lit(-1 if here is None else here).alias("here"),
            *places(s.keys, widths[0], "key"),
            *places(s.values, widths[1], "value"),
        )
        for s, here in zip(specs, conditions)
    ]
    return F.array(*made)


def _records(rows: DataFrame, expressions: Sequence[Column], conditions: Sequence[Column], specs: Column, widths: tuple[int, int], kept: Sequence[str] = ()) -> DataFrame:
    """(check, k1, k2, v1, v2, proof, is_first) for each row and specification.

    Columns are hashed once a row, and a record picks its own: the code is the same for all
    checks, and short, as the engine's compiler leaves long code alone.
    """
    hashes = [_hashes([e]) for e in expressions]
    parts = rows.select(
        *kept,
        *[F.array(*[h[which] for h in hashes]).alias(f"__h{which}") for which in range(3)],
        F.array(*conditions, F.lit(True)).alias("__here"),
        specs.alias("__specs"),
    )
    found = parts.select(*kept, "__h0", "__h1", "__h2", "__here", F.inline("__specs"))
    found = found.where((F.col("here") < 0) | F.get(F.col("__here"), F.col("here")))

    def of(which: int, *names: str) -> Column:
        return _digest(which, [F.get(F.col(f"__h{which}"), F.col(n)) for n in names])

    keys, values = [f"key{i}" for i in range(widths[0])], [f"value{i}" for i in range(widths[1])]
    return found.select(
        *kept,
        "check",
        of(0, *keys).alias("k1"),
        of(1, *keys).alias("k2"),
        of(0, *values).alias("v1"),
        of(1, *values).alias("v2"),
        F.xxhash64(of(2, *keys), of(2, *values)).alias("proof"),
        "is_first",
    )


def _combined(tables: Mapping[Hashable, _Table], deals: Sequence[_Deal], widths: tuple[int, int]) -> DataFrame | None:
    """The records that are counted before their shuffle: of checks that nothing deals, and of hot buckets."""
    frames = []
    for name, table in tables.items():
        specs, places, conditions = [], [], []
        for spec in table.specs:
            deal = next((d for d in deals if spec.check in d.checks), None)
            present = None if spec.present is None else table.expressions[spec.present]
            if deal is not None:
                if not deal.hot:
                    continue
                is_hot = _bucket(table.expressions[_dealt_by(spec, deal, name)]).isin(*deal.hot)
                present = is_hot if present is None else is_hot & present
            specs.append(spec)
            places.append(None if present is None else len(conditions))
            conditions += [] if present is None else [present]
        if specs:
            used = sorted({i for s in specs for i in (*s.keys, *s.values)})
            listed = _listed(specs, used.index, places, widths)
            frames.append(_records(table.df, [table.expressions[i] for i in used], conditions, listed, widths))
    return reduce(DataFrame.union, frames) if frames else None


def _dealt_by(spec: _Spec, deal: _Deal, table: Hashable) -> int:
    """The expression of a check's key that deals it."""
    return next(key for key in spec.keys if key in deal.at.get(table, ()))


def _is_whole(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType)


def _dealt(tables: Mapping[Hashable, _Table], deals: Sequence[_Deal], widths: tuple[int, int]) -> DataFrame:
    """The other records, made of rows that were sent once for all checks that a column deals.

    Rows of all tables and columns share their fields, as many of each type as one of them needs.
    The number that deals a row is not sent again as a part of its keys.
    """
    sides = []
    for group, deal in enumerate(deals):
        for name, table in tables.items():
            by: dict[int, list[_Spec]] = {}
            for spec in table.specs:
                if spec.check in deal.checks:
                    by.setdefault(_dealt_by(spec, deal, name), []).append(spec)
            sides += [(group, name, at, specs) for at, specs in sorted(by.items())]
    kinds = {
        n: t.df.select(*[e.alias(f"c{i}") for i, e in enumerate(t.expressions)]).schema.fields for n, t in tables.items()
    }
    slots: list[tuple[T.DataType, int]] = []
    slot_of: list[dict[int, int]] = []
    numbers = sorted({kinds[name][at].dataType.simpleString() for _, name, at, _ in sides if _is_whole(kinds[name][at].dataType)})
    for _, name, at, specs in sides:
        taken: dict[int, int] = {}
        # Behind the fields of rows: the number by which they are dealt, as each type that it comes from.
        whole = {at: -1 - numbers.index(kinds[name][at].dataType.simpleString())} if _is_whole(kinds[name][at].dataType) else {}
        for i in sorted({i for s in specs for i in (*s.keys, *s.values, *(() if s.present is None else (s.present,)))}):
            if i in whole:
                continue
            kind = kinds[name][i].dataType
            slot = (kind, sum(kinds[name][j].dataType == kind for j in taken))
            if slot not in slots:
                slots.append(slot)
            taken[i] = slots.index(slot)
        slot_of.append(taken | whole)
    rows = []
    for name, table in tables.items():
        made = []
        for number, (group, own, at, _) in enumerate(sides):
            if own == name:
                holds = {slot: table.expressions[i] for i, slot in slot_of[number].items()}
                by = table.expressions[at]
                row = F.struct(
                    F.lit(group).alias("group"),
                    F.lit(number).alias("side"),
                    (by.cast("bigint") if _is_whole(kinds[name][at].dataType) else _hashes([by])[0]).alias("place"),
                    *[holds.get(i, F.lit(None)).cast(kind).alias(f"s{i}") for i, (kind, _) in enumerate(slots)],
                )
                hot = deals[group].hot
                made.append(F.when(~_bucket(by).isin(*hot), row) if hot else row)
        if made:
            rows.append(table.df.select(F.inline(F.array(*made))).where(F.col("side").isNotNull()))
    shuffled = int(rows[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(shuffled, -(-sum(d.rows * len(d.checks) for d in deals) // DEALT_PER_TASK))
    dealt = reduce(DataFrame.union, rows).repartition(tasks, "group", "place")
    fields = [F.col(f"s{i}") for i in range(len(slots))] + [F.col("place").cast(n) for n in reversed(numbers)]
    flags = [i for i, (kind, _) in enumerate(slots) if kind == T.BooleanType()]
    listed = [
        _listed(specs, lambda i, taken=taken: taken[i] % len(fields), [None if s.present is None else flags.index(taken[s.present]) for s in specs], widths)
        for (_, _, _, specs), taken in zip(sides, slot_of)
    ]
    return _records(dealt, fields, [fields[i] for i in flags], F.get(F.array(*listed), F.col("side")), widths, ("group", "place"))


def _pairs() -> Column:
    return (F.col("n1").cast("decimal(19,0)") * F.col("n2").cast("decimal(19,0)")).cast(_WIDE)


def _count_keys(records: DataFrame, compared: Column, dealt_by: Sequence[str] = ()) -> DataFrame:
    by_value = records.groupBy(*dealt_by, "check", "k1", "k2", "v1", "v2").agg(
        F.count_if("is_first").alias("c1"),
        F.count_if(~F.col("is_first")).alias("c2"),
        (F.min("proof") != F.max("proof")).alias("differ"),
    )
    one, two = F.col("c1").cast("decimal(19,0)"), F.col("c2").cast("decimal(19,0)")
    # Wide decimals only where values are compared.
    agreeing = F.when(compared & (F.col("c1") > 0) & (F.col("c2") > 0), (one * two).cast(_WIDE))
    return (
        by_value.groupBy(*dealt_by, "check", "k1", "k2")
        .agg(
            F.sum("c1").alias("n1"),
            F.sum("c2").alias("n2"),
            F.coalesce(F.sum(agreeing), F.lit(0)).alias("agreeing"),
            F.bool_or("differ").alias("differ"),
        )
        .drop(*dealt_by)
    )


def _by_key(checks: Sequence[KeyedCheck]) -> tuple[DataFrame, Column]:
    """For each key of each check its rows on either side, and whether the check compares values."""
    tables = _tables(checks)
    deals = _deals(tables)
    sides = [side for c in checks for side in (c.first, c.second) if side is not None]
    widths = (max(len(s.keys) for s in sides), max(len(s.values) for s in sides))
    compared = F.col("check").isin([i for i, c in enumerate(checks) if c.first.values])
    frames = []
    if (records := _combined(tables, deals, widths)) is not None:
        frames.append(_count_keys(records, compared))
    if deals:
        frames.append(_count_keys(_dealt(tables, deals, widths), compared, ("group", "place")))
    return reduce(DataFrame.union, frames), compared


def counted(checks: Sequence[KeyedCheck]) -> DataFrame:
    """What was counted for each check, by its number: ``groups``, ``surplus``, ``orphans``, ``pairs``, ``clashed``."""
    by_key, compared = _by_key(checks)
    n1, n2 = F.col("n1"), F.col("n2")
    pairs = _pairs() - F.col("agreeing")
    return by_key.groupBy("check").agg(
        F.count_if(n1 > 1).alias("groups"),
        F.coalesce(F.sum(F.when(n1 > 1, n1 - 1)), F.lit(0)).alias("surplus"),
        F.coalesce(F.sum(F.when(n2 == 0, n1)), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum(F.when(compared & (n1 > 0) & (n2 > 0), pairs)), F.lit(0)).cast(_WIDE).alias("pairs"),
        F.bool_or("differ").alias("clashed"),
    )


def _one_pass(checks: Sequence[KeyedCheck], labels: Sequence[Label | None]) -> DataFrame:
    names = ("groups", "surplus", "orphans", "pairs")

    def of(number: int, name: str) -> Column:
        # Of a check without a row nothing was counted.
        return F.coalesce(F.max(F.when(F.col("check") == number, F.col(name))), F.lit(0))

    row = counted(checks).agg(
        *[of(i, n).alias(f"__{i}_{n}") for i in range(len(checks)) for n in names],
        *[F.max((F.col("check") == i) & F.col("clashed")).alias(f"__{i}_clashed") for i in range(len(checks))],
    )
    results = [
        F.struct(*c.finish({n: F.col(f"__{i}_{n}") for n in names}, label), F.col(f"__{i}_clashed").alias("clashed"))
        for i, (c, label) in enumerate(zip(checks, labels))
    ]
    return row.select(F.posexplode(F.array(*results)).alias("number", "r")).select("number", "r.*")


def evaluate_keyed(checks: Sequence[KeyedCheck], labels: Sequence[Label | None] | None = None) -> DataFrame:
    """A result row for each check with its ``number`` and whether its digests ``clashed``."""
    labels = labels or [None] * len(checks)
    frames = []
    for begin in range(0, len(checks), CHECKS_PER_PASS):
        some = slice(begin, begin + CHECKS_PER_PASS)
        frame = _one_pass(checks[some], labels[some])
        frames.append(frame.withColumn("number", F.col("number") + begin))
    return reduce(DataFrame.unionByName, frames)


def broken_keys(checks: Sequence[KeyedCheck]) -> DataFrame:
    """(check, k1, k2): the digests of the keys that break each check, by its number."""
    by_key, _ = _by_key(checks)
    test = reduce(lambda a, b: a | b, [(F.col("check") == i) & c.broken() for i, c in enumerate(checks)])
    return by_key.where(test).select("check", "k1", "k2")


def marked_rows(df: DataFrame, checks: Sequence[KeyedCheck], marks: Sequence[str]) -> DataFrame:
    """``df`` with a boolean column for each check: whether the row's key breaks it.

    ``df`` has the columns of the checks' first sides. The digests of broken keys are written
    once; a check with few of them is joined by broadcast under the session's own limit, and
    one with none is not joined at all.
    """
    path = new_shared_path(df.sparkSession, "broken-keys")
    broken_keys(checks).write.partitionBy("check").parquet(path)
    stored = df.sparkSession.read.schema("k1 bigint, k2 bigint, check int").parquet(path)
    there = {r["check"] for r in stored.select("check").distinct().collect()}
    for i, (check, mark) in enumerate(zip(checks, marks)):
        if i not in there:
            df = df.withColumn(mark, F.lit(False))
            continue
        one, two = (_digest(which, [_hashes([c])[which] for c in check.first.keys]) for which in (0, 1))
        keys = stored.where(F.col("check") == i).select(F.col("k1").alias(f"{mark}1"), F.col("k2").alias(f"{mark}2"))
        met = (one == F.col(f"{mark}1")) & (two == F.col(f"{mark}2"))
        if check.first.present is not None:
            met = met & check.first.present
        df = df.join(keys, met, "left").withColumn(mark, F.col(f"{mark}1").isNotNull()).drop(f"{mark}1", f"{mark}2")
    return df
