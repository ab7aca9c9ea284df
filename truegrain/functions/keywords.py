"""Keywords by the thousand: an index of the signs they hold, looked up once per text.

Each keyword is filed under one run of three signs that it holds (fewer, if it is shorter),
the one that fewest keywords have. A text can only hold keywords that are filed under one of
its own runs; these few are then confirmed by a search. So the work for a text grows with its
length and with what it nearly holds, not with the number of keywords, and needs no shuffle.

Large tables of keywords are joined instead: there a run has at least half the length of its
keyword, so that few share one, and neither keywords nor texts pass through the driver.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.errors import RuleError
from truegrain.functions.columns import free_name, ref

_RUN = 3
_ENTRY = "struct<priority: bigint, class: string, pattern: string>"

Keyword = tuple[int, str, str]


#: Keywords that are collected; larger tables are joined.
LISTED = 1_000
#: Buckets in which runs of keywords are counted, and bits of the table of those that file one.
_BUCKETS, _TABLE_BITS = 1 << 16, 1 << 24


def known_keywords(rules: DataFrame) -> DataFrame:
    """(pattern, priority, class) of a rule table with these columns; rows that lack one do not count.

    Each pattern once, with the least priority and, of these, class: no other can be chosen.
    """
    if missing := [c for c in ("class", "priority", "pattern") if c not in rules.columns]:
        raise RuleError(f"the table of categories lacks {', '.join(missing)}")
    rows = rules.select(F.col("priority").cast("bigint"), F.col("class").cast("string"), F.lower(F.col("pattern").cast("string")).alias("pattern"))
    known = rows.where(F.col("priority").isNotNull() & F.col("class").isNotNull() & (F.length("pattern") > 0))
    return known.groupBy("pattern").agg(F.min(F.struct("priority", "class")).alias("least")).select("pattern", "least.*")


def with_class_of(df: DataFrame, text: Column, rules: DataFrame, default: str, result_as: str) -> DataFrame:
    """:func:`with_class` for a table of keywords of any size. ``text`` has to be deterministic."""
    known = known_keywords(rules)
    some = known.limit(LISTED + 1).collect()
    if len(some) <= LISTED:
        return with_class(df, text, sorted((r["priority"], r["class"], r["pattern"]) for r in some), default, result_as)
    return _with_joined_class(df, text, known, default, result_as)


def _runs_of(signs: Column, size: Column) -> Column:
    """Hashes of all runs of so many signs."""
    starts = F.when(F.size(signs) >= size, F.sequence(F.lit(1), F.size(signs) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(signs, i, size), ""))))


def _with_joined_class(df: DataFrame, text: Column, known: DataFrame, default: str, result_as: str) -> DataFrame:
    """The same by joins. A keyword is filed under the hash of that of its runs whose bucket fewest
    runs of keywords share, a run being the largest power of two of its signs.

    What meets by hash is confirmed on the texts themselves; equal texts are one.
    """
    size = F.call_function("shiftleft", F.lit(1), F.length(F.bin(F.size("signs"))) - 1)
    # Making runs is much work for little data, which small files or few bytes leave to one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = known.repartition(tasks).withColumn("signs", F.split("pattern", "")).withColumn("size", size)
    runs = sized.select("pattern", "priority", "class", F.explode(_runs_of(F.col("signs"), F.col("size"))).alias("run"))
    runs = runs.withColumn("bucket", F.pmod("run", F.lit(_BUCKETS)))
    common = runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    filed = runs.join(common, "bucket").groupBy("pattern", "priority", "class").agg(F.min(F.struct("n", "run"))["run"].alias("run"))

    def place(run: Column) -> tuple[Column, Column]:
        at = F.pmod(run, F.lit(_TABLE_BITS))
        return F.floor(at / 64), F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))

    word, bit = place(F.col("run"))
    bits = filed.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    sizes = sorted(r["size"] for r in sized.select("size").distinct().collect())
    own, key, near = (free_name(df, name) for name in ("__text", "__key", "__near"))
    whole = F.coalesce(text, F.lit(""))
    texts = df.select(whole.alias("text")).distinct().repartition(tasks).select(F.xxhash64("text").alias("of"), F.split("text", "").alias("signs"))
    held = texts.select("of", F.explode(F.flatten(F.array(*[_runs_of(F.col("signs"), F.lit(n)) for n in sizes]))).alias("held"))
    word, bit = place(F.col("held"))
    # Runs under which nothing is filed stay in their task, but for those that share a bit.
    held = held.withColumns({"at": word, "own_bit": bit}).join(F.broadcast(bits), F.col("at") == F.col("word"))
    held = held.where(F.col("bits").bitwiseAND(F.col("own_bit")) != 0).select("of", "held")
    met = held.join(filed, F.col("held") == F.col("run")).groupBy(F.col("of").alias(key))
    found = met.agg(F.collect_set(F.struct("priority", "class", "pattern")).alias(near))
    names = [ref(n) for n in df.columns if n != result_as]
    rows = df.withColumn(own, whole).withColumn(key, F.xxhash64(F.col(own))).join(found, key, "left")
    there = F.filter(near, lambda e: F.contains(F.col(own), e["pattern"]))
    return rows.select(*names, F.coalesce(F.array_min(there)["class"], F.lit(default)).alias(result_as))


def _runs(text: str, size: int) -> set[str]:
    return {text[i : i + size] for i in range(len(text) - size + 1)}


def index(keywords: Sequence[Keyword]) -> dict[str, list[Keyword]]:
    """Each keyword under one of its runs, of those the one that fewest keywords have."""
    common = Counter(run for _, _, p in keywords for run in _runs(p, min(_RUN, len(p))))
    found: dict[str, list[Keyword]] = {}
    for keyword in keywords:
        pattern = keyword[2]
        run = min(_runs(pattern, min(_RUN, len(pattern))), key=lambda r: (common[r], r))
        found.setdefault(run, []).append(keyword)
    return found


def with_class(df: DataFrame, text: Column, keywords: Sequence[Keyword], default: str, result_as: str) -> DataFrame:
    """``df`` with the class of least priority one of whose keywords is in ``text`` (equal ones by name), else ``default``."""
    filed = index(keywords)
    if not filed:
        return df.withColumn(result_as, F.lit(default))
    own, signs, runs = (free_name(df, name) for name in ("__text", "__signs", "__runs"))
    found = df.withColumn(own, F.coalesce(text, F.lit("")))
    # Steps of their own, as each is used several times by the next.
    found = found.withColumn(signs, F.split(F.col(own), ""))

    def joined(size: int) -> Column:
        longer = F.col(signs)
        for k in range(1, size):
            # Behind the end a run is NULL.
            longer = F.zip_with(longer, F.slice(signs, k + 1, F.greatest(F.size(signs) - k, F.lit(0))), lambda a, b: F.concat(a, b))
        return longer

    sizes = sorted({len(run) for run in filed})
    of_text = F.array_distinct(F.flatten(F.array(*[joined(size) for size in sizes])))
    # One literal, which the optimizer reads once.
    listed = {run: [{"priority": p, "class": c, "pattern": k} for p, c, k in some] for run, some in filed.items()}
    entries = F.from_json(F.lit(json.dumps(listed)), f"map<string, array<{_ENTRY}>>")
    found = found.withColumn(runs, F.array_intersect(of_text, F.map_keys(entries)))
    near = F.flatten(F.transform(F.col(runs), lambda run: F.coalesce(F.try_element_at(entries, run), F.array().cast(f"array<{_ENTRY}>"))))
    there = F.filter(near, lambda e: F.contains(F.col(own), e["pattern"]))
    return found.withColumn(result_as, F.coalesce(F.array_min(there)["class"], F.lit(default))).drop(own, signs, runs)
