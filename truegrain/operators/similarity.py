"""Best fuzzy match of names, without comparing every pair.

Two names match when their similarity, 100 * (1 - d / (|a| + |b|)) on sorted
words, reaches a threshold; d counts the insertions and deletions between them.
A pair that can match has d <= t for a t that follows from the two lengths. Cut
``b`` into t + 2 pieces: d edits leave at least two of them whole, so both occur in
``a``, in that order, and the edits before, between and after them bound how far each
may have moved. Two equal pieces therefore find all pairs that can match with an
equi-join. One piece would be shared by very many names; two seldom are, so the join
grows with the names and not with their pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.errors import RuleError
from truegrain.functions.columns import column_of
from truegrain.functions.text import (
    BITS,
    common_subsequence_length,
    letter_bits,
    letter_set,
    letters,
    short_common_subsequence_length,
    sorted_tokens,
)
from truegrain.session import settle


def _edits(total_length: Column, threshold: int) -> Column:
    """Most edits two names of this total length may differ by."""
    return F.floor(total_length * (100 - threshold) / 100).cast("int")


def _longest_partner(length: Column, threshold: int) -> Column:
    return F.floor(length * (200 - threshold) / threshold).cast("int")


def _shortest_partner(length: Column, threshold: int) -> Column:
    return F.ceil(length * threshold / (200 - threshold)).cast("int")


def _piece_count(length: Column, threshold: int) -> Column:
    """Pieces for a choice of this length: two more than its most edits with any partner."""
    return _edits(length + _longest_partner(length, threshold), threshold) + 2


def _piece_start(length: Column, pieces: Column, index: Column) -> Column:
    """Where piece ``index`` (from 0) starts, counted from 1; piece lengths differ by at most 1."""
    return F.floor(length * index / pieces).cast("int") + 1


def _range(low: Column, high: Column) -> Column:
    """The whole numbers from low to high; none if high is less."""
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))


def _two_pieces(df: DataFrame, length: Column, threshold: int) -> DataFrame:
    """``df`` with a row for each two pieces of a choice of this length: where they start, and their sizes."""

    def start(index: Column) -> Column:
        return _piece_start(length, F.col("pieces"), index)

    return (
        df.withColumn("pieces", _piece_count(length, threshold))
        .select("*", F.explode(_range(F.lit(0), F.col("pieces") - 2)).alias("i"))
        .select("*", F.explode(_range(F.col("i") + 1, F.col("pieces") - 1)).alias("j"))
        .withColumns({"at_i": start(F.col("i")), "at_j": start(F.col("j"))})
        .withColumns(
            {"size_i": start(F.col("i") + 1) - F.col("at_i"), "size_j": start(F.col("j") + 1) - F.col("at_j")}
        )
    )


def _key(length: Column, one: Column, other: Column) -> Column:
    """Two pieces of a choice of some length as a number; other pieces with the same number are found out later."""
    return F.xxhash64(length, F.col("i"), F.col("j"), one, other)


def _choice_keys(choices: DataFrame, threshold: int) -> DataFrame:
    """(b, b_key, b_set, b_rank, key): all twos of pieces of every choice."""
    rows = _two_pieces(choices.withColumn("b_length", F.length("b_key")), F.col("b_length"), threshold)
    one = F.substring("b_key", F.col("at_i"), F.col("size_i"))
    other = F.substring("b_key", F.col("at_j"), F.col("size_j"))
    return rows.select("b", "b_key", "b_set", "b_rank", _key(F.col("b_length"), one, other).alias("key"))


def _name_keys(names: DataFrame, threshold: int) -> DataFrame:
    """(a, a_key, a_set, edits, key): where two pieces of a partner could be.

    If piece i stands x places and piece j y places further right than in the choice,
    there are at least |x| edits before i, |y - x| between, and |shift - y| after j.
    """
    a_length, b_length, edits = F.col("a_length"), F.col("b_length"), F.col("edits")
    shift, x, y = F.col("shift"), F.col("x"), F.col("y")
    room = edits - F.abs(x)
    partners = F.sequence(_shortest_partner(a_length, threshold), _longest_partner(a_length, threshold))
    rows = (
        names.withColumn("a_length", F.length("a_key"))
        .select("*", F.explode(partners).alias("b_length"))
        .withColumns({"edits": _edits(a_length + b_length, threshold), "shift": a_length - b_length})
        .where(F.abs(shift) <= edits)
    )
    placed = (
        _two_pieces(rows, b_length, threshold)
        .select("*", F.explode(_range(_half_up(shift - edits), _half_down(shift + edits))).alias("x"))
        .select("*", F.explode(_range(_half_up(x + shift - room), _half_down(x + shift + room))).alias("y"))
        .withColumns({"at_i": F.col("at_i") + x, "at_j": F.col("at_j") + y})
        .where((F.col("at_i") >= 1) & (F.col("at_i") + F.col("size_i") <= F.col("at_j")))
        .where(F.col("at_j") + F.col("size_j") <= a_length + 1)
    )
    one = F.substring("a_key", F.col("at_i"), F.col("size_i"))
    other = F.substring("a_key", F.col("at_j"), F.col("size_j"))
    return placed.select("a", "a_key", "a_set", "edits", _key(b_length, one, other).alias("key"))


def _half_up(value: Column) -> Column:
    return F.ceil(value / 2).cast("int")


def _half_down(value: Column) -> Column:
    return F.floor(value / 2).cast("int")


def _ladder(threshold: int) -> list[int]:
    """Thresholds to try in turn: near matches first."""
    strict = 100 - (100 - threshold) // 3
    between = (strict + threshold) // 2
    return sorted({strict, between, threshold}, reverse=True)


def best_matches(
    names: DataFrame,
    name: str,
    choices: DataFrame,
    choice: str,
    threshold: int = 90,
    choice_order: str | None = None,
) -> DataFrame:
    """(name, matched, score): for each distinct name its most similar choice.

    Names without a choice that reaches the threshold are left out. Among equal
    scores the choice that is first in ``choice_order`` wins (default: alphabetical).

    Stricter thresholds are tried first. They allow few edits, so pieces are long and
    keys are few; a name they match is done, because every choice they did not find is
    less similar. Only the other names go on. Their results are settled one by one, so
    this runs jobs while the query is built.
    """
    if isinstance(threshold, bool) or not isinstance(threshold, int) or not 1 <= threshold <= 100:
        raise RuleError(f"threshold must be a whole number from 1 to 100, not {threshold!r}")
    left = (
        names.select(column_of(names, name).alias("a"))
        .where(F.col("a").isNotNull())
        .distinct()
        .withColumn("a_key", sorted_tokens(F.col("a")))
        .where(F.col("a_key") != "")
        .withColumn("a_set", letter_set(F.col("a_key")))
    )
    rank = column_of(choices, choice_order) if choice_order else F.lit(0)
    right = (
        choices.select(column_of(choices, choice).alias("b"), rank.alias("rank"))
        .where(F.col("b").isNotNull())
        .groupBy("b")
        .agg(F.min("rank").alias("b_rank"))
        .withColumn("b_key", sorted_tokens(F.col("b")))
        .where(F.col("b_key") != "")
        .withColumn("b_set", letter_set(F.col("b_key")))
    )
    *stricter, last = _ladder(threshold)
    found = []
    for step in stricter:
        near = settle(_matches(left, right, step))
        found.append(near)
        left = left.join(near.select(F.col("name").alias("a")), "a", "left_anti")
    found.append(_matches(left, right, last))
    return reduce(DataFrame.unionByName, found)


def _candidates(a: DataFrame, b: DataFrame, threshold: int) -> DataFrame:
    """Pairs that share two pieces and that two cheap bounds on the distance do not part.

    The bounds are the characters used, and the built-in distance, which may also
    substitute and so is never larger than d; it is -1 beyond the bound.
    """
    unlike = F.bit_count(F.col("a_set").bitwiseXOR(F.col("b_set")))
    bounded = F.call_function("levenshtein", F.col("a_key"), F.col("b_key"), F.col("edits"))
    close = F.when(unlike <= F.col("edits"), bounded >= 0).otherwise(F.lit(False))
    # Sizes known before the fan-out say nothing about the sizes after it, so neither
    # side may be broadcast on their account.
    met = _name_keys(a, threshold).join(_choice_keys(b, threshold).hint("merge"), "key")
    return met.where(close)


def _matches(a: DataFrame, b: DataFrame, threshold: int) -> DataFrame:
    """The best match of each name of ``a`` among the choices ``b``, at one threshold."""
    # Names are few bytes but fan out into many keys, so they are spread by number of
    # tasks, not by size. The join has shuffles of its own, whose hot keys the adaptive
    # plan can split.
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = a.repartition(tasks), b.repartition(tasks)
    pairs = _candidates(a, b, threshold).select("a", "b", "b_key", "b_rank").distinct()
    with_bits = a.select(
        "a",
        "a_key",
        letters(F.col("a_key")).alias("a_letters"),
        letter_bits(F.col("a_key")).alias("a_bits"),
    )
    a_length, total = F.length("a_key"), F.length("a_key") + F.length("b_key")
    common = F.when(
        a_length <= BITS,
        short_common_subsequence_length(
            a_length, F.col("a_letters"), F.col("a_bits"), F.col("b_key")
        ),
    ).otherwise(common_subsequence_length(F.col("a_key"), F.col("b_key")))
    scored = pairs.join(with_bits, "a").select(
        "a", "b", "b_rank", total.alias("total"), (total - 2 * common).alias("distance")
    )
    nearest = F.struct((F.col("distance") / F.col("total")).alias("far"), "b_rank", "b", "distance", "total")
    best = (
        scored.groupBy("a")
        .agg(F.min(nearest).alias("best"))
        .where(100 * F.col("best.distance") <= (100 - threshold) * F.col("best.total"))
    )
    return best.select(
        F.col("a").alias("name"),
        F.col("best.b").alias("matched"),
        (100 * (1 - F.col("best.far"))).alias("score"),
    )
