from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from truegrain import RuleError
from truegrain.functions.text import (
    common_subsequence_length,
    letter_bits,
    letters,
    normalised_name,
    short_common_subsequence_length,
    sorted_tokens,
)
from truegrain.operators.similarity import best_matches


def common(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def brute_force(names, choices, threshold):
    def key(text):
        return " ".join(sorted(text.split()))

    found = {}
    for name in set(names):
        best = None
        for order, choice in enumerate(choices):
            a, b = key(name), key(choice)
            total = len(a) + len(b)
            distance = total - 2 * common(a, b)
            if a and b and 100 * distance <= (100 - threshold) * total:
                candidate = (distance / total, order, choice)
                best = min(best, candidate) if best else candidate
        if best:
            found[name] = best[2]
    return found


def matched(spark, names, choices, threshold=90):
    left = spark.createDataFrame([(n,) for n in names], "n string")
    right = spark.createDataFrame(list(zip(choices, range(len(choices)))), "c string, o int")
    rows = best_matches(left, "n", right, "c", threshold, "o").collect()
    assert len({r["name"] for r in rows}) == len(rows)
    return {r["name"]: (r["matched"], round(r["score"], 1)) for r in rows}


def test_known_names(spark):
    choices = ["annual_inc", "int_rate", "mths_since_last_delinq", "is_inc_v", "zip code", "x"]
    names = ["annualinc", "intrate", "mthssincelastdelinq", "isincv", "code zip", "annualinc", None, "", "x"]
    assert matched(spark, names, choices) == {
        "annualinc": ("annual_inc", 94.7),
        "intrate": ("int_rate", 93.3),
        "mthssincelastdelinq": ("mths_since_last_delinq", 92.7),
        "code zip": ("zip code", 100.0),
        "x": ("x", 100.0),
    }


def test_first_choice_wins_ties(spark):
    assert matched(spark, ["abcdefghijkl"], ["abcdefghijklz", "abcdefghijkly"])["abcdefghijkl"][0] == "abcdefghijklz"


@pytest.mark.parametrize(("threshold", "seed"), [(90, 1), (80, 2)])
def test_same_as_all_pairs(spark, threshold, seed):
    random.seed(seed)
    def word():
        return "".join(random.choice("abc_ ") for _ in range(random.randint(1, 24))).strip() or "a"
    # A third of all choices share a long beginning, and one name is repeated very often.
    choices = list(dict.fromkeys([word() for _ in range(60)] + ["shared_start_" + word() for _ in range(40)]))
    names = [words[:at] + words[at + 1 :] for words in choices for at in (0, len(words) // 2)]
    names = [n for n in names if n.strip()] + ["shared_start_a"] * 100
    found = {n: m for n, (m, _) in matched(spark, names, choices, threshold).items()}
    assert found == brute_force(names, choices, threshold)


def test_long_names(spark):
    name = "orig_projected_additional_accrued_interest_of_the_secondary_applicant_x"
    assert len(name) > 62
    assert matched(spark, [name.replace("_", "")], [name, name[:60]])[name.replace("_", "")][0] == name


def test_threshold_must_be_sensible(spark):
    df = spark.createDataFrame([("a",)], "n string")
    for threshold in (0, 101, 90.5, True):
        with pytest.raises(RuleError):
            best_matches(df, "n", df, "n", threshold)


def test_common_subsequence_both_ways(spark):
    random.seed(9)
    pairs = [("", ""), ("", "a"), ("a", ""), ("héllo😀", "hllo😀é")]
    pairs += [
        ("".join(random.choice("abcd") for _ in range(random.randint(1, 62))),
         "".join(random.choice("abcde") for _ in range(random.randint(1, 70))))
        for _ in range(40)
    ]
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    rows = df.select(
        "a",
        "b",
        common_subsequence_length(a, b).alias("full"),
        F.when(
            F.length(a) > 0, short_common_subsequence_length(F.length(a), letters(a), letter_bits(a), b)
        ).alias("short"),
    ).collect()
    for row in rows:
        expected = common(row["a"], row["b"])
        assert row["full"] == expected
        assert row["short"] in (None, expected)


def test_names_are_stripped_of_any_space(spark):
    df = spark.createDataFrame([(" Zip  Code \t",)], "n string")
    row = df.select(normalised_name(F.col("n")), sorted_tokens(F.col("n"))).first()
    assert tuple(row) == ("zip  code", "Code Zip")
