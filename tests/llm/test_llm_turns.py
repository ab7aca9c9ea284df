"""Repair of conversations against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from truegrain.llm import turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n int, conversation string, part int"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def cheapest(rows):
    """Cost, audit and lines by a search over (row, what was written); rows: (role, text, fault)."""

    @lru_cache(None)
    def solve(at, state):  # state as the last initials written: "", "s", "u" or "a"
        best = None
        if at == len(rows) and state in ("", "a"):
            best = (0, "", ())
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        options = []
        if at < len(rows):
            role, text, fault = rows[at]
            options.append((2, "D", at + 1, state, None))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] and role[:1] in allowed:
                    options.append((more, "K", at + 1, role[:1], (role, text)))
                for new in ("user", "assistant"):
                    if new[0] in allowed:
                        options.append((1 + more, "R", at + 1, new[0], (new, text)))
        if inserted[0] < 3:
            for new in ("user", "assistant"):
                if new[0] in allowed:
                    options.append((5, "I", at, new[0], (new, "")))
        for cost, letter, then, to, line in options:
            if letter == "I":
                inserted[0] += 1
            rest = search(then, to) if letter == "I" else solve(then, to)
            if letter == "I":
                inserted[0] -= 1
            if rest:
                found = (cost + rest[0], letter + rest[1], ((line,) if line else ()) + rest[2])
                if best is None or found[:2] < best[:2]:
                    best = found
        return best

    # Insertions at one place: at most three, searched without the cache of their own place.
    def search(at, state):
        return solve.__wrapped__(at, state)

    inserted = [0]
    return solve(0, "")


def brute(table, damage=True):
    found = {}
    for conversation in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in (r for r in table if r[0] == conversation):
            name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            fate = zlib.crc32(name.encode()) % 20 if damage else 9
            role, text = " " if role is None else role, " " if text is None else text
            if fate == 0:
                continue
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            rows += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            faults.append(fault)
            seen.add((role, text))
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(tuple((r, t, f) for (_, r, t), f in zip(rows, faults)))
        text = "\n".join(f"{r}:{t}" for r, t in lines)
        counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
        found[conversation] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return found


def some_table(seed, conversations=60):
    pick = random.Random(seed)
    texts = ["Yes.", "no", "Well then!", "and so on", "", " \t", "ok.", "Why?", "a\nb.", "é.", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    weights = [8, 8, 2, 8, 8, 1, 1, 1, 1]
    rows = []
    for c in range(conversations):
        turn = pick.randrange(3)
        for _ in range(pick.randrange(1, 9)):
            rows.append((c, pick.choice([turn] * 9 + [None]), pick.choices(roles, weights)[0], pick.choice(texts)))
            turn += pick.choice([0, 1, 1, 1, 1, 2])
    return rows


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA).repartition(3)


def summary(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    found = [(r["conv_id"], tuple(r[c] for c in names)) for r in df.collect()]
    assert len({c for c, _ in found}) == len(found)
    return dict(found)


@pytest.mark.parametrize("limits", [(20_000, 2 << 20), (2, 2 << 20), (1, 3)])
def test_against_search(spark, limits):
    rows = some_table(limits[0]) + [(None, None, "user", "Hi."), (None, 3, "assistant", "Lo."), (None, 3, None, None)]
    rows += [(900, t, "user" if t % 2 else "assistant", "Word %d." % t) for t in range(6)] * 2
    found = summary(turns.summaries(turns.repair(table_of(spark, rows), rows_at_most=limits[0], bytes_at_most=limits[1])))
    assert found == brute(rows, damage=False)


def test_damage(spark):
    rows = some_table(5, 150) + [(None, None, None, None)]
    rows += [next((c, 0, "user", "Dropped.") for c in range(1_000, 2_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)]
    found = summary(turns.summaries(turns.repair(turns.damaged(table_of(spark, rows)), count_col="n")))
    expected = brute(rows)
    assert found == expected
    gone = [c for c, r in found.items() if r == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert gone


def test_turns_that_are_left(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Why?"), (1, 2, "user", "So."), (1, 3, "assistant", ""), (2, 0, "user", "x")]
    pieces = turns.repair(table_of(spark, rows))
    left = sorted((r["conversation"], r["part"], r["seq"], r["place"], r["role"], r["text"]) for r in turns.turns(pieces).collect())
    assert [(c, r, t) for c, _, _, _, r, t in left] == [(1, "system", "Be brief."), (1, "user", "Why?"), (1, "assistant", "So.")]
    assert summary(turns.summaries(pieces))[1][6] == "KKRD"


def test_one_conversation_with_most_rows(spark):
    """Long runs, many tasks, and repeated rows counted before they are sorted."""
    rows = [(7, i, "user" if i % 3 else "assistant", f"Text {i}.") for i in range(700)]
    rows += [(7, 700, "assistant", "The same.")] * 300 + [(7, 701 + i, "user", "cut") for i in range(200)]
    rows += [(8, 1, "user", "Hi."), (8, 2, "assistant", "Lo.")]
    found = summary(turns.summaries(turns.repair(table_of(spark, rows), rows_at_most=50)))
    whole = summary(turns.summaries(turns.repair(table_of(spark, rows))))
    assert found == whole
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = found[7]
    assert (gaps, blank, duplicate, truncated) == (0, 0, 299 + 199, 1)
    plain = np.full(turns.STATES, turns.NEVER)
    plain[0] = 0
    symbols = ["u" if i % 3 else "a" for i in range(700)] + ["a"] + [turns.GONE] * 299 + ["u!"] + [turns.GONE] * 199
    for symbol in symbols:
        plain = (plain[:, None] + turns.power(symbol, 0)).min(axis=0)
    assert cost == min((plain[:, None] + turns.INSERTIONS).min(axis=0)[[0, 3]])
    assert len(audit.replace("I", "")) == len(symbols)


def test_powers_are_products():
    for symbol in ("u", "a", "s", "-", "u!", "a!", "-!", turns.GONE):
        one, total = turns.power(symbol, 0), None
        for n in range(1, 20):
            total = one if total is None else turns.product(total, one)
            assert (turns.run_matrix(symbol, n) == total).all()
            assert turns.back(symbol, n, turns.at_end()) == turns.apply(total, turns.at_end())


def test_empty_table(spark):
    empty = table_of(spark, [(1, 1, "user", "a")]).where("conv_id > 1")
    assert turns.summaries(turns.repair(empty)).count() == 0
