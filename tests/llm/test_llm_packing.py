"""Packing against exhaustive search, plain best fit and the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from truegrain.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def fewest(items, capacity):
    """The fewest sequences, by trying every set that can hold the largest piece."""

    @lru_cache(None)
    def solve(rest):
        if not rest:
            return 0
        largest, others = rest[-1], rest[:-1]
        best = len(rest)

        def fill(room, at, kept):
            nonlocal best
            if at < 0:
                best = min(best, 1 + solve(tuple(sorted(kept))))
                return
            if others[at] <= room:
                fill(room - others[at], at - 1, kept)
            fill(room, at - 1, (*kept, others[at]))

        fill(capacity - largest, len(others) - 1, ())
        return best

    return solve(tuple(sorted(items)))


def plain_best_fit(items, capacity):
    rooms = []
    for item in sorted(items, reverse=True):
        fitting = [(r, i) for i, r in enumerate(rooms) if r >= item]
        if fitting:
            rooms[min(fitting)[1]] -= item
        else:
            rooms.append(capacity - item)
    return sorted(rooms)


def used(patterns):
    found = Counter()
    for pattern, times in patterns:
        for length, each in pattern:
            found[length] += each * times
    return found


def test_reduction_keeps_an_optimum():
    pick, fixed_some = random.Random(2), 0
    for _ in range(400):
        capacity = pick.randrange(6, 25)
        items = [pick.randrange(pick.choice([1, 3, capacity // 3]), capacity + 1) for _ in range(pick.randrange(1, 9))]
        counts = np.bincount(items, minlength=capacity + 1)
        fixed = packing.reduce(counts, capacity)
        rest = [length for length in range(capacity + 1) for _ in range(counts[length])]
        assert all(sum(length * n for length, n in p) <= capacity and sum(n for _, n in p) <= 3 for p, _ in fixed)
        assert used(fixed) + Counter(rest) == Counter(items)
        assert sum(times for _, times in fixed) + fewest(rest, capacity) == fewest(items, capacity)
        fixed_some += any(len(p) > 1 or p[0][1] > 1 for p, _ in fixed)
    assert fixed_some > 200


def test_known_dominating_sets():
    def of(items, piece, capacity=100):
        return packing.dominating(np.bincount(items, minlength=capacity + 1), capacity, piece)

    assert of([90, 20, 30], 90) == (90,)
    assert of([70, 30, 20, 5], 70) == (70, 30)  # fills it
    assert of([70, 25, 20, 15], 70) == (70, 25)  # no two others fit
    assert of([50, 20, 26, 19], 50) == (50, 26, 20)  # three others never fit, best pair
    assert of([50, 40, 20, 19], 50) == (50, 40)  # no pair is more than the 40
    assert of([50, 10, 10, 10, 40, 5], 50) is None or of([50, 10, 10, 10, 40, 5], 50)[0] == 50
    assert of([50, 10, 11, 12, 13], 50) is None  # four fit


def test_best_fit_as_one_by_one():
    pick = random.Random(4)
    for _ in range(200):
        capacity = pick.randrange(5, 60)
        items = [pick.randrange(1, pick.choice([4, capacity]) + 1) for _ in range(pick.randrange(0, 60))]
        items = [min(i, capacity) for i in items]
        patterns = packing.best_fit(np.bincount(items, minlength=capacity + 1), capacity)
        assert used(patterns) == Counter(items)
        rooms = sorted(capacity - sum(length * n for length, n in p) for p, times in patterns for _ in range(times))
        assert rooms == plain_best_fit(items, capacity)


def test_plan_of_many_pieces_is_small():
    pick = np.random.default_rng(1)
    histogram = {i: int(pick.integers(1, 10**9)) for i in range(1, 2_049)}
    patterns = packing.plan(histogram)
    assert used(patterns) == Counter(histogram)
    assert len(patterns) < 20_000
    alone = packing.best_fit(np.array([histogram.get(i, 0) for i in range(2_049)]), 2_048)
    assert sum(times for _, times in patterns) <= sum(times for _, times in alone)
    assert packing.plan({}) == []
    with pytest.raises(ValueError):
        packing.plan({4_000: 1})


def prose(seed, count):
    pick = random.Random(seed)
    return " ".join(pick.choice(["a", "of", "the", "lorem", "Ipsum."]) for _ in range(count))


def test_packed_documents(documents):
    texts = [prose(i, n) for i, n in enumerate([3, 80, 127, 128, 129, 1000, 63, 64, 2, 500])]
    texts += [None, "", "   ", "é" * 400, *["the same"] * 30]
    rows = [*enumerate(texts), (None, "a b"), (None, "a b"), (3, texts[3]), (3, "other")]
    tokenizer = Tokenizer.from_file(PATH)
    found = packing.packed(documents(rows), PATH, capacity=128, with_ids=True).collect()
    assert [f for f in packing.packed(documents([(1, "a")]).where("doc_id > 1"), PATH).collect()] == []

    def known(text):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        return [(i // 128, i, ids[i : i + 128]) for i in range(0, len(ids), 128)]

    expected = Counter((d, p, s, tuple(i)) for d, t in rows for p, s, i in known(t))
    assert Counter((r["doc_id"], r["piece"], r["start"], tuple(r["ids"])) for r in found) == expected
    sequences = {}
    for r in found:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["ids"]))
    for own in sequences.values():
        at = 0
        for offset, length, _ in sorted(own):
            assert offset == at
            at += length
        assert at <= 128
    lengths = [r["length"] for r in found]
    assert len(sequences) <= len(plain_best_fit(lengths, 128)) and len(sequences) <= -(-sum(lengths) // 128) + 1
    whole = packing.sequences(packing.packed(documents(rows), PATH, capacity=128, with_ids=True)).collect()
    assert sum(r["n_pieces"] for r in whole) == len(found) and max(len(r["ids"]) for r in whole) <= 128
    assert sum(len(r["ids"]) for r in whole) == sum(lengths)
