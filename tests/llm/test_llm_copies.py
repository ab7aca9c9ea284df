"""Fingerprints, repeated passages and similar documents against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from truegrain.llm import jaccard, prefixtree, repeats, sketch, suffixes

WORDS = ["of", "the", "Lorem", "ipsum", "dolor", "sit", "amet,", "consectetur", "elit.", "é", "sed", "do", "xyz"]


def prose(seed, count):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(count))


# --- fingerprints


def shingle_set(text, size):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, min(len(words), 1)))}


def test_fingerprints(documents, rows_of):
    texts = [prose(i, n) for i, n in enumerate([3, 60, 400, 1, 2000, 300])] + [None, "", "same words here", "same words here", "ü" * 5000]
    df = documents([(5 * i, t) for i, t in enumerate(texts)])
    found = rows_of(sketch.fingerprints(df))
    assert [r["doc_id"] for r in found] == [5 * i for i in range(len(texts))]
    whole = [t or "" for t in texts]
    for i, row in enumerate(found):
        own, following = whole[i], whole[i - 1]
        third = len(own) // 3
        other = own[: len(own) - third] + following[:third]
        assert row["n_chars"] == len(own)
        assert row["edited_sha256"] == hashlib.sha256(other.encode()).hexdigest()
        for near, a, b in ((row["near_edited"], own, other), (row["near_next"], own, following)):
            a, b = shingle_set(a, 5), shingle_set(b, 5)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - true) < (1e-9 if max(len(a), len(b)) <= sketch.LEAST else 0.15)
    assert found[8]["fingerprint"] == found[9]["fingerprint"]
    assert found[6]["fingerprint"] == "0:"


def test_fingerprint_ties_nulls_and_one_row(documents):
    assert sketch.fingerprints(documents([(1, "a b")]).where("doc_id > 1")).count() == 0
    one = sketch.fingerprints(documents([(1, "a b c d")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert sketch.fingerprints(documents([(None, "z"), (2, "a"), (2, "a"), (2, "b"), (None, None)])).count() == 5


def test_sketches_merge():
    a, b = prose(1, 3000), prose(2, 150)
    both = sketch.sketches([a, b, a + " " + b, ""])
    joined = sketch.merge(both[0], both[1])
    assert sketch.containment(both[1], joined) > 0.95
    assert sketch.containment(both[1], both[2]) > 0.9
    assert sketch.containment(both[0], both[1]) < 0.1
    assert sketch.likeness(joined, both[2]) > 0.9
    assert sketch.parse(both[0].text()).hashes.tolist() == both[0].hashes.tolist()
    assert sketch.containment(both[3], both[0]) == 0.0


# --- repeated passages


def test_deep_shallow_order():
    pick = random.Random(1)
    for _ in range(60):
        n, length, signs = pick.randint(1, 300), pick.choice([8, 16, 40, 64]), pick.choice(["a", "ab", "abcd"])
        raw = "".join(pick.choice(signs) for _ in range(n + length))
        if pick.random() < 0.5:
            raw = (raw[:30] * 40)[: n + length]
        raw = raw.encode()
        places = np.array(pick.sample(range(n), pick.randint(1, n)))
        buckets = None if pick.random() < 0.5 else np.array([raw[p] for p in places])
        order, numbers = suffixes.suffix_classes(raw, places, length, buckets)
        texts = [raw[p : p + length] for p in places[order]]
        assert texts == sorted(texts) and sorted(order.tolist()) == list(range(len(places)))
        ranks = {t: i for i, t in enumerate(sorted(set(texts)))}
        assert numbers.tolist() == [ranks[raw[p : p + length]] for p in places]


def brute_removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    found = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        found.append((len(r), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return found


def passages():
    shared, other = prose(90, 45), prose(91, 120)
    texts = [None, "", "short", prose(1, 200), prose(1, 200), "a" * 900, "ab" * 300, "héé" * 100]
    texts += [prose(i, 40) + shared + prose(i + 100, 60) for i in range(2, 14)]
    texts += [prose(20, 30) + other[:k] + " end" for k in (198, 199, 200, 201, 300, 700)]
    texts += [other[i:] + prose(50 + i, 20) for i in (0, 1, 2, 40)] + [prose(70, 90) * 3]
    copy = prose(71, 300)
    return texts + [copy[:i] + "#" + copy[i + 1 :] for i in (0, 100, 199, 200, 201, 900)]


@pytest.mark.parametrize("together", [1000, 3])
def test_repeats_against_brute_force(documents, rows_of, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    texts = passages()
    found = rows_of(repeats.digests(repeats.removed(documents(texts))))
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found]
    assert got == brute_removed(texts, 200)


def test_spans_of_a_short_period_are_united():
    assert len(repeats.spans(b" " * 1_000_000, 200)[0]) == 1
    for period in (b"ab", b"abc", b"x" * 39 + b"y"):
        assert len(repeats.spans(period * 9_000, 200)[0]) <= 4


def test_near_copies_of_one_text(documents, rows_of, monkeypatch):
    """Hundreds of different spans of each anchor: cut by further anchors, and by digests beyond."""
    pick, copy = random.Random(6), prose(72, 90)
    texts = []
    for _ in range(240):
        at = pick.randrange(len(copy))
        texts.append(copy[:at] + pick.choice("#$%&") + copy[at + 1 :])
    monkeypatch.setattr(repeats, "TOGETHER", 8)
    found = rows_of(repeats.digests(repeats.removed(documents(texts))))
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found] == brute_removed(texts, 200)


def test_parts_of_equal_windows_meet():
    """Windows that two spans share, at any place, are in parts of equal keys."""
    shared = prose(73, 60).encode()
    one, two = b"0123456789" * 3 + shared, shared + b" and the rest of it " * 4
    seen = []
    for raw in (one, two):
        anchor = raw.index(shared) + 100
        key, first, count, _, _ = repeats.parts(raw, anchor, 50, 200)
        assert first[0] == 0 and (first[1:] == np.cumsum(count)[:-1]).all() and count.sum() == len(raw) - 199
        windows = {raw[i : i + 200]: k for a, c, k in zip(first, count, key) for i in range(a, a + c)}
        seen.append(windows)
    both = seen[0].keys() & seen[1].keys()
    assert len(both) == len(shared) - 199 and all(seen[0][w] == seen[1][w] for w in both)


def test_repeats_ties_and_empty(documents, rows_of):
    text = prose(3, 100)
    found = rows_of(repeats.digests(repeats.removed(documents([(1, text), (1, text), (1, prose(4, 100)), (None, prose(5, 90))]))))
    assert sorted(r["n_removed"] for r in found) == [0, 0, *[len(text.encode())] * 2]
    assert repeats.removed(documents([(1, text)]).where("doc_id > 1")).count() == 0


def test_kept_documents(documents, rows_of):
    shared = prose(90, 60)
    df = documents([(1, "one " + shared + " x"), (2, shared), (3, None), (4, "clean"), (5, "")])
    found = rows_of(repeats.kept_documents(df))
    assert [r["doc_id"] for r in found] == [1, 3, 4, 5]
    assert found[0]["text"] == "one  x" and found[0]["n_chars"] == 6
    assert repeats.kept_documents(df).columns == df.columns


# --- similar documents


def brute_components(texts, gram, over, under):
    sets = [shingle_set(t, gram) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and under * len(sets[i] & sets[j]) >= over * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [top(i) for i in range(len(texts))]


def near_copies():
    pick = random.Random(5)
    texts = [None, "", " ", "one", "one", "One two", "one two three", "a b c d", "A b c  d"]
    for seed, size in enumerate([12, 14, 20, 21, 30, 60, 60, 100, 200, 400]):
        base = prose(200 + seed, size).split(" ")
        for _ in range(7):
            words = list(base)
            for _ in range(pick.choice([0, 1, 1, 2, 3, 5, 9])):
                words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
            if pick.random() < 0.3:
                words = words[: int(len(words) * pick.choice([0.9, 0.95, 0.97]))]
            texts.append(" ".join(words))
    texts += ["the same licence line is here for all " + prose(400 + i, 9) for i in range(30)]
    return texts


@pytest.mark.parametrize("gram,over,under,block", [(3, 9, 10, 400_000), (5, 8, 10, 400_000), (3, 9, 10, 150), (1, 1, 2, 400_000), (2, 1, 1, 90)])
def test_components_against_brute_force(documents, rows_of, monkeypatch, gram, over, under, block):
    monkeypatch.setattr(jaccard, "BLOCK_ELEMENTS", block)
    texts = near_copies()
    found = rows_of(jaccard.linked_components(documents(texts), gram=gram, over=over, under=under))
    sizes, roots = brute_components(texts, gram, over, under)
    assert [r["n_shingles"] for r in found] == sizes
    assert [r["component_id"] for r in found] == roots


def test_links_are_counted(documents, rows_of):
    base = prose(1, 100).split()
    texts = [" ".join(base), " ".join(base), " ".join([*base[:50], "x", *base[51:]]), prose(2, 100)]
    found = rows_of(jaccard.linked_components(documents(texts)))
    assert [r["n_links"] for r in found] == [1, 1, 1, 0]


def test_every_linking_pair_shares_a_box():
    pick = random.Random(9)
    for over, under in ((9, 10), (8, 10), (1, 2)):
        for _ in range(300):
            size = pick.randint(1, 120)
            a = {pick.randrange(1 << 60) for _ in range(size)}
            b = set(list(a)[pick.randint(0, max(0, size // 8)) :]) | {pick.randrange(1 << 60) for _ in range(pick.randint(0, size // 8))}
            if not b or under * len(a & b) < over * len(a | b):
                continue
            marks, owner, slack = jaccard.box_marks([np.array(sorted(s), np.uint64) for s in (a, b)], over, under)
            # Each set forgets some of its marks, those of greatest number here: one in common is left.
            left = []
            for i in (0, 1):
                kept = set()
                for kind in set(slack[owner == i].tolist()):
                    own = sorted(marks[(owner == i) & (slack == kind)].tolist())
                    kept |= set(own[: len(own) - kind // 2])
                left.append(kept)
            assert left[0] & left[1]


def test_prefix_tree_search():
    pick = random.Random(3)
    sets = [np.array(sorted(pick.sample(range(40), pick.randint(1, 20)))) for _ in range(60)]
    sets += [s[: max(1, len(s) - 1)] for s in sets[:30]] + [sets[0]]
    tree = prefixtree.PrefixTree(sets, 40)
    for over, under in ((1, 2), (8, 10), (9, 10), (1, 1)):
        for asked in sets:
            got = sorted(tree.similar(asked, over, under).tolist())
            q = set(asked.tolist())
            assert got == [i for i, s in enumerate(sets) if under * len(q & set(s.tolist())) >= over * len(q | set(s.tolist()))]


def test_rows_without_id_and_no_rows(documents, rows_of):
    found = rows_of(jaccard.linked_components(documents([(None, "a b c d"), (4, "a b c d"), (9, "a b c d"), (9, "a b c d")])))
    assert [r["component_id"] for r in found] == [None, 4, 4, 4]
    assert jaccard.linked_components(documents([(1, "a")]).where("doc_id > 1")).count() == 0


def test_one_of_each(documents, rows_of):
    base = prose(1, 120).split()
    texts = [(8, " ".join(base)), (3, " ".join([*base[:60], "x", *base[61:]])), (5, prose(2, 80)), (6, None), (7, "")]
    assert [r["doc_id"] for r in rows_of(jaccard.one_of_each(documents(texts)))] == [3, 5, 6, 7]


def test_a_sieve_loses_no_key(spark, monkeypatch):
    from truegrain.llm import common

    df = spark.range(2000).selectExpr("id", "cast(id % 7 as string) as t", "'x' as text")
    keys = df.where("id % 50 = 3").select("id", "t")
    for bits, most in ((1 << 24, 60), (64, 2000)):
        monkeypatch.setattr(common, "SIEVE_BITS", bits)
        found = common.sieved(df, keys, ["id", "t"])
        assert found.columns == df.columns
        ids = {r["id"] for r in found.collect()}
        assert {r["id"] for r in keys.collect()} <= ids and len(ids) <= most
    assert common.sieved(df, keys.where("false"), ["id", "t"]).count() == 0


def test_one_of_each_repeated_rows_and_ids(documents, rows_of):
    a, b, c, d = (prose(900 + i, 80) for i in range(4))
    rows = [(9, a), (9, a), (9, b), (4, b), (None, b), (None, c), (None, c), (7, d), (None, d), (11, None), (11, None), (12, "")]
    df = documents(rows)
    once = jaccard.one_of_each(df)
    assert once.columns == df.columns
    wanted = [(4, b), (7, d), (9, a), (11, None), (12, ""), (None, c)]
    assert sorted(((r["doc_id"], r["text"]) for r in once.collect()), key=str) == sorted(wanted, key=str)
    left = sorted(((r["doc_id"], r["text"]) for r in repeats.kept_documents(once.where("text <> ''")).collect()), key=str)
    assert left == sorted([(4, b), (7, d), (9, a), (None, c)], key=str)
