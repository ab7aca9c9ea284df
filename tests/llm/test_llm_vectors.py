"""Vector codes against plain loops."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from truegrain.llm import orchard

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, codes int, error int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1, 2) for i, v, k in rows], SCHEMA).repartition(3)


def brute(rows, parts=8, entries=16, rounds=6):
    """Codes, errors, label errors and codebooks by whole searches in Python integers."""
    rows = [(i, v, k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], k) for i, v, k in rows]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not whole:
        return [], []
    width = len(whole[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in whole[:entries]] for p in range(parts)]

    def choose(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        taken = [[choose(v, p)[1] for p in range(parts)] for _, v, _ in whole]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), c in zip(whole, taken) if c[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    found, by_label = [], {}
    for i, v, k in whole:
        chosen = [choose(v, p) for p in range(parts)]
        error = sum(d for d, _ in chosen)
        by_label[k] = by_label.get(k, 0) + error
        found.append((i, "".join(f"{e:02x}" for _, e in chosen), error, k))
    flat = ",".join(str(x) for p in books for e in p for x in e)
    return [(i, c, e, by_label[k], hashlib.sha256(flat.encode()).hexdigest()) for i, c, e, k in found], books


def some_rows(seed, count, dims=16, spread=8):
    pick = random.Random(seed)
    return [
        (pick.randrange(10 * count), [pick.randrange(-spread, spread) / 4 for _ in range(dims)], pick.choice([0, 1, None]))
        for _ in range(count)
    ]


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_against_loops(spark, seed):
    rows = some_rows(seed, 150)
    rows += rows[:7] + [(None, [0.5] * 16, 3), (None, [0.25] * 16, None), (5, None, 1), (6, [0.1] * 15 + [None], 1)]
    rows += [(7, [0.1] * 15 + [math.nan], 1), (8, [math.inf] + [0.0] * 15, None), (9, [-0.0001] * 16, 0)]
    found = sorted((tuple(r) for r in orchard.digests(table(spark, rows)).collect()), key=key)
    assert found == sorted(brute(rows)[0], key=key)


def test_fewer_vectors_than_entries_and_none(spark):
    rows = some_rows(3, 5)
    found = sorted((tuple(r) for r in orchard.digests(table(spark, rows)).collect()), key=key)
    assert found == sorted(brute(rows)[0], key=key)
    assert orchard.digests(table(spark, rows).where("vec_id < -1")).count() == 0
    assert orchard.digests(table(spark, [(1, None, 2), (2, [math.nan] * 8, None)])).count() == 0


def test_one_vector_many_times(spark):
    rows = [(i, [0.5, -0.25] * 8, 1) for i in range(40)]
    found = orchard.digests(table(spark, rows)).collect()
    assert len(found) == 40 and {(r["code"], r["error"], r["label_error"]) for r in found} == {("00" * 8, 0, 0)}


def test_other_lengths(spark):
    rows = [(1, [0.1] * 10, 1), (2, [0.2] * 10, 1), (3, [0.3] * 8, 1), (4, [], 1)]
    df = table(spark, rows)
    books = orchard.learn(df)
    assert books.length == 10 and books.entries.shape == (8, 2, 2)
    coded = orchard.codes(df, books)
    assert sorted(r["id"] for r in coded.collect()) == [1, 2]
    back = {r["id"]: r["vector"] for r in orchard.rebuilt(coded, books).collect()}
    assert np.allclose(back[1], 0.1, atol=1 / 4096) and np.allclose(back[2], 0.2, atol=1 / 4096)
    with pytest.raises(Exception, match="greater than"):
        orchard.learn(table(spark, [(1, [1e9] * 8, 1)]))


def test_search_against_all_distances():
    pick = np.random.default_rng(5)
    for entries in (1, 2, 16, 40):
        for spread in (2, 6, 1000):
            points = pick.integers(-spread, spread, (500, 3))
            books = pick.integers(-spread, spread, (entries, 3))
            apart = ((points[:, None] - books[None]) ** 2).sum(axis=2)
            chosen, best = orchard.nearest(points, books)
            assert chosen.tolist() == apart.argmin(axis=1).tolist()
            assert best.tolist() == apart.min(axis=1).tolist()


def test_far_entries_are_not_visited(monkeypatch):
    """Two clusters far apart: a point of one never measures its distance to the other's entries."""
    books = np.array([[i, 0] for i in range(8)] + [[10_000 + i, 0] for i in range(8)])
    order, apart = orchard.neighbours(books)
    assert (order[:, 0] == np.arange(16)).all() and (np.diff(apart, axis=1) >= 0).all()
    points = np.array([[3, 1], [7, 0]])
    touched = set()

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                touched.update(at.tolist())
            return np.asarray(super().__getitem__(at))

    monkeypatch.setattr(orchard, "neighbours", lambda _: (order, apart))
    chosen, _ = orchard.nearest(points, books.view(Watched))
    assert chosen.tolist() == [3, 7] and touched and max(touched) < 8
