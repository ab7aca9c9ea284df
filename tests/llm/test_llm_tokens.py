"""Encoding, planes, lengths and placement against the tokenizers library and plain loops."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from truegrain.llm import bpe, lengths, library, maglev, planes
from truegrain.session import new_shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", "   ", "a\x85b", "a\x1cb", "A<|endoftext|>b", "x<|ENDOFTEXT|>y", "it's don'T", "ΑΣ ας", "a​b",
    "́a b", "İx é ﬁ", "aaaaaaaaaaaaaaaaaaaa!!!!!!!!!!'s", "日本語のテキスト 12½³", "x" * 3000, "ab" * 700,
    "\U0001f600😀's", "The same text.", "The same text.", "é\n\te",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_segment_tree_as_the_library(documents, rows_of, tokenizer):
    found = rows_of(bpe.encode(documents(ODD), PATH))
    assert len(found) == len(ODD)
    for row, text in zip(found, ODD):
        ids = ids_of(tokenizer, text)
        assert row["ids"] == ids
        assert row["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)


def same_ids(encoder, tokenizer, texts):
    ids, counts = encoder.encode_texts(texts)[:2]
    known = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    return counts.tolist() == list(map(len, known)) and ids.tolist() == [i for k in known for i in k]


@pytest.mark.parametrize("kind", [bpe.Encoder, library.LibraryEncoder])
def test_every_code_point_between_two_letters(tokenizer, kind):
    encoder = kind(PATH)
    points = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for begin in range(0, len(points), 50_000):
        some = points[begin : begin + 50_000]
        if not same_ids(encoder, tokenizer, some):
            assert [t for t in some if not same_ids(encoder, tokenizer, [t])] == []


@pytest.mark.parametrize("kind", [bpe.Encoder, library.LibraryEncoder])
def test_random_texts_over_all_planes(tokenizer, kind):
    pick = random.Random(9)
    signs = [chr(c) for c in [*range(0x300), *(pick.randrange(0x110000) for _ in range(3_000))] if not 0xD800 <= c < 0xE000]
    signs += list("\x1c\x1d\x1e\x1f \t\n\r\x85\xa0\u0323\u0301\u0308'st") * 20
    texts = ["".join(pick.choices(signs, k=pick.randrange(40))) for _ in range(20_000)]
    texts += [t[:9] + "<|endoftext|>" + t[9:] for t in texts[:300]]
    encoder = kind(PATH)
    for begin in range(0, len(texts), 5_000):
        assert same_ids(encoder, tokenizer, texts[begin : begin + 5_000])


def test_very_long_words(tokenizer):
    encoder, pick = bpe.Encoder(PATH), random.Random(3)
    assert encoder.ranks.in_order
    for word in ("".join(pick.choices("acgt", k=1_000_000)), "ab" * 60_001, "a" * 70_003, "日本語テキスト" * 9_000):
        assert encoder.encode(word).tolist() == ids_of(tokenizer, word)


def test_ranks_at_once_as_one_by_one():
    ranks = bpe.PairRanks([(1, 1, 2), (2, 2, 3), (2, 1, 4), (3, 4, 5)])
    assert ranks.in_order and not bpe.PairRanks([(1, 2, 3), (2, 1, 4), (3, 1, 4), (4, 4, 3)]).in_order
    pick = random.Random(1)
    for size in (4, 16, 64):
        for _ in range(40):
            n = pick.randrange(1, size + 1)
            symbols = np.array([[pick.choice([1, 1, 2]) for _ in range(n)] + [0] * (size - n)])
            one, many = (bpe.PairTrees(symbols.copy(), np.array([n]), ranks) for _ in range(2))
            one.merge_all()
            many.merge_ranks()
            assert one.symbols[one.alive].tolist() == many.symbols[many.alive].tolist()


def test_digests(documents, rows_of, tokenizer):
    found = rows_of(bpe.digests(bpe.encode(documents(ODD), PATH)))
    for row, text in zip(found, ODD):
        ids = ids_of(tokenizer, text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_root_is_leftmost_of_lowest_rank():
    ranks = bpe.PairRanks([(1, 1, 2), (2, 2, 3), (2, 1, 4)])
    for symbols in ([1] * 9, [1, 1, 2, 1, 1, 1], [2, 2, 2], [1], [3, 3], [1, 2, 1, 2, 2]):
        trees = bpe.PairTrees(np.array([symbols + [0] * (16 - len(symbols))]), np.array([len(symbols)]), ranks)
        trees.merge_all()
        plain = list(symbols)
        while True:
            best = [(r, i) for i in range(len(plain) - 1) if (r := int(ranks(np.array(plain[i]), np.array(plain[i + 1])))) >= 0]
            if not best:
                break
            rank, i = min(best)
            plain[i : i + 2] = [int(ranks.merged[rank])]
        assert trees.symbols[trees.alive].tolist() == plain


def test_empty_table(documents):
    none = documents([(1, "a")]).where("doc_id > 1")
    assert bpe.encode(none, PATH).count() == 0
    assert lengths.histogram(lengths.encoded_lengths(none, PATH)).count() == 0
    assert maglev.place(none, ["a"]).count() == 0


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_planes_round_trip(kind):
    for count in (0, 1, 7, 8, 100, 1000):
        ids = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint64).astype(planes.ID)
        index, payload = planes.pack(ids, kind, block=64)
        assert sum(index) == len(payload)
        assert planes.unpack(index, payload, count, kind, block=64).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_written_files_read_back(spark, documents, tokenizer, kind):
    path = new_shared_path(spark, "planes")
    texts = [*ODD, *("word %d and more" % i for i in range(300))]
    planes.write(documents([(7 * i - 50, t) for i, t in enumerate(texts)]), path, PATH, kind=kind, block=128)
    found = sorted(planes.read(spark, path).collect(), key=lambda r: r["doc_id"])
    start = 0
    for row, text in zip(found, texts, strict=True):
        ids = [*ids_of(tokenizer, text), 1]
        assert (row["start"], row["n_tokens"], row["ids"]) == (start, len(ids), ids)
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_null_and_repeated_ids(spark, documents):
    path = new_shared_path(spark, "planes")
    planes.write(documents([(None, "a b"), (3, "c"), (3, "c"), (3, "d e f")]), path, PATH)
    found = planes.read(spark, path).collect()
    assert sorted(r["start"] for r in found) == [0, *np.cumsum([r["n_tokens"] for r in sorted(found, key=lambda r: r["start"])])[:-1].tolist()]
    assert min(found, key=lambda r: r["start"])["doc_id"] is None


def test_histogram_against_loops(spark, rows_of):
    random.seed(4)
    values = [0, 0, *(int(random.expovariate(1 / 900)) for _ in range(400)), None]
    found = lengths.histogram(spark.createDataFrame([(v,) for v in values], "length int"))
    known = [v for v in values if v is not None]
    for row in rows_of(found, "length"):
        n = row["length"]
        assert row["n_docs"] == Counter(known)[n]
        assert row["docs_from"] == sum(v >= n for v in known)
        assert row["tokens_from"] == sum(v for v in known if v >= n)
        assert row["truncated_total"] == sum(min(v, n) for v in known)
        assert (row["docs_total"], row["tokens_total"]) == (len(known), sum(known))
    limits = {r["limit"]: r["truncated_total"] for r in lengths.truncated_totals(found, [0, 1, 77, 100_000]).collect()}
    assert limits == {m: sum(min(v, m) for v in known) for m in (0, 1, 77, 100_000)}
    ordered = sorted(known)
    for r in lengths.quantiles(found, [0.0, 0.5, 0.9, 1.0]).collect():
        assert r["length"] == ordered[max(1, int(np.ceil(r["share"] * len(ordered)))) - 1]


def test_lookup_table_is_even_and_moves_little():
    shards = [f"s{i}" for i in range(20)]
    before = maglev.lookup_table(shards, 10_007)
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    after = maglev.lookup_table([s for s in shards if s != "s7"], 10_007)
    names = [s for s in shards if s != "s7"]
    moved = sum(shards[a] != names[b] for a, b in zip(before, after))
    assert moved < 2 * 10_007 / 20
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            maglev.lookup_table(bad)
    with pytest.raises(ValueError):
        maglev.lookup_table(["a"], 100)


def test_turns_by_the_slow_way():
    """Each shard's whole preference list, and turns over these."""
    shards, slots = ["a", "b", "c"], 31
    lists = [
        [(maglev._number(f"{s}/offset") + k * (maglev._number(f"{s}/skip") % (slots - 1) + 1)) % slots for k in range(slots)]
        for s in shards
    ]
    owner: dict[int, int] = {}
    while len(owner) < slots:
        for i, order in enumerate(lists):
            free = [p for p in order if p not in owner]
            if free:
                owner[free[0]] = i
    assert maglev.lookup_table(shards, slots) == [owner[p] for p in range(slots)]


def test_placement(documents, rows_of):
    found = rows_of(maglev.place(documents([(1, "a"), (2, "b"), (2, "b"), (None, None)]), ["x", "y", "z"]))
    table = maglev.lookup_table(["x", "y", "z"])
    assert len(found) == 4
    for row in found:
        slot = maglev._number("" if row["doc_id"] is None else str(row["doc_id"])) % maglev.SLOTS
        assert (row["slot"], row["shard"]) == (slot, "xyz"[table[slot]])
