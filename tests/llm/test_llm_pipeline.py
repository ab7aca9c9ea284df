"""The whole pipeline against brute force, stage by stage, on a small table."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
from test_llm_copies import brute_components, near_copies, prose, shingle_set
from test_llm_text import ITEM, brute_contaminated
from tokenizers import Tokenizer

import corpus_pipeline


def brute_cut(texts, length=200):
    """What is left of each text without bytes of strings that start at two places."""
    raw = [t.encode() for t in texts]
    seen: dict[bytes, int] = {}
    for r in raw:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] = seen.get(r[i : i + length], 0) + 1
    left = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        left.append(bytes(np.frombuffer(r, np.uint8)[~gone]).decode("utf-8", "ignore"))
    return left


def brute_run(rows, items):
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    _, roots = brute_components([t for _, t in rows], 5, 8, 10)
    ids = [i for i, _ in rows]
    least = {}
    for place, root in enumerate(roots):
        least[root] = min(least.get(root, ids[place]), ids[place])
    rows = [(i, t) for (i, t), root in zip(rows, roots) if i == least[root] or not shingle_set(t, 5)]
    left = brute_cut([t for _, t in rows])
    rows = [(i, t) for (i, _), t in zip(rows, left) if t]
    dirty = {d for d, _ in brute_contaminated([t for _, t in rows], items)}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {}
    for place, (i, t) in enumerate(rows):
        if place not in dirty:
            ids = tokenizer.encode(t, add_special_tokens=False).ids
            decoded = tokenizer.decode(ids, skip_special_tokens=False)
            found[i] = (ids, hashlib.sha256(decoded.encode()).hexdigest())
    return found


def test_run_against_brute_force(spark, tmp_path):
    shared = prose(90, 60)
    texts = near_copies() + [prose(600 + i, 80) + " " + shared + " " + prose(700 + i, 80) for i in range(6)]
    texts += [prose(800, 60) + ". " + ITEM + " " + prose(801, 60), prose(802, 300), "12 34 -- 56", shared]
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    items = [ITEM, "another item of the benchmark that nobody copied anywhere at all"]
    table = [(i, t, "en" if i % 3 else "fr", "s", len(t or "")) for i, t in rows]
    documents = spark.createDataFrame(table, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = {r["doc_id"]: (r["ids"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == brute_run(rows, items)
