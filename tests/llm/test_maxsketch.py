"""Ranked lexical search against scores of all pairs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lethe.llm import maxsketch
from lethe.scratch import scratch_path

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    found = [(d, Counter(terms(t))) for d, t in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    n_docs, length = len(found), sum(n for _, _, n in found)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in found:
            m = 100 - 90 + (90 * n * n_docs) // length
            score = 0
            for t in set(terms(text)):
                if t in c:
                    df = sum(t in other for _, other, _ in found)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:k], 1)]
    return out


def key(row):
    return tuple((v is None, v or 0) for v in row)


def searched(spark, docs, items, **options):
    path = scratch_path(spark, "index")
    maxsketch.build(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), path)
    found = maxsketch.search(spark, path, spark.createDataFrame(items, "item_id long, text string"), **options)
    return sorted((tuple(r) for r in found.collect()), key=key)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(500)] + ["Éa", "ÉA", "straße", "x9"]
    docs = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 30, 300])))) for k in range(300)]
    docs += [(400 + k, docs[5][1]) for k in range(40)] + [docs[7], docs[7], (None, docs[5][1]), (None, "w1 w1"), (500, None), (501, ""), (502, "-- !?")]
    docs += [(600, "w1 " * 70000 + "w2")]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 25])))) for k in range(30)]
    items += [(40, docs[5][1]), (41, "W1;w1/W2"), (42, None), (43, ""), (44, "unheard of"), (3, "w5 w6"), (None, "w7")]
    return docs, items


def test_search(spark, corpus):
    assert searched(spark, *corpus) == sorted(brute(*corpus), key=key)


def test_blocks_of_items(spark, corpus, monkeypatch):
    monkeypatch.setattr(maxsketch, "BLOCK_BYTES", 300)
    assert searched(spark, *corpus, k=3) == sorted(brute(*corpus, k=3), key=key)


def test_bounds_hold_and_spare_work(corpus):
    docs, items = corpus
    block = maxsketch.Block([(k, (t or "").encode()) for k, (_, t) in enumerate(items)])
    block.weights = np.arange(1, len(block.terms) + 1)
    scored = 0
    for _, text in docs:
        found = Counter(maxsketch.terms_of((text or "").encode()))
        if found:
            counts = np.fromiter(found.values(), np.uint32, len(found))
            bounds = block.bounds(maxsketch.sketch_of(list(found), counts), 55, {})
            exact = block.scores((b" ".join(found), counts.tobytes()), 55, list(range(len(block.keys))))
            assert (bounds >= exact).all()
            scored += int(sum(b > 0 for b in bounds)) - sum(e > 0 for e in exact)
    assert scored < 0.5 * len(docs) * len(block.keys)


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None)], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], [(1, "a"), (1, "a")]) == [(1, 1, 1, 287 * (1000000000 // 1800))] * 2


def test_clashing_columns(spark):
    docs = spark.sql("SELECT 4L AS doc_id, 'a b' AS text, 1 AS n, 'x' AS terms, 2 AS sketch")
    items = spark.sql("SELECT 2L AS item_id, 'a' AS text, 1 AS item, 3 AS rank, 5 AS doc_id")
    path = scratch_path(spark, "index")
    maxsketch.build(docs, path)
    assert [tuple(r)[:3] for r in maxsketch.search(spark, path, items).collect()] == [(2, 1, 4)]
