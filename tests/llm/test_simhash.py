from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lethe.llm import simhash
from lethe.llm.common import components

SCHEMA = "doc_id long, text string, FP string, t string"


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [w[i : i + 4] for i in range(len(w) - 3)] or ([w] if w else [])
    h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3) + rng.choice(["É", "x", "Q", "日"])
    base = [[word() for _ in range(rng.choice([0, 1, 3, 4, 5, 60, 300]))] for _ in range(25)]
    texts = []
    for words in base:
        for _ in range(6):
            w = list(words)
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = word()
            texts.append(rng.choice([" ", "\n", " \t "]).join(w))
    return [None, "", " ", "tail ", "x" * 40000, *texts]


def test_components_equal_brute_force(spark):
    texts = corpus()
    rows = [(100 - k, t, "", "") for k, t in enumerate(texts)] + [(None, texts[9], "", ""), (100, None, "", "")]
    marks = [fingerprint(r[1]) for r in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4]
    root = roots(len(rows), near)
    least = {}
    for r, (doc_id, *_) in zip(root, rows, strict=True):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    expected = sorted(((d[0], f"{m:016x}", least[r]) for d, m, r in zip(rows, marks, root, strict=True)), key=str)
    found = simhash.digests(simhash.assign(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert len(set(root)) < len(set(marks))


def test_empty_table(spark):
    assert simhash.assign(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_of_dense_and_chance_buckets(spark):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 3)
    values = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for c in centre for _ in range(150)]
    values = np.unique(np.array([v if v < 1 << 63 else v - (1 << 64) for v in values], np.int64))
    near = [(i, j) for i in range(len(values)) for j in range(i) if (int(values[i]) ^ int(values[j])) % (1 << 64) and ((int(values[i]) ^ int(values[j])) & (1 << 64) - 1).bit_count() <= 4]
    want = roots(len(values), near)
    for rows, most in ((values, simhash.BUCKET), (rng.permutation(values), simhash.BUCKET), (values, 100)):
        df = spark.createDataFrame([(int(v),) for v in rows], "fp long")
        edges = [tuple(r) for r in simhash.links(df, most=most).collect()]
        at = {int(v): k for k, v in enumerate(values)}
        assert roots(len(values), [(at[a], at[b]) for a, b in edges]) == want


def test_every_mask_choice_covers_close_pairs():
    rng = random.Random(2)
    for n in (10, 10**5, 10**8, 10**11):
        masks = simhash._masks(n)
        for _ in range(200):
            flips = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(m & flips == 0 for m in masks)


def test_a_template_that_links_nothing_is_split(spark):
    """Fingerprints that agree on 44 bits and are mostly further apart than a link: one bucket of each mask holds them all."""
    rng = np.random.default_rng(4)
    values = np.unique(rng.integers(0, 1 << 20, 600) << 11)
    marks = [int(v) for v in values]
    near = [(i, j) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4]
    at = {v: k for k, v in enumerate(marks)}
    edges = [tuple(r) for r in simhash.links(spark.createDataFrame([(v,) for v in marks], "fp long"), most=50).collect()]
    assert roots(len(marks), [(at[a], at[b]) for a, b in edges]) == roots(len(marks), near)


@pytest.mark.parametrize("search", [0, 10**4])
def test_a_search_that_is_cut_short_finds_the_same(search):
    rng = np.random.default_rng(6)
    sparse = rng.integers(0, 1 << 22, 900) << 30
    dense = [int(sparse[0]) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (200, 2))]
    values = np.unique(np.concatenate([sparse, dense]).astype(np.int64))
    marks = [int(v) for v in values]
    near = [(i, j) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4]
    at = {v: k for k, v in enumerate(marks)}
    links = simhash.forest(values, search=search)
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    assert roots(len(marks), [(at[a], at[b]) for a, b in links]) == roots(len(marks), near)


def test_a_large_bucket_passes_through_however_batches_fall():
    rows = np.array([(1, 0, 5)] * 3 + [(1, 1, k) for k in range(40)] + [(2, 0, 7), (2, 0, 6)], np.int64)
    for step in (1, 3, 7, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in rows[i : i + step].T], ["mask", "key", "fp"]) for i in range(0, len(rows), step)]
        out = [row for b in simhash._bucket_links(10)(iter(batches)) for row in b.to_pylist()]
        assert sorted(r["a"] for r in out if r["mask"] == 1) == list(range(40))
        assert {(r["a"], r["b"]) for r in out if r["mask"] is None} >= {(7, 6)}
        assert all(r["mask"] in (None, 1) for r in out)


def test_finer_masks_cover_close_pairs():
    rng = random.Random(3)
    for mask in simhash._masks(10**6):
        for fine in simhash._finer(mask):
            assert mask % (1 << 64) & fine % (1 << 64) == mask % (1 << 64) and fine != mask
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(50):
            flips = sum(1 << b for b in rng.sample(free, 4))
            assert any(m % (1 << 64) & flips == 0 for m in simhash._finer(mask))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    found = dict(map(tuple, components(edges).collect()))
    assert found == {**{k: 0 for k in range(1, 41)}, 101: 100}
