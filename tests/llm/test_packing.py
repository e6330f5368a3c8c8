from __future__ import annotations

import random
from collections import defaultdict

from lethe.llm import packing
from lethe.llm.tokens import default_vocabulary

SCHEMA = "doc_id long, text string, source string, cluster string, shard string"


def test_best_fit_equals_a_full_search():
    rng = random.Random(3)
    for _ in range(30):
        items = sorted(((rng.randint(1, 100), rng.choice([0, 1, 1, 1, 2, 4]), rng.choice([0, 0, 1, 2])) for _ in range(120)), reverse=True)
        bins, expected = [], []
        for size, source, cluster in items:
            fits = [(b[0], k) for k, b in enumerate(bins) if b[0] >= size and not b[1] & source and not b[2] & cluster]
            if fits:
                k = min(fits)[1]
            else:
                bins.append([100, 0, 0])
                k = len(bins) - 1
            bins[k] = [bins[k][0] - size, bins[k][1] | source, bins[k][2] | cluster]
            expected.append(k)
        assert packing.best_fit(items, 100) == expected


def test_every_token_is_placed_once(spark):
    rng = random.Random(4)
    rows = [(k, "word " * rng.choice([0, 3, 20, 55, 130]), rng.choice(["a", "a", "b", None, "c"]), "", "") for k in range(150)]
    rows += [(None, None, "a", "", ""), (7, "x", None, "", ""), (7, "x", None, "", ""), (500, "tok " * 20000, "b", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    sized = {}
    for r in packing.sizes(docs, default_vocabulary()).collect():
        sized.setdefault(r.doc_id, []).append(r.n_tokens)
    found = packing.run(docs, default_vocabulary(), capacity=64, shard_docs=40).collect()
    total, bins = defaultdict(int), defaultdict(list)
    for r in found:
        total[r.doc_id] += r.n_tokens
        bins[r.bin_id].append(r)
    assert dict(total) == {k: sum(v) for k, v in sized.items()}
    for rows_of_bin in bins.values():
        rows_of_bin.sort(key=lambda r: r.bin_offset)
        ends = 0
        for r in rows_of_bin:
            assert r.bin_offset == ends
            ends += r.n_tokens
        assert ends <= 64
        sources = [r.source for r in rows_of_bin if r.source is not None]
        assert len(set(sources)) == len(sources)
        assert len({r.cluster for r in rows_of_bin}) == len(rows_of_bin)
    assert any(len(v) > 2 for v in bins.values())


def test_empty_table(spark):
    assert packing.run(spark.createDataFrame([], SCHEMA), default_vocabulary()).count() == 0
