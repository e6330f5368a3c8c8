"""Groups of near copies at five-word shingles and similarity 0.8, against all pairs."""

from __future__ import annotations

import random

from lethe.llm import nearcopies, simhash


def shingles(text, width=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for g, (d, _) in zip(group, rows, strict=True):
        least[g] = min(d, least.get(g, d))
    return sorted(least.values())


def corpus(seed=4):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    rows = []
    for _ in range(30):
        base = [word() for _ in range(rng.choice([3, 60, 200]))]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w)))
    return rows + [(len(rows), None), (len(rows) + 1, " ")]


def test_one_of_each_group_stays(spark):
    rows = corpus()
    found = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = sorted(r.doc_id for r in found.collect())
    assert kept == brute(rows) and len(kept) < len(rows)


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "BLOCK_SETS", 3)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(100)]
    rows = [(k, " ".join(["new" + str(rng.random()) if i == j else x for i, x in enumerate(base)])) for k, j in enumerate(rng.sample(range(100), 25))]
    found = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in found.collect()) == brute(rows)
