from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lethe.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, N_HIT string, items string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width):
    windows = {}
    for item_id, text in items:
        w = words(text)
        n = min(len(w), width)
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item_id))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def random_case(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(["a", "B", "Éé", "7"]) + rng.choice(" -\n,") for _ in range(n))
    items = [(k, text(rng.choice([0, 1, 2, 3, 5]))) for k in range(10)] + [(77, None)]
    docs = [(k, text(rng.choice([0, 3, 40]))) for k in range(60)] + [(None, "a b"), (3, None), (3, ""), (4, "é" * 30000)]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 20, 12])
def test_equals_brute_force(spark, limit):
    docs, items = random_case(limit)
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA)
    scanned = decontaminate.scan(df, spark.createDataFrame(items, "item_id long, text string"), width=3, limit_bytes=limit)
    assert sorted(map(tuple, decontaminate.digests(scanned).collect()), key=str) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = random_case(1)
    none = spark.createDataFrame([], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert not decontaminate.scan(df, none).where("n_hit > 0").count()
    assert decontaminate.scan(df.limit(0), spark.createDataFrame(items, none.schema)).count() == 0


def test_cleaned_cuts_the_hit_span(spark):
    docs = [(1, "Keep this text. One two three! And this one stays here."), (2, "one, two THREE"), (3, "clean"), (4, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three"), (2, "stays here")], "item_id long, text string")
    for limit in (1 << 20, 12):
        cleaned = decontaminate.clean(df, items, limit_bytes=limit)
        assert dict(map(tuple, cleaned.collect())) == {1: "Keep this text. ! And this one .", 3: "clean", 4: None}


def test_repeated_items_are_split_into_parts_under_the_limit(spark):
    items = spark.createDataFrame([(1, "one two three")] * 500 + [(k, f"item {k} of many") for k in range(2, 40)] + [(99, "w " * 400)], "item_id long, text string")
    once = items.select(F.col("item_id").cast("string"), "text").distinct()
    parts = decontaminate._parts(once, 60)
    sizes = once.groupBy(decontaminate._part_of(parts)).agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n"))
    assert all(r["size"] <= 60 or r.n == 1 for r in sizes.collect())
    assert decontaminate._parts(once, 1 << 20) == 1
    docs = spark.createDataFrame([(1, "x one two three"), (2, "clean")], "doc_id long, text string")
    found = decontaminate.scan(docs, items.where("item_id = 1"), limit_bytes=4)
    assert sorted((r.doc_id, r.n_hit, r["items"]) for r in found.collect()) == [(1, 3, ["1"]), (2, 0, [])]
