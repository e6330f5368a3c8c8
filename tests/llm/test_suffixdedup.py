from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lethe.llm import induced, suffixdedup

SCHEMA = "doc_id long, text string, n_bytes string, TH string"


def brute(rows, length):
    """By doc_id (distinct ids): bytes, removed, maximal runs and a hash of what stays."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    piece = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    shared = [piece(n) for n in (19, 20, 45, 99, 150, 700)]
    texts = []
    for _ in range(60):
        parts = [rng.choice([piece(rng.randint(0, 60)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 15) :], "x" * rng.randint(0, 200)]) for _ in range(rng.randint(0, 7))]
        texts.append("".join(parts))
    texts += [texts[3], texts[3] + "tail", None, "", "ab" * 3000, piece(9000)]
    return [(k * 7 % 1009, t) for k, t in enumerate(texts)] + [(None, texts[5])]


@pytest.mark.parametrize("length, anchor", [(20, 6), (20, 20), (100, 20)])
def test_equals_brute_force(spark, length, anchor):
    rows = corpus(length + anchor)
    docs = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA).repartition(3)
    found = suffixdedup.digests(suffixdedup.dedup(docs, length=length, anchor=anchor)).collect()
    expected = brute(rows, length)
    assert {r.doc_id: tuple(r)[1:] for r in found} == expected and len(found) == len(rows)
    assert sum(e[1] for e in expected.values()) > 5000


def test_sorting_with_queues_on_disk_and_recursion(spark):
    docs = spark.createDataFrame(corpus(1), "doc_id long, text string").repartition(5)
    parts = suffixdedup.sliced(docs)
    asked = [r for b in parts.collect() for out in suffixdedup._anchors(1, 20, 6)(iter([_batch(b)])) for r in out.to_pylist()]
    answers = suffixdedup._again(pa.Table.from_pylist(asked, pa.schema([("shard", pa.int64()), ("slice", pa.int64()), ("keys", pa.binary())]))).to_pylist()
    bits = {r["slice"]: [{"shard": r["shard"], "bits": r["bits"]}] for r in answers}
    cut = [r for b in parts.collect() for out in suffixdedup._cut(1, 20, 6)(iter([_batch(b, bits.get(b.slice))])) for r in out.to_pylist()]
    blobs = [r["blob"] for r in cut if r["shard"] == 0]
    plain, small = (suffixdedup.repeats(blobs, 20, 6, **x) for x in ({}, {"base_items": 50, "queue_bytes": 500}))
    cover = lambda found: {(n, r, i) for n, r, a, b in zip(*(x.tolist() for x in found)) for i in range(a, b + 1)}
    assert cover(plain) == cover(small) and cover(plain)


def _batch(row, answers=None):
    return pa.RecordBatch.from_pylist([{"slice": row.slice, "image": bytes(row.image), "answers": answers}])


def test_rows_alike_count_as_one_document(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abc") for _ in range(300))
    other = "".join(rng.choice("abc") for _ in range(150)) + text[50:250]
    rows = [(1, text), (1, text), (2, text), (3, other), (3, other), (3, other)]
    for parts in (1, 6):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = sorted((r.doc_id, r.n_removed) for r in suffixdedup.dedup(docs).collect())
        assert found == [(1, 0), (1, 0), (2, 300), (3, 200), (3, 200), (3, 200)]


def _dealt(rows, spark):
    """Blobs of segments of a small table, by shard."""
    parts = suffixdedup.without_copies(suffixdedup.sliced(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)))
    asked = parts.mapInArrow(suffixdedup._anchors(1, 100, 20), "shard long, slice long, keys binary")
    answers = asked.groupBy("shard").applyInArrow(suffixdedup._again, "shard long, slice long, bits binary").groupBy("slice").agg(
        F.collect_list(F.struct("shard", "bits")).alias("answers"))
    return parts.join(answers, "slice", "left").mapInArrow(suffixdedup._cut(1, 100, 20), "shard long, blob binary").collect()


def test_what_a_phrase_shorter_than_a_window_joins_is_not_dealt_or_sorted(spark, monkeypatch):
    rng = random.Random(4)
    own = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    short, longer = ([own(n) for _ in range(10)] for n in (50, 80))
    assert not _dealt([(i, own(300) + short[i % 10] + own(300)) for i in range(200)], spark)
    # A phrase that fills a core meets in a shard, but no window of it is elsewhere, so nothing is left to sort.
    blobs = [r.blob for r in _dealt([(i, own(300) + longer[i % 10] + own(300)) for i in range(200)], spark)]
    sizes, suffixes = [], induced.suffixes
    monkeypatch.setattr(induced, "suffixes", lambda t, *a, **k: sizes.append(len(t)) or suffixes(t, *a, **k))
    assert sum(len(suffixdedup._unpack(b)[-1]) for b in blobs) > 5000
    assert not len(suffixdedup.repeats(blobs, 100, 20)[0]) and not sizes


def test_whole_copies_are_not_dealt(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(500)) for _ in range(20)]
    rows = [(20 * k + i, t) for k in range(5) for i, t in enumerate(texts)] + [(None, texts[3])] * 2 + [(7, texts[7])]
    assert not _dealt(rows[:100], spark)
    found = suffixdedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    whole = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed, r.n_spans) for r in found)
    kept = {(i, t) for i, t in enumerate(texts) if i != 3} | {(None, texts[3])}
    assert whole == sorted((i is not None, i or 0, 0 if (i, t) in kept else 500, 0 if (i, t) in kept else 1) for i, t in rows)


@pytest.mark.parametrize("length, anchor", [(100, 20), (21, 6), (20, 20), (9, 1)])
def test_halves_hold_each_window_once_and_their_core(length, anchor):
    rng = np.random.default_rng(length)
    data = rng.integers(97, 100, 4000, np.uint8)
    offsets = np.array([0, 5, 5, 1500, 1500 + length, 4000])
    doc, first, last, place = suffixdedup.segments(data, offsets, length, anchor)
    own, low, high, core, width = suffixdedup.halves(first, last, place, length, anchor)
    windows = [(int(doc[k]), w) for k, a, b in zip(own, low, high) for w in range(a, b + 1)]
    assert sorted(windows) == [(d, w) for d in range(5) for w in range(offsets[d + 1] - offsets[d] - length + 1)]
    assert (core >= high).all() and (core + width <= low + length).all()


def test_empty_table(spark):
    assert suffixdedup.dedup(spark.createDataFrame([], SCHEMA)).count() == 0
