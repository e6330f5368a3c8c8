from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lethe.llm import wavelet
from lethe.llm.tokens import Encoder, default_vocabulary, encoder

SCHEMA = "doc_id long, text string, TEXT_ string, start string"


@pytest.mark.parametrize("size", [0, 1, 7, 511, 512, 513, 3000])
def test_matrix_answers_like_a_list(size):
    ids = np.random.default_rng(size).integers(0, 70 if size % 2 else 50257, size)
    matrix = wavelet.WaveletMatrix.build(ids)
    assert matrix.all().tolist() == ids.tolist()
    for i in range(0, size, 17):
        token = int(ids[i])
        assert matrix.access(i) == token
        assert matrix.count(token) == int((ids == token).sum())
        assert matrix.count(token, i) == int((ids[:i] == token).sum())
        assert matrix.positions(token).tolist() == np.flatnonzero(ids == token).tolist()
        assert [matrix.select(token, k) for k in range(3)] == [*np.flatnonzero(ids == token)[:3], -1, -1, -1][:3]
    assert matrix.count(60000) == 0 and matrix.select(60000, 0) == -1


def test_encoder_equals_library():
    own, rng = Encoder(default_vocabulary()), random.Random(5)
    alphabet = "ab's tredvlm1 2\n\t\r\u0085é'!.,½²ªß\x1c\x1f\x0b\x0c日😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["x" * 5000, "", None, "<|endoftext|>", "it's'll ''s 's"]
    ids, counts = own.encode(texts)
    library = Tokenizer.from_file(default_vocabulary())
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(e) for e in expected] == own.counts(texts).tolist()
    assert ids.tolist() == [i for e in expected for i in e]


def test_round_trip(spark, path):
    rows = [(5, "a b c", "", ""), (3, None, "", ""), (None, "nul", "", ""), (4, "", "", ""), (5, "a b c", "", ""), (1, "long " * 9000, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    wavelet.write(docs, path("w"), default_vocabulary(), block_ids=100)
    found = {}
    for row in wavelet.digests(wavelet.read(spark, path("w"))).collect():
        found.setdefault(row.doc_id, []).append((row.start, row.n_tokens, row.ids_crc32))
    own, start, expected = encoder(default_vocabulary()), 0, {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.append(own.encode([text])[0], 0).astype("<u4")
        expected.setdefault(doc_id, []).append((start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert {k: sorted(v) for k, v in found.items()} == expected


@pytest.fixture
def uncoalesced(spark):
    """Small partitions stay apart, so that small tables fill several shards."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield spark
    spark.conf.unset(setting)


def test_lookups_in_files(uncoalesced, path):
    spark = uncoalesced
    rng = random.Random(8)
    rows = [(k % 9 if k % 5 else None, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30))), "", "") for k in range(60)]
    wavelet.write(spark.createDataFrame(rows, SCHEMA).repartition(3), path("w"), default_vocabulary(), block_ids=100)
    blocks, library = wavelet.read(spark, path("w")), Tokenizer.from_file(default_vocabulary())
    assert blocks.count() > 2
    texts = {}
    for doc_id, text, *_ in rows:
        texts.setdefault(doc_id, []).append([*library.encode(text, add_special_tokens=False).ids, 0])
    tokens = {t for lists in texts.values() for ids in lists for t in ids}
    every = [t for lists in texts.values() for ids in lists for t in ids]
    assert dict(map(tuple, wavelet.counts(blocks, [*tokens, 50000]).collect())) == {t: every.count(t) for t in tokens}
    found = wavelet.occurrences(blocks, sorted(tokens)).collect()
    assert sorted(r.position for r in found) == list(range(len(every)))
    assert {r.position: r.token for r in found} == dict(map(tuple, wavelet.access(blocks, [*range(len(every)), -1, 10**9]).collect()))
    places = {}
    for r in sorted(found, key=lambda r: r.position):
        ids = places.setdefault(r.doc_id, [])
        if r.place == 0:
            ids.append([])
        assert r.place == len(ids[-1])
        ids[-1].append(r.token)
    assert {k: sorted(v) for k, v in places.items()} == {k: sorted(v) for k, v in texts.items()}


def test_one_id_on_all_rows_fills_several_shards(uncoalesced, path):
    spark = uncoalesced
    rows = [(None, "the same" if k % 2 else f"text {k}", "", "") for k in range(4000)]
    wavelet.write(spark.createDataFrame(rows, SCHEMA).repartition(8), path("w"), default_vocabulary(), block_ids=100)
    shards = [r["docs"] for r in wavelet.read(spark, path("w")).groupBy("shard").agg({"n_docs": "sum"}).withColumnRenamed("sum(n_docs)", "docs").collect()]
    assert sum(shards) == 4000 and max(shards) < 2000


def test_empty_table(spark, path):
    wavelet.write(spark.createDataFrame([], SCHEMA), path("w"), default_vocabulary())
    assert wavelet.digests(wavelet.read(spark, path("w"))).count() == 0
