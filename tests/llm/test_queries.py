"""The registered queries without SQL on a small fixture, against brute force."""

from __future__ import annotations

import importlib.util
import random
import zlib
from pathlib import Path

import pytest

from lethe.llm.queries import ORACLES, QUERIES
from lethe.llm.tokens import default_vocabulary, encoder


def brute(name):
    spec = importlib.util.spec_from_file_location(name, Path(__file__).parent / f"test_{name}.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(31)
    folder = str(tmp_path_factory.mktemp("queries"))
    word = lambda: rng.choice(["stone", "Éa", "river", "the", "of", "x#"]) + str(rng.randrange(30))
    rows = []
    for k in range(120):
        text = " ".join(word() for _ in range(rng.choice([1, 5, 40, 90])))
        if rows and rng.random() < 0.4:
            text = rng.choice(rows)[1] + rng.choice(["", " tail 12345", "\n" + text])
        rows.append((k, text, rng.choice(["en", "de"]), f"src{k % 3}", len(text)))
    rows += [(130, None, "en", "src0", None), (131, "", None, None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(k, k % 2, int(k % 7 == 0)) for k in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, [(r[0], r[1]) for r in rows]


def run(spark, tables, name):
    found = [tuple(r) for r in QUERIES[name](spark, tables[0]).collect()]
    assert name not in ORACLES
    return found


def test_op1(spark, tables):
    own, start, expected = encoder(default_vocabulary()).library, 0, []
    for doc_id, text in tables[1]:
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        expected.append((doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(run(spark, tables, "op1_wavelet")) == expected


def test_op5(spark, tables):
    found = sorted(run(spark, tables, "op5_toxicity"))
    assert [(r[0], r[1]) for r in found] == [(d, zlib.crc32(str(d).encode()) % 5 == 0) for d, _ in tables[1]]
    assert all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.5) for r in found)


def test_op6(spark, tables):
    own = brute("qualityrules")
    for r in run(spark, tables, "op6_qualityrules"):
        n, chars, symbols, _, dup, repeat = own.brute(dict(tables[1])[r[0]])
        failed = n < 50 or 100 * repeat > 50 * n
        assert r[1:7] == (n, chars, symbols, dup, repeat, failed) and not (failed and r[7])


def test_op7(spark, tables):
    import re

    own, texts = encoder(default_vocabulary()), dict(tables[1])
    for doc_id, before, edits, _, after, _ in run(spark, tables, "op7_edittokens"):
        text = texts[doc_id] or ""
        assert before == own.counts([text])[0] and edits == len(re.findall("[0-9]{4,}", text))
        assert after == own.counts([re.sub("[0-9]{4,}", "<num>", text)])[0]


def test_op8(spark, tables):
    found = {r[0]: r[1:] for r in run(spark, tables, "op8_suffixdedup")}
    assert found == brute("suffixdedup").brute(tables[1], 100) and any(r[1] for r in found.values())


def test_op9(spark, tables):
    own, total, bins = encoder(default_vocabulary()), {}, {}
    for doc_id, source, cluster, _, n, bin_id, _ in run(spark, tables, "op9_packing"):
        total[doc_id] = total.get(doc_id, 0) + n
        bins.setdefault(bin_id, []).append((source, cluster, n))
    assert total == {d: int(own.counts([t])[0]) + 1 for d, t in tables[1]}
    for rows in bins.values():
        sources = [s for s, _, _ in rows if s is not None]
        assert sum(n for *_, n in rows) <= 2048 and len(set(sources)) == len(sources)
        assert len({c for _, c, _ in rows}) == len(rows)


def test_op10(spark, tables):
    own = brute("simhash")
    marks = [own.fingerprint(t) for _, t in tables[1]]
    near = [(i, j) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4]
    roots = own.roots(len(marks), near)
    expected = [(d, f"{m:016x}", tables[1][r][0]) for (d, _), m, r in zip(tables[1], marks, roots, strict=True)]
    assert sorted(run(spark, tables, "op10_simhash")) == expected
