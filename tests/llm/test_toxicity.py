from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lethe.llm import toxicity
from lethe.llm.common import text_bytes

SCHEMA = "doc_id long, text string, lang string, SCORE string, answer string"


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    plain = ["the", "of", "wander", "Éclair", "stone", "river", "blue", "ton", "anth", "ver"]
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(plain) for _ in range(rng.choice([1, 5, 40, 200]))]
        toxic = rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Scum", "grolp" + rng.choice(plain), "idiot"])
        rows.append((k, " ".join(words), rng.choice(["en", "de", None]), "", ""))
        labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = corpus()
    rows += [(5000, None, "en", "", ""), (5001, "", "xx", "", ""), (None, "scum", "en", "", ""), (7, rows[7][1], "en", "", ""), (5002, "stone " * 60000, "en", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([*labels, labels[3], (None, 1), (4, None)], "doc_id long, toxic int")
    return rows, dict(map(tuple, labels.dropna().collect())), toxicity.classify(docs, labels, keep_text=True).collect()


def test_held_out_accuracy(scored):
    rows, labels, found = scored
    held = [r for r in found if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)
    assert sum(r.toxic == bool(labels[r.doc_id]) for r in held) >= 0.95 * len(held)
    assert sum(labels[r.doc_id] for r in held) > 10


def test_every_row_has_a_score(scored):
    rows, _, found = scored
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.toxic is not None for r in found)
    assert found[0].__fields__ == ["doc_id", "text", "lang", "score", "predicted", "toxic"]
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert by_id[5000] == by_id[5001] and len(by_id[7]) == 1


def test_batches_do_not_change_answers():
    rows, labels = corpus(60)
    texts = [r[1] for r in rows] + ["", None]
    slots = []
    for t in texts[:60]:
        word, stem, _ = toxicity.features(*text_bytes(pa.array([t])))
        slots.append((word, stem))
    model = toxicity.train(slots, np.array([bool(y) for _, y in labels]))
    together = toxicity.answer(model, *text_bytes(pa.array(texts)))
    alone = [toxicity.answer(model, *text_bytes(pa.array([t], pa.string())))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_pooling_by_hand():
    model = toxicity.train([], np.zeros(0, bool))
    word, stem, begin = toxicity.features(*text_bytes(pa.array(["One two three four"])))
    x = model.words[word] + model.stems[stem]
    pooled = [max(sum(x[i + k] @ f[k] for k in range(w))[u] for i in range(4)) for w, f in zip(toxicity.WIDTHS, model.filters) for u in range(toxicity.FILTERS)]
    expected = np.maximum(np.array(pooled) + model.bias, 0) @ model.out
    assert np.allclose(toxicity.answer(model, *text_bytes(pa.array(["One two three four"]))), expected, atol=1e-5)


def test_without_labels_or_documents(spark):
    rows, _ = corpus(10)
    docs, none = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.classify(docs, none).collect()} == {0}
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_a_null_id_is_held_out(spark):
    rows, _ = corpus(5)
    docs = spark.createDataFrame([(None, *r[1:]) for r in rows[:2]] + rows[2:], SCHEMA)
    labels = spark.createDataFrame([(None, 1), (2, 0)], "doc_id long, toxic int")
    found = toxicity.digests(toxicity.classify(docs, labels)).collect()
    assert [r.held_out for r in found if r.doc_id is None] == [True, True] and all(r.held_out is not None for r in found)
