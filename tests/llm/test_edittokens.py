from __future__ import annotations

import random

import numpy as np
import pytest

from lethe.llm import edittokens as e
from lethe.llm.tokens import default_vocabulary, encoder

SCHEMA = "doc_id long, text string, n_edits string, LEAVES string"
ALPHABET = ["a", "word", " ", "  ", "\n", "'s", "'", "12", "é", ".", "\t ", "don't", "日", "x"]


def count(text):
    return len(encoder(default_vocabulary()).library.encode(text, add_special_tokens=False).ids)


def random_edits(rng, n):
    points = sorted(rng.randint(0, n) for _ in range(2 * rng.randint(0, 4)))
    return [(a, b, "".join(rng.choice(ALPHABET) for _ in range(rng.choice([0, 1, 30])))) for a, b in zip(points[::2], points[1::2])]


@pytest.mark.parametrize("leaf_chars", [1, 8, 64])
def test_edits_equal_counting_anew(leaf_chars):
    own, rng = encoder(default_vocabulary()), random.Random(leaf_chars)
    for _ in range(60):
        rows = []
        for _ in range(5):
            alphabet = ALPHABET if rng.random() < 0.3 else ALPHABET[:-2]
            text = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 20, 300])))
            rows.append((text, e.Tree(*e.leaves_of(own, [text], leaf_chars)[0]), random_edits(rng, len(text))))
        for _ in range(3):  # edits on edited trees
            expected = []
            for text, _, edits in rows:
                for a, b, new in reversed(edits):
                    text = text[:a] + new + text[b:]
                expected.append(text)
            done = e.edited(own, rows, leaf_chars)
            assert [t for t, _ in done] == expected
            for (_, tree, _), text in zip(rows, expected, strict=True):
                assert (tree.chars, tree.tokens) == (len(text), count(text))
                assert tree.sums[:, 1].tolist() == [int(x.sum()) for x in tree.leaves]
            rows = [(t, tree, random_edits(rng, len(t))) for (_, tree, _), t in zip(rows, expected, strict=True)]


def test_a_small_edit_encodes_little():
    own, text = encoder(default_vocabulary()), "some plain words here. " * 5000
    tree = e.Tree(*e.leaves_of(own, [text])[0])
    (new, again), = e.edited(own, [(text, tree, [(60000, 60004, "changed")])])
    assert tree.tokens == count(new) and again < 5 * e.LEAF_CHARS


def test_tree_finds_leaves():
    tree = e.Tree(np.array([3, 1, 5]), np.array([1, 1, 2]))
    assert [tree.find(k) for k in range(9)] == [(0, 0)] * 3 + [(1, 3)] + [(2, 4)] * 5


def test_bad_edits_are_errors():
    own = encoder(default_vocabulary())
    for edits in ([(0, 3, ""), (2, 4, "")], [(0, 99, "")], [(3, 2, "")]):
        with pytest.raises(ValueError):
            e.edited(own, [("some text", e.Tree(*e.leaves_of(own, ["some text"])[0]), edits)])


def test_over_a_table(spark):
    rows = [(1, "call 12345 or 6789012 now", "", ""), (2, None, "", ""), (3, "", "", ""), (None, "1234", "", ""), (1, "call 12345 or 6789012 now", "", ""), (4, "é日 77777 " * 4000, "", "")]
    trees = e.replacing(e.build(spark.createDataFrame(rows, SCHEMA), default_vocabulary()), "[0-9]{4,}", "<num>")
    before = {r.doc_id: r.n_tokens for r in trees.collect()}
    found = e.apply(trees, default_vocabulary()).collect()
    assert len(found) == len(rows)
    for r in found:
        old = next(x[1] for x in rows if x[0] == r.doc_id)
        new = None if old is None else __import__("re").sub("[0-9]{4,}", "<num>", old)
        assert r.text == new and r.n_tokens == count(new or "") and before[r.doc_id] == count(old or "")
        assert sum(x.tokens for x in r.leaves) == r.n_tokens and sum(x.chars for x in r.leaves) == len(new or "")


def test_empty_table(spark):
    trees = e.replacing(e.build(spark.createDataFrame([], SCHEMA), default_vocabulary()), "[0-9]", "")
    assert e.apply(trees, default_vocabulary()).count() == 0
