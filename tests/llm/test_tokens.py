"""Texts that hold an added token literally, against a tokenizer of its own."""

from __future__ import annotations

import random

import numpy as np
from tokenizers import Tokenizer

from lethe.llm import edittokens, tokens
from lethe.llm.common import span_hashes
from lethe.llm.tokens import Encoder, default_vocabulary, encoder

TOKEN = "<|endoftext|>"


def plain():
    library = Tokenizer.from_file(default_vocabulary())
    return lambda text: library.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_those_of_the_library():
    ids = plain()
    texts = [f"a {TOKEN} b", TOKEN, f"{TOKEN}{TOKEN}x", f"é  {TOKEN}\n 日", "<|endoftext|", None, "a b"]
    found, counts = encoder(default_vocabulary()).encode(texts)
    assert ids(texts[0]) == [64, 220, 50256, 275]
    assert found.tolist() == [i for t in texts for i in ids(t or "")]
    assert counts.tolist() == [len(ids(t or "")) for t in texts] == encoder(default_vocabulary()).counts(texts).tolist()


def test_edits_make_and_break_added_tokens():
    ids, own, rng = plain(), encoder(default_vocabulary()), random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice(["ab", " ", "  ", TOKEN, "<|endof", "text|>", "\n", "7"]) for _ in range(40))
        tree = edittokens.Tree(*edittokens.leaves_of(own, [text], 8)[0])
        assert tree.tokens == len(ids(text))
        for _ in range(4):
            a = rng.randrange(len(text) + 1)
            edit = (a, min(len(text), a + rng.randrange(4)), rng.choice(["", "|", "<|endof", "text|>", TOKEN, " "]))
            [(text, _)] = edittokens.edited(own, [(text, tree, [edit])], 8)
            assert tree.tokens == len(ids(text)) and np.sum(tree.leaves[0]) == len(text)


def thue_morse(letters, n):
    word, other = letters
    for _ in range(n.bit_length() - 1):
        word, other = word + other, other + word
    return word, other


def test_pieces_with_one_hash_are_told_apart():
    """Words whose polynomial hashes modulo 2 ** 64 are equal, together, alone, and after one another."""
    ids, own = plain(), Encoder(default_vocabulary())
    for n in (1024, 2048, 4096):
        a, b = thue_morse(("a", "b"), n)
        codes = np.frombuffer((a + b).encode("utf-32-le"), np.uint32)
        assert len(set(span_hashes(codes, np.array([0, n]), np.array([n, 2 * n])).tolist())) == 1
        for texts in ([a, b], [b], [a, f"x {b} {a}", b, f"{b} {b}"], [a]):
            found, counts = own.encode(texts)
            assert found.tolist() == [i for t in texts for i in ids(t)]
            assert counts.tolist() == [len(ids(t)) for t in texts] == own.counts(texts).tolist()


def test_remembered_pieces_with_a_forged_hash(monkeypatch):
    """Every short piece shares one of four hashes: remembered entries are compared as well."""
    monkeypatch.setattr(tokens, "span_hashes", lambda codes, starts, ends: ((ends - starts) % 4).astype(np.uint64))
    ids, own, rng = plain(), Encoder(default_vocabulary()), random.Random(2)
    for _ in range(20):
        texts = ["".join(rng.choice("ab c7.é\n") for _ in range(rng.randrange(60))) for _ in range(9)]
        assert own.encode(texts)[0].tolist() == [i for t in texts for i in ids(t)]
