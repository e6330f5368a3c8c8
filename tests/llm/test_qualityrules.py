from __future__ import annotations

import math
import random
import re
from collections import Counter

import pyarrow as pa

from lethe.llm import qualityrules as q
from lethe.llm.common import text_bytes

SCHEMA = "doc_id long, text string, lang string, N_WORDS string, kept string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)]


def texts(seed=1):
    rng = random.Random(seed)
    parts = ["a", "bé", "日", "#", "%x", " ", "  ", "\n", "\t", "\v", "long" * 5, "<b>", "\x1c", " "]
    found = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 30, 300]))) for _ in range(150)]
    return [*found, None, "", "\n\n", " a", "a b c a b c", "x " * 30000]


def test_measures_equal_brute_force():
    rows = texts()
    for at in range(0, len(rows), 13):
        part = rows[at : at + 13]
        found = q.measures_of(*text_bytes(pa.array(part, pa.string())))
        assert [[int(m[k]) for m in found] for k in range(len(part))] == [brute(t) for t in part]


def thue_morse(letters, n):
    word, other = letters
    for _ in range(n.bit_length() - 1):
        word, other = word + other, other + word
    return word, other


def test_lines_and_words_with_one_hash_are_told_apart():
    a, b = thue_morse("ab", 1024)
    rows = [f"{a}\n{b}", f"{a} x y {b} x y", f"{b} {a} {b} {a} {b}", f"{a}\n{b}\n{a}", a, b, f"{a} {a} {a} {b}", "plain text\nplain text"]
    found = q.measures_of(*text_bytes(pa.array(rows, pa.string())))
    assert [[int(m[k]) for m in found] for k in range(len(rows))] == [brute(t) for t in rows]


def test_forged_hashes(monkeypatch):
    """With eight hashes for all lines and words every count still is right."""
    monkeypatch.setattr(q, "span_hashes", lambda data, starts, ends: ((ends - starts) % 8).astype("uint64"))
    for seed in (3, 4):
        rows = texts(seed)[:60]
        found = q.measures_of(*text_bytes(pa.array(rows, pa.string())))
        assert [[int(m[k]) for m in found] for k in range(len(rows))] == [brute(t) for t in rows]


def test_tail_is_exact():
    for n, k, p in ((1, 0, 0.3), (20, 3, 0.1), (500, 2, 0.02), (50, 50, 0.4), (300, 20, 0.05)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(q.tail(k, n, p) - exact) < 1e-9


def _log_choose(n, k):
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def test_risk_is_held_and_verdicts_follow(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(8000):
        good = rng.random() < 0.7
        word = "stone" if good else "stone" * rng.choice([1, 5])
        rows.append((k, " ".join(f"{word}{rng.randrange(10**6)}" for _ in range(60)), rng.choice(["en", "de"]), "", ""))
        labels.append((k, int(good)))
    rows += [(19000, None, "en", "", ""), (19001, "", None, "", ""), (19002, "word " * 200, "en", "", ""), (7, rows[7][1], "en", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([*labels, labels[0], (None, 1), (5, None)], "doc_id long, quality int")
    measured = q.measure(docs)
    chosen = q.thresholds(measured, marks)
    found = q.judge(measured, chosen).collect()
    good = dict(labels)
    for lang in ("en", "de"):
        own = [r for r in found if r.lang == lang and good.get(r.doc_id)]
        assert sum(not r.kept for r in own) <= q.RISK * len(own)
        assert chosen[lang]["long_words"] < 25
    bad = [r for r in found if good.get(r.doc_id) == 0]
    assert sum(not r.kept for r in bad) > 0.4 * len(bad)
    # The strictest proven cutoff, by a plain search.
    n = sum(1 for r in found if r.lang == "de" and good.get(r.doc_id) and not r.base_failed)
    best, p = None, q.RISK / 6
    for cutoff in q.RULES[2].cutoffs:
        k = sum(1 for r in found if r.lang == "de" and good.get(r.doc_id) and r.word_chars / r.n_words > cutoff)
        if sum(math.exp(_log_choose(n, i) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1)) > q.ERROR / 12:
            break
        best = cutoff
    assert chosen["de"]["long_words"] == best
    by_id = {r.doc_id: r for r in found}
    assert by_id[19000].base_failed and by_id[19001].base_failed and by_id[19002].base_failed and len(found) == len(rows)


def test_without_proof_a_rule_is_off(spark):
    docs = spark.createDataFrame([(k, "w " + " ".join(map(str, range(80))), "en") for k in range(5)], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(k, 1) for k in range(5)], "doc_id long, quality int")
    assert q.thresholds(q.measure(docs), marks) == {"en": {}}
    assert all(r.kept for r in q.run(docs, marks).collect())


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int")
    assert q.run(docs, none).count() == 0
    some = spark.createDataFrame([(1, "a " * 5, "en", "", "")], SCHEMA)
    assert [r.kept for r in q.run(some, none).collect()] == [False]
