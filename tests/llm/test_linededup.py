from __future__ import annotations

import random
import re

import pytest

from lethe.llm import linededup

SCHEMA = "doc_id long, text string, N_LINES string, pos string"


def brute(rows, least, words=None):
    """Texts after deletion, lines deleted and maximal runs; rows of distinct ids. Lines of more than ``words`` words count alone."""
    seen, alone, out = set(), set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = [] if text is None else text.split("\n")
        filled = [k for k, x in enumerate(lines) if x.strip(" \t\n\v\f\r")]
        gone = set()
        for i in range(len(filled) - least + 1):
            run = tuple(lines[k] for k in filled[i : i + least])
            if run in seen:
                gone |= set(range(i, i + least))
            seen.add(run)
        for i, k in enumerate(filled):
            if words is not None and len(re.findall(r"[^\x20\x09-\x0D]+", lines[k])) > words:
                if (lines[k],) in alone:
                    gone.add(i)
                alone.add((lines[k],))
        runs = sum(i - 1 not in gone for i in gone)
        cut = {filled[i] for i in gone}
        kept = None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in cut)
        out[doc_id] = (kept, len(lines), len(gone), runs)
    return out


def corpus(seed):
    rng = random.Random(seed)
    line = lambda: rng.choice(["a", "b", "a b", "", " ", "é", "long " * 50])
    rows = [(k, "\n".join(line() for _ in range(rng.choice([0, 1, 2, 9, 40])))) for k in range(40)]
    rows += [(90, rows[3][1]), (91, rows[3][1]), (50, None), (51, ""), (None, "a\nb\na\nb"), (52, "\n".join(str(k % 700) for k in range(2000)))]
    return rows


@pytest.mark.parametrize("least, words", [(1, None), (2, None), (2, 1), (2, 49), (3, 49), (4, None), (5, 1), (7, None)])
def test_equals_brute_force(spark, least, words):
    rows = corpus(least)
    found = linededup.dedup(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA), min_lines=least, min_words=words).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_deleted, r.n_runs) for r in found} == brute(rows, least, words)
    assert len(found) == len(rows)


def test_final_order_is_a_suffix_array(spark):
    rows = [(k, t) for k, t in corpus(8)[:25] if t]
    ranks, _ = linededup.suffix_ranks(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {}
    for r in ranks.collect():
        found[r.doc_id, r.pos] = r["rank"]
    # Line ids order lines by hash: take the order of single lines from the ranks, the rest must follow.
    first, _ = linededup.suffix_ranks(spark.createDataFrame(rows, "doc_id long, text string"), until=1)
    one = {(r.doc_id, r.pos): r["rank"] for r in first.collect()}
    suffix = {(d, p): tuple(one[x] for x in sorted(one) if x[0] == d and x[1] >= p) for d, p in one}
    for key, own in suffix.items():
        assert found[key] == sum(other < own for other in suffix.values())


def test_repeated_rows_count_as_one(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb"), (2, "x")]
    found = linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text, r.n_deleted) for r in found) == [(1, "a\nb\nc", 0), (1, "a\nb\nc", 0), (2, "", 2), (2, "x", 0)]


def test_empty_table(spark):
    assert linededup.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_line_alone_is_a_run(spark):
    long, short = " ".join(f"w{k}" for k in range(51)), " ".join(f"v{k}" for k in range(50))
    rows = [(1, long), (2, f"x\n{long}\ny"), (3, long), (4, short), (5, short), (6, f"{long}\n{long}\nx\nz"), (7, f"x\nz\n{long}"), (None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.text, r.n_deleted, r.n_runs) for r in linededup.dedup(docs, min_words=50).collect()}
    assert found == {
        1: (long, 0, 0), 2: ("x\ny", 1, 1), 3: ("", 1, 1), 4: (short, 0, 0), 5: (short, 0, 0),
        6: ("x\nz", 2, 1), 7: ("", 3, 1), None: ("q", 0, 0)}


def test_pipeline_deletes_a_long_line_in_other_company(spark):
    import corpus_pipeline

    long = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, long, 0), (2, f"x\n{long}\ny", 0), (3, long, 0)], "doc_id long, text string, n_chars long")
    found = sorted(map(tuple, corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()))
    assert found == [(1, long, len(long)), (2, "x\ny", 3)]
