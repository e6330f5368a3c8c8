"""Quality rules whose thresholds bound the risk of rejecting good documents.

Each rule rejects at one end of a measure. For a stratum (language) and rule, its cutoffs
are tested from the mildest on: among labelled good documents, the exact binomial
tail must show that at most ``RISK / rules`` of them would be rejected. The sequence stops
at the first cutoff that fails, so only strata and rules need the (Bonferroni) correction:
with probability ``1 - ERROR``, in no stratum are more than ``RISK`` of the good
documents rejected. A rule without proof in a stratum stays off there.

Counts are sums over all labelled rows; the driver sees one row for each language.

Nulls: a null text has no words, and no measure of it is over a cutoff; null labels are left out;
a null language is a stratum like others; a language without labels has no rules. A document
with several label rows is good if one says so. Repeated rows are each judged. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.llm.common import bounded, mixed, slices, span_hashes, spans, stored, text_bytes, window_hashes

RISK, ERROR = 0.02, 0.05
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3
_AT_ONCE = 1 << 14
_SPACE = np.zeros(256, bool)
_SPACE[9:14] = _SPACE[32] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Reject where the measure is over (``upper``) or under a cutoff; cutoffs from mild to strict."""

    name: str
    measure: str  # SQL over MEASURES
    cutoffs: tuple[float, ...]
    upper: bool = True

    def rejects(self, cutoff: float | Column) -> Column:
        value = F.expr(self.measure)
        hit = value > cutoff if self.upper else value < cutoff
        return F.coalesce(hit, F.lit(False))


_FALLING = tuple(round(0.9 - 0.05 * k, 2) for k in range(18))
RULES = (
    Rule("few_words", "n_words", tuple(range(51, 121, 3)), upper=False),
    Rule("short_words", "word_chars / nullif(n_words, 0)", tuple(round(1.5 + 0.25 * k, 2) for k in range(14)), upper=False),
    Rule("long_words", "word_chars / nullif(n_words, 0)", tuple(round(20 - 0.5 * k, 1) for k in range(28))),
    Rule("symbols", "n_symbols / nullif(word_chars, 0)", tuple(round(0.5 * 0.75**k, 5) for k in range(20))),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", _FALLING),
    Rule("repeated_words", "n_repeat_words / nullif(n_words, 0)", _FALLING),
)


def measures_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The MEASURES of several texts laid end to end."""
    n = len(offsets) - 1
    per = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    inside = ~_SPACE[data]
    starts, ends, doc = spans(inside, offsets)
    n_words = np.bincount(doc, minlength=n)
    # Bytes 10xxxxxx continue a code point.
    word_chars = per(inside & ((data & 0xC0) != 0x80))
    # Lines with a word; the same line twice in a text has one key.
    line_start, line_end, line_doc = spans(data != 10, offsets)
    seen = np.concatenate([[0], np.cumsum(inside)])
    filled = seen[line_end] > seen[line_start]
    line_start, line_end, line_doc = line_start[filled], line_end[filled], line_doc[filled]
    n_lines = np.bincount(line_doc, minlength=n)
    _, first, inverse = np.unique(
        _of(span_hashes(data, line_start, line_end), line_doc), return_index=True, return_inverse=True)
    n_dup = n_lines - np.bincount(line_doc[first], minlength=n)
    doubtful = line_doc[_differs(data, line_start, line_end, line_doc, first[inverse])]
    # Windows of words, and the words that those found again cover.
    words = span_hashes(data, starts, ends)
    _, same, which = np.unique(words, return_index=True, return_inverse=True)
    doubtful = np.concatenate([doubtful, doc[_differs(data, starts, ends, None, same[which])]])
    keys = window_hashes(words, WINDOW)
    at = np.flatnonzero(doc[: len(keys)] == doc[WINDOW - 1 :][: len(keys)])
    _, first, inverse, count = np.unique(_of(keys[at], doc[at]), return_index=True, return_inverse=True, return_counts=True)
    again = at[count[inverse] > 1]
    model = at[first[inverse]]
    other = (doc[model] != doc[at]) | (np.stack([which[model + k] != which[at + k] for k in range(WINDOW)]).any(axis=0) if len(at) else False)
    doubtful = np.unique(np.concatenate([doubtful, doc[at[other]], doc[model[other]]]))
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + WINDOW, -1)
    covered = np.cumsum(change[:-1]) > 0
    n_repeat = np.bincount(doc[covered], minlength=n)
    for k in doubtful.tolist():
        n_dup[k], n_repeat[k] = _repeats(data[offsets[k] : offsets[k + 1]].tobytes())
    return [n_words, word_chars, per(_SYMBOL[data]), n_lines, n_dup, n_repeat]


def _differs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray | None, model: np.ndarray) -> np.ndarray:
    """Spans that are not, byte by byte, the span their hash was found with first (or not of the same text)."""
    length = ends - starts
    other = length != length[model]
    if doc is not None:
        other |= doc != doc[model]
    check = np.flatnonzero(~other & (model != np.arange(len(model))))
    for a in range(0, len(check), _AT_ONCE):
        some = check[a : a + _AT_ONCE]
        total = np.cumsum(length[some])
        inside = np.arange(total[-1]) - np.repeat(total - length[some], length[some])
        wrong = data[np.repeat(starts[some], length[some]) + inside] != data[np.repeat(starts[model[some]], length[some]) + inside]
        other[some[np.searchsorted(total, np.flatnonzero(wrong), side="right")]] = True
    # The model of a stranger may have been counted with it.
    found = np.flatnonzero(other)
    return np.concatenate([found, model[found]])


def _repeats(text: bytes) -> tuple[int, int]:
    """n_dup_lines and n_repeat_words of one text, without hashes of our own."""
    lines = [line for line in text.split(b"\n") if line.split()]
    words = text.split()
    windows = [tuple(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(WINDOW)}
    return len(lines) - len(set(lines)), len(covered)


def _of(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mixed(hashes ^ mixed(doc.astype(np.uint64) + np.uint64(1)))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the measures of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = measures_of(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), *(pa.array(x.astype(np.int64)) for x in found)],
                ["doc_id", "lang", *MEASURES])

    schema = "doc_id long, lang string, " + ", ".join(f"{name} long" for name in MEASURES)
    return bounded(docs).select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text").mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def tail(rejected: int, n: int, risk: float) -> float:
    """P(Bin(n, risk) <= rejected): small if the true share is surely not over ``risk``."""
    if rejected >= n:
        return 1.0
    i = np.arange(rejected)
    logs = np.concatenate([[0.0], np.cumsum(np.log((n - i) / (i + 1)) + np.log(risk / (1 - risk)))]) + n * np.log1p(-risk)
    top = logs.max()
    return float(min(1.0, np.exp(top) * np.exp(logs - top).sum()))


def thresholds(measured: DataFrame, labels: DataFrame, *, rules=RULES, risk: float = RISK, error: float = ERROR) -> dict[str | None, dict[str, float]]:
    """For each language, the strictest proven cutoff of each rule."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    rows = measured.where(~base_failed()).join(good, "doc_id")
    sums = [F.sum(r.rejects(c).cast("long")).alias(f"{r.name}|{k}") for r in rules for k, c in enumerate(r.cutoffs)]
    counted = rows.groupBy("lang").agg(F.count("*").alias("n"), *sums).collect()
    level = error / max(1, len(counted) * len(rules))
    chosen: dict[str | None, dict[str, float]] = {}
    for row in counted:
        own = chosen.setdefault(row.lang, {})
        for r in rules:
            for k, cutoff in enumerate(r.cutoffs):
                if tail(row[f"{r.name}|{k}"], row.n, risk / len(rules)) > level:
                    break
                own[r.name] = cutoff
    return chosen


def judge(measured: DataFrame, chosen: dict[str | None, dict[str, float]], *, rules=RULES) -> DataFrame:
    """base_failed, the names of the rules that reject, and kept."""
    failed = []
    for r in rules:
        hit = F.lit(False)
        for lang, own in sorted(chosen.items(), key=str):
            if r.name in own:
                hit = F.when(F.col("lang").eqNullSafe(F.lit(lang)), r.rejects(F.lit(own[r.name]))).otherwise(hit)
        failed.append(F.when(hit, F.lit(r.name)))
    judged = measured.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.array_compact(F.array(*failed)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def run(docs: DataFrame, labels: DataFrame) -> DataFrame:
    measured = stored(measure(docs), "measures")
    return judge(measured, thresholds(measured, labels))


def digests(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.concat_ws(",", "rejected_by").alias("rejected_by"))
