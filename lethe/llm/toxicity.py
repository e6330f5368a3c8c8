"""A convolutional toxicity classifier in numpy, with thresholds calibrated by language.

Words (lower-cased runs of letters and digits) are hashed to embeddings, each the sum of
one for the word and one for its beginning. Filters of several widths slide over a whole
text, the greatest answer of each filter is kept, and a logistic unit makes the score.

``fit`` trains on a bounded sample (``SAMPLE`` rows of either label, those least in a hash
order, whole texts, at most ``SAMPLE_WORDS`` words in all), since such a model gains
nothing from more. ``calibrate`` then looks at every labelled row of a bucket of ids that the
training never draws from: one logistic curve for all languages turns answers into scores, and each
language gets the threshold with the best F1. Both use histograms, a row for each language and
answer bin. The score itself depends on the text alone.

Nulls: a null text is empty and scored like one; a null id has the bucket of the empty text, which is held out; label rows without id or label are left out;
a document with several label rows is toxic if one says so. Texts without words
have the least answer of the training. A null or rare language has
the threshold of all. Repeated documents are each scored. Without labels of both kinds every
score is 0. Further columns pass through ``score``; result columns replace their namesakes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lethe.llm.common import bounded, lowered, slices, span_hashes, spans, stored, text_bytes, without

WIDTHS = (1, 2, 3)
SIZE, FILTERS = 8, 16
WORD_BITS, STEM_BITS, STEM_BYTES = 16, 14, 4
#: Rows of either label, and words in all, that the training sees at most.
SAMPLE, SAMPLE_WORDS = 2500, 6_000_000
EPOCHS, BATCH = 8, 32
BINS, RARE = 400, 25
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


@dataclass
class Model:
    """Parameters; ``curve`` maps answers to scores, ``thresholds`` are scores by language."""

    words: np.ndarray
    stems: np.ndarray
    filters: list[np.ndarray]  # width x size x filters
    bias: np.ndarray
    out: np.ndarray
    out_bias: float = 0.0
    least: float = 0.0  # the answer to a text without words
    curve: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, answers: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * answers + self.curve[1], -30, 30)))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and stem numbers (0 is nothing) in slots, and where each text's slots begin.

    Each text has a slot for each word, one at least, and empty ones behind them, so that every
    filter finds a place.
    """
    low = lowered(data)
    starts, ends, doc = spans(_WORD[low], offsets)
    n = len(offsets) - 1
    count = np.bincount(doc, minlength=n)
    begin = np.concatenate([[0], np.cumsum(np.maximum(count, 1) + WIDTHS[-1] - 1)])
    slot = begin[doc] + np.arange(len(starts)) - (np.cumsum(count) - count)[doc]
    word, stem = np.zeros(begin[-1], np.int32), np.zeros(begin[-1], np.int32)
    for target, stop, bits in ((word, ends, WORD_BITS), (stem, np.minimum(ends, starts + STEM_BYTES), STEM_BITS)):
        target[slot] = 1 + (span_hashes(low, starts, stop) >> np.uint64(64 - bits)).astype(np.int32)
    return word, stem, begin


def _forward(model: Model, word: np.ndarray, stem: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Slot vectors, pooled answers (text x filter) and each width's answers by slot."""
    x = model.words[word] + model.stems[stem]
    padding = (begin[1:, None] - np.arange(1, WIDTHS[-1])).ravel()
    answers, pooled = [], []
    for width, weights in zip(WIDTHS, model.filters, strict=True):
        y = x @ weights[0]
        for k in range(1, width):
            y[:-k] += x[k:] @ weights[k]
        y[padding] = -np.inf
        answers.append(y)
        pooled.append(np.maximum.reduceat(y, begin[:-1], axis=0))
    return x, np.concatenate(pooled, axis=1) + model.bias, answers


def answer(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The raw answer for each text, before the curve."""
    word, stem, begin = features(data, offsets)
    _, pooled, _ = _forward(model, word, stem, begin)
    found = np.maximum(pooled, 0) @ model.out + model.out_bias
    return np.where(word[begin[:-1]] == 0, model.least, found)


def train(texts: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, seed: int = 7) -> Model:
    """Fit to (word, stem) slot arrays, by Adagrad on batches; both labels count alike."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.25).astype(np.float32)
    model = Model(
        draw((1 << WORD_BITS) + 1, SIZE), draw((1 << STEM_BITS) + 1, SIZE),
        [draw(w, SIZE, FILTERS) for w in WIDTHS], np.zeros(FILTERS * len(WIDTHS), np.float32),
        np.abs(draw(FILTERS * len(WIDTHS))) * np.tile([1, -1], FILTERS * len(WIDTHS) // 2).astype(np.float32),
    )
    model.words[0] = model.stems[0] = 0
    if not len(texts) or toxic.min() == toxic.max():
        return model
    tables = [model.words, model.stems, *model.filters, model.bias, model.out]
    memory = [np.full_like(t, 1e-3) for t in tables]
    weight = np.where(toxic, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean()))
    rate = 0.1

    def step(k: int, gradient: np.ndarray, rows=slice(None)) -> None:
        memory[k][rows] += gradient**2
        tables[k][rows] -= rate * gradient / np.sqrt(memory[k][rows])

    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            word, stem = (np.concatenate([texts[i][k] for i in chosen]) for k in (0, 1))
            begin = np.concatenate([[0], np.cumsum([len(texts[i][0]) for i in chosen])])
            x, pooled, answers = _forward(model, word, stem, begin)
            shown = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-np.clip(shown @ model.out + model.out_bias, -30, 30)))
            error = ((p - toxic[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
            back = error[:, None] * model.out * (pooled > 0)
            dx = np.zeros_like(x)
            grads = []
            for w, (width, weights) in enumerate(zip(WIDTHS, model.filters, strict=True)):
                own = back[:, w * FILTERS : (w + 1) * FILTERS]
                best = np.maximum.reduceat(answers[w], begin[:-1], axis=0)
                owner = np.repeat(np.arange(len(chosen)), np.diff(begin))
                slot, unit = np.nonzero(answers[w] == best[owner])
                _, first = np.unique(owner[slot] * FILTERS + unit, return_index=True)
                slot, unit = slot[first], unit[first]
                g = own[owner[slot], unit]
                slot, unit, g = slot[g != 0], unit[g != 0], g[g != 0]
                dw = np.zeros_like(weights)
                for k in range(width):
                    np.add.at(dw[k].T, unit, g[:, None] * x[slot + k])
                    np.add.at(dx, slot + k, g[:, None] * weights[k].T[unit])
                grads.append(dw)
            touched = np.flatnonzero((dx != 0).any(axis=1))
            for k, numbers in ((0, word), (1, stem)):
                rows, inverse = np.unique(numbers[touched], return_inverse=True)
                g = np.zeros((len(rows), SIZE), np.float32)
                np.add.at(g, inverse, dx[touched])
                step(k, g[rows > 0], rows[rows > 0])
            for w, dw in enumerate(grads):
                step(2 + w, dw)
            step(5, back.sum(axis=0))
            step(6, error @ shown)
            model.out_bias -= rate * float(error.sum())
    for word, stem in texts:
        _, pooled, _ = _forward(model, word, stem, np.array([0, len(word)]))
        model.least = min(model.least, float((np.maximum(pooled, 0) @ model.out)[0] + model.out_bias))
    return model


def _bucket():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5


def _labels(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("y"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a bounded sample of labelled rows whose crc32 bucket is 2, 3 or 4."""
    known = _labels(labels).where(_bucket() >= 2)
    kept = ["doc_id", "y"]
    # A top-N of ids in hash order for either label: at most 2 * SAMPLE ids.
    ids = known.where("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select(*kept).union(
        known.where("y = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select(*kept))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            word, stem, begin = features(*text_bytes(batch.column("text")))
            cut = lambda a: [a[i:j].tobytes() for i, j in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(np.diff(begin)), pa.array(cut(word)), pa.array(cut(stem))],
                ["doc_id", "y", "n", "word", "stem"])

    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text")
    rows = stored(bounded(chosen).mapInArrow(numbers, "doc_id long, y int, n long, word binary, stem binary"), "sample")
    # Whole texts up to the bound of words; the sizes are looked at before the texts are fetched.
    sizes = [(r.n, r.doc_id) for r in rows.select("n", "doc_id").orderBy("n", "doc_id").limit(2 * SAMPLE).collect()]
    within = int(np.searchsorted(np.cumsum([n for n, _ in sizes]), SAMPLE_WORDS, side="right"))
    largest = sizes[within - 1][0] if within else 0
    found = rows.where(F.col("n") <= largest).orderBy("n", "doc_id").limit(within).collect()
    texts = [tuple(np.frombuffer(r[k], np.int32) for k in ("word", "stem")) for r in found]
    return train(texts, np.array([r.y for r in found], bool))


def answers(docs: DataFrame, model: Model, *, keep_text: bool) -> DataFrame:
    """``docs`` and the column ``answer``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = without(docs, "answer")
    kept = [f for f in docs.schema.fields if keep_text or f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = answer(shared.value, *text_bytes(batch.column("text"))).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(found)], [f.name for f in kept] + ["answer"])

    return bounded(docs).mapInArrow(run, T.StructType([*kept, T.StructField("answer", T.DoubleType())]))


def calibrate(model: Model, answered: DataFrame, labels: DataFrame) -> Model:
    """Set curve and thresholds by all labelled rows of bucket 1; ``answered`` has doc_id, lang, answer."""
    rows = answered.join(_labels(labels).where(_bucket() == 1), "doc_id")
    low, high = rows.agg(F.min("answer"), F.max("answer")).first()
    if low is None or rows.agg(F.count_distinct("y")).first()[0] < 2:
        model.curve = (0.0, -30.0)
        return model
    width = (high - low) / BINS or 1.0
    binned = rows.groupBy("lang", F.least(F.floor((F.col("answer") - low) / width), F.lit(BINS - 1)).alias("bin"), "y").count()
    counts: dict[str | None, np.ndarray] = {}
    for r in binned.collect():
        counts.setdefault(r.lang, np.zeros((2, BINS)))[r.y, r.bin] += r["count"]
    total = sum(counts.values())
    middle = low + (np.arange(BINS) + 0.5) * width
    model.curve = _curve(middle, total)
    edges = model.score(low + np.arange(BINS) * width)
    best = edges[_best_cut(total)]
    model.threshold = float(best)
    model.thresholds = {
        lang: float(edges[_best_cut(c)]) for lang, c in counts.items() if lang is not None and c[1].sum() >= RARE}
    return model


def _best_cut(counts: np.ndarray) -> int:
    """The bin from which on calling all toxic has the best F1; of a run of such bins the middle one."""
    hit, false = (np.cumsum(c[::-1])[::-1] for c in (counts[1], counts[0]))
    f1 = 2 * hit / np.maximum(hit + false + counts[1].sum(), 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return int(best[(len(best) - 1) // 2])


def _curve(x: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """A logistic curve through the binned labels, by Newton steps with a little shrinkage."""
    n, positive = counts.sum(axis=0), counts[1]
    middle, spread = np.average(x, weights=n), max(np.sqrt(np.cov(x, aweights=n)), 1e-6)
    z, a, b = (x - middle) / spread, 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([((p * n - positive) * z).sum() + 0.01 * a, (p * n - positive).sum()])
        w = n * p * (1 - p)
        h = np.array([[(w * z * z).sum() + 0.01, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        move = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - move[0], b - move[1]
    return float(a / spread), float(b - a * middle / spread)


def verdicts(answered: DataFrame, model: Model) -> DataFrame:
    """Replace ``answer`` by score, predicted (score of 0.5 or more) and toxic (by the language's threshold)."""
    line = F.lit(model.curve[0]) * F.col("answer") + F.lit(model.curve[1])
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), line))))
    threshold = F.lit(model.threshold)
    if model.thresholds and "lang" in answered.columns:
        by_lang = F.create_map(*(F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair))
        threshold = F.coalesce(F.try_element_at(by_lang, "lang"), threshold)
    return without(answered, "score", "predicted", "toxic").withColumn("score", score).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")).withColumn("toxic", F.col("score") >= threshold).drop("answer")


def classify(docs: DataFrame, labels: DataFrame, *, keep_text: bool = False) -> DataFrame:
    """Fit, calibrate and score: doc_id, lang (all columns with ``keep_text``), score, predicted, toxic."""
    model = fit(docs, labels)
    short = stored(answers(docs.select("doc_id", "lang", "text"), model, keep_text=False), "answers")
    model = calibrate(model, short, labels)
    return verdicts(answers(docs, model, keep_text=True) if keep_text else short, model)


def digests(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", (_bucket() == 0).alias("held_out"), "score", "predicted", "toxic")
