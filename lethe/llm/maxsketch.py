"""Ranked lexical search: hashed max-sketches bound every score, exact scores follow in falling order of the bounds.

``build`` writes a row for each document: its length, its distinct terms with their counts, and a sketch. A sketch is a
row of bytes, a power of two and at least ``SPREAD`` times as many as the document has terms; every term is hashed to a cell, and a cell keeps
the greatest count among its terms. A term's impact grows with its count, so what a cell gives
is never less than the impact of any term hashed there, and a batch of queries looks up all its terms in a sketch at
once: the sums are upper bounds of all scores of the document.

``search`` reads the index twice. The first pass counts documents, lengths and the documents of each query term; the
second one bounds all documents against all items. Where a bound passes the least of an item's ``k`` best
so far, documents are scored exactly from their stored terms, the highest bound first, until bounds fall under that threshold.
Each task sends its ``k`` best of each item, which are exact, and the best of those are the result: no pairs, no
shuffle of documents, and copies or frequent terms make no task larger than another.
Items are searched in blocks of bounded size, so a large set of them is never held whole.

Nulls: a null or empty text has no terms and is no document of the statistics; a null ``doc_id`` is kept and comes after
the others where scores are equal. Every row of the items is an item of its own, also with a null or repeated
``item_id``; items without terms, or with none that scores, give no rows. Repeated documents are ranked each. Empty
tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lethe.llm.common import bounded, slices, stored

K = 10
#: Cells of a sketch for each distinct term, before rounding up to a power of two.
SPREAD = 4
#: Bytes of the texts of a block of items.
BLOCK_BYTES = 4 << 20
#: Documents whose bounds are taken together.
LOT = 256
#: Letters A-Z lowered, digits, letters and everything beyond ASCII kept, all else blank.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_INDEX = "doc_id long, n long, terms binary, counts binary, sketch binary"
_FULL = 255


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split()


def impact(tf: int, m: int) -> int:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def sketch_of(terms: list[bytes], counts: np.ndarray) -> np.ndarray:
    """The greatest count, 255 at most, of the terms hashed to each cell."""
    width = 1 << max(SPREAD * len(terms) - 1, 7).bit_length()
    cells = np.fromiter((zlib.crc32(t) for t in terms), np.int64, len(terms)) & (width - 1)
    sketch = np.zeros(width, np.uint8)
    np.maximum.at(sketch, cells, np.minimum(counts, _FULL).astype(np.uint8))
    return sketch


def build(docs: DataFrame, path: str) -> None:
    """Write the index of ``docs`` (doc_id, text) as Parquet at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                words = terms_of(text or b"")
                found = Counter(words)
                counts = np.fromiter(found.values(), np.uint32, len(found))
                rows.append((len(words), b" ".join(found), counts.tobytes(), sketch_of(list(found), counts).tobytes()))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "terms", "counts", "sketch"])

    bounded(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _INDEX).write.parquet(path)


class Block:
    """Some items, their terms laid out one item after another for look-ups in batches."""

    def __init__(self, items: list[tuple[int, bytes]]) -> None:
        lists = [(key, list(dict.fromkeys(terms_of(text)))) for key, text in items]
        self.keys = [key for key, terms in lists if terms]
        lists = [terms for _, terms in lists if terms]
        self.terms = list(dict.fromkeys(t for terms in lists for t in terms))
        place = {t: i for i, t in enumerate(self.terms)}
        self.lists = [np.array([place[t] for t in terms]) for terms in lists]
        self.flat = np.concatenate([*self.lists, np.zeros(0, np.int64)]).astype(np.int64)
        self.starts = np.cumsum([0, *map(len, self.lists)])[:-1]
        self.hashes = np.array([zlib.crc32(t) for t in self.terms], np.int64)
        self.weights = np.zeros(len(self.terms), np.int64)

    def bounds(self, sketch: np.ndarray, m: int, cells: dict[int, np.ndarray]) -> np.ndarray:
        """Upper bounds of the scores of one document for all items."""
        where = cells.get(len(sketch))
        if where is None:
            where = cells[len(sketch)] = self.hashes & (len(sketch) - 1)
        tf = np.arange(_FULL + 1, dtype=np.int64)
        table = 1_000_000_000 * tf // (1000 * tf + 8 * m)
        table[_FULL] = 1_000_000
        found = self.weights * table[sketch[where]]
        return np.add.reduceat(found[self.flat], self.starts)

    def scores(self, row: tuple[bytes, bytes], m: int, wanted: list[int]) -> list[int]:
        """Exact scores of a document, given as its terms and counts, for some items."""
        counts = dict(zip(row[0].split(), np.frombuffer(row[1], np.uint32).tolist(), strict=True))
        parts = [w * impact(counts[t], m) if t in counts else 0 for t, w in zip(self.terms, self.weights.tolist(), strict=True)]
        return [sum(parts[i] for i in self.lists[item].tolist()) for item in wanted]


def _order(score: int, doc_id: int | None) -> tuple[int, bool, int]:
    """Greater is better: the score, then known ids before missing ones, then the lesser id."""
    return score, doc_id is not None, -(doc_id or 0)


def _statistics(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[pa.RecordBatch]:
    """(place of the term, documents with it); at -1 the number of documents, at -2 their terms."""
    place = {t: i for i, t in enumerate(block.terms)}
    wanted, found = place.keys(), Counter()
    for batch in batches:
        for terms in batch.column("terms").to_pylist():
            found.update(wanted & set(terms.split()))
    rows = [(place[t], c) for t, c in found.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int64()))], ["place", "held"])


def _best(batches: Iterator[pa.RecordBatch], block: Block, documents: int, length: int, k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best documents of a task for each item of the block."""
    heaps: list[list[tuple[int, bool, int]]] = [[] for _ in block.keys]
    threshold = np.ones(len(block.keys), np.int64)
    cells: dict[int, np.ndarray] = {}
    for batch in batches:
        # A slice of the batch at a time, so that no more than a lot of stored terms becomes Python objects.
        for a in range(0, batch.num_rows, LOT):
            rows = batch.slice(a, LOT)
            ids, lengths = rows.column("doc_id").to_pylist(), rows.column("n").to_pylist()
            sketches, terms, counts = (rows.column(c) for c in ("sketch", "terms", "counts"))
            ms = [10 + 90 * n * documents // length for n in lengths]
            bounds = np.stack([
                block.bounds(np.frombuffer(sketches[i].as_buffer(), np.uint8), m, cells) if n else np.zeros(len(block.keys), np.int64)
                for i, (m, n) in enumerate(zip(ms, lengths, strict=True))])
            # The document with the highest bound of all first; those of one document are scored together.
            for i in np.argsort(-bounds.max(axis=1), kind="stable").tolist():
                wanted = np.flatnonzero(bounds[i] >= threshold).tolist()
                if not wanted:
                    continue
                scored = block.scores((terms[i].as_py(), counts[i].as_py()), ms[i], wanted)
                for item, score in zip(wanted, scored, strict=True):
                    entry, heap = _order(score, ids[i]), heaps[item]
                    if not score:
                        continue
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == k:
                        threshold[item] = heap[0][0]
    out = [(key, -e[2] if e[1] else None, e[0]) for key, heap in zip(block.keys, heaps, strict=True) for e in heap]
    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], ["item", "doc_id", "score"])


def _blocks(items: DataFrame) -> Iterator[Block]:
    """Blocks of items, streamed to the driver and cut where their texts pass ``BLOCK_BYTES``."""
    held, size = [], 0
    for row in items.select("item", F.col("text").cast("binary")).toLocalIterator():
        if held and size + len(row["text"] or b"") > BLOCK_BYTES:
            yield Block(held)
            held, size = [], 0
        held.append((row["item"], bytes(row["text"] or b"")))
        size += len(held[-1][1])
    if held:
        yield Block(held)


def _searched(index: DataFrame, block: Block, k: int) -> DataFrame:
    counted = index.select("terms").mapInArrow(lambda b: _statistics(b, block), "place int, held long").groupBy("place").agg(F.sum("held").alias("held"))
    held = {r["place"]: r["held"] for r in counted.collect()}
    totals = index.where("n > 0").agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    documents, length = totals["documents"], totals["length"] or 1
    block.weights = np.array([weight(documents, held.get(i, 0)) if i in held else 0 for i in range(len(block.terms))], np.int64)
    return index.mapInArrow(lambda b: _best(b, block, documents, length, k), "item long, doc_id long, score long")


def search(spark: SparkSession, path: str, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of the index at ``path`` for each item."""
    index = bounded(spark.read.schema(_INDEX).parquet(path))
    # As a table: a number that is taken twice has to be the same.
    numbered = stored(items.select("item_id", F.col("text").cast("string")).withColumn("item", F.monotonically_increasing_id()), "items")
    found = None
    for block in _blocks(numbered):
        if block.keys:
            part = _searched(index, block, k)
            found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return numbered.select("item", "item_id").join(ranked, "item").select("item_id", "rank", "doc_id", "score")

