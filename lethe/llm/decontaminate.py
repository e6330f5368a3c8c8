"""Benchmark decontamination: a broadcast hash set of test windows against every window of the corpus.

Words are runs of digits, letters and code points beyond ASCII, A-Z lower-cased. A
window is ``width`` consecutive words of a benchmark item, or all its words where it
has fewer. Training texts are scanned by vectors of word hashes; each hit is verified
word for word, so the hash only selects candidates.

The set is broadcast only while the item texts stay under ``limit_bytes``, which is
measured first; a larger benchmark is taken in parts by hash, made finer until no part is larger (but for
one of a single item), each against all documents, with a table in the shared folder between two parts. Repeated
items are taken once.

Nulls: a null text has no words, an item with null text no window; a null id is kept as
null (items: not listed). Repeated documents are each scanned. Empty tables: an
empty benchmark hits nothing. Further columns pass through; result columns replace columns
of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lethe.llm.common import bounded, lowered, slices, span_hashes, spans, stored, text_bytes, window_hashes, without

WIDTH = 10
#: Bytes of item texts that are broadcast at once; their windows take about three times that.
LIMIT_BYTES = 16 << 20
#: Share of hit words from which on a document goes as a whole.
DROP_SHARE = 0.5
_HINT_BITS = 20
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

RESULT = {"n_words": "long", "n_hit": "long", "hit_bits": "binary", "items": "array<string>"}


class WindowSet:
    """Windows of the items by width: sorted hashes, and where to verify each."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        texts = pa.array([text for _, text in items], pa.string())
        data, offsets = text_bytes(texts)
        low = lowered(data)
        starts, ends, owner = spans(_WORD[low], offsets)
        self.raw, self.starts, self.ends = low.tobytes(), starts.tolist(), ends.tolist()
        self.names = [name for name, _ in items]
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        hashes, size = span_hashes(low, starts, ends), np.bincount(owner, minlength=len(items))
        for w in np.unique(np.minimum(size[size > 0], width)).tolist():
            h = window_hashes(hashes, w)
            first = np.arange(len(h))
            whole = owner[first] == owner[first + w - 1]
            whole &= size[owner[first]] >= width if w == width else size[owner[first]] == w
            at = first[whole]
            order = np.argsort(h[at], kind="stable")
            hint = np.zeros(1 << _HINT_BITS, bool)
            hint[h[at] >> np.uint64(64 - _HINT_BITS)] = True
            self.by_width[w] = h[at][order], at[order], hint
        self.owner = owner.tolist()

    def words(self, at: int, width: int) -> bytes:
        return b" ".join(self.raw[self.starts[k] : self.ends[k]] for k in range(at, at + width))


def _hits(windows: WindowSet, raw: bytes, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, hashes: np.ndarray):
    """Whether each word is hit, and the (text, item) pairs."""
    hit, pairs, memo = np.zeros(len(starts) + 1, np.int32), set(), {}
    for width, (known, places, hint) in windows.by_width.items():
        h = window_hashes(hashes, width)
        some = np.flatnonzero(hint[h >> np.uint64(64 - _HINT_BITS)])
        some = some[doc[some] == doc[some + width - 1]]
        left, right = np.searchsorted(known, h[some], side="left"), np.searchsorted(known, h[some], side="right")
        kept = np.flatnonzero(left < right)
        for i, a, b in zip(some[kept].tolist(), left[kept].tolist(), right[kept].tolist(), strict=True):
            seen = raw[starts[i] : ends[i + width - 1]]
            items = memo.get((width, seen))
            if items is None:
                words = b" ".join(raw[starts[k] : ends[k]] for k in range(i, i + width))
                found = {windows.owner[p] for p in places[a:b].tolist() if windows.words(p, width) == words}
                items = memo[width, seen] = tuple(found)
            if items:
                hit[i] += 1
                hit[i + width] -= 1
                pairs.update((int(doc[i]), item) for item in items)
    return np.cumsum(hit[:-1]) > 0, pairs


def _scanner(shared, first: bool, finish=None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: WindowSet = shared.value
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            low = lowered(data)
            starts, ends, doc = spans(_WORD[low], offsets)
            hit, pairs = _hits(windows, low.tobytes(), starts, ends, doc, span_hashes(low, starts, ends))
            n = np.bincount(doc, minlength=batch.num_rows)
            cuts = np.concatenate([[0], np.cumsum(n)])
            items: list[set] = [set() for _ in range(batch.num_rows)]
            for k, item in pairs:
                if windows.names[item] is not None:
                    items[k].add(windows.names[item])
            bits = [np.packbits(hit[a:b], bitorder="little") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            if not first:
                bits = [x | np.frombuffer(y, np.uint8) for x, y in zip(bits, batch.column("hit_bits").to_pylist(), strict=True)]
                for own, former in zip(items, batch.column("items").to_pylist(), strict=True):
                    own.update(former)
            n_hit = [int(np.bitwise_count(x).sum()) for x in bits]
            kept = [name for name in batch.schema.names if name not in RESULT]
            scanned = pa.RecordBatch.from_arrays(
                [batch.column(name) for name in kept]
                + [pa.array(n), pa.array(n_hit, pa.int64()), pa.array([x.tobytes() for x in bits], pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                [*kept, *RESULT])
            yield scanned if finish is None else finish(scanned)

    return scan


def scan(docs: DataFrame, benchmark: DataFrame, *, width: int = WIDTH, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """``docs`` (with ``text``) and n_words, n_hit, hit_bits (a bit for each word, low bits first), items (ids, sorted)."""
    return _scanned(docs, benchmark, width, limit_bytes)


def clean(
    docs: DataFrame, benchmark: DataFrame, *, width: int = WIDTH, limit_bytes: int = LIMIT_BYTES, drop_share: float = DROP_SHARE
) -> DataFrame:
    """Scan and cut in one pass: the hit spans go out of the texts.

    Documents with ``drop_share`` of their words hit, or with nothing left, go as a whole.
    """
    return _scanned(docs, benchmark, width, limit_bytes, drop_share)


def _part_of(parts: int):
    return F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))


def _parts(items: DataFrame, limit_bytes: int) -> int:
    """A number of parts of which none is over the limit, unless it is a single item."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 if size <= limit_bytes else 2 * -(-size // limit_bytes)
    while parts > 1:
        sizes = items.groupBy(_part_of(parts).alias("part")).agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n"))
        if sizes.where((F.col("n") > 1) & (F.col("size") > limit_bytes)).isEmpty():
            break
        parts *= 2
    return parts


def _scanned(docs: DataFrame, benchmark: DataFrame, width: int, limit_bytes: int, drop_share: float | None = None) -> DataFrame:
    docs = without(docs, *RESULT)
    # Copies of one item would all fall into one part.
    items = benchmark.select(F.col("item_id").cast("string"), "text").where("text IS NOT NULL").distinct()
    parts = _parts(items, limit_bytes)
    kept = T.StructType(docs.schema.fields)
    schema = T.StructType(kept.fields + [T.StructField(k, T._parse_datatype_string(v)) for k, v in RESULT.items()])
    for part in range(parts):
        own = items if parts == 1 else items.where(_part_of(parts) == part)
        windows = WindowSet([tuple(row) for row in own.collect()], width)
        last, shared = part == parts - 1, docs.sparkSession.sparkContext.broadcast(windows)
        finish = _cutter(kept, drop_share) if last and drop_share is not None else None
        done = bounded(docs).mapInArrow(_scanner(shared, part == 0, finish), kept if finish else schema)
        docs = done if last else stored(done, "decontaminate")
    return docs


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def _cutter(schema: T.StructType, drop_share: float):
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, keep = batch.column("text").to_pylist(), np.ones(batch.num_rows, bool)
        counts = batch.column("n_words").to_pylist()
        for k in np.flatnonzero(batch.column("n_hit").to_numpy() > 0).tolist():
            bits = np.frombuffer(batch.column("hit_bits")[k].as_py(), np.uint8)
            hit = np.unpackbits(bits, count=counts[k], bitorder="little").astype(bool)
            if hit.mean() >= drop_share:
                keep[k] = False
                continue
            raw = texts[k].encode()
            data = np.frombuffer(raw, np.uint8)
            starts, ends, _ = spans(_WORD[lowered(data)], np.array([0, len(data)]))
            runs, stops, _ = spans(hit, np.array([0, len(hit)]))
            parts, at = [], 0
            for a, b in zip(runs.tolist(), stops.tolist(), strict=True):
                parts.append(raw[at : starts[a]])
                at = ends[b - 1]
            texts[k] = b"".join([*parts, raw[at:]]).decode()
            keep[k] = bool(texts[k].strip())
        arrays = [pa.array(texts, pa.string()) if f.name == "text" else batch.column(f.name) for f in schema.fields]
        return pa.RecordBatch.from_arrays(arrays, schema.fieldNames()).filter(pa.array(keep))

    return cut
