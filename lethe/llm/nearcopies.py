"""Links between texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

No distance on 64-bit SimHash fingerprints serves here: pairs at 0.8 differ in up to 14 bits, and
blocks that 14 flips leave whole are too short to part a large table. So candidates share one of
``BANDS`` bands of ``ROWS`` minima of hashed shingles: a pair at exactly 0.8 is missed with
probability (1 - 0.8 ** ROWS) ** BANDS, 1 in 4,800. Every candidate is verified on the whole sets, exactly.

Only distinct sets are compared. Of buckets with the same members one is searched. A bucket
emits a spanning forest of its links, never its pairs, and a large one is cut into blocks
whose pairs of blocks are tasks of their own, so a task's memory is bounded (by two blocks of
``BLOCK_SETS`` sets or ``BLOCK_SHINGLES`` shingles on average) and no pair in it is left out.

Nulls and ties: a null or empty text has an empty set, which is in no bucket; equal sets are to be made one by the
caller, who knows which row stands for them. Rows are told by their number alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lethe.llm.common import bounded, drop_stored, key_map, mixed, shingle_hashes, slices, split_by_map, stored, text_bytes

SHINGLE_WORDS = 5
#: Least similarity of a link, as a fraction.
SIMILARITY = (4, 5)
BANDS, ROWS = 16, 4
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 20
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CELL = ("t", "key", "i", "j")


def sets_of(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted sets of shingle hashes of several texts end to end, and their offsets."""
    hashes, doc = shingle_hashes(data, offsets, width)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(len(offsets)))


def sketches(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each set (0 where it is empty) and its bands."""
    n = len(bounds) - 1
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    h, bands = np.zeros((2, n), np.uint64), np.zeros((n, BANDS), np.uint64)
    if len(full):
        at = bounds[full]
        for k in range(2):
            h[k, full] = mixed(np.add.reduceat(mixed(hashes ^ _FACTORS[k]), at))
        for b in range(BANDS):
            key = np.full(len(full), b, np.uint64)
            for factor in _FACTORS[b * ROWS : (b + 1) * ROWS]:
                key = mixed(key ^ np.minimum.reduceat(hashes * factor, at))
            bands[full, b] = key
    return h[0], h[1], bands


def sketched(rows: DataFrame, fingerprints: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, th, row, fingerprint of the text, size of the set, its hashes h1 and h2, and bands, for rows with these first three and text."""
    schema = "doc_id long, th long, row long, fp long, size long, h1 long, h2 long, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            hashes, bounds = sets_of(data, offsets, width)
            h1, h2, bands = sketches(hashes, bounds)
            fp = fingerprints(data, offsets)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(bands) + 1) * BANDS, pa.int32()), pa.array(bands.view(np.int64).ravel()))
            columns = [*(batch.column(k) for k in ("doc_id", "th", "row")), pa.array(fp.view(np.int64)), pa.array(np.diff(bounds)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "th", "row", "fp", "size", "h1", "h2", "bands"])

    return bounded(rows).mapInArrow(run, schema)


def _sets(rows: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, bounds = sets_of(*text_bytes(batch.column("text")), width)
            raw = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(raw, pa.binary())], ["node", "shingles"])

    return bounded(rows).mapInArrow(run, "node long, shingles binary")


def forest(nodes: list[int], sets: list[np.ndarray], similarity: tuple[int, int] = SIMILARITY) -> list[tuple[int, int]]:
    """Links of at least ``similarity`` that connect what all such links connect; sets are sorted, distinct and not empty."""
    over, under = similarity
    links, size, flat, rest = [], np.array([len(s) for s in sets]), np.concatenate(sets), np.arange(len(sets))
    queue: list[int] = []
    while len(rest):
        if not queue:
            queue, drop = [int(rest[0])], np.arange(len(rest)) == 0
        else:
            one = queue.pop()
            own, n = sets[one], size[rest]
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            common = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(n) - n)
            drop = under * common >= over * (len(own) + n - common)
            found = rest[drop].tolist()
            links += [(nodes[one], nodes[k]) for k in found]
            queue += found
        if drop.any():
            flat, rest = flat[np.repeat(~drop, size[rest])], rest[~drop]
    return links


def _cell_links(similarity: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links in runs of one cell; rows come sorted by cell, and a run may span batches."""
        cell, nodes, sets, links = None, [], [], []

        def out() -> pa.RecordBatch:
            pairs = np.array(links, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in _CELL), strict=True)
            for k, (key, node) in enumerate(zip(keys, batch.column("node").to_pylist(), strict=True)):
                if key != cell:
                    links += forest(nodes, sets, similarity) if len(nodes) > 1 else []
                    cell, nodes, sets = key, [], []
                nodes.append(node)
                sets.append(np.frombuffer(batch.column("shingles")[k].as_py(), np.uint64))
            if links:
                yield out()
                links = []
        links += forest(nodes, sets, similarity) if len(nodes) > 1 else []
        if links:
            yield out()

    return run


def links(sets: DataFrame, rows: DataFrame, width: int = SHINGLE_WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """Verified links (a, b) between distinct sets (node, size, bands); ``rows`` has the text of each node as ``row``."""
    spread = sets.where("size > 0").select("node", "size", F.posexplode("bands").alias("t", "key"))
    # Over one shuffle of the bands each bucket is counted and marked by its members.
    bucket = Window.partitionBy("t", "key")
    mark = {f"m{k}": F.bit_xor(F.xxhash64(F.lit(k), "node")).over(bucket) for k in range(2)}
    crowded = stored(spread.withColumns({"n": F.count("*").over(bucket), "total": F.sum("size").over(bucket), **mark}).where("n > 1"), "crowded")
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_SETS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("long")
    # Buckets of the same members, which near copies share in most bands, are searched once.
    same = ["n", "total", "m0", "m1"]
    chosen = crowded.groupBy(*same).agg(F.min(F.struct("t", "key")).alias("b")).select("b.t", "b.key")
    members = stored(crowded.join(chosen, ["t", "key"], "left_semi").select("t", "key", parts.alias("parts"), "node"), "members")
    drop_stored(crowded)
    wanted = members.select(F.col("node").alias("row")).distinct()
    # Sets are computed where the texts lie, of rows that the map of wanted ones lets through.
    found = key_map(wanted, F.xxhash64("row"))
    texts = rows.select("row", "text")
    if found is None:
        some = texts.join(wanted, "row", "left_semi")
    else:
        found = stored(found, "wanted")
        some = split_by_map(texts, F.xxhash64("row"), found)[0]
    shingles = stored(_sets(some, width), "shingles")
    own = F.pmod(F.xxhash64("node"), "parts")
    cells = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        "t", "key", F.least(own, "other").alias("i"), F.greatest(own, "other").alias("j"), "node")
    dealt = bounded(cells.join(shingles, "node")).repartition(*_CELL).sortWithinPartitions(*_CELL)
    found_links = stored(dealt.select(*_CELL, "node", "shingles").mapInArrow(_cell_links(similarity), "a long, b long"), "links")
    drop_stored(shingles, members)
    return found_links
