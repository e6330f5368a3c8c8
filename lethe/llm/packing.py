"""Conflict-constrained best-fit packing of documents into sequences of a fixed number of tokens.

Documents are dealt evenly over shards of some thousands, by place and not by value,
so no source or duplicate cluster makes a shard large. In a shard, items go in by falling
size: bins are kept ordered by residual, and the search starts at the least residual
that fits and goes on until a bin holds neither the item's source nor its duplicate
cluster, which bitmaps of the bin tell. Nothing fits: a new bin.

A document longer than a bin fills bins of its own; its rest is an item like others.

Nulls: a null text has no tokens but the end token; a null source conflicts with nothing; a null
``doc_id`` is kept. Copies share a cluster, and repeated rows are copies. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm.common import bounded, slices, stored
from lethe.llm.tokens import encoder

CAPACITY = 2048
SHARD_DOCS = 4096
SCHEMA = "doc_id long, source string, cluster long, piece long, n_tokens long, bin_id long, bin_offset long"


def sizes(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, source, cluster (a hash of the text) and n_tokens with the end token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in slices(batches):
            n = own.counts(batch.column("text").to_pylist()) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in ("doc_id", "source", "cluster")] + [pa.array(n)],
                ["doc_id", "source", "cluster", "n_tokens"])

    chosen = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64("text").alias("cluster"), "text")
    return bounded(chosen).mapInArrow(count, "doc_id long, source string, cluster long, n_tokens long")


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """The bin of each item (size, source bits, cluster bits); items come by falling size."""
    order: list[tuple[int, int]] = []  # (residual, bin)
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for size, source, cluster in items:
        at = bisect_left(order, (size, -1))
        while at < len(order) and (sources[order[at][1]] & source or clusters[order[at][1]] & cluster):
            at += 1
        if at < len(order):
            residual, chosen = order.pop(at)
        else:
            residual, chosen = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[chosen] |= source
        clusters[chosen] |= cluster
        insort(order, (residual - size, chosen))
        placed.append(chosen)
    return placed


def _packer(capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        rows = sorted(
            zip(*(group.column(k).to_pylist() for k in ("n_tokens", "doc_id", "cluster", "source")), strict=True),
            key=lambda r: (-(r[0] % capacity), r[1] is not None, r[1] or 0, r[2], r[3] or ""))
        bits = {s: 1 << k for k, s in enumerate(dict.fromkeys(r[3] for r in rows if r[3] is not None))}
        shared = {c: 1 << k for k, (c, n) in enumerate(Counter(r[2] for r in rows).items()) if n > 1}
        rests = [(n % capacity, bits.get(source, 0), shared.get(cluster, 0)) for n, _, cluster, source in rows if n % capacity]
        chosen = iter(best_fit(rests, capacity))
        used: Counter = Counter()
        out, whole = [], len(rests)
        for n, doc_id, cluster, source in rows:
            for piece in range(n // capacity):
                out.append((doc_id, source, cluster, piece, capacity, shard << 32 | whole, 0))
                whole += 1
            if n % capacity:
                b = next(chosen)
                out.append((doc_id, source, cluster, n // capacity, n % capacity, shard << 32 | b, used[b]))
                used[b] += n % capacity
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        names = ("doc_id", "source", "cluster", "piece", "n_tokens", "bin_id", "bin_offset")
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    return pack


def pack(sized: DataFrame, *, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """A row for each piece: its bin, and where in the bin it begins. ``sized`` is a stored table."""
    shards = -(-sized.count() // shard_docs) or 1
    # Places in the files of a stored table are the same for every attempt of a task.
    placed = sized.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    return placed.groupBy("shard").applyInArrow(_packer(capacity), SCHEMA)


def run(docs: DataFrame, vocabulary: str, *, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    return pack(stored(sizes(docs, vocabulary), "sizes"), capacity=capacity, shard_docs=shard_docs)
