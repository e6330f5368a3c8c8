"""What the operators share: Arrow batches of bounded size, byte scans, hashes, components.

Texts arrive as Arrow columns. Scans work on the UTF-8 bytes of several texts at
once, so each step is one vector operation, and never hold more than a slice of
some megabytes (or one text, where a text alone is longer).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.scratch import scratch_path

#: Bytes of text that one vector step works on.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between Spark and a Python worker.
BATCH_BYTES = 4 << 20
_BASE, _MIX1, _MIX2 = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
#: Seed of shingle hashes, and the bytes that words consist of.
SEED = 42
_INSIDE = np.ones(256, bool)
_INSIDE[9:14] = _INSIDE[32] = False


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables that ``stored`` makes are noted here while a shelf is open, so that whoever opened it can drop them.
_shelf: ContextVar[list[str] | None] = ContextVar("shelf", default=None)
#: Bits of a map of keys, at most, and bits for each key.
MOST_BITS, BITS_EACH = 1 << 26, 8


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    shelf = _shelf.get()
    if shelf is not None:
        shelf.append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


@contextmanager
def shelf() -> Iterator[list[str]]:
    """The paths of all tables that are stored in the block."""
    paths: list[str] = []
    token = _shelf.set(paths)
    try:
        yield paths
    finally:
        _shelf.reset(token)


def drop_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` once everything that was to read them is written itself."""
    for table in tables:
        drop_paths(table.sparkSession, [table._stored_at])


def key_map(keys: DataFrame, hashed: Column) -> DataFrame | None:
    """A bit for each key, by the low bits of a hash, as words (w, bits); None beyond ``MOST_BITS``.

    Its size is bounded whatever the number of keys, so it is safe to broadcast. It says of a row that its key is
    surely not there, or perhaps: only the latter need a join.
    """
    bits = 1 << max(BITS_EACH * keys.count(), 1 << 10).bit_length()
    if bits > MOST_BITS:
        return None
    words = bits // 64
    place = F.pmod(hashed, F.lit(bits))
    return keys.select((place % words).alias("w"), F.call_function("div", place, F.lit(words)).cast("int").alias("b")).groupBy("w").agg(
        F.expr("bit_or(shiftleft(1L, b))").alias("bits")).withColumn("words", F.lit(words))


def split_by_map(df: DataFrame, hashed: Column, found: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key may be in the map, and those whose key is surely not (None without a map). Nothing is shuffled."""
    if found is None:
        return df, None
    w, b, bits = fresh(df, "_w", "_b", "_bits")
    words = found.first()
    if words is None:
        return df.limit(0), df
    n = words["words"]
    place = F.pmod(hashed, F.lit(64 * n))
    flagged = df.withColumns({w: place % n, b: F.call_function("div", place, F.lit(n)).cast("int")}).join(
        F.broadcast(found.select(F.col("w").alias(w), F.col("bits").alias(bits))), w, "left")
    there = F.expr(f"coalesce(shiftright(`{bits}`, `{b}`) & 1L, 0L) = 1L")
    columns = [F.col(f"`{name}`") for name in df.columns]
    return flagged.where(there).select(*columns), flagged.where(~there).select(*columns)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that a result column of the same name (in any case) replaces."""
    taken = {name.lower() for name in names}
    return df.select(*(F.col(f"`{name}`") for name in df.columns if name.lower() not in taken))


def bounded(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches stay small where texts are long.

    Spark sends 10,000 rows or 64 MB at a time unless told otherwise; a session that was told is left alone.
    """
    conf, limit = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(limit) == "67108864b":
        conf.set(limit, f"{BATCH_BYTES}b")
    return df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, made longer until no column of ``df`` has it."""
    taken, out = {name.lower() for name in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` has at most ``size`` bytes in each, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column one after another, and n + 1 offsets; null is empty."""
    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = filled.buffers()
    ends = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if data is None or not len(filled):
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true cells that do not cross texts: starts, ends and the text of each."""
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begin] = inside[begin]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _power_table(base: int, n: int) -> np.ndarray:
    found = _powers.get(base)
    if found is None or len(found) < n:
        size = max(n, 1 << 16)
        found = np.empty(size, np.uint64)
        found[0], done = 1, 1
        while done < size:
            step = min(done, size - done)
            found[done : done + step] = found[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        if n <= 1 << 22:
            _powers[base] = found
    return found


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(_MIX1)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(_MIX2)
    return h ^ (h >> np.uint64(33))


class SpanHashes:
    """A 64-bit hash of ``symbols[start:end]`` for each span; equal spans have equal hashes."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.sums, self.inverse = np.zeros(n + 1, np.uint64), _power_table(_BASE_INVERSE, n + 1)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, n + 1)[:n], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(_MIX2))


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of ``SpanHashes`` for one set of spans."""
    return SpanHashes(symbols)(starts, ends)


def window_hashes(items: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive 64-bit numbers, by their first position."""
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * np.uint64(_BASE) + items[k : k + n]
    return mixed(h)


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of several texts, and the text of each."""
    low = lowered(data)
    inside = _INSIDE[low]
    starts, ends, doc = spans(inside, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # One blank after each word: the byte that follows it, or one more at the end of a text.
    length = ends - starts
    begin = np.concatenate([[0], np.cumsum(length + 1)])
    plain = np.full(begin[-1], 32, np.uint8)
    plain[np.arange(len(low))[inside] + np.repeat(begin[:-1] - starts, length)] = low[inside]
    raw = plain.tobytes()
    count = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    begins_shingle = np.arange(len(starts)) - first[doc] <= np.maximum(count[doc] - width, 0)
    at = np.flatnonzero(begins_shingle)
    last = np.minimum(at + width - 1, (first + count - 1)[doc[at]])
    digest = xxhash.xxh64_intdigest
    pairs = zip(begin[at].tolist(), (begin[last] + length[last]).tolist(), strict=True)
    return np.fromiter((digest(raw[a:b], SEED) for a, b in pairs), np.uint64, len(at)), doc[at]


def components(edges: DataFrame) -> DataFrame:
    """Connected components: ``edges`` (a, b) of longs to (node, root), root the least node.

    Large-star and small-star steps alternate until nothing moves, so the rounds grow
    with the logarithm of the longest chain. A row per edge at most is kept, a node's
    neighbours are only ever reduced to their least, and each round is a table in
    the shared folder.
    """
    now = stored(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("low"))
        # Large star: neighbours above a node move to the least one of its neighbourhood.
        large = both.where("b > a").join(least, F.col("a") == F.col("node")).select(
            F.col("low").alias("a"), "b").distinct()
        # Small star: a node and its lower neighbours move to the least of these.
        floor = large.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
        joined = large.join(floor, F.col("b") == F.col("node"))
        small = joined.select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a < b").distinct()
        then = stored(small, "edges")
        before, after = (x.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first() for x in (now, then))
        drop_stored(now)
        moved, now = before != after, then
        if not moved:
            return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
