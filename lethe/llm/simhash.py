"""SimHash near-duplicates: pigeonhole blocks find close fingerprints, Hamming distance verifies them.

A text's fingerprint has a bit set where over half the hashes of its 4-word shingles
have it. Fingerprints that differ in at most ``DISTANCE`` bits agree on ``k`` of
``DISTANCE + k`` blocks of bits, so each fingerprint goes once into the bucket of each
choice of ``k`` blocks. ``k`` grows with the number of distinct fingerprints, to
keep chance meetings in a bucket few; the links found are the same for every ``k``.
A bucket of over ``BUCKET`` fingerprints, as templates make them, is not searched: its
members go into buckets of further blocks of their other bits, until buckets are small or
only ``LAST_BITS`` bits are left to differ, which bound a bucket by themselves. Within a
task a search that gets nowhere near linear does the same.

Only distinct fingerprints are compared, so copies cost one row each. A bucket
emits a spanning forest of its links, never its pairs: a search takes each
fingerprint once and drops what it reaches from what is still to be compared, so a dense
group costs little more than its size.

Nulls: a null text has no words and the fingerprint zero, as has an empty one; a null
``doc_id`` is kept, and a component's id is its least known one. Repeated rows each get a
row. An empty table gives no rows. Other columns are not read by ``assign``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lethe.llm import nearcopies
from lethe.llm.common import bounded, components, drop_stored, fresh, key_map, shingle_hashes, slices, split_by_map, stored, text_bytes

SHINGLE_WORDS = 4
DISTANCE = 4
#: Fingerprints of a bucket that is searched as it is, and bits outside a key that bound a bucket's size by themselves.
BUCKET, LAST_BITS = 1 << 20, 20
#: Blocks to agree on where a large bucket is split, and comparisons that a search has, for each fingerprint and in all.
FINER, SEARCH_EACH, SEARCH = 2, 64, 1 << 24
#: Files of a table, at most, whose rows are numbered by file and place.
MOST_FILES = 1 << 18


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS, step: int = 1 << 16) -> np.ndarray:
    n = len(offsets) - 1
    hashes, doc = shingle_hashes(data, offsets, width)
    ones, total = np.zeros((n, 64), np.int64), np.bincount(doc, minlength=n)
    for a in range(0, len(hashes), step):
        bits = np.unpackbits(hashes[a : a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = doc[a : a + step]
        begin = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = fingerprints_of(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return bounded(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _choices(bits: list[int], k: int) -> list[int]:
    """Masks of the choices of k of DISTANCE + k blocks of these bits: numbers that differ in at most DISTANCE of the bits agree under one."""
    blocks = DISTANCE + k
    edges = [len(bits) * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[i:j]) for i, j in pairwise(edges)]
    return [reduce(int.__or__, chosen) for chosen in combinations(parts, k)]


def _masks(n: int) -> list[int]:
    """Bit masks of the buckets of n fingerprints, with keys of about log2 n bits or more."""
    wanted = np.log2(max(n, 1)) - 2
    k = next((k for k in range(1, 8) if 64 * k // (DISTANCE + k) >= wanted), 8)
    return [_signed(m) for m in _choices(list(range(64)), k)]


def _finer(mask: int) -> list[int]:
    """Masks of the buckets that take the place of one bucket of ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [_signed((mask % (1 << 64)) | m) for m in _choices(free, FINER)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def forest(values: np.ndarray, distance: int = DISTANCE, *, search: int = SEARCH) -> list[tuple[int, int]]:
    """Links within ``distance`` that connect what all such links connect; values are distinct."""
    links, rest, queue = [], values.view(np.uint64), []
    left = search + SEARCH_EACH * len(rest)
    while len(rest) > (0 if queue else 1):
        if left < 0:
            # Members that lie apart: what is not searched yet is parted by blocks of the bits that differ.
            todo = np.concatenate([np.array(queue, np.uint64), rest])
            bits = int(np.bitwise_or.reduce(todo ^ todo[0]))
            places = [b for b in range(64) if bits >> b & 1]
            if len(places) > DISTANCE + FINER:
                for mask in _choices(places, FINER):
                    keys = todo & np.uint64(mask)
                    order = np.argsort(keys, kind="stable")
                    links += np.stack(_run_links(keys[order], todo[order], search=search), axis=1).tolist()
                return links
            left = len(rest) ** 2
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
        one = queue.pop()
        left -= len(rest)
        near = np.bitwise_count(rest ^ np.uint64(one)) <= distance
        if near.any():
            found = rest[near].tolist()
            links += [(one, other) for other in found]
            queue += found
            rest = rest[~near]
    return links


def _run_links(keys: np.ndarray, fp: np.ndarray, **search) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal keys."""
    begin, end = _runs(keys)
    pair = begin[end - begin == 2]
    a, b = fp[pair], fp[pair + 1]
    near = np.bitwise_count(a ^ b) <= DISTANCE
    long = end - begin > 2
    more = [x for i, j in zip(begin[long].tolist(), end[long].tolist(), strict=True) for x in forest(fp[i:j], **search)]
    more = np.array(more, np.uint64).reshape(-1, 2)
    return np.concatenate([a[near], more[:, 0]]), np.concatenate([b[near], more[:, 1]])


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of equal keys (rows, where they have columns)."""
    differ = keys[1:] != keys[:-1]
    change = np.flatnonzero(differ.any(axis=1) if differ.ndim > 1 else differ) + 1
    edges = np.concatenate([[0], change, [len(keys)]]) if len(keys) else np.zeros(1, np.int64)
    return edges[:-1], edges[1:]


def _bucket_links(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (mask null) of buckets of ``most`` rows or fewer; the rows of larger ones pass through, with their mask.

        Rows come sorted by bucket, and a bucket may span batches. No more than ``most`` rows and a batch are held.
        """
        held, passed = np.zeros((0, 3), np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.stack([batch.column(k).to_numpy() for k in ("mask", "key", "fp")], axis=1)])
            begin, end = _runs(rows[:, :2])
            large = end - begin > most
            if passed is not None and (rows[0, :2] == passed).all():
                large[0] = True
            over = np.repeat(large, end - begin)
            # The last bucket may go on in the next batch.
            stop, passed = (len(rows), rows[-1, :2]) if large[-1] else (begin[-1], None)
            if large.any():
                yield _link_batch(rows[over, 2], rows[over, 2], rows[over, 0])
            yield _searched(rows[:stop][~over[:stop]])
            held = rows[stop:]
        yield _searched(held)

    return run


def _searched(rows: np.ndarray) -> pa.RecordBatch:
    return _link_batch(*_run_links(rows[:, :2], np.ascontiguousarray(rows[:, 2]).view(np.uint64)))


def _link_batch(a: np.ndarray, b: np.ndarray, mask: np.ndarray | None = None) -> pa.RecordBatch:
    masks = pa.nulls(len(a), pa.int64()) if mask is None else pa.array(mask)
    return pa.RecordBatch.from_arrays([masks, pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["mask", "a", "b"])


def links(distinct: DataFrame, *, most: int = BUCKET) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints (column fp), enough to connect all that links connect.

    Buckets of over ``most`` members are split by further bits; which links connect is the same for every ``most``.
    """
    masks = _masks(distinct.count())
    spread = distinct.select("fp", F.explode(F.lit(masks)).alias("mask"))
    found = []
    while True:
        free = max(64 - (m % (1 << 64)).bit_count() for m in masks)
        # No more than 2 ** free fingerprints agree on the other bits.
        bound = most if free > LAST_BITS else 1 << LAST_BITS
        rows = spread.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        searched = stored(rows.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(
            _bucket_links(bound), "mask long, a long, b long"), "links")
        found.append(searched.where("mask IS NULL").select("a", "b"))
        over = searched.where("mask IS NOT NULL")
        # Masks, not buckets: 15 at first for up to 8 million fingerprints, and 15 for each of them in the next round.
        coarse = [row["mask"] for row in over.select("mask").distinct().collect()]
        if not coarse:
            return reduce(DataFrame.union, found)
        masks = [fine for mask in coarse for fine in _finer(mask)]
        finer = distinct.sparkSession.createDataFrame([(mask, fine) for mask in coarse for fine in _finer(mask)], "mask long, fine long")
        spread = over.join(F.broadcast(finer), "mask").select(F.col("a").alias("fp"), F.col("fine").alias("mask"))


def assign(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id, the least doc_id that links lead to, for each row of ``docs``."""
    marked = stored(fingerprints(docs), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    roots = components(links(distinct.select("fp")))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = grouped.join(least, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def digests(assigned: DataFrame) -> DataFrame:
    return assigned.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, width: int = nearcopies.SHINGLE_WORDS, similarity: tuple[int, int] = nearcopies.SIMILARITY) -> DataFrame:
    """One row of each group of near copies: the least by doc_id (none last), then by a hash of the text.

    Near copies are texts whose fingerprints link, as in ``assign``, and also texts whose sets of ``width``-word shingles are as
    similar as ``similarity``, which fingerprints of 64 bits find only in part. Texts without words are one group. Rows are told apart by their place in the files of ``docs``, never
    by ``doc_id``, so tied and missing ids neither keep a copy nor drop another text.
    """
    (row,) = fresh(docs, "_row")
    tagged = _numbered(docs, row)
    rows = tagged.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("th"), F.col(row).alias("row"))
    marked = stored(nearcopies.sketched(rows, fingerprints_of, width), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "th", "row")
    heads = stored(marked.groupBy("h1", "h2").agg(F.min(order).alias("head")).select("h1", "h2", "head", F.col("head.row").alias("node")), "heads")
    sets = marked.join(heads.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "size", "bands")
    similar = nearcopies.links(sets, rows, width, similarity)
    near = _fingerprint_links(marked.select("fp", "h1", "h2").distinct().join(heads, ["h1", "h2"]).select("fp", "node"))
    roots = components(similar.union(near))
    grouped = stored(heads.join(roots, "node", "left").select("h1", "h2", "head", F.coalesce("root", "node").alias("root")), "grouped")
    least = grouped.groupBy("root").agg(F.min("head").alias("least"))
    # The rows that go: all but the least of each group. Rows that the map of these leaves out stay where they are.
    stays = grouped.join(least, "root").select("h1", "h2", F.col("least.row").alias("keeper"))
    gone = stored(marked.select("row", "h1", "h2").join(stays, ["h1", "h2"]).where("row <> keeper").select(F.col("row").alias(row)), "gone")
    drop_stored(heads, marked, grouped)
    found = key_map(gone, F.xxhash64(F.col(row)))
    perhaps, surely = split_by_map(tagged, F.xxhash64(F.col(row)), None if found is None else stored(found, "gone-map"))
    kept = perhaps.join(gone, row, "left_anti")
    kept = kept if surely is None else kept.unionByName(surely)
    return kept.select(*(F.col(f"`{name}`") for name in docs.columns))


def _fingerprint_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between nodes with fingerprints (node, fp) that connect what ``links`` connects; a node may have several fingerprints."""
    pairs = stored(nodes, "marks")
    distinct = stored(pairs.groupBy("fp").agg(F.min("node").alias("least")), "least-nodes")
    alike = pairs.join(distinct, "fp").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    found = links(distinct.select("fp"))
    ends = [distinct.select(F.col("fp").alias(end), F.col("least").alias(f"least_{end}")) for end in ("a", "b")]
    across = found.join(ends[0], "a").join(ends[1], "b").select(F.col("least_a").alias("a"), F.col("least_b").alias("b"))
    return alike.union(across)


def _numbered(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with a number of its own for each row, the same whenever it is read.

    A Parquet table gives it: the number of the file by name, and the place of the row in it. Anything else, or a table
    of very many or very long files, is stored first.
    """
    try:
        place = docs.select("*", F.col("_metadata.file_path").alias(f"{row}_file"), F.col("_metadata.row_index").alias(f"{row}_place"))
    except AnalysisException:
        place = None
    if place is not None:
        files = place.groupBy(f"{row}_file").agg(F.max(f"{row}_place").alias("last"))
        longest = files.agg(F.count("*").alias("n"), F.max("last").alias("last")).first()
        if longest["n"] <= MOST_FILES and (longest["last"] or 0) < 1 << 40:
            # A row for each file, MOST_FILES at most, so it may be broadcast.
            named = files.select(f"{row}_file", F.row_number().over(Window.orderBy(f"{row}_file")).cast("long").alias(f"{row}_no"))
            joined = place.join(F.broadcast(stored(named, "files")), f"{row}_file")
            return joined.select(*(F.col(f"`{name}`") for name in docs.columns), F.expr(f"shiftleft(`{row}_no`, 40) + `{row}_place`").alias(row))
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "tagged")
