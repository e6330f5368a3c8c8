"""Suffix-array dedup of byte strings: every byte in a ``LENGTH``-byte string seen earlier goes.

Each window of ``LENGTH`` bytes has an anchor, the ``ANCHOR``-byte string in it of least hash;
equal windows have equal anchors at equal places. Neighbouring windows of one anchor make a
segment. A few common words make an anchor, so a segment is cut in halves: the windows that hold
at most half of their other bytes before the anchor, and the others. All windows of a half share
a core of over half a window, so what repeats lies in halves whose cores repeat.

Texts are packed into slices of some megabytes, a table bucketed by slice, so that what is
found out about a slice comes back to it without moving texts again. First ids and hashes of
whole texts are dealt out: a text that a lower id has, too, is a repeat from end to end, and is left out of
what follows. Then the cores' hashes alone are dealt out and counted, and each slice learns which
of its cores occur elsewhere. Then the halves of those are dealt over shards by their core: equal windows meet in one
shard whatever documents they are in. A slice first drops copies of halves that it
holds itself.

In a shard, of equal halves all but the first are repeats. Of the different halves of a core, the windows
that share all but some bytes with another, with a mark after each run, go through external induced sorting (``induced``):
suffixes in order with their common prefixes, where a run of common prefixes of
``LENGTH`` or more is one repeated string. Its first place by (document, start) stays.

Order and ties: documents come in order of doc_id (null first), those of one id in order of a
hash of the text; rows alike in both count as one document, and each keeps the same bytes.
Nulls: a null text is empty. Short texts have no window. An empty table gives no rows.
Other columns are not read. Where a removal leaves broken UTF-8, ``kept`` is still exact,
since it is binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm import induced
from lethe.llm.common import _BASE, _BASE_INVERSE, SpanHashes, _power_table, bounded, mixed, slices, spans, stored, text_bytes
from lethe.scratch import scratch_database

LENGTH, ANCHOR = 100, 20
#: Shards for each shuffle partition; a shard is held by one task while its text is sorted.
SHARDS_PER_PARTITION = 3
SLICE = 2 << 20
#: Windows whose anchors are looked for at once.
BLOCK = 1 << 15
SLICES = "slice long, image binary, heads binary"
MARKS = "slice long, row int, first int, last int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
_NO_ID = -(1 << 63)


def _least(data: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """For each window the place of its anchor; in blocks that stay in the processor's cache."""
    n = len(data) - length + 1
    out = np.empty(n, np.int32)
    power, inverse = _power_table(_BASE, BLOCK + length), _power_table(_BASE_INVERSE, BLOCK + length)
    number = np.arange(BLOCK + length, dtype=np.uint64)
    width = length - anchor + 1
    for base in range(0, n, BLOCK):
        part = data[base : base + BLOCK + length - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        h = (sums[anchor:] - sums[:-anchor]) * inverse[: len(part) - anchor + 1]
        # Upper half: the hash, which decides; lower half: the place, so the first of equals wins.
        least = (mixed(h) & np.uint64(0xFFFFFFFF00000000)) | number[: len(h)]
        step = 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if width > step:
            least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
        out[base : base + len(least)] = (least & np.uint64(0xFFFFFFFF)).astype(np.int32) + np.int32(base)
    return out


def segments(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Text, first and last window (from the text's start), and anchor (likewise) of each segment."""
    n, none = len(data), np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none
    place = _least(data, length, anchor)
    valid = np.zeros(n + 1, np.int8)
    begins = np.zeros(n + 1, bool)
    sizes = np.diff(offsets)
    fits = sizes >= length
    valid[offsets[:-1][fits]] += 1
    valid[(offsets[1:] - length + 1)[fits]] -= 1
    begins[offsets[:-1][fits]] = True
    at = np.flatnonzero(np.cumsum(valid, dtype=np.int8)[: len(place)] > 0)
    if not len(at):
        return none, none, none, none
    own = place[at]
    new = begins[at]
    new[0] = True
    new[1:] |= own[1:] != own[:-1]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    owner = np.searchsorted(offsets, at[begin], side="right") - 1
    return owner, at[begin] - offsets[owner], at[end] - offsets[owner], own[begin] - offsets[owner]


def halves(first: np.ndarray, last: np.ndarray, place: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Segment, first and last window, and start and width of the core of each half, in order of segment and window.

    The windows of a segment that hold at most half of their other bytes before the anchor share the rest behind it, the
    others share what is before it: the core is the anchor with that half, so a few common words do not make a core.
    """
    before = (length - anchor) // 2
    cut = place - before
    both = [(last >= cut, np.maximum(first, cut), last, place, length - before),
            (first < cut, first, np.minimum(last, cut - 1), cut - 1, anchor + before + 1)]
    parts = [(np.flatnonzero(has), low[has], high[has], core[has], np.full(int(has.sum()), width)) for has, low, high, core, width in both]
    owner, low, high, core, width = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((low, owner))
    return owner[order], low[order], high[order], core[order], width[order]


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    begin = np.cumsum(sizes) - sizes
    return data[np.repeat(starts - begin, sizes) + np.arange(int(sizes.sum()))]


def _places(ids: np.ndarray, th: np.ndarray) -> np.ndarray:
    """The place of each (doc_id, th) among the distinct ones."""
    order = np.lexsort((th, ids))
    new = np.concatenate([[0], np.cumsum((ids[order][1:] != ids[order][:-1]) | (th[order][1:] != th[order][:-1]))])
    place = np.empty(len(ids), np.int64)
    place[order] = new
    return place


def _pack(arrays: list[np.ndarray]) -> bytes:
    kinds = "".join(a.dtype.char for a in arrays).encode()
    head = bytes([len(kinds)]) + kinds + np.array([a.nbytes for a in arrays], np.int64).tobytes()
    raw = head + b"".join(a.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    kinds = raw[1 : 1 + raw[0]].decode()
    sizes = np.frombuffer(raw, np.int64, len(kinds), 1 + len(kinds))
    at = np.cumsum(sizes) - sizes + 1 + 9 * len(kinds)
    return [np.frombuffer(raw, k, int(n) // np.dtype(k).itemsize, int(i)) for k, n, i in zip(kinds, sizes, at, strict=True)]


def _packed_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of SLICES; a slice is named by its content, so every attempt of a task names it alike."""
    for batch in slices(batches, size=SLICE):
        data, offsets = text_bytes(batch.column("text"))
        ids, th, other = (batch.column(k).to_numpy() for k in ("doc_id", "th", "other"))
        known = batch.column("known").to_numpy(zero_copy_only=False).astype(np.uint8)
        image = _pack([ids, known, th, np.diff(offsets), data])
        heads = _pack([ids, th, other, np.diff(offsets)])
        name = int.from_bytes(hashlib.blake2b(image, digest_size=8).digest(), "little", signed=True)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([image]), pa.array([heads])], ["slice", "image", "heads"])


def _heads(shards: int, length: int):
    """Rows (shard, slice, texts): id, hashes, size and row of the texts that have windows, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, heads in zip(batch.column("slice").to_pylist(), batch.column("heads"), strict=True):
                own = _unpack(heads.as_py())
                at = np.flatnonzero(own[3] >= length)
                shard = (own[2][at].view(np.uint64) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                rows = [(s, name, _pack([x[at[order[a:b]]] for x in own] + [at[order[a:b]].astype(np.int32)])) for s, a, b in _runs(shard[order])]
                if rows:
                    yield _dealt(rows, "texts")

    return run


def _dealt(rows: list[tuple[int, int, bytes]], label: str) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["shard", "slice", label])


def _later(group: pa.Table) -> pa.Table:
    """For each slice the rows whose whole text a row of a lower id has, too."""
    parts = [_unpack(b.as_py()) for b in group.column("texts")]
    ids, th, other, size, row = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((ids, size, other, th))
    new = np.zeros(len(order), bool)
    new[0] = True
    for x in (size, other, th):
        new[1:] |= x[order][1:] != x[order][:-1]
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = np.zeros(len(order), bool)
    later[order] = ids[order] > ids[head]
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    found = [r[x].tobytes() for r, x in zip(np.split(row, cuts), np.split(later, cuts), strict=True)]
    return pa.table({"slice": group.column("slice"), "rows": pa.array(found, pa.binary())})


def _copied(batch: pa.RecordBatch) -> list[np.ndarray]:
    """For each slice of a batch the rows that are whole copies."""
    if "copies" not in batch.schema.names:
        return [np.zeros(0, np.int32)] * batch.num_rows
    return [np.frombuffer(b"".join(x.as_py() or ()), np.int32) for x in batch.column("copies")]


class _Slice:
    """One slice opened: documents but for whole copies, the halves of their segments, and the hash of each core."""

    def __init__(self, image: bytes, length: int, anchor: int, copies: np.ndarray):
        self.ids, _, self.th, size, self.data = _unpack(image)
        self.rows = np.arange(len(size), dtype=np.int32)
        if len(copies):
            stays = np.ones(len(size), bool)
            stays[copies] = False
            self.data = self.data[np.repeat(stays, size)]
            self.ids, self.th, size, self.rows = (x[stays] for x in (self.ids, self.th, size, self.rows))
        self.offsets = np.concatenate([[0], np.cumsum(size)])
        doc, *found = segments(self.data, self.offsets, length, anchor)
        own, self.first, self.last, self.place, self.width = halves(*found, length, anchor)
        self.doc = doc[own]
        at = self.offsets[self.doc] + self.place
        self.hashes = SpanHashes(self.data)
        self.key = self.hashes(at, at + self.width)
        self.anchors, self.inverse, self.count = np.unique(self.key, return_inverse=True, return_counts=True)

    def dealt(self, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Places of the anchors in order of their shard, and (shard, begin, end) in that order."""
        shard = (self.anchors % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        return order, _runs(shard[order])


def _runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1, [len(values)]]) if len(values) else np.zeros(1, np.int64)
    return [(int(values[a]), a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _anchors(shards: int, length: int, anchor: int):
    """Rows (shard, slice, keys): the different anchors of each slice, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, image, copies in zip(batch.column("slice").to_pylist(), batch.column("image"), _copied(batch), strict=True):
                own = _Slice(image.as_py(), length, anchor, copies)
                order, runs = own.dealt(shards)
                rows = [(s, name, own.anchors[order[a:b]].tobytes()) for s, a, b in runs]
                if rows:
                    yield _dealt(rows, "keys")

    return run


def _again(group: pa.Table) -> pa.Table:
    """For each slice, a bit for each of its anchors in this shard: does another slice have it, too?"""
    keys = [np.frombuffer(b.as_py(), np.uint64) for b in group.column("keys")]
    _, inverse, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    bits, at = [], 0
    for own in keys:
        bits.append(np.packbits(count[inverse[at : at + len(own)]] > 1).tobytes())
        at += len(own)
    return pa.table({"shard": group.column("shard"), "slice": group.column("slice"), "bits": pa.array(bits, pa.binary())})


def _cut(shards: int, length: int, anchor: int):
    """Rows (shard, blob) of segments to compare, and with shard below 0 the repeats known already."""

    def of(name: int, image: bytes, copies: np.ndarray, answers: dict[int, bytes]) -> Iterator[tuple[int, bytes]]:
        own = _Slice(image, length, anchor, copies)
        order, runs = own.dealt(shards)
        shared = own.count > 1
        for s, a, b in runs:
            shared[order[a:b]] |= np.unpackbits(np.frombuffer(answers[s], np.uint8), count=b - a).astype(bool)
        chosen = np.flatnonzero(shared[own.inverse])
        if not len(chosen):
            return
        doc, first, last, place, width, key = (x[chosen] for x in (own.doc, own.first, own.last, own.place, own.width, own.key))
        start, size = own.offsets[doc] + first, last - first + length
        content = own.hashes(start, start + size)
        rank = (_places(own.ids, own.th)[doc] << 32) + first
        order, head, new = _copies(key, content, rank)
        again = order[rank[order] > rank[head]]
        if len(again):
            yield -1 - int(name % shards), _pack([np.array([name]), own.rows[doc[again]], first[again].astype(np.int32), last[again].astype(np.int32)])
        # Rows alike count as one document: each of them is sent, since each needs its marks.
        kept = np.sort(order[new | (rank[order] == rank[head])])
        target = (key[kept] % np.uint64(shards)).astype(np.int64)
        kept = kept[np.argsort(target, kind="stable")]
        for s, a, b in _runs(np.sort(target)):
            part = kept[a:b]
            rows, local = np.unique(doc[part], return_inverse=True)
            yield s, _pack([
                np.full(1, name), own.ids[rows], own.th[rows], own.rows[rows], local.astype(np.int32), first[part].astype(np.int32),
                size[part].astype(np.int32), (place[part] - first[part]).astype(np.uint8), width[part].astype(np.uint8), _gather(own.data, start[part], size[part])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, image, answers, copies in zip(*(batch.column(k) for k in ("slice", "image", "answers")), _copied(batch), strict=True):
                known = {x["shard"]: x["bits"] for x in answers.as_py() or ()}
                rows = list(of(name.as_py(), image.as_py(), copies, known))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s for s, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.binary())], ["shard", "blob"])

    return run


def _copies(key: np.ndarray, content: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments ordered by content and place; for each the first of its content, and whether it is that one."""
    order = np.lexsort((rank, content, key))
    new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1])])
    return order, order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))], new


def _table(name, row, first, last) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
    return pa.table([pa.array(x.astype(k.to_pandas_dtype())) for x, k in zip((name, row, first, last), kinds, strict=True)], names=["slice", "row", "first", "last"])


def _joined(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    parts, docs = [], 0
    for blob in blobs:
        name, ids, th, rows, local, *rest = _unpack(blob)
        parts.append((np.repeat(name, len(ids)), ids, th, rows, local.astype(np.int64) + docs, *rest))
        docs += len(ids)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _perhaps(hashes: SpanHashes, begin: np.ndarray, size: np.ndarray, place: np.ndarray, chosen: np.ndarray, length: int, anchor: int):
    """Of chosen segments the runs of windows that may be elsewhere: segment, first and last window from its start.

    Windows that lie alike about their core, up to some bytes, share all bytes but these; without a second such span they are the only ones.
    """
    step = max(1, (length - anchor) // 10)
    core, count = place[chosen], size[chosen] - length + 1
    parts = []
    for near in range(0, int(core.max(initial=-1)) + 1, step):
        far = near + step - 1
        low, high = np.maximum(core - far, 0), np.minimum(core - near, count - 1)
        own = np.flatnonzero(low <= high)
        at = (begin[chosen] + core)[own]
        parts.append((own, low[own], high[own], hashes(at - near, at - far + length)))
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    own, low, high, key = (np.concatenate(x) for x in zip(*parts, strict=True))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    kept = np.flatnonzero(times[inverse] > 1)
    kept = kept[np.lexsort((low[kept], own[kept]))]
    own, low, high = own[kept], low[kept], high[kept]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (low[1:] != high[:-1] + 1)
    a = np.flatnonzero(new)
    return chosen[own[a]], low[a], high[np.append(a[1:], len(own))[: len(a)] - 1]


def repeats(blobs: list[bytes], length: int, anchor: int, **sorting) -> tuple[np.ndarray, ...]:
    """Slice, row, first and last window of all repeats in one shard."""
    name, ids, th, row, doc, first, size, place, width, data = _joined(blobs)
    first, size, place, width = (x.astype(np.int64) for x in (first, size, place, width))
    begin = np.cumsum(size) - size
    rank = (_places(ids, th)[doc] << 32) + first
    hashes = SpanHashes(data)
    key = hashes(begin + place, begin + place + width)
    content = hashes(begin, begin + size)
    order, head, new = _copies(key, content, rank)
    again = order[rank[order] > rank[head]]
    out = [(again, first[again], first[again] + size[again] - length)]
    # Cores with several different segments: what may repeat of their first copies is sorted by suffixes.
    group = np.cumsum(np.concatenate([[True], key[order][1:] != key[order][:-1]])) - 1
    several = order[new & (np.bincount(group[new], minlength=len(order))[group] > 1)]
    several, start, stop = _perhaps(hashes, begin, size, place, several, length, anchor)
    if len(several):
        # Close relatives side by side in one text; the order of segments does not matter.
        total = stop - start + length
        at = np.cumsum(total + 1) - total - 1
        text = np.ones(int((total + 1).sum()) + 1, np.uint16)
        text[-1] = 0
        text[np.repeat(at - (np.cumsum(total) - total), total) + np.arange(int(total.sum()))] = _gather(data, begin[several] + start, total).astype(np.uint16) + 2
        suffix, common = induced.suffixes(text, length, **sorting)
        interval = np.cumsum(common < length)
        segment = np.searchsorted(at, suffix, side="right") - 1
        offset = suffix - at[segment]
        whole = (offset + length <= total[segment]) & (suffix < len(text) - 1)
        interval, segment, offset = interval[whole], segment[whole], offset[whole]
        where = (rank[several] + start)[segment] + offset
        begins = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]])) if len(interval) else np.zeros(0, np.int64)
        least = np.repeat(np.minimum.reduceat(where, begins), np.diff(np.append(begins, len(where)))) if len(begins) else where
        later = where > least
        segment, offset = segment[later], offset[later]
        by = np.lexsort((offset, segment))
        segment, offset = segment[by], offset[by]
        starts = np.concatenate([[True], (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1)]) if len(by) else np.zeros(0, bool)
        a = np.flatnonzero(starts)
        b = np.append(a[1:], len(by))[: len(a)] - 1
        own = several[segment[a]]
        low, high = (first[own] + start[segment[a]] + offset[x] for x in (a, b))
        out.append((own, low, high))
        # The same for rows alike, whose segments are not first but of the same rank.
        alike = np.flatnonzero(~new & (rank[order] == rank[head]))
        by_own = np.argsort(own, kind="stable")
        left, right = (np.searchsorted(own, head[alike], side=x, sorter=by_own) for x in ("left", "right"))
        found = right - left
        at = by_own[np.repeat(left - (np.cumsum(found) - found), found) + np.arange(int(found.sum()))]
        out.append((np.repeat(order[alike], found), low[at], high[at]))
    owner, low, high = (np.concatenate(x) for x in zip(*out, strict=True))
    return name[doc[owner]], row[doc[owner]], low, high


def sliced(docs: DataFrame) -> DataFrame:
    """``docs`` as a table of slices, bucketed by slice in the shared folder."""
    spark = docs.sparkSession
    keyed = bounded(docs).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"),
        F.xxhash64(F.lit(7), "text").alias("th"), F.xxhash64(F.lit(8), "text").alias("other"), "text")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{scratch_database(spark, 'slices')}.slices"
    rows = keyed.mapInArrow(_packed_slices, SLICES).repartition(buckets, "slice")
    rows.write.bucketBy(buckets, "slice").option("compression", "uncompressed").saveAsTable(name)
    return spark.table(name)


def without_copies(parts: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """``parts`` with the rows of each slice that are copies of a whole text; only ids and hashes are dealt out for it."""
    shards = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = parts.select("slice", "heads").mapInArrow(_heads(shards, length), "shard long, slice long, texts binary")
    copies = texts.groupBy("shard").applyInArrow(_later, "slice long, rows binary").where(F.length("rows") > 0)
    found = stored(copies.groupBy("slice").agg(F.collect_list("rows").alias("copies")), "copies")
    return parts.drop("heads").join(found.hint("merge"), "slice", "left")


def marks(parts: DataFrame, *, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """Runs of windows (slice, row, first and last start) that are seen earlier."""
    shards = SHARDS_PER_PARTITION * int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = parts.mapInArrow(_anchors(shards, length, anchor), "shard long, slice long, keys binary")
    answers = asked.groupBy("shard").applyInArrow(_again, "shard long, slice long, bits binary").groupBy("slice").agg(
        F.collect_list(F.struct("shard", "bits")).alias("answers"))
    known = parts.join(answers.hint("merge"), "slice", "left")
    cut = known.mapInArrow(_cut(shards, length, anchor), "shard long, blob binary")

    def solve(group: pa.Table) -> pa.Table:
        blobs = [b.as_py() for b in group.column("blob")]
        if group.column("shard")[0].as_py() >= 0:
            return _table(*repeats(blobs, length, anchor))
        # Repeats that a slice knew by itself.
        parts = [_unpack(b) for b in blobs]
        return _table(np.concatenate([np.repeat(n, len(d)) for n, d, _, _ in parts]), *(np.concatenate([p[k] for p in parts]) for k in (1, 2, 3)))

    return cut.groupBy("shard").applyInArrow(solve, MARKS)


def dedup(docs: DataFrame, *, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes that stay, of each row."""
    parts = without_copies(sliced(docs), length=length)
    found = marks(parts, length=length, anchor=anchor).groupBy("slice").agg(F.collect_list(F.struct("row", "first", "last")).alias("found"))
    joined = parts.join(found.hint("merge"), "slice", "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image, found, copies in zip(batch.column("image"), batch.column("found"), _copied(batch), strict=True):
                ids, known, th, size, data = _unpack(image.as_py())
                offsets = np.concatenate([[0], np.cumsum(size)])
                change = np.zeros(len(data) + 1, np.int32)
                if found.is_valid:
                    row, low, high = (found.values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                    np.add.at(change, offsets[row] + low, 1)
                    np.add.at(change, offsets[row] + high + length, -1)
                change[offsets[copies]] += 1
                change[offsets[copies + 1]] -= 1
                gone = np.cumsum(change[:-1]) > 0
                _, _, owner = spans(gone, offsets)
                before = np.concatenate([[0], np.cumsum(gone)])[offsets]
                rest, cut = data[~gone].tobytes(), offsets - before
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64(), mask=known == 0), pa.array(size), pa.array(np.diff(before).astype(np.int64)),
                    pa.array(np.bincount(owner, minlength=len(ids))),
                    pa.array([rest[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], pa.binary()),
                ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(remove, RESULT)


def digests(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
