"""Token ids kept as wavelet matrices: one compressed block of a shard answers access, count and lookup.

``write`` sorts documents by ``doc_id``, encodes each whole text, adds the end id
and packs ids into blocks. A block is one self-contained binary file image (a
cell of a Parquet file, so that Spark's commit protocol covers lost executors):
document ids and lengths, a bit-plane for each bit of an id, and a rank directory.
``read`` opens such files again; ``access``, ``counts`` and ``occurrences`` answer from their planes, without undoing them.

Nulls: a null text is empty, so its ids are the end id alone; a null ``doc_id`` sorts first.
Repeated rows each keep their own entry, ordered by a hash of the text, then by text, among
equal ids; many rows of one id, or alike, are dealt over several shards. An empty
table gives no file rows. Other columns are not read. A document longer than a
block makes its block longer.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lethe.llm.common import bounded, slices
from lethe.llm.tokens import encoder

#: Ids after which a block is closed at the next end of a document.
BLOCK_IDS = 1 << 20
END_ID = 0
_MAGIC = b"LWM1"
_RANK_BITS = 512
FILE_SCHEMA = "shard int, block int, start_in_shard long, n_ids long, n_docs long, image binary"


class WaveletMatrix:
    """Bit-planes of a sequence of ids, from the highest bit down; at each level zeros go before ones."""

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.levels, self._planes, self._ranks = n, len(planes), planes, ranks
        self._zeros = [n - int(r[-1]) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.asarray(ids)
        top = int(ids.max()) if len(ids) else 0
        now = ids.astype(np.uint16 if top < 1 << 16 else np.uint32)
        planes, ranks = [], []
        for level in range(max(top.bit_length(), 1) - 1, -1, -1):
            bit = (now >> level) & 1 > 0
            planes.append(np.packbits(bit, bitorder="little"))
            padded = np.zeros(-(-len(bit) // _RANK_BITS) * _RANK_BITS, bool)
            padded[: len(bit)] = bit
            ones = padded.reshape(-1, _RANK_BITS).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)]))
            now = np.concatenate([now[~bit], now[bit]])
        return cls(len(ids), planes, ranks)

    def _bit(self, level: int, i: int) -> int:
        return int(self._planes[level][i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before position ``i``: the directory, then the bytes of one directory step."""
        step = i // _RANK_BITS
        begin = step * (_RANK_BITS // 8)
        tail = self._planes[level][begin : (i >> 3) + 1]
        found = int(self._ranks[level][step])
        if i & 7:
            return found + int(np.bitwise_count(tail[:-1]).sum()) + (int(tail[-1]) & ((1 << (i & 7)) - 1)).bit_count()
        return found + int(np.bitwise_count(tail[: (i >> 3) - begin]).sum())

    def _zeros_before(self, level: int, i: int) -> int:
        return i - self._ones(level, i)

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            bit = self._bit(level, i)
            value = value << 1 | bit
            i = self._zeros[level] + self._ones(level, i) if bit else self._zeros_before(level, i)
        return value

    def _interval(self, token: int, i: int) -> tuple[int, int]:
        """The places on the last level of the occurrences of ``token`` before ``i``."""
        low = 0
        if token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            if token >> (self.levels - 1 - level) & 1:
                low, i = (self._zeros[level] + self._ones(level, x) for x in (low, i))
            else:
                low, i = (self._zeros_before(level, x) for x in (low, i))
        return low, i

    def count(self, token: int, end: int | None = None) -> int:
        """How often ``token`` occurs before ``end``."""
        low, high = self._interval(token, self.n if end is None else end)
        return high - low

    def _place(self, level: int, bit: int, k: int) -> int:
        """The position of the k-th (from 0) cell that is ``bit``."""
        low, high = 0, self.n
        while low < high:  # least position with more than k such cells up to it
            middle = (low + high) // 2
            seen = self._ones(level, middle + 1)
            low, high = (low, middle) if (seen if bit else middle + 1 - seen) > k else (middle + 1, high)
        return low

    def select(self, token: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence of ``token``; -1 if there are fewer."""
        low, high = self._interval(token, self.n)
        if not 0 <= k < high - low:
            return -1
        i = low + k
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            i = self._place(level, bit, i - self._zeros[level] if bit else i)
        return i

    def _places(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """``_place`` of several k at once."""
        if len(k) * _RANK_BITS > self.n:
            return np.flatnonzero(np.unpackbits(self._planes[level], count=self.n, bitorder="little") == bit)[k]
        ones = self._ranks[level].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * _RANK_BITS - ones
        step = np.searchsorted(before, k, side="right") - 1
        steps = np.pad(self._planes[level], (0, -len(self._planes[level]) % (_RANK_BITS // 8))).reshape(-1, _RANK_BITS // 8)
        seen = np.cumsum(np.unpackbits(steps[step], axis=1, bitorder="little") == bit, axis=1)
        return step * _RANK_BITS + np.argmax(seen > (k - before[step])[:, None], axis=1)

    def positions(self, token: int) -> np.ndarray:
        """The positions of all occurrences of ``token``, ascending."""
        low, high = self._interval(token, self.n)
        i = np.arange(low, high)
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            i = self._places(level, bit, i - self._zeros[level] if bit else i)
        return i

    def all(self) -> np.ndarray:
        """Every id, in order: the planes are undone from the last to the first."""
        values = np.zeros(self.n, np.uint32)
        for level in range(self.levels - 1, -1, -1):
            bit = np.unpackbits(self._planes[level], count=self.n, bitorder="little").view(bool)
            before = np.empty(self.n, np.uint32)
            zeros = self._zeros[level]
            before[~bit] = values[:zeros]
            before[bit] = values[zeros:] | np.uint32(1 << (self.levels - 1 - level))
            values = before
        return values


def _packed(array: np.ndarray) -> bytes:
    raw = array.tobytes()
    body = pa.compress(raw, codec="zstd", asbytes=True)
    return struct.pack("<QQ", len(raw), len(body)) + body


def to_image(doc_ids: np.ndarray, known: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One block as bytes; ``known`` is false where a document has no id."""
    matrix = WaveletMatrix.build(ids)
    head = _MAGIC + struct.pack("<QQI", matrix.n, len(doc_ids), matrix.levels)
    parts = [doc_ids.astype("<i8"), known.astype("u1"), lengths.astype("<i8")]
    for plane, rank in zip(matrix._planes, matrix._ranks, strict=True):
        parts += [plane, rank.astype("<u4")]
    return head + b"".join(map(_packed, parts))


def from_image(image: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, WaveletMatrix]:
    """Document ids, whether they are known, lengths and the matrix of a block."""
    if image[:4] != _MAGIC:
        raise ValueError("not a wavelet matrix file")
    n, _, levels = struct.unpack_from("<QQI", image, 4)
    at, parts = 4 + 20, []
    for _ in range(3 + 2 * levels):
        size, body = struct.unpack_from("<QQ", image, at)
        at += 16
        parts.append(pa.decompress(image[at : at + body], size, codec="zstd", asbytes=True))
        at += body
    doc_ids, lengths = (np.frombuffer(parts[k], "<i8") for k in (0, 2))
    planes = [np.frombuffer(p, np.uint8) for p in parts[3::2]]
    ranks = [np.frombuffer(p, "<u4") for p in parts[4::2]]
    return doc_ids, np.frombuffer(parts[1], "u1").astype(bool), lengths, WaveletMatrix(n, planes, ranks)


def _blocks(vocabulary: str, end_id: int, block_ids: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode = encoder(vocabulary).encode
        docs, known, lengths, ids = [], [], [], []
        block = start = held = 0

        def closed() -> pa.RecordBatch:
            nonlocal block, start, held
            image = to_image(*map(np.concatenate, (docs, known, lengths, ids)))
            row = [[shard], [block], [start], [held], [sum(map(len, docs))], [image]]
            block, start, held = block + 1, start + held, 0
            for part in (docs, known, lengths, ids):
                part.clear()
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ("shard", "block", "start_in_shard", "n_ids", "n_docs", "image")
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names)

        for batch in slices(batches):
            found, counts = encode(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            lengths.append(counts + 1)
            ids.append(np.insert(found, ends, end_id))
            docs.append(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))
            known.append(batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False))
            held += len(ids[-1])
            if held >= block_ids:
                yield closed()
        if held:
            yield closed()

    return pack


def write(docs: DataFrame, path: str, vocabulary: str, *, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` (doc_id, text) and write shards, ranges of ascending ``doc_id``, to ``path``."""
    # The partition of a range sort is its place in the order, so shard numbers ascend with doc_id.
    # Rows of one id are told by text, rows alike by a number: these may change places, as their ids are the same.
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("th"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "th", "row").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "th", "text")
    bounded(ordered.select("doc_id", "text")).mapInArrow(_blocks(vocabulary, end_id, block_ids), FILE_SCHEMA).write.option(
        "compression", "uncompressed").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row for each block of the files at ``path``, with ``start``: the ids in all blocks before it."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # One row for each shard: as many as tasks that wrote.
    sums = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return files.join(F.broadcast(starts), "shard").withColumn("start", F.col("before") + F.col("start_in_shard")).drop("before")


def digests(blocks: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (end id included)."""
    import zlib

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids, known, lengths, matrix = from_image(batch.column("image")[k].as_py())
                ids = matrix.all().astype("<u4")
                ends = np.cumsum(lengths)
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * (e - m) : 4 * e]) for e, m in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64(), mask=~known),
                    pa.array(batch.column("start")[k].as_py() + ends - lengths),
                    pa.array(lengths), pa.array(crc, pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return bounded(blocks).select("start", "image").mapInArrow(
        check, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _answers(blocks: DataFrame, answer, schema: str) -> DataFrame:
    """Rows that ``answer`` gives for each block: a list of columns from its start, document ids, lengths and matrix."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, image in zip(batch.column("start").to_pylist(), batch.column("image"), strict=True):
                for columns in answer(start, *from_image(image.as_py())):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) if isinstance(c, np.ndarray) else c for c in columns], names)

    return bounded(blocks).select("start", "image").mapInArrow(run, schema)


def access(blocks: DataFrame, positions: list[int]) -> DataFrame:
    """position and token of a given list of positions in the sequence of all ids; those beyond its end have no row."""
    wanted = np.unique(np.array(positions, np.int64))

    def answer(start, doc_ids, known, lengths, matrix):
        own = wanted[(wanted >= start) & (wanted < start + matrix.n)]
        yield own, np.array([matrix.access(i) for i in (own - start).tolist()], np.int64)

    return _answers(blocks, answer, "position long, token long")


def counts(blocks: DataFrame, tokens: list[int]) -> DataFrame:
    """token and n, its occurrences in all blocks, for each of a given list of tokens that occurs."""
    wanted = np.unique(np.array(tokens, np.int64))

    def answer(start, doc_ids, known, lengths, matrix):
        yield wanted, np.array([matrix.count(t) for t in wanted.tolist()], np.int64)

    return _answers(blocks, answer, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n > 0")


def occurrences(blocks: DataFrame, tokens: list[int]) -> DataFrame:
    """A row for each occurrence of the given tokens: token, position in all ids, doc_id and place in the document."""
    wanted = np.unique(np.array(tokens, np.int64))

    def answer(start, doc_ids, known, lengths, matrix):
        ends = np.cumsum(lengths)
        for token in wanted.tolist():
            found = matrix.positions(token)
            doc = np.searchsorted(ends, found, side="right")
            yield (np.full(len(found), token, np.int64), start + found,
                   pa.array(doc_ids[doc], pa.int64(), mask=~known[doc]), found - (ends - lengths)[doc])

    return _answers(blocks, answer, "token long, position long, doc_id long, place long")
