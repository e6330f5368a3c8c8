"""Embedding whitening: exact cross-products from bit planes, centred as integers before the eigenvectors.

Every entry ``c`` becomes the whole number ``x = floor(SCALE * c) + OFFSET``. A block of rows takes
the least ``x`` of each dimension off, packs every bit of what is left across its rows into 64-bit words,
and counts the common bits of each pair of such planes; the counts, weighted by powers of two, are
the sums of products, and the least values are put back by algebra. All of it is whole numbers, so partial
results of blocks and tasks add up to the same sums in any order. A task sends a row for each pair of
dimensions, whatever its number of rows; the driver holds that triangle, which grows with
the dimensions only, and takes the eigenvectors of ``(n * products - sums x sums) / n ** 2``.

Nulls: a vector that is null, has a null or an entry that is not finite, or has another length than most
(of equally frequent lengths the longest counts) is left out; a null ``vec_id`` is kept. Empty table, or
no spread at all: no rows. Repeated rows count each. Entries beyond 2 ** 62 / SCALE in size are taken as that.
Components whose eigenvalue is nil but for rounding have no scale and are not returned. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm.common import bounded

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows of a block whose bit planes are counted at once.
BLOCK_ROWS = 8192
_LIMBS, _LIMB = 5, 32
_FARTHEST = float(1 << 62)
_SUMS = "i int, j int, " + ", ".join(f"l{k} long" for k in range(_LIMBS))


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found: rows, sums of ``x``, and the components as columns, most variance first."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def _whole(batch: pa.RecordBatch, width: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows of ``batch`` that hold ``width`` finite entries, and their ``x``."""
    column = batch.column("embedding")
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    batch = batch.filter(pa.array(lengths == width))
    column = batch.column("embedding")
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), width)
    fine = np.isfinite(values).all(axis=1)
    x = np.clip(np.floor(values[fine] * SCALE), -_FARTHEST, _FARTHEST).astype(np.int64) + OFFSET
    return batch.filter(pa.array(fine)), x


def planes_of(y: np.ndarray) -> np.ndarray:
    """Bit planes of numbers that are not negative: (dimensions, bits, words), rows packed into words."""
    rows, width = y.shape
    bits = max(int(y.max(initial=0)).bit_length(), 1)
    packed = np.zeros((width, bits, -(-rows // 64) * 8), np.uint8)
    turned = np.ascontiguousarray(y.T).astype(np.uint64)
    for b in range(bits):
        found = np.packbits((turned >> np.uint64(b)).astype(np.uint8) & np.uint8(1), axis=1)
        packed[:, b, : found.shape[1]] = found
    return packed.view(np.uint64)


def scatter(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums of each dimension and, for j <= i, of the products of dimensions i and j."""
    rows, width = x.shape
    least = x.min(axis=0)
    planes = planes_of(x - least)
    bits, words = planes.shape[1:]
    small = 2 * bits + rows.bit_length() < 62
    kind = np.int64 if small else object
    weight = np.array([1 << b for b in range(bits)], kind)
    low = [int(v) for v in least]
    above = [int(v) for v in np.bitwise_count(planes).sum(axis=2, dtype=np.int64).astype(kind) @ weight]
    products = []
    for i in range(width):
        others = planes[: i + 1].reshape(-1, words)
        counts = np.stack([np.bitwise_count(others & planes[i, b]).sum(axis=1, dtype=np.int64) for b in range(bits)])
        own = (weight @ counts.astype(kind)).reshape(i + 1, bits) @ weight
        products.append([int(v) + low[i] * above[j] + low[j] * above[i] + rows * low[i] * low[j] for j, v in enumerate(own)])
    return [v + rows * m for v, m in zip(above, low, strict=True)], products


def _limbs(value: int) -> list[int]:
    """Parts of 32 bits, the last one signed: sums of them as longs stay exact over billions of tasks."""
    out = []
    for _ in range(_LIMBS - 1):
        out.append(value & ((1 << _LIMB) - 1))
        value >>= _LIMB
    return [*out, value]


def _sums_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    n, sums, products = 0, [0] * width, [[0] * (i + 1) for i in range(width)]
    for batch in batches:
        x = _whole(batch, width)[1]
        for a in range(0, len(x), BLOCK_ROWS):
            part, cross = scatter(x[a : a + BLOCK_ROWS])
            n += len(x[a : a + BLOCK_ROWS])
            sums = [p + q for p, q in zip(sums, part, strict=True)]
            products = [[p + q for p, q in zip(own, more, strict=True)] for own, more in zip(products, cross, strict=True)]
    if not n:
        return
    rows = [(-1, -1, n), *((i, -1, v) for i, v in enumerate(sums)), *((i, j, v) for i, own in enumerate(products) for j, v in enumerate(own))]
    parts = zip(*(_limbs(v) for _, _, v in rows), strict=True)
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], pa.int32()) for k in (0, 1)] + [pa.array(part, pa.int64()) for part in parts],
        ["i", "j", *(f"l{k}" for k in range(_LIMBS))])


def _rows(vectors: DataFrame) -> DataFrame:
    return bounded(vectors).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of all vectors of ``vectors`` (vec_id, embedding); None if there is no spread."""
    rows = _rows(vectors)
    fine = F.expr("embedding IS NOT NULL AND forall(embedding, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))")
    common = rows.where(fine).groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = common["width"] if common else 0
    if not width:
        return None
    found = rows.mapInArrow(lambda batches: _sums_of(batches, width), _SUMS).groupBy("i", "j").agg(
        *(F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS))).collect()
    exact = {(r["i"], r["j"]): sum(r[f"l{k}"] << (_LIMB * k) for k in range(_LIMBS)) for r in found}
    n, sums = exact[-1, -1], tuple(exact[i, -1] for i in range(width))
    v = np.empty((width, width))
    for i in range(width):
        for j in range(i + 1):
            v[i, j] = v[j, i] = (n * exact[i, j] - sums[i] * sums[j]) / (n * n)
    eigenvalues, vectors_ = np.linalg.eigh(v)
    order = np.argsort(-eigenvalues, kind="stable")[:components]
    order = order[eigenvalues[order] > max(eigenvalues[-1], 0.0) * width * np.finfo(float).eps]
    if not len(order):
        return None
    return Whitening(n, sums, vectors_[:, order], eigenvalues[order], float(np.trace(v)))


def _centred(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int]]:
    """``n * x - sums`` divided by ``n``, and the exact sum of its squares before the division for each row."""
    sums = np.array(model.sums, object)
    far = max((abs(model.n * int(v) - s) for edge in (x.min(axis=0), x.max(axis=0)) for v, s in zip(edge, model.sums, strict=True)), default=0)
    reach = model.n * int(np.abs(x).max(initial=0))
    if x.shape[1] * far * far < 1 << 62 and reach < 1 << 62:
        scaled = x * np.int64(model.n) - sums.astype(np.int64)
        return scaled / model.n, (scaled * scaled).sum(axis=1).tolist()
    scaled = x.astype(object) * model.n - sums
    return np.array([[v / model.n for v in row] for row in scaled]).reshape(x.shape), [sum(v * v for v in row) for row in scaled]


def _project(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int]]:
    centred, squares = _centred(x, model)
    return centred @ model.vectors / np.sqrt(model.eigenvalues), squares


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, measured over all rows."""
    width, k = model.vectors.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, cross = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            x = _whole(batch, width)[1]
            if len(x):
                z = _project(x, model)[0]
                total += z.sum(axis=0)
                cross += z.T @ z
        i, j = np.tril_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, np.arange(k)]), pa.int32()), pa.array(np.concatenate([j, np.full(k, -1)]), pa.int32()),
             pa.array(np.concatenate([cross[i, j], total]))], ["i", "j", "v"])

    found = _rows(vectors).mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    value = {(r["i"], r["j"]): r["v"] / model.n for r in found}
    return max(abs(v - value[i, -1] * value[j, -1] - (i == j)) for (i, j), v in value.items() if j >= 0)


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, whitened (array of double, a cell for each component) and deviation (decimal) of each row."""
    width = model.vectors.shape[0]
    schema = pa.schema([("whitened", pa.list_(pa.float64())), ("deviation", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = _whole(batch, width)
            if len(x):
                z, squares = _project(x, model)
                offsets = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
                whitened = pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([kept.column("vec_id"), whitened, pa.array([str(v) for v in squares])], ["vec_id", *schema.names])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return _rows(vectors).mapInArrow(run, f"vec_id {kind}, whitened array<double>, deviation string")


def run(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is null where it is beyond a long, which needs some 70 million rows of unit vectors;
    ``deviation_digits`` is always its decimal digits. ``eigenvalue`` belongs to the component.
    """
    model = fit(vectors, components)
    spark = vectors.sparkSession
    if model is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
                                         "identity_error double, deviation_digits string, eigenvalue double")
    error = identity_error(vectors, model)
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues))
    values = F.array(*(F.lit(float(e)) for e in model.eigenvalues))
    cells = transform(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return cells.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened", shares[F.col("k")].alias("explained"),
        F.lit(float(error)).alias("identity_error"), F.col("deviation").alias("deviation_digits"), values[F.col("k")].alias("eigenvalue"))
