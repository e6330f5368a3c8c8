"""Embedding whitening against numpy on whole numbers of Python."""

from __future__ import annotations

import math

import numpy as np
import pytest

from lethe.llm import whitening
from lethe.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def cleaned(rows, width):
    return [(k, v) for k, v, _ in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]


def expected(rows, width, components=32):
    kept = cleaned(rows, width)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in kept], object)
    n, sums = len(x), x.sum(axis=0)
    scaled = x * n - sums
    v = np.array([[int(c) / n**3 for c in row] for row in scaled.T @ scaled])
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    z = np.array([[int(c) / n for c in row] for row in scaled]) @ vectors[:, order] / np.sqrt(values[order])
    return n, [int((row * row).sum()) for row in scaled], z, values[order] / np.trace(v), [k for k, _ in kept]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(9, 9))
    found = [(k, [float(c) for c in rng.normal(size=9) @ mix], 0) for k in range(400)]
    found += found[:20] + [(None, found[3][1], 1)]
    found += [(900, None, 0), (901, [1.0] * 8 + [None], 0), (902, [math.nan] * 9, 0), (903, [math.inf] + [0.0] * 8, 0), (904, [], 0), (905, [1.0], 0)]
    return found


@pytest.mark.parametrize("x", [
    np.random.default_rng(1).integers(-60, 60, (1000, 7)), np.random.default_rng(2).integers(-(2**40), 2**40, (130, 3)),
    np.array([[-(2**62), 2**62], [5, 1]]), np.zeros((3, 2), np.int64)])
def test_scatter_is_exact(x):
    sums, products = whitening.scatter(x.astype(np.int64))
    exact = x.astype(object)
    full = exact.T @ exact
    assert sums == [int(v) for v in exact.sum(axis=0)]
    assert all(products[i][j] == full[i, j] for i in range(x.shape[1]) for j in range(i + 1))


@pytest.mark.parametrize("value", [0, 1, -1, 2**130 + 7, -(2**150)])
def test_limbs(value):
    assert sum(part << (32 * k) for k, part in enumerate(whitening._limbs(value))) == value


def test_run(spark, rows):
    found = whitening.run(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    n, squares, z, shares, ids = expected(rows, 9)
    assert len(found) == n * 9 and {r["n"] for r in found} == {n}
    assert sorted(r["deviation"] for r in found if r["component"] == 1) == sorted(squares)
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-9
    share = {r["component"]: r["explained"] for r in found}
    assert [share[k + 1] for k in range(9)] == pytest.approx(shares)
    for k in range(9):
        own = {r["vec_id"]: r["whitened"] for r in found if r["component"] == k + 1}
        there = dict(zip(ids, z[:, k], strict=True))
        sign = math.copysign(1, own[0] * there[0])
        assert all(own[i] * sign == pytest.approx(there[i], abs=1e-9) for i in there)


def test_far_entries(spark):
    """Values whose squares leave 64 bits stay exact; those whose deviation does are null as a long."""
    rows = [(k, [1e9 * ((k * 7) % 11), float(k), 3e38 if k == 2 else 0.0], 0) for k in range(20)]
    found = whitening.run(spark.createDataFrame(rows, SCHEMA)).collect()
    x = [[min(math.floor(64 * float(np.float32(c))), 2**62) + 1000000 for c in v] for _, v, _ in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = {k: sum((20 * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for k, row in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation_digits"]) for r in found} == exact
    assert all(r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 2**63 else None) for r in found)


def test_without_spread(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, None, 0)], [(k, [1.0, 2.0], 0) for k in range(5)]):
        found = whitening.run(spark.createDataFrame(rows, SCHEMA))
        assert found.collect() == [] and found.columns[:4] == ["vec_id", "component", "n", "deviation"]
    # One dimension without spread has no component.
    assert {r["component"] for r in whitening.run(spark.createDataFrame([(k, [1.0, float(k)], 0) for k in range(5)], SCHEMA)).collect()} == {1}


def test_query_and_clashing_columns(spark, rows, tmp_path):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS component", "2 AS n", "3 AS whitened")
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = QUERIES["op11_whitening"](spark, str(tmp_path))
    assert found.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == expected(rows, 9)[0] * 9
