"""Incremental eigendecomposition against a plain one of the whole covariance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from sunledger.llm import registry, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = x - sums / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], components[:, ::-1]


def check(rows, vectors):
    deviation, centred, values, components = plain(vectors)
    k = min(8, len(values), sum(values > 1e-9 * values[0]))
    assert len(rows) == k * len(vectors)
    want = centred @ components[:, :k] / np.sqrt(values[:k])
    got = np.zeros_like(want)
    for r in rows:
        i, c = r["vec_id"], r["component"] - 1
        got[i, c] = r["whitened"]
        assert (r["n"], int(r["deviation"])) == (len(vectors), deviation[i])
        assert math.isclose(r["explained"], values[c] / values.sum(), rel_tol=1e-9)
        assert r["identity_error"] < 1e-9
    for c in range(k):
        sign = np.sign(got[:, c] @ want[:, c])
        assert np.allclose(got[:, c], sign * want[:, c], atol=1e-7)


def test_query(spark):
    vectors = [r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()]
    check(registry.QUERIES["op12_whitening"](spark, SF).collect(), vectors)


@pytest.mark.parametrize("parts", [1, 40])
def test_copies_and_levels(spark, parts):
    """A third of all rows is one vector; many tasks are combined in more than one level."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(300, 5)) * [9, 3, 3, 1, 0.2]
    vectors[::3] = vectors[0]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(vectors)]
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect(), vectors)


def test_update():
    """Deflation: repeated eigenvalues, directions without change, zero vectors."""
    rng = np.random.default_rng(3)
    rows = np.vstack([np.eye(6), np.eye(6), np.zeros((3, 6)), rng.normal(size=(40, 6)), 1e6 * np.eye(6)[:2], 1e-6 * np.eye(6)])
    one, left, right = whitening.Spectrum(6), whitening.Spectrum(6), whitening.Spectrum(6)
    for i, x in enumerate(rows):
        one.add(x, 1 + i % 3)
        (left if i < 20 else right).add(x, 1 + i % 3)
    left.join(right)
    weights = 1 + np.arange(len(rows)) % 3
    centred = rows - weights @ rows / weights.sum()
    scatter = (centred * weights[:, None]).T @ centred
    for s in (one, left):
        assert s.n == weights.sum()
        assert np.allclose(s.vectors @ np.diag(s.values) @ s.vectors.T, scatter, atol=1e-13 * np.abs(scatter).max())
        assert np.allclose(s.vectors.T @ s.vectors, np.eye(6), atol=1e-13)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.1, -3.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [None, 1.0]), (6, [2.0]), (7, [])]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("vector", F.lit("x")).withColumn("n", F.lit(1)).withColumn("component", F.lit("c"))
    got = whitening.whiten(table).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in got) == sorted((str(i), c) for i in (1, 1, None, 6, 7) for c in (1, 2))
    assert {r["n"] for r in got} == {5} and max(r["identity_error"] for r in got) < 1e-9
    assert whitening.whiten(table.limit(0)).collect() == []
    assert whitening.whiten(table.where("vec_id = 1")).collect() == []  # no variance
    assert whitening.whiten(table.where("vec_id = 7")).collect() == []  # no entries
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], SCHEMA)).collect()
    assert {r["component"] for r in line} == {1} and math.isclose(line[0]["explained"], 1)
    far = whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [-1e30]), (3, [0.0])], SCHEMA)).collect()
    assert len(far) == 3 and max(r["identity_error"] for r in far) < 1e-6


def test_exact_deviation():
    model = whitening.Whitening(3, [3 << 50, 5], np.ones(2), np.eye(2), 1.0)
    x = np.array([[1 << 50, 2], [(1 << 50) + (1 << 40), 1]])
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, model.sums, strict=True)) for row in x]
    assert [int(v.as_py()) for v in model.deviation(x)] == want
