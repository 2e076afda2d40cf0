"""Operator 11 against numpy's eigenvectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewpulse.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=16):
    """(by row index: deviation and whitened values), explained, n; components by numpy."""
    own = [(i, v) for i, (_, v, *_) in enumerate(rows) if v and None not in v and np.isfinite(np.float64(np.float32(v))).all()]
    x = np.array([np.floor(64 * np.float32(v).astype(float)).astype(np.int64) + 1_000_000 for _, v in own])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (n * fit - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    real = e > 1e-10 * e[0]
    e, u = e[real], u[:, real]
    return [i for i, _ in own], ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ u / np.sqrt(e), e / (np.square(c).sum() / n), n


def test_pairs_of_known_matrices():
    rng = np.random.default_rng(0)
    for d, k, e in [(64, 16, None), (200, 16, None), (5, 16, None), (1, 16, [3.0]), (40, 16, np.repeat([3.0, 2, 1, 0.5], 10)), (12, 4, [5.0, 1] + [0.0] * 10)]:
        e = np.sort(rng.exponential(size=d))[::-1] if e is None else np.array(e)
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        a = (q * e) @ q.T
        values, vectors, residuals = whitening.leading_pairs(lambda u: a @ u, d, k, e.sum())  # noqa: B023
        assert np.allclose(values, e[: min(k, d)], atol=1e-13 * e[0], rtol=0)
        assert residuals.max() <= 2e-12 * e[0]
        assert np.abs(vectors.T @ vectors - np.eye(min(k, d))).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    a = (q * np.linspace(-3, 5, 30)) @ q.T
    off = np.linalg.qr(rng.standard_normal((30, 2)))[0]
    p = np.eye(30) - off @ off.T
    values, r = np.array([0.31, 2.2]), rng.standard_normal((30, 2))
    t = whitening.minres_corrections(lambda v: a @ v, values, r, off, steps=60, tolerance=1e-12)
    for i in range(2):
        assert np.allclose(p @ (a - values[i] * np.eye(30)) @ p @ t[:, i], -p @ r[:, i], atol=1e-9)
    assert np.abs(off.T @ t).max() < 1e-10


@pytest.mark.parametrize("d", [3, 24])
def test_equals_numpy(spark, d):
    rng = np.random.default_rng(d)
    base = (rng.standard_normal((300, d)) * np.linspace(2, 0.3, d)).astype(np.float32)
    rows = [(i, [float(v) for v in base[i % 120]], i) for i in range(300)]  # equal vectors count once
    rows += [(1000, None, 0), (1001, [], 0), (1002, [None] * d, 0), (1003, [float("nan")] * d, 0), (1004, [float("inf")] * d, 0), (None, [0.5] * d, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("clash")).withColumn("id", F.lit("clash")).repartition(5)
    got = whitening.whiten(df).collect()
    at, deviation, z, explained, n = brute(rows)
    want = {rows[i][0]: (deviation[j], z[j]) for j, i in enumerate(at)}
    k = z.shape[1]
    assert len(got) == len(at) * k and {r.n for r in got} == {n}
    mine = {(r.vec_id, r.component): r for r in got}
    sign = np.sign([sum(mine[i, c + 1].whitened * want[i][1][c] for i in want) for c in range(k)])
    for (i, c), r in mine.items():
        assert r.deviation == want[i][0]
        assert abs(r.whitened * sign[c - 1] - want[i][1][c - 1]) < 1e-9
        assert abs(r.explained - explained[c - 1]) < 1e-9 * explained[c - 1] and r.identity_error < 1e-9


def test_awkward_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert whitening.whiten(make([])).collect() == []
    assert whitening.whiten(make([(1, None, 0)])).collect() == []
    assert whitening.whiten(make([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect() == []  # one distinct vector has no variance
    line = whitening.whiten(make([(i, [float(i), 2.0 * i], 0) for i in range(5)])).collect()  # rank one
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12
    other = whitening.whiten(make([(i, [float(i), float(i * i)], 0) for i in range(5)] + [(9, [1.0], 0)])).collect()
    assert {r.vec_id for r in other} == set(range(5))  # the rarer length takes no part
    far = whitening.whiten(make([(1, [2.0**40, 1.0], 0), (2, [-(2.0**40), 3.0], 0), (3, [3e38, 1.0], 0), (4, [2.0**54, 1.0], 0)])).collect()
    assert {r.vec_id for r in far} == {1, 2, 4} and [r.deviation for r in far if r.vec_id == 4] == [None] * len({r.component for r in far})


def test_registered_query(spark):
    got = queries.op11_whitening(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = got.collect()
    source = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    at, deviation, z, explained, n = brute(source)
    assert len(rows) == z.size and max(r.identity_error for r in rows) < 1e-9
    assert {(r.vec_id, r.deviation) for r in rows} == {(source[i][0], int(v)) for i, v in zip(at, deviation)}
    assert np.allclose(sorted(abs(r.whitened) for r in rows), np.sort(np.abs(z).ravel()), atol=1e-8)
