"""Whitening against numpy's eigenvectors of the covariance."""

import math

import numpy as np
import pytest

from pitchmetrics.llm import queries, whitening


def _plain(vectors, components=16, scale=64):
    """For vectors of one length: x, fit list, eigenvalues, vectors, trace."""
    x = np.floor(scale * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    values, vecs = np.linalg.eigh(c.T @ c / n)
    return x, n, s, values[::-1][:components], vecs[:, ::-1][:, :components], values.sum()


def _check(rows, given, components=16):
    """rows: the result for the vectors ``given`` {key: vector} of one length."""
    keys = list(given)
    x, n, s, values, vecs, trace = _plain([given[k] for k in keys], components)
    there = values > 1e-12 * max(values[0], 1e-300)
    k = int(there.sum())
    assert len(rows) == len(keys) * k
    by = {(r.vec_id, r.component): r for r in rows}
    white = np.array([[by[key, j + 1].whitened for j in range(k)] for key in keys])
    z = ((n * x - s) / n) @ (vecs[:, :k] / np.sqrt(values[:k]))
    sign = np.sign((white * z).sum(0))
    assert np.abs(white - z * sign).max() < 1e-7
    for i, key in enumerate(keys):
        for j in range(k):
            r = by[key, j + 1]
            assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s, strict=True))
            assert r.explained == pytest.approx(values[j] / trace, rel=1e-9) and r.identity_error < 1e-9


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    given = {k: v for k, v in given.items() if v is not None and len(v) and all(a is not None and math.isfinite(a) for a in v)}
    _check(queries.op11_embedding_whitening(spark, sf).collect(), given)


def test_steep_and_tied_spectra(spark):
    rng = np.random.default_rng(1)
    steep = rng.standard_normal((300, 40)) * np.geomspace(50, 0.5, 40) + 5
    got = whitening.whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(steep)], "vec_id long, embedding array<double>"),
                           components=5, block=10)
    _check(got.collect(), dict(enumerate(steep)), 5)
    # all eigenvalues equal: any orthonormal basis is right
    corners = np.vstack([np.eye(12), -np.eye(12)])
    rows = whitening.whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corners)], "vec_id long, embedding array<double>"),
                            components=4, block=8).collect()
    assert len(rows) == 24 * 4 and max(r.identity_error for r in rows) < 1e-9
    assert all(r.explained == pytest.approx(1 / 12) for r in rows)


def test_low_rank_is_cut(spark):
    rng = np.random.default_rng(2)
    flat = np.round(rng.standard_normal((60, 2)) * 64) @ np.array([[1, 0, 1, 0, 2], [0, 1, 0, 1, 0]]) / 64
    rows = whitening.whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(flat)], "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in rows} == {1, 2}


def test_edge_cases(spark):
    rng = np.random.default_rng(3)
    long = rng.standard_normal((30, 6))
    rows = [(i, v.tolist(), 1, 1) for i, v in enumerate(long)] + [(100 + i, long[0].tolist(), 1, 1) for i in range(20)]
    short = {200 + i: rng.standard_normal(3).tolist() for i in range(9)}
    wide = {300 + i: (rng.standard_normal(4) * 10 ** (2 * (i % 4))).tolist() for i in range(12)}
    rows += [(k, v, 1, 1) for k, v in (short | wide).items()]
    rows += [(400, None, 1, 1), (401, [], 1, 1), (402, [None, 1.0, 2.0], 1, 1), (403, [float("nan")] * 6, 1, 1), (404, [float("inf")] * 6, 1, 1),
             (405, [1e12] * 6, 1, 1), (406, [1.0] * 7, 1, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, x int").repartition(3)
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == {*range(30), *range(100, 120), *short, *wide}
    _check([r for r in got if r.vec_id < 200], {k: v for k, v, *_ in rows if k < 200})
    _check([r for r in got if 200 <= r.vec_id < 300], short)
    _check([r for r in got if 300 <= r.vec_id < 400], wide)
    assert whitening.whiten(df.limit(0)).collect() == []
    none = spark.createDataFrame([(None, [1.0, 2.0]), (None, [2.0, 1.0]), (None, [2.0, 5.0])], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in whitening.whiten(none).collect()] == [None] * 6


def test_uncertified_raises(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 20)))], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError):
        whitening.whiten(df, components=3, block=4, rounds=1)
