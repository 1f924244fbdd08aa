"""Whitening against an eigendecomposition of the covariance formed from exact integers."""

import numpy as np
import pytest

from quillon.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, component int, x string, n int, id int"


def frame(spark, vectors, first=0):
    rows = [(first + i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", 2, 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def plain(vectors):
    """(kept row numbers, n, deviations, eigenvalues falling, eigenvectors, whitened), from 32-bit entries as the table holds them."""
    kept = [i for i, v in enumerate(vectors) if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in vectors[i]] for i in kept], dtype=object)
    n = len(x)
    far = n * x - x.sum(axis=0)
    c = far.astype(float) / n
    value, vector = np.linalg.eigh(c.T @ c / n)
    value, vector = value[::-1], vector[:, ::-1]
    return kept, n, (far * far).sum(axis=1), value, vector, c @ vector / np.sqrt(np.maximum(value, 1e-300))


def compare(got, vectors, most=32):
    kept, n, deviation, value, _, white = plain(vectors)
    k = min(most, len(value))
    assert len(got) == len(kept) * k
    by = {(r.vec_id, r.component): r for r in got}
    signs = {}
    for at, i in enumerate(kept):
        for j in range(k):
            r = by[i, j + 1]
            assert (r.n, r.deviation) == (n, deviation[at])
            assert r.explained == pytest.approx(value[j] / value.sum(), rel=1e-9)
            sign = signs.setdefault(j, np.sign(r.whitened * white[at, j]))
            assert r.whitened * sign == pytest.approx(white[at, j], abs=1e-8)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9 and got[0].residual <= 1e-13


def test_query_equals_the_eigendecomposition(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = [*(rng.normal(0, 1, (300, 16)) * np.geomspace(1, 9, 16) + 1000).tolist(), None, [None] * 16, [1.0] * 15 + [float("nan")], [1.0] * 15 + [float("inf")], [0.5] * 15 + [None]]
    vectors += [vectors[0]] * 3
    frame(spark, vectors).write.parquet(f"{tmp_path}/embeddings.parquet")
    compare(queries.QUERIES["op12_whitening"](spark, str(tmp_path)).collect(), vectors)


def test_more_dimensions_than_the_block(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(0, 1, (400, 90)) * np.geomspace(0.5, 20, 90)).tolist()
    settings = whitening.Settings(components=6, guard=3)
    compare(whitening.whitened(frame(spark, vectors), settings).collect(), vectors, 6)


def test_lobpcg_on_close_eigenvalues():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    value = np.concatenate(([5, 5 - 1e-6, 4, 3.99], np.linspace(2, 0.1, 296)))
    v = (turn * value) @ turn.T
    products = []
    got, vectors, residual, rounds = whitening.lobpcg(lambda b: products.append(b.shape) or v @ b, 300, whitening.Settings(components=8, guard=6))
    assert np.allclose(got, value[:8], atol=1e-12) and residual <= 1e-13 and rounds == len(products) < 120
    assert np.abs(np.abs(np.sum(vectors * turn[:, :8], axis=0)) - 1).max() < 1e-8


def test_odd_tables(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [None, [], []])).collect() == []
    assert whitening.whitened(frame(spark, [[1.0, 2.0]] * 4)).collect() == []  # nothing varies
    got = whitening.whitened(frame(spark, [[1.0, 7.0], [2.0, 7.0], [5.0, 7.0], [1.0], [float("inf"), 1.0]])).collect()
    assert {(r.vec_id, r.component, r.n) for r in got} == {(i, 1, 3) for i in range(3)}  # one dimension varies, one vector has another length
    assert {r.explained for r in got} == {1.0}


def test_deviation_beyond_doubles(spark):
    vectors = [[2.0**15 * i, 3.0] for i in range(40)]
    got = {r.vec_id: r.deviation for r in whitening.whitened(frame(spark, vectors)).collect()}
    kept, _, deviation, *_ = plain(vectors)
    assert [got[i] for i in kept] == list(deviation)
