"""Bidiagonalisation against a plain eigendecomposition, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackflow.llm import whitening
from trackflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(vectors, most=16):
    """Sums, components and the rest, by a dense covariance of the distinct rows."""
    x = np.array([[int(np.floor(64.0 * float(c))) + 1_000_000 for c in v] for v in vectors], object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, s = len(fit), fit.sum(axis=0)
    c = ((n * fit - s) / n).astype(float)
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    kept = min(most, int((e > 1e-18 * e[0]).sum()))
    whole = ((n * x - s) / n).astype(float) @ v[:, :kept] / np.sqrt(e[:kept])
    return n, [int(r) for r in ((n * x - s) ** 2).sum(axis=1)], whole, e[:kept] / e.sum()


def compare(rows, ids, vectors):
    n, deviation, whole, share = plain(vectors)
    at = {i: k for k, i in enumerate(ids)}
    assert len(rows) == whole.size
    signs = {}
    for r in rows:
        want = whole[at[r.vec_id], r.component - 1]
        assert r.n == n and r.deviation == deviation[at[r.vec_id]]
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
        if abs(want) > 1e-6:
            assert signs.setdefault(r.component, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
        assert abs(r.whitened) == pytest.approx(abs(want), abs=1e-7)


def test_given_rows(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    rows = QUERIES["op13_whitening"](spark, FOLDER).collect()
    compare(rows, [r.vec_id for r in table], [r.embedding for r in table])


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    return df.withColumns({c: F.lit("own") for c in ("n", "component", "x", "id", "whitened", "_v")})


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    sound = [(i, rng.normal(0, 3, 3).tolist()) for i in range(30)]
    sound += [(100, sound[0][1]), (101, sound[0][1]), (102, [0.0, 0.0, 0.0])]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [float("nan")] * 3), (204, [1.0, float("inf"), 2.0]), (205, [1e300, 0.0, 0.0])]
    rows = whitening.whiten(frame(spark, sound + odd)).collect()
    compare(rows, [i for i, _ in sound], [v for _, v in sound])
    # Null and repeated ids are kept.
    again = whitening.whiten(frame(spark, sound + [(None, sound[1][1]), (5, sound[2][1])])).collect()
    assert len(again) == 3 * (len(sound) + 2) and sum(r.vec_id is None for r in again) == 3


def test_lengths_are_whitened_apart(spark):
    rng = np.random.default_rng(2)
    three, two = ([(i, rng.normal(0, 3, w).tolist()) for i in range(k, k + 9)] for k, w in ((0, 3), (50, 2)))
    rows = whitening.whiten(frame(spark, three + two)).collect()
    for part in (three, two):
        ids = [i for i, _ in part]
        compare([r for r in rows if r.vec_id in ids], ids, [v for _, v in part])


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.whiten(frame(spark, rows))
        assert out.collect() == []
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.mark.parametrize("kind", ["equal variances", "low rank", "one direction", "steep"])
def test_hard_spectra(kind):
    """Repeated and vanishing deviations: all wanted components are found."""
    rng = np.random.default_rng(3)
    if kind == "equal variances":
        x = np.vstack((np.eye(20), -np.eye(20)))
    elif kind == "low rank":
        x = rng.normal(size=(100, 5)) @ rng.normal(size=(5, 20))
    elif kind == "one direction":
        x = rng.normal(size=(100, 1)) * np.ones((1, 20))
    else:
        x = rng.normal(size=(100, 20)) * 10.0 ** -np.arange(0, 10, 0.5)
    x = x - x.mean(axis=0)

    def products(M, p):
        u = x @ p
        return (x @ M).T @ u, float(u @ u), x.T @ u

    v, values, steps = whitening.bidiagonalise(products, 20, float((x * x).sum()), whitening.Plan())
    want = np.linalg.svd(x, compute_uv=False)
    k = min(16, len(values))
    assert np.abs(values[:k] - want[:k]).max() < 1e-12 * want[0] * 20
    sound = values > 1e-6 * values[0]
    assert np.abs(v[:, sound].T @ v[:, sound] - np.eye(sound.sum())).max() < 1e-12
    assert np.abs(x.T @ (x @ v[:, sound]) - v[:, sound] * values[sound] ** 2).max() < 1e-9 * values[0] ** 2


def test_stops_early_where_the_rest_is_small():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 100)) * np.where(np.arange(100) < 16, 100.0 - 4 * np.arange(100), 0.01)
    x = x - x.mean(axis=0)
    _, values, steps = whitening.bidiagonalise(
        lambda M, p: ((x @ M).T @ (x @ p), float((x @ p) @ (x @ p)), x.T @ (x @ p)), 100, float((x * x).sum()), whitening.Plan()
    )
    assert steps < 60 and values[:16] == pytest.approx(np.linalg.svd(x, compute_uv=False)[:16], rel=1e-12)


def test_large_entries():
    x = np.array([[2**45, 0], [0, 1]], np.int64)
    big = whitening.deviations(x, 2**30, np.array([2**70, 5], object))
    assert big.tolist() == [[2**75 - 2**70, -5], [-(2**70), 2**30 - 5]]
