"""Components by counting and quotient iteration, against a full eigendecomposition and exact sums."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as contract
from tests.llm import brute
from tillstream.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int, _x int, whitened string"


def test_counts_of_eigenvalues():
    rng = np.random.default_rng(2)
    for d in (1, 2, 5, 30):
        for _ in range(20):
            a = rng.integers(-3, 4, (d, d)).astype(float)
            a += a.T
            values = np.linalg.eigvalsh(a)
            for shift in (values[:-1] + values[1:]) / 2 if d > 1 else [values[0] - 1, values[0] + 1]:
                if np.abs(values - shift).min() > 1e-6:
                    assert whitening.above(a, shift) == (values > shift).sum()
    assert whitening.above(np.zeros((3, 3)), 0.0) == 0
    assert whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize("values", [
    [9, 5, 4, 3, 1, 0.5], [5, 5, 5, 1, 1], [7, 7 - 1e-9, 3, 2], [1e12, 1, 1e-3, 1e-3, 0], [2, 0, 0], [1e-300, 0], [4],
    [1] * 20, [100 - k * 1e-13 for k in range(6)]])
def test_leading_components(values):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]
    v = q @ np.diag(np.array(values, float)) @ q.T
    v = (v + v.T) / 2
    got = whitening.leading(v, 4)
    scale = max(values)
    assert len(got) == min(4, sum(x > d * 2.3e-16 * sum(values) for x in values))
    for c, x in zip(got, sorted(values, reverse=True)):
        assert abs(c.value - x) <= 1e-13 * scale
        assert np.linalg.norm(v @ c.vector - c.value * c.vector) <= 1e-13 * d * scale
    w = np.array([c.vector for c in got])
    assert np.abs(w @ w.T - np.eye(len(got))).max() < 1e-12


def expected(rows, most=4):
    """n, and by row: vec_id, exact deviation, coordinates up to sign; the shares of variance."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(x) for _, x in kept), default=0)
    kept = [(i, x + [0] * (d - len(x))) for i, x in kept]
    fit = sorted({tuple(x) for _, x in kept})
    n = len(fit)
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    z = {x: r @ vectors[:, order] / np.sqrt(values[order]) for x, r in zip(fit, centred)}
    return n, [(i, sum((n * c - s)**2 for c, s in zip(x, sums)), z[tuple(x)]) for i, x in kept], \
        values[order] / values.sum()


def test_against_a_full_decomposition(spark):
    df = spark.read.parquet(f"{brute.SF}/embeddings.parquet")
    n, rows, shares = expected([tuple(r) for r in df.select("vec_id", "embedding").collect()])
    got = contract.queries()["op13_whitening"](spark, brute.SF).toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(got) == 4 * len(rows) and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    by_id = got.drop_duplicates("vec_id").set_index("vec_id")["deviation"]
    z = np.array([wide.loc[i].to_numpy() for i, _, _ in rows])
    want = np.array([w for _, _, w in rows])
    assert all(by_id[i] == dev for i, dev, _ in rows)
    sign = np.sign((z * want).sum(axis=0))
    assert np.abs(z - want * sign).max() < 1e-9
    for k in range(4):
        assert abs(got[got["component"] == k + 1]["explained"].iloc[0] / shares[k] - 1) < 1e-12


def test_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    own = [(k, [float(x) for x in rng.standard_normal(3)]) for k in range(30)]
    own += [(3, own[3][1]), (None, own[4][1]), (40, [1.0, None, 2.0]), (41, None), (42, [float("nan"), 1.0, 1.0]),
            (43, [float("inf"), 1.0, 1.0]), (44, [0.5]), (45, []), (46, [-0.0, 0.0, -0.0])] + [(50, [1.0, 2.0, 3.0])] * 40
    df = spark.createDataFrame([(i, v, 1, 7, "old") for i, v in own], VECTORS)
    kept = [i for i, _ in own if i not in (40, 41, 42, 43)]
    single = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    n, rows, _ = expected(single, 3)
    got = whitening.report(df).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in got) == sorted(
        (i is None, i or 0, k) for i in kept for k in (1, 2, 3))
    assert {(r["vec_id"], r["deviation"]) for r in got} == {(i, dev) for i, dev, _ in rows} and got[0]["n"] == n
    fitted = whitening.fit(whitening.integers(df))
    wide = whitening.whiten(df, fitted)
    assert wide.columns == ["vec_id", "embedding", "label", "whitened"] and wide.count() == len(kept)
    assert all(len(r["whitened"]) == 3 for r in wide.collect())


def test_tables_without_components(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0])] * 5):
        df = spark.createDataFrame([(i, v, 1, 7, "old") for i, v in rows], VECTORS)
        assert whitening.report(df).count() == 0
        assert whitening.whiten(df, whitening.fit(whitening.integers(df))).count() == sum(v is not None for _, v in rows)


def test_wide_entries(spark):
    rows = [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [1e3, 3.0]), (4, [2e3, -5.0])]
    df = spark.createDataFrame([(i, v, 1, 7, "old") for i, v in rows], VECTORS)
    # Beside such entries the second direction's variance is below what doubles can tell from zero.
    got = whitening.report(df).collect()
    assert [(r["vec_id"], r["component"], r["deviation"] is None) for r in got] == [
        (1, 1, True), (2, 1, True), (3, 1, False), (4, 1, False)]
    two = whitening.report(df.filter("vec_id > 2")).collect()
    assert [(r["component"], r["deviation"]) for r in two] == [(1, 256000**2 + 2048**2)] * 2
