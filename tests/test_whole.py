"""Models are fitted to all rows, however many there are."""

import numpy as np
import pytest

from tallywright.functions import statistics as st
from tallywright.operators import quality, selection


def table(spark, data, names):
    return spark.createDataFrame([(f"c{i:05d}", *map(float, x)) for i, x in enumerate(data)], ", ".join(["cb string", *[f"{c} double" for c in names]])).repartition(5)


@pytest.fixture(scope="module")
def turned():
    """Cells of three features, two of them alike."""
    rnd = np.random.default_rng(11)
    data = rnd.normal(0, [1, 0.6, 0.2], (7000, 3))
    data[:, 1] += 0.5 * data[:, 0]
    return data - data.min(axis=0)


def test_robust_components_of_over_5000_cells(spark, turned):
    names = ["a", "b", "c"]
    weights, used = quality.principal_components(table(spark, turned, names), names, robust=True)
    vectors, sizes = st.sparse_components(turned)
    order = np.argsort(-sizes, kind="stable")
    assert weights == pytest.approx(vectors[:, order][:, : weights.shape[1]], abs=1e-12) and set(used) <= set(names)


def test_robust_components_without_collecting_cells(spark, turned, monkeypatch):
    rows = table(spark, turned[:, :2], ["a", "b"])
    at_once = quality.principal_components(rows, ["a", "b"], robust=True)
    monkeypatch.setattr(quality, "AT_ONCE", 10)
    by_tasks = quality.principal_components(rows, ["a", "b"], robust=True)
    assert (by_tasks[0] == at_once[0]).all() and by_tasks[1] == at_once[1]


@pytest.mark.parametrize("n", [1, 2, 3000, 3001])
def test_spreads_by_tasks(spark, monkeypatch, n):
    """Few values, halves of equal ones (the middle ranks are far apart), many ties, one value far out, equal ones, and one that is 0
    but for its rounding."""
    monkeypatch.setattr(selection, "MOST_HANDED", 20)
    rnd = np.random.default_rng(n)
    data = np.stack([rnd.normal(size=n), np.arange(n) % 2, rnd.integers(0, 4, n), np.where(np.arange(n) == 7, 1e12, rnd.gamma(1, 1, n)), np.full(n, 0.1), 1e-17 * rnd.normal(size=n)], axis=1)
    names = list("abcdef")
    directions = np.concatenate([np.eye(6), rnd.normal(size=(6, 5))], axis=1)
    along = selection.spreads(table(spark, data, names), names)
    assert (along(directions) == st.spread(st.projected(data, directions).T)).all()


def test_density_of_more_points_than_are_summed_at_once(monkeypatch):
    rnd = np.random.default_rng(13)
    data, at = rnd.normal(size=(500, 3)), rnd.normal(size=(40, 3))
    h = st.normal_bandwidth(data)
    diff = at[:, None, :] - data[None, :, :]
    want = np.exp(-0.5 * np.einsum("ijk,kl,ijl->ij", diff, np.linalg.inv(h), diff)).mean(axis=1) / np.sqrt(np.linalg.det(2 * np.pi * h))
    monkeypatch.setattr(st, "SUMMED", 64)
    assert st.density(data, h, at) == pytest.approx(want, rel=1e-9)


def test_all_high_cells_train(spark):
    """3,000 High and as many Low cells; the smaller half of each lies elsewhere, and all overlap."""
    rnd = np.random.default_rng(17)
    n = 6000
    data = rnd.normal(0, 2, (n, 2)) + np.repeat([[0, 0], [4, 0], [0, 4], [4, 4]], n // 4, axis=0)
    rows = table(spark, data, ["a", "b"])
    sizes = spark.createDataFrame([(f"c{i:05d}", 10 * n - i) for i in range(n)], "cb string, n_umis long")
    got = {r["cb"]: r["score"] for r in quality.score_cells(rows, sizes, ["a", "b"], {"min": 3000, "expected": 3000, "max": 3001}).collect()}
    z = (data - data.min(0)) / (data.max(0) - data.min(0))
    values, vectors = np.linalg.eigh(np.cov(z, rowvar=False))
    pcs = z @ vectors[:, ::-1]
    pcs = (pcs - pcs.min(0)) / (pcs.max(0) - pcs.min(0))
    at = np.arange(0, n, 50)
    d1, d0 = (st.density(x, st.normal_bandwidth(x) + 1e-9 * np.eye(2), pcs[at]) for x in (pcs[:3000], pcs[3000:]))
    want = np.where((d1 + d0) / 2 < 1e-10, 0.5, d1 / np.maximum(d1 + d0, 1e-300))
    assert [got[f"c{i:05d}"] for i in at] == pytest.approx(want.tolist(), abs=1e-6)
