"""Whitening against numpy over all rows, with copies, odd vectors, several lengths and no spread."""

from __future__ import annotations

import numpy as np
import pytest

from tallymill.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, count int, x string"


def table(spark, vectors):
    return spark.createDataFrame([(k, v, 1, "clash") for k, v in vectors], SCHEMA)


def plain(vectors, counts=None):
    """Sums, covariance, eigenvalues and whitened vectors of all rows, in numpy."""
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    w = np.ones(len(x)) if counts is None else np.array(counts, float)
    n, sums = int(w.sum()), (x * w[:, None].astype(np.int64)).sum(0)
    centred = (n * x - sums) / n
    covariance = (centred * w[:, None]).T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    return n, ((n * x - sums) ** 2).sum(1), values, np.trace(covariance), centred @ axes / np.sqrt(values)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    own = (rng.normal(size=(300, 12)) * np.linspace(1, 3, 12)).tolist()
    # A third of all rows is one vector, and some occur twice.
    return [*own, *own[:20], *[own[7]] * 160]


def test_equals_numpy(spark, vectors):
    n, deviation, values, trace, want = plain(vectors)
    rows = whitening.whiten(table(spark, list(enumerate(vectors))).repartition(5)).collect()
    assert len(rows) == 8 * len(vectors)
    found, signs = np.zeros((len(vectors), 8)), None
    for r in rows:
        found[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == int(deviation[r["vec_id"]])
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    signs = np.sign((found * want).sum(0))
    assert np.abs(found * signs - want).max() < 1e-8
    assert len({tuple(found[k]) for k in range(len(vectors)) if vectors[k] == vectors[7]}) == 1


def test_each_distinct_vector_once(spark, vectors):
    distinct = [list(v) for v in dict.fromkeys(map(tuple, vectors))]
    n, _, values, trace, want = plain(distinct)
    rows = whitening.whiten(table(spark, list(enumerate(vectors))), weights="one").collect()
    assert {r["n"] for r in rows} == {len(distinct)} == {n}
    found = {(r["vec_id"], r["component"]): r["whitened"] for r in rows}
    for c in range(8):
        own = np.array([found[vectors.index(v), c + 1] for v in distinct])
        assert min(np.abs(own - want[:, c]).max(), np.abs(own + want[:, c]).max()) < 1e-8


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [1.0, None]), (4, [1.0, nan]), (11, [inf, 1.0]), (7, [1e300, 1.0]),
        (5, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [1.0, 3.0]), (None, [1.0, 3.5]),
        (8, [5.0]), (9, [1e9, 2.0, 3.0]), (10, [-1e9, 2.5, 3.0]),
    ]
    out = [tuple(r) for r in whitening.whiten(table(spark, rows)).collect()]
    count = {k: sum(1 for r in out if r[0] == k) for k in {k for k, _ in rows}}
    # A row per component for each usable row, repeated and null ids included.
    assert count == {1: 0, 2: 0, 3: 0, 4: 0, 11: 0, 7: 0, 5: 4, 6: 2, None: 2, 8: 1, 9: 3, 10: 3}
    by = {(r[0], r[1]): r for r in out}
    assert by[6, 1][2] == 4 and by[6, 2][4] is None and by[6, 2][5] == 0.0 and by[6, 1][5] == 1.0
    assert by[8, 1][3:] == (0, None, None, None)
    first, second = (round(1024 * c) + 100_000 for c in (1e9, -1e9))
    assert by[9, 1][3] == by[10, 1][3] == (first - second) ** 2 + 512**2
    assert abs(by[9, 1][4]) == pytest.approx(1.0)
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0
    assert whitening.whiten(table(spark, rows).where("false")).count() == 0


def test_long_vectors(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(40, 300)).tolist()
    out = whitening.whiten(table(spark, list(enumerate(vectors)))).collect()
    assert len(out) == 320 and max(r["identity_error"] for r in out) < 1e-6
