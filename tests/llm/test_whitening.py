"""Whitening against a dense eigendecomposition."""

import math

import duckdb
import numpy as np
import pytest

from deltarecon.llm import whitening

from tests.conftest import SF_CHECK


@pytest.fixture
def make(spark):
    def make(vectors, kind="float"):
        return spark.createDataFrame(list(enumerate(vectors)), f"vec_id long, embedding array<{kind}>")
    return make


def dense(vectors):
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    return n, deviation, centred, v, values[::-1], vectors[:, ::-1]


def check(got, vectors, components=8, accurate=1e-7):
    n, deviation, centred, v, values, directions = dense(vectors)
    k = min(components, len(v))
    assert len(got) == n * k
    by = {(r["vec_id"], r["component"]): r for r in got}
    whitened = np.array([[by[i, c + 1]["whitened"] for c in range(k)] for i in range(n)])
    for c in range(k):
        want = centred @ directions[:, c] / math.sqrt(values[c])
        sign = math.copysign(1, whitened[:, c] @ want)
        assert np.abs(sign * whitened[:, c] - want).max() < accurate
    covariance = whitened.T @ whitened / n
    assert np.abs(covariance - np.eye(k)).max() < 1e-9
    for (i, c), r in by.items():
        assert r["n"] == n and r["deviation"] == deviation[i] == int(r["deviation_exact"])
        assert abs(r["explained"] - values[c - 1] / np.trace(v)) < 1e-9 and r["identity_error"] < 1e-9


def test_test_table_against_dense(spark):
    vectors = [r[0] for r in duckdb.sql(f"SELECT embedding FROM '{SF_CHECK}/embeddings.parquet' ORDER BY vec_id").fetchall()]
    table = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    fitted = whitening.fit(table)
    assert fitted.residual <= 1e-12 and 12 < fitted.passes < 120
    check(whitening.whiten(table, fitted).collect(), vectors)


@pytest.mark.parametrize("seed,top", [(0, 1.0), (1, 30.0), (2, 1000.0)])
def test_flat_and_steep_spectra(make, seed, top):
    rng = np.random.default_rng(seed)
    scales = np.concatenate([[top, top / 3], np.linspace(1.2, 0.9, 46)])
    vectors = (rng.standard_normal((400, 48)) * scales).tolist()
    check(whitening.whitening_report(make(vectors)).collect(), vectors)


def test_filter_without_a_wide_block(make):
    """A block hardly wider than what is wanted, so that only the filter can separate."""
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((300, 40)) * np.linspace(2, 1, 40)).tolist()
    table = make(vectors)
    check(whitening.whiten(table, whitening.fit(table, block=12)).collect(), vectors)


def test_fewer_dimensions_than_components(make):
    vectors = np.random.default_rng(3).standard_normal((50, 5)).tolist()
    check(whitening.whitening_report(make(vectors)).collect(), vectors)


def test_rows_left_out_and_clashing_columns(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((60, 12)).tolist()
    nan, inf = good[0][:-1] + [math.nan], good[0][:-1] + [math.inf]
    rows = [(i, v, 1, "a") for i, v in enumerate(good)]
    rows += [(100, None, 2, "b"), (101, nan, 3, "c"), (102, inf, 4, "d"), (103, good[0][:-1] + [None], 5, None),
             (104, [], 6, "e"), (105, good[0][:5], 7, "f")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, x string")
    got = whitening.whitening_report(table).collect()
    assert {r["vec_id"] for r in got} == set(range(60)) and got[0]["n"] == 60
    assert len(got) == 60 * 8
    nulls = spark.createDataFrame([(None, v) for v in good], "vec_id long, embedding array<float>")
    assert len(whitening.whitening_report(nulls).collect()) == 60 * 8


def test_repeated_rows_weigh_twice(make):
    vectors = np.random.default_rng(6).standard_normal((40, 9)).tolist()
    check(whitening.whitening_report(make(vectors + vectors[:7])).collect(), vectors + vectors[:7])


def test_no_rows_one_row_and_constant_rows(make, spark):
    assert whitening.whitening_report(make([])).collect() == []
    assert whitening.whitening_report(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect() == []
    for vectors in ([[1.0, 2.0, 3.0]], [[1.0, 2.0, 3.0]] * 5):
        got = whitening.whitening_report(make(vectors)).collect()
        assert len(got) == 3 * len(vectors)
        assert all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] == 0 for r in got)


def test_components_without_variance(make):
    """Vectors in a plane: two components, the others null."""
    rng = np.random.default_rng(7)
    plane = np.zeros((30, 10))
    plane[:, 2], plane[:, 5] = rng.integers(-5, 5, 30), rng.integers(-9, 9, 30)
    got = whitening.whitening_report(make(plane.tolist())).collect()
    assert {r["component"] for r in got if r["whitened"] is not None} == {1, 2}
    assert {r["component"] for r in got} == set(range(1, 9)) and got[0]["identity_error"] < 1e-9


def test_deviation_beyond_a_long(make):
    vectors = [[float(i * 2 ** 30)] + [0.0] for i in range(5)]
    got = whitening.whitening_report(make(vectors, "double")).collect()
    x = [math.floor(1024 * v[0]) for v in vectors]
    for r in got:
        exact = (5 * x[r["vec_id"]] - sum(x)) ** 2
        assert int(r["deviation_exact"]) == exact and r["deviation"] == (exact if exact < 2 ** 63 else None)


def test_scratch_is_removed(make, spark, tmp_path):
    import os
    from deltarecon.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).removeprefix("file:") + "/deltarecon-scratch"
    before = {os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs}
    whitening.whitening_report(make([[1.0, 2.0], [2.0, 1.0], [0.0, 4.0]])).collect()
    assert {os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs} <= before
