import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening
from tidemark.llm.whitening import count_below, eigenvectors, fit, identity_error, leading_components, leading_eigenvalues, moments, project, tridiagonal

SCHEMA = "vec_id long, embedding array<float>"


def symmetric(d, values=None, seed=0):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    values = rng.uniform(0, 10, d) if values is None else np.array(values, float)
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


CLOSE = [5, 5, 5, 5 - 1e-9, 2, 2, 1, 1e-12, 0, 0]


@pytest.mark.parametrize("a", [symmetric(1), symmetric(2), symmetric(3), symmetric(40), symmetric(10, CLOSE), np.zeros((5, 5)), np.eye(6), np.diag([1.0, 2, 3]), 1e5 * symmetric(64, seed=4)], ids=str)
def test_components_against_numpy(a):
    d, scale = len(a), max(np.abs(a).max(), 1e-300)
    want = np.linalg.eigvalsh(a)[::-1]
    k = min(8, d)
    values, vectors = leading_components(a, 8)
    assert np.abs(values - want[:k]).max() <= 1e-13 * scale * d
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-12
    assert np.abs(a @ vectors.T - vectors.T * values).max() <= 1e-11 * scale


def test_tridiagonal_form_and_sturm_counts():
    a = symmetric(20, seed=2)
    diagonal, off, _ = tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    want = np.linalg.eigvalsh(a)
    assert np.abs(np.linalg.eigvalsh(t) - want).max() < 1e-12
    x = np.linspace(-1, 11, 50)
    assert (count_below(diagonal, off, x) == [(want < v).sum() for v in x]).all()
    values = leading_eigenvalues(diagonal, off, 20)
    vectors = eigenvectors(diagonal, off, values)
    assert np.abs(t @ vectors.T - vectors.T * values).max() < 1e-11


def rows_of(rng, n, d=12):
    mix = rng.standard_normal((d, d))
    return [(i, [float(np.float32(v)) for v in rng.standard_normal(d) @ mix / 4]) for i in range(n)]


@pytest.fixture
def query(spark, monkeypatch):
    def run(rows):
        frame = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA).repartition(5)
        monkeypatch.setattr(whitening, "table", lambda *_: frame)
        return whitening.op12(spark, "")

    return run


def expected(rows):
    """The contract in plain numpy: every number but the sign of a component."""
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array([[float(n * e - s) / n for e, s in zip(r, sums)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = centred @ vectors / np.sqrt(values)
    deviation = [int(sum((n * e - s) ** 2 for e, s in zip(r, sums))) for r in x]
    return n, deviation, white, values / values.sum()


def test_query_against_numpy(query):
    rows = rows_of(np.random.default_rng(7), 300)
    n, deviation, white, share = expected(rows)
    got = query(rows).collect()
    assert len(got) == 300 * 8 and {r["component"] for r in got} == set(range(1, 9))
    signs = {}
    for r in got:
        want = white[r["vec_id"], r["component"] - 1]
        signs.setdefault(r["component"], math.copysign(1, want * r["whitened"]))
        assert abs(r["whitened"] - signs[r["component"]] * want) < 1e-8
        assert r["deviation"] == deviation[r["vec_id"]] and r["n"] == n
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_rows_that_take_no_part(query):
    rng = np.random.default_rng(8)
    good = rows_of(rng, 50, 4)
    bad = [(900, None), (901, [1.0, None, 2.0, 3.0]), (902, [float("nan")] * 4), (903, [1.0, float("inf"), 0.0, 0.0]), (904, []), (905, [1.0, 2.0])]
    got = query(good + bad).collect()
    assert {r["vec_id"] for r in got} == set(range(50)) and len(got) == 200
    n, deviation, *_ = expected(good)
    assert {r["n"] for r in got} == {n} and all(r["deviation"] == deviation[r["vec_id"]] for r in got)


def test_repeated_rows_null_ids_and_clashing_columns(spark, query):
    rows = rows_of(np.random.default_rng(9), 30, 3)
    frame = spark.createDataFrame([*rows, rows[0], (None, rows[1][1])], SCHEMA)
    for name in ("x", "whitened", "n", "sums", "products"):
        frame = frame.withColumn(name, F.lit("there before"))
    got = query(frame).collect()
    assert len(got) == 32 * 3 and sum(r["vec_id"] is None for r in got) == 3 and got[0]["n"] == 32
    first = [(r["component"], r["whitened"]) for r in got if r["vec_id"] == 0]
    assert len(first) == 6 and len(set(first)) == 3


def test_no_variance_and_no_rows(spark, query):
    got = query([(1, [1.0, 2.0]), (2, [1.0, 2.0])]).collect()
    assert {(r["component"], r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in got} == {(1, None, 0.0, 0.0, 0), (2, None, 0.0, 0.0, 0)}
    flat = query([(i, [float(i), 5.0, 2.0 * i]) for i in range(9)]).collect()
    assert {r["component"] for r in flat if r["whitened"] is not None} == {1} and flat[0]["identity_error"] < 1e-9
    assert query(spark.createDataFrame([], SCHEMA)).collect() == []
    assert query([(1, None)]).count() == 0


def test_blocks_and_real_numbers(spark, monkeypatch):
    rows = rows_of(np.random.default_rng(10), 200, 6)
    frame = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(7)
    monkeypatch.setattr(whitening, "BLOCK", 16)
    x = np.array([v for _, v in rows])
    found = moments(frame, "v")
    assert found.n == 200 and np.allclose(found.products / 200, np.cov(x.T, bias=True), rtol=0, atol=1e-12)
    model = fit(frame, 4, "v")
    got = project(frame, model, "v")
    assert identity_error(got, model) < 1e-10 and got.columns == ["vec_id", "v", "whitened"]
    with pytest.raises(ValueError):
        fit(frame, vector="vec_id")
