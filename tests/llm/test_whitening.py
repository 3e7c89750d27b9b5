"""Whitening: the qd solver against numpy's, and whole results against exact sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening as W

RNG = np.random.default_rng(7)
CASES = {
    "plain": RNG.standard_normal((300, 40)),
    "graded": RNG.standard_normal((300, 40)) * np.logspace(0, -6, 40),
    "graded_up": RNG.standard_normal((300, 40)) * np.logspace(-6, 0, 40),
    "equal": np.concatenate([np.eye(12)] * 3) - 1 / 12,
    "identity": np.concatenate([np.eye(20)] * 2),
    "few_rows": RNG.standard_normal((5, 40)),
    "twice": np.repeat(RNG.standard_normal((300, 10)), 2, axis=1),
    "one": RNG.standard_normal((30, 1)),
    "two": RNG.standard_normal((30, 2)),
}


@pytest.mark.parametrize("name", CASES)
def test_singular_values_and_directions(name):
    y = CASES[name]
    d = y.shape[1]
    r = np.linalg.qr(y, mode="r")
    r = np.concatenate([r, np.zeros((d - len(r), d))])
    a, b, v = W.bidiagonal(r)
    size = max(np.abs(a).max(), np.abs(b).max(initial=0))
    squared, known = W.dqds(a / size, b / size), np.linalg.svd(r / size, compute_uv=False)
    assert len(squared) == d and (np.diff(squared) <= 0).all()
    k = int((known > 1e-10 * known[0]).sum())
    assert np.allclose(np.sqrt(squared[:k]), known[:k], rtol=1e-9)
    x = v @ W.directions(a / size, b / size, squared[:k])
    assert np.abs(x.T @ x - np.eye(k)).max() < 1e-11
    assert np.abs((r / size).T @ ((r / size) @ x) - x * squared[:k]).max() < 1e-13 * squared[0] * d


def vectors(spark):
    x = RNG.standard_normal((400, 6)) @ RNG.standard_normal((6, 6))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(7, x[7].tolist(), 2), (None, x[3].tolist(), None), (900, None, 1), (901, [], 1), (902, [1.0, None] * 3, 1), (903, [float("nan")] * 6, 1), (904, [float("inf")] + [0.0] * 5, 1), (905, [1.0, 2.0], 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("component", F.lit("x")).withColumn("n", F.lit(1))


def test_rows_against_exact_sums(spark):
    df = vectors(spark)
    got = W.whiten_vectors(df.repartition(40), components=4).toPandas()
    good = [r for r in df.collect() if r["embedding"] and len(r["embedding"]) == 6 and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in r["embedding"]] for r in good], dtype=object)
    n, s = len(x), x.sum(0)
    centred = ((n * x - s) / n).astype(float)
    values, unit = np.linalg.eigh(centred.T @ centred / n)
    values, unit = values[::-1], unit[:, ::-1]
    assert len(got) == 4 * n and (got["n"] == n).all() and (got["identity_error"] < 1e-9).all()
    want = sorted((-1 if r["vec_id"] is None else r["vec_id"], int(((n * v - s) ** 2).sum())) for r, v in zip(good, x, strict=True))
    for k in range(4):
        one = got[got["component"] == k + 1]
        assert sorted(zip(one["vec_id"].fillna(-1).astype(int), one["deviation"].astype(int), strict=True)) == want
        assert np.allclose(one["explained"], values[k] / values.sum(), rtol=1e-9)
        w = np.abs(centred @ unit[:, k] / np.sqrt(values[k]))
        assert np.allclose(np.sort(np.abs(one["whitened"])), np.sort(w), atol=1e-8)
    copies = got[(got["vec_id"] == 7)].groupby("component")["whitened"].nunique()
    assert (copies == 1).all()


def test_nothing_to_whiten(spark):
    df = vectors(spark)
    for none in (df.limit(0), df.where("vec_id = 1"), df.where("embedding is null")):
        assert W.whiten_vectors(none).collect() == []
    equal = W.whiten_vectors(df.where("vec_id < 2"), components=3).collect()
    assert len(equal) == 2 and all(abs(r["whitened"]) == pytest.approx(1) for r in equal)


def test_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(i, [float(i) * 2**40, 1.0]) for i in range(3)], "vec_id long, embedding array<double>")
    got = W.whiten_vectors(df).collect()
    assert len(got) == 3 and {r["deviation"] for r in got} == {None, 0}
