from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.llm import queries
from claimweave.llm.whitening import Whitening, above, contour, intervals, whiten


def reference(x, k):
    """Deviation exact, components by a dense solver."""
    n, s = len(x), x.sum(0)
    deviation = [int(((n * r.astype(object) - s.astype(object)) ** 2).sum()) for r in x]
    c = x - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return deviation, e, u, c @ u / np.sqrt(e), np.trace(c.T @ c / n)


def test_query_equals_dense_solver(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(1024 * np.array([r["embedding"] for r in rows], np.float64)).astype(np.int64) + 100_000
    deviation, e, _, white, trace = reference(x, 8)
    got = queries.op11_embedding_whitening(spark, sf).orderBy("vec_id", "component").toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(got) == len(x) * 8 and set(got["n"]) == {len(x)}
    assert got["deviation"].to_numpy().reshape(-1, 8)[:, 0].tolist() == deviation
    mine = got["whitened"].to_numpy().reshape(-1, 8)
    sign = np.sign((mine * white).sum(0))
    assert np.abs(mine * sign - white).max() < 1e-8
    assert np.allclose(got["explained"].to_numpy()[:8], e / trace, rtol=1e-10)
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9


def test_inertia_counts():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    v = a @ a.T
    e = np.linalg.eigvalsh(v)
    for c in (*(e[:-1] + e[1:]) / 2, e[0] - 1, e[-1] + 1):
        assert above(v, c) == (e > c).sum()
    flip = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert above(flip, 0.0) == 1 and above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("spectrum", ["gaps", "equal", "close", "low rank"])
def test_contour_finds_all(spectrum):
    rng = np.random.default_rng(2)
    d = 24
    e = {
        "gaps": np.linspace(1, 30, d),
        "equal": np.repeat([9.0, 5.0, 1.0], 8),
        "close": np.concatenate([5 + 1e-9 * np.arange(8), np.linspace(0, 4, 16)]),
        "low rank": np.concatenate([np.zeros(20), [1.0, 2.0, 3.0, 4.0]]),
    }[spectrum]
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    v = (q * e) @ q.T
    found = [contour(v, a, b, n) for a, b, n in intervals(v, 8)]
    values = np.sort(np.concatenate([f[0] for f in found]))[::-1]
    assert len(values) >= 8 and np.allclose(values[:8], np.sort(e)[::-1][:8], atol=1e-12 * 30)
    for w, x in found:
        assert np.abs(v @ x - x * w).max() < 1e-12


def test_large_entries_are_exact(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(-(1 << 45), 1 << 45, (50, 3))
    frame = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    rows, model, error = whiten(frame, 2, scale=1, shift=7)
    got = rows.orderBy("vec_id").collect()
    want, e, _, white, _ = reference(x + 7, 2)
    assert [int(r["whitened"]["deviation"]) for r in got] == want
    assert Fraction(int(model.sums[0]), 50) == Fraction(int((x[:, 0] + 7).sum()), 50)
    mine = np.array([r["whitened"]["values"] for r in got])
    assert np.abs(mine * np.sign((mine * white).sum(0)) - white).max() < 1e-8
    assert error < 1e-9
    # beyond a long the query's column is null
    assert rows.select(F.col("whitened.deviation").try_cast("long").alias("x")).where("x is not null").count() == 0


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 0.2, 0.3]), (2, [0.4, 0.1, 0.0]), (2, [0.4, 0.1, 0.0]), (None, [0.9, -0.5, 0.25]), (5, [0.0, 0.0, 0.0])]
    bad = [(6, None), (7, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]), (9, [None, 1.0, 1.0]), (10, []), (11, [1.0])]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("whitened", F.lit("kept")).withColumn("SCALED", F.lit(1))
    rows, model, error = whiten(frame)
    assert rows.columns == ["vec_id", "embedding", "whitened", "SCALED", "whitened_"]
    assert model.n == 5 and rows.count() == 5 and len(model.e) == 3
    x = np.floor(1024 * np.array([v for _, v in good])).astype(np.int64) + 100_000
    want = reference(x, 3)[0]
    assert sorted(int(r["whitened_"]["deviation"]) for r in rows.collect()) == sorted(want)
    assert error < 1e-9


def test_fewer_directions_than_components(spark):
    frame = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(10)], "vec_id long, embedding array<double>")
    rows, model, error = whiten(frame)
    values = rows.first()["whitened"]["values"]
    assert values[0] is not None and values[1] is None and values[2] is None
    assert model.explained[0] == pytest.approx(1) and model.explained[1] == pytest.approx(0, abs=1e-12)
    assert error < 1e-9


def test_nothing_varies_and_empty(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 4, "vec_id long, embedding array<double>")
    rows, model, error = whiten(same)
    assert [r["whitened"]["values"] for r in rows.collect()] == [[None, None]] * 4
    assert {int(r["whitened"]["deviation"]) for r in rows.collect()} == {0}
    assert model.explained == [None, None] and error is None
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    rows, model, error = whiten(none)
    assert rows.collect() == [] and error is None and isinstance(model, Whitening)
