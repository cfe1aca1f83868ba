import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.llm import pivots
from claimweave.llm.pivots import PivotTable, bounds, choose_pivots, distances, products


def brute(rows, wanted, k, scale=1024):
    usable = [(i, [int(np.floor(scale * float(c))) for c in v]) for i, v in rows]
    out = {}
    for at, (q, x) in enumerate(usable):
        if q is None or not wanted(q):
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), i is None, i or 0) for other, (i, y) in enumerate(usable) if other != at]
        out.setdefault(q, []).extend((None if n else i, -s) for s, n, i in sorted(scored)[:k])
    return out


def gathered(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], int(r["score"])))
    return out


def frame_of(spark, rows, more=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<double>{more}")


@pytest.mark.parametrize("shape", ["clusters", "noise", "copies", "lengths"])
def test_equals_brute_force(spark, shape):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 12))
    x = {
        "clusters": centres[rng.integers(0, 6, 700)] + 0.02 * rng.standard_normal((700, 12)),
        "noise": rng.standard_normal((700, 12)),
        "copies": np.vstack([np.tile(centres[0], (300, 1)), rng.standard_normal((400, 12))]),
        "lengths": rng.standard_normal((700, 12)) * np.exp(rng.standard_normal((700, 1)) * 2),
    }[shape]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    made = PivotTable(frame_of(spark, rows), F.col("vec_id") % 20 == 0, k=7, pivots=9, sample=128, block_rows=64, block_queries=5)
    assert gathered(made.top()) == brute(rows, lambda i: i % 20 == 0, 7)


def test_elimination_skips_most_of_clustered_rows(spark):
    rng = np.random.default_rng(4)
    centres = 3 * rng.standard_normal((20, 16))
    # all of one length, as near rows then have the greatest products
    x = centres[rng.integers(0, 20, 3000)] + 0.01 * rng.standard_normal((3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    top = PivotTable(frame_of(spark, rows), F.col("vec_id") % 100 == 0, pivots=24).top().collect()
    assert len(top) == 300
    assert max(r["evaluated"] for r in top) < 3000 / 4


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.integers(-1000, 1000, (400, 8))
    table = choose_pivots(x[:100], 12)
    far, square = distances(x.astype(float), table), (x.astype(float) ** 2).sum(1)
    for q in range(20):
        assert (bounds(far[q], square[q], far, square) >= products(x[q], x)).all()


def test_products_beyond_doubles_are_exact():
    q, x = np.array([1 << 40, 3]), np.array([[1 << 40, 1], [(1 << 40) - 1, -7]])
    assert products(q, x).tolist() == [(1 << 80) + 3, (1 << 40) * ((1 << 40) - 1) - 21]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (None, [1.0, 0.0]),
        (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (200, [None, 1.0]), (7, [1.0]), (8, []), (9, [-1.0, 0.5]), (300, None), (10, [1e300, 1.0]),
    ]
    frame = frame_of(spark, rows).withColumn("score", F.lit("x")).withColumn("row_key", F.lit(1)).withColumn("Region", F.lit(None).cast("int"))
    got = gathered(PivotTable(frame, F.col("vec_id") % 100 == 0, k=10).top())
    valid = [r for r in rows if r[1] is not None and len(r[1]) == 2 and None not in r[1] and all(np.isfinite(c) and abs(c) < 1e12 for c in r[1])]
    assert got == brute(valid, lambda i: i % 100 == 0, 10)
    assert got[0][:3] == [(1, 1024 * 1024), (1, 1024 * 1024), (None, 1024 * 1024)]


def test_empty_and_single(spark):
    assert PivotTable(frame_of(spark, []), F.col("vec_id") % 100 == 0).top().collect() == []
    assert PivotTable(frame_of(spark, [(0, [1.0])]), F.col("vec_id") % 100 == 0).top().collect() == []
    assert PivotTable(frame_of(spark, [(0, None)]), F.col("vec_id") % 100 == 0).top().collect() == []


def test_no_query(spark):
    assert PivotTable(frame_of(spark, [(1, [1.0]), (2, [2.0])]), F.col("vec_id") % 100 == 0).top().collect() == []


def test_scaled_floors_towards_minus_infinity(spark):
    row = frame_of(spark, [(0, [-0.0001, 0.0001, 1.5])]).select(pivots.scaled(F.col("embedding"), 1024).alias("x")).first()
    assert row["x"] == [-1, 0, 1536]
