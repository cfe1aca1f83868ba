import math

import numpy as np
from pyspark.sql import functions as F

from claimweave.llm import ann, queries


def brute(ids, vectors, wanted, k):
    out = {}
    for q in wanted:
        score = np.zeros(len(vectors))
        for d in range(vectors.shape[1]):
            score += vectors[ids == q][0][d] * vectors[:, d]
        rows = [(-s, i) for s, i in zip(score, ids) if i != q]
        out[q] = [(i, -s) for s, i in sorted(rows)[:k]]
    return out


def recall(got, want):
    hits = total = 0
    for q, near in want.items():
        total += len(near)
        hits += len({i for i, _ in near} & {i for i, _ in got.get(q, [])})
    return hits / total


def gathered(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    want = brute(ids, vectors, ids[ids % 20 == 0], 20)
    got = gathered(queries.QUERIES["op3_nearest_neighbours"](spark, sf))
    assert set(got) == set(want) and recall(got, want) >= 0.9
    for q, near in got.items():
        exact = {i: s for i, s in zip(ids, vectors @ vectors[ids == q][0])}
        assert all(math.isclose(s, exact[i], rel_tol=1e-9, abs_tol=1e-12) for i, s in near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def test_parts_are_balanced():
    x = np.random.default_rng(0).normal(size=(1000, 8))
    sizes = np.bincount(ann.balanced_parts(x, 16), minlength=16)
    assert sizes.min() >= 62 and sizes.max() <= 63


def test_odd_vectors(spark):
    rng = np.random.default_rng(0)
    common = [10 * float(x) for x in rng.normal(size=6)]
    rows = [(k, common) for k in range(0, 200)] + [(200 + k, [float(x) for x in rng.normal(size=6)]) for k in range(100)]
    rows += [(400, None), (420, [0.0] * 6), (440, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (460, [math.nan] * 6), (480, [math.inf] * 6), (500, [1.0]), (None, common)]
    frame = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, part int").repartition(5)
    got = gathered(ann.nearest(frame, F.col("vec_id") % 20 == 0, k=5, parts=4, block_rows=16, block_queries=3))
    assert set(got) == {q for q in range(0, 300, 20)}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
    assert [i for i, _ in got[20]] == [0, 1, 2, 3, 4]  # ties to the smaller id, in whichever block
    few = ann.nearest(frame.where("vec_id between 195 and 203"), F.col("vec_id") == 200, k=20)
    assert few.count() == 8
    assert ann.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.nearest(frame.where("vec_id = 400"), F.col("vec_id") == 400).count() == 0
