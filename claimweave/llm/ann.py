"""Approximate nearest neighbours with learned partitions.

A bounded sample of the vectors is joined into a graph of nearest neighbours, which is cut into
``parts`` parts of equal size by repeated spectral bisection. A softmax classifier learns from the
sample in which part a vector lies. Every row is indexed under its most probable part; a query
goes to its most probable parts and is compared with all rows there, in double precision.

How many parts a query visits is measured: the smallest number that finds ``aim`` of the
nearest sample vectors of sample queries. It also visits so many parts that they hold more rows
than are asked for, so small tables are searched in full.

Parts are no unit of work. Rows of a part are dealt by a hash of the id into blocks of
``BLOCK_ROWS``, its queries into blocks of ``BLOCK_QUERIES``, and one task step compares one block
with another, so one vector that a third of the rows share is spread.

Vectors that are null, of another length than most, zero, or hold null or non-finite components
take no part, as rows or as queries. Rows with the query's own id are never its neighbours; ids
are expected to be unique. Equal scores go to the smaller id. Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm.tables import Scratch, quoted

SAMPLE, PARTS, AIM = 4096, 32, 0.97
#: Neighbours per vector in the graph.
GRAPH_NEIGHBOURS = 16
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 2048


def _spectral_halves(weights: np.ndarray) -> np.ndarray:
    """Which vertices go to the upper half: by the second eigenvector of the normalised graph, at its median."""
    degree = np.maximum(weights.sum(1), 1e-12)
    scaled = weights / np.sqrt(degree[:, None] * degree[None, :])
    trivial = np.sqrt(degree / degree.sum())
    x = np.cos(np.arange(len(weights)) * 12.9898)
    for _ in range(60):
        x = x - trivial * (trivial @ x)
        x = scaled @ x + x
        x /= np.linalg.norm(x) or 1.0
    order = np.argsort(x / np.sqrt(degree), kind="stable")
    upper = np.zeros(len(weights), bool)
    upper[order[len(order) // 2 :]] = True
    return upper


def balanced_parts(vectors: np.ndarray, parts: int, neighbours: int = GRAPH_NEIGHBOURS) -> np.ndarray:
    """Part of each vector; all parts have the same size, give or take one."""
    k = min(neighbours, len(vectors) - 1)
    graph = np.zeros((len(vectors), len(vectors)), np.float32)
    for at in range(0, len(vectors) if k > 0 else 0, 256):
        far = -(vectors[at : at + 256] @ vectors.T)
        far[np.arange(len(far)), np.arange(at, at + len(far))] = np.inf
        np.put_along_axis(graph[at : at + 256], np.argpartition(far, k - 1, axis=1)[:, :k], 1.0, axis=1)
    np.maximum(graph, graph.T.copy(), out=graph)
    label = np.zeros(len(vectors), np.int64)
    step = 1
    while step < parts:
        new = label * 2
        for p in range(step):
            own = np.flatnonzero(label == p)
            if len(own) > 1:
                new[own[_spectral_halves(graph[np.ix_(own, own)])]] += 1
        label, step = new, step * 2
    return label


class Router:
    """Softmax regression from vectors to parts."""

    def __init__(self, vectors: np.ndarray, label: np.ndarray, parts: int, steps: int = 300):
        x = np.hstack([vectors, np.ones((len(vectors), 1))])
        self.weights = np.zeros((x.shape[1], parts))
        want = np.eye(parts)[label]
        first, second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for t in range(1, steps + 1):
            slope = x.T @ (self._softmax(x @ self.weights) - want) / len(x) + 1e-5 * self.weights
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            self.weights -= 0.2 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """Parts from the most to the least probable."""
        return np.argsort(-(np.hstack([vectors, np.ones((len(vectors), 1))]) @ self.weights), axis=1, kind="stable")


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _probes(router: Router, vectors: np.ndarray, k: int, parts: int, aim: float) -> int:
    """Parts to visit so that ``aim`` of the k nearest among the sample are there."""
    queries = vectors[:: max(1, len(vectors) // 1024)]
    near = queries @ vectors.T
    near[np.arange(len(queries)), np.arange(0, len(vectors), max(1, len(vectors) // 1024))[: len(queries)]] = -np.inf
    k = min(k, len(vectors) - 1)
    if k < 1:
        return parts
    nearest = np.argpartition(-near, k - 1, axis=1)[:, :k]
    own = router.order(vectors)[:, 0]
    place = np.empty((len(queries), parts), np.int64)
    np.put_along_axis(place, router.order(queries), np.arange(parts)[None, :].repeat(len(queries), 0), axis=1)
    needed = np.sort(np.take_along_axis(place, own[nearest], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(aim * len(needed)))]) + 1


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vector: Column, dimension: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (F.size(vector) == dimension) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _block_top(k: int):
    """The k nearest rows of one block for each query of one block."""
    names = ["query_id", "vec_id", "score"]
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def task(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        q, x = _matrix(queries["vector"]), _matrix(rows["vector"])
        q_ids, x_ids = queries["query_id"].to_numpy(), rows["vec_id"].to_numpy()
        out: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, len(q), 256):
            near = q[at : at + 256] @ x.T
            bound = np.abs(near).max(initial=0) * 1e-9
            for row, (query, query_id) in enumerate(zip(q[at : at + 256], q_ids[at : at + 256], strict=True)):
                own = near[row]
                own[x_ids == query_id] = -np.inf
                least = np.partition(own, len(own) - k)[len(own) - k] - bound if len(own) > k else -np.inf
                some = np.flatnonzero((own >= least) & (own > -np.inf))
                # products added in the same order for every row, so equal vectors have equal scores
                score = np.zeros(len(some))
                for d in range(x.shape[1]):
                    score += query[d] * x[some, d]
                best = np.lexsort((x_ids[some], -score))[:k]
                for part, values in zip(out, (np.full(len(best), query_id), x_ids[some][best], score[best]), strict=True):
                    part.append(values)
        return pa.Table.from_arrays([pa.array(np.concatenate(p)) for p in out], names=names).cast(schema)

    return task


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, parts: int = PARTS, aim: float = AIM, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (inner product) of the ``k`` nearest rows found."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    result = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select(quoted(vec_id).cast("long").alias("vec_id"), quoted(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    common = rows.where("vector is not null").groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(usable(F.col("vector"), common["d"])) if common else rows.limit(0)
    # the id of the least hash in each class of hashes: at most ``sample`` rows, whatever the number of tasks
    hashed = rows.withColumn("h", F.xxhash64("vec_id"))
    chosen = hashed.groupBy(F.pmod("h", F.lit(sample))).agg(F.min("h").alias("h")).select("h")
    drawn = hashed.join(F.broadcast(chosen), "h", "left_semi").groupBy("h").agg(F.min("vector").alias("vector")).toArrow()
    if not drawn.num_rows:
        return spark.createDataFrame([], result)
    units = np.unique(_unit(_matrix(drawn["vector"])), axis=0)
    rng = np.random.default_rng(0)
    units = units[rng.permutation(len(units))]
    router = Router(units, balanced_parts(units, parts), parts)
    probes = _probes(router, units, k, parts, aim)
    sent = spark.sparkContext.broadcast(router)  # dimensions x parts numbers

    def route(batches):
        for batch in batches:
            order = sent.value.order(_unit(_matrix(batch.column(1)))) if batch.num_rows else np.zeros((0, parts), np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1, dtype=np.int32) * parts), pa.array(order.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "order"])

    schema = T.StructType([*rows.schema.fields, T.StructField("order", T.ArrayType(T.IntegerType()))])
    routed = rows.mapInArrow(route, schema).select("vec_id", "vector", F.element_at("order", 1).alias("part"), F.when(F.col("is_query"), F.col("order")).alias("order"))
    routed = scratch.cut(routed)
    held = dict(map(tuple, routed.groupBy("part").count().collect()))  # at most ``parts`` rows
    counts = F.array(*(F.lit(held.get(p, 0)) for p in range(parts)))
    before = F.aggregate(F.sequence(F.lit(1), F.lit(parts)), F.struct(F.lit(0).cast("long").alias("rows"), F.lit(0).alias("n")), lambda s, i: F.when((s["rows"] <= k) | (s["n"] < probes), F.struct((s["rows"] + F.element_at(counts, F.element_at(F.col("order"), i) + 1)).alias("rows"), (s["n"] + 1).alias("n"))).otherwise(s))
    visits = routed.where("order is not null").select(F.col("vec_id").alias("query_id"), "vector", F.explode(F.slice("order", F.lit(1), before["n"])).alias("part"))
    asked = dict(map(tuple, visits.groupBy("part").count().collect()))

    def blocks(sizes: dict[int, int], limit: int) -> Column:
        return F.element_at(F.array(*(F.lit(-(-sizes.get(p, 0) // limit)) for p in range(parts))), F.col("part") + 1)

    row_blocks, query_blocks = blocks(held, block_rows), blocks(asked, block_queries)

    def spread(own: str, n_own: Column, n_other: Column) -> list[Column]:
        mine = F.pmod(F.xxhash64(own, F.lit("block")), F.greatest(n_own, F.lit(1))).cast("int")
        return [mine, F.explode(F.when(n_other > 0, F.sequence(F.lit(0), n_other - 1)).otherwise(F.array().cast("array<int>")))]

    mine, others = spread("query_id", query_blocks, row_blocks)
    left = visits.select("query_id", "vector", "part", mine.alias("qb"), others.alias("rb"))
    mine, others = spread("vec_id", row_blocks, query_blocks)
    right = routed.select("vec_id", "vector", "part", mine.alias("rb"), others.alias("qb"))
    keys = ["part", "qb", "rb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_block_top(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
