"""Exact top-k search by inner product with a table of distances to pivots.

A bounded sample (``SAMPLE`` rows, one per class of hashes) gives the pivots: rows far from
each other, and the means of the rows nearest to them. Every row is written once with its distances to all pivots, its
region (the nearest pivot) and, for a query, the k-th best exact score within the sample. That score is a
floor: no row below it can be an answer.

By the triangle inequality ``|d(q,p) - d(x,p)|`` bounds the distance of q and x from below for each
pivot p, the largest is taken, and ``(|q|^2 + |x|^2 - bound^2) / 2`` bounds their product from above. The
bound is used twice: a query skips regions whose intervals of distances can't reach its floor,
and within a region its candidates are evaluated in the order of the bound until the next bound is
below the k-th best score seen. Equal bounds are evaluated, so ties are whole. Bounds carry a margin for rounding; the
scores are sums of integers and exact.

Regions are no unit of work: their rows are dealt by a hash into blocks of ``BLOCK_ROWS``, the queries that
visit them into blocks of ``BLOCK_QUERIES``, and one task step compares two blocks. One vector that a
third of the rows share is spread like that.

Vectors that are null, empty, of another length than most, or hold null or non-finite components take no part, as queries or as
candidates; so do vectors with a scaled component beyond 2**53, which a double doesn't hold exactly. Zero vectors do.
A row is never its own candidate; other rows with its id are. Rows without id can be found, with a
null id after all others of equal score. Scores are decimals of 38 places. Extra columns have no effect. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.tables import Scratch, quoted

SAMPLE, PIVOTS = 4096, 48
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 2048
#: Candidates evaluated at first, then so many times more at each step.
FIRST, MORE = 64, 4
#: Doubles hold integers exactly up to this.
EXACT = 1 << 53
#: Share of the squared lengths by which bounds are widened for rounding.
MARGIN = 1e-9


def scaled(vector: Column, by: int) -> Column:
    """floor(by * component) as long, null where a vector can't take part."""
    fit = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * by) < EXACT))
    return F.when((F.size(vector) > 0) & F.coalesce(fit, F.lit(False)), F.transform(vector, lambda c: F.floor(c.cast("double") * by)))


def matrix(column: pa.ChunkedArray | pa.Array, kind: type = np.int64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, kind).reshape(len(column), -1) if len(column) else np.empty((0, 0), kind)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of one integer vector with many: floats while these are exact, else Python integers."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    if most < EXACT:
        return x.astype(np.float64) @ q.astype(np.float64)
    return np.array([sum(a * b for a, b in zip(row, q.tolist(), strict=True)) for row in x.tolist()], object)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other (each the farthest from those before), then moved to the mean of the rows nearest to them."""
    x = sample.astype(np.float64)
    chosen = [int(np.argmax(((x - x.mean(0)) ** 2).sum(1)))]
    away = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < count and away.max(initial=0) > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(1))
    pivots = x[chosen]
    nearest = distances(x, pivots).argmin(1)
    means = np.array([x[nearest == p].mean(0) for p in range(len(pivots))])
    # half of the pivots stay at the rim, where they part what lies far out; half go to the middle of their rows
    pivots[::2] = means[::2]
    return pivots


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, by differences: squares of close points don't cancel."""
    out = np.empty((len(x), len(pivots)))
    for p, pivot in enumerate(pivots):
        out[:, p] = np.sqrt(((x - pivot) ** 2).sum(1))
    return out


def bounds(q_far: np.ndarray, q_square: float, far: np.ndarray, square: np.ndarray) -> np.ndarray:
    """Upper bounds of the products of one query with rows, from their distances to the pivots."""
    least = np.abs(far - q_far).max(1)
    return (q_square + square - least * least) / 2 + MARGIN * (q_square + square + 1)


def best_of_block(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The answers that one block of rows can give to one block of queries."""
    schema = pa.schema([("query_key", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row_key", pa.int64()), ("score", pa.decimal128(38, 0)), ("evaluated", pa.int64())])

    def task(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        q, x = matrix(queries["vector"]), matrix(rows["vector"])
        q_far, far = matrix(queries["far"], np.float64), matrix(rows["far"], np.float64)
        q_square, square = queries["square"].to_numpy(), rows["square"].to_numpy()
        q_keys, keys = queries["row_key"].to_numpy(), rows["row_key"].to_numpy()
        no_id = rows["vec_id"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
        ids = rows["vec_id"].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
        floors, out = queries["floor"].to_pylist(), []
        for i in range(len(q)):
            bound = bounds(q_far[i], q_square[i], far, square)
            bound[keys == q_keys[i]] = -np.inf
            floor = -np.inf if floors[i] is None else floors[i]
            left = np.flatnonzero((bound >= float(floor)) & (bound > -np.inf))
            found, step, evaluated = [], FIRST, 0
            while len(left):
                if len(left) > step:  # the next ``step`` in the order of their bounds
                    cut = len(left) - step
                    split = np.argpartition(bound[left], cut)
                    now, left = left[split[cut:]], left[split[:cut]]
                else:
                    now, left = left, left[:0]
                evaluated += len(now)
                found += [(-int(s), bool(no_id[r]), int(ids[r]), int(keys[r])) for s, r in zip(products(q[i], x[now]).tolist(), now.tolist(), strict=True) if s >= floor]
                found = sorted(found)[:k]
                if len(found) == k:
                    floor = max(floor, -found[-1][0])
                    left = left[bound[left] >= float(floor)]
                step *= MORE
            query_id = queries["query_id"][i].as_py()
            out += [(int(q_keys[i]), query_id, None if n else v, r, -s, evaluated) for s, n, v, r in found]
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return task


class PivotTable:
    """Rows with their distances to pivots, and the queries among them."""

    def __init__(self, vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024, pivots: int = PIVOTS, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES):
        self.spark, self.k, self.block_rows, self.block_queries = vectors.sparkSession, k, block_rows, block_queries
        self.scratch = Scratch(self.spark, "pivots")
        rows = vectors.select(quoted(vec_id).cast("long").alias("vec_id"), scaled(quoted(vector), scale).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query")).where("vector is not null")
        common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
        rows = rows.where(F.size("vector") == common["d"]) if common else rows.limit(0)
        # written once: the row keys stay as they are when a task runs again
        rows = self.scratch.cut(rows.select(F.monotonically_increasing_id().alias("row_key"), "*"))
        hashed = rows.withColumn("h", F.xxhash64("row_key"))
        chosen = hashed.groupBy(F.pmod("h", F.lit(sample))).agg(F.min("h").alias("h")).select("h")
        drawn = hashed.join(F.broadcast(chosen), "h", "left_semi").select("row_key", "vector").toArrow()  # at most ``sample`` rows
        self.empty = not drawn.num_rows
        if not self.empty:
            self.regions = min(pivots, drawn.num_rows)
            self.table = self._measured(rows, matrix(drawn["vector"]), drawn["row_key"].to_numpy())

    def _measured(self, rows: DataFrame, sample: np.ndarray, keys: np.ndarray) -> DataFrame:
        chosen = choose_pivots(sample, self.regions)
        self.regions = len(chosen)
        sent, k = self.spark.sparkContext.broadcast((chosen, sample, keys)), self.k  # sample x dimensions numbers

        def task(batches):
            pivots, sample, keys = sent.value
            for batch in batches:
                x = matrix(batch.column("vector"))
                wide = x.astype(np.float64)
                far = distances(wide, pivots) if len(x) else np.empty((0, len(pivots)))
                floors: list[int | None] = [None] * len(x)
                for i in np.flatnonzero(batch.column("is_query").to_numpy(zero_copy_only=False)):
                    scores = products(x[i], sample)[keys != batch.column("row_key")[i].as_py()]
                    if len(scores) >= k:
                        floors[i] = int(np.sort(scores)[-k])
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(pivots))
                added = [
                    pa.ListArray.from_arrays(offsets, pa.array(far.ravel())),
                    pa.array((wide**2).sum(1) if len(x) else np.empty(0)),
                    pa.array(far.argmin(1).astype(np.int32)),
                    pa.array(floors, pa.decimal128(38, 0)),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "far", "square", "region", "floor"])

        schema = "row_key long, vec_id long, vector array<long>, is_query boolean, far array<double>, square double, region int, floor decimal(38,0)"
        return self.scratch.cut(rows.mapInArrow(task, schema))

    def _visits(self) -> DataFrame:
        """Each query with the regions where a row may reach its floor."""
        span = F.explode(F.transform("far", lambda d, p: F.struct(p.alias("p"), d.alias("d"))))
        ends = self.table.select("region", span.alias("f")).groupBy("region", "f.p").agg(F.min("f.d").alias("lo"), F.max("f.d").alias("hi")).collect()  # pivots squared
        most = self.table.groupBy("region").agg(F.max("square").alias("square"), F.count("*").alias("rows")).collect()  # one row per pivot
        self.held = {r["region"]: r["rows"] for r in most}
        lo, hi = np.zeros((self.regions, self.regions)), np.zeros((self.regions, self.regions))
        square = np.full(self.regions, -np.inf)
        for r in ends:
            lo[r["region"], r["p"]], hi[r["region"], r["p"]] = r["lo"], r["hi"]
        for r in most:
            square[r["region"]] = r["square"]

        def task(batches):
            for batch in batches:
                far, q_square = matrix(batch.column("far"), np.float64), batch.column("square").to_numpy()
                lists = []
                for i, floor in enumerate(batch.column("floor").to_pylist()):
                    least = np.maximum(np.maximum(lo - far[i], far[i] - hi).max(1), 0)
                    bound = (q_square[i] + square - least * least) / 2 + MARGIN * (q_square[i] + np.maximum(square, 0) + 1)
                    lists.append(np.flatnonzero((bound >= (-np.inf if floor is None else float(floor))) & (square > -np.inf)).tolist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*batch.schema.names, "regions"])

        asked = self.table.where("is_query").select("row_key", F.col("vec_id").alias("query_id"), "vector", "far", "square", "floor")
        visits = asked.mapInArrow(task, "row_key long, query_id long, vector array<long>, far array<double>, square double, floor decimal(38,0), regions array<int>")
        return self.scratch.cut(visits.select("*", F.explode("regions").alias("region")).drop("regions"))

    def top(self) -> DataFrame:
        """query_id, rank (from 1), vec_id, score; ``evaluated`` is the number of candidates whose product was taken in the answer's block."""
        result = "query_id long, rank int, vec_id long, score decimal(38,0), evaluated long"
        if self.empty:
            return self.spark.createDataFrame([], result)
        visits = self._visits()
        asked = dict(map(tuple, visits.groupBy("region").count().collect()))

        def blocks(sizes: dict[int, int], limit: int) -> Column:
            return F.element_at(F.array(*(F.lit(-(-sizes.get(p, 0) // limit)) for p in range(self.regions))), F.col("region") + 1)

        n_rows, n_queries = blocks(self.held, self.block_rows), blocks(asked, self.block_queries)

        def spread(n_own: Column, n_other: Column) -> list[Column]:
            mine = F.pmod(F.xxhash64("row_key", F.lit("block")), F.greatest(n_own, F.lit(1))).cast("int")
            return [mine, F.explode(F.when(n_other > 0, F.sequence(F.lit(0), n_other - 1)).otherwise(F.array().cast("array<int>")))]

        mine, others = spread(n_queries, n_rows)
        left = visits.select("row_key", "query_id", "vector", "far", "square", "floor", "region", mine.alias("qb"), others.alias("rb"))
        mine, others = spread(n_rows, n_queries)
        right = self.table.select("row_key", "vec_id", "vector", "far", "square", "region", mine.alias("rb"), others.alias("qb"))
        keys = ["region", "qb", "rb"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best_of_block(self.k), "query_key long, query_id long, vec_id long, row_key long, score decimal(38,0), evaluated long")
        best = Window.partitionBy("query_key").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row_key")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= self.k)
        return ranked.select("query_id", "rank", "vec_id", "score", "evaluated")
