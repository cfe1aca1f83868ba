"""Merges, ordered operators, snapshots, contracts."""

import pytest
from pyspark.sql import functions as F

from claimweave.operators import assign_ids, carry_forward, check_contracts, insert_missing, many_to_one, merge_by_key, replace_window, running_number
from claimweave.sources.tables import ConcurrentWrite, SnapshotStore, read_or_empty
from claimweave.schemas import TRACKING


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_is_idempotent_and_incoming_wins(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    incoming = spark.createDataFrame([(2, "x"), (2, "c"), (3, "d")], "k int, v string")
    once = merge_by_key(current, incoming, ["k"], [F.col("v")])
    assert rows(once) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(merge_by_key(once, incoming, ["k"], [F.col("v")])) == rows(once)


def test_replace_window_drops_whole_windows_and_moved_keys(spark):
    current = spark.createDataFrame([(1, "m1"), (2, "m1"), (3, "m2"), (4, "m3")], "k int, w string")
    incoming = spark.createDataFrame([(1, "m1"), (3, "m1")], "k int, w string")
    assert rows(replace_window(current, incoming, "k", "w")) == [(1, "m1"), (3, "m1"), (4, "m3")]


def test_insert_missing_null_safe(spark):
    current = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    incoming = spark.createDataFrame([(1, None), (1, "y"), (None, None)], "a int, b string")
    assert rows(insert_missing(current, incoming, ["a"], ["b"])) == sorted(
        [(1, None), (2, "x"), (1, "y"), (None, None)], key=repr
    )


def test_running_number_equals_plain_window_under_skew(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id % 7 as string) end as k", "id div 100 as b")
    got = {r["id"]: r["numero"] for r in running_number(df, ["k"], [F.col("id")], "b").collect()}
    seen = {}
    for i in range(3000):
        k = "hot" if i % 3 == 0 else str(i % 7)
        seen[k] = seen.get(k, 0) + 1
        assert got[i] == seen[k]


def test_carry_forward(spark):
    data = [("d", p, p // 2, v) for p, v in enumerate([None, "a", None, None, "b", None, None])]
    df = spark.createDataFrame(data, "k string, p int, b int, v string")
    got = {r["p"]: r["c"] for r in carry_forward(df, ["k"], ["p"], "b", "v", "c").collect()}
    assert got == {0: None, 1: "a", 2: "a", 3: "a", 4: "b", 5: "b", 6: "b"}


def test_assign_ids_are_dense_and_stable(spark):
    df = spark.range(50).selectExpr("cast(id as string) as k")
    start = spark.createDataFrame([(100,)], "id bigint")
    first, second = rows(assign_ids(df, ["k"], start)), rows(assign_ids(df.orderBy(F.desc("k")), ["k"], start))
    assert first == second
    assert sorted(r[1] for r in first) == list(range(101, 151))


def test_contracts(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "a")], "k int, v string")
    got = rows(check_contracts(df, "m", ["k", "v"], ["k"]))
    assert got == [("m", "k", "unique", 1), ("m", "v", "not_null", 1)]


def test_snapshots_switch_together_and_survive_failure(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    one = spark.createDataFrame([(1,)], "a int")
    assert store.read("t", one.schema).count() == 0
    store.write({"t": one, "u": one})
    broken = one.select(F.raise_error(F.lit("stop")).cast("int").alias("a"))
    with pytest.raises(Exception):
        store.write({"t": one.union(one), "u": broken})
    assert store.read("t", one.schema).count() == 1
    store.write({"t": one.union(one)})
    assert store.read("t", one.schema).count() == 2 and store.read("u", one.schema).count() == 1


def test_missing_table_is_empty(spark):
    assert read_or_empty(spark, "no_such_table", TRACKING).count() == 0


def test_running_number_in_two_levels(spark):
    df = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id % 7 as string) end as k", "id div 10 as b", "id div 700 as o")
    plain = rows(running_number(df, ["k"], [F.col("id")], "b").select("id", "numero"))
    assert rows(running_number(df, ["k"], [F.col("id")], "b", outer="o").select("id", "numero")) == plain
    nulls = spark.createDataFrame([(1, None, None), (2, None, 5), (3, 1, 10), (4, 1, 11)], "id int, o int, b int")
    assert rows(running_number(nulls, [], [F.col("id")], "b", outer="o").select("id", "numero")) == [(1, 1), (2, 2), (3, 3), (4, 4)]


def _hot_sides(spark):
    many = spark.range(9000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else cast(id % 211 as string) end as k", "cast(id % 2 as int) as n")
    one = spark.range(300).selectExpr("cast(id as string) as k", "cast(id % 2 as bigint) as n", "id * 2 as v").unionByName(spark.sql("select 'hot' as k, 0L as n, -1L as v union all select 'hot', 1L, -2L"))
    return many, one


def test_many_to_one_equals_a_plain_join(spark):
    many, one = _hot_sides(spark)
    for how in ("inner", "left"):
        plain = many.join(one, ["k", "n"], how).select("id", "k", "n", "v")
        assert rows(many_to_one(many, one, ["k", "n"], how)) == rows(plain)
    safe = one.unionByName(spark.sql("select cast(null as string) as k, 1L as n, 7L as v"))
    got = {r["id"]: r["v"] for r in many_to_one(many, safe, ["n"], "left", null_safe=["k"]).collect()}
    assert len(got) == 9000 and got[1] == 7 and got[3] == -2 and got[212] is None
    assert many_to_one(many.limit(0), one, ["k", "n"], "left").count() == 0


TINY_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_does_not_meet_in_one_task(spark, how):
    """With tiny skew settings the largest task's share of the rows falls, while a join on the grouping keys keeps it."""
    many = spark.range(90_000).repartition(12).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id % 211 as string) end as k", "sha2(cast(id as string), 256) as filler")
    facts = spark.range(60_000).selectExpr("case when id % 212 = 211 then 'hot' else cast(id % 212 as string) end as k", "id as v")
    one = facts.groupBy("k").agg(F.max("v").alias("v"))

    def largest(frame):
        counted = frame.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("filler"), F.max("v"))  # the rows keep their width
        spread = [r["n"] for r in counted.collect()]
        return max(spread) / sum(spread)

    before = {name: spark.conf.get(name, None) for name in TINY_SKEW}
    for name, value in TINY_SKEW.items():
        spark.conf.set(name, value)
    try:
        plain = largest(many.join(one, "k", how))
        helped = largest(many_to_one(many, one, ["k"], how))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert plain > 0.33 and helped < 0.2, (plain, helped)


def test_two_writers_lose_nothing(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "a int")
    first, second = SnapshotStore(spark, str(tmp_path)), SnapshotStore(spark, str(tmp_path))
    first.write({"t": one})
    first.prepare("t", one.union(one))
    second.prepare("u", one)
    second.publish()
    first.publish()  # another table changed meanwhile: both stay
    assert first.read("t", one.schema).count() == 2 and first.read("u", one.schema).count() == 1
    first.prepare("t", one)
    second.write({"t": one.union(one).union(one)})
    with pytest.raises(ConcurrentWrite):
        first.publish()
    first.discard()
    assert first.read("t", one.schema).count() == 3
    other = SnapshotStore(spark, str(tmp_path), pipeline="other")
    assert other.versions() == {}


def test_commits_of_many_threads_all_count(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def add(i):
        SnapshotStore(spark, str(tmp_path)).append("t", spark.createDataFrame([(i,)], "a int"))

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(add, range(12)))
    got = SnapshotStore(spark, str(tmp_path)).read("t", spark.createDataFrame([], "a int").schema)
    assert sorted(r["a"] for r in got.collect()) == list(range(12))


def _bytes(folder):
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


def test_windows_are_replaced_by_themselves(spark, tmp_path):
    """As replace_window over the whole table, but what is written follows the batch."""
    store = SnapshotStore(spark, str(tmp_path))
    target = spark.range(200_000).selectExpr("id as k", "concat('m', id % 40) as w", "cast(id as string) as v")
    store.replace_windows("t", target, "k", "w")
    before, size = target, _bytes(tmp_path)
    batches = [[(0, "m0", "new"), (40, "m0", "new")], [(1, "m7", "moved")], [(5, None, "none"), (900_000, "m99", "added")], []]
    for batch in batches:
        incoming = spark.createDataFrame(batch, "k bigint, w string, v string")
        before = replace_window(before, incoming, "k", "w")
        store.replace_windows("t", incoming, "k", "w")
        assert rows(store.read("t", target.schema)) == rows(before)
    grown = _bytes(tmp_path) - size
    assert grown < size / 5  # the windows m1, m7, m5 and the rows that came
    parts = len([p for p in tmp_path.rglob("*.parquet")])
    store.remove_superseded(keep=1)
    assert len([p for p in tmp_path.rglob("*.parquet")]) < parts and rows(store.read("t", target.schema)) == rows(before)


def test_append_writes_only_what_comes(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    big = spark.range(100_000)
    store.append("t", big)
    size = _bytes(tmp_path)
    store.append("t", spark.range(5))
    assert _bytes(tmp_path) - size < size / 20 and store.read("t", big.schema).count() == 100_005


def test_contracts_need_one_aggregation(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "a"), (None, "b"), (None, "b")], "k int, v string")
    got = rows(check_contracts(df, "m", ["k", "v"], ["k", "v"], only_failures=False))
    assert got == sorted([("m", "k", "not_null", 2), ("m", "k", "unique", 1), ("m", "v", "not_null", 1), ("m", "v", "unique", 2)], key=repr)
    empty = rows(check_contracts(df.limit(0), "m", ["k", "v"], ["k"], only_failures=False))
    assert [r[3] for r in empty] == [0, 0, 0]
    plan = check_contracts(df, "m", ["k", "v"], ["k"], only_failures=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
