"""Denials meet the register through the link of their process and remittance; wide rows are shuffled once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimweave.operators import assign_ids, many_to_one
from claimweave.plans import register as G
from claimweave.schemas import REGISTER

LINKED = "id_registro string, numero_processo string, cd_remessa bigint, conta bigint, cd_lancamento bigint, codigo_glosa string, criterio_correspondencia string"


def _register(spark, rows):
    """(id, process, remittance, account, entry, reason, link, appealed, active) as register rows."""
    names = "id processo_controle_fatura_gab cd_remessa conta cd_lancamento motivo_glosa conciliacao_remessa_id dt_recurso sn_ativo".split()
    kinds = "id bigint, processo_controle_fatura_gab string, cd_remessa bigint, conta bigint, cd_lancamento bigint, motivo_glosa string, conciliacao_remessa_id bigint, dt_recurso date, sn_ativo string"
    frame = spark.createDataFrame(rows, kinds)
    return frame.select(*[(F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in REGISTER.fields])


def _linked(spark, rows):
    frame = spark.createDataFrame(rows, LINKED)
    absent = {n: F.lit(None).cast("string") for n in (*G._ROLLUP_MAX, "cd_tuss") if n not in frame.columns}
    return frame.withColumns({**absent, "data_realizacao": F.lit(dt.date(2026, 1, 1)), "valor_glosa": F.lit(1)})


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    some = lambda: (rng.choice(["P1", " p1", "P2", "P3", None]), rng.choice([1, 2, None]), rng.choice([5, 6]), rng.choice([1, 2, None]))
    linked = [(f"{i:02x}" if i % 3 else f"x{i}", *some(), rng.choice([" A", "", "B", None]), "r") for i in range(150)]
    records = [(i, *some(), rng.choice(["A", "B", None]), rng.choice([None, 7, 8]), rng.choice([None, dt.date(2026, 1, 1)]), rng.choice(["true", "true", "false"])) for i in range(120)]
    return linked, records, [("P1", 1, 7), ("P2", 1, None), ("P2", 2, 8)]


def _clean(p):
    return p and p.strip().upper()


def _keys(data):
    """Key of each denial and active record: process, remittance, account, entry, reason, link."""
    linked, records, links = data
    link = {(p, r): x for p, r, x in links}
    denials = [(d, (_clean(d[1]), d[2], d[3], d[4], (d[5] or "").strip() or None, link.get((_clean(d[1]), d[2])))) for d in linked]
    active = [(r, (_clean(r[1]), *r[2:7])) for r in records if r[8] == "true"]
    return denials, active


def _frames(spark, data):
    linked, records, links = data
    return _linked(spark, linked), spark.createDataFrame(links, "_processo string, cd_remessa bigint, conciliacao_remessa_id bigint"), _register(spark, records)


def test_best_record_and_missing_denials_as_by_hand(spark, data):
    linked, links, register = _frames(spark, data)
    denials, active = _keys(data)
    strict = lambda k: None not in k[:3]
    best = {}
    for r, k in active:
        if strict(k):
            best[k] = min(best.get(k, (True, 10**9)), (r[7] is not None, r[0]))
    want = sorted((d[0], best[k][1]) for d, k in denials if k in best)
    got = sorted((r["id_registro"], r["registro_glosa_id"]) for r in G.best_records(linked, links, register).collect())
    assert got == want and want
    missing = G.missing_denials(register, G.roll_up(linked), links)
    absent = {(d[1], *k) for d, k in denials if k not in best}
    fresh = G.new_register_rows(register, missing, links, F.lit("2026-05-10 12:00:00").cast("timestamp"))
    rows = fresh.collect()
    found = [(r["processo_controle_fatura_gab"], _clean(r["processo_controle_fatura_gab"]), r["cd_remessa"], r["conta"], r["cd_lancamento"], r["motivo_glosa"], r["conciliacao_remessa_id"]) for r in rows]
    assert set(found) == absent and len(found) == len(absent) == missing.count()
    assert sorted(r["id"] for r in rows) == list(range(120, 120 + len(rows)))
    # every denial with a whole key has a record once the new ones are in the register
    both = register.unionByName(fresh)
    assert sorted(map(tuple, G.best_records(linked, links, register, fresh).collect())) == sorted(map(tuple, G.best_records(linked, links, both).collect()))
    assert G.best_records(linked, links, register, fresh).count() == sum(strict(k) for _, k in denials)


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString().splitlines()


def test_denials_are_shuffled_once(spark, data, shuffled_joins):
    """Between the join with their record and the denials' source lies one exchange."""
    linked, links, register = _frames(spark, data)
    plan = _plan(G.best_records(linked.repartition(3, "criterio_correspondencia"), links, register))
    source = next(i for i, line in enumerate(plan) if "criterio_correspondencia" in line and "REPARTITION_BY_NUM" in line)
    above, indent = [], len(plan[source]) - len(plan[source].lstrip(" :+-"))
    for line in reversed(plan[:source]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < indent:
            above.append(line)
            indent = own
    assert sum("Exchange" in line for line in above) == 1, above


def test_unread_ids_cost_no_shuffle(spark):
    df = spark.range(20).selectExpr("cast(id as string) as k", "id as v")
    numbered = assign_ids(df, ["k"], spark.createDataFrame([(None,)], "id bigint"))
    assert "Window" not in "".join(_plan(numbered.select("k"))) and "Window" in "".join(_plan(numbered))
    assert sorted(r["id"] for r in numbered.collect()) == list(range(1, 21))
    assert assign_ids(df.limit(0), ["k"], spark.createDataFrame([(3,)], "id bigint")).count() == 0


def test_joins_carry_no_hash(spark, shuffled_joins):
    many = spark.createDataFrame([(1, "a"), (2, None)], "n int, k string")
    one = spark.createDataFrame([(1, "a", 5)], "n bigint, k string, v int")
    joined = many_to_one(many, one, ["n", "k"], "left")
    assert "AS _chave" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["n"], r["v"]) for r in joined.collect()) == [(1, 5), (2, None)]


def test_stale_ids_of_any_shape(spark):
    linked = spark.createDataFrame([("00ff",), ("",), ("antigo1",), (None,)], "id_registro string")
    tracking = spark.createDataFrame([("00ff", 1), ("00FF", 2), ("", 3), (None, 4), ("antigo1", 5), ("antigo2", 5), ("00", 6)], "id_registro string, registro_glosa_id bigint")
    stale = G.stale_register_ids(tracking, linked)
    assert sorted(r["id"] for r in stale.collect()) == [2, 4, 6]
