"""Rows of one small file are rendered and parsed by many tasks; shortcuts of the parsers give the general results."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import documents, fields
from checks.frames import Frames
from claimweave.functions import numbers as N
from claimweave.functions import text as T
from claimweave.sources.pages import clean_cell

_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("orders"))
    rows = [(k, k + 7, "FOP"[k % 3], 1000.5 + k, dt.datetime(1996, 1, 1 + k), "5-LOW") for k in range(5)]
    spark.createDataFrame(rows, _ORDERS).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    return Frames(spark, folder)


@pytest.mark.parametrize("build", [documents._order_pages, documents._settlement_pages, documents._legacy_pages])
def test_pages_of_one_file_are_dealt_over_tasks(frames, build):
    pages = build(frames)
    assert pages.rdd.getNumPartitions() >= documents._SPREAD
    assert pages.count() in (5, 10)


def test_usual_amounts_read_as_before(spark):
    texts = ["1.234,56", "R$ 1.234.567,8", "R$7,005", "(1.234,5)", "1,2,3", "1.2,3", " 5,00 ", "1.5", "-", "R$ -", "1" * 17 + ",00", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        N.parse_document_number("t").alias("d"), N.bad_document_number("t").alias("ruim"), N.parse_statement_number("t").alias("s")
    ).collect()
    number = [None if x is None else Decimal(x) for x in ("1234.56", "1234567.80", "7.01", "-1234.50", None, "12.30", "5.00", "1.50", "0", "0", None, None)]
    assert [r["d"] for r in rows] == number
    assert rows[10]["ruim"] and not rows[0]["ruim"] and not rows[11]["ruim"]
    assert [rows[i]["s"] for i in (0, 6, 8)] == [Decimal("1234.56"), Decimal("5.00"), None]


def test_folding_of_marks_and_ligatures(spark):
    texts = ["JOÃO", "éte", "ﬁm Ã", "plain", "한", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(T.fold("t").alias("f"), clean_cell(F.concat("t", F.lit("  x\r\n\n y"))).alias("c"), clean_cell(F.col("t")).alias("u"))
    found = rows.collect()
    assert [r["f"] for r in found] == ["joao", "ete", "fim a", "plain", "한", None]
    assert found[0]["c"] == "JOÃO x\ny" and found[0]["u"] == "JOÃO" and found[5]["u"] == ""


def test_amounts_of_one_file_are_dealt_over_tasks(spark, tmp_path):
    line = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_quantity double"
    spark.createDataFrame([(5, 1, 2, 3, 1234.5, 8.0)], line).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    for build in (fields._money, fields._limits):
        rows = build(Frames(spark, str(tmp_path)))
        assert rows.rdd.getNumPartitions() >= fields._SPREAD
    assert fields._money(Frames(spark, str(tmp_path))).collect()[0]["negativo"] == Decimal("-1234.50")
