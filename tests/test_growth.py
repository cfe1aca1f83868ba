"""Steps that grew faster than their input: what they read, shuffle or hold at once."""

import datetime as dt
import os

import pyarrow as pa
from pyspark.sql import functions as F

from checks import documents
from checks.frames import Frames
from claimweave.functions import text as T
from claimweave.plans import accounts as A
from claimweave.plans import report_table as U
from claimweave.sources.statements import parse_statements

_HEAD = "REGISTRO ANS#OPERADORA#CNPJ OPERADORA#X\r\n123#IPM#07.204.600/0001-70#\r\nFATURA#LOTE#DATA ENVIO LOTE#NRO PROTOCOLO#RESTO\r\n"
_LINE = "1#NR1#02/03/2024#L1#1,00#,05#-#G1#01#\x8aILVA#01/01/2024#22#S1#\"A\"\"B\"##2#1,00#1,00#1,00#10#9"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_statement_lines_are_read_once(spark):
    texts = [("a.txt", _LINE), ("b.txt", _LINE + "\r\n1#2"), (None, _LINE + "\r\n1#2"), ("c.txt", _LINE + "\r\n" + _LINE)]
    files = spark.createDataFrame([(n, (_HEAD + t).encode("latin-1")) for n, t in texts], "arquivo string, content binary")
    rows, rejects = parse_statements(files.withColumn("referencia", F.lit("2024-03-01").cast("date")))
    assert "Join" not in _plan(rows)
    found = rows.collect()
    # a file without a name keeps its good line
    assert len(found) == 4 and len({r["id_registro"] for r in found}) == 2
    assert {(r["nome_beneficiario"], r["descricao_servico"]) for r in found} == {("ŠILVA", 'A"B')}
    assert sorted((r["arquivo"] or "", r["erro"]) for r in rejects.collect()) == [("", "2 campos; esperados 21"), ("b.txt", "2 campos; esperados 21")]


def test_short_way_of_trimming(spark):
    texts = ["-", " - ", "a", "a b", " x　", "é", "", " ", "é-\t", "--", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(T.dash_to_null("t").alias("t")).collect()
    assert [r["t"] for r in found] == [None, None, "a", "a b", "x", "é", None, None, "é-", "--", None]


def _accounts(spark):
    reports = spark.createDataFrame(
        [("r1", 1, 10, None, ""), ("r2", 1, None, 7, "G"), ("r3", 2, None, None, "G"), ("r4", 1, 99, 7, "G"), ("r5", None, 10, 7, "G")],
        "id_registro string, cd_remessa long, conta_informada long, cd_atendimento_informado long, numero_guia_normalizada string",
    ).selectExpr("*", "'P1/2024' as numero_processo", "'P1/2024' as numero_processo_normalizado", "'FINALIZADO' as status_processo", "cast(null as date) as competencia")
    items = spark.createDataFrame(
        [(1, 10, 5, "X", "2024-01-05"), (1, 10, 6, "X", "2024-02-05"), (1, 20, 7, "G", "2024-03-05"), (1, None, 7, "G", "2024-04-05"), (2, 30, 7, "G", None), (1, 40, 8, "Y", None)],
        "cd_remessa long, conta long, cd_atendimento long, nr_guia_normalizada string, dia string",
    ).withColumn("dt_competencia", F.col("dia").cast("date"))
    return reports, items


def test_only_asked_lines_are_spread_over_the_account_rules(spark):
    found = A.resolve_accounts(*_accounts(spark))
    assert _plan(found).count("Join LeftSemi") == 2
    rows = sorted((r["id_registro"], r["conta"], r["criterio"], str(r["competencia"])) for r in found.collect() if r["conta"])
    assert rows == [
        ("r1", 10, "remessa_conta", "2024-01-01"),
        ("r1", 10, "remessa_conta", "2024-02-01"),
        ("r2", 20, "remessa_atendimento_guia", "2024-03-01"),
        ("r4", 20, "remessa_atendimento_guia", "2024-03-01"),
    ]


def _tables(spark, folder) -> Frames:
    day = dt.datetime(1996, 1, 5)
    lines = [(k // 2, k % 2 + 1, 10 + k, k // 2, 5.0 + k, 100.25 + k, 0.05, 0.02, "R", "F", day) for k in range(2, 14)]
    kinds = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    orders = [(k, 3 + k % 2, "FO"[k % 2], day, "5-LOW") for k in range(1, 7)]
    spark.createDataFrame(lines, kinds).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    return Frames(spark, str(folder))


def test_only_lines_of_asked_values_are_compared(spark, tmp_path):
    frames = _tables(spark, tmp_path)
    plan = _plan(U.enrich_reports(frames.reports(), frames.items()))
    assert any("Join LeftSemi" in row and "valor" in row for row in plan.splitlines())


def test_sources_with_several_readers_are_written_once(spark, tmp_path):
    frames = _tables(spark, tmp_path)
    found, plain = frames.written().report_items(), frames.report_items()
    assert not any("lineitem.parquet" in name for name in found.inputFiles())
    assert found.dtypes == plain.dtypes and found.count() == plain.count() > 0
    assert found.exceptAll(plain).count() == 0


def test_archives_of_one_large_batch_go_on_by_bytes():
    pages = pa.RecordBatch.from_pydict({"page_id": list(range(8)), "html": [os.urandom(1 << 20).hex() for _ in range(8)]})
    packed = list(documents._pack(iter([pages])))
    assert len(packed) > 1 and sum(b.num_rows for b in packed) == 8
    assert packed[0].column(0)[0].as_py() == "p0.zip"
