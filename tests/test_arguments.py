"""Argument rules of extraction runs and issuing batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimweave.plans.arguments import extraction_periods, validate_batches, validate_extractions

TODAY = dt.date(2026, 6, 15)
RUN = "id int, cnpj string, numero_nfse string, competencia string, inicio string, fim string"


def periods(spark, *given):
    checked = validate_extractions(spark.createDataFrame([(1, *given)], RUN))
    error = checked.first()["erro"]
    rows = extraction_periods(checked, F.lit(TODAY)).orderBy("periodo_inicio").collect()
    return error, [(str(r["periodo_inicio"]), str(r["periodo_fim"])) for r in rows]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ((None, None, None, None, None), [("2026-06-01", "2026-06-30")]),
        ((" ", "", None, None, " "), [("2026-06-01", "2026-06-30")]),
        ((None, None, "02/2024", None, None), [("2024-02-01", "2024-02-29")]),
        ((None, None, None, "11/2025", "2026-01"), [("2025-11-01", "2025-11-30"), ("2025-12-01", "2025-12-31"), ("2026-01-01", "2026-01-31")]),
        ((None, None, None, "30/05/2026", "2026-07-20"), [("2026-05-30", "2026-05-31"), ("2026-06-01", "2026-06-15")]),
        ((None, None, None, "16/06/2026", "20/06/2026"), []),
        (("12.345.678/0001-95", "12", None, None, None), []),
    ],
)
def test_valid_runs(spark, given, want):
    assert periods(spark, *given) == (None, want)


@pytest.mark.parametrize(
    "given",
    [
        ("12.345.678/0001-95", None, None, None, None),
        ("12.345.678/0001-95", "1", None, "01/2026", None),
        ("12", "1", None, None, None),
        ("12.345.678/0001-95", "1234567890123456", None, None, None),
        (None, None, "01/2026", "01/2026", "02/2026"),
        (None, None, "13/2026", None, None),
        (None, None, None, None, "01/2026"),
        (None, None, None, "01/01/2026", "02/2026"),
        (None, None, None, "31/02/2026", "01/03/2026"),
        (None, None, None, "02/03/2026", "01/03/2026"),
    ],
)
def test_broken_runs(spark, given):
    error, found = periods(spark, *given)
    assert error and found == []


def test_batches(spark):
    good = "12345678000195"
    rows = [(1, [5, 6], {"5": good, "6": good}), (1, [5], None), (1, [5], {}), (None, [5], None), (1, None, None), (1, [], None), (1, [5, None], None), (1, [5, 5], None), (1, [5], {"a": good}), (1, [5], {"7": good}), (1, [5], {"5": "1"}), (1, [5, 6], {"5": good})]
    frame = spark.createDataFrame(rows, "lote_id bigint, solicitacao_ids array<bigint>, cnpj_por_solicitacao map<string,string>").coalesce(1)
    assert [r["erro"] is None for r in validate_batches(frame).collect()] == [True] * 3 + [False] * 9
