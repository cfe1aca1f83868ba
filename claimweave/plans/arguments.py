"""Rules for the arguments of extraction runs and issuing batches, over tables of requested runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions import dates as D
from claimweave.functions import numbers as N
from claimweave.functions import text as T
from claimweave.sources.pages import fence

_GIVEN = ("cnpj", "numero_nfse", "competencia", "inicio", "fim")


def _text(name: str) -> Column:
    return T.blank_to_null(F.trim(F.col(name).cast("string")))


def _month_or_date(name: str, dated: Column) -> Column:
    """First day of the month, or the day itself where whole dates are given."""
    return F.when(dated, D.parse_request_date(name)).otherwise(D.parse_month(name))


def validate_extractions(runs: DataFrame) -> DataFrame:
    """Adds ``tipo`` (``nota``, ``mes``, ``periodo``, ``padrao``), ``de``, ``ate`` and ``erro``, the first broken rule.

    A run names one invoice (``cnpj`` and ``numero_nfse`` together), one month (``competencia``), a span
    (``inicio`` and ``fim``, both months or both days), or nothing, which stands for the present month.
    """
    clean = runs.withColumns({c: _text(c) for c in _GIVEN})
    given = {c: F.col(c).isNotNull() for c in _GIVEN}
    note, span = given["cnpj"] | given["numero_nfse"], given["inicio"] | given["fim"]
    kind = F.when(note, "nota").when(given["competencia"], "mes").when(span, "periodo").otherwise("padrao")
    dated = F.coalesce(D.looks_like_date("inicio"), F.lit(False))
    dated_end = F.coalesce(D.looks_like_date("fim"), F.lit(False))
    typed = fence(clean, tipo=kind, por_dia=dated, _mes=D.parse_month("competencia"))
    for bound, name, whole in (("de", "inicio", F.col("por_dia")), ("ate", "fim", dated_end)):
        typed = fence(typed, **{f"_{bound}": _month_or_date(name, whole)})
        typed = typed.withColumn(bound, F.when(given["competencia"], F.col("_mes")).otherwise(F.col(f"_{bound}")))
    error = (
        F.when(note & ~(given["cnpj"] & given["numero_nfse"]), "cnpj e numero_nfse sao informados juntos")
        .when(note & (given["competencia"] | span), "uma nota nao se combina com competencia ou periodo")
        .when(note & N.cnpj("cnpj").isNull(), "cnpj tem 14 digitos")
        .when(note & ~F.col("numero_nfse").rlike(r"\A[0-9]{1,15}\z"), "numero_nfse tem de 1 a 15 digitos")
        .when(given["competencia"] & span, "competencia nao se combina com inicio e fim")
        .when(given["competencia"] & F.col("de").isNull() & ~note, "competencia invalida")
        .when(span & ~(given["inicio"] & given["fim"]) & ~note, "inicio e fim sao informados juntos")
        .when(span & (dated != dated_end), "inicio e fim tem o mesmo formato")
        .when(span & (F.col("de").isNull() | F.col("ate").isNull()) & ~note, "inicio ou fim invalido")
        .when(span & (F.col("ate") < F.col("de")), "fim nao vem antes de inicio")
    )
    return typed.withColumn("erro", error).drop("_mes", "_de", "_ate")


def extraction_periods(validated: DataFrame, today: Column) -> DataFrame:
    """One row per period to fetch of every valid run: months as they are, day spans cut at month ends and at today."""
    good = validated.filter("erro is null and tipo <> 'nota'").withColumn("_hoje", today)
    month = D.month_start("_hoje")
    bounded = good.withColumns(
        {"_de": F.when(F.col("tipo") == "padrao", month).otherwise(F.col("de")), "_ate": F.when(F.col("tipo") == "padrao", month).otherwise(F.col("ate"))}
    )
    last = F.when(F.col("por_dia"), F.least("_ate", "_hoje")).otherwise(F.col("_ate"))
    months = F.when(F.col("_de") <= last, F.sequence(D.month_start("_de"), D.month_start(last), F.expr("interval 1 month")))
    opened = bounded.withColumn("_fim", last).withColumn("_mes", F.explode(months))
    whole = F.last_day("_mes")
    return opened.select(
        *validated.columns,
        F.when(F.col("por_dia"), F.greatest("_de", "_mes")).otherwise(F.col("_mes")).alias("periodo_inicio"),
        F.when(F.col("por_dia"), F.least("_fim", whole)).otherwise(whole).alias("periodo_fim"),
    )


def validate_batches(runs: DataFrame) -> DataFrame:
    """Adds ``erro`` to (``lote_id``, ``solicitacao_ids``, ``cnpj_por_solicitacao``): the first broken rule of a batch call.

    Ids are positive and not repeated; a map of issuers names all requests of the batch and no other,
    each with 14 digits.
    """
    ids, issuers = F.col("solicitacao_ids"), F.coalesce("cnpj_por_solicitacao", F.create_map().cast("map<string,string>"))
    keys = F.transform(F.map_keys(issuers), lambda k: k.try_cast("bigint"))
    error = (
        F.when(F.coalesce(F.col("lote_id") <= 0, F.lit(True)), "lote_id e um inteiro positivo")
        .when(F.coalesce(F.size(ids) <= 0, F.lit(True)), "solicitacao_ids nao e vazio")
        .when(F.exists(ids, lambda i: F.coalesce(i <= 0, F.lit(True))), "solicitacao_ids tem inteiros positivos")
        .when(F.size(F.array_distinct(ids)) < F.size(ids), "solicitacao_ids nao se repetem")
        .when(F.exists(keys, lambda k: k.isNull()), "cnpj_por_solicitacao tem um id invalido")
        .when(F.size(F.array_except(keys, ids)) > 0, "cnpj_por_solicitacao tem um id fora do lote")
        .when(F.exists(F.map_values(issuers), lambda v: N.cnpj(v).isNull()), "cnpj_por_solicitacao tem um cnpj invalido")
        .when((F.size(issuers) > 0) & (F.size(F.array_except(ids, keys)) > 0), "cnpj_por_solicitacao informa todos os itens")
    )
    return runs.withColumn("erro", error)
