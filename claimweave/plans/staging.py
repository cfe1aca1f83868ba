"""Typed, normalised views over the source tables, and the hospital source scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import dates as D
from claimweave.functions import numbers as N
from claimweave.functions import text as T
from claimweave.functions.identity import row_digest
from claimweave.operators.skew import many_to_one
from claimweave.schemas import ASSOCIATION

ITEM_COLUMNS = (
    "cd_remessa",
    "conta",
    "cd_lancamento",
    "cd_atendimento",
    "cd_paciente",
    "nm_paciente",
    "cd_prestador",
    "nm_prestador",
    "cd_convenio",
    "cnpj_convenio",
    "nm_convenio",
    "tp_atendimento",
    "nr_guia_normalizada",
    "nr_carteira_normalizada_com_zero",
    "nr_carteira_normalizada",
    "cd_pro_fat_normalizado",
    "cd_tuss_normalizado",
    "descricao",
    "dt_atendimento",
    "dt_alta",
    "dt_competencia",
    "dt_lancamento",
    "qt_lancamento",
    "valor_item",
    "cd_gru_fat",
    "ds_gru_fat",
    "cd_gru_pro",
    "ds_gru_pro",
)


def stage_denials(association: DataFrame) -> DataFrame:
    """Claim lines whose denied value is positive."""
    kept = association.filter(F.coalesce("valor_glosa", F.lit(0)) > 0)
    return kept.select(*ASSOCIATION.fieldNames()).withColumn("id_registro", F.col("id_registro").cast("string"))


def stage_items(items: DataFrame) -> DataFrame:
    """Hospital billing lines with normalised guide, card and service codes."""
    computed = {
        "conta": F.col("cd_reg"),
        "nr_guia_normalizada": T.norm_key("nr_guia"),
        "nr_carteira_normalizada_com_zero": T.digits("nr_carteira"),
        "nr_carteira_normalizada": T.strip_zeros("nr_carteira"),
        "cd_pro_fat_normalizado": T.norm_key("cd_pro_fat"),
        "cd_tuss_normalizado": T.norm_key("cd_tuss"),
        "valor_item": N.money("vl_total_conta"),
    }
    codes = ("cd_remessa", "conta", "cd_lancamento", "cd_atendimento", "cd_paciente", "cd_prestador", "cd_convenio")
    columns = []
    for name in ITEM_COLUMNS:
        value = computed.get(name, F.col(name))
        columns.append((value.cast("bigint") if name in codes else value).alias(name))
    return items.select(*columns)


def item_digest() -> Column:
    """Content key of a staged billing line."""
    return row_digest(ITEM_COLUMNS)


def modal_months(reports: DataFrame) -> DataFrame:
    """Most frequent report month of each process; the later month wins a tie."""
    counted = (
        reports.filter(F.col("competencia").isNotNull())
        .groupBy(T.upper_trim("numero_processo").alias("numero_processo_normalizado"), D.month_start("competencia").alias("mes"))
        .agg(F.count(F.lit(1)).alias("quantidade"))
    )
    return counted.groupBy("numero_processo_normalizado").agg(
        F.max_by("mes", F.struct("quantidade", "mes")).alias("competencia_modal")
    )


def eligible_processes(df: DataFrame, status: str = "status_processo", number: str = "numero_processo") -> DataFrame:
    """Final or running processes whose number carries a year from 2024 on."""
    wanted = T.upper_trim(status).isin(*fv.REPORT_STATUSES)
    return df.filter(wanted & (T.year_suffix(number) >= fv.REPORT_MIN_YEAR))


def stage_reports(reports: DataFrame) -> DataFrame:
    """Eligible report rows; every row of a process takes the modal month of the process."""
    # The month is counted over all rows of the process, eligible or not.
    normalised = eligible_processes(reports).withColumn(
        "numero_processo_normalizado", T.upper_trim("numero_processo")
    )
    joined = many_to_one(normalised, modal_months(reports), ["numero_processo_normalizado"], "left")
    return joined.select(
        F.col("id_registro").cast("string").alias("id_registro"),
        F.trim("numero_processo").alias("numero_processo"),
        "numero_processo_normalizado",
        T.upper_trim("status_processo").alias("status_processo"),
        F.col("documento_id").cast("string").alias("documento_id"),
        "documento_nome",
        F.col("pagina_pdf").cast("bigint").alias("pagina_pdf"),
        F.col("cd_remessa").cast("bigint").alias("cd_remessa"),
        "nome_paciente",
        T.norm_key("numero_guia").alias("numero_guia_normalizada"),
        N.safe_account("numero_conta").alias("conta_informada"),
        F.col("cd_atendimento").cast("bigint").alias("cd_atendimento_informado"),
        F.coalesce("competencia_modal", D.month_start("competencia")).alias("competencia"),
        N.money("valor").alias("valor"),
        "extraido_em",
    )


# --- hospital source ------------------------------------------------------


def remittance_totals(records: DataFrame, start: Column, end: Column) -> DataFrame:
    """Largest record total per account, then the sum per remittance, payer and month."""
    wanted = records.filter(
        (F.col("sn_pertence_pacote") == "N")
        & (F.col("cd_convenio") == fv.PAYER_CODE)
        & F.col("cd_remessa").isNotNull()
        & (F.col("dt_competencia") >= start)
        & (F.col("dt_competencia") < end)
    )
    accounts = wanted.groupBy("cd_remessa", "cd_reg", "nm_convenio", "cnpj_convenio", "dt_competencia").agg(
        F.max("vl_total_registro").alias("valor")
    )
    return accounts.groupBy(
        "cd_remessa", "nm_convenio", "cnpj_convenio", D.month_year("dt_competencia").alias("competencia")
    ).agg(F.sum("valor").alias("valor_total"))


def select_items(records: DataFrame, procedures: DataFrame, groups: DataFrame, start: Column, end: Column) -> DataFrame:
    """Payer lines with any of three dates inside the half-open period, plus their procedure group."""

    def inside(name: str) -> Column:
        return (F.col(name) >= start) & (F.col(name) < end)

    wanted = records.filter(
        F.col("cd_remessa").isNotNull()
        & (F.col("cd_convenio") == fv.PAYER_CODE)
        & (inside("dt_competencia") | inside("dt_lancamento") | inside("dt_atendimento"))
    )
    lookup = procedures.select("cd_pro_fat", F.col("cd_gru_pro").alias("_grupo"))
    names = groups.select("cd_gru_pro", "ds_gru_pro")
    base = wanted.drop("cd_gru_pro", "ds_gru_pro", "sn_pertence_pacote", "vl_total_registro")
    joined = base.join(lookup, "cd_pro_fat", "left").join(names, F.col("_grupo") == names["cd_gru_pro"], "left")
    return joined.drop("_grupo")


def data_period(association: DataFrame, reports: DataFrame, today: Column) -> DataFrame:
    """One row: first month and the month after the last, over both sources.

    Nulls when neither source has a date from 2024 up to the month after ``today``.
    """
    low = F.lit(fv.PERIOD_MIN_DATE).cast("date")
    high = F.add_months(F.trunc(today, "month"), 2)
    denied = association.filter(F.coalesce("valor_glosa", F.lit(0)) > 0).select(F.col("data_realizacao").alias("data"))
    reported = reports.filter(
        F.col("status_processo").isin(*fv.REPORT_STATUSES) & (T.year_suffix("numero_processo") >= fv.REPORT_MIN_YEAR)
    ).select(F.col("competencia").alias("data"))
    both = denied.unionByName(reported).filter((F.col("data") >= low) & (F.col("data") < high))
    return both.agg(
        D.month_start(F.min("data")).alias("inicio"), F.add_months(D.month_start(F.max("data")), 1).alias("fim")
    )


def column_or_null(df: DataFrame, names: Iterable[str], kind: str = "string") -> Column:
    """First non-null of the columns that exist in the frame, read under alternative names."""
    present = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast(kind)
