"""Resolve the remittance of each process key, automatically or by manual override."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import numbers as N
from claimweave.functions import text as T

PROCESS_KEY = ("numero_processo", "competencia_producao", "numero_protocolo", "valor_protocolo")


def process_keys(denials: DataFrame) -> DataFrame:
    linked = denials.filter(F.col("status_associacao").startswith(fv.LINKED_STATUS_PREFIX))
    return linked.select(
        "numero_processo",
        "competencia_producao",
        T.upper_trim("numero_protocolo").alias("numero_protocolo"),
        F.col("valor_protocolo_cogestao").cast("decimal(38,10)").cast(N.MONEY).alias("valor_protocolo"),
    ).distinct()


def match_remittances(denials: DataFrame, totals: DataFrame, manual: DataFrame) -> DataFrame:
    """One remittance per process key, or none.

    An automatic match needs exactly one remittance with the month and total of the key,
    so totals are first reduced to the groups that hold a single row: the join never fans
    out, however many remittances share a month and value.  A key with a manual override
    only ever takes the override.
    """
    keys = process_keys(denials)
    money = F.col("valor_total").cast("decimal(38,10)").cast(N.MONEY)
    row = F.struct("cd_remessa", "nm_convenio", "cnpj_convenio")
    lone = (
        totals.select(F.col("competencia").alias("competencia_producao"), money.alias("valor_protocolo"), row.alias("r"))
        .groupBy("competencia_producao", "valor_protocolo")
        .agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("r"))
        .filter("n = 1")
    )
    overrides = manual.select(
        T.upper_trim("numero_processo").alias("processo"),
        F.trim("competencia_producao").alias("competencia_producao"),
        T.upper_trim("nr").alias("numero_protocolo"),
        F.col("cd_remessa").alias("remessa"),
    ).distinct()

    named = keys.withColumn("processo", T.upper_trim("numero_processo"))
    on = ["processo", "competencia_producao", "numero_protocolo"]
    automatic = (
        named.join(lone, ["competencia_producao", "valor_protocolo"])
        .join(overrides.select(*on).distinct(), on, "left_anti")
        .select(
            *PROCESS_KEY,
            "r.cd_remessa",
            "r.nm_convenio",
            "r.cnpj_convenio",
            F.col("valor_protocolo").alias("valor_total_remessa"),
            F.lit(1).cast("bigint").alias("quantidade_candidatos"),
            F.lit("automatica").alias("origem_associacao"),
        )
    )
    remittance = totals.select(
        F.col("cd_remessa").alias("remessa"),
        F.col("competencia").alias("competencia_producao"),
        "cd_remessa",
        "nm_convenio",
        "cnpj_convenio",
        money.alias("valor_total_remessa"),
    ).distinct()
    by_hand = (
        named.join(overrides, on)
        .join(remittance, ["remessa", "competencia_producao"])
        .select(
            *PROCESS_KEY,
            "cd_remessa",
            "nm_convenio",
            "cnpj_convenio",
            "valor_total_remessa",
            F.lit(1).cast("bigint").alias("quantidade_candidatos"),
            F.lit("manual").alias("origem_associacao"),
        )
        .distinct()
    )
    return automatic.unionByName(by_hand)


def expected_remittances(denials: DataFrame, remittances: DataFrame, how: str) -> DataFrame:
    """Denials with ``cd_remessa`` of their process key (``inner`` or ``left``)."""
    key = remittances.select(*[F.col(c).alias(f"_{c}") for c in PROCESS_KEY], "cd_remessa")
    value = F.col("valor_protocolo_cogestao").cast("decimal(38,10)").cast(N.MONEY)
    return denials.join(
        key,
        (F.col("numero_processo") == F.col("_numero_processo"))
        & (F.col("competencia_producao") == F.col("_competencia_producao"))
        & (value == F.col("_valor_protocolo"))
        & (T.upper_trim("numero_protocolo") == F.col("_numero_protocolo")),
        how,
    ).drop(*[f"_{c}" for c in PROCESS_KEY])
