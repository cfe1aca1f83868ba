"""Upkeep of the report table: legacy rows, status refresh, identifier repair, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import dates as D
from claimweave.functions import text as T
from claimweave.operators.merge import first_by_key, merge_by_key
from claimweave.operators.skew import many_to_one
from claimweave.schemas import REPORT_ROWS


def _process_status(processes: DataFrame) -> DataFrame:
    """One normalised status per normalised process number."""
    normalised = processes.select(
        T.upper_trim("numero_processo").alias("_processo"), T.upper_trim("status_processo").alias("_status")
    )
    return first_by_key(normalised, ["_processo"], [F.col("_status").asc_nulls_last()])


def migrate_legacy(current: DataFrame, legacy: DataFrame, processes: DataFrame) -> DataFrame:
    """Upsert legacy report rows of final or running processes, with the process status."""
    status = _process_status(processes).filter(F.col("_status").isin(*fv.REPORT_STATUSES))
    named = legacy.withColumn("_processo", T.upper_trim("numero_processo"))
    rows = many_to_one(named, status, ["_processo"]).withColumn("status_processo", F.col("_status"))
    incoming = rows.select(*[c for c in current.columns if c in rows.columns])
    for name in current.columns:
        if name not in incoming.columns:
            incoming = incoming.withColumn(name, F.lit(None).cast(current.schema[name].dataType))
    return merge_by_key(current, incoming, ["id_registro"])


def refresh_status(reports: DataFrame, processes: DataFrame) -> DataFrame:
    """Report status follows the process table wherever it is different."""
    status = _process_status(processes).withColumn("_achado", F.lit(True))
    joined = many_to_one(reports.withColumn("_processo", T.upper_trim("numero_processo")), status, ["_processo"], "left")
    changed = F.coalesce("_achado", F.lit(False)) & ~F.col("status_processo").eqNullSafe(F.col("_status"))
    return joined.withColumn("status_processo", F.when(changed, F.col("_status")).otherwise(F.col("status_processo"))).select(
        *reports.columns
    )


def repair_identifiers(reports: DataFrame) -> DataFrame:
    """Split two or three blank-separated numbers in the account into account and attendance."""
    whole = F.col("numero_conta").rlike(r"\A\s*[0-9]+(?:\s+[0-9]+){1,2}\s*\z") & F.col("cd_atendimento").isNull()
    parts = F.split(F.regexp_replace("numero_conta", r"\A\s+|\s+\z", ""), r"\s+")
    account, attendance = F.element_at(parts, -2), F.element_at(parts, -1).try_cast("bigint")
    fix = whole & attendance.isNotNull()
    return reports.withColumns(
        {
            "numero_conta": F.when(fix, account).otherwise(F.col("numero_conta")),
            "cd_atendimento": F.when(fix, attendance).otherwise(F.col("cd_atendimento")),
        }
    )


def technical_defaults(reports: DataFrame) -> DataFrame:
    """Fill the load id and the row id of rows that came from elsewhere."""
    for name in ("_dlt_load_id", "_dlt_id"):
        if name not in reports.columns:
            reports = reports.withColumn(name, F.lit(None).cast("string"))
    return reports.withColumns(
        {
            "_dlt_load_id": F.coalesce("_dlt_load_id", F.lit(fv.LEGACY_LOAD_ID)),
            "_dlt_id": F.coalesce("_dlt_id", F.md5("id_registro")),
        }
    )


def upgrade_reports(current: DataFrame, legacy: DataFrame | None, processes: DataFrame) -> DataFrame:
    """Bring the report table up to date before it is read."""
    if legacy is not None:
        current = migrate_legacy(current, legacy, processes)
    return repair_identifiers(refresh_status(current, processes))


def enrich_reports(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Correct identifiers from the hospital lines of the same remittance and value.

    Lines of the same patient win over the others; a correction needs all matching lines
    to agree.  Only lines of the rows' remittances and values go on.  They are reduced per (remittance, value[, patient]) to
    their smallest and largest record first, so each report row meets at most one row per level. The month of a
    remittance is that of all its lines.
    """
    valued = items.filter(F.col("vl_total_conta").isNotNull() & F.col("cd_remessa").isNotNull()).withColumn(
        "valor", F.col("vl_total_conta").cast("decimal(18,2)")
    )
    # Not made distinct, so that both sides come straight from a shuffle and a hot value can be split.
    wanted = rows.select("cd_remessa", "valor").dropna()
    lines = valued.join(wanted, ["cd_remessa", "valor"], "left_semi").select(
        "cd_remessa",
        "valor",
        T.match_key("nm_paciente").alias("_paciente"),
        F.struct(
            "cd_reg", "cd_atendimento", "nm_paciente", "nr_guia", D.month_start("dt_competencia").alias("mes")
        ).alias("linha"),
    )

    def agreed(keys: list[str], name: str) -> DataFrame:
        found = lines.groupBy(*keys).agg(F.min("linha").alias("a"), F.max("linha").alias("b"))
        return found.select(
            *keys, F.struct(F.when(F.col("a").eqNullSafe(F.col("b")), F.col("a")).alias("linha")).alias(name)
        )

    months = (
        items.groupBy("cd_remessa")
        .agg(F.min(D.month_start("dt_competencia")).alias("m1"), F.max(D.month_start("dt_competencia")).alias("m2"))
        .select("cd_remessa", F.when(F.col("m1") == F.col("m2"), F.col("m1")).alias("_mes_remessa"))
    )
    joined = rows.withColumn("_paciente", T.match_key("nome_paciente"))
    for keys, name in ((["cd_remessa", "valor", "_paciente"], "_mesmo"), (["cd_remessa", "valor"], "_qualquer")):
        joined = many_to_one(joined, agreed(keys, name), keys, "left")
    joined = (
        many_to_one(joined, months, ["cd_remessa"], "left")
        .withColumn("_linha", F.coalesce("_mesmo", "_qualquer").getField("linha"))
        .withColumn("competencia", F.coalesce("competencia", "_mes_remessa"))
    )
    hit = F.col("_linha").isNotNull()

    def replaced(name: str, value, keep_own: bool = False):
        own = F.col(name)
        return F.when(hit, F.coalesce(value, own) if keep_own else value).otherwise(own).alias(name)

    new = {
        "numero_conta": replaced("numero_conta", F.col("_linha.cd_reg").cast("string")),
        "cd_atendimento": replaced("cd_atendimento", F.col("_linha.cd_atendimento")),
        "nome_paciente": replaced("nome_paciente", T.blank_to_null("_linha.nm_paciente"), keep_own=True),
        "numero_guia": replaced("numero_guia", F.col("_linha.nr_guia")),
        "competencia": replaced("competencia", F.col("_linha.mes"), keep_own=True),
    }
    return fill_single_month(joined.select(*[new.get(c, F.col(c)) for c in rows.columns]))


def fill_single_month(rows: DataFrame) -> DataFrame:
    """Rows without a month take the only month of their process, when there is just one."""
    months = (
        rows.groupBy("numero_processo")
        .agg(F.min("competencia").alias("m1"), F.max("competencia").alias("m2"))
        .select("numero_processo", F.when(F.col("m1") == F.col("m2"), F.col("m1")).alias("_mes"))
    )
    joined = many_to_one(rows, months, ["numero_processo"], "left")
    return joined.withColumn("competencia", F.coalesce("competencia", "_mes")).select(*rows.columns)


def report_table_rows(enriched: DataFrame, processes: DataFrame) -> DataFrame:
    """Rows ready to merge: with a month, and with the upper-case process status."""
    status = processes.select("numero_processo", F.upper("status_processo").alias("status_processo"))
    return (
        enriched.drop("status_processo")
        .filter(F.col("competencia").isNotNull())
        .join(status, "numero_processo")
        .select(*REPORT_ROWS.fieldNames())
    )
