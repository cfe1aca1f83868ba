"""Hospital account of each report row, and the billing lines behind the accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import dates as D
from claimweave.operators.merge import first_by_key
from claimweave.operators.skew import many_to_one
from claimweave.plans.staging import ITEM_COLUMNS, item_digest

_KEY = ("prioridade", "k_remessa", "k_conta", "k_atendimento", "k_guia")


def _probes(remittance: Column, account: Column, attendance: Column, guide: Column) -> Column:
    """The keys under which a row takes part in the four account rules."""
    none = F.lit(-1).cast("bigint")
    blank = F.lit("")
    filled = guide != ""

    def key(priority: int, account_key: Column, attendance_key: Column, guide_key: Column) -> Column:
        values = (F.lit(priority), remittance, account_key, attendance_key, guide_key)
        return F.struct(*[v.alias(n) for v, n in zip(values, _KEY)])

    has_account, has_attendance = account.isNotNull(), attendance.isNotNull()
    keys = F.array(
        F.when(has_account & has_attendance, key(1, account, attendance, blank)),
        F.when(has_account & filled, key(2, account, none, guide)),
        F.when(has_attendance & filled, key(3, none, attendance, guide)),
        F.when(has_account, key(4, account, none, blank)),
    )
    return F.when(remittance.isNotNull(), keys)


#: Rules whose key holds the account, and those that go by attendance and guide.
_ACCOUNT_RULES, _GUIDE_RULES = (1, 2, 4), (3,)


def _asked_lines(lines: DataFrame, reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of an account that a report row names, and lines of an attendance and guide that one names.

    What is asked for isn't made distinct: both sides of the semi-joins come straight from a shuffle, so that adaptive
    execution can split a hot account.
    """
    accounts = reports.select("cd_remessa", F.col("conta_informada").alias("conta")).dropna()
    guides = reports.select(
        "cd_remessa", F.col("cd_atendimento_informado").alias("cd_atendimento"), F.col("numero_guia_normalizada").alias("nr_guia_normalizada")
    ).dropna()
    named = guides.filter("nr_guia_normalizada <> ''")
    return lines.join(accounts, ["cd_remessa", "conta"], "left_semi"), lines.join(named, named.columns, "left_semi")


def resolve_accounts(reports: DataFrame, items: DataFrame) -> DataFrame:
    """First rule that gives exactly one account for the report row.

    Billing lines are cut to those that some report row asks for, once by account and once by attendance and guide,
    before they are spread over the keys of the rules. Then they are reduced to one row per rule key (smallest and
    largest account) before the join, so every report row meets at most four rows.
    """
    month = D.month_start("dt_competencia")
    lines = items.select("cd_remessa", "conta", "cd_atendimento", "nr_guia_normalizada", month.alias("mes"))
    own = _probes(F.col("cd_remessa"), F.col("conta"), F.col("cd_atendimento"), F.col("nr_guia_normalizada"))
    by_account, by_guide = _asked_lines(lines, reports)
    keyed = [
        part.select(F.inline(own), "conta", "mes").filter(F.col("prioridade").isin(*rules))
        for part, rules in ((by_account, _ACCOUNT_RULES), (by_guide, _GUIDE_RULES))
    ]
    groups = (
        keyed[0]
        .unionByName(keyed[1])
        .groupBy(*_KEY)
        .agg(
            F.min("conta").alias("conta_menor"),
            F.max("conta").alias("conta_maior"),
            # At most two entries per calendar month.
            F.collect_set(F.struct(F.col("conta").isNull().alias("sem_conta"), "mes")).alias("meses"),
        )
        .filter("conta_menor = conta_maior")
    )
    carried = (
        "id_registro",
        "numero_processo",
        "numero_processo_normalizado",
        "status_processo",
        "cd_remessa",
        "competencia",
        "numero_guia_normalizada",
    )
    probes = reports.select(
        "id_registro",
        F.inline(
            _probes(
                F.col("cd_remessa"),
                F.col("conta_informada"),
                F.col("cd_atendimento_informado"),
                F.col("numero_guia_normalizada"),
            )
        ),
    )
    chosen = (
        many_to_one(probes.filter("prioridade is not null"), groups, _KEY)
        .groupBy("id_registro")
        .agg(F.min_by(F.struct("prioridade", "conta_menor", "meses"), "prioridade").alias("escolha"))
    )
    criterion = F.create_map(*[F.lit(x) for pair in fv.ACCOUNT_RULES for x in pair])
    opened = (
        reports.select(*carried)
        .join(chosen, "id_registro")
        .withColumn("m", F.explode("escolha.meses"))
        .select(
            "id_registro",
            "numero_processo",
            "numero_processo_normalizado",
            "status_processo",
            "cd_remessa",
            F.coalesce("competencia", "m.mes").alias("competencia"),
            "numero_guia_normalizada",
            F.when(~F.col("m.sem_conta"), F.col("escolha.conta_menor")).alias("conta"),
            criterion[F.col("escolha.prioridade")].alias("criterio"),
        )
    )
    return opened.distinct()


def report_items(accounts: DataFrame, reports: DataFrame, items: DataFrame) -> DataFrame:
    """Billing lines of the newest report row of every (process, remittance, account).

    Only lines of a wanted account go on; they lie together by account, so that neither the full-width
    distinct nor the join shuffles them again.
    """
    details = reports.select(
        "id_registro",
        "documento_id",
        "documento_nome",
        "pagina_pdf",
        F.col("nome_paciente").alias("nome_paciente_relatorio"),
        F.col("valor").alias("valor_conta_relatorio"),
        "extraido_em",
    )
    newest = first_by_key(
        accounts.join(details, "id_registro"),
        ["numero_processo_normalizado", "cd_remessa", "conta"],
        [F.col("extraido_em").desc_nulls_first(), F.col("id_registro").desc_nulls_first()],
    )
    account = newest.select(
        F.col("id_registro").alias("id_registro_relatorio"),
        "numero_processo",
        "numero_processo_normalizado",
        "status_processo",
        "documento_id",
        "documento_nome",
        "pagina_pdf",
        "competencia",
        "nome_paciente_relatorio",
        "valor_conta_relatorio",
        F.col("criterio").alias("criterio_conta"),
        F.col("cd_remessa").alias("_remessa"),
        F.col("conta").alias("_conta"),
    )
    wanted = account.select(F.col("_remessa").alias("cd_remessa"), F.col("_conta").alias("conta")).distinct()
    lines = items.select(*ITEM_COLUMNS).join(wanted, ["cd_remessa", "conta"], "left_semi").distinct().withColumn("_digest", item_digest())
    joined = account.join(
        lines, (F.col("_remessa") == F.col("cd_remessa")) & (F.col("_conta") == F.col("conta"))
    )
    return joined.select(
        F.md5(F.concat_ws("|", "id_registro_relatorio", "_digest")).alias("id_item_relatorio"),
        *[c for c in account.columns if not c.startswith("_")],
        *ITEM_COLUMNS,
    )
