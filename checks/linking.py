"""Denial linking: staging, remittances, accounts, rule cascade, marts, register."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.frames import Frames, run_ts, sql
from checks.registry import query
from claimweave.api import run_linking
from claimweave.functions import text as T
from claimweave.operators.contracts import check_contracts
from claimweave.plans import accounts as A
from claimweave.plans import cascade as C
from claimweave.plans import register as G
from claimweave.plans import report_table as U
from claimweave.plans import staging as S
from claimweave.schemas import REGISTER, TRACKING
from claimweave.session import shared_folder
from claimweave.sources.tables import SnapshotStore

_CRITERION = "criterio_correspondencia"


def _outcomes(f: Frames, report_items):
    return C.outcomes(C.rule_results(f.cascade_denials(), report_items, f.staged_items(), f.remittances()))


def _resolved(f: Frames):
    f = f.written()
    lines = f.once("report_items", f.report_items)
    return C.resolve(_outcomes(f, lines), f.staged_items(), lines)


#: The last whole run of this session: (session, folder), its store and its test results.
_RUN: dict[tuple[str, str], tuple[SnapshotStore, DataFrame]] = {}


def _run(f: Frames):
    """One whole run per session and folder, in a store of its own below the shared folder; the run before it is removed."""
    key = (f.spark.sparkContext.applicationId, f.sf)
    if key not in _RUN:
        for store, _ in _RUN.values():
            store.remove()
        _RUN.clear()
        store = SnapshotStore(f.spark, f"{shared_folder(f.spark)}/linking-{uuid.uuid4().hex[:12]}")
        _RUN[key] = store, run_linking(store, f.written().inputs(), run_ts(), strict=False)
    return _RUN[key]


def published(f: Frames, name: str):
    store, _ = _run(f)
    return f.spark.read.parquet(f"{store.root}/{name}/{store.versions()[name]}").drop("parte")


def linked(f: Frames):
    return published(f, "linked_mart")


@query(
    "positive_denials",
    sql("select id_registro, valor_glosa, codigo_servico, status_associacao from denials", "denials"),
)
def _positive(f):
    return f.denials().select("id_registro", "valor_glosa", "codigo_servico", "status_associacao")


@query(
    "staged_items",
    sql(
        "select cd_remessa, conta, cd_lancamento, cd_atendimento, guia nr_guia_normalizada, carteira nr_carteira_normalizada,"
        " carteira_zero nr_carteira_normalizada_com_zero, pf cd_pro_fat_normalizado, tuss cd_tuss_normalizado, valor_item,"
        " dt_competencia, qt_lancamento from items",
        "items",
    ),
)
def _staged_items(f):
    return f.staged_items().select(
        "cd_remessa",
        "conta",
        "cd_lancamento",
        "cd_atendimento",
        "nr_guia_normalizada",
        "nr_carteira_normalizada",
        "nr_carteira_normalizada_com_zero",
        "cd_pro_fat_normalizado",
        "cd_tuss_normalizado",
        "valor_item",
        "dt_competencia",
        "qt_lancamento",
    )


@query(
    "staged_reports",
    sql(
        "select id_registro, numero_processo, processo numero_processo_normalizado, status_processo, cd_remessa,"
        " guia numero_guia_normalizada, conta_informada, cd_atendimento cd_atendimento_informado, competencia, valor from reports",
        "reports",
    ),
)
def _staged_reports(f):
    return f.staged_reports().drop("documento_id", "documento_nome", "pagina_pdf", "nome_paciente", "extraido_em")


@query(
    "year_suffix_filter",
    sql(
        "select id_registro, upper(trim(numero_processo)) numero, upper(trim(status_processo)) status from raw_reports"
        " where upper(trim(status_processo)) in ('FINALIZADO','TRAMITANDO') and cast(right(numero_processo, 4) as int) >= 2024",
        "raw_reports",
    ),
)
def _year_suffix(f):
    return S.eligible_processes(f.reports()).select(
        "id_registro", T.process_number("numero_processo").alias("numero"), T.upper_trim("status_processo").alias("status")
    )


@query(
    "modal_month",
    sql(
        "select r.id_registro, m.mes competencia from raw_reports r join (select p, mes from (select upper(trim(numero_processo)) p,"
        " competencia mes, count(*) n from raw_reports group by 1, 2)"
        " qualify row_number() over (partition by p order by n desc, mes desc) = 1) m on m.p = upper(trim(r.numero_processo))",
        "raw_reports",
    ),
)
def _modal(f):
    reports = f.reports()
    keyed = reports.withColumn("numero_processo_normalizado", T.upper_trim("numero_processo"))
    joined = keyed.join(S.modal_months(reports), "numero_processo_normalizado", "left")
    return joined.select("id_registro", F.coalesce("competencia_modal", "competencia").alias("competencia"))


@query(
    "remittance_match",
    sql(
        "select numero_processo, competencia_producao, numero_protocolo, valor_protocolo, cd_remessa, valor_total_remessa,"
        " origem origem_associacao from remittances",
        "remittances",
    ),
)
def _remittances(f):
    return f.remittances().drop("nm_convenio", "cnpj_convenio", "quantidade_candidatos")


@query(
    "resolve_accounts",
    sql(
        "select id_registro, numero_processo, processo numero_processo_normalizado, status_processo, cd_remessa, competencia,"
        " guia numero_guia_normalizada, conta, crit criterio from accounts",
        "accounts",
    ),
)
def _accounts(f):
    return f.written().accounts()


@query(
    "report_items",
    sql(
        "select id_item_relatorio, id_registro_relatorio, numero_processo, status_processo, competencia, valor_conta valor_conta_relatorio,"
        " criterio_conta, cd_remessa, conta, cd_lancamento, cd_atendimento, pf cd_pro_fat_normalizado, valor_item from report_items",
        "report_items",
    ),
)
def _report_items(f):
    return f.written().report_items().select(
        "id_item_relatorio",
        "id_registro_relatorio",
        "numero_processo",
        "status_processo",
        "competencia",
        "valor_conta_relatorio",
        "criterio_conta",
        "cd_remessa",
        "conta",
        "cd_lancamento",
        "cd_atendimento",
        "cd_pro_fat_normalizado",
        "valor_item",
    )


_CANDIDATE = "prio prioridade, crit criterio, id_registro, proc numero_processo_resolvido, cd_remessa, conta, cd_lancamento"


def _report_candidates(f):
    f = f.written()
    lines = f.once("report_items", f.report_items)
    results = C.rule_results(f.cascade_denials(), lines, f.staged_items(), f.remittances())
    return C.report_candidates(f.cascade_denials(), lines, results).select(
        "prioridade", "criterio", "id_registro", "numero_processo_resolvido", "cd_remessa", "conta", "cd_lancamento"
    )


@query(
    "direct_match",
    sql(f"select {_CANDIDATE} from (select 1 prio, 'relatorio_hpc_guia_beneficiario_servico' crit, * from direct)", "direct"),
)
def _direct(f):
    return _report_candidates(f).filter("prioridade = 1")


@query("fallback_cascade", sql(f"select {_CANDIDATE} from fallback", "fallback"))
def _fallback(f):
    return _report_candidates(f).filter("prioridade > 1")


_COUNTS = (
    "select id_registro, prio prioridade, crit criterio, cast(count(*) as bigint) quantidade_candidatos,"
    " count(distinct (proc, cd_remessa, conta)) quantidade_contextos,"
    " count(distinct (proc, cd_remessa, conta, cd_lancamento)) quantidade_itens from legacy group by 1, 2, 3"
)


@query("legacy_cascade", sql(_COUNTS, "legacy"))
def _legacy(f):
    f = f.written()
    counts = C.rule_counts(f.cascade_denials(), f.report_items(), f.staged_items(), f.remittances())
    return counts.filter("_legado and prioridade > 20").drop("_legado").withColumn("quantidade_candidatos", F.col("quantidade_candidatos").cast("bigint"))


@query(
    "rule_outcomes",
    sql(
        "select id_registro, min(prio) filter (where nc = 1) prioridade, min(prio) filter (where nc > 1) prioridade_insegura"
        " from counted group by 1",
        "counted",
    ),
)
def _rule_outcomes(f):
    f = f.written()
    out = _outcomes(f, f.report_items()).select("id_registro", F.col("escolha.prioridade").alias("prioridade"), "prioridade_insegura")
    return out.filter("prioridade is not null or prioridade_insegura is not null")


@query(
    "resolved",
    sql(
        "select id_registro, numero_processo, criterio, status_correspondencia, cd_remessa, conta, cd_lancamento, guia nr_guia,"
        " pf cd_pro_fat, tuss cd_tuss, valor_item, nm_paciente from resolved",
        "resolved",
    ),
)
def _resolved_query(f):
    return _resolved(f).select(
        "id_registro",
        "numero_processo",
        "criterio",
        "status_correspondencia",
        "cd_remessa",
        "conta",
        "cd_lancamento",
        "nr_guia",
        "cd_pro_fat",
        "cd_tuss",
        "valor_item",
        "nm_paciente",
    )


_LINKED = (
    "id_registro, numero_processo, competencia_producao, cd_remessa, conta, cd_lancamento, status_correspondencia,"
    " {c}, cd_atendimento, nm_prestador, {p}, valor_item, numero_protocolo, referencia, codigo_servico, codigo_glosa,"
    " valor_processado, valor_liberado, valor_glosa, data_realizacao"
)


@query(
    "linked_mart",
    sql("select " + _LINKED.format(c="criterio criterio_correspondencia", p="pf cd_pro_fat") + " from linked", "linked"),
)
def _linked(f):
    names = [c.strip() for c in _LINKED.format(c="criterio_correspondencia", p="cd_pro_fat").split(",")]
    return linked(f).select(*names)


@query(
    "unlinked_mart",
    sql(
        """select d.id_registro, d.numero_processo, m.cd_remessa,
  case when status_associacao = 'SEM_PROCESSO' then 'sem_processo' when status_associacao = 'AMBIGUO' then 'processo_ambiguo'
       when m.cd_remessa is null then 'remessa_nao_encontrada_ou_ambigua' when u.crit is not null then 'ambiguo'
       else 'nao_encontrado' end motivo,
  d.valor_glosa, u.crit criterio_correspondencia, '[]' remessas_candidatas, d.numero_protocolo, d.data_realizacao,
  d.codigo_servico, d.valor_processado
from denials d left join remittances m on m.numero_processo = d.numero_processo and m.competencia_producao = d.competencia_producao
  and m.valor_protocolo = d.valor_protocolo_cogestao and m.numero_protocolo = upper(trim(d.numero_protocolo))
left join (select * from counted where nc > 1 qualify row_number() over (partition by id_registro order by prio) = 1) u
  on u.id_registro = d.id_registro
where not exists (select 1 from resolved r where r.id_registro = d.id_registro)""",
        "resolved",
        "remittances",
    ),
)
def _unlinked(f):
    return published(f, "unlinked_mart").drop(
        "numero_guia_senha", "codigo_beneficiario", "codigo_glosa", "data_primeira_ocorrencia", "data_ultima_tentativa"
    )


@query(
    "items_mart",
    sql(
        """select md5(i.id_item_relatorio || '|' || coalesce(l.id_registro, '')) id_registro, i.id_item_relatorio,
  l.id_registro demonstrativo_id_registro, i.numero_processo, i.status_processo, i.cd_remessa, i.conta, i.cd_lancamento,
  coalesce(nullif(l.codigo_servico, ''), i.pf) cd_pro_fat, i.tuss cd_tuss,
  coalesce(nullif(l.descricao_servico, ''), i.descricao) descricao, i.valor_item, l.valor_glosa, l.criterio criterio_demonstrativo
from report_items i left join linked l on upper(trim(l.numero_processo)) = i.processo and l.cd_remessa = i.cd_remessa
  and l.conta = i.conta and l.cd_lancamento = i.cd_lancamento""",
        "linked",
        "report_items",
    ),
)
def _items_mart(f):
    return published(f, "items_mart").select(
        "id_registro",
        "id_item_relatorio",
        "demonstrativo_id_registro",
        "numero_processo",
        "status_processo",
        "cd_remessa",
        "conta",
        "cd_lancamento",
        "cd_pro_fat",
        "cd_tuss",
        "descricao",
        "valor_item",
        "valor_glosa",
        "criterio_demonstrativo",
    )


_ITEMS_MART_SQL = """select md5(i.id_item_relatorio || '|' || coalesce(l.id_registro, '')) id_registro, i.numero_processo, i.status_processo, i.cd_remessa, i.conta
from report_items i left join linked l on upper(trim(l.numero_processo)) = i.processo and l.cd_remessa = i.cd_remessa
  and l.conta = i.conta and l.cd_lancamento = i.cd_lancamento"""
_UNLINKED_SQL = """select d.id_registro from denials d left join remittances m on m.numero_processo = d.numero_processo and m.competencia_producao = d.competencia_producao
  and m.valor_protocolo = d.valor_protocolo_cogestao and m.numero_protocolo = upper(trim(d.numero_protocolo))
where not exists (select 1 from resolved r where r.id_registro = d.id_registro)"""
#: Model, its rows in SQL, columns that are never null, columns that are unique.
_MODEL_TESTS = (
    ("report_accounts", "accounts", "id_registro numero_processo cd_remessa conta", "id_registro"),
    ("report_items", "report_items", "id_item_relatorio numero_processo cd_remessa conta", "id_item_relatorio"),
    ("items_mart", f"({_ITEMS_MART_SQL})", "id_registro numero_processo status_processo cd_remessa conta", "id_registro"),
    ("remittances", "remittances", "numero_processo cd_remessa", ""),
    ("resolved", "resolved", "id_registro", "id_registro"),
    ("linked_mart", "linked", "id_registro", "id_registro"),
    ("unlinked_mart", f"({_UNLINKED_SQL})", "id_registro", "id_registro"),
)
_TESTS_SQL = " union all ".join(
    f"select '{model}' modelo, '{c}' coluna, '{test}' teste, "
    + (f"count(*) filter ({c} is null)" if test == "not_null" else f"(select count(*) from (select {c} from {rows} group by 1 having {c} is not null and count(*) > 1))")
    + (f" falhas from {rows}" if test == "not_null" else " falhas")
    for model, rows, filled, unique in _MODEL_TESTS
    for test, columns in (("not_null", filled), ("unique", unique))
    for c in columns.split()
)


@query(
    "single_month",
    sql(
        """select r.id_registro, coalesce(r.competencia, case when m.a = m.b then m.a end) competencia from (
  select id_registro, numero_processo, case when l_orderkey % 3 > 0 then competencia end competencia from raw_reports) r
join (select numero_processo, min(case when l_orderkey % 3 > 0 then competencia end) a, max(case when l_orderkey % 3 > 0 then competencia end) b from raw_reports group by 1) m
 using (numero_processo)""",
        "raw_reports",
    ),
)
def _single_month(f):
    """Report rows of every third order lose their month and take the only one of their process."""
    order = F.substring("documento_id", 2, 20).cast("bigint")
    reports = f.reports().withColumn("competencia", F.when(order % 3 > 0, F.col("competencia")))
    return U.fill_single_month(reports).select("id_registro", "competencia")


@query("contracts", sql(f"select * from ({_TESTS_SQL})", "linked", "report_items", "accounts", "remittances"))
def _model_tests(f):
    """Results of all model tests of a run, which were taken before its models were published."""
    return _run(f)[1]


@query(
    "contract_failures",
    sql(
        """select 'linked_mart' modelo, 'id_registro' coluna, 'not_null' teste, count(*) filter (where id_registro is null) falhas from linked
union all select 'linked_mart', 'cd_lancamento', 'not_null', count(*) filter (where cd_lancamento is null) from linked
union all select 'linked_mart', 'id_registro', 'unique', count(*) from (select id_registro from linked group by 1 having count(*) > 1)
union all select 'linked_mart', 'conta', 'unique', count(*) from (select conta from linked group by 1 having count(*) > 1)""",
        "linked",
    ),
)
def _contracts(f):
    return check_contracts(
        linked(f), "linked_mart", ["id_registro", "cd_lancamento"], ["id_registro", "conta"], only_failures=False
    )


# --- hospital source scans ------------------------------------------------


def _records(f: Frames):
    """Hospital view with package flag and record total; the payer varies by supplier nation."""
    return f.items().withColumns(
        {
            "sn_pertence_pacote": F.when(F.col("qt_lancamento") > 40, "S").otherwise("N"),
            "cd_convenio": F.when(F.col("tp_atendimento") == "5-LOW", F.lit(11)).otherwise(F.lit(10)).cast("bigint"),
            "vl_total_registro": F.col("vl_total_conta"),
        }
    )


@query(
    "max_then_sum",
    sql(
        """select cd_remessa, strftime(dt_competencia, '%m/%Y') competencia, cast(sum(v) as decimal(18,2)) valor_total from (
  select cd_remessa, conta, dt_competencia, max(valor_item) v from items
  where qt_lancamento <= 40 and tp_atendimento <> '5-LOW' and dt_competencia >= date '1996-01-01' and dt_competencia < date '2000-01-01'
  group by 1, 2, 3) group by 1, 2""",
        "items",
    ),
)
def _max_then_sum(f):
    day = lambda x: F.lit(x).cast("date")
    totals = S.remittance_totals(_records(f), day("1996-01-01"), day("2000-01-01"))
    return totals.select("cd_remessa", "competencia", F.col("valor_total").cast("decimal(18,2)").alias("valor_total"))


@query(
    "date_or_filter",
    sql(
        """select i.cd_remessa, i.conta, i.cd_lancamento, i.cd_atendimento, cast(n.r_regionkey as bigint) cd_gru_pro, n.r_name ds_gru_pro, i.valor_item
from items i left join (select 'S' || p pf, p % 7 grupo from range(40) t(p)) g on g.pf = i.pf
left join region n on n.r_regionkey = g.grupo
where tp_atendimento <> '5-LOW' and ((dt_competencia >= date '1997-01-01' and dt_competencia < date '1997-07-01')
  or (dt_lancamento >= date '1997-01-01' and dt_lancamento < date '1997-07-01')
  or (dt_atendimento >= date '1997-01-01' and dt_atendimento < date '1997-07-01'))""",
        "items",
    ),
)
def _date_or_filter(f):
    codes = f.t("part").select((F.col("p_partkey") % 40).alias("p")).distinct()
    procedures = codes.select(F.concat(F.lit("S"), "p").alias("cd_pro_fat"), (F.col("p") % 7).alias("cd_gru_pro"))
    groups = f.t("region").select(F.col("r_regionkey").cast("bigint").alias("cd_gru_pro"), F.col("r_name").alias("ds_gru_pro"))
    day = lambda x: F.lit(x).cast("date")
    rows = S.select_items(_records(f), procedures, groups, day("1997-01-01"), day("1997-07-01"))
    return rows.select(
        "cd_remessa",
        F.col("cd_reg").alias("conta"),
        "cd_lancamento",
        "cd_atendimento",
        "cd_gru_pro",
        "ds_gru_pro",
        F.col("vl_total_conta").alias("valor_item"),
    )


@query(
    "data_period",
    sql(
        """select cast(date_trunc('month', min(d)) as date) inicio, cast(date_trunc('month', max(d)) + interval 1 month as date) fim from (
  select cast(data_realizacao + interval 27 year as date) d from denials
  union all select cast(competencia + interval 27 year as date) from raw_reports
  where trim(status_processo) in ('FINALIZADO','TRAMITANDO') and status_processo = trim(status_processo) and cast(right(numero_processo, 4) as int) >= 2024)
where d >= date '2024-01-01' and d < date '2026-07-01'""",
        "denials",
        "raw_reports",
    ),
)
def _data_period(f):
    later = lambda c: F.add_months(c, 27 * 12)
    association = f.association().withColumn("data_realizacao", later("data_realizacao"))
    reports = f.reports().withColumn("competencia", later("competencia"))
    return S.data_period(association, reports, F.lit("2026-05-10").cast("date"))


# --- report table upkeep --------------------------------------------------


@query(
    "enrich_reports",
    sql(
        """select r.id_registro, coalesce(c.conta, r.numero_conta) numero_conta, case when c.hit then c.atend else r.cd_atendimento end cd_atendimento,
  coalesce(c.pac, r.nome_paciente) nome_paciente, coalesce(c.guia, r.numero_guia) numero_guia, coalesce(c.mes, r.competencia) competencia
from raw_reports r left join (
  select id_registro, true hit, any_value(cast(conta as varchar)) conta, any_value(cd_atendimento) atend, any_value(nm_paciente) pac,
    any_value(lower(guia)) guia, any_value(dt_competencia) mes from (
    select r.id_registro, i.*, i.nm_paciente = r.nome_paciente same, bool_or(i.nm_paciente = r.nome_paciente) over (partition by r.id_registro) any_same
    from raw_reports r join items i on i.cd_remessa = r.cd_remessa and i.valor_item = r.valor)
  where same or not any_same group by 1
  having count(distinct (conta, cd_atendimento, nm_paciente, guia, dt_competencia)) = 1) c using (id_registro)""",
        "raw_reports",
        "items",
    ),
)
def _enrich(f):
    f = f.written()
    rows = U.enrich_reports(f.reports(), f.items())
    return rows.select("id_registro", "numero_conta", "cd_atendimento", "nome_paciente", "numero_guia", "competencia")


# --- register -------------------------------------------------------------
# The register holds one older record per linked key of odd accounts; some carry follow-up
# data.  Tracking points to those records, partly for denials that are no longer linked.

_REGISTER_SQL = """
base as materialized (select upper(trim(numero_processo)) processo, cd_remessa, conta, cd_lancamento, nullif(trim(codigo_glosa), '') motivo,
    min(id_registro) id_registro, cast('0x' || substr(min(id_registro), 1, 15) as bigint) id from linked where conta % 2 = 1 group by 1, 2, 3, 4, 5),
conc as materialized (select distinct upper(trim(numero_processo)) processo, cd_remessa, 500000 + conta % 1000 * 100 + cd_remessa rem_id
    from linked where conta % 3 = 0),
links as materialized (select processo, cd_remessa, max(rem_id) rem_id from conc group by 1, 2),
register as materialized (select b.*, l.rem_id, case when conta % 10 = 1 then date '2026-01-01' end dt_recurso,
    case when conta % 14 = 1 then 'false' else 'true' end sn_ativo from base b left join links l using (processo, cd_remessa)),
tracking as materialized (select case when conta % 5 = 0 then 'antigo' || id else id_registro end id_registro, id registro_glosa_id from register),
dead as materialized (select registro_glosa_id id from tracking t left join (select distinct id_registro, 1 ok from linked) k using (id_registro)
    group by 1 having max(ok) is null),
cleaned as materialized (select r.*, case when d.id is not null and sn_ativo = 'true' and dt_recurso is null then 'false' else sn_ativo end ativo
    from register r left join dead d on d.id = r.id),
rolled as materialized (select l.rem_id, upper(trim(g.numero_processo)) processo, g.cd_remessa, g.conta, g.cd_lancamento,
    nullif(trim(g.codigo_glosa), '') motivo, max(g.nm_prestador) prestador, max(g.valor_item) valor, cast(sum(g.valor_glosa) as decimal(18,2)) glosa,
    max(g.descricao) descricao, count(*) n
    from linked g left join links l on l.processo = upper(trim(g.numero_processo)) and l.cd_remessa = g.cd_remessa group by 1, 2, 3, 4, 5, 6),
fresh as materialized (select r.* from rolled r where not exists (select 1 from cleaned c where c.processo = r.processo and c.cd_remessa = r.cd_remessa
    and c.conta = r.conta and c.rem_id is not distinct from r.rem_id and c.cd_lancamento is not distinct from r.cd_lancamento
    and c.motivo is not distinct from r.motivo and c.ativo = 'true'))
"""


_LINKED_LINES = """linked as materialized (select line_id id_registro, processo numero_processo, remessa cd_remessa, l_orderkey conta,
    cast(l_linenumber as bigint) cd_lancamento, case when l_linenumber = 7 then ' ' else ' ' || (l_linenumber * 100) end codigo_glosa,
    'PRESTADOR ' || l_suppkey nm_prestador, price valor_item, cast(price * disc as decimal(18,2)) valor_glosa, 'ITEM ' || l_partkey descricao,
    'regra ' || l_linenumber criterio from lines), """


def _register_sql(select: str) -> str:
    return sql("", "lines").rstrip() + ", " + _LINKED_LINES + _REGISTER_SQL + " " + select


def _linked_lines(f: Frames):
    """Linked denials straight from the lines, so these queries measure the register only."""
    known = f.lines(identified=True).selectExpr(
        "line_id as id_registro",
        "processo as numero_processo",
        "remessa as cd_remessa",
        "l_orderkey as conta",
        "cast(l_linenumber as bigint) as cd_lancamento",
        "case when l_linenumber = 7 then ' ' else concat(' ', l_linenumber * 100) end as codigo_glosa",
        "concat('PRESTADOR ', l_suppkey) as nm_prestador",
        "price as valor_item",
        "cast(price * disc as decimal(18,2)) as valor_glosa",
        "concat('ITEM ', l_partkey) as descricao",
        "concat('regra ', l_linenumber) as criterio_correspondencia",
        "ship as data_realizacao",
    )
    absent = {
        "bigint": "cd_paciente cd_atendimento cd_prestador cd_convenio cd_gru_pro cd_gru_fat",
        "string": "nm_paciente nm_convenio tp_atendimento cd_pro_fat cd_tuss nr_guia ds_gru_pro ds_gru_fat",
        "timestamp_ntz": "dt_atendimento dt_alta dt_lancamento",
        "decimal(18,4)": "qt_lancamento",
    }
    return known.withColumns({n: F.lit(None).cast(kind) for kind, names in absent.items() for n in names.split()})


def _register_frames(f: Frames):
    """(linked, conciliations, conciliation remittances, register, tracking)."""
    rows = _linked_lines(f).withColumn("_p", T.upper_trim("numero_processo"))
    motive = T.blank_to_null(F.trim("codigo_glosa"))
    conciliated = rows.filter("conta % 3 = 0").select(
        "_p", "cd_remessa", F.expr("500000 + conta % 1000 * 100 + cd_remessa").alias("rem")
    ).distinct()
    # One conciliation per remittance link, named by the link id; inactive twins must not count.
    active = conciliated.select(F.concat_ws("#", "_p", "rem").alias("k"), "_p", "cd_remessa", "rem")
    ids = active.withColumn("id", F.xxhash64("k"))
    conciliations = ids.select("id", F.lower("_p").alias("processo_recebimento"), F.lit(True).alias("ativo")).unionByName(
        ids.select((F.col("id") + 1).alias("id"), F.lower("_p").alias("processo_recebimento"), F.lit(False).alias("ativo"))
    )
    remittances = ids.select(F.col("rem").alias("id"), F.col("id").alias("conciliacao_id"), "cd_remessa").unionByName(
        ids.select((F.col("rem") + 9000000).alias("id"), (F.col("id") + 1).alias("conciliacao_id"), "cd_remessa")
    )
    base = (
        rows.filter("conta % 2 = 1")
        .groupBy("_p", "cd_remessa", "conta", "cd_lancamento", motive.alias("motivo_glosa"))
        .agg(F.min("id_registro").alias("id_registro"))
        .withColumn("id", F.expr("cast(conv(substr(id_registro, 1, 15), 16, 10) as bigint)"))
    )
    links = active.groupBy("_p", "cd_remessa").agg(F.max("rem").alias("conciliacao_remessa_id"))
    old = base.join(links, ["_p", "cd_remessa"], "left").withColumns(
        {
            "processo_controle_fatura_gab": F.col("_p"),
            "dt_recurso": F.expr("case when conta % 10 = 1 then date'2026-01-01' end"),
            "sn_ativo": F.expr("case when conta % 14 = 1 then 'false' else 'true' end"),
            "origem_registro": F.lit("triagem"),
        }
    )
    columns = [
        (F.col(c.name) if c.name in old.columns else F.lit(None)).cast(c.dataType).alias(c.name) for c in REGISTER.fields
    ]
    register = old.select(*columns)
    tracking = old.select(
        F.expr("case when conta % 5 = 0 then concat('antigo', id) else id_registro end").alias("id_registro"),
        F.col("id").alias("registro_glosa_id"),
        F.lit("antigo").alias(_CRITERION),
        F.lit(None).cast("timestamp_ntz").alias("data_importacao"),
    ).select(*TRACKING.fieldNames())
    return _linked_lines(f), conciliations, remittances, register, tracking


@query("deactivate_stale", _register_sql("select id, ativo sn_ativo from cleaned"))
def _deactivate(f):
    rows, _, _, register, tracking = _register_frames(f)
    return G.deactivate(register, G.stale_register_ids(tracking, rows)).select("id", "sn_ativo")


@query(
    "insert_missing",
    _register_sql(
        """select processo processo, cd_remessa, conta, cd_lancamento, motivo motivo_glosa, rem_id conciliacao_remessa_id, prestador, valor,
   case when rem_id is null then 'triagem' else 'conciliacao' end origem_registro,
   descricao || '. Valor glosado na origem: R$ ' || cast(glosa as varchar) descricao_glosa from fresh"""
    ),
)
def _insert_missing(f):
    rows, conciliations, remittances, register, tracking = _register_frames(f)
    cleaned = G.deactivate(register, G.stale_register_ids(tracking, rows))
    links = G.active_links(conciliations, remittances)
    fresh = G.new_register_rows(cleaned, G.missing_denials(cleaned, G.roll_up(rows), links), links, run_ts())
    return fresh.select(
        T.upper_trim("processo_controle_fatura_gab").alias("processo"),
        "cd_remessa",
        "conta",
        "cd_lancamento",
        "motivo_glosa",
        "conciliacao_remessa_id",
        "prestador",
        "valor",
        "origem_registro",
        "descricao_glosa",
    )


@query(
    "track_best",
    _register_sql(
        """select g.id_registro, c.id registro_glosa_id, g.criterio criterio_correspondencia from linked g
left join links l on l.processo = upper(trim(g.numero_processo)) and l.cd_remessa = g.cd_remessa
join cleaned c on c.processo = upper(trim(g.numero_processo)) and c.cd_remessa = g.cd_remessa and c.rem_id is not distinct from l.rem_id
 and c.conta = g.conta and c.cd_lancamento is not distinct from g.cd_lancamento and c.motivo is not distinct from nullif(trim(g.codigo_glosa), '')
 and c.ativo = 'true'
qualify row_number() over (partition by g.id_registro order by c.dt_recurso is not null, c.id) = 1"""
    ),
)
def _track(f):
    rows, conciliations, remittances, register, tracking = _register_frames(f)
    cleaned = G.deactivate(register, G.stale_register_ids(tracking, rows))
    return G.best_records(rows, G.active_links(conciliations, remittances), cleaned)


@query(
    "register_chain",
    _register_sql(
        """select processo, cd_remessa, conta, cd_lancamento, motivo motivo_glosa, rem_id conciliacao_remessa_id, ativo sn_ativo from cleaned
union all select processo, cd_remessa, conta, cd_lancamento, motivo, rem_id, 'true' from fresh"""
    ),
)
def _chain(f):
    register, _, _ = G.materialize_denials(*_register_frames(f), run_ts())
    return register.select(
        T.upper_trim("processo_controle_fatura_gab").alias("processo"),
        "cd_remessa",
        "conta",
        "cd_lancamento",
        "motivo_glosa",
        "conciliacao_remessa_id",
        "sn_ativo",
    )


@query(
    "track",
    _register_sql(
        """select t.id_registro, t.criterio, c.processo, c.cd_remessa, c.conta, c.cd_lancamento, c.motivo motivo_glosa, t.novo from (
  select g.id_registro, g.criterio, b.chave, true novo from linked g
  left join links l on l.processo = upper(trim(g.numero_processo)) and l.cd_remessa = g.cd_remessa
  join next_register b on b.processo = upper(trim(g.numero_processo)) and b.cd_remessa = g.cd_remessa and b.rem_id is not distinct from l.rem_id
   and b.conta = g.conta and b.cd_lancamento is not distinct from g.cd_lancamento and b.motivo is not distinct from nullif(trim(g.codigo_glosa), '') and b.ativo = 'true'
  qualify row_number() over (partition by g.id_registro order by b.dt_recurso is not null, b.ordem) = 1
  union all select t.id_registro, 'antigo', cast(t.registro_glosa_id as varchar), false from tracking t
  where t.id_registro not in (select g.id_registro from linked g
   left join links l on l.processo = upper(trim(g.numero_processo)) and l.cd_remessa = g.cd_remessa
   join next_register b on b.processo = upper(trim(g.numero_processo)) and b.cd_remessa = g.cd_remessa and b.rem_id is not distinct from l.rem_id
    and b.conta = g.conta and b.cd_lancamento is not distinct from g.cd_lancamento and b.motivo is not distinct from nullif(trim(g.codigo_glosa), '') and b.ativo = 'true')) t
 join next_register c on c.chave = t.chave"""
    ).replace(
        " select t.id_registro, t.criterio",
        """, next_register as materialized (select cast(id as varchar) chave, id ordem, processo, cd_remessa, conta, cd_lancamento, motivo, rem_id, dt_recurso, ativo from cleaned
 union all select 'novo' || row_number() over (), 9000000000000000000, processo, cd_remessa, conta, cd_lancamento, motivo, rem_id, null, 'true' from fresh) select t.id_registro, t.criterio""",
        1,
    ),
)
def _tracking(f):
    """The tracking table after the run: new and moved rows, and those of denials that were not seen."""
    register, tracking, _ = G.materialize_denials(*_register_frames(f), run_ts())
    record = register.select("id", T.upper_trim("processo_controle_fatura_gab").alias("processo"), "cd_remessa", "conta", "cd_lancamento", "motivo_glosa")
    seen = tracking.select("id_registro", F.col("registro_glosa_id").alias("id"), F.col(_CRITERION).alias("criterio"), F.col("data_importacao").isNotNull().alias("novo"))
    return seen.join(record, "id").drop("id")


@query(
    "register_counts",
    _register_sql(
        """select (select count(*) from cleaned where ativo <> sn_ativo) registros_desativados, (select count(*) from fresh) registros_glosa,
 (select count(*) from linked) rastreios"""
    ),
)
def _counts(f):
    return G.materialize_denials(*_register_frames(f), run_ts())[2]


__all__ = ["linked", "A"]
