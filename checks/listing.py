"""Incremental selection and issuance tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.frames import Frames, run_ts
from checks.fields import _IDENTITY_FIELDS, _IDENTITY_SQL
from checks.registry import query
from claimweave.functions import numbers as N
from claimweave.operators.ordered import running_number
from claimweave.plans import arguments as A
from claimweave.plans import incremental as J
from claimweave.plans import issuance as S
from claimweave.schemas import PROCESS_HISTORY
from claimweave.session import shared_folder
from claimweave.sources.tables import append_events, append_ledger, read_ledger


@query(
    "new_identities",
    f"""with r as ({_IDENTITY_SQL}) select o_orderkey from r where o_orderstatus <> 'F' and tipo is null
union all select min(o_orderkey) from r where o_orderstatus <> 'F' and tipo is not null
 and (tipo, a, b) not in (select (tipo, a, b) from r where o_orderstatus = 'F' and tipo is not null) group by tipo, a, b""",
)
def _new_identities(f):
    rows = f.t("orders").selectExpr("o_orderkey", "o_orderstatus", *_IDENTITY_FIELDS)
    incoming, existing = rows.filter("o_orderstatus <> 'F'"), rows.filter("o_orderstatus = 'F'")
    return J.new_invoices(incoming, existing, ["o_orderkey"]).select("o_orderkey")


@query(
    "new_references",
    """select distinct cast(date_trunc('month', l_shipdate) as date) referencia from lineitem
except select cast(date_trunc('month', o_orderdate) as date) from orders where o_orderpriority = '1-URGENT'""",
)
def _new_references(f):
    available = f.t("lineitem").select(F.trunc("l_shipdate", "month").alias("referencia"))
    loaded = f.t("orders").filter("o_orderpriority = '1-URGENT'").select(F.trunc("o_orderdate", "month").alias("referencia"))
    return J.new_references(available, loaded)


@query(
    "missing_references",
    """select distinct cast(date_trunc('month', l_shipdate) as date) referencia from lineitem
 where date_trunc('month', l_shipdate) not in (select date_trunc('month', o_orderdate) from orders)""",
)
def _missing(f):
    return J.missing_keys(
        f.t("lineitem").select(F.trunc("l_shipdate", "month").alias("referencia")),
        f.t("orders").select(F.trunc("o_orderdate", "month").alias("referencia")),
        "referencia",
    )


@query("distinct_keys", "select distinct cast(date_trunc('month', o_orderdate) as date) referencia, o_orderstatus from orders")
def _distinct(f):
    return f.t("orders").select(F.trunc("o_orderdate", "month").alias("referencia"), "o_orderstatus").distinct()


# A listing row per event: the process is named by user and event type group, its status by the event.
_STATUS = "case event_type when 'purchase' then 'FINALIZADO' when 'view' then 'Tramitando' when 'click' then 'TRAMITANDO' when 'error' then 'CANCELADO' else 'RASCUNHO' end"
_NUMBER = "'P' || (100000 + user_id * 10 + event_id % 7) || '/' || (2022 + user_id % 4)"
_LISTING_SQL = f"""listing as (select event_id, ts, {_NUMBER} numero_processo, {_STATUS} status_processo,
   event_id // 25 + 1 pagina, event_id % 25 posicao from events),
 ordered as (select *, row_number() over (partition by numero_processo order by pagina, posicao) n, count(*) over (partition by numero_processo) k from listing),
 state as (select numero_processo, lower(status_processo) status_processo, value_ok detalhes from (
   select numero_processo, status_processo, event_id % 2 = 0 value_ok, row_number() over (partition by numero_processo order by event_id desc) n
   from listing where status_processo <> 'CANCELADO') where n = 1),
 transitions as (select o.* from ordered o left join state s using (numero_processo)
   where n = 1 and (s.numero_processo is null or upper(s.status_processo) <> upper(o.status_processo)
     or (upper(o.status_processo) = 'FINALIZADO' and not s.detalhes)))"""


def _listing(f: Frames):
    return f.t("events").selectExpr(
        "event_id",
        "concat('P', 100000 + user_id * 10 + event_id % 7, '/', 2022 + user_id % 4) as numero_processo",
        f"{_STATUS} as status_processo",
        "cast(event_id div 25 + 1 as bigint) as pagina",
        "event_id % 25 as posicao",
    )


def _state(f: Frames):
    """Last known status per number, from the events that are no errors."""
    last = _listing(f).filter("status_processo <> 'CANCELADO'").groupBy("numero_processo").agg(
        F.max_by(F.struct("status_processo", "event_id"), "event_id").alias("u")
    )
    return last.select(
        "numero_processo",
        F.lower("u.status_processo").alias("status_processo"),
        (F.col("u.event_id") % 2 == 0).alias("detalhes_finalizados_extraidos"),
    )


def _transitions(f: Frames):
    return J.select_transitions(_listing(f), _state(f), ["pagina", "posicao"])


@query("transitions", f"with {_LISTING_SQL} select numero_processo, status_processo, event_id from transitions")
def _transitions_query(f):
    return _transitions(f).select("numero_processo", "status_processo", "event_id")


@query(
    "history",
    f"""with {_LISTING_SQL} select sha256(numero_processo || '|' || upper(status_processo)) id_status, numero_processo, max(novo) novo from (
 select numero_processo, status_processo, 0 novo from state union all select numero_processo, status_processo, 1 from transitions) group by 1, 2""",
)
def _history(f):
    old_ts = F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    history = J.history_rows(_state(f), old_ts).select(*PROCESS_HISTORY.fieldNames())
    merged = J.merge_history(history, _transitions(f), run_ts())
    return merged.select("id_status", "numero_processo", (F.col("observado_em") == run_ts()).cast("int").alias("novo"))


@query(
    "completion_flag",
    f"""with {_LISTING_SQL} select s.numero_processo, s.detalhes or d.numero_processo is not null detalhes from state s
 left join (select distinct numero_processo from transitions where status_processo = 'FINALIZADO') d using (numero_processo)""",
)
def _flag(f):
    done = J.pending_details(J.process_rows(_transitions(f), run_ts()))
    flagged = J.mark_details_done(_state(f), done)
    return flagged.select("numero_processo", F.col("detalhes_finalizados_extraidos").alias("detalhes"))


@query(
    "recheck_list",
    f"with {_LISTING_SQL} select numero_processo from state where upper(status_processo) = 'TRAMITANDO' and cast(right(numero_processo, 4) as int) >= 2024",
)
def _recheck(f):
    return J.recheck_list(_state(f)).select("numero_processo")


@query(
    "page_streak",
    f"""with {_LISTING_SQL}, quiet as (select distinct pagina from listing where pagina not in (select pagina from transitions)),
 stop as (select min(a.pagina) p from quiet a join quiet b on b.pagina = a.pagina - 1)
 select pagina, posicao, numero_processo from listing, stop where p is null or pagina <= p""",
)
def _streak(f):
    return J.pages_until_streak(_listing(f), _state(f)).select("pagina", "posicao", "numero_processo")


@query(
    "run_summary",
    f"""with {_LISTING_SQL}, found as (select distinct numero_processo from listing),
 failed as (select distinct numero_processo from listing where status_processo = 'CANCELADO')
select 'encontrado' situacao, numero_processo from found
union all select 'ja_carregado', numero_processo from found where numero_processo not in (select numero_processo from transitions)
union all select 'processado', numero_processo from transitions where numero_processo not in (select numero_processo from failed)
union all select 'com_erro', numero_processo from failed""",
)
def _summary(f):
    failed = _listing(f).filter("status_processo = 'CANCELADO'")
    return J.run_summary(_listing(f), _transitions(f), failed)


_OPENED = "case when o_orderkey % 50 = 0 then null else o_orderdate end"
_PROGRESS = "case o_orderstatus when 'F' then ' finalizado' when 'O' then 'TRAMITANDO ' else 'Rascunho' end"


@query(
    "ordered_selection",
    f"""select numero_processo, row_number() over (order by data_abertura desc nulls last, numero_processo) ordem
from (select 'P' || o_orderkey || '/' || (2022 + o_custkey % 8) numero_processo, {_PROGRESS} status, {_OPENED} data_abertura,
  2022 + o_custkey % 8 ano from orders)
where upper(trim(status)) in ('FINALIZADO', 'TRAMITANDO') and ano >= 2024""",
)
def _ordered(f):
    processes = f.t("orders").selectExpr(
        "concat('P', o_orderkey, '/', 2022 + o_custkey % 8) as numero_processo",
        f"{_PROGRESS} as status_processo",
        f"{_OPENED} as data_abertura",
    )
    queue = J.report_queue(processes)
    # Newest day first, undated last; the rank is counted day by day.
    day = F.coalesce(-F.unix_date(F.col("data_abertura").cast("date")), F.lit(2**31 - 1))
    ranked = running_number(queue.withColumn("_dia", day), [], [F.col("numero_processo")], "_dia", "ordem")
    return ranked.select("numero_processo", F.col("ordem").cast("bigint").alias("ordem"))


@query(
    "pending_unset_flag",
    """select o_orderkey from orders where o_orderstatus = 'F' and (o_orderkey % 3 = 0 or o_orderkey % 3 = 1)""",
)
def _pending(f):
    # The flag is unset, false or true.
    flag = "case o_orderkey % 3 when 0 then null when 1 then false else true end as detalhes_finalizados_extraidos"
    status = "case o_orderstatus when 'F' then 'Finalizado' else 'TRAMITANDO' end as status_processo"
    return J.pending_details(f.t("orders").selectExpr("o_orderkey", flag, status)).select("o_orderkey")


# --- issuance -------------------------------------------------------------

_REQ_CPF = "lpad(cast(c_custkey * 104729 % 1000000000 as string), 9, '0')"


def _sheet(f: Frames):
    """Request sheet with mixed header spellings; some rows are blank or break one rule."""
    return f.t("customer").selectExpr(
        "c_custkey + 2 as row_number",
        "case when c_custkey % 50 = 0 then '' else concat(' ', c_name, '  x') end as `Paciente`",
        "case when c_custkey % 50 = 0 then null else c_mktsegment end as `Local `",
        "case when c_custkey % 50 = 0 then '' when c_custkey % 11 = 0 then ' ' else 'EXAME' end as `tipo  atendimento`",
        f"case when c_custkey % 50 = 0 then '' when c_custkey % 3 = 0 then '529.982.247-25' else concat({_REQ_CPF}, '00') end as `CPF`",
        "case when c_custkey % 50 = 0 then '' else concat('R$ ', replace(cast(cast(c_acctbal as decimal(18,2)) as string), '.', ',')) end as `Valor`",
        "'' as `Rua`",
        "'' as `Número Casa`",
        "'' as `Bairro`",
        "case when c_custkey % 50 = 0 then '' else 'SOBRAL' end as `Cidade`",
        "case when c_custkey % 50 = 0 then '' when c_custkey % 13 = 0 then 'CEA' else 'CE' end as `UF`",
        "case when c_custkey % 50 = 0 then '' else concat('raio  x', char(10), char(10), ' mao ') end as `Tipo de Exame`",
        "'' as `E-mail`",
        "case when c_custkey % 50 = 0 then '' when c_custkey % 17 = 0 then '6000' else '60.000-000' end as `CEP`",
    ).withColumnRenamed("E-mail", "EMAIL")


@query(
    "request_validation",
    """with r as (select c_custkey, c_custkey + 2 row_number, trim(c_name) || ' x' paciente, 'raio x' || chr(13) || chr(10) || 'mao' tipo_exame,
  cast(c_acctbal as decimal(18,2)) valor from customer where c_custkey % 50 <> 0)
select cast(row_number as int) row_number, paciente, tipo_exame, valor,
 case when c_custkey % 11 = 0 then 'campos obrigatorios vazios: TIPO ATENDIMENTO' when c_custkey % 3 <> 0 and not ok then 'CPF invalido'
  when valor <= 0 then 'VALOR deve ser maior que zero' when c_custkey % 13 = 0 then 'UF invalida' when c_custkey % 17 = 0 then 'CEP invalido' end erro
from (select *, (list_sum([cast(substr(d, i, 1) as int) * (11 - i) for i in range(1, 10)]) * 10 % 11) % 10 = 0
   and (list_sum([cast(substr(d, i, 1) as int) * (12 - i) for i in range(1, 10)]) * 10 % 11) % 10 = 0 and d <> '000000000' ok
  from (select *, lpad(cast(c_custkey * 104729 % 1000000000 as varchar), 9, '0') d from r))""",
)
def _validation(f):
    rows = S.validate_requests(S.normalize_requests(_sheet(f)))
    return rows.select("row_number", "paciente", "tipo_exame", "valor", "erro")


def _issues(f: Frames):
    """One issue per order: the batch is the customer, the request is the order."""
    return f.t("orders").selectExpr(
        "o_orderkey as id",
        "o_custkey as lote_id",
        "o_orderkey as solicitacao_nota_id",
        "o_custkey % 9 as usuario_id",
        "case when o_orderpriority = '5-LOW' then '' else concat('1234567800', 1000 + o_custkey % 7) end as cnpj_emissor",
        "case o_orderstatus when 'F' then 'PENDENTE' when 'O' then 'PROCESSANDO' else case when o_orderpriority = '2-HIGH' then 'ERRO' else 'EMITIDA' end end as status",
        "cast(null as string) as numero_nfse",
        "cast(null as string) as protocolo",
        "case when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then concat('falha ', o_orderkey) end as erro",
    )


_ISSUE_STATUS = "case o_orderstatus when 'F' then 'PENDENTE' when 'O' then 'PROCESSANDO' else case when o_orderpriority = '2-HIGH' then 'ERRO' else 'EMITIDA' end end"


def _requests(f: Frames):
    joined = f.t("orders").join(f.t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr(
        "o_orderkey as id",
        "case when o_orderpriority = '5-LOW' then '98765432000199' end as cnpj_emissor",
        "concat('  ', c_name) as nm_paciente",
        "c_mktsegment as local",
        "'EXAME' as tipo_atendimento",
        "cast(o_orderkey as string) as codigo_atendimento",
        "'52998224725' as nr_cpf",
        "cast(cast(o_totalprice as decimal(18,2)) as string) as valor_nota",
        "'RUA A' as ds_endereco",
        "'1' as nr_endereco",
        "'CENTRO' as nm_bairro",
        "'' as nr_cep",
        "'' as ds_complemento",
        "'' as nr_fone",
        "case when o_orderpriority = '1-URGENT' then ' ' else 'Sobral' end as nm_cidade",
        "case when o_orderpriority = '1-URGENT' then '' else 'ce' end as sg_uf",
        "'raio x' as procedimento",
        "cast(o_orderdate as string) as data_criacao",
        "'' as email",
    )


def _workflow(f: Frames):
    return f.t("orders").selectExpr(
        "o_orderkey as solicitacao_nota_id",
        "case when o_orderpriority = '3-MEDIUM' then 'PENDENTE' else 'VALIDADA' end as validacao",
        "case when o_orderpriority = '2-HIGH' then 'NOVA' else 'EMISSAO_SOLICITADA' end as status",
    )


@query(
    "eligible_issuances",
    """select o_orderkey emissao_id, o_custkey lote_id, o_custkey % 9 usuario_id,
 case when o_orderpriority = '5-LOW' then '98765432000199' else '1234567800' || (1000 + o_custkey % 7) end cnpj, false conflito_cnpj
from orders where o_orderstatus = 'F' and o_orderpriority not in ('2-HIGH', '3-MEDIUM')""",
)
def _eligible(f):
    rows = S.eligible_issuances(_issues(f), _requests(f), _workflow(f))
    given = rows.withColumn("cnpj_payload", F.col("cnpj_emissor"))
    return S.choose_issuer(given).select("emissao_id", "lote_id", "usuario_id", "cnpj", "conflito_cnpj")


@query(
    "request_rows",
    """select cast(o_orderkey as int) row_number, c_name paciente, case when o_orderpriority = '1-URGENT' then 'CAUCAIA' else 'Sobral' end cidade, 'CE' uf,
 cast(o_totalprice as decimal(18,2)) valor from orders join customer on o_custkey = c_custkey
where o_orderstatus = 'F' and o_orderpriority not in ('2-HIGH', '3-MEDIUM')""",
)
def _request_rows(f):
    rows = S.request_rows(S.eligible_issuances(_issues(f), _requests(f), _workflow(f)), "CAUCAIA", "ce")
    return rows.select("row_number", "paciente", "cidade", "uf", "valor")


_BATCH_SQL = f"""i as (select o_orderkey id, o_custkey lote_id, {_ISSUE_STATUS} st,
 case when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then 'falha ' || o_orderkey end erro from orders)"""


@query(
    "batch_status",
    f"""with {_BATCH_SQL} select lote_id, count(*) total, count(*) filter (st = 'ERRO') erro, count(*) filter (st = 'EMITIDA') emitida,
 count(*) filter (st = 'PENDENTE') pendente, count(*) filter (st = 'PROCESSANDO') processando,
 case when count(*) filter (st = 'ERRO') = 0 and count(*) filter (st = 'EMITIDA') = count(*) then 'EMITIDA' else 'ERRO' end status_lote from i group by 1""",
)
def _batch(f):
    return S.batch_status(_issues(f))


@query(
    "error_digest",
    f"""with {_BATCH_SQL} select lote_id, string_agg('solicitacao=' || id || ': ' || erro, '; ' order by id) detalhes from (
 select *, row_number() over (partition by lote_id order by id) n from i where st = 'ERRO') where n <= 5 group by 1""",
)
def _digest(f):
    return S.error_digest(_issues(f))


def _batches(f: Frames):
    return f.t("customer").selectExpr(
        "c_custkey as id",
        "case when c_acctbal < 3000 then 'PENDENTE' when c_acctbal < 6000 then 'ERRO' else 'EMITIDA' end as status",
        "cast(null as string) as dag_run_id",
        "'antigo' as erro_disparo",
        "cast(null as timestamp_ntz) as airflow_disparado_em",
    )


@query(
    "start_batches",
    """select c_custkey id, case when c_mktsegment = 'BUILDING' and c_acctbal < 6000 then 'PROCESSANDO' when c_acctbal < 3000 then 'PENDENTE' when c_acctbal < 6000 then 'ERRO' else 'EMITIDA' end status,
 case when c_mktsegment = 'BUILDING' then 'run-1' end dag_run_id, case when c_mktsegment <> 'BUILDING' then 'antigo' end erro_disparo, c_mktsegment = 'BUILDING' disparado from customer""",
)
def _start(f):
    started = f.t("customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"), F.lit("run-1").alias("dag_run_id"))
    rows = S.start_batches(_batches(f), started, run_ts())
    return rows.select("id", "status", "dag_run_id", "erro_disparo", F.col("airflow_disparado_em").isNotNull().alias("disparado"))


@query(
    "finish_batches",
    f"""with {_BATCH_SQL}, s as (select lote_id, count(*) n, count(*) filter (st = 'ERRO') e, count(*) filter (st = 'EMITIDA') ok, count(*) filter (st = 'PENDENTE') p,
  count(*) filter (st = 'PROCESSANDO') w from i group by 1),
d as (select lote_id, string_agg('solicitacao=' || id || ': ' || erro, '; ' order by id) t from (
 select *, row_number() over (partition by lote_id order by id) n from i where st = 'ERRO') where n <= 5 group by 1)
select c_custkey id, case when n is not null and e = 0 and ok = n then 'EMITIDA' else 'ERRO' end status,
 case when n is not null and e = 0 and ok = n then null else substr('dag_run_id=run-2; ' || case when coalesce(e, 0) > 0 then t else
  'lote terminou com ' || coalesce(p, 0) || ' item(ns) pendente(s) e ' || coalesce(w, 0) || ' item(ns) em processamento.' end, 1, 1000) end erro_disparo
from customer left join s on s.lote_id = c_custkey left join d on d.lote_id = c_custkey""",
)
def _finish(f):
    runs = f.t("customer").select(F.col("c_custkey").alias("id"), F.lit("run-2").alias("dag_run_id"))
    return S.finish_batches(_batches(f), _issues(f), runs).select("id", "status", "erro_disparo")


def _outcomes(f: Frames):
    """An outcome for every issue, also for those that may not change any more."""
    return f.t("orders").selectExpr(
        "o_orderkey as emissao_id",
        "o_totalprice > 200000 as sucesso",
        "case when o_totalprice > 200000 then cast(o_orderkey + 7 as string) end as numero_nfse",
        "cast(null as string) as protocolo",
        "case when o_totalprice <= 200000 then concat('erro ', repeat('x', cast(o_orderkey % 2000 as int))) end as erro",
    )


@query(
    "apply_outcomes",
    f"""select o_orderkey id, case when o_orderstatus = 'O' then case when o_totalprice > 200000 then 'EMITIDA' else 'ERRO' end else {_ISSUE_STATUS} end status,
 case when o_orderstatus = 'O' and o_totalprice > 200000 then cast(o_orderkey + 7 as varchar) end numero_nfse,
 case when o_orderstatus = 'O' and o_totalprice <= 200000 then substr('erro ' || repeat('x', o_orderkey % 2000), 1, 1000)
  when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then 'falha ' || o_orderkey end erro from orders""",
)
def _apply(f):
    return S.apply_outcomes(_issues(f), _workflow(f), _outcomes(f), run_ts())[0].select("id", "status", "numero_nfse", "erro")


@query(
    "workflow_outcomes",
    """select o_orderkey solicitacao_nota_id, case when o_orderpriority = '2-HIGH' then 'NOVA' when o_totalprice > 200000 then 'EMITIDA' else 'ERRO_EMISSAO' end status from orders""",
)
def _workflow_outcomes(f):
    return S.apply_outcomes(_issues(f), _workflow(f), _outcomes(f), run_ts())[1].select("solicitacao_nota_id", "status")


@query(
    "append_events",
    """select o_orderkey solicitacao_nota_id, o_custkey % 9 usuario_id, case when o_totalprice > 200000 then 'NFSE_EMITIDA' else 'ERRO_EMISSAO' end tipo_acao,
 substr(case when o_totalprice > 200000 then 'NFS-e ' || (o_orderkey + 7) || ' emitida. dag_run_id=r; pdf=nfse-' || (o_orderkey + 7) || '.pdf'
  else 'Falha na emissao. dag_run_id=r; erro=erro ' || repeat('x', o_orderkey % 2000) end, 1, 500) observacao from orders""",
)
def _events(f):
    """Appended in two calls to a table that does not exist before, and read back."""
    path = f"{shared_folder(f.spark)}/eventos-{uuid.uuid4().hex}"
    events = S.outcome_events(_issues(f), _outcomes(f), "r")
    append_events(events.filter("tipo_acao = 'NFSE_EMITIDA'"), path)
    append_events(events.filter("tipo_acao <> 'NFSE_EMITIDA'"), path)
    return f.spark.read.parquet(path)


@query(
    "failed_workflow",
    """select o_orderkey solicitacao_nota_id, case when o_orderpriority = '2-HIGH' then 'NOVA' when o_orderstatus = 'P' then 'ERRO_EMISSAO' else 'EMISSAO_SOLICITADA' end status from orders""",
)
def _failed(f):
    failed = f.t("orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("solicitacao_nota_id"))
    return S.fail_workflow(_workflow(f), failed).select("solicitacao_nota_id", "status")


@query(
    "artifacts",
    """select doc_id emissao_nfse_id, 'nfse-' || n_chars || '.pdf' nome_arquivo, 'application/pdf' tipo_mime, cast(strlen('%PDF' || text) as bigint) tamanho_bytes,
 sha256('%PDF' || text) sha256 from documents where lang <> 'de'""",
)
def _artifacts(f):
    files = f.t("documents").select(
        F.col("doc_id").alias("emissao_nfse_id"),
        F.col("n_chars").cast("string").alias("numero_nfse"),
        F.encode(F.concat(F.when(F.col("lang") == "de", "<html>").otherwise("%PDF"), "text"), "UTF-8").alias("content"),
    )
    return S.artifact_rows(files)[0].drop("conteudo")


@query(
    "issued_ledger",
    """select c_custkey + 2 row_number from customer where c_custkey % 50 <> 0 and not (c_acctbal > 5000 and c_mktsegment <> 'BUILDING')""",
)
def _ledger(f):
    """A ledger file of appended successes and failures with broken lines in between, read back."""
    path = f"{shared_folder(f.spark)}/livro-{uuid.uuid4().hex}"
    rows = S.normalize_requests(_sheet(f))
    hashed = rows.withColumn("h", S.request_hash(rows)).select("row_number", "h")
    keyed = hashed.join(f.t("customer"), F.col("row_number") == F.col("c_custkey") + 2)
    status = F.when(F.col("c_mktsegment") == "BUILDING", "failure").otherwise("success").alias("status")
    append_ledger(keyed.filter("c_acctbal > 5000").select(status, F.col("h").alias("row_hash")), path)
    keyed.filter("c_acctbal <= 5000").select(F.concat(F.lit('{"status": "success", "row_hash": '), "h")).write.mode("append").text(path)
    return S.unissued(rows, read_ledger(f.spark, path)).select(F.col("row_number").cast("bigint").alias("row_number"))


@query(
    "row_selection",
    """select 'todas' modo, c_custkey + 2 row_number from customer where c_custkey % 50 <> 0
union all select 'linha', c_custkey + 2 from customer where c_custkey = 15
union all select 'limite', r from (select c_custkey + 2 r from customer where c_custkey % 50 <> 0 order by 1 limit 10)""",
)
def _selection(f):
    """All rows of the sheet, one row by its number, and the first ten."""
    rows = S.normalize_requests(_sheet(f))
    modes = {"todas": {"all_rows": True}, "linha": {"row_number": 17}, "limite": {"all_rows": True, "limit": 10}}
    parts = [S.select_requests(rows, **how).select(F.lit(mode).alias("modo"), F.col("row_number").cast("bigint").alias("row_number")) for mode, how in modes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "artifact_upsert",
    """select doc_id emissao_nfse_id, case when doc_id % 3 = 0 then 'nfse-' || (n_chars + 1) else 'nfse-' || n_chars end || '.pdf' nome_arquivo, false rejeitado
 from documents where lang <> 'de' or doc_id % 3 = 0
union all select doc_id, cast(n_chars as varchar), true from documents where lang = 'de'""",
)
def _artifact_upsert(f):
    """A first load, then a second one that replaces every third file; what is no document is rejected."""
    docs = f.t("documents")

    def files(rows, more: int, head):
        content = F.encode(F.concat(head, "text"), "UTF-8")
        return rows.select(F.col("doc_id").alias("emissao_nfse_id"), (F.col("n_chars") + more).cast("string").alias("numero_nfse"), content.alias("content"))

    first, rejects = S.artifact_rows(files(docs, 0, F.when(F.col("lang") == "de", "<html>").otherwise("%PDF")))
    second, _ = S.artifact_rows(files(docs.filter("doc_id % 3 = 0"), 1, F.lit("%PDF")))
    kept = S.upsert_artifacts(first, second).select("emissao_nfse_id", "nome_arquivo", F.lit(False).alias("rejeitado"))
    return kept.unionByName(rejects.select("emissao_nfse_id", F.col("numero_nfse").alias("nome_arquivo"), F.lit(True).alias("rejeitado")))


@query(
    "issuer_choice",
    """select o_orderkey emissao_id, case when o_orderkey % 3 = 0 then '12345678000195' when o_orderkey % 5 = 0 then '98765432000110' else '11222333000181' end cnpj,
 o_orderkey % 15 = 0 conflito_cnpj from orders""",
)
def _issuer(f):
    """The table's issuer, the payload's or the default, and where the first two differ."""
    rows = f.t("orders").selectExpr(
        "o_orderkey as emissao_id",
        "case when o_orderkey % 3 = 0 then '12.345.678/0001-95' end as cnpj_emissor",
        "case when o_orderkey % 5 = 0 then '98765432000110' when o_orderkey % 3 = 0 then '12345678000195' end as cnpj_payload",
    )
    return S.choose_issuer(rows, default="11222333000181").select("emissao_id", "cnpj", "conflito_cnpj")


_RUN_ERRORS = (
    "cnpj e numero_nfse sao informados juntos",
    "uma nota nao se combina com competencia ou periodo",
    "cnpj tem 14 digitos",
    "numero_nfse tem de 1 a 15 digitos",
    None,
    None,
    "competencia invalida",
    "inicio e fim sao informados juntos",
    "inicio e fim tem o mesmo formato",
    None,
    "fim nao vem antes de inicio",
    None,
)


@query(
    "argument_rules",
    """select o_orderkey id, case o_orderkey % 12 """
    + " ".join(f"when {i} then '{e}'" for i, e in enumerate(_RUN_ERRORS) if e)
    + """ end erro, cast(case o_orderkey % 12 when 5 then 1 when 11 then 1 when 9 then case when cast(o_orderdate as date) > date '1997-03-10' then 0 else
  len(generate_series(cast(date_trunc('month', o_orderdate) as timestamp), cast(least(cast(o_orderdate as date) + cast(o_custkey % 60 as int), date '1997-03-10') as timestamp), interval 1 month)) end
 else 0 end as bigint) periodos from orders""",
)
def _arguments(f):
    cnpj, day = "'12.345.678/0001-95'", "date_format(o_orderdate, 'dd/MM/yyyy')"
    cases = {
        "cnpj": {0: cnpj, 1: cnpj, 2: "'12.345.678/0001-9'", 3: cnpj, 4: cnpj},
        "numero_nfse": {1: "'7'", 2: "'7'", 3: "'x1'", 4: "cast(o_orderkey as string)"},
        "competencia": {1: "'06/2026'", 5: "'Junho, 2026'", 6: "'2026/06'", 11: "' '"},
        "inicio": {7: day, 8: day, 9: day, 10: "'07/2026'"},
        "fim": {8: "'07/2026'", 9: "date_format(date_add(cast(o_orderdate as date), cast(o_custkey % 60 as int)), 'yyyy-MM-dd')", 10: "'2026-06'"},
    }
    columns = [f"case o_orderkey % 12 {' '.join(f'when {k} then {v}' for k, v in own.items())} end as {name}" for name, own in cases.items()]
    checked = A.validate_extractions(f.t("orders").selectExpr("o_orderkey as id", *columns))
    periods = A.extraction_periods(checked, F.lit("1997-03-10").cast("date")).groupBy("id").agg(F.count("*").alias("periodos"))
    return checked.join(periods, "id", "left").select("id", "erro", F.coalesce("periodos", F.lit(0)).cast("bigint").alias("periodos"))


@query(
    "batch_arguments",
    """select o_orderkey id, case o_orderkey % 9 when 0 then 'lote_id e um inteiro positivo' when 1 then 'solicitacao_ids nao e vazio' when 2 then 'solicitacao_ids tem inteiros positivos'
 when 3 then 'solicitacao_ids nao se repetem' when 4 then 'cnpj_por_solicitacao tem um id invalido' when 5 then 'cnpj_por_solicitacao tem um id fora do lote'
 when 6 then 'cnpj_por_solicitacao tem um cnpj invalido' when 7 then 'cnpj_por_solicitacao informa todos os itens' end erro from orders""",
)
def _batch_arguments(f):
    good = "'12.345.678/0001-95'"
    runs = f.t("orders").selectExpr(
        "o_orderkey as id",
        "case o_orderkey % 9 when 0 then 0L else o_custkey + 1 end as lote_id",
        "case o_orderkey % 9 when 1 then cast(array() as array<bigint>) when 2 then array(1L, -1L) when 3 then array(4L, 4L) else array(o_orderkey, o_orderkey + 1) end as solicitacao_ids",
        f"case o_orderkey % 9 when 4 then map('x', {good}) when 5 then map('0', {good}) when 6 then map(cast(o_orderkey as string), '12')"
        f" when 7 then map(cast(o_orderkey as string), {good}) when 8 then map(cast(o_orderkey as string), {good}, cast(o_orderkey + 1 as string), {good}) end as cnpj_por_solicitacao",
    )
    return A.validate_batches(runs).select("id", "erro")


@query(
    "failed_batch",
    f"""with i as (select o_orderkey id, o_custkey lote, {_ISSUE_STATUS} st, case when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then 'falha ' || o_orderkey end erro,
  case when o_orderpriority = '2-HIGH' then 'NOVA' else 'EMISSAO_SOLICITADA' end fluxo from orders),
h as (select *, lote = 1 and st = 'PROCESSANDO' caiu from i)
select 'emissao' tabela, id, case when caiu then 'ERRO' else st end status, case when caiu then 'dag_run_id=r9; erro=caiu' else erro end erro from h
union all select 'fluxo', id, case when caiu and fluxo = 'EMISSAO_SOLICITADA' then 'ERRO_EMISSAO' else fluxo end, null from h
union all select 'lote', c_custkey, case when c_custkey = 1 and c_acctbal < 6000 then 'ERRO' when c_custkey = 1 then 'ERRO' when c_acctbal < 3000 then 'PENDENTE' when c_acctbal < 6000 then 'ERRO' else 'EMITIDA' end,
 case when c_custkey = 1 then 'dag_run_id=r9; erro=caiu' else 'antigo' end from customer""",
)
def _failed_batch(f):
    """A run of one batch breaks: its issues in work, their workflow rows and the batch become errors."""
    batches = _batches(f).withColumn("status", F.when(F.col("id") == 1, "PENDENTE").otherwise(F.col("status")))
    batches, issues, workflow = S.fail_batch(batches, _issues(f), _workflow(f), 1, "r9", "caiu")
    parts = [issues.select(F.lit("emissao").alias("tabela"), "id", "status", "erro")]
    parts.append(workflow.select(F.lit("fluxo").alias("tabela"), F.col("solicitacao_nota_id").alias("id"), "status", F.lit(None).cast("string").alias("erro")))
    parts.append(batches.select(F.lit("lote").alias("tabela"), "id", "status", F.col("erro_disparo").alias("erro")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "invoice_names",
    """select o_orderkey, rtrim(substr(o_orderkey || ' - Sala-' || o_custkey || ', ' || o_orderpriority || ' e ' ||
 case when o_orderkey % 5 = 0 then repeat('Ana ', 80) || 'B' when o_orderkey % 7 = 0 then 'SEM INFORMACAO' else 'Ana-' || o_custkey end, 1, 230)) || '.pdf' nome from orders""",
)
def _invoice_names(f):
    """Names of invoice files: unsafe characters, blanks, a blank patient and one that is too long."""
    rows = f.t("orders").selectExpr(
        "o_orderkey",
        "cast(o_orderkey as string) as numero",
        "concat('Sala/', o_custkey, ' .') as sala",
        "o_orderpriority",
        "case when o_orderkey % 5 = 0 then concat(repeat('Ana  ', 80), 'B') when o_orderkey % 7 = 0 then ' . ' else concat(' Ana\t', o_custkey) end as paciente",
    )
    return rows.select("o_orderkey", S.invoice_file_name("numero", "sala", "o_orderpriority", "paciente").alias("nome"))


__all__ = ["N"]
