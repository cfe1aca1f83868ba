"""Column functions, identity, merges, report table upkeep, periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.frames import sql
from checks.registry import query
from claimweave.functions import dates as D
from claimweave.functions import identity as I
from claimweave.functions import numbers as N
from claimweave.functions import text as T
from claimweave.operators import merge as K
from claimweave.operators.ordered import running_number
from claimweave.plans import report_table as U
from claimweave.sources import cards as P


#: Tasks that read the amounts, however few files the rows came from.
_SPREAD = 64


@query(
    "norm_keys",
    """select c_custkey, upper(trim(' ' || lower(c_name) || '  ')) chave, regexp_replace(c_name, '[^0-9]', '', 'g') digitos,
 ltrim(regexp_replace(c_name, '[^0-9]', '', 'g'), '0') sem_zeros, trim(regexp_replace(c_mktsegment || '  ' || c_name || chr(10), '\\s+', ' ', 'g')) compacto,
 lower(c_mktsegment) dobrado from customer""",
)
def _norm(f):
    return f.t("customer").select(
        "c_custkey",
        T.norm_key(F.concat(F.lit(" "), F.lower("c_name"), F.lit("  "))).alias("chave"),
        T.digits("c_name").alias("digitos"),
        T.strip_zeros("c_name").alias("sem_zeros"),
        T.squash(F.concat("c_mktsegment", F.lit("  "), "c_name", F.lit("\n"))).alias("compacto"),
        T.fold("c_mktsegment").alias("dobrado"),
    )


@query(
    "text_folding",
    """select doc_id, lower(strip_accents(text)) dobrado, length(trim(regexp_replace(text, '[\\s]+', ' ', 'g'))) tamanho from documents""",
)
def _fold(f):
    return f.t("documents").select(
        "doc_id", T.fold("text").alias("dobrado"), F.length(T.squash("text")).cast("bigint").alias("tamanho")
    )


@query(
    "money_round",
    """select line_id, price extrato, price documento, -price negativo, price pedido, cast(round(cast(l_quantity as decimal(18,4)) / 4, 2) as decimal(18,2)) quarto
from (select md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice*100) as bigint))) line_id,
 cast(l_extendedprice as decimal(18,2)) price, l_quantity from lineitem)""",
)
def _money(f):
    base = f.t("lineitem").repartition(_SPREAD).selectExpr(
        "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice*100) as bigint))) as line_id",
        "cast(l_extendedprice as decimal(18,2)) as price",
        "l_quantity",
    )
    # 1234567.80 rendered as 1.234.567,80, as R$ text and in parentheses, then parsed back.
    whole, cents = F.split_part(F.col("price").cast("string"), F.lit("."), F.lit(1)), F.split_part(
        F.col("price").cast("string"), F.lit("."), F.lit(2)
    )
    grouped = F.regexp_replace(whole, r"(\d)(?=(\d{3})+$)", "$1.")
    brazilian = F.concat(grouped, F.lit(","), cents)
    return base.select(
        "line_id",
        N.parse_statement_number(brazilian).alias("extrato"),
        N.parse_document_number(F.concat(F.lit("R$ "), brazilian)).alias("documento"),
        N.parse_document_number(F.concat(F.lit("("), brazilian, F.lit(")"))).alias("negativo"),
        N.parse_request_number(F.concat(F.lit("R$"), brazilian)).alias("pedido"),
        N.money(F.col("l_quantity").cast("decimal(18,4)") / 4).alias("quarto"),
    )


@query(
    "amount_limits",
    """select line_id, case when k <= 16 then cast(repeat('9', k) as decimal(18,2)) end extrato, k > 16 extrato_ruim, case when k <= 16 then cast(repeat('9', k) as decimal(18,2)) end documento,
 k > 16 documento_ruim, cast(l_orderkey + 0.33 as decimal(18,2)) pedido
from (select md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice*100) as bigint))) line_id, l_orderkey, l_linenumber + 12 k from lineitem)""",
)
def _limits(f):
    base = f.t("lineitem").repartition(_SPREAD).selectExpr(
        "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice*100) as bigint))) as line_id",
        "concat(repeat('9', cast(l_linenumber + 12 as int)), ',00') as grande",
        # a dot far behind the comma
        "concat(l_orderkey, ',', repeat('3', 31), '.5') as longo",
    )
    return base.select(
        "line_id",
        N.parse_statement_number("grande").alias("extrato"),
        N.bad_statement_number("grande").alias("extrato_ruim"),
        N.parse_document_number("grande").alias("documento"),
        N.bad_document_number("grande").alias("documento_ruim"),
        N.parse_request_number("longo").alias("pedido"),
    )


@query(
    "safe_account_cast",
    """select doc_id, case when length(d) between 1 and 18 then cast(d as bigint) end conta, case when length(n) between 1 and 18 then cast(n as bigint) end tamanho
from (select doc_id, n_chars, regexp_replace(text, '[^0-9]', '', 'g') d, cast(n_chars as varchar) n from documents)""",
)
def _account(f):
    return f.t("documents").select(
        "doc_id",
        N.safe_account("text").alias("conta"),
        N.safe_account(F.col("n_chars").cast("string")).alias("tamanho"),
    )


@query(
    "month_labels",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m') ano_mes, strftime(o_orderdate, '%m/%Y') mes_ano, cast(date_trunc('month', o_orderdate) as date) mes,
 cast(o_orderdate as date) dia_extrato, cast(o_orderdate as date) dia_documento, cast(date_trunc('month', o_orderdate) as date) mes_nome,
 cast(date_trunc('month', o_orderdate) as date) mes_xml, cast(date_trunc('month', o_orderdate) as date) mes_documento,
 case when o_orderkey % 5 > 0 then cast(o_orderdate as date) end dia_pedido, case when o_orderkey % 5 > 0 then cast(date_trunc('month', o_orderdate) as date) end mes_referencia from orders""",
)
def _months(f):
    names = F.array(*[F.lit(x) for x in ("janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro").split()])
    day = F.col("o_orderdate")
    return f.t("orders").select(
        "o_orderkey",
        D.year_month(day).alias("ano_mes"),
        D.month_year(day).alias("mes_ano"),
        D.month_start(day).alias("mes"),
        D.parse_statement_date(F.date_format(day, "dd/MM/yyyy")).alias("dia_extrato"),
        D.parse_document_date(F.date_format(day, "d//M/yyyy")).alias("dia_documento"),
        D.parse_month(F.concat(F.initcap(F.get(names, F.month(day) - 1)), F.lit(", "), F.year(day).cast("string"))).alias("mes_nome"),
        D.parse_xml_month(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")).alias("mes_xml"),
        D.parse_document_month(F.concat(F.lit("comp "), F.date_format(day, "MM-yyyy"))).alias("mes_documento"),
        D.parse_request_date(F.concat(F.lit(" "), F.date_format(day, "d/M/yyyy"), F.when(F.col("o_orderkey") % 5 == 0, "x").otherwise(""))).alias("dia_pedido"),
        D.parse_reference(F.concat(F.when(F.col("o_orderkey") % 5 == 0, "1").otherwise(""), F.date_format(day, "MM/yyyy"))).alias("mes_referencia"),
    )


@query(
    "surrogate_ids",
    """select c_custkey, md5(concat_ws(chr(31), cast(c_custkey as varchar), c_mktsegment, coalesce(cast(nullif(c_nationkey, 0) as varchar), chr(0)))) chave,
 sha256('P' || c_custkey || '/2024|' || upper(c_mktsegment)) id_status from customer""",
)
def _surrogate(f):
    rows = f.t("customer").withColumn("pais", F.nullif(F.col("c_nationkey"), F.lit(0)))
    number = F.concat(F.lit("P"), F.col("c_custkey").cast("string"), F.lit("/2024"))
    return rows.select(
        "c_custkey", I.row_digest(["c_custkey", "c_mktsegment", "pais"]).alias("chave"), I.status_id(number, F.lower("c_mktsegment")).alias("id_status")
    )


@query(
    "fingerprints",
    """select o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":' ||
 case when o_orderkey % 3 = 0 then 'null' else '"' || o_orderpriority || '"' end || ',"o_orderstatus":"' || o_orderstatus || '"}') impressao from orders""",
)
def _fingerprints(f):
    """Keys sorted, whatever the order of the columns; a null is part of the print."""
    rows = f.t("orders").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")))
    return rows.select("o_orderkey", I.fingerprint(["o_orderstatus", "o_orderpriority", "o_orderkey", "o_custkey"]).alias("impressao"))


@query(
    "occurrence_ids",
    """select fp, n ocorrencia, sha256(fp || ':' || n) id_registro from (
 select sha256(concat_ws(chr(31), l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m'))) fp,
  row_number() over (partition by l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m') order by l_orderkey, l_linenumber, l_partkey, l_suppkey) n
 from lineitem)""",
)
def _occurrences(f):
    month = D.year_month("l_shipdate")
    lines = f.t("lineitem").withColumn("fp", F.sha2(I.canonical_text(["l_returnflag", "l_linestatus", month]), 256))
    # Blocks follow the first order column, so a print that covers a third of the rows is
    # numbered in many tasks.
    blocks = lines.withColumn("_bloco", F.expr("l_orderkey div 1000")).withColumn("_faixa", F.expr("_bloco div 64"))
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    numbered = running_number(blocks, ["fp"], order, "_bloco", "ocorrencia", outer="_faixa")
    return numbered.select("fp", F.col("ocorrencia").cast("bigint").alias("ocorrencia"), I.occurrence_id("fp", "ocorrencia").alias("id_registro"))


_COMPACT = "case when o_orderkey % 3 = 0 then o_custkey || ' ' || o_orderkey when o_orderkey % 3 = 1 then '1 ' || o_custkey || '  ' || o_orderkey else 'c' || o_orderkey end"


@query(
    "split_identifiers",
    """select o_orderkey, case when o_orderkey % 5 <> 0 and o_orderkey % 3 < 2 then cast(o_custkey as varchar) else """
    + _COMPACT.replace("||", "||")
    + """ end numero_conta, case when o_orderkey % 5 = 0 then 7 when o_orderkey % 3 < 2 then o_orderkey end cd_atendimento from orders""",
)
def _split(f):
    rows = f.t("orders").selectExpr(
        "o_orderkey",
        f"{_COMPACT} as numero_conta",
        "cast(case when o_orderkey % 5 = 0 then 7 end as bigint) as cd_atendimento",
    )
    return U.repair_identifiers(rows)


@query(
    "sector_names",
    """select doc_id, case source_n when 0 then 'ipm/saudecogestao' when 1 then 'ipm/saudecogestao' when 2 then 'ipm/nuexo' else 'ipm/' || lang || source end setor,
 case when source_n in (0, 1) then lang not in ('de', 'en') when source_n = 2 then lang <> 'fr' else false end alvo,
 lang = 'en' relatorio
from (select *, cast(substr(source, 4) as int) % 4 source_n from documents)""",
)
def _sectors(f):
    docs = f.t("documents").selectExpr(
        "*", "cast(substr(source, 4) as int) % 4 as n"
    )
    shown = docs.selectExpr(
        "doc_id",
        "case n when 0 then ' IPM / Saúde Cogestão ' when 1 then 'IPM/CO-GESTORA/' when 2 then 'Ipm/NUEXO' else concat('IPM/', lang, source) end as setor",
        "case lang when 'de' then 'DESPACHO nº 1.pdf' when 'en' then concat('Relatório_', doc_id, '_', n_chars, '.PDF')"
        " when 'fr' then 'Certidão Negativa.pdf' else 'Resumo.pdf' end as nome",
    )
    canonical = shown.withColumn("canonico", P.canonical_sector("setor"))
    return canonical.select(
        "doc_id",
        F.col("canonico").alias("setor"),
        P.is_target_document(F.col("canonico"), F.col("nome")).alias("alvo"),
        P.is_report_document("nome").alias("relatorio"),
    )


@query(
    "tax_rate",
    """select l_orderkey, l_linenumber, l_partkey, case when t > 1 then printf('%.4f', cast(t as double) / 100) else printf('%.4f', cast(t as double)) end taxa, 'x' || l_returnflag texto
from (select *, cast(round(l_tax * 100) as bigint) * cast(l_quantity as bigint) t from lineitem)""",
)
def _tax(f):
    scaled = F.expr("cast(round(l_tax * 100) as bigint) * cast(l_quantity as bigint)")
    return f.t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        N.tax_rate(F.concat(scaled.cast("string"), F.lit(",0"))).alias("taxa"),
        N.tax_rate(F.concat(F.lit("x"), "l_returnflag")).alias("texto"),
    )


_IDENTITY_FIELDS = (
    "case when o_orderkey % 3 = 0 then concat(' ab', o_orderkey % 700, ' ') else '' end as codigo_verificacao_nfse",
    "case when o_orderkey % 7 = 0 then null else concat('12.345.678/0001-', 10 + o_custkey % 80) end as prestador_cnpj",
    "concat('000', o_orderkey % 900) as numero_nfse",
)
_IDENTITY_SQL = """select o_orderkey, case when o_orderkey % 3 = 0 then 'codigo_verificacao_nfse' when o_orderkey % 7 <> 0 then 'prestador_numero_nfse' end tipo,
 case when o_orderkey % 3 = 0 then 'AB' || (o_orderkey % 700) when o_orderkey % 7 <> 0 then '123456780001' || (10 + o_custkey % 80) end a,
 case when o_orderkey % 3 = 0 then '' when o_orderkey % 7 <> 0 then cast(o_orderkey % 900 as varchar) end b, o_orderstatus from orders"""


@query("invoice_identity", f"select o_orderkey, tipo, a, b from ({_IDENTITY_SQL})")
def _identity(f):
    rows = f.t("orders").selectExpr("o_orderkey", *_IDENTITY_FIELDS)
    return rows.select(
        "o_orderkey", I.invoice_identity("codigo_verificacao_nfse", "prestador_cnpj", "numero_nfse").alias("i")
    ).select("o_orderkey", "i.tipo", "i.a", "i.b")


_CPF = "lpad(cast((o_orderkey * 7919 + o_custkey) % 1000000000 as varchar), 9, '0')"


@query(
    "cpf_check",
    f"""with d as (select o_orderkey, {_CPF} || (10 + o_custkey % 90) cpf from orders),
s as (select *, list_sum([cast(substr(cpf, i, 1) as int) * (11 - i) for i in range(1, 10)]) s1, list_sum([cast(substr(cpf, i, 1) as int) * (12 - i) for i in range(1, 11)]) s2 from d)
select o_orderkey, cpf, (s1 * 10 % 11) % 10 = cast(substr(cpf, 10, 1) as int) and (s2 * 10 % 11) % 10 = cast(substr(cpf, 11, 1) as int)
  and not regexp_matches(cpf, '^(0+|1+|2+|3+|4+|5+|6+|7+|8+|9+)$') valido from s""",
)
def _cpf(f):
    rows = f.t("orders").selectExpr(
        "o_orderkey", "concat(lpad(cast((o_orderkey * 7919 + o_custkey) % 1000000000 as string), 9, '0'), 10 + o_custkey % 90) as cpf"
    )
    return rows.withColumn("valido", N.is_valid_cpf("cpf"))


@query(
    "default_chain",
    sql("""select line_id, coalesce(nullif(pf, ''), '-') codigo, coalesce(nullif(pf, ''), tuss) primeiro, coalesce(nullif(tuss, ''), pf) segundo,
 coalesce(nullif(pf, ''), 'Item do demonstrativo IPM') || '. Valor glosado na origem: R$ ' || cast(price as varchar) texto, p_name from (
 select line_id, pf0 pf, upper(tuss0) tuss, price, p_name from lines join part on p_partkey = l_partkey)""", "lines"),
)
def _defaults(f):
    rows = f.lines().join(f.t("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    pf, tuss = F.col("pf"), F.upper("tuss")
    return rows.select(
        "line_id",
        F.coalesce(T.blank_to_null(pf), F.lit("-")).alias("codigo"),
        F.coalesce(T.blank_to_null(pf), tuss).alias("primeiro"),
        F.coalesce(T.blank_to_null(tuss), pf).alias("segundo"),
        F.concat(
            F.coalesce(T.blank_to_null(pf), F.lit("Item do demonstrativo IPM")), F.lit(". Valor glosado na origem: R$ "), F.col("price").cast("string")
        ).alias("texto"),
        "p_name",
    )


@query(
    "format_fields",
    """select c_custkey, substr(d, 1, 3) || '.' || substr(d, 4, 3) || '.' || substr(d, 7, 3) || '-' || substr(d, 10) cpf,
 replace(cast(cast(c_acctbal as decimal(18,2)) as varchar), '.', ',') valor,
 case c_custkey % 3 when 0 then '(85)3' || substr(d, 9, 3) || '-' || substr(d, 8, 4) when 1 then '(85)9' || substr(d, 9, 3) || '-' || substr(d, 7, 5) else '' end fone,
 'Customer-' || substr(c_name, 10) || ' - ' || c_mktsegment arquivo, substr('erro ' || c_name || ' ' || c_name, 1, 30) erro
from (select *, lpad(cast(c_custkey as varchar), 11, '0') d from customer)""",
)
def _formats(f):
    rows = f.t("customer").withColumn("d", F.lpad(F.col("c_custkey").cast("string"), 11, "0"))
    phone = F.expr(
        "case c_custkey % 3 when 0 then concat('+55 (85) 3', substr(d, 9, 3), '-', substr(d, 8, 4))"
        " when 1 then concat('85 9', substr(d, 9, 3), ' ', substr(d, 7, 5)) else '123' end"
    )
    name = F.concat(T.safe_file_part("c_name"), F.lit(" - "), T.safe_file_part("c_mktsegment"))
    return rows.select(
        "c_custkey",
        N.format_cpf("d").alias("cpf"),
        N.money_text("c_acctbal").alias("valor"),
        N.format_phone(phone).alias("fone"),
        F.regexp_replace(name, "#", "-").alias("arquivo"),
        T.cut(T.squash(F.concat(F.lit("erro  "), "c_name", F.lit(" "), "c_name")), 30).alias("erro"),
    )


# --- merges ---------------------------------------------------------------


def _merge_frames(f):
    """Current: orders that are not in process; incoming: not finished ones, some given twice."""
    orders = f.t("orders").select(
        "o_orderkey", F.trunc("o_orderdate", "month").alias("mes"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("valor")
    )
    current = orders.filter("o_orderstatus <> 'P'")
    first = orders.filter("o_orderstatus <> 'F'").withColumns({"valor": F.col("valor") + 1, "versao": F.lit(1)})
    second = orders.filter("o_orderstatus = 'P'").withColumns({"valor": F.col("valor") + 2, "versao": F.lit(2)})
    incoming = first.unionByName(second)
    return current, incoming


_INCOMING = """incoming as (select o_orderkey, cast(date_trunc('month', o_orderdate) as date) mes, o_orderstatus,
  cast(o_totalprice as decimal(18,2)) + case when o_orderstatus = 'P' then 2 else 1 end valor from orders where o_orderstatus <> 'F')"""


@query(
    "merge_by_key",
    f"""with {_INCOMING} select o_orderkey, mes, o_orderstatus, cast(valor as decimal(18,2)) valor from incoming
union all select o_orderkey, cast(date_trunc('month', o_orderdate) as date), o_orderstatus, cast(o_totalprice as decimal(18,2)) from orders where o_orderstatus = 'F'""",
)
def _merge(f):
    current, incoming = _merge_frames(f)
    merged = K.merge_by_key(current, incoming, ["o_orderkey"], [F.col("versao").desc()])
    return merged.withColumn("valor", F.col("valor").cast("decimal(18,2)"))


@query(
    "replace_window",
    """with lim as (select cast(date_trunc('month', max(o_orderdate) - interval 400 day) as date) m from orders),
base as (select o_orderkey, cast(date_trunc('month', o_orderdate) as date) mes, o_orderstatus, cast(o_totalprice as decimal(18,2)) valor from orders)
select b.* from base b, lim where mes >= m and o_orderstatus <> 'F' union all select b.* from base b, lim where mes < m""",
)
def _window(f):
    base = f.t("orders").select(
        "o_orderkey", F.trunc("o_orderdate", "month").alias("mes"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("valor")
    )
    last = f.t("orders").agg(F.trunc(F.date_sub(F.max("o_orderdate"), 400), "month").alias("m")).scalar()
    incoming = base.filter((F.col("mes") >= last) & (F.col("o_orderstatus") != "F"))
    return K.replace_window(base, incoming, "o_orderkey", "mes")


# --- report table ---------------------------------------------------------


def _processes(f):
    """Processes by customer; the status is taken from the balance."""
    return f.t("customer").selectExpr(
        "concat(' p', 100000 + c_custkey, '/', 2022 + c_custkey % 8) as numero_processo",
        "case when c_acctbal < 2000 then ' tramitando' when c_acctbal < 7000 then 'Finalizado ' else 'CANCELADO' end as status_processo",
    )


_PROC_SQL = """proc as (select 'P' || (100000 + c_custkey) || '/' || (2022 + c_custkey % 8) numero,
 case when c_acctbal < 2000 then 'TRAMITANDO' when c_acctbal < 7000 then 'FINALIZADO' else 'CANCELADO' end status from customer)"""


@query(
    "refresh_status",
    sql("", "raw_reports").rstrip()
    + f", {_PROC_SQL} select id_registro, coalesce(p.status, r.status_processo) status_processo from raw_reports r"
    + " left join proc p on p.numero = upper(trim(r.numero_processo))",
)
def _refresh(f):
    return U.refresh_status(f.reports(), _processes(f)).select("id_registro", "status_processo")


@query(
    "legacy_migration",
    sql("", "raw_reports").rstrip()
    + f""", {_PROC_SQL},
moved as (select id_registro, r.numero_processo, p.status status_processo, valor from raw_reports r join proc p on p.numero = upper(trim(r.numero_processo))
  where r.status_processo = ' finalizado' and p.status <> 'CANCELADO')
select * from moved union all select id_registro, numero_processo, status_processo, valor from raw_reports where status_processo <> 'TRAMITANDO '
 and id_registro not in (select id_registro from moved)""",
)
def _migrate(f):
    reports = f.reports()
    current = reports.filter("status_processo <> 'TRAMITANDO '")
    legacy = reports.filter("status_processo = ' finalizado'").drop("status_processo")
    return U.migrate_legacy(current, legacy, _processes(f)).select("id_registro", "numero_processo", "status_processo", "valor")


@query(
    "report_upkeep",
    sql("", "raw_reports").rstrip()
    + f""", {_PROC_SQL} select id_registro, coalesce(p.status, r.status_processo) status_processo, numero_conta, r.cd_atendimento from raw_reports r
left join proc p on p.numero = upper(trim(r.numero_processo)) where r.status_processo <> 'TRAMITANDO '""",
)
def _upkeep(f):
    """The whole upkeep: older rows moved in, status refreshed, identifiers repaired."""
    reports = f.reports()
    legacy = reports.filter("status_processo = ' finalizado'").drop("status_processo")
    kept = U.upgrade_reports(reports.filter("status_processo <> 'TRAMITANDO '"), legacy, _processes(f))
    return kept.select("id_registro", "status_processo", "numero_conta", "cd_atendimento")


@query(
    "report_rows",
    sql(
        "select id_registro, 'SITUAÇÃO ' || right(numero_processo, 4) status_processo, competencia, valor from raw_reports"
        " where l_orderkey % 3 > 0 and cast(right(numero_processo, 1) as int) % 2 = 1",
        "raw_reports",
    ),
)
def _report_rows(f):
    """Rows with a month, of known processes, with the status of the process in capitals."""
    order = F.substring("documento_id", 2, 20).cast("bigint")
    enriched = f.reports().withColumn("competencia", F.when(order % 3 > 0, F.col("competencia")))
    known = f.reports().select("numero_processo").distinct().filter("cast(right(numero_processo, 1) as int) % 2 = 1")
    processes = known.withColumn("status_processo", F.concat(F.lit("situação "), F.expr("right(numero_processo, 4)")))
    return U.report_table_rows(enriched, processes).select("id_registro", "status_processo", "competencia", "valor")


@query(
    "technical_defaults",
    """select cast(o_orderkey as varchar) id_registro, coalesce(nullif(o_orderstatus, 'P'), 'legacy_migration') _dlt_load_id,
 case when o_orderpriority = '5-LOW' then md5(cast(o_orderkey as varchar)) else o_orderpriority end _dlt_id from orders""",
)
def _technical(f):
    rows = f.t("orders").selectExpr(
        "cast(o_orderkey as string) as id_registro",
        "nullif(o_orderstatus, 'P') as _dlt_load_id",
        "nullif(o_orderpriority, '5-LOW') as _dlt_id",
    )
    return U.technical_defaults(rows)


# --- periods --------------------------------------------------------------


@query(
    "month_sequence",
    """select cast(m as date) competencia, strftime(m, '%m/%Y') rotulo, strftime(m, '%Y%m') yyyymm from (
 select unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), interval 1 month)) m from orders)""",
)
def _month_sequence(f):
    return D.month_sequence(f.t("orders").agg(F.min("o_orderdate").alias("inicio"), F.max("o_orderdate").alias("fim")))


@query(
    "date_windows",
    """with b as (select cast(min(o_orderdate) as date) + 9 s, cast(max(o_orderdate) as date) - 5 e from orders),
m as (select s, e, cast(unnest(generate_series(date_trunc('month', s), cast(e as timestamp), interval 1 month)) as date) m from b)
select greatest(s, m) inicio, least(e, last_day(m)) fim, strftime(greatest(s, m), '%d/%m/%Y') || ' a ' || strftime(least(e, last_day(m)), '%d/%m/%Y') rotulo from m""",
)
def _date_windows(f):
    bounds = f.t("orders").agg(
        F.date_add(F.min("o_orderdate").cast("date"), 9).alias("inicio"),
        F.max("o_orderdate").cast("date").alias("fim"),
        F.date_sub(F.max("o_orderdate").cast("date"), 5).alias("hoje"),
    )
    return D.date_windows(bounds)
