"""Files and document pages rendered from the driver tables, then parsed back."""

from __future__ import annotations

import io
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from checks.frames import Frames, run_ts, sql
from checks.registry import query
from claimweave import fixed_values as fv
from claimweave.functions import text as T
from claimweave.session import shared_folder
from claimweave.sources import cards as P
from claimweave.sources import invoices as X
from claimweave.sources import payment_docs as Y
from claimweave.sources import report_docs as R
from claimweave.sources import settlement_docs as E
from claimweave.sources import statements as S
from claimweave.sources.pages import document_texts
from claimweave.sources.tables import SnapshotStore
from claimweave.streaming.ingest import merge_invoices


def brl(value: str) -> str:
    """SQL text of a decimal as 1.234,56."""
    return (
        f"translate(regexp_replace(cast({value} as string), '([0-9])(?=([0-9]{{3}})+[.])', '$1;'), '.;', ',.')"
    )


#: Tasks that render and read the documents, however few files the rows came from.
_SPREAD = 64


# --- statements -----------------------------------------------------------


def _statement_files(f: Frames):
    """One small statement file per line; the line occurs twice, every 50th file is one field short."""
    fields = [
        "'1'",
        "concat(' NR', l_suppkey % 20)",
        "date_format(ship, 'dd/MM/yyyy')",
        "concat('L', l_suppkey, ' ')",
        brl("price"),
        "concat(',', lpad(cast(l_linenumber as string), 2, '0'))",
        "'-'",
        "concat('G', l_orderkey % 500)",
        "concat('0', o_custkey % 100)",
        "concat('JOSÉ ', o_custkey)",
        "case when l_linenumber = 3 then '-' else date_format(ordered, 'dd/MM/yyyy') end",
        "'22'",
        "pf",
        "concat('\"SERVIÇO ', l_partkey, '\"')",
        "''",
        "concat(cast(l_quantity as int), ',5000')",
        brl("price"),
        "'-,5'",
        brl("cast(price * disc as decimal(18,2))"),
        "case when l_linenumber = 2 then '' else cast(l_linenumber * 10 as string) end",
        "'9'",
    ]
    line = "concat_ws('#', " + ", ".join(fields) + ")"
    short = "concat_ws('#', " + ", ".join(fields[:-1]) + ")"
    head = (
        "concat_ws('\\r\\n', 'REGISTRO ANS#OPERADORA#CNPJ OPERADORA#X', '123#IPM#07.204.600/0001-70#', '',"
        " 'FATURA#LOTE#DATA ENVIO LOTE#NRO PROTOCOLO#RESTO', "
    )
    text = f"{head} {line}, '', case when l_partkey % 50 = 0 then {short} else {line} end)"
    return f.lines().selectExpr(
        "concat(line_id, '.txt') as arquivo", "trunc(ship, 'month') as referencia", f"encode({text}, 'ISO-8859-1') as content"
    )


@query(
    "statement_roundtrip",
    sql(
        """select cast(date_trunc('month', ship) as date) referencia, '07204600000170' cnpj_operadora, 'L' || l_suppkey numero_lote,
 ship data_envio_lote, 'NR' || (l_suppkey % 20) numero_protocolo, price valor_protocolo, cast(l_linenumber as decimal(18,2)) / 100 vgp,
 'G' || (l_orderkey % 500) numero_guia_senha, case when l_linenumber <> 3 then ordered end data_realizacao, 'SERVIÇO ' || l_partkey descricao_servico,
 nullif(pf0, '') codigo_servico, cast(l_quantity as decimal(18,4)) + 0.5 q, price valor_processado, cast(-0.5 as decimal(18,2)) valor_liberado,
 cast(price * disc as decimal(18,2)) valor_glosa, case when l_linenumber = 2 then '9' else cast(l_linenumber * 10 as varchar) end codigo_glosa,
 'JOSÉ ' || o_custkey nome_beneficiario, '0' || (o_custkey % 100) codigo_beneficiario, n from lines cross join (values (1), (2)) k(n) where l_partkey % 50 <> 0""",
        "lines",
    )
    .replace("cast(l_linenumber as decimal(18,2)) / 100 vgp", "cast(l_linenumber as bigint) centavos_glosa_protocolo")
    .replace("cast(l_quantity as decimal(18,4)) + 0.5 q", "cast(cast(l_quantity as decimal(18,4)) + 0.5 as decimal(18,4)) quantidade_executada")
    .replace("codigo_beneficiario, n from", "codigo_beneficiario from"),
)
def _statements(f):
    rows, _ = S.parse_statements(_statement_files(f))
    cents = (F.col("valor_glosa_protocolo") * 100).cast("bigint").alias("centavos_glosa_protocolo")
    return rows.select("*", cents).drop("id_registro", "codigo_tabela", "grau_participacao", "valor_glosa_protocolo")


@query(
    "statement_rejects",
    sql("select line_id || '.txt' arquivo, cast(7 as bigint) linha, '20 campos; esperados 21' erro from lines where l_partkey % 50 = 0", "lines"),
)
def _rejects(f):
    _, rejects = S.parse_statements(_statement_files(f))
    return rejects.select("arquivo", F.col("linha").cast("bigint").alias("linha"), "erro")


# --- invoices -------------------------------------------------------------

_XML = """concat('<ConsultarNfseResposta xmlns="http://www.abrasf.org.br/nfse.xsd"><ListaNfse><CompNfse><Nfse><InfNfse><Numero> ', o_orderkey,
 ' </Numero><CodigoVerificacao>v', o_orderkey, '</CodigoVerificacao><DataEmissao>', date_format(o_orderdate, "yyyy-MM-dd'T'10:00:00"),
 '</DataEmissao><Servico><Valores><Aliquota>', cast(o_custkey % 7 as string), ',5</Aliquota><ValorServicos>', cast(cast(o_totalprice as decimal(18,2)) as string),
 '</ValorServicos></Valores><Discriminacao>', o_orderpriority, '\\n  linha</Discriminacao></Servico><PrestadorServico><IdentificacaoPrestador><Cnpj>',
 12345678000100 + o_custkey % 3, '</Cnpj></IdentificacaoPrestador></PrestadorServico></InfNfse></Nfse></CompNfse>',
 '<CompNfse><Nfse><InfNfse><Numero>', o_orderkey + 1000000000, '</Numero><DeclaracaoPrestacaoServico><InfDeclaracaoPrestacaoServico><Competencia>',
 date_format(o_orderdate, 'yyyy-MM-dd'), '</Competencia><Tomador><RazaoSocial>Cliente &amp; ', o_custkey, '</RazaoSocial><RazaoSocial>B</RazaoSocial></Tomador>',
 '</InfDeclaracaoPrestacaoServico></DeclaracaoPrestacaoServico></InfNfse></Nfse></CompNfse></ListaNfse></ConsultarNfseResposta>')"""


def _invoice_documents(f: Frames):
    return f.t("orders").repartition(_SPREAD).selectExpr(
        "concat('nota_', o_orderkey, '.xml') as arquivo", "concat('nota_', o_orderkey, '.xml') as membro", f"encode({_XML}, 'UTF-8') as documento"
    )


@query(
    "invoice_xml_roundtrip",
    """select cast(1 as bigint) indice_documento_xml, cast(o_orderkey as varchar) numero_nfse, 'v' || o_orderkey codigo_verificacao_nfse, (o_custkey % 7) || ',5' aliquota_xml,
 printf('%.4f', case when o_custkey % 7 = 0 then 0.5 else (o_custkey % 7 + 0.5) / 100.0 end) aliquota, cast(cast(o_totalprice as decimal(18,2)) as varchar) valor_servicos,
 o_orderpriority || ' linha' discriminacao, cast(12345678000100 + o_custkey % 3 as varchar) prestador_cnpj, cast(null as varchar) competencia_nfse, cast(null as varchar) tomador_razao_social,
 strftime(o_orderdate, '%Y-%m-%dT10:00:00') data_hora from orders
union all select 2, cast(o_orderkey + 1000000000 as varchar), null, null, null, null, null, null, strftime(o_orderdate, '%Y-%m-%d'), 'Cliente & ' || o_custkey, null from orders""",
)
def _invoices(f):
    rows = X.project_invoice(X.invoice_nodes(_invoice_documents(f)))
    return rows.select(
        "indice_documento_xml",
        "numero_nfse",
        "codigo_verificacao_nfse",
        "aliquota_xml",
        "aliquota",
        "valor_servicos",
        "discriminacao",
        "prestador_cnpj",
        "competencia_nfse",
        "tomador_razao_social",
        "data_hora",
    )


@query(
    "xml_flatten",
    """select o_orderkey + 1000000000 numero, 'Cliente & ' || o_custkey primeira, 'B' segunda, cast(4 as bigint) chaves from orders
union all select o_orderkey, null, null, 7 from orders""",
)
def _flatten(f):
    nodes = X.invoice_nodes(_invoice_documents(f))
    root = "compnfse_nfse_infnfse"
    name = f"{root}_declaracaoprestacaoservico_infdeclaracaoprestacaoservico_tomador_razaosocial"
    return nodes.select(
        F.col("campos")[f"{root}_numero"].cast("bigint").alias("numero"),
        F.col("campos")[name].alias("primeira"),
        F.col("campos")[f"{name}_2"].alias("segunda"),
        F.size("campos").cast("bigint").alias("chaves"),
    )


def _damaged_documents(f: Frames):
    """The invoice documents; every seventh is cut off, every eleventh has another root without a provider or a month."""
    return f.t("orders").repartition(_SPREAD).selectExpr(
        "concat('nota_', o_orderkey, '.xml') as arquivo",
        "'a.xml' as membro",
        f"encode(case when o_orderkey % 7 = 0 then substr({_XML}, 1, 300) when o_orderkey % 11 = 0 then '<vazio/>' else {_XML} end, 'UTF-8') as documento",
    )


@query(
    "provider_check",
    """select 'nota_' || o_orderkey || '.xml' arquivo, case when o_orderkey % 7 = 0 then 'XML invalido' when o_orderkey % 11 = 0 then 'CNPJ do prestador ausente'
 else 'CNPJ do prestador diferente' end erro from orders where o_custkey % 3 <> 0 or o_orderkey % 7 = 0 or o_orderkey % 11 = 0""",
)
def _provider(f):
    found = X.check_provider(X.provider_ids(_damaged_documents(f)), "12.345.678/0001-00")
    return found.withColumn("erro", F.substring_index("erro", ":", 1))  # without the parser's own words


@query(
    "invoice_period",
    """select 'nota_' || o_orderkey || '.xml' arquivo, case when o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0 then cast(date_trunc('month', o_orderdate) as date) end competencia,
 case when o_orderkey % 7 = 0 then 'XML invalido' when o_orderkey % 11 = 0 then 'competencia nao identificada' end erro from orders""",
)
def _period(f):
    found = X.infer_period(X.invoice_nodes(_damaged_documents(f)))
    return found.withColumn("erro", F.substring_index("erro", ":", 1))


def _leaves(paths: dict[str, tuple[str, ...]], rank: int) -> dict[str, str]:
    """Mapped column to the path of that rank, where it has one below the invoice node."""
    return {name: own[rank] for name, own in paths.items() if len(own) > rank}


def _nested(leaves: dict[str, str]) -> str:
    """SQL text of elements for the paths, each holding its column's name and the order's key."""
    tree: dict = {}
    for name, path in leaves.items():
        here = tree
        for part in path.split("/"):
            here = here.setdefault(part, {})
        here["#"] = name

    def spell(node: dict) -> str:
        return "".join(f"<{t}>{own['#'] + ' {k}' if '#' in own else ''}{spell({c: x for c, x in own.items() if c != '#'})}</{t}>" for t, own in node.items())

    return "concat('<CompNfse>" + spell(tree).replace("{k}", "', o_orderkey, '") + "</CompNfse>')"


#: Columns whose path another column reads as well: they share its text.
_FIRST_PATHS = _leaves(fv.INVOICE_PATHS, 0)


@query(
    "invoice_columns",
    "select o_orderkey id, "
    + ", ".join(f"'{n} ' || o_orderkey {n}" for n in _FIRST_PATHS)
    + ", 'aliquota_xml ' || o_orderkey aliquota, "
    + ", ".join(f"'{n} ' || o_orderkey {n}" for n in fv.INVOICE_NAMES)
    + " from orders",
)
def _invoice_columns(f):
    """Every mapped column of one document that holds all first paths and all elements found by name."""
    leaves = {**_FIRST_PATHS, **{name: f"Extra/{own[-1]}" for name, own in fv.INVOICE_NAMES.items()}}
    documents = f.t("orders").repartition(_SPREAD).selectExpr("cast(o_orderkey as string) as arquivo", "'a.xml' as membro", f"encode({_nested(leaves)}, 'UTF-8') as documento")
    rows = X.project_invoice(X.invoice_nodes(documents))
    return rows.select(F.col("arquivo").cast("bigint").alias("id"), *X.MAPPED, "aliquota")


def _pack(batches):
    """Fixture: an archive of two XML members and one other file per page; batches go on by bytes, however many pages came as one."""
    rows = X.Rows({"arquivo": pa.string(), "content": pa.binary()})
    for batch in batches:
        for page_id, html in X.values_of(batch, "page_id", "html"):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w") as archive:
                archive.writestr(f"a/{page_id}.xml", html)
                archive.writestr(f"b/{page_id}.XML", f"<x>{page_id}</x>")
                archive.writestr("leia.txt", "nada")
            yield from rows.add((f"p{page_id}.zip", buffer.getvalue()), buffer.tell())
    yield from rows.rest()


@query(
    "zip_expand",
    """select 'p' || page_id || '.zip' arquivo, page_id || '.xml' membro, sha256(html) resumo from pages
union all select 'p' || page_id || '.zip', page_id || '.XML', sha256('<x>' || page_id || '</x>') from pages
union all select 'p' || page_id || '.xml', 'p' || page_id || '.xml', sha256(html) from pages""",
)
def _zip(f):
    pages = f.t("pages")
    packed = pages.select("page_id", "html").mapInArrow(_pack, "arquivo string, content binary")
    plain = pages.select(F.concat(F.lit("p"), "page_id", F.lit(".xml")).alias("arquivo"), F.encode("html", "UTF-8").alias("content"))
    opened = X.expand_archives(packed.unionByName(plain))
    return opened.select("arquivo", "membro", F.sha2("documento", 256).alias("resumo"))


@query(
    "stream_ingest",
    """select numero_nfse, codigo_verificacao_nfse from (select cast(o_orderkey as varchar) numero_nfse, 'v' || o_orderkey codigo_verificacao_nfse from orders
union all select cast(o_orderkey + 1000000000 as varchar), null from orders)""",
)
def _stream(f):
    """The orders file as a file stream; each micro-batch is parsed and merged, the last one twice."""
    spark = f.spark
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    store = SnapshotStore(spark, f"{base}/tables")

    def handle(batch, _number):
        rows = X.invoice_rows(X.invoice_nodes(_documents_of(batch)), "202605", run_ts())
        merge_invoices(store, "nfse_xml", rows)
        merge_invoices(store, "nfse_xml", rows)

    stream = spark.readStream.schema(f.t("orders").schema).option("pathGlobFilter", "orders.parquet").parquet(f.sf)
    running = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    rows = spark.read.parquet(*[f"{store.root}/{p['caminho']}" for p in store.parts("nfse_xml")])
    return rows.select("numero_nfse", "codigo_verificacao_nfse")


def _documents_of(orders):
    return orders.repartition(_SPREAD).selectExpr(
        "concat('nota_', o_orderkey, '.xml') as arquivo", "concat('nota_', o_orderkey, '.xml') as membro", f"encode({_XML}, 'UTF-8') as documento"
    )


# --- cards and trees ------------------------------------------------------


@query(
    "process_cards",
    """select 'P' || (100000 + o_orderkey) || '/' || year(o_orderdate) numero_processo,
 case o_orderstatus when 'F' then 'FINALIZADO' when 'O' then 'TRAMITANDO' else case when o_orderpriority = '5-LOW' then 'EM ANALISE' else 'DESCONHECIDO' end end status_processo,
 case when o_orderstatus = 'O' then 'PAGAMENTO ' || o_orderpriority when o_orderstatus = 'F' then 'Conta ' || o_custkey || ' segunda' end tipo_processo_assunto,
 cast(o_orderdate as date) data_abertura, case when o_orderstatus = 'F' then 'pago "ok' end motivo_finalizacao, 'http://x/' || o_orderkey url_visualizacao from orders""",
)
def _cards(f):
    cards = f.t("orders").repartition(_SPREAD).selectExpr(
        "concat('p', 100000 + o_orderkey, ' _ ', year(o_orderdate)) as numero",
        "concat('PROCESSO p', 100000 + o_orderkey, '/', year(o_orderdate), case o_orderstatus when 'F' then '  finalizado ' when 'O' then ''"
        " else case when o_orderpriority = '5-LOW' then ' - em análise' else '' end end) as cabecalho",
        "concat('x ', case when o_orderstatus = 'O' then 'Tramitando' else 'nada' end, ' aberto em ', date_format(o_orderdate, 'dd/MM/yyyy'), ' fim') as texto",
        "array('Número', 'FINALIZADO', ' Número ', concat('Conta  ', o_custkey), ' segunda', 'terceira', '01/01/2020') as linhas",
        "case when o_orderstatus = 'O' then concat('Tipo de Processo/Assunto: PAGAMENTO ', o_orderpriority, ' Data de abertura: 01/01/2000') else '' end as tipo",
        "'' as data",
        "case when o_orderstatus = 'F' then '\"pago \"ok\" (ver mais) resto VISUALIZAR PROCESSO x' else '' end as motivo",
        "concat(' http://x/', o_orderkey) as href",
    )
    rows, _ = P.parse_process_cards(cards)
    return rows.withColumn("status_processo", F.upper(T.fold("status_processo")))


@query(
    "doc_tree",
    """select 'P' || (100000 + p_partkey) || '/2024' numero_processo, setor_canonico, id documento_id, nome documento_nome from part cross join (values
 ('ipm/saudecogestao', 'a', 'Resumo.pdf'), ('ipm/nuexo', 'c', 'NF_1.pdf'), ('ipm/nuexo', 'e', '')) k(setor_canonico, id, nome)""",
)
def _tree(f):
    tree = f.t("part").selectExpr(
        "concat('P', 100000 + p_partkey, '/2024') as numero_processo",
        "array(named_struct('setor', ' IPM/Co-Gestora', 'documentos', array(named_struct('id', 'a', 'nome', 'Resumo.pdf'), named_struct('id', 'b', 'nome', 'Despacho 1.pdf'),"
        " named_struct('id', 'f', 'nome', 'relatorio_1_2.pdf'))),"
        " named_struct('setor', 'IPM/NUEXO', 'documentos', array(named_struct('id', 'c', 'nome', 'NF_1.pdf'), named_struct('id', 'd', 'nome', 'Certidão.pdf'), named_struct('id', 'e', 'nome', null))),"
        " named_struct('setor', p_brand, 'documentos', array(named_struct('id', 'z', 'nome', p_name)))) as setores",
    )
    return P.target_documents(tree).drop("setor")


# --- account report pages -------------------------------------------------

_DOC = [
    "concat('P', 100000 + o_orderkey, '/2025') as numero_processo",
    "concat('D', o_orderkey) as documento_id",
    "concat('relatorio_', o_custkey % 20, '_', o_orderkey, '.pdf') as documento_nome",
]


def _order_pages(f: Frames):
    return f.t("orders").repartition(_SPREAD).selectExpr(
        "*", "cast(o_totalprice as decimal(18,2)) as price", "o_custkey % 20 as remessa", "cast(o_orderdate as date) as ship", "o_custkey + 3 as atend"
    )


_ORDERS_SQL = """(select *, cast(o_totalprice as decimal(18,2)) price, o_custkey % 20 remessa, cast(o_orderdate as date) ship, o_custkey + 3 atend,
 'D' || o_orderkey line_id from orders)"""


_REPORT_TABLES_SQL = ("""select line_id documento_id, remessa cd_remessa, 'JOÃO ' || o_custkey nome_paciente, 'G' || (o_orderkey % 500) numero_guia,
 case when o_orderkey % 3 = 2 then cast(o_orderkey as varchar) else cast(o_orderkey as varchar) end numero_conta, atend + 1 cd_atendimento,
 cast(date_trunc('month', ship) as date) competencia, price valor, n from {o} join (values (0, 1), (1, 1), (1, 2), (2, 1)) k(caso, n) on k.caso = o_orderkey % 3""").replace("price valor, n from", "price valor from").replace("{o}", _ORDERS_SQL)


def _table_pages(orders, value: str):
    """Pages with a one- or two-row header, or with labelled text, by the order's key."""
    row = (
        "array(cast(remessa as string), concat('JOÃO  ', o_custkey), concat('G', o_orderkey % 500), concat(o_orderkey, ' ', atend + 1), '',"
        f" date_format(ship, 'MM/yyyy'), concat('R$ ', {value}))"
    )
    one = "array('Remessa', 'Nome do Paciente', 'Número da Guia', 'Número da Conta', 'Código Atendimento', 'Competência', 'Valor')"
    two_a = "array('Remessa', 'Nome do', 'Número da', 'Número da', 'Código', 'Competência', 'Valor')"
    two_b = "array(null, 'Paciente', 'Guia', 'Conta', 'Atendimento', '', '')"
    text = (
        "concat_ws('\\n', concat('Remessa: ', remessa), concat('Nome do Paciente: JOÃO ', o_custkey), concat('Guia - G', o_orderkey % 500),"
        " concat('Número da Conta: ', o_orderkey), concat('Atendimento: ', atend + 1), concat('Competência: ', date_format(ship, 'MM/yyyy')),"
        f" concat('Valor: ', {value}))"
    )
    empty = "array(array(array('', cast(null as string))))"
    return orders.selectExpr(
        *_DOC,
        "1 as page",
        f"case o_orderkey % 3 when 0 then array(array({one}, {row})) when 1 then array(array({two_a}, {two_b}, {row}, {one}, {row})) else {empty} end as tables",
        f"case when o_orderkey % 3 = 2 then {text} else '' end as text",
    )


_REPORT_COLUMNS = ("documento_id", "cd_remessa", "nome_paciente", "numero_guia", "numero_conta", "cd_atendimento", "competencia", "valor")


@query("report_tables", _REPORT_TABLES_SQL)
def _report_tables(f):
    rows = R.parse_report_tables(_table_pages(_order_pages(f), brl("price"))).filter("completo and not erro")
    return rows.select(*_REPORT_COLUMNS)


_REPORT_WORDS_SQL = ("""select line_id documento_id, remessa cd_remessa, 'MARIA ' || o_custkey nome_paciente, 'G' || (o_orderkey % 500) numero_guia,
 cast(o_orderkey as varchar) numero_conta, atend cd_atendimento, cast(date_trunc('month', ship) as date) competencia, price valor from {o}
union all select line_id, remessa, 'PEDRO', null, cast(o_orderkey as varchar), remessa, cast(date_trunc('month', ship) as date), price + 1 from {o}""").replace("price + 1 from", "cast(price + 1 as decimal(18,2)) from").replace("{o}", _ORDERS_SQL)


def _word_pages(orders):
    def word(text: str, x: float, top: float) -> str:
        return f"named_struct('text', {text}, 'x0', {x}d, 'top', {top}d)"

    words = [
        word("'Paciente'", 300, 100),
        word("'Atend.'", 264, 100),
        word("cast(o_custkey as string)", 340, 121.5),
        word("'MARIA'", 300, 120),
        word("concat('G', o_orderkey % 500)", 110, 119),
        word("cast(o_orderkey as string)", 170, 122),
        word("cast(atend as string)", 270, 123.5),
        word(brl("price"), 540, 120),
        word("'PEDRO'", 300, 130),
        word("concat(o_orderkey, ' ', remessa)", 165, 131),
        word(brl("cast(price + 1 as decimal(18,2))"), 560, 134.5),
        word("'solto'", 300, 150),
        word("'Total'", 300, 180),
        word("'9.999,99'", 540, 190),
    ]
    return orders.selectExpr(
        *_DOC, "1 as page", "800d as height", "concat('Compet.: ', date_format(ship, 'MM/yyyy'), ' fim') as text", "array(" + ", ".join(words) + ") as words"
    )


@query("report_words", _REPORT_WORDS_SQL)
def _report_words(f):
    # A row whose value is no number rejects its document, so the loose word has no value at all.
    rows = R.parse_report_words(_word_pages(_order_pages(f))).filter("completo and not erro")
    return rows.select(*_REPORT_COLUMNS)


def _mixed_reports(f: Frames):
    """Words for two documents of four, tables for one of these and two others; some values are broken, one page in four is blank."""
    orders = _order_pages(f)
    tables = _table_pages(orders.filter("o_orderkey % 4 > 0"), "case when o_orderkey % 10 = 6 then 'x' else " + brl("price") + " end")
    blank = F.substring("documento_id", 2, 20).cast("bigint") % 4 == 3
    tables = tables.withColumns({"tables": F.when(~blank, F.col("tables")).otherwise(F.array().cast(tables.schema["tables"].dataType)), "text": F.when(~blank, F.col("text"))})
    return R.parse_reports(_word_pages(orders.filter("o_orderkey % 4 < 2")), tables, run_ts())


@query(
    "report_layouts",
    f"select * from ({_REPORT_WORDS_SQL}) where cast(substr(documento_id, 2) as bigint) % 4 < 2 union all select * from ({_REPORT_TABLES_SQL})"
    " where cast(substr(documento_id, 2) as bigint) % 4 = 2 and cast(substr(documento_id, 2) as bigint) % 10 <> 6",
)
def _report_layouts(f):
    return _mixed_reports(f)[0].select(*_REPORT_COLUMNS)


@query(
    "report_rejects",
    "select 'P' || (100000 + o_orderkey) || '/2025' numero_processo, 'D' || o_orderkey documento_id from orders where o_orderkey % 4 = 3 or (o_orderkey % 4 = 2 and o_orderkey % 10 = 6)",
)
def _report_rejects(f):
    return _mixed_reports(f)[1].select("numero_processo", "documento_id")


# --- settlement documents -------------------------------------------------


def _settlement_pages(f: Frames):
    """Three pages per order: summary and headed table, a continuation, and an older text page."""
    value = brl("cast(o_totalprice as decimal(18,2))")
    doc = [
        "concat('P', 100000 + o_orderkey, '/2025') as numero_processo",
        "concat('D', o_orderkey) as documento_id",
        "'resumo.pdf' as documento_nome",
    ]
    summary = (
        "array(array('Nome Prestador', concat('HOSPITAL ', o_custkey), 'CNPJ', '12.345.678/0001-90'),"
        " array('Número Processo\\nNúmero Processo Recurso', concat('p', 200000 + o_orderkey, '_2025\\nR-', o_orderkey), '', ''),"
        " array('Competência TMS', date_format(o_orderdate, 'MM/yyyy'), 'Comp de Produção', '01/2025'),"
        " array('Dt Fechamento', concat(date_format(o_orderdate, 'dd'), '//', date_format(o_orderdate, 'MM/yyyy')), '', ''),"
        f" array('Valor Informado', concat('R$ ', {value}), 'Valor Liberado', {value}), array('Valor Glosado', 'R$ -', '', ''))"
    )
    head = "array(array('Nr', 'Nr', 'Valor', 'Valor', 'Valor'), array('', 'Origem', 'Protocolo', 'Glosado', 'Aprovado'))"
    line = "array(concat({n}, o_orderkey), concat('O', o_orderkey), '', {v}, '(1,50)', {v})"
    rows_1 = "array(" + line.format(n="'1'", v=value) + ")"
    rows_2 = "array(" + line.format(n="'2'", v=value) + ", array('total', '', '', ''))"
    orders = f.t("orders").repartition(_SPREAD)
    first = orders.selectExpr(*doc, "1 as page", f"array({summary}, concat({head}, {rows_1})) as tables", "'' as text")
    second = orders.selectExpr(*doc, "2 as page", f"array({rows_2}) as tables", "'' as text")
    return first.unionByName(second)


_SETTLEMENT_SQL = """select '12345678000190' cnpj, 'HOSPITAL ' || o_custkey nome_prestador, 'P' || (200000 + o_orderkey) || '/2025' numero_processo, 'P' || (100000 + o_orderkey) || '/2025' processo_origem,
 'R-' || o_orderkey processo_recurso, strftime(o_orderdate, '%m/%Y') competencia_tms, cast(o_orderdate as date) data_fechamento, v valor_informado, cast(0 as decimal(18,2)) valor_glosado_producao,
 k.n || o_orderkey nr, 'O' || o_orderkey nr_origem, v valor_protocolo, cast(-1.5 as decimal(18,2)) valor_glosado_protocolo, v valor_aprovado_protocolo, cast(k.n as bigint) pagina_pdf
from (select *, cast(o_totalprice as decimal(18,2)) v from orders) cross join (values (1), (2)) k(n)"""
_SETTLEMENT_COLUMNS = (
    "cnpj",
    "nome_prestador",
    "numero_processo",
    "processo_origem",
    "processo_recurso",
    "competencia_tms",
    "data_fechamento",
    "valor_informado",
    "valor_glosado_producao",
    "nr",
    "nr_origem",
    "valor_protocolo",
    "valor_glosado_protocolo",
    "valor_aprovado_protocolo",
    "pagina_pdf",
)


@query("settlement_tables", _SETTLEMENT_SQL)
def _settlement(f):
    rows, _ = E.parse_settlements(_settlement_pages(f))
    return rows.select(*_SETTLEMENT_COLUMNS)


_LEGACY_SQL = """select '01234567890123' cnpj, 'HOSPITAL ' || o_custkey nome_prestador, strftime(o_orderdate, '%m/%Y') competencia_tms, '1/2025' competencia_producao, cast(o_orderdate as date) data_fechamento,
 cast(v + 100 as decimal(18,2)) valor_informado, v valor_aprovado_producao, cast(case when o_orderstatus = 'F' then 7.5 else 100 end as decimal(18,2)) valor_glosado_producao from (select *, cast(o_totalprice as decimal(18,2)) v from orders)
where o_orderstatus <> 'P'"""


def _legacy_pages(f: Frames):
    informed, approved = brl("cast(o_totalprice + 100 as decimal(18,2))"), brl("cast(o_totalprice as decimal(18,2))")
    text = (
        "concat('Resumo Fechamento do Processo\\n', date_format(o_orderdate, 'yyyyMM'), '77 1/2025 1234567890123 HOSPITAL ', o_custkey, ' 01/02/2025 3 4 10,00\\n',"
        f" case when o_orderstatus = 'P' then '' else concat('TOTAL GERAL 3 ', {informed}, ' 1,00 ', {approved}, '\\n') end, 'Data - ', date_format(o_orderdate, 'dd/MM/yyyy'),"
        " case when o_orderstatus = 'F' then ' GLOSA: R$ 7,50' else '' end)"
    )
    return f.t("orders").repartition(_SPREAD).selectExpr(
        "concat('P', 100000 + o_orderkey, '/2025') as numero_processo",
        "concat('D', o_orderkey) as documento_id",
        "'resumo.pdf' as documento_nome",
        "1 as page",
        "cast(array() as array<array<array<string>>>) as tables",
        f"{text} as text",
    )


def _order_key():
    return F.substring("documento_id", 2, 20).cast("bigint")


def _mixed_settlements(f: Frames):
    """Tables for two documents of three, older text for two of three, and a broken value in the text of every tenth."""
    tables, legacy = _settlement_pages(f), _legacy_pages(f)
    broken = legacy.withColumn("text", F.when(_order_key() % 10 == 7, F.regexp_replace("text", "TOTAL GERAL 3 [^ ]+", "TOTAL GERAL 3 1,2,3")).otherwise(F.col("text")))
    return E.parse_settlements(tables.filter(_order_key() % 3 < 2).unionByName(broken.filter(_order_key() % 3 > 0)))


@query(
    "settlement_layouts",
    """select 'D' || o_orderkey documento_id, k.n || o_orderkey nr, cast(o_totalprice as decimal(18,2)) valor_informado, cast(k.n as bigint) pagina_pdf from orders cross join (values (1), (2)) k(n) where o_orderkey % 3 < 2
union all select 'D' || o_orderkey, null, cast(cast(o_totalprice as decimal(18,2)) + 100 as decimal(18,2)), 1 from orders where o_orderkey % 3 = 2 and o_orderstatus <> 'P' and o_orderkey % 10 <> 7""",
)
def _settlement_layouts(f):
    return _mixed_settlements(f)[0].select("documento_id", "nr", "valor_informado", "pagina_pdf")


@query(
    "settlement_rejects",
    "select 'P' || (100000 + o_orderkey) || '/2025' processo_origem, 'D' || o_orderkey documento_id from orders where o_orderkey % 3 = 2 and o_orderstatus <> 'P' and o_orderkey % 10 = 7",
)
def _settlement_rejects(f):
    return _mixed_settlements(f)[1].select("processo_origem", "documento_id")


@query("legacy_settlement", _LEGACY_SQL)
def _legacy_settlement(f):
    rows, _ = E.parse_settlements(_legacy_pages(f))
    return rows.select(
        "cnpj",
        "nome_prestador",
        "competencia_tms",
        "competencia_producao",
        "data_fechamento",
        "valor_informado",
        "valor_aprovado_producao",
        "valor_glosado_producao",
    )


@query(
    "new_report_documents",
    """select 'D' || o_orderkey documento_id, 'Relatorio_' || (o_custkey % 20) || '_' || o_orderkey || '.PDF' documento_nome from orders where o_orderkey % 4 = 1 and o_orderstatus <> 'F'""",
)
def _new_report_documents(f):
    """Report files by their name that no loaded report row comes from."""
    documents = f.t("orders").selectExpr(
        "concat('D', o_orderkey) as documento_id",
        "case o_orderkey % 4 when 1 then concat('Relatorio_', o_custkey % 20, '_', o_orderkey, '.PDF') when 2 then 'relatorio.pdf' else concat('Resumo ', o_orderkey) end as documento_nome",
    )
    loaded = f.t("orders").filter("o_orderstatus = 'F'").selectExpr("concat('D', o_orderkey) as documento_id", "1 as linha")
    return P.new_report_documents(documents, loaded.unionByName(loaded))


@query(
    "document_texts",
    """select 'D' || o_custkey documento_id, string_agg(case when o_orderkey % 3 = 0 then '' else o_orderpriority end, chr(10) order by o_orderkey) as "text" from orders group by o_custkey""",
)
def _document_texts(f):
    """Pages of a document joined in their order; a page without text is an empty line."""
    pages = f.t("orders").selectExpr(
        "concat('P', o_custkey) as numero_processo",
        "concat('D', o_custkey) as documento_id",
        "'a.pdf' as documento_nome",
        "o_orderkey as page",
        "case when o_orderkey % 3 > 0 then o_orderpriority end as text",
    )
    return document_texts(pages).select("documento_id", "text")


# --- payment documents ----------------------------------------------------


def _payment_texts(f: Frames):
    """A commitment text and an invoice text per supplier; every fourth supplier has one text with both."""
    commitment = (
        "concat('NOTA DE EMPENHO\\nBanco/Agência: ', 100 + s_nationkey, ' / ', case when s_nationkey % 2 = 0 then 'BRADESCO / ' else '' end, s_suppkey,"
        " '-1 Conta: 99\\nConta corrente: ', s_suppkey * 7, '-0 Favorecido: X\\n')"
    )
    invoice = (
        "concat('DANFSE\\nNúmero da NFS-e\\n', s_suppkey + 5, '\\nChave de acesso da NFS-e: AB.', s_suppkey, '-9\\nPRESTADOR DE SERVICO\\nCNPJ / CPF / NIF: 12.345.678/0001-',"
        " lpad(cast(s_nationkey as string), 2, '0'), '\\nTOMADOR\\nCNPJ / CPF: 99.999.999/0001-99')"
    )
    suppliers = f.t("supplier")
    doc = "concat('P', 100000 + s_suppkey, '/2025') as numero_processo"
    both = suppliers.filter("s_suppkey % 4 = 0").selectExpr(doc, "concat('B', s_suppkey) as documento_id", "'doc.pdf' as documento_nome", f"concat({commitment}, {invoice}) as text")
    first = suppliers.filter("s_suppkey % 4 <> 0").selectExpr(doc, "concat('E', s_suppkey) as documento_id", "'Empenho 1.pdf' as documento_nome", f"{commitment} as text")
    second = suppliers.filter("s_suppkey % 4 in (1, 2)").selectExpr(doc, "concat('N', s_suppkey) as documento_id", "'NF_9.pdf' as documento_nome", f"{invoice} as text")
    return both.unionByName(first).unionByName(second)


@query(
    "payment_docs",
    """select case when s_suppkey % 4 = 0 then 'B' else 'E' end || s_suppkey documento_id, 'EMPENHO' tipo_documento, case when s_nationkey % 2 = 0 then 'Banco Bradesco' end banco,
 cast(100 + s_nationkey as varchar) codigo_conta, s_suppkey || '-1' codigo_agencia, (s_suppkey * 7) || '-0' conta, cast(null as varchar) numero_nfse, cast(null as varchar) chave_acesso_nfse, cast(null as varchar) cnpj_cpf_nif_prestador from supplier
union all select case when s_suppkey % 4 = 0 then 'B' else 'N' end || s_suppkey, 'NFS_E', null, null, null, null, cast(s_suppkey + 5 as varchar), 'AB' || s_suppkey || '9', '123456780001' || lpad(cast(s_nationkey as varchar), 2, '0')
from supplier where s_suppkey % 4 <> 3""",
)
def _payments(f):
    return Y.parse_payment_docs(_payment_texts(f)).drop("id_registro", "numero_processo", "documento_nome")


@query(
    "payment_routes",
    """select 'EMPENHO' destino, count(*) n from supplier union all select 'NFS_E', count(*) from supplier where s_suppkey % 4 <> 3 union all select 'rejeito', 0""",
)
def _routes(f):
    parts = Y.route_payment_docs(Y.parse_payment_docs(_payment_texts(f)))
    counted = [p.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("destino"), "n") for p, k in zip(parts, ("EMPENHO", "NFS_E", "rejeito"))]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(
    "document_completeness",
    """select 'P' || (100000 + s_suppkey) || '/2025' numero_processo, false falta_empenho, s_suppkey % 4 = 3 falta_nota_fiscal, false empenho_incompleto, s_suppkey % 4 = 3 nota_fiscal_incompleta from supplier""",
)
def _completeness(f):
    texts = _payment_texts(f)
    return Y.document_completeness(texts, Y.parse_payment_docs(texts))
