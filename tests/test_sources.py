"""Files and pages on small cases."""

import datetime as dt
import io
import random
import sys
import unicodedata
import zipfile
from decimal import Decimal
from xml.etree import ElementTree

from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import text as T
from claimweave.sources import cards, invoices, statements
from claimweave.sources.pages import folded_cells, folded_parts
from claimweave.sources.tables import SnapshotStore, append_ledger, read_ledger
from claimweave.streaming.ingest import ingest_invoices, ingest_statements

HEAD = "REGISTRO ANS#OPERADORA#CNPJ OPERADORA#\r\n1#X#07.204.600/0001-70#\r\nFATURA#LOTE#DATA ENVIO LOTE#NRO PROTOCOLO#\r\n"
LINE = "1#55#01/06/2026#L9#4.881,60#,83#-#G1#007#ANA “x”#02/06/2026#22#0101#EXAME#-#1,5#10,00#9,17#,83##A1"


def statement(*lines):
    return (HEAD + "\r\n".join(lines) + "\r\n").encode("cp1252")


def test_statement_rows_and_repeats(spark):
    files = spark.createDataFrame([("f", dt.date(2026, 6, 1), statement(LINE, "", LINE))], "arquivo string, referencia date, content binary")
    rows, rejects = statements.parse_statements(files)
    got = rows.collect()
    assert rejects.count() == 0 and len(got) == 2 and len({r.id_registro for r in got}) == 2
    r = got[0]
    assert (r.numero_lote, r.numero_protocolo, r.valor_protocolo, r.valor_glosa) == ("L9", "55", Decimal("4881.60"), Decimal("0.83"))
    assert (r.codigo_glosa, r.nome_beneficiario, r.codigo_beneficiario) == ("A1", "ANA “x”", "007")
    again = statements.parse_statements(files)[0]
    assert {x.id_registro for x in again.collect()} == {x.id_registro for x in got}


def test_statement_with_a_bad_line_is_rejected_whole(spark):
    files = spark.createDataFrame(
        [("bad", dt.date(2026, 6, 1), statement(LINE, LINE.rsplit("#", 1)[0])), ("none", dt.date(2026, 6, 1), b"nada")],
        "arquivo string, referencia date, content binary",
    )
    rows, rejects = statements.parse_statements(files)
    assert rows.count() == 0
    assert {(r.arquivo, r.linha, r.erro) for r in rejects.collect()} == {
        ("bad", 5, "20 campos; esperados 21"),
        ("none", None, "CNPJ da operadora nao encontrado"),
    }


XML = "<CompNfse xmlns='http://x'><Nfse><InfNfse><Numero>{n}</Numero><CodigoVerificacao>{c}</CodigoVerificacao></InfNfse></Nfse></CompNfse>"


def test_streams_ingest_only_new(spark, tmp_path):
    landing, store = tmp_path / "in", SnapshotStore(spark, str(tmp_path / "tables"))
    landing.mkdir()
    (landing / "a.xml").write_text(XML.format(n=1, c="k1"))
    run = lambda: ingest_invoices(spark, str(landing), store, str(tmp_path / "ck"), "202606", F.lit("2026-06-01").cast("timestamp")).awaitTermination()
    run()
    with zipfile.ZipFile(landing / "b.zip", "w") as archive:
        archive.writestr("x/c.xml", "<L>" + XML.format(n=1, c="K1 ") + XML.format(n=2, c="") + "</L>")
        archive.writestr("d.xml", XML.format(n=3, c="k3"))
    run()
    version = store.versions()["nfse_xml"]
    got = spark.read.parquet(f"{store.root}/nfse_xml/{version}")
    assert sorted(r.numero_nfse for r in got.collect()) == ["1", "2", "3"]

    folder = tmp_path / "st"
    folder.mkdir()
    (folder / "demonstrativo_conta_ipm_2026_06.txt").write_bytes(statement(LINE, LINE))
    ingest_statements(spark, str(folder), store, str(tmp_path / "ck2")).awaitTermination()
    from claimweave.schemas import STATEMENT_ROWS

    assert {str(r.referencia) for r in store.read("demonstrativo_conta_ipm", STATEMENT_ROWS).collect()} == {"2026-06-01"}


def test_invoice_nodes_flatten_repeats(spark):
    document = b"<InfNfse><k>a</k><k> b  c </k><k>d</k></InfNfse>"
    node = invoices.invoice_nodes(spark.createDataFrame([("f", "m", document)], invoices.DOCUMENTS)).collect()[0]
    assert node.campos == {"infnfse_k": "a", "infnfse_k_2": "b c", "infnfse_k_3": "d"}
    broken = invoices.invoice_nodes(spark.createDataFrame([("f", "m", b"<a>")], invoices.DOCUMENTS)).collect()[0]
    assert broken.erro and broken.no is None


def test_archives_are_sniffed(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("p/a.XML", "<a/>")
        archive.writestr("b.txt", "x")
    files = spark.createDataFrame([("z.bin", buffer.getvalue()), ("dir/q.xml", b"<q/>")], "arquivo string, content binary")
    got = {(r.membro, bytes(r.documento)) for r in invoices.expand_archives(files).collect()}
    assert got == {("a.XML", b"<a/>"), ("q.xml", b"<q/>")}


def test_ledger_skips_malformed_lines(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert read_ledger(spark, path).count() == 0
    append_ledger(spark.createDataFrame([("success", "h1")], "status string, row_hash string"), path)
    (tmp_path / "ledger" / "x.json").write_text('{"status": "success", "row_hash": "h2"}\n{broken\n')
    assert {r.row_hash for r in read_ledger(spark, path).collect()} == {"h1", "h2"}


def test_sectors(spark):
    frame = spark.createDataFrame([("IPM/ Saúde Cogestão/",), ("ipm/cogestora",), ("IPM/NUEXO",)], "s string")
    assert [r[0] for r in frame.select(cards.canonical_sector("s")).collect()] == ["ipm/saudecogestao", "ipm/saudecogestao", "ipm/nuexo"]


def test_unreadable_documents_are_rows(spark):
    documents = [
        ("ok", "a.xml", b"<CompNfse><Nfse><InfNfse><Competencia>2026-01-05</Competencia><PrestadorServico><IdentificacaoPrestador><Cnpj>12.3</Cnpj></IdentificacaoPrestador></PrestadorServico></InfNfse></Nfse></CompNfse>"),
        ("mixed", "a.xml", b"<CompNfse><Nfse><InfNfse><Competencia>2026-01-05</Competencia><PrestadorServico><IdentificacaoPrestador><Cnpj>123</Cnpj></IdentificacaoPrestador></PrestadorServico></InfNfse></Nfse></CompNfse>"),
        ("mixed", "b.xml", b"<a><b></a>"),
        ("none", "a.xml", None),
        ("empty", "a.xml", b""),
        ("bytes", "a.xml", b"\xff\xfe\x00<"),
        ("code", "a.xml", b"<?xml version='1.0' encoding='x-unknown'?><a/>"),
        ("deep", "a.xml", b"<a>" * 5000 + b"x" + b"</a>" * 5000),
    ]
    frame = spark.createDataFrame(documents, invoices.DOCUMENTS)
    nodes = invoices.invoice_nodes(frame).collect()
    assert len(nodes) == len(documents) and {n.arquivo for n in nodes if n.erro} == {"mixed", "none", "empty", "bytes", "code", "deep"}
    period = {r.arquivo: (str(r.competencia), r.erro is None) for r in invoices.infer_period(invoices.invoice_nodes(frame)).collect()}
    assert period["ok"] == ("2026-01-01", True) and not any(good for name, (_, good) in period.items() if name != "ok")
    checked = {r.arquivo: r.erro for r in invoices.check_provider(invoices.provider_ids(frame), "1/23").collect()}
    assert "ok" not in checked and checked["mixed"].startswith("XML invalido") and checked["none"] == "documento ausente"
    assert checked["deep"] == "CNPJ do prestador ausente"
    assert invoices.invoice_nodes(frame.limit(0)).count() == 0


def _by_paths(node):
    """Mapped texts by following each path on its own."""
    tag = lambda e: e.tag.rsplit("}", 1)[-1]
    text = lambda e: " ".join((e.text or "").split()) or None
    out = {}
    for name, paths in fv.INVOICE_PATHS.items():
        out[name] = None
        for path in paths:
            parts, here = path.split("/"), [node]
            for part in parts[1:] if parts[0] == tag(node) else parts:
                here = [c for e in here for c in e if tag(c) == part]
            found = [t for t in map(text, here) if t is not None]
            if found:
                out[name] = found[0]
                break
    for name, names in fv.INVOICE_NAMES.items():
        out[name] = next((text(e) for e in node.iter() if tag(e) in names and text(e)), None)
    return out


def test_one_walk_equals_following_each_path(spark):
    """Random documents over the elements of the mapped paths, with repeats, gaps and blanks."""
    rng = random.Random(7)
    tags = sorted({p for paths in fv.INVOICE_PATHS.values() for path in paths for p in path.split("/")} | {n for names in fv.INVOICE_NAMES.values() for n in names})
    paths = [path.split("/") for paths in fv.INVOICE_PATHS.values() for path in paths]

    def document():
        root = ElementTree.Element(rng.choice(["CompNfse", "Nfse", "InfNfse", "LoteRps", "{http://x}CompNfse"]))
        for _ in range(rng.randint(0, 25)):
            here = root
            path = rng.choice(paths)
            for part in path[1:] if path[0] == root.tag else path:
                known = [c for c in here if c.tag == part]
                here = rng.choice(known) if known and rng.random() < 0.7 else ElementTree.SubElement(here, part)
            here.text = rng.choice([None, " ", "a", " b  c ", str(rng.random())])
            if rng.random() < 0.2:
                ElementTree.SubElement(here, rng.choice(tags)).text = "extra"
        return ElementTree.tostring(root)

    made = [(f"f{i}", "m", document()) for i in range(300)]
    got = {}
    for n in invoices.invoice_nodes(spark.createDataFrame(made, invoices.DOCUMENTS)).collect():
        got.setdefault(n.arquivo, []).append(n)
    for name, _, content in made:
        root = ElementTree.fromstring(content)
        for n, node in zip(got[name], invoices._nodes_of(root), strict=True):
            assert {c: n[c] for c in invoices.MAPPED} == _by_paths(node), name


def _spread_over_cells(text):
    """Every text through the joined folding of tables, and through the folding of a list."""
    return [[[text, "A"], ["", text]], [], [["É", text]]]


def test_folding_joined_cells_equals_folding_each(spark):
    texts = ["Ação", "ﬁm", "½ e ß", "한글", "ＦＵＬＬ　ｗ", "Σίσυφος", "a\\b\"c", "", "linha\nnova", "ﷺ", "é́"]
    frame = spark.createDataFrame([(t, _spread_over_cells(t)) for t in texts], "t string, c array<array<array<string>>>")
    one = frame.select("t", T.fold("t").alias("f"), folded_cells(F.col("c")).alias("c"), folded_parts(F.array(F.lit("X"), "t")).alias("p"))
    for r in one.collect():
        assert r["c"] == [[[r["f"], "a"], ["", r["f"]]], [], [["e", r["f"]]]] and r["p"] == ["x", r["f"]], r["t"]
    empty = spark.sql("select cast(array() as array<array<array<string>>>) as c, cast(null as array<string>) as n")
    assert empty.select(folded_cells(F.col("c")).alias("x")).first()["x"] == []


def test_accent_tables_cover_every_code_point():
    """The blocks that are looked through hold every character with a compatibility form."""
    outside = [c for c in range(0x80, sys.maxunicode + 1) if unicodedata.decomposition(chr(c)) and not any(c in block for block in T._DECOMPOSED)]
    assert outside == []


def test_node_text_is_what_elementtree_writes():
    """Attributes, prefixes, escapes, empty elements and tails; a place is met under several nodes and twice in one."""
    from xml.etree import ElementTree

    from claimweave.sources import invoices as X

    documents = [
        '<a xmlns="u:1" xmlns:p="u:2" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" p:k="1&quot;&lt;&#10;&#9;&#13;" z="&amp;"><b xsi:nil="true"/> t &gt; <p:c>x &amp; y</p:c>tail<c xml:lang="pt"> </c></a>',
        "<r><CompNfse><Numero> 1 </Numero><Numero>2</Numero><x-y>3</x-y></CompNfse> after <CompNfse><Numero/><e/></CompNfse>z</r>",
        "<r><a/><b xmlns='u:9'><c xmlns='u:8' k='v'/></b></r>",
    ]
    for document in documents:
        root = ElementTree.fromstring(document)
        for node in root.iter():
            assert X._text_of(node) == ElementTree.tostring(node, encoding="unicode")
    first, second = X._nodes_of(ElementTree.fromstring(documents[1]))
    assert X._describe(first)[1] == {"compnfse_numero": "1", "compnfse_numero_2": "2", "compnfse_x_y": "3"} and X._describe(second)[1] == {}
    root = X._node_place("CompNfse")
    assert root.child("{u:1}Numero") is root.below["{u:1}Numero"] and root.child("q" * 600).name.startswith("compnfse_q") and "q" * 600 not in root.below


def test_settlement_tables_are_cleaned_once(spark):
    """Summaries, headers and protocol lines come from one reading of the tables; the last summary of a document counts, and one without a name has no lines."""
    from claimweave.sources import settlement_docs as S

    labels = {"CNPJ": "12.345.678/0001-90", "Competência TMS": "01/2025", "Comp de Produção": "01/2025", "Dt Fechamento": "02/02/2025", "Valor Informado": "3,00", "Valor Liberado": "3,00", "Valor Glosado": "0,00"}

    def summary(name):
        return [["Nome Prestador", name], ["Número Processo", "P1/2025"], *([k, v] for k, v in labels.items())]

    head = ["Nr", "Valor Protocolo", "Valor Glosado", "Valor Aprovado"]
    line = lambda n: [n, "x", "3,00", "1,00", "2,00"]
    pages = [
        ("P1/2025", "D1", "a.pdf", 1, [summary("OLD"), [head, line("1")]]),
        ("P1/2025", "D1", "a.pdf", 70, [[line("2")]]),
        ("P1/2025", "D1", "a.pdf", 140, [[line("3")], summary("NEW")]),
        ("P1/2025", "D2", "a.pdf", 1, [[head, line("4")]]),
        ("P1/2025", None, "a.pdf", 1, [summary("OLD"), [head, line("5")]]),
    ]
    frame = spark.createDataFrame(pages, "numero_processo string, documento_id string, documento_nome string, page int, tables array<array<array<string>>>")
    rows = S.parse_settlement_tables(frame)
    got = sorted((r["documento_id"], r["nr"], r["nome_prestador"], r["pagina_pdf"]) for r in rows.collect())
    assert got == [("D1", "1", "NEW", 1), ("D1", "2", "NEW", 70), ("D1", "3", "NEW", 140)]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Generate posexplode") == 1
