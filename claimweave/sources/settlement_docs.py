"""Settlement document pages: a summary and protocol tables that run across pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import dates as D
from claimweave.functions import numbers as N
from claimweave.functions import text as T
from claimweave.functions.identity import fingerprint, occurrence_id
from claimweave.operators.ordered import carry_forward
from claimweave.schemas import SETTLEMENTS
from claimweave.sources.pages import DOCUMENT, clean_rows, fence, first_of, folded_cells, preferred, squash_cells, upto

_MONEY = (
    "valor_informado",
    "valor_aprovado_producao",
    "valor_glosado_producao",
    "valor_protocolo",
    "valor_aprovado_protocolo",
    "valor_glosado_protocolo",
)
_TEXT = ("nome_prestador", "competencia_tms", "competencia_producao", "nr", "nr_origem", "processo_recurso")
_PAGE_BLOCK = 64


def _value_after(rows: Column, folded: Column, label: str) -> Column:
    """Text right of a label; a label on the n-th line of its cell takes the n-th line there."""

    def in_row(row: Column, folded_row: Column) -> Column:
        def at_cell(cell: Column, i: Column) -> Column:
            lines = F.split(cell, "\n")
            line = F.array_position(lines, label).cast("int")

            def take(candidate: Column) -> Column:
                values = F.split(candidate, "\n")
                return F.when(
                    candidate != "",
                    F.when(line <= F.size(values), F.get(values, line - 1)).when(F.size(lines) == 1, F.get(values, F.lit(0))),
                )

            # Most cells don't hold the label at all; they need no split.
            return F.when(cell.contains(label) & (line > 0), first_of(F.transform(upto(row, i + 2), take)))

        return first_of(F.transform(folded_row, at_cell))

    return first_of(F.zip_with(rows, folded, in_row))


def _summary(rows: Column, folded: Column) -> Column:
    fields = [
        F.coalesce(*[_value_after(rows, folded, label) for label in labels]).alias(name)
        for name, labels in fv.SETTLEMENT_LABELS.items()
    ]
    return F.struct(*fields)


def _is_summary(folded: Column) -> Column:
    text = F.array_join(F.flatten(folded), " ")
    found = F.lit(True)
    for marker in fv.SETTLEMENT_MARKERS:
        found = found & text.contains(marker)
    return found


def _header_kind(folded: Column) -> Column:
    """Null when the cells are no protocol header, else whether they name an origin column."""
    found = F.exists(folded, lambda c: c.isin(*fv.PROTOCOL_HEADER["nr"]))
    for name, labels in fv.PROTOCOL_HEADER.items():
        if name != "nr":
            found = found & _any_cell_contains(folded, labels)
    return F.when(found, F.exists(folded, lambda c: c.contains(fv.PROTOCOL_ORIGIN_LABEL)))


def _any_cell_contains(cells: Column, labels: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for label in labels:
        hit = hit | F.exists(cells, lambda c: c.contains(label))  # noqa: B023  (used at once)
    return hit


def _header(folded: Column) -> Column:
    """``struct(origem, inicio)`` of the first header made of one to four joined rows."""
    depth = fv.PROTOCOL_HEADER_ROWS

    def attempt(k: Column) -> Column:
        start, size = (k / depth).cast("int"), (k % depth).cast("int") + 1
        rows = F.slice(folded, start + 1, size)
        width = F.array_max(F.transform(rows, lambda r: F.size(r)))
        joined = F.transform(
            F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))),
            lambda j: F.array_join(F.filter(F.transform(rows, lambda r: F.get(r, j)), lambda c: c != ""), " "),
        )
        kind = N.let(joined, _header_kind)
        inside = start + size <= F.size(folded)
        return F.when(inside, F.struct(kind.alias("origem"), (start + size).alias("inicio")))

    attempts = F.sequence(F.lit(0), F.greatest(F.size(folded) * depth - 1, F.lit(0)))
    return F.get(F.filter(F.transform(attempts, attempt), lambda h: h["origem"].isNotNull()), F.lit(0))


def _protocol_cells(rows: Column, folded: Column, start: Column) -> Column:
    """Leading number, second cell and the last three cells of every protocol row."""

    def values(row: Column, folded_row: Column) -> Column:
        filled = F.filter(row, lambda c: c != "")
        own_header = _header_kind(folded_row).isNotNull()
        good = (F.size(filled) >= 4) & F.get(filled, F.lit(0)).rlike("[0-9]") & ~own_header
        return F.when(
            good,
            F.struct(
                F.get(filled, F.lit(0)).alias("nr"),
                F.get(filled, F.lit(1)).alias("segundo"),
                F.try_element_at(filled, F.lit(-3)).alias("valor_protocolo"),
                F.try_element_at(filled, F.lit(-2)).alias("valor_glosado_protocolo"),
                F.try_element_at(filled, F.lit(-1)).alias("valor_aprovado_protocolo"),
            ),
        )

    return F.filter(F.zip_with(upto(rows, start + 1), upto(folded, start + 1), values), lambda v: v.isNotNull())


def parse_settlement_tables(pages: DataFrame) -> DataFrame:
    """One row per protocol line with the summary of its document; ``erro`` marks broken values.

    Each table becomes one short row (its summary, or its header flag and its protocol cells); these rows are shuffled
    once, to their document, where they get its summary and the header of an earlier table is carried forward over them.
    """
    tables = pages.select(*DOCUMENT, "page", F.posexplode("tables").alias("tabela", "_t"))
    cleaned = fence(tables, _linhas=clean_rows(F.col("_t"))).drop("_t").filter(F.size("_linhas") > 0)
    folded = fence(cleaned, _dobradas=F.get(folded_cells(F.array("_linhas")), F.lit(0)))
    kind = fence(folded, _resumo=_is_summary(F.col("_dobradas"))).dropna(subset=list(DOCUMENT))
    other = ~F.col("_resumo")
    headed = fence(kind, _lisas=F.when(other, squash_cells(F.col("_dobradas"))))
    headed = fence(headed, _cabecalho=F.when(other, _header(F.col("_lisas"))))
    short = fence(
        headed,
        _sumario=F.when(F.col("_resumo"), _summary(F.col("_linhas"), F.col("_dobradas"))),
        _celulas=F.when(other, _protocol_cells(F.col("_linhas"), F.col("_lisas"), F.coalesce("_cabecalho.inicio", F.lit(0)))),
    ).select(
        *DOCUMENT,
        "page",
        "tabela",
        F.expr(f"page div {_PAGE_BLOCK}").alias("_bloco"),
        F.col("_cabecalho.origem").alias("_origem"),
        F.when(F.col("_resumo"), F.struct("page", "tabela")).alias("_lugar"),
        "_sumario",
        "_celulas",
    )
    # The last summary of the document; its tables were cleaned once, for this and for their protocol lines.
    short = short.withColumn("resumo", F.max_by("_sumario", "_lugar").over(W.partitionBy(*DOCUMENT))).filter("resumo is not null").drop("_sumario", "_lugar")
    order = ["page", "tabela"]
    carried = carry_forward(short, list(DOCUMENT), order, "_bloco", "_origem", "_com_origem")
    lines = carried.filter(F.col("_com_origem").isNotNull()).select(*DOCUMENT, "page", "_com_origem", "resumo", F.inline("_celulas"))
    own = [c for c in fv.SETTLEMENT_LABELS if c != "numero_processo"]
    joined = (
        lines.withColumnRenamed("numero_processo", "processo_origem")
        .select(
            "*",
            *[F.col(f"resumo.{c}").alias(c) for c in own],
            F.coalesce(T.process_number("resumo.numero_processo"), F.col("processo_origem")).alias("numero_processo"),
            F.col("resumo.numero_processo").isNull().alias("_sem_processo"),
            F.when(F.col("_com_origem"), F.col("segundo")).otherwise("").alias("nr_origem"),
        )
    )
    return _typed(joined)


def _typed(joined: DataFrame) -> DataFrame:
    required = [c for c in fv.SETTLEMENT_LABELS if c not in (*fv.SETTLEMENT_OPTIONAL_LABELS, "numero_processo")]
    bad = F.col("_sem_processo")
    for name in required:
        bad = bad | F.col(name).isNull()
    read = joined
    for name in _MONEY:
        # One step each, as the generated code of all of them together would be too large to compile.
        read = fence(read, **{f"_{name}": N.parse_document_number(name)})
        read = fence(read, **{f"_{name}_ruim": N.bad_document_number(F.col(name))})
        bad = bad | F.col(f"_{name}_ruim")
    joined = fence(read, _fechamento=D.parse_document_date("data_fechamento"))
    bad = bad | (T.edge_trim("data_fechamento").isNotNull() & F.col("_fechamento").isNull())
    columns = {
        "cnpj": T.blank_to_null(T.digits("cnpj")),
        "data_fechamento": F.col("_fechamento"),
        **{name: F.col(f"_{name}") for name in _MONEY},
        **{name: T.edge_trim(name) for name in _TEXT},
        "pagina_pdf": F.col("page").cast("bigint"),
        "erro": F.coalesce(bad, F.lit(False)),
    }
    names = [c for c in SETTLEMENTS.fieldNames() if c != "id_registro"]
    return joined.withColumns(columns).select(*names, "erro")


def parse_legacy_settlement(pages: DataFrame) -> DataFrame:
    """Summary rows of older documents from the page text; all three blocks must be present."""
    text = F.col("text")
    marked = fence(pages, _marca=T.fold(text).contains(fv.LEGACY_MARKER)).filter("_marca")
    parts = {f"_prestador{i}": T.first_match(text, fv.LEGACY_PROVIDER, i) for i in range(1, 5)}
    parts |= {f"_total{i}": T.first_match(text, fv.LEGACY_TOTALS, i) for i in range(1, 4)}
    parts |= {"_fechado": T.first_match(text, fv.LEGACY_CLOSED, 1), "_explicito": T.first_match(text, fv.LEGACY_DENIED, 1)}
    found = fence(marked, **parts).filter("_prestador1 is not null and _total1 is not null and _fechado is not null")
    provider = [F.col(f"_prestador{i}") for i in range(1, 5)]
    closed, explicit = F.col("_fechado"), F.col("_explicito")
    numbers = {"_informado": F.col("_total1"), "_aprovado": F.col("_total3"), "_negado": explicit}
    read, bad = found, F.lit(False)
    for name, value in numbers.items():
        # One step each, as the generated code of all of them together would be too large to compile.
        read = fence(read, **{name: N.parse_document_number(value)})
        read = fence(read, **{f"{name}_ruim": F.coalesce(N.bad_document_number(value), F.lit(False))})
        bad = bad | F.col(f"{name}_ruim")
    informed, approved = F.col("_informado"), F.col("_aprovado")
    denied = F.when(explicit.isNotNull(), F.col("_negado")).otherwise((informed - approved).cast(N.MONEY))
    values = {
        "cnpj": N.provider_cnpj(provider[2]),
        "nome_prestador": T.edge_trim(provider[3]),
        "numero_processo": F.col("numero_processo"),
        "competencia_tms": D.internal_process_month(provider[0]),
        "competencia_producao": provider[1],
        "data_fechamento": D.parse_document_date(closed),
        "valor_informado": informed,
        "valor_aprovado_producao": approved,
        "valor_glosado_producao": denied,
        "processo_origem": F.col("numero_processo"),
        "documento_id": F.col("documento_id"),
        "documento_nome": F.col("documento_nome"),
        "pagina_pdf": F.col("page").cast("bigint"),
    }
    columns = [
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SETTLEMENTS.fields if f.name != "id_registro"
    ]
    return read.select(*columns, bad.alias("erro"))


def parse_settlements(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): tables first, legacy text for documents they gave nothing for.

    A document with a broken value is rejected as a whole; one without any record gives neither rows nor a reject.
    """
    key = ["processo_origem", "documento_id"]
    layouts = [parse_settlement_tables(pages), parse_legacy_settlement(pages)]
    ranked = preferred(layouts, None, key)
    names = [c for c in SETTLEMENTS.fieldNames() if c != "id_registro"]
    clean = ranked.filter("not rejeitado").withColumn("_fp", fingerprint(names))
    # Equal records share document and page, so a group is bounded by one page.
    number = F.row_number().over(W.partitionBy("_fp").orderBy("pagina_pdf"))
    rows = clean.withColumn("id_registro", occurrence_id("_fp", number)).select(*SETTLEMENTS.fieldNames())
    return rows, ranked.filter("rejeitado").select(*key).distinct()
