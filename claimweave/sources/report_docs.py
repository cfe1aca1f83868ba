"""Account report pages to report rows.

Everything about one page happens inside its row with array functions, so parsing needs
no shuffle; only the choice between the two layouts compares documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import dates as D
from claimweave.functions import numbers as N
from claimweave.functions import text as T
from claimweave.functions.identity import fingerprint
from claimweave.schemas import REPORT_ROWS
from claimweave.sources.pages import DOCUMENT, clean_rows, fence, folded_cells, folded_parts, preferred, squash_cells, upto

FIELDS = tuple(fv.REPORT_LABELS)


def remittance_of_file(name: Column | str) -> Column:
    base = F.regexp_extract(T.fold(name), r"([^/]*)/*\z", 1)
    return T.first_match(base, fv.REPORT_FILE_NAME, 1).try_cast("bigint")


def _header_places(folded_cells: Column) -> Column:
    """Zero-based cell of each field, null unless every field has one."""

    def place(labels: tuple[str, ...]) -> Column:
        return F.array_position(F.transform(folded_cells, lambda c: c.isin(*labels)), True)

    found = F.array(*[place(labels) for labels in fv.REPORT_LABELS.values()])
    return N.let(found, lambda places: F.when(~F.exists(places, lambda p: p == 0), F.transform(places, lambda p: (p - 1).cast("int"))))


def _header(folded_rows: Column) -> Column:
    """``struct(places, start)`` of the first one- or two-row header in the first five rows."""

    def attempt(k: Column) -> Column:
        at, two = (k / 2).cast("int"), (k % 2) == 1
        one = F.get(folded_rows, at)
        next_row = F.coalesce(F.get(folded_rows, at + 1), F.array().cast("array<string>"))
        joined = F.zip_with(one, next_row, lambda a, b: F.trim(F.concat_ws(" ", a, b)))
        places = N.let(F.when(two, joined).otherwise(one), _header_places)
        found = F.struct(places.alias("p"), (at + 1 + two.cast("int")).alias("inicio"))
        return F.when(at < F.size(folded_rows), found)

    attempts = F.transform(F.sequence(F.lit(0), F.lit(9)), attempt)
    return F.get(F.filter(attempts, lambda h: h["p"].isNotNull()), F.lit(0))


def _table_values(rows: Column, folded: Column) -> Column:
    """One ``struct`` of field texts per data row of a table, from its cleaned cells and their folded copies."""
    table = F.struct(rows.alias("r"), squash_cells(folded).alias("f"))
    headed = N.let(table, lambda t: F.struct(t["r"].alias("r"), t["f"].alias("f"), _header(t["f"]).alias("h")))
    return N.let(headed, lambda t: _rows_below(t["r"], t["f"], t["h"]))


def _rows_below(rows: Column, folded: Column, header: Column) -> Column:
    def values(row: Column, folded_row: Column) -> Column:
        cells = [F.coalesce(F.get(row, header["p"][i]), F.lit("")).alias(f) for i, f in enumerate(FIELDS)]
        return F.when(_header_places(folded_row).isNull(), F.struct(*cells))

    start = header["inicio"] + 1
    data = F.zip_with(upto(rows, start), upto(folded, start), values)
    return F.when(header.isNotNull(), F.filter(data, lambda v: v.isNotNull()))


def _text_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), T.LINE_BREAK), lambda x: F.trim(x)), lambda x: x != "")


def _text_values(lines: Column, folded: Column) -> Column:
    """Field texts from ``label: value`` lines; the first matching line of a field counts."""

    def field(labels: tuple[str, ...]) -> Column:
        pattern = r"\A(?:" + "|".join(labels) + r")\s*[:\-]?\s*(.+)\z"
        at = F.array_position(F.transform(folded, lambda x: x.rlike(pattern)), True).cast("int") - 1

        def value(line: Column) -> Column:
            size = F.length(F.regexp_extract(F.get(folded, at), pattern, 1))
            return F.substring(line, F.length(line) - size + 1, size)

        return F.coalesce(F.btrim(value(F.get(lines, at)), F.lit(fv.EDGE_PUNCTUATION)), F.lit(""))

    return F.struct(*[field(labels).alias(f) for f, labels in fv.REPORT_LABELS.items()])


def _record(values: Column, file_remittance: Column) -> Column:
    """Typed record of the field texts; ``completo`` and ``erro`` say what became of it."""
    groups = F.regexp_extract_all(values["numero_conta"], F.lit(r"(\d+)"), F.lit(1))
    parts = {
        "grupos": F.when(F.size(groups) == 3, F.slice(groups, 2, 2)).otherwise(groups),
        "atendimento": T.digits(values["cd_atendimento"]),
        "remessa": F.coalesce(T.digits(values["cd_remessa"]).try_cast("bigint"), file_remittance),
        "paciente": T.edge_trim(values["nome_paciente"]),
        "mes": D.parse_document_month(values["competencia"]),
        "valor": N.parse_document_number(values["valor"]),
        "com_mes": T.edge_trim(values["competencia"]).isNotNull(),
        "com_valor": T.edge_trim(values["valor"]).isNotNull(),
    }
    return N.let(F.struct(*[v.alias(n) for n, v in parts.items()]), lambda p: _assembled(values, p))


def _assembled(values: Column, p: Column) -> Column:
    split = (p["atendimento"] == "") & (F.size(p["grupos"]) == 2)
    account = F.when(split, F.get(p["grupos"], F.lit(0))).otherwise(values["numero_conta"])
    attendance = F.when(split, F.get(p["grupos"], F.lit(1))).otherwise(p["atendimento"])
    has_month, has_value = p["mes"].isNotNull(), p["valor"].isNotNull()
    return F.struct(
        p["remessa"].alias("cd_remessa"),
        p["paciente"].alias("nome_paciente"),
        T.edge_trim(values["numero_guia"]).alias("numero_guia"),
        T.edge_trim(account).alias("numero_conta"),
        attendance.try_cast("bigint").alias("cd_atendimento"),
        p["mes"].alias("competencia"),
        p["valor"].alias("valor"),
        (p["remessa"].isNotNull() & p["paciente"].isNotNull() & has_month & has_value).alias("completo"),
        ((p["com_valor"] & ~has_value) | (p["com_mes"] & ~has_month)).alias("erro"),
    )


def _open(pages: DataFrame, records: Column) -> DataFrame:
    return pages.select(*DOCUMENT, F.col("page").cast("bigint").alias("pagina_pdf"), F.inline(records))


def parse_report_tables(pages: DataFrame) -> DataFrame:
    """Records of the report tables; a page without any takes its labelled text."""
    named = pages.withColumn("_remessa", remittance_of_file("documento_nome"))
    cleaned = fence(named, _tabelas=F.transform("tables", clean_rows))
    folded = fence(cleaned, _dobradas=folded_cells(F.col("_tabelas")))
    staged = fence(folded, _valores=F.flatten(F.zip_with("_tabelas", "_dobradas", lambda t, f: F.coalesce(_table_values(t, f), F.array().cast(_VALUES)))))
    typed = fence(staged, _todas=F.transform("_valores", lambda v: _record(v, F.col("_remessa"))))
    kept = typed.withColumn("_linhas", F.filter("_todas", lambda r: r["completo"] | r["erro"]))
    lines = fence(kept, _frases=F.when(~F.coalesce(F.exists("_linhas", lambda r: r["completo"]), F.lit(False)), _text_lines(F.col("text"))))
    lines = fence(lines, _frases_dobradas=folded_parts(F.col("_frases"), "\n"))
    fallback = fence(
        lines,
        _texto=F.when(F.col("_frases").isNotNull(), F.transform(F.array(_text_values(F.col("_frases"), F.col("_frases_dobradas"))), lambda v: _record(v, F.col("_remessa")))),
    )
    records = F.when(F.col("_texto").isNull(), F.col("_linhas")).otherwise(F.concat(F.coalesce("_linhas", F.array().cast(fallback.schema["_texto"].dataType)), "_texto"))
    return _open(fallback, records).filter("completo or erro")


_VALUES = "array<struct<" + ",".join(f"{f}:string" for f in FIELDS) + ">>"


def _table_words() -> tuple[Column, Column]:
    """(top of the header, words between header and total) of one page."""
    low, high = fv.REPORT_HEADER_X
    words = F.col("words")
    folded = F.col("_dobradas")
    head = F.filter(
        words, lambda w, i: (w["x0"] >= low) & (w["x0"] < high) & F.get(folded, i).startswith(fv.REPORT_HEADER_WORD)
    )
    top_of_header = F.array_min(F.transform(head, lambda w: w["top"]))
    header_top = F.col("_topo")
    totals = F.filter(words, lambda w, i: (w["top"] > header_top) & F.get(folded, i).startswith(fv.REPORT_TOTAL_WORD))
    total_top = F.coalesce(F.array_min(F.transform(totals, lambda w: w["top"])), F.col("height"))
    end = N.let(total_top, lambda t: F.filter(words, lambda w: (w["top"] > header_top + fv.REPORT_HEADER_GAP) & (w["top"] < t)))
    return top_of_header, end


def _word_values(month: Column) -> Column:
    """Field texts of the table rows of one page of positioned words."""
    data = F.col("_dados")
    tops = F.array_sort(F.array_distinct(F.transform(data, lambda w: w["top"])))
    # A row starts at the first word more than the tolerance below the start of the row before.
    anchors = F.aggregate(
        tops,
        F.array().cast("array<double>"),
        lambda rows, top: F.when(
            (F.size(rows) == 0) | (top - F.element_at(rows, -1) > fv.REPORT_ROW_TOLERANCE), F.concat(rows, F.array(top))
        ).otherwise(rows),
    )

    def values(anchor: Column) -> Column:
        return N.let(ordered_row(anchor), texts_of)

    def ordered_row(anchor: Column) -> Column:
        row = F.filter(data, lambda w: (w["top"] >= anchor) & (w["top"] - anchor <= fv.REPORT_ROW_TOLERANCE))
        return F.array_sort(F.transform(row, lambda w: F.struct(w["x0"].alias("x0"), w["top"].alias("top"), w["text"].alias("text"))))

    def texts_of(ordered: Column) -> Column:
        def between(field: str) -> Column:
            start, end = fv.REPORT_COLUMN_X[field]
            inside = F.filter(ordered, lambda w: (w["x0"] >= start) & (w["x0"] < F.lit(end)))
            return F.trim(F.array_join(F.transform(inside, lambda w: w["text"]), " "))

        texts = {f: between(f) for f in fv.REPORT_COLUMN_X}
        texts["cd_remessa"] = F.lit("")
        texts["competencia"] = F.coalesce(D.month_year(month), F.lit(""))
        return F.struct(*[texts[f].alias(f) for f in FIELDS])

    return F.when(F.col("_topo").isNotNull(), F.transform(anchors, values))


def parse_report_words(pages: DataFrame) -> DataFrame:
    """Records of the fixed-width layout; the remittance comes from the file name."""
    named = pages.filter(F.size("words") > 0).withColumns(
        {"_remessa": remittance_of_file("documento_nome"), "_mes": D.parse_report_month_label(F.coalesce("text", F.lit("")))}
    )
    top, data = _table_words()
    folded = fence(named, _dobradas=folded_parts(F.transform("words", lambda w: w["text"])))
    placed = fence(fence(folded, _topo=top), _dados=data)
    staged = fence(placed, _todos=_word_values(F.col("_mes")))
    kept = staged.withColumn(
        "_valores",
        F.filter(
            "_todos",
            lambda v: (v["nome_paciente"] != "")
            & (N.parse_document_number(v["valor"]).isNotNull() | N.bad_document_number(v["valor"])),
        ),
    )
    typed = kept.withColumn("_linhas", F.transform("_valores", lambda v: _record(v, F.col("_remessa"))))
    return _open(typed, F.col("_linhas")).filter("completo or erro")


def parse_reports(words: DataFrame, tables: DataFrame, run_ts: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): the word layout first, tables and text for documents it gave nothing for.

    A document with a broken value, or without any row, is rejected as a whole. Each parser runs once over
    its pages; the records of a document meet in one window, which holds no more than its pages gave.
    """
    key = list(DOCUMENT[:2])
    listed = words.select(*DOCUMENT).unionByName(tables.select(*DOCUMENT)).distinct()
    ranked = preferred([parse_report_words(words), parse_report_tables(tables)], listed, key)
    names = [c for c in REPORT_ROWS.fieldNames() if c not in ("id_registro", "status_processo", "extraido_em")]
    good = ranked.filter("not rejeitado").select(*names)
    rows = good.withColumn("id_registro", F.sha2(fingerprint(names), 256)).withColumn("extraido_em", run_ts)
    return rows, ranked.filter("rejeitado").select(*DOCUMENT).distinct()
