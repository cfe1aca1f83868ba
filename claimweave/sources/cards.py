"""Process listing cards and document trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import dates as D
from claimweave.functions import text as T
from claimweave.sources.pages import fence, folded_parts

_STATUS = rf"(?i)\b({fv.PROCESS_STATUSES})\b"
_DATE = r"\b(\d{2}/\d{2}/\d{4})\b"


def clean_reason(c: Column | str) -> Column:
    """Reason text without the trailing page links, more/less marks and quotes."""
    text = F.regexp_replace(T.squash(c), "(?is)" + fv.REASON_CUT + ".*", "")
    text = F.regexp_replace(text, "(?i)" + fv.REASON_MORE, "")
    return T.blank_to_null(F.btrim(text, F.lit(fv.REASON_QUOTES)))


def _status_after_number(header: Column) -> Column:
    rest = F.regexp_replace(header, r"(?is)\A.*?" + fv.PROCESS_NUMBER, "")
    status = T.edge_trim(rest)
    return F.when(header.rlike("(?i)" + fv.PROCESS_NUMBER) & (F.length(status) <= 80), F.upper(status))


def _labelled(text: Column, folded: Column) -> Column:
    """Value after the earliest label, up to the next known label."""

    def place(labels: tuple[str, ...], within: Column) -> Column:
        hits = [
            F.when(F.instr(within, label) > 0, F.struct(F.instr(within, label).alias("p"), F.lit(len(label)).alias("n")))
            for label in labels
        ]
        return F.array_min(F.array_compact(F.array(*hits)))

    start = place(fv.TYPE_LABELS, folded)
    offset = start["p"] + start["n"]
    tail = F.substring(text, offset, F.length(text))
    stop = place(fv.TYPE_STOP_LABELS, F.substring(folded, offset, F.length(text)))
    value = F.when(stop.isNull(), tail).otherwise(F.substring(tail, F.lit(1), stop["p"] - 1))
    value = F.ltrim(value, F.lit(fv.EDGE_PUNCTUATION))
    value = F.regexp_replace(value, r"(?i)\b(FINALIZADO|TRAMITANDO)\b.*$", "")
    return F.when(start.isNull(), text).otherwise(T.blank_to_null(T.squash(value)))


def _type_from_lines(lines: Column, folded: Column, status: Column) -> Column:
    """The one or two lines after the (folded) status, before a date or the closing note."""
    at = F.array_position(folded, status).cast("int")
    rest = F.greatest(F.size(lines), F.lit(1))
    tail = F.arrays_zip(F.slice(lines, at + 1, rest).alias("x"), F.slice(folded, at + 1, rest).alias("d"))
    ends = F.transform(tail, lambda t: t["x"].rlike(_DATE) | t["d"].contains("finalizado pelo"))
    stop = F.array_position(ends, True).cast("int")
    head = F.when(stop > 0, F.slice(tail, F.lit(1), stop - 1)).otherwise(tail)
    kept = F.transform(F.filter(head, lambda t: ~t["d"].isin(*fv.TYPE_SKIPPED_LINES)), lambda t: t["x"])
    return F.when(at > 0, T.blank_to_null(T.squash(F.array_join(F.slice(kept, 1, 2), " "))))


def parse_process_cards(cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): typed process rows; cards without a process number are rejected."""
    extra = [c for c in cards.columns if c not in ("numero", "cabecalho", "texto", "linhas", "tipo", "data", "motivo", "href")]
    header = T.squash(F.coalesce("cabecalho", F.lit("")))
    text = T.squash(F.coalesce("texto", F.lit("")))
    base = cards.withColumns(
        {
            "_cabecalho": header,
            "_texto": text,
            "_tipo": T.squash(F.coalesce("tipo", F.lit(""))),
            "_linhas": F.filter(F.transform(F.coalesce("linhas", F.array().cast("array<string>")), T.squash), lambda x: x != ""),
            "numero_processo": T.process_number(F.coalesce(T.blank_to_null("numero"), header)),
        }
    )
    status = F.coalesce(
        F.upper(T.first_match("_cabecalho", _STATUS)),
        F.upper(T.first_match("_texto", _STATUS)),
        _status_after_number(F.col("_cabecalho")),
        F.lit(fv.STATUS_UNKNOWN),
    )
    named = fence(base, status_processo=status)
    # One folding for the type, the status and all lines; squashed texts hold no line feed.
    named = fence(named, _dobrado=folded_parts(F.concat(F.array("_tipo", "status_processo"), "_linhas"), "\n"))
    folded_lines = F.slice("_dobrado", F.lit(3), F.greatest(F.size("_linhas"), F.lit(0)))
    day = F.coalesce(T.first_match(T.squash(F.coalesce("data", F.lit(""))), _DATE), T.first_match("_texto", _DATE))
    rows = named.filter(F.col("numero_processo").isNotNull()).select(
        "numero_processo",
        "status_processo",
        F.when(F.col("_tipo") != "", _labelled(F.col("_tipo"), F.get("_dobrado", F.lit(0))))
        .otherwise(_type_from_lines(F.col("_linhas"), folded_lines, F.get("_dobrado", F.lit(1))))
        .alias("tipo_processo_assunto"),
        D.parse_statement_date(day).alias("data_abertura"),
        clean_reason(F.coalesce("motivo", F.lit(""))).alias("motivo_finalizacao"),
        T.blank_to_null(F.trim("href")).alias("url_visualizacao"),
        *extra,
    )
    return rows, cards.filter(T.process_number(F.coalesce(T.blank_to_null("numero"), header)).isNull())


def canonical_sector(c: Column | str) -> Column:
    bare = F.btrim(F.regexp_replace(T.fold(c), T.WHITESPACE, ""), F.lit("/"))
    return F.when(bare.isin(*fv.SETTLEMENT_SPELLINGS), fv.SECTOR_SETTLEMENT).otherwise(bare)


def is_target_document(sector: Column, name: Column) -> Column:
    """Documents worth parsing in the two target sectors."""
    folded = T.fold(name)
    stem = F.regexp_replace(F.regexp_extract(folded, r"([^/]*)/*\z", 1), r"(?<=.)\.[^.]*\z", "")
    excluded = F.lit(False)
    for word in fv.PAYMENT_EXCLUDED_WORDS:
        excluded = excluded | folded.contains(word)
    settlement = ~stem.rlike(fv.SETTLEMENT_EXCLUDED_STEM) & ~folded.contains(fv.SETTLEMENT_EXCLUDED_WORD)
    return (
        F.when(folded == "", True)
        .when(sector == fv.SECTOR_SETTLEMENT, settlement)
        .when(sector == fv.SECTOR_PAYMENT, ~excluded)
        .otherwise(False)
    )


def is_report_document(name: Column | str) -> Column:
    base = F.regexp_extract(T.fold(name), r"([^/]*)/*\z", 1)
    return base.rlike(fv.REPORT_FILE_NAME)


def target_documents(tree: DataFrame) -> DataFrame:
    """Documents to parse, with their sector as written and as a canonical name."""
    sectors = tree.select("numero_processo", F.explode("setores").alias("s"))
    documents = sectors.select(
        "numero_processo", F.trim(F.coalesce("s.setor", F.lit(""))).alias("setor"), F.explode("s.documentos").alias("d")
    ).select(
        "numero_processo",
        "setor",
        canonical_sector("setor").alias("setor_canonico"),
        F.trim(F.coalesce("d.id", F.lit(""))).alias("documento_id"),
        F.trim(F.coalesce("d.nome", F.lit(""))).alias("documento_nome"),
    )
    wanted = F.col("setor_canonico").isin(fv.SECTOR_SETTLEMENT, fv.SECTOR_PAYMENT)
    return documents.filter(wanted & is_target_document(F.col("setor_canonico"), F.col("documento_nome")))


def new_report_documents(documents: DataFrame, reports: DataFrame) -> DataFrame:
    """Account report files of (``documento_id``, ``documento_nome``) that were not loaded yet."""
    named = documents.filter(is_report_document("documento_nome") & (F.trim("documento_id") != ""))
    return named.join(reports.select("documento_id").distinct(), "documento_id", "left_anti")
