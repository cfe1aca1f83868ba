"""Payment and provider invoice documents from their whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import text as T
from claimweave.schemas import COMMITMENTS, PROVIDER_INVOICES
from claimweave.sources.pages import DOCUMENT

COMMITMENT, INVOICE = "EMPENHO", "NFS_E"


def _value_of(text: Column, labels: tuple[str, ...]) -> Column:
    """Rest of the line (or the next line) after the first label that occurs."""
    tail = r"[ \t]*[:\-]?[ \t]*(?:\r?\n[ \t]*)?([^\r\n]+)"
    found = [F.when(text.rlike(f"(?iu)(?:{x}){tail}"), T.squash(F.regexp_extract(text, f"(?iu)(?:{x}){tail}", 1))) for x in labels]
    return T.blank_to_null(F.coalesce(*found))


def _before_label(value: Column) -> Column:
    return T.edge_trim(F.regexp_replace(value, "(?ius)" + fv.NEXT_LABEL + r".*\z", ""))


def _bank(agency: Column, folded: Column) -> Column:
    known = [F.when(folded.contains(marker), F.lit(name)) for marker, name in fv.BANKS.items()]
    parts = F.transform(F.split(agency, "/"), lambda x: F.trim(x))
    part = F.get(F.filter(parts, lambda x: x.rlike("[A-Za-zÀ-ÿ]")), F.lit(0))
    named = F.when(T.fold(part).startswith("banco "), part).otherwise(F.concat(F.lit("Banco "), part))
    return F.coalesce(*known, named)


def _provider(text: Column) -> Column:
    section = F.coalesce(T.first_match(text, "(?is)" + fv.PROVIDER_SECTION), text)
    return F.coalesce(
        T.first_match(text, "(?iu)" + fv.PROVIDER_SHEET),
        T.first_match(section, "(?iu)" + fv.PROVIDER_ID),
        T.first_match(text, "(?iu)" + fv.PROVIDER_ID_ANYWHERE),
    )


def parse_payment_docs(texts: DataFrame) -> DataFrame:
    """Commitment and invoice records; one document may give both kinds."""
    base = texts.withColumns(
        {"_nome": T.fold("documento_nome"), "_dobrado": T.fold(F.coalesce("text", F.lit(""))), "_texto": F.coalesce("text", F.lit(""))}
    )
    name, folded, text = F.col("_nome"), F.col("_dobrado"), F.col("_texto")
    is_commitment = name.contains(fv.COMMITMENT_WORD_IN_NAME) | folded.contains(fv.COMMITMENT_WORD_IN_TEXT)
    is_invoice = name.startswith(fv.INVOICE_NAME_PREFIX)
    for word in fv.INVOICE_WORDS_IN_NAME:
        is_invoice = is_invoice | name.contains(word)
    for word in fv.INVOICE_WORDS_IN_TEXT:
        is_invoice = is_invoice | folded.contains(word)
    agency = _before_label(_value_of(text, fv.BANK_AGENCY_LABELS))
    found = base.withColumns(
        {
            "_agencia": F.when(is_commitment, agency),
            "_conta": F.when(is_commitment, _before_label(_value_of(text, fv.ACCOUNT_LABELS))),
            "_numero": F.when(is_invoice, T.identifier_only(F.coalesce(*[T.first_match(text, "(?iu)" + p) for p in fv.INVOICE_NUMBERS]))),
            "_chave": F.when(is_invoice, T.identifier_only(_value_of(text, fv.ACCESS_KEY_LABELS))),
            "_prestador": F.when(is_invoice, T.identifier_only(_provider(text))),
        }
    ).withColumn("_banco", F.when(is_commitment, _bank(F.col("_agencia"), folded)))
    parts = F.filter(F.transform(F.split("_agencia", "/"), lambda x: T.squash(x)), lambda x: x != "")
    none = F.lit(None).cast("string")

    def record(kind: str, **values: Column) -> Column:
        names = (
            "banco",
            "banco_agencia",
            "codigo_conta",
            "codigo_agencia",
            "conta",
            "numero_nfse",
            "chave_acesso_nfse",
            "cnpj_cpf_nif_prestador",
        )
        return F.struct(F.lit(kind).alias("tipo_documento"), *[values.get(n, none).alias(n) for n in names])

    kinds = F.array(
        F.when(
            is_commitment,
            record(
                COMMITMENT,
                banco=F.col("_banco"),
                banco_agencia=F.col("_agencia"),
                codigo_conta=T.edge_trim(F.get(parts, F.lit(0))),
                codigo_agencia=F.when(F.size(parts) >= 2, T.edge_trim(F.element_at(parts, -1))),
                conta=F.col("_conta"),
            ),
        ),
        F.when(
            is_invoice,
            record(
                INVOICE,
                numero_nfse=F.col("_numero"),
                chave_acesso_nfse=F.col("_chave"),
                cnpj_cpf_nif_prestador=F.col("_prestador"),
            ),
        ),
    )
    opened = found.select(*DOCUMENT, F.inline(F.filter(kinds, lambda k: k.isNotNull())))
    # The identity keeps the combined bank/agency field that is no longer a column.
    hashed = (
        "numero_processo",
        "tipo_documento",
        "documento_id",
        "documento_nome",
        "banco",
        "banco_agencia",
        "conta",
        "numero_nfse",
        "chave_acesso_nfse",
        "cnpj_cpf_nif_prestador",
    )
    record_json = F.to_json(F.struct(*sorted(hashed)), {"ignoreNullFields": "false"})
    return opened.withColumn("id_registro", F.sha2(record_json, 256)).drop("banco_agencia")


def route_payment_docs(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(commitments, provider invoices, rejects of unknown kind)."""
    kind = F.upper(F.coalesce("tipo_documento", F.lit("")))
    return (
        records.filter(kind == COMMITMENT).select(*COMMITMENTS.fieldNames()),
        records.filter(kind == INVOICE).select(*PROVIDER_INVOICES.fieldNames()),
        records.filter(~kind.isin(COMMITMENT, INVOICE)),
    )


def document_completeness(documents: DataFrame, records: DataFrame) -> DataFrame:
    """Per process: which kinds of document are missing and which kinds lack fields."""

    def some(condition: Column) -> Column:
        return F.coalesce(F.bool_or(condition), F.lit(False))

    def filled(*names: str) -> Column:
        good = F.lit(True)
        for n in names:
            good = good & (F.coalesce(F.col(n), F.lit("")) != "")
        return good

    is_commitment, is_invoice = F.col("tipo_documento") == COMMITMENT, F.col("tipo_documento") == INVOICE
    flags = records.groupBy("numero_processo").agg(
        some(is_commitment).alias("_e"),
        some(is_invoice).alias("_n"),
        some(is_commitment & filled("codigo_conta", "codigo_agencia", "conta")).alias("_ec"),
        some(is_invoice & filled("numero_nfse", "chave_acesso_nfse", "cnpj_cpf_nif_prestador")).alias("_nc"),
    )
    processes = documents.select("numero_processo").distinct()
    joined = processes.join(flags, "numero_processo", "left")
    false = F.lit(False)
    return joined.select(
        "numero_processo",
        (~F.coalesce("_e", false)).alias("falta_empenho"),
        (~F.coalesce("_n", false)).alias("falta_nota_fiscal"),
        (~F.coalesce("_ec", false)).alias("empenho_incompleto"),
        (~F.coalesce("_nc", false)).alias("nota_fiscal_incompleta"),
    )
