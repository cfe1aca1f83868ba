"""Deterministic row identity: fingerprints, surrogate keys, invoice identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions.text import _col, digits

_UNIT = "\x1f"
_NULL = "\x00"


def canonical_text(columns: Sequence[str | Column]) -> Column:
    """All values as text with a separator and a null mark, in the given order."""
    return F.concat_ws(_UNIT, *[F.coalesce(_col(c).cast("string"), F.lit(_NULL)) for c in columns])


def row_digest(columns: Sequence[str | Column]) -> Column:
    return F.md5(canonical_text(columns))


# First byte of a short id: what follows is the id itself, or the bytes that its hexadecimal digits spell.
_HEX_ID, _PLAIN_ID = bytearray(b"\x01"), bytearray(b"\x00")


def short_id(name: Column | str) -> Column:
    """A text id in as few bytes as it can be told from; the digests that serve as ids take half."""
    name = _col(name)
    digits = name.rlike(r"\A([0-9a-f]{2})+\z")
    return F.when(digits, F.concat(F.lit(_HEX_ID), F.unhex(name))).otherwise(F.concat(F.lit(_PLAIN_ID), name.cast("binary")))


def whole_id(short: Column | str) -> Column:
    """The id that :func:`short_id` shortened."""
    short = _col(short)
    kept = F.substring(short, 2, 2**31 - 1)
    return F.when(F.substring(short, 1, 1) == F.lit(_HEX_ID), F.lower(F.hex(kept))).otherwise(kept.cast("string"))


def fingerprint(columns: Sequence[str]) -> Column:
    """sha256 of the JSON of the record with its keys sorted; nulls are kept."""
    record = F.struct(*[F.col(c) for c in sorted(columns)])
    return F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256)


def occurrence_id(fp: Column | str, number: Column | str) -> Column:
    return F.sha2(F.concat(_col(fp), F.lit(":"), _col(number).cast("string")), 256)


def status_id(number: Column | str, status: Column | str) -> Column:
    return F.sha2(F.concat(_col(number), F.lit("|"), F.upper(_col(status))), 256)


def invoice_identity(code: Column | str, provider: Column | str, number: Column | str) -> Column:
    """``struct(tipo, a, b)``: verification code, else provider and number, else null."""
    key = F.upper(F.trim(F.coalesce(_col(code), F.lit(""))))
    owner = digits(provider)
    raw = F.trim(F.coalesce(_col(number), F.lit("")))
    plain = F.when(
        raw.rlike(r"\A[0-9]+\z"), F.coalesce(F.nullif(F.regexp_replace(raw, "^0+", ""), F.lit("")), F.lit("0"))
    ).otherwise(raw)
    by_code = F.struct(F.lit("codigo_verificacao_nfse").alias("tipo"), key.alias("a"), F.lit("").alias("b"))
    by_number = F.struct(F.lit("prestador_numero_nfse").alias("tipo"), owner.alias("a"), plain.alias("b"))
    return F.when(key != "", by_code).when((owner != "") & (raw != ""), by_number)
