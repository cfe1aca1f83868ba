"""Number parsing dialects, rounding and check digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions.text import _col, dash_to_null, digits, edge_trim, squash

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,4)"
_NUMERAL = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def money(c: Column | str) -> Column:
    """Null counts as zero; exact decimal before rounding to cents."""
    return F.coalesce(_col(c).cast("decimal(38,10)"), F.lit(0)).cast(MONEY)


def _swap_comma(c: Column) -> Column:
    return F.translate(c, ",", ".")


def parse_statement_number(c: Column | str, to: str = MONEY) -> Column:
    """``1.234,50``, ``,83`` and ``-,5``; blank or dash is null; other text is null."""
    # Texts of digits and separators alone, the usual case, need no trimming.
    text = F.when(_col(c).rlike(r"\A[0-9,.]+\z"), _col(c)).otherwise(dash_to_null(c))
    return F.translate(text, ",.", ".").try_cast(to)


# Dots before one comma, behind an optional sign of the currency.
_USUAL = r"\A(?:R\$ ?)?[0-9]+(?:\.[0-9]+)*,[0-9]+\z"
# One decimal comma after any dots, one decimal dot after any commas, or dots only.
_SEPARATORS = r"\A(?:[^,]*,[^.,]*|[^.]*\.[^.,]*|[^,]*)\z"


def parse_document_number(c: Column | str, to: str = MONEY) -> Column:
    """Free-form amounts: the last separator decides, parentheses negate."""
    raw = edge_trim(c)
    kept = F.btrim(F.regexp_replace(raw, r"[^0-9,.\-]", ""), F.lit("."))
    plain = _swap_comma(F.regexp_replace(kept, r"[.,](?=.*[.,])", ""))
    signed = F.when(raw.rlike(r"(?s)\A\(.*\)\z"), F.regexp_replace(plain, r"\A-*", "-")).otherwise(plain)
    number = F.when(kept.rlike(_SEPARATORS), signed).try_cast(to)
    general = F.when(squash(c).rlike(r"(?i)\A(?:R ?\$ ?)?-\z"), F.lit(0).cast(to)).otherwise(number)
    # The usual spelling, dots before one comma, needs one search instead of all these.
    return F.when(_col(c).rlike(_USUAL), F.translate(_col(c), ",.R$ ", ".").try_cast(to)).otherwise(general)


def bad_statement_number(c: Column | str, to: str = MONEY) -> Column:
    """Text that gives no number of type ``to``: unreadable or too large. More decimals are rounded half-up."""
    return parse_statement_number(c, to).isNull() & dash_to_null(c).isNotNull()


def bad_document_number(c: Column | str, to: str = MONEY) -> Column:
    """Text that gives no number of type ``to``: unreadable or too large. More decimals are rounded half-up."""
    return parse_document_number(c, to).isNull() & edge_trim(c).isNotNull()


def parse_request_number(c: Column | str) -> Column:
    """Amount of a request row: optional ``R$``; a comma means Brazilian style; half-even cents."""
    text = F.regexp_replace(squash(_col(c).cast("string")), r"R\$| ", "")
    number = F.when(F.contains(text, F.lit(",")), F.translate(text, ",.", ".")).otherwise(text)
    return F.bround(number.try_cast("decimal(30,10)"), 2).try_cast(MONEY)


def let(value: Column, body) -> Column:
    """``body`` over ``value`` evaluated once, where the expression uses it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _half_even_scaled(x: Column, scale: int) -> Column:
    """``x * scale`` rounded half-even on the exact binary value of ``x`` (x >= 0).

    The product is split into its rounded value and its exact rounding error, so a
    tie of the printed digits is only treated as a tie when the double really is one.
    """
    factor = F.lit(float(scale))
    head = x * F.lit(134217729.0)

    def rounded(s: Column) -> Column:
        whole = F.floor(s["produto"])
        part = s["produto"] - whole
        error = (s["alto"] * factor - s["produto"]) + (x - s["alto"]) * factor
        up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
        return whole + up.cast("int")

    return let(F.struct((x * factor).alias("produto"), (head - (head - x)).alias("alto")), rounded)


def tax_rate(c: Column | str) -> Column:
    """Four-decimal rate text; values above one are percentages; other text is kept."""
    text = F.trim(_swap_comma(_col(c)))
    number = F.when(text.rlike(_NUMERAL), text.try_cast("double"))

    def shown(n: Column) -> Column:
        rate = F.when(n > 1, n / 100).otherwise(n)
        scaled = _half_even_scaled(F.abs(rate), 10000).cast("decimal(30,0)").cast("string")
        # 5 -> 00005 -> 0.0005; longer numbers only get the point.
        padded = F.regexp_replace(F.concat(F.lit("0000"), scaled), r"\A0{0,4}(?=[0-9]{5})", "")
        return F.concat(F.when(rate < 0, "-").otherwise(""), F.regexp_replace(padded, r"([0-9]{4})\z", ".$1"))

    return F.coalesce(let(number, shown), _col(c))


def money_text(c: Column | str) -> Column:
    """``1234.5`` shown as ``1234,50``."""
    return F.replace(_col(c).cast(MONEY).cast("string"), F.lit("."), F.lit(","))


def _check_digit(number: Column, length: int) -> Column:
    places = F.sequence(F.lit(1), F.lit(length))
    total = F.aggregate(
        places,
        F.lit(0),
        lambda acc, i: acc + F.substring(number, i, F.lit(1)).cast("int") * (F.lit(length + 2) - i),
    )
    return ((total * 10) % 11) % 10


def is_valid_cpf(c: Column | str) -> Column:
    """Eleven digits, not all equal, both modulo-11 check digits right."""
    number = digits(c)
    shape = (F.length(number) == 11) & ~number.rlike(r"\A([0-9])\1*\z")
    first = F.substring(number, 10, 1).cast("int")
    second = F.substring(number, 11, 1).cast("int")
    right = (_check_digit(number, 9) == first) & (_check_digit(number, 10) == second)
    return F.when(shape, right).otherwise(F.lit(False))


def cnpj(c: Column | str) -> Column:
    """Fourteen digits or null."""
    number = digits(squash(c))
    return F.when(F.length(number) == 14, number)


def provider_cnpj(c: Column | str) -> Column:
    """Digits; thirteen of them get their lost leading zero back; blank is null."""
    number = digits(c)
    padded = F.when(F.length(number) == 13, F.lpad(number, 14, "0")).otherwise(number)
    return F.nullif(padded, F.lit(""))


def safe_account(c: Column | str) -> Column:
    """Digits as bigint when there are 1 to 18 of them, else null."""
    number = digits(c)
    return F.when(number.rlike(r"\A[0-9]{1,18}\z"), number.try_cast("bigint"))


def format_cpf(c: Column | str) -> Column:
    number = digits(c)
    part = lambda start, size: F.substring(number, start, size)
    return F.concat(part(1, 3), F.lit("."), part(4, 3), F.lit("."), part(7, 3), F.lit("-"), F.substring(number, 10, 1000))


def format_phone(c: Column | str) -> Column:
    """``(dd)nnnn-nnnn``; a leading country code is dropped; other lengths give blank."""
    number = digits(c)
    local = F.when(number.startswith("55") & F.length(number).isin(12, 13), F.substring(number, 3, 20)).otherwise(number)
    shown = F.concat(
        F.lit("("), F.substring(local, 1, 2), F.lit(")"), F.substring(local, 3, 4), F.lit("-"), F.substring(local, 7, 20)
    )
    return F.when(F.length(local).isin(10, 11), shown).otherwise("")
