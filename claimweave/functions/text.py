"""Text column functions: keys, whitespace, accents, regex helpers."""

from __future__ import annotations

import functools
import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave import fixed_values as fv

WHITESPACE = r"[\p{IsWhite_Space}\x1c-\x1f]+"
_NOT_ASCII = r"[^\x00-\x7f]"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


#: Planes that hold characters with a decomposition; beyond them there are ideographs and private use only.
_DECOMPOSED = (range(0x80, 0x20000), range(0x2F800, 0x2FA20))


@functools.cache
def _accent_tables() -> tuple[str, str, str, str]:
    """Every character whose compatibility form differs: to one base character, or to several (class and JSON map)."""
    source, target, several = [], [], {}
    for code in (c for block in _DECOMPOSED for c in block):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        # Hangul syllables fall apart into letters, by rule; combining marks go by a pattern
        if base == char or not base or 0xAC00 <= code < 0xD7A4:
            continue
        if len(base) == 1:
            source.append(char)
            target.append(base)
        else:
            several[char] = base
    return "".join(source), "".join(target), f"[{_ranges(sorted(map(ord, several)))}\\x{{ac00}}-\\x{{d7a3}}]", json.dumps(several)


def _ranges(codes: list[int]) -> str:
    """Code points as ranges of a character class."""
    runs: list[list[int]] = []
    for code in codes:
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs)


def _spelled_out(c: Column) -> Column:
    """Ligatures, fractions and the like as their several characters; Hangul syllables as letters."""
    table = F.from_json(F.lit(_accent_tables()[3]), "map<string,string>")

    def hangul(x: Column) -> Column:
        at = F.ascii(x) - 0xAC00
        tail = at % 28
        letters = F.array(0x1100 + F.floor(at / 588), 0x1161 + F.floor(at % 588 / 28), F.when(tail > 0, 0x11A7 + tail))
        return F.array_join(F.transform(F.array_compact(letters), lambda k: F.decode(F.unhex(F.lpad(F.hex(k), 4, "0")), "UTF-16BE")), "")

    def one(x: Column) -> Column:
        return F.when(x <= "\x7f", x).when(x.between("\uac00", "\ud7a3"), hangul(x)).otherwise(F.coalesce(table[x], x))

    return F.array_join(F.transform(F.split(c, ""), one), "")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squash(c: Column | str) -> Column:
    """Any whitespace run becomes one space; both ends trimmed; null stays null."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE, " "))


def squash_lines(c: Column | str) -> Column:
    """Squash inside each line, drop blank lines, join with CRLF."""
    lines = F.transform(F.split(F.coalesce(_col(c), F.lit("")), LINE_BREAK), squash)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\r\n")


def norm_key(c: Column | str) -> Column:
    """Upper-case join key without outer blanks; null becomes the empty text."""
    return F.upper(F.trim(F.coalesce(_col(c), F.lit(""))))


def upper_trim(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def digits(c: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), "[^0-9]", "")


def strip_zeros(c: Column | str) -> Column:
    return F.regexp_replace(digits(c), "^0+", "")


def fold(c: Column | str) -> Column:
    """Lower case without accents (compatibility decomposition, marks dropped).

    The expression carries its tables. Fold a whole text once and carry the copy along
    (``sources.pages.folded_cells``, ``folded_parts``); don't fold inside a lambda.
    """
    accented, base, several, _ = _accent_tables()
    single = F.translate(_col(c), accented, base)
    # Plain text, the usual case, needs no table lookup. Few texts have more than single accented letters, and
    # only those are searched for characters of several letters and for marks: that class has very many ranges.
    rare = F.regexp_replace(F.when(single.rlike(several), _spelled_out(single)).otherwise(single), r"\p{Mn}", "")
    plain = F.when(single.rlike(_NOT_ASCII), rare).otherwise(single)
    return F.lower(F.when(_col(c).rlike(_NOT_ASCII), plain).otherwise(_col(c)))


def match_key(c: Column | str) -> Column:
    """Accent-free, whitespace-squashed upper-case name used to compare patients."""
    return F.upper(squash(fold(F.coalesce(_col(c), F.lit("")))))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def opens_plain(c: Column | str) -> Column:
    """The first character is visible ASCII."""
    return F.substring(_col(c), 1, 1).between("!", "~")


def dash_to_null(c: Column | str) -> Column:
    """Trimmed text; blank or a single dash is null."""
    text = F.regexp_replace(_col(c), r"^[\p{IsWhite_Space}\x1c-\x1f]+|[\p{IsWhite_Space}\x1c-\x1f]+\z", "")
    # Between visible ASCII characters there is nothing to trim.
    tight = opens_plain(c) & F.substring(_col(c), -1, 1).between("!", "~")
    return F.when(tight, F.when(_col(c) != "-", _col(c))).otherwise(F.when((text != "") & (text != "-"), text))


def edge_trim(c: Column | str) -> Column:
    """Squashed text without label punctuation at the ends; blank is null."""
    return blank_to_null(F.btrim(squash(c), F.lit(fv.EDGE_PUNCTUATION)))


def first_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Group of the first match, null when there is none."""
    return blank_to_null(F.regexp_extract(_col(c), pattern, group))


def process_number(c: Column | str) -> Column:
    """First process number inside a text, as ``P.../yyyy``; null when absent."""
    pattern = "(?i)" + fv.PROCESS_NUMBER
    number = first_match(c, pattern, 1)
    return F.concat(F.upper(number), F.lit("/"), first_match(c, pattern, 2))


def exact_process_number(c: Column | str) -> Column:
    """As :func:`process_number`, but the whole trimmed text must be the number."""
    text = F.trim(_col(c))
    whole = r"(?i)\A" + fv.PROCESS_NUMBER + r"\z"
    return F.when(text.rlike(whole), process_number(text))


def year_suffix(c: Column | str) -> Column:
    """Four-digit part after the first slash as an integer, else null."""
    part = F.split_part(_col(c), F.lit("/"), F.lit(2))
    return F.when(part.rlike(r"\A[0-9]{4}\z"), part.try_cast("int"))


def identifier_only(c: Column | str) -> Column:
    return blank_to_null(F.regexp_replace(_col(c), "[^A-Za-z0-9]", ""))


def cut(c: Column | str, size: int) -> Column:
    return F.substring(_col(c), 1, size)


def safe_file_part(c: Column | str) -> Column:
    clean = F.regexp_replace(_col(c), r'[<>:"/\\|?*\x00-\x1f]', "-")
    clean = F.btrim(squash(clean), F.lit(" ."))
    return F.coalesce(blank_to_null(clean), F.lit(fv.FILE_NAME_FALLBACK))
