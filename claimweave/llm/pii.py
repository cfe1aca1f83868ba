"""Personal data replaced by format-preserving pseudonyms, in DataFrame expressions only.

Found are e-mail addresses, payment card numbers (Luhn digit), IBANs (check digits), US social
security numbers, phone numbers, IPv4 addresses and calendar dates. What looks like one of them
but fails its validation stays as it is. A valid value is permuted inside its own format by a
keyed Feistel network over decimal digits (letters of e-mail names: over the alphabet), with
SHA-256 as the round function: separators, length and letter case stay, a card keeps a valid
Luhn digit, an IBAN valid check digits, an address in 0 to 255 per part, a date is a date of
the same layout within the same 400 years. Equal values get equal pseudonyms in all documents,
however they are punctuated, and different values of one format get different ones. Dates with slashes or dots are
read day first where that is a date, else month first; those that are read month first are
permuted among themselves, so the images of the two readings never meet.

What is found need not be valid as a whole. A run of digit groups is searched for cards between its
separators, and what is left of it for the other kinds. An IBAN has its country's length, so what
follows it is looked at on its own. Of a host name the longest valid beginning counts.

Null text stays null, text without findings as it is. Rows are handled one by one. The first
digits that tell a kind (+ and country code of a phone, country of an IBAN) are kept. Patterns repeat
unboundedly only over character classes, which the pattern engine matches without recursion, so texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.tables import fresh, quoted

_ROUNDS = 8

#: Length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO EG GT HU LB NI PL SV", 29: "BR PS QA UA", 30: "JO KW MU", 31: "MT SC",
    32: "LC", 33: "RU",
}
_IBAN_BODY = "|".join(rf"(?:{'|'.join(codes.split())})\d{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())

#: Kinds in the order in which they are tried at one place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": rf"(?<![A-Za-z0-9])(?:{_IBAN_BODY})(?![A-Za-z0-9])",
    "date": r"(?<![0-9])(?:(?:\d{4}-\d{2}-\d{2})|(?:\d{4}/\d{2}/\d{2})|(?:\d{2}[/.]\d{2}[/.]\d{4}))(?![0-9])",
    "ip": r"(?<![0-9.])\d{1,3}(?:\.\d{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])\d{3}-\d{2}-\d{4}(?![0-9-])",
    "run": r"(?<![0-9])(?:\d[\x20-]?){12}\d[\d\x20-]*",
    "phone": r"(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{2,4}\)|(?<![0-9])\d{2,4})[\x20.-]?\d{2,4}(?:[\x20.-]?\d{2,4}){1,3}(?![0-9])",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Kinds looked for in what a run of digit groups leaves beside its cards.
_LEFT = "|".join(f"(?:{PATTERNS[k]})" for k in ("date", "ssn", "phone"))
_CARD_DIGITS = (13, 19)
#: Words of 7 digits and more, or an @, or a date; a cheap test before the patterns.
_SIGN = r"@|\d[\d\x20().+/-]{5,}\d"


def _digest(key: str, *parts: Column) -> Column:
    """48 bits of a keyed hash."""
    text = F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 12), 16, 10).cast("long")


def feistel(digits: Column, key: str, tweak: Column) -> Column:
    """Keyed permutation of the decimal strings of one length, by an alternating Feistel network.

    Longer strings than 36 digits do not occur. One digit is shifted by a keyed amount.
    """
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    state = F.struct(F.substr(digits, F.lit(1), left).alias("a"), F.substr(digits, left + 1).alias("b"))

    def turn(s: Column, r: Column) -> Column:
        width = F.length(s["a"])
        low = F.pow(F.lit(10), width).cast("decimal(20,0)")
        moved = (s["a"].cast("decimal(20,0)") + (_digest(key, tweak, n, r, s["b"]) % low)) % low
        return F.struct(s["b"].alias("a"), F.lpad(moved.cast("decimal(20,0)").cast("string"), width, "0").alias("b"))

    mixed = F.aggregate(F.array(*(F.lit(r) for r in range(_ROUNDS))), state, turn, lambda s: F.concat(s["a"], s["b"]))
    single = F.pmod(digits.cast("long") + _digest(key, tweak) % 10, F.lit(10)).cast("string")
    return F.when(n > 1, mixed).when(n == 1, single).otherwise(digits)


def _numbers(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(value: Column, digits: Column, letters: str = "[^0-9]") -> Column:
    """``value`` with its digits replaced, in order, by ``digits``."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")

    def place(c: Column, k: Column) -> Column:
        seen = F.length(F.regexp_replace(F.substr(value, F.lit(1), k + 1), letters, ""))
        return F.when(c.rlike(letters), c).otherwise(F.substr(digits, seen, F.lit(1)))

    return F.array_join(F.transform(chars, place), "")


def luhn_digit(body: Column) -> Column:
    """The digit that makes ``body`` plus it valid."""
    reverse = F.split(F.reverse(body), "")

    def doubled(d: Column, k: Column) -> Column:
        value = d.cast("int") * F.when(k % 2 == 0, 2).otherwise(1)
        return F.when(value > 9, value - 9).otherwise(value)

    total = F.aggregate(F.transform(F.filter(reverse, lambda d: d != ""), doubled), F.lit(0), lambda a, x: a + x)
    return F.pmod(-total, F.lit(10)).cast("string")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    return luhn_digit(F.substr(digits, F.lit(1), n - 1)) == F.substr(digits, n)


def _mod97(text: Column) -> Column:
    """The number that a rearranged IBAN spells, modulo 97."""
    value = F.aggregate(
        F.filter(F.split(text, ""), lambda c: c != ""),
        F.lit(0).cast("long"),
        lambda a, c: F.pmod(F.when(c.rlike("[0-9]"), a * 10 + c.cast("long")).otherwise(a * 100 + F.ascii(c).cast("long") - 55), F.lit(97)),
    )
    return value


def _card(value: Column, key: str) -> Column:
    digits = _numbers(value)
    body = feistel(F.substr(digits, F.lit(1), F.length(digits) - 1), key, F.lit("card"))
    return _refill(value, F.concat(body, luhn_digit(body)))


def _iban(value: Column, key: str) -> Column:
    plain = F.translate(value, " ", "")
    country, body = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
    hidden = _refill(body, feistel(_numbers(body), key, F.concat(F.lit("iban"), F.regexp_replace(body, "[0-9]", "#"))))
    check = F.lpad((98 - _mod97(F.concat(hidden, country, F.lit("00")))).cast("string"), 2, "0")
    whole = F.concat(country, check, hidden)
    return _refill(value, whole, letters=" ")


def _ip(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a * 256 + p)
    half = F.lit(65536).cast("long")

    def turn(s: Column, r: Column) -> Column:
        return F.struct(s["b"].alias("a"), F.pmod(s["a"] + _digest(key, F.lit("ip"), r, s["b"]), half).alias("b"))

    start = F.struct(F.floor(number / half).cast("long").alias("a"), F.pmod(number, half).alias("b"))
    mixed = F.aggregate(F.array(*(F.lit(r) for r in range(_ROUNDS))), start, turn, lambda s: s["a"] * half + s["b"])
    return F.array_join(F.transform(F.array(*(F.lit(k) for k in (24, 16, 8, 0))), lambda k: F.pmod(F.floor(mixed / F.pow(F.lit(2), k)).cast("long"), F.lit(256)).cast("string")), ".")


#: Spans of 400 years have 146097 days; the first one lacks the year 0, which has 366.
_DAYS, _FIRST_DAYS = 146097, 146097 - 366
#: Steps after which a walk over the days has left the excluded ones; each step leaves them with 3 chances in 5.
_WALK = 96


def _date_parts(value: Column) -> Column:
    """A date in year-month-day order: read as it stands, day before month unless that fails."""
    year_first = value.rlike(r"^\d{4}")
    iso = F.concat_ws("-", F.substr(value, F.lit(1), F.lit(4)), F.substr(value, F.lit(6), F.lit(2)), F.substr(value, F.lit(9), F.lit(2)))
    a, b, y = F.substr(value, F.lit(1), F.lit(2)), F.substr(value, F.lit(4), F.lit(2)), F.substr(value, F.lit(7), F.lit(4))
    day_first = F.try_to_date(F.concat_ws("-", y, b, a), "yyyy-MM-dd")
    month_first = F.try_to_date(F.concat_ws("-", y, a, b), "yyyy-MM-dd")
    return F.when(year_first, F.struct(F.try_to_date(iso, "yyyy-MM-dd").alias("day"), F.lit("ymd").alias("order"))).otherwise(
        F.when(day_first.isNotNull(), F.struct(day_first.alias("day"), F.lit("dmy").alias("order"))).otherwise(F.struct(month_first.alias("day"), F.lit("mdy").alias("order")))
    )


def _date(value: Column, key: str) -> Column:
    """Another day of the same 400 years that reads in the same order.

    A month-first date needs a day over 12 to be read so again; its walk goes on over other days
    until it comes to one, which permutes these days among themselves.
    """
    return _let(_date_parts(value), lambda read: _moved_date(value, read, key))


def _moved_date(value: Column, read: Column, key: str) -> Column:
    day = read["day"]
    first = F.make_date(F.greatest(F.floor(F.year(day) / 400).cast("int") * 400, F.lit(1)), F.lit(1), F.lit(1))
    size = F.when(F.year(day) < 400, _FIRST_DAYS).otherwise(_DAYS).cast("long")
    offset = F.datediff(day, first).cast("long")
    rounds = F.array(*(F.lit(r) for r in range(16)))

    def swap(at: Column, r: Column) -> Column:  # swap-or-not network: any number of days
        partner = F.pmod(_digest(key, F.lit("pivot"), r, F.year(first)) - at, size)
        coin = _digest(key, F.lit("coin"), r, F.greatest(at, partner)) % 2
        return F.when(coin == 1, partner).otherwise(at)

    def stays(at: Column) -> Column:
        return (read["order"] != "mdy") | (F.day(F.date_add(first, at.cast("int"))) > 12)

    once = F.aggregate(rounds, offset, swap)
    there = F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), once, lambda at, _: F.when(stays(at), at).otherwise(F.aggregate(rounds, at, swap)))
    return _let(F.date_add(first, there.cast("int")), lambda moved: _spelled_date(value, moved, read["order"]))


def _spelled_date(value: Column, moved: Column, order: Column) -> Column:
    y, m, d = F.date_format(moved, "yyyy"), F.date_format(moved, "MM"), F.date_format(moved, "dd")
    parts = F.when(order == "ymd", F.concat(y, m, d)).when(order == "dmy", F.concat(d, m, y)).otherwise(F.concat(m, d, y))
    return _refill(value, parts)


def _email(value: Column, key: str) -> Column:
    """Name and first label of the host are moved through their alphabets by a keyed stream."""
    name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    top = F.substring_index(host, ".", -1)
    inner = F.concat(name, F.lit("@"), F.substr(host, F.lit(1), F.length(host) - F.length(top)))
    codes = F.transform(F.filter(F.split(inner, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))

    def size(c: Column) -> Column:
        return F.when(c < 58, 10).otherwise(26).cast("long")

    def low(c: Column) -> Column:
        return F.when(c < 58, 48).when(c < 91, 65).otherwise(97).cast("long")

    def moved(c: Column, shift: Column) -> Column:
        return F.when((c.between(48, 57)) | (c.between(65, 90)) | (c.between(97, 122)), low(c) + F.pmod(c - low(c) + shift, size(c))).otherwise(c)

    # unbalanced Feistel: each half is shifted by a stream that the other half keys
    half = F.floor(F.size(codes) / 2).cast("int")
    start = F.struct(F.slice(codes, F.lit(1), half).alias("a"), F.slice(codes, half + 1, F.size(codes)).alias("b"))

    def turn(s: Column, r: Column) -> Column:
        seed = F.struct(s["b"].alias("other"), _digest(key, F.lit("email"), r, F.array_join(F.transform(s["b"], lambda c: c.cast("string")), ",")).alias("seed"))
        shifted = F.transform(F.arrays_zip(s["a"].alias("c"), F.transform(s["a"], lambda c, k: k).alias("k")), lambda z: moved(z["c"], _digest(key, seed["seed"], z["k"])))
        return F.struct(s["b"].alias("a"), shifted.alias("b"))

    mixed = F.aggregate(F.array(*(F.lit(r) for r in range(4))), start, turn, lambda s: F.concat(s["a"], s["b"]))
    return F.concat(F.array_join(F.transform(mixed, lambda c: F.chr(c)), ""), top)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once, where the expression uses it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _address(match: Column, key: str) -> Column:
    """The longest valid beginning of a host: labels of 1 to 63 without hyphens at their ends, 253 characters, letters at last."""
    name, host = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)

    def valid(label: Column) -> Column:
        return F.length(label).between(1, 63) & ~label.startswith("-") & ~label.endswith("-")

    def longest(labels: Column) -> Column:
        def ends(i: Column) -> Column:
            own = F.slice(labels, F.lit(1), i)
            return F.forall(own, valid) & F.get(labels, i - 1).rlike("^[A-Za-z]{2,24}$") & (F.length(F.array_join(own, ".")) <= 253)

        end = F.array_max(F.filter(F.sequence(F.lit(1), F.size(labels)), lambda i: (i > 1) & ends(i)))
        return F.concat(name, F.lit("@"), F.array_join(F.slice(labels, F.lit(1), end), "."))

    # 253 characters hold 127 labels at most
    whole = _let(F.slice(F.split(host, r"\."), F.lit(1), F.lit(128)), longest)
    return _let(whole, lambda w: F.when(w.isNull(), match).otherwise(F.concat(_email(w, key), F.substr(match, F.length(w) + 1))))


def _replace_all(text: Column, pattern: str, put: Callable[[Column], Column]) -> Column:
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.concat(F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), put), F.array(F.lit(""))).alias("put"))
    return F.array_join(F.transform(pieces, lambda z: F.concat(z["gap"], z["put"])), "")


def _card_end(parts: Column, at: Column) -> Column:
    """Index of the last part of the longest card that begins with part ``at``; parts are digits and separators by turns.

    Groups are as on cards: one of 13 to 19 digits, 4-4-4-4 with or without a shorter end or an extra one, 4-6-4, 4-6-5.
    """

    def joined(end: Column) -> Column:
        return F.array_join(F.filter(F.slice(parts, at + 1, end - at + 1), lambda p: p.rlike("^[0-9]")), "")

    def shaped(end: Column) -> Column:
        own = F.slice(parts, at + 1, end - at + 1)
        return F.array_join(F.transform(own, lambda p: F.when(p.rlike("^[0-9]"), F.length(p).cast("string")).when(F.length(p) == 1, "-").otherwise("x")), "")

    def card(end: Column) -> Column:
        shape = shaped(end)
        one = shape.rlike("^1[3-9]$")
        several = shape.rlike("^4-4-4-[1-4]$|^4-4-4-4-[1-3]$|^4-6-[45]$")
        return (one | several) & _luhn(joined(end))

    ends = F.filter(F.transform(F.array(*(F.lit(k) for k in (0, 4, 6, 8))), lambda k: at + k), lambda e: e < F.size(parts))
    return F.array_max(F.filter(ends, card))


def _run(match: Column, key: str) -> Column:
    """Cards within a run of digit groups replaced, and the other kinds in what is left between them."""

    def between(parts: Column, begin: Column, size: Column) -> Column:
        return _replace_all(F.array_join(F.slice(parts, begin + 1, F.greatest(size, F.lit(0))), ""), _LEFT, lambda m: _single(m, key))

    def searched(parts: Column) -> Column:
        n = F.size(parts)
        start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<a:int,b:int>>").alias("cards"))

        def step(s: Column, i: Column) -> Column:
            end = F.when(i >= s["next"], _card_end(parts, i))
            return _let(end, lambda e: F.when(e.isNull(), s).otherwise(F.struct((e + 1).alias("next"), F.concat(s["cards"], F.array(F.struct(i.alias("a"), e.alias("b")))).alias("cards"))))

        places = F.sequence(F.lit(0), n - 1, F.lit(2))
        found = F.aggregate(places, start, step, lambda s: s["cards"])

        def spelled(cards: Column) -> Column:
            def one(c: Column, k: Column) -> Column:
                before = F.when(k > 0, F.get(cards, k - 1)["b"] + 1).otherwise(0)
                return F.concat(between(parts, before, c["a"] - before), _card(F.array_join(F.slice(parts, c["a"] + 1, c["b"] - c["a"] + 1), ""), key))

            rest = F.when(F.size(cards) > 0, F.element_at(cards, -1)["b"] + 1).otherwise(0)
            return F.concat(F.array_join(F.transform(cards, one), ""), between(parts, rest, n - rest))

        return _let(found, spelled)

    digits = _numbers(match)
    whole = F.length(digits).between(*_CARD_DIGITS) & _luhn(digits)
    return F.when(whole, _card(match, key)).otherwise(_let(F.regexp_extract_all(match, F.lit("([0-9]+|[^0-9]+)"), 1), searched))


def _single(match: Column, key: str) -> Column:
    """Date, social security or phone number; others stay."""
    n = F.length(_numbers(match))
    phone_ok = n.between(9, 15) & (match.contains("(") | match.startswith("+") | match.rlike(r"\d[\x20.-]\d"))
    ssn_ok = ~match.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return (
        F.when(_is_kind(match, "date") & _date_parts(match)["day"].isNotNull(), _date(match, key))
        .when(_is_kind(match, "ssn"), F.when(ssn_ok, _refill(match, feistel(_numbers(match), key, F.lit("ssn")))).otherwise(match))
        .when(_is_kind(match, "phone") & phone_ok, _phone(match, key))
        .otherwise(match)
    )


def _is_kind(match: Column, kind: str) -> Column:
    return match.rlike(f"^(?:{PATTERNS[kind]})$")


def _phone(value: Column, key: str) -> Column:
    lead = F.regexp_extract(value, r"^(\+\d{1,3}[\x20.-]?)?", 0)
    rest = F.substr(value, F.length(lead) + 1)
    return F.concat(lead, _refill(rest, feistel(_numbers(rest), key, F.concat(F.lit("phone"), _numbers(lead)))))


def pseudonym(match: Column, key: str) -> Column:
    """The replacement of one match; null digits or failed validation leave it as it is."""
    octets = F.forall(F.split(match, r"\."), lambda p: p.cast("int") <= 255)
    plain = F.translate(match, " ", "")
    iban_ok = _mod97(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))) == 1
    return (
        F.when(match.contains("@"), _address(match, key))
        .when(match.rlike("^[A-Z]"), F.when(iban_ok, _iban(match, key)).otherwise(match))
        .when(_is_kind(match, "ip"), F.when(octets, _ip(match, key)).otherwise(match))
        .when(match.rlike(r"^(?:\d[\x20-]?){12}\d"), _run(match, key))
        .otherwise(_single(match, key))
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with valid findings in ``text`` replaced, and the array ``pii`` of what was replaced by what.

    The added column is renamed with ``_`` where taken; its fields are ``found`` and ``put``.
    """
    out = fresh(docs, "pii")
    body = quoted(text)
    found = F.when(body.rlike(_SIGN), F.regexp_extract_all(body, F.lit(f"({_ANY})"), 1))
    # written once per row before it is used twice
    marked = docs.withColumn(out, F.transform(found, lambda m: F.struct(m.alias("found"), pseudonym(m, key).alias("put"))))
    gaps = F.split(body, _ANY, -1)
    pieces = F.transform(F.arrays_zip(gaps.alias("gap"), F.concat(F.col(out)["put"], F.array(F.lit(""))).alias("put")), lambda z: F.concat(z["gap"], z["put"]))
    replaced = F.when(F.exists(F.col(out), lambda m: m["found"] != m["put"]), F.array_join(pieces, "")).otherwise(body)
    empty = F.array().cast(marked.schema[out].dataType)
    kept = F.coalesce(F.filter(F.col(out), lambda m: m["found"] != m["put"]), empty)
    return marked.select(*(replaced.alias(c) if c == text else quoted(c) for c in docs.columns), kept.alias(out))
