"""Column functions on small cases."""

import unicodedata
from decimal import Decimal

from pyspark.sql import functions as F

from claimweave.functions import dates as D
from claimweave.functions import identity as I
from claimweave.functions import numbers as N
from claimweave.functions import text as T


def column(spark, values, build, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(build(F.col("v"))).collect()]


def test_tax_rates_round_like_binary_numbers(spark):
    given = ["5", "0,03", "3.125", "x", None, "1", "2,345", "0.00125", "12345"]
    want = ["0.0500", "0.0300", "0.0312", "x", None, "1.0000", f"{2.345 / 100:.4f}", f"{0.00125:.4f}", f"{123.45:.4f}"]
    assert column(spark, given, N.tax_rate) == want


def test_statement_numbers(spark):
    given = [",83", "4.881,60", "-,5", "-", " ", "abc", "12"]
    want = [Decimal("0.83"), Decimal("4881.60"), Decimal("-0.50"), None, None, None, Decimal("12.00")]
    assert column(spark, given, N.parse_statement_number) == want
    assert column(spark, given, N.bad_statement_number) == [False, False, False, False, False, True, False]


def test_document_numbers(spark):
    given = ["R$ -", "-", "R$ 1.234,50", "1,234.50", "(10,00)", "1.234.567", "", "1,2,3", "abc"]
    want = [Decimal(0), Decimal(0), Decimal("1234.50"), Decimal("1234.50"), Decimal("-10.00"), Decimal("1234.57"), None, None, None]
    got = column(spark, given, N.parse_document_number)
    assert got[:5] == want[:5] and got[6:] == want[6:]
    assert got[5] == Decimal("1234.57")
    assert column(spark, given, N.bad_document_number) == [False] * 7 + [True, True]


def test_request_numbers_round_half_even(spark):
    assert column(spark, ["R$ 1.234,505", "2.345", "2.335", "x"], N.parse_request_number) == [
        Decimal("1234.50"),
        Decimal("2.34"),
        Decimal("2.34"),
        None,
    ]


def test_dates(spark):
    given = ["01//06/2026", "1/6/26", "1/6/69", "2026-06-01", "31/02/2026"]
    assert [str(x) for x in column(spark, given, D.parse_document_date)] == [
        "2026-06-01",
        "2026-06-01",
        "1969-06-01",
        "2026-06-01",
        "None",
    ]
    months = ["06/2026", "2026-6", "Junho, 2026", "março 2026", "13/2026"]
    assert [str(x) for x in column(spark, months, D.parse_month)] == ["2026-06-01"] * 3 + ["2026-03-01", "None"]
    assert [str(x) for x in column(spark, ["Comp.: 05/2026", "compr 05.2026 x", "nada"], D.parse_report_month_label)] == [
        "2026-05-01",
        "2026-05-01",
        "None",
    ]


def test_text_keys(spark):
    assert column(spark, [" aB ", None], T.norm_key) == ["AB", ""]
    assert column(spark, ["00.12-3", None, "x"], T.strip_zeros) == ["123", "", ""]
    assert column(spark, ["Ação  Nº"], lambda c: T.squash(T.fold(c))) == ["acao no"]
    assert column(spark, ["p12345 _ 2024", "x P99999/2023 y", "1/2"], T.process_number) == ["P12345/2024", "P99999/2023", None]
    assert column(spark, ["P1/2024", "P1/24", "P1/2024\n", "P1"], T.year_suffix) == [2024, None, None, None]


def test_cpf(spark):
    assert column(spark, ["529.982.247-25", "52998224724", "11111111111", "123"], N.is_valid_cpf) == [True, False, False, False]


def test_invoice_identity(spark):
    rows = [(" ab 1 ", None, None), (None, "12.3", "000123"), ("", "12", "0"), (None, None, "1")]
    frame = spark.createDataFrame(rows, "c string, p string, n string")
    got = [r[0] for r in frame.select(I.invoice_identity("c", "p", "n")).collect()]
    assert [tuple(x) if x else None for x in got] == [
        ("codigo_verificacao_nfse", "AB 1", ""),
        ("prestador_numero_nfse", "123", "123"),
        ("prestador_numero_nfse", "12", "0"),
        None,
    ]


def test_phone_and_file_names(spark):
    assert column(spark, ["+55 85 98888-7777", "8533334444", "123"], N.format_phone) == ["(85)9888-87777", "(85)3333-4444", ""]
    assert column(spark, [' a/b: "c" ', " . "], T.safe_file_part) == ["a-b- -c-", "SEM INFORMACAO"]


def test_numbers_beyond_the_type_are_bad(spark):
    given = ["9999999999999999,99", "99999999999999999,00"]
    for bad in (N.bad_statement_number, N.bad_document_number):
        assert column(spark, given, bad) == [False, True]
    assert column(spark, ["1," + "3" * 31 + ".5"], N.parse_request_number) == [Decimal("1.33")]


def test_fold_beyond_latin(spark):
    given = ["ﬁm ½ ™ ΆΈ йё", "한국 각 Ção", "𝐀𝟙 Ⅷ ㍿", "plain", None]
    korean = unicodedata.normalize("NFKD", "한국 각")
    assert column(spark, given, T.fold) == ["fim 1⁄2 tm αε ие", f"{korean} cao", "a1 viii 株式会社", "plain", None]
