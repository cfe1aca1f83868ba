"""Date and month parsing dialects, month labels and period windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions.text import _col, dash_to_null, edge_trim, first_match, fold


def date_of(year: Column, month: Column, day: Column) -> Column:
    """Date from text parts; null when a part is missing or the day does not exist."""
    iso = F.concat(
        F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(day.cast("string"), 2, "0")
    )
    return iso.try_cast("date")


_DAY_MONTH_YEAR, _MONTH_YEAR, _YEAR_MONTH_DAY, _YEAR_MONTH = "$3-$2-$1", "$2-$1-1", "$1-$2-$3", "$1-$2-1"


def _parts(c: Column, pattern: str, iso: str) -> Column:
    """Date from the groups of the first match; null without a match or for a day that does not exist."""
    whole = rf"(?s)\A.*?(?:{pattern}).*\z"
    return F.when(c.rlike(pattern), F.regexp_replace(c, whole, iso).try_cast("date"))


def parse_statement_date(c: Column | str) -> Column:
    """``dd/mm/yyyy``; blank, dash or anything else is null."""
    return _parts(dash_to_null(c), fv.DAY_MONTH_YEAR, _DAY_MONTH_YEAR)


def parse_document_date(c: Column | str) -> Column:
    """Repeated slashes collapse; ``d/m/yyyy``, ``d/m/yy`` or ISO."""
    raw = F.regexp_replace(edge_trim(c), "/{2,}", "/")
    return F.coalesce(
        _parts(raw, fv.DAY_MONTH_YEAR, _DAY_MONTH_YEAR),
        _parts(raw, fv.DAY_MONTH_SHORT_YEAR_2000, "20" + _DAY_MONTH_YEAR),
        _parts(raw, fv.DAY_MONTH_SHORT_YEAR_1900, "19" + _DAY_MONTH_YEAR),
        _parts(raw, fv.YEAR_MONTH_DAY, _YEAR_MONTH_DAY),
    )


def parse_request_date(c: Column | str) -> Column:
    text = F.trim(_col(c))
    return F.coalesce(
        _parts(text, fv.DAY_MONTH_YEAR, _DAY_MONTH_YEAR),
        _parts(text, fv.YEAR_MONTH_DAY, _YEAR_MONTH_DAY),
    )


def parse_month(c: Column | str) -> Column:
    """``mm/yyyy``, ``yyyy-mm`` or a Portuguese month name with a year."""
    text = F.trim(_col(c))
    named = fv.NAMED_MONTH
    numbers = F.create_map(*[F.lit(x) for i, name in enumerate(fv.MONTH_NAMES, start=1) for x in (name, i)])
    month = F.try_element_at(numbers, F.lower(first_match(text, named, 1)))
    return F.coalesce(
        _parts(text, fv.MONTH_YEAR, _MONTH_YEAR),
        _parts(text, fv.YEAR_MONTH, _YEAR_MONTH),
        date_of(first_match(text, named, 2), month, F.lit("1")),
    )


def parse_reference(c: Column | str) -> Column:
    """Strict ``mm/yyyy``."""
    return _parts(F.trim(_col(c)), fv.REFERENCE_MONTH, _MONTH_YEAR)


def parse_xml_month(c: Column | str) -> Column:
    """Month inside an ISO date, ``mm/yyyy`` or compact ``yyyymm[dd]`` value."""
    text = F.trim(_col(c))
    return F.coalesce(
        _parts(text, fv.XML_YEAR_MONTH, _YEAR_MONTH),
        _parts(text, fv.XML_MONTH_YEAR, _MONTH_YEAR),
        _parts(text, fv.XML_COMPACT_MONTH, _YEAR_MONTH),
    )


def parse_document_month(c: Column | str) -> Column:
    """``mm/yyyy`` or ``mm-yyyy`` anywhere, else the month of a document date."""
    return F.coalesce(
        _parts(_col(c), fv.DOCUMENT_MONTH, _MONTH_YEAR),
        F.trunc(parse_document_date(c), "month"),
    )


def parse_report_month_label(c: Column | str) -> Column:
    """Month after a competence label whose letters a damaged font may have garbled."""
    return _parts(fold(c), fv.REPORT_MONTH_LABEL, _MONTH_YEAR)


def internal_process_month(c: Column | str) -> Column:
    """``yyyymm...`` shown as ``mm/yyyy`` when the month is 1 to 12."""
    month = first_match(c, r"\A\d{4}(\d{2})", 1)
    valid = month.try_cast("int").between(1, 12)
    return F.when(valid, F.concat(month, F.lit("/"), first_match(c, r"\A(\d{4})", 1)))


def year_month(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def month_year(c: Column | str) -> Column:
    return F.date_format(_col(c), "MM/yyyy")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def looks_like_date(c: Column | str) -> Column:
    return F.trim(_col(c)).rlike(fv.WHOLE_DATE)


def local_time(run_ts: Column) -> Column:
    """Wall-clock time of the business zone for a zoned run timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(fv.LOCAL_ZONE), F.to_utc_timestamp(run_ts, F.current_timezone()).cast("timestamp_ntz"))


def month_sequence(bounds: DataFrame, start: str = "inicio", end: str = "fim") -> DataFrame:
    """One row per month between two dates, both months included."""
    first, last = month_start(start), month_start(end)
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return bounds.select(F.explode(months).alias("competencia")).select(
        "competencia", month_year("competencia").alias("rotulo"), F.date_format("competencia", "yyyyMM").alias("yyyymm")
    )


def date_windows(bounds: DataFrame, start: str = "inicio", end: str = "fim", today: str = "hoje") -> DataFrame:
    """Cut a date range at month ends, never past today; empty when it starts later.

    A window inside one month has at most 31 days, so the 31-day limit needs no cut.
    """
    last = F.least(_col(end), _col(today))
    months = F.when(_col(start) <= last, F.sequence(month_start(start), month_start(last), F.expr("interval 1 month")))
    return (
        bounds.select(_col(start).alias("_s"), last.alias("_e"), F.explode(months).alias("_m"))
        .select(F.greatest("_s", "_m").alias("inicio"), F.least("_e", F.last_day("_m")).alias("fim"))
        .withColumn("rotulo", F.concat(F.date_format("inicio", "dd/MM/yyyy"), F.lit(" a "), F.date_format("fim", "dd/MM/yyyy")))
    )
