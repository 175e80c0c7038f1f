"""Dates of versioned documents: day precision, closed intervals, an open end is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted written forms, tried in this order.
PATTERNS = ("d.M.yyyy", "yyyy-M-d", "d/M/yyyy")


def parse_date(text: Column) -> Column:
    """Date of a text in one of PATTERNS; blank or other texts give null."""
    return F.coalesce(*[F.try_to_date(F.trim(text), p) for p in PATTERNS])


def bad_date(text: Column) -> Column:
    """True for a text that isn't blank and isn't a date."""
    return (F.trim(F.coalesce(text, F.lit(""))) != "") & parse_date(text).isNull()


def format_date(date: Column, pattern: str = "dd.MM.yyyy") -> Column:
    """The date as text, '' for null."""
    return F.coalesce(F.date_format(date, pattern), F.lit(""))


def format_iso(date: Column) -> Column:
    return format_date(date, "yyyy-MM-dd")


def closing_date(next_valid_from: Column) -> Column:
    """A revision ends on the day before the next one starts."""
    return F.date_sub(next_valid_from, 1)


def valid_format(text: Column) -> Column:
    """Blank, or dd.dd.dddd."""
    return (F.coalesce(text, F.lit("")) == "") | text.rlike("^\\d{2}\\.\\d{2}\\.\\d{4}$")


def before(a: Column, b: Column) -> Column:
    return F.coalesce(a < b, F.lit(False))


def date_or(text: Column, fallback: Column) -> Column:
    return F.coalesce(parse_date(text), fallback)


def opened(valid_to: Column) -> Column:
    """A null or blank end is open."""
    return F.coalesce(F.trim(valid_to.cast("string")), F.lit("")) == ""
