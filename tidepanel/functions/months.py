"""Months: one DATE at the first of the month inside, yyyyMM text at the edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_month(text: Column) -> Column:
    """A month from yyyyMM, yyyy-MM, yyyy-MM-dd or an integer yyyyMM; null when it is none of these."""
    digits = F.regexp_replace(text.cast("string"), "-", "")
    return F.trunc(F.try_to_timestamp(F.substring(digits, 1, 6), F.lit("yyyyMM")).cast("date"), "month")


def month_text(month: Column) -> Column:
    return F.date_format(month, "yyyyMM")


def month_index(month: Column) -> Column:
    return 12 * F.year(month) + F.month(month)


def first_of_month(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "month")


def month_from_name(name: Column, year: Column) -> Column:
    """From an English month name and a year."""
    return F.to_date(F.concat(F.lit("1 "), F.initcap(name), F.lit(" "), year), "d MMMM yyyy")
