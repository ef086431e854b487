"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def chemical_name(drug: Column) -> Column:
    """The text before the first digit, without white space and closing hyphens; a drug without digits whole."""
    head = strip(F.regexp_extract(drug, r"^([^0-9]*)", 1))
    return F.when(drug.rlike("[0-9]"), strip(F.regexp_replace(head, "-+$", ""))).otherwise(strip(drug))


def number(text: Column) -> Column:
    """A double from text with thousands separators; null when it is no number."""
    return F.regexp_replace(text, ",", "").try_cast("double")


def percent(share: Column) -> Column:
    """A whole percentage, half to even."""
    return F.concat(F.bround(share * 100, 0).cast("long").cast("string"), F.lit("%"))


def plural(n: Column, one: str) -> Column:
    return F.concat(n.cast("string"), F.lit(f" {one}"), F.when(n == 1, "").otherwise("s"))
