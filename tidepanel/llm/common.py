"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import written

#: Words are runs of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def durable(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it again: lineage ends here, and a lost executor costs nothing."""
    return written(df)


def shards_for(amount: float, each: float) -> int:
    """How many shards of about `each` an amount needs; it grows with the amount."""
    return max(1, math.ceil((amount or 0) / each))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def held_out() -> Column:
    """True on the fifth of the documents whose labels are never learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
