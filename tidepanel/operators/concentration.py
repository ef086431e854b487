"""Monthly volume, distinct providers and concentration of row-level facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def volume_and_concentration(facts: DataFrame) -> DataFrame:
    """facts: code, name, month, practice, items -> code, name, month, total_items, n_distinct_practices, hhi.

    The index is sum(x^2) / T^2, which needs no second pass over the facts. A null practice adds to the total and the
    index but is no practice. A total of 0 or less, or none, has no index.
    """
    by_practice = facts.groupBy("code", "name", "month", "practice").agg(F.sum("items").alias("x"))
    sums = by_practice.groupBy("code", "name", "month").agg(F.sum("x").alias("total_items"), F.count("practice").alias("n_distinct_practices"), F.sum(F.col("x") * F.col("x")).alias("_squares"))
    total = F.col("total_items")
    return sums.select("code", "name", "month", "total_items", "n_distinct_practices", F.when(total > 0, F.col("_squares") / (total * total)).alias("hhi"))


def cross_check(computed: DataFrame, expected: DataFrame, key: str, column: str) -> DataFrame:
    """Adds expected_<column> and MATCH or MISMATCH to the computed rows whose key is expected."""
    known = expected.select(key, F.col(column).alias(f"expected_{column}"))
    return computed.join(known, key).withColumn("check", F.when(F.col(column) == F.col(f"expected_{column}"), "MATCH").otherwise("MISMATCH"))


def profile(rows: DataFrame, entity: str, month: str = "month") -> DataFrame:
    """One row: rows, entities, months, first and last month. Two grouped levels instead of two distinct counts."""
    cells = rows.groupBy(entity, month).agg(F.count("*").alias("n"))
    entities = cells.groupBy(entity).agg(F.sum("n").alias("n")).agg(F.sum("n").alias("n_rows"), F.count(entity).alias("n_entities"))
    months = cells.groupBy(month).agg(F.lit(1).alias("one")).agg(F.count(month).alias("n_months"), F.min(month).alias("first_month"), F.max(month).alias("last_month"))
    return entities.crossJoin(F.broadcast(months))  # one row each
