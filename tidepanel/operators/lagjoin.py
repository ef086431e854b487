"""Monthly series joined with the lag at which they are published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def growth(x: Column, before: Column, keep_inf: bool = True) -> Column:
    """x / before - 1. From 0 to more is +inf, or null on request; 0 to 0 and a missing value are null."""
    rise = F.when(x > 0, F.lit(float("inf"))).when(x < 0, F.lit(float("-inf"))) if keep_inf else F.lit(None).cast("double")
    return F.when(before == 0, rise).otherwise(x / before - 1)


def series_features(series: DataFrame, key: str, keep_inf: bool = True) -> DataFrame:
    """series: key, month, total_items -> with items_mom_growth on the previous row of the key, and log_items."""
    before = F.lag("total_items").over(Window.partitionBy(key).orderBy("month"))
    return series.withColumns({"items_mom_growth": growth(F.col("total_items"), before, keep_inf), "log_items": F.log1p("total_items")})


def lagged_join(features: DataFrame, series: DataFrame, key: str, lag: int = 2, suffix: str = "_epd") -> DataFrame:
    """Each row of features with the series' values of exactly `lag` months before; null where there is no such row."""
    values = [c for c in series.columns if c not in (key, "month")]
    late = series.select(F.col(key).alias("_key"), F.add_months("month", lag).alias("_at"), *[F.col(c).alias(f"{c}{suffix}") for c in values])
    return features.join(late, (F.col(key) == F.col("_key")) & (F.col("month") == F.col("_at")), "left").drop("_key", "_at")


def through_map(features: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Rows whose key the mapping (key, code) knows, with the code; others are dropped."""
    return features.join(mapping, key)


def coverage(rows: DataFrame, column: str) -> DataFrame:
    """One row: the share of rows with a value."""
    return rows.agg(F.avg(F.col(column).isNotNull().cast("double")).alias("coverage"), F.count("*").alias("n_rows"))


def fair_set(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Labelled rows that have all the columns; an infinite growth is a value."""
    return rows.where(F.col("label_onset_next_month").isNotNull()).dropna(subset=columns)
