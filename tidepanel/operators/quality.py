"""Gates: each returns the rows that break a rule. `enforce` stops when there is one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """A rule that the data must keep is broken."""


def enforce(violations: DataFrame, rule: str) -> None:
    if not violations.isEmpty():
        raise GateError(rule)


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def overlapping_months(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("month").intersect(right.select("month"))


def wrong_month_sizes(rows: DataFrame, expected: int) -> DataFrame:
    """Months that don't have exactly the expected number of rows."""
    return rows.groupBy("month").agg(F.count("*").alias("n_rows")).where(F.col("n_rows") != expected)


def without_series(codes: DataFrame, series: DataFrame, key: str) -> DataFrame:
    """Codes that have no row in the series."""
    return codes.select(key).distinct().join(series, key, "left_anti")


def other_months(batch: DataFrame, text_month: Column, month: str) -> DataFrame:
    """Rows of a batch whose month, written with or without a hyphen, is not the requested yyyyMM."""
    return batch.where(~F.regexp_replace(text_month.cast("string"), "-", "").eqNullSafe(F.lit(month)))


def late_starts(series: DataFrame, key: str, cutoff: Column) -> DataFrame:
    """Keys that have no row before the cutoff, with their first month."""
    return series.groupBy(key).agg(F.min("month").alias("first_month"), F.count_if(F.col("month") < cutoff).alias("_early")).where("_early = 0").drop("_early")


def unreconciled(audit: DataFrame) -> DataFrame:
    """Months whose landed rows differ from their source's."""
    return audit.where(~F.col("source_rows").eqNullSafe(F.col("landed_rows")))


def rows_by_month(rows: DataFrame) -> DataFrame:
    return rows.groupBy("month").agg(F.count("*").alias("n_rows"))


def gate_report(rows: DataFrame, entity: str, expected: int, cutoff: Column, asked: Column) -> DataFrame:
    """gate, n_violations, passed: the gates of a monthly series (entity, month), all from one read of it.

    unmapped: rows without an entity. duplicate_keys: entities and months that occur together more than once.
    wrong_month_sizes: months that don't have the expected number of rows. other_months: rows of months that `asked` (a
    condition on month) leaves out, or of none. late_starts: entities without a row before the cutoff. Each count is that of
    the rows which the gate of the same name returns; these are read only where it is above zero. An empty table passes.
    """
    cells = rows.groupBy(F.col(entity).alias("_e"), "month").agg(F.count("*").alias("n"))
    sets = cells.groupingSets([["_e"], ["month"], []], "_e", "month").agg(
        F.grouping_id().alias("level"), F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("twice"), F.sum(F.when(F.col("_e").isNull(), F.col("n"))).alias("nameless"),
        F.sum(F.when(~F.coalesce(asked, F.lit(False)), F.col("n"))).alias("other"), F.min("month").alias("first"),
    )
    of_entity, of_month, of_all = (F.col("level") == i for i in (1, 2, 3))
    counts = {
        "unmapped": F.sum(F.when(of_all, F.col("nameless"))), "duplicate_keys": F.sum(F.when(of_all, F.col("twice"))), "wrong_month_sizes": F.count_if(of_month & (F.col("n") != expected)),
        "other_months": F.sum(F.when(of_all, F.col("other"))), "late_starts": F.count_if(of_entity & (F.col("first") >= cutoff)),
    }
    one = sets.agg(*[F.coalesce(c, F.lit(0)).alias(k) for k, c in counts.items()])
    lines = F.array(*[F.struct(F.lit(k).alias("gate"), F.col(k).alias("n_violations"), (F.col(k) == 0).alias("passed")) for k in counts])
    return one.select(F.inline(lines))
