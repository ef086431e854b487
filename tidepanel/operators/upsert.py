"""Keyed upserts with a policy for each column, and tables whose upserts survive a run that breaks off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import exists
from .quality import duplicate_keys, enforce

#: States of a commit record: rows wait in the staging folder, or they are in the table.
STAGED, LANDED = "staged", "landed"


def merged(state: DataFrame, batch: DataFrame, keys: list[str], take: list[str], came: Sequence[str] = (), seen: Sequence[str] = (), now: Column | None = None) -> DataFrame:
    """state after the batch: columns in `take` come from the batch where it has the key, even when null; others stay.

    A new key brings all columns the batch has. Keys are compared as they are; a null key never matches. Clock columns are
    not read from the batch: those in `came` are set to `now` (by default the time of the query) for a new key and stay
    afterwards, those in `seen` are set whenever the batch has the key.
    """
    now = F.current_timestamp() if now is None else now
    hit = F.col("_hit").isNotNull()
    new = batch.withColumn("_hit", F.lit(1)).select("_hit", *[F.col(c).alias(f"_new_{c}") for c in batch.columns])
    same = [F.col(k) == F.col(f"_new_{k}") for k in keys]
    both = state.withColumn("_old", F.lit(1)).join(new, same, "full_outer")
    out = []
    for c in state.columns:
        kind = state.schema[c].dataType
        fresh = now.cast(kind) if c in {*came, *seen} else F.col(f"_new_{c}") if c in batch.columns else F.lit(None).cast(kind)
        use = hit if c in {*take, *seen} else F.col("_old").isNull()
        out.append(F.when(use, fresh).otherwise(F.col(c)).alias(c))
    return both.select(*out)


def upsert(state: DataFrame, batch: DataFrame, keys: list[str], take: list[str], came: Sequence[str] = (), seen: Sequence[str] = (), now: Column | None = None) -> DataFrame:
    """`merged` after a check that the batch has no key twice."""
    enforce(duplicate_keys(batch, keys), f"the batch repeats a key of {keys}")
    return merged(state, batch, keys, take, came, seen, now)


def widened(state: DataFrame, batch: DataFrame, clocks: Sequence[str] = ()) -> DataFrame:
    """state with the columns that only the batch has, and with clock columns that it lacks; null in its rows."""
    more = {f.name: f.dataType for f in batch.schema if f.name not in state.columns} | {c: "timestamp" for c in clocks if c not in state.columns}
    return state.withColumns({c: F.lit(None).cast(kind) for c, kind in more.items()}) if more else state


def _record(spark: SparkSession, staging: str, months: list[str], state: str) -> None:
    spark.createDataFrame([(months, state)], "months array<string>, state string").coalesce(1).write.mode("overwrite").parquet(f"{staging}/commit")


def _overwrite(spark: SparkSession, path: str, staging: str, month: str) -> None:
    spark.read.parquet(f"{staging}/rows").hint("rebalance", month).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)


def recover(spark: SparkSession, path: str, staging: str, month: str = "month") -> list[str]:
    """Finishes an upsert that broke off after its rows were staged; returns its months, none where nothing was open.

    A run that broke off before that has left the table as it was: its staged rows are without a commit record, and the next
    upsert overwrites them. Months are overwritten whole, so finishing twice does no harm.
    """
    if not exists(spark, f"{staging}/commit/_SUCCESS"):
        return []
    months, state = spark.read.parquet(f"{staging}/commit").first()
    if state != STAGED:
        return []
    _overwrite(spark, path, staging, month)
    _record(spark, staging, months, LANDED)
    return months


def upsert_months(
    spark: SparkSession, path: str, staging: str, batch: DataFrame, keys: list[str], take: list[str], month: str = "month",
    came: Sequence[str] = (), seen: Sequence[str] = (), now: Column | None = None,
) -> list[str]:
    """Upserts into a table partitioned by month: only the batch's months are read, staged and overwritten.

    Both folders may be of any store that Spark writes; a staging folder belongs to one table and one writer at a time. The
    rows are staged, a commit record says so, the months are overwritten, and the record says that too: a run that breaks off
    at any point is finished or left out by the next (`recover`). Columns that only the batch has are added, null in the rows
    it does not touch (`sources.landing.read_evolved` reads such a table). The months of a batch are a short list. Returns them.
    """
    recover(spark, path, staging, month)
    months = sorted(r[0] for r in batch.select(F.col(month).cast("string")).distinct().collect())
    state = spark.read.option("mergeSchema", True).parquet(path).withColumn(month, F.col(month).cast("string"))
    state = widened(state, batch, [*came, *seen]).where(F.col(month).isin(months))
    upsert(state, batch.withColumn(month, F.col(month).cast("string")), keys, take, came, seen, now).write.mode("overwrite").parquet(f"{staging}/rows")
    _record(spark, staging, months, STAGED)
    _overwrite(spark, path, staging, month)
    _record(spark, staging, months, LANDED)
    return months


def run_metrics(labelled: DataFrame, scored: DataFrame) -> DataFrame:
    """One row: training_rows, onset_events, fallback_rate, rows_scored, rows_explained."""
    train = labelled.agg(F.count("y").alias("training_rows"), F.sum("y").cast("long").alias("onset_events"), F.avg("y").alias("fallback_rate"))
    return train.crossJoin(F.broadcast(scored.agg(F.count("*").alias("rows_scored"), F.count("explanation").alias("rows_explained"))))  # one row each
