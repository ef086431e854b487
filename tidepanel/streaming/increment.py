"""Months processed once: an incremental batch, and the same as an available-now stream over a landing folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import GateError
from ..sources.landing import AUDIT, append, land, unprocessed
from ..sources.staging import exists


def audited(spark: SparkSession, path: str) -> DataFrame:
    """The audit table, empty where there is none yet."""
    return spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], AUDIT)


def process_months(spark: SparkSession, months: list[str], batch_of: Callable[[str], DataFrame], month_column: str, table: str, audit: str, stop: bool = True) -> list[str]:
    """Lands each requested month that has no verified audit row, all in one write. Returns the months that landed.

    A month fails when its batch can't be opened, has no rows, or has a row of another month; that is one job over the month
    column of all batches. With `stop` nothing from the first failed month on is landed, and then it is an error; without it
    the others land, and a failed month's audit row says so. Audit rows are written last, so a run that broke off is done
    again, and a second run does only what is not verified.
    """
    done = audited(spark, audit).where("verified")
    requested = spark.createDataFrame([(m,) for m in months], "month string")
    todo = sorted(r[0] for r in unprocessed(requested, done).collect())
    batches, failed = {}, {}
    for month in todo:
        try:
            batch = batch_of(month)
            batches[month] = batch.withColumn("_own", F.regexp_replace(F.col(month_column).cast("string"), "-", "")).drop(month_column).withColumn("month", F.lit(month))
        except (AnalysisException, FileNotFoundError) as e:
            failed[month] = f"{month} can't be read: {str(e).splitlines()[0]}"
    every = reduce(DataFrame.unionByName, batches.values()) if batches else None
    sizes = {r["month"]: (r["n"], r["wrong"]) for r in every.groupBy("month").agg(F.count("*").alias("n"), F.count_if(~F.col("_own").eqNullSafe(F.col("month"))).alias("wrong")).collect()} if batches else {}
    for month in batches:
        n, wrong = sizes.get(month, (0, 0))
        if not n or wrong:
            failed[month] = f"the batch is not of {month} alone" if n else f"the batch of {month} is empty"
    good = [m for m in todo if m not in failed and not (stop and failed and m > min(failed))]
    if good:
        found = land(spark, reduce(DataFrame.unionByName, [batches[m] for m in good]).drop("_own"), good, table)
        lost = [r["month"] for r in found.where("NOT verified").collect()]
        append(found.coalesce(1), audit)
        if lost and stop:
            raise GateError(f"{lost} were not landed whole")
        good = [m for m in good if m not in lost]
    if failed and stop:
        raise GateError(failed[min(failed)])
    if failed:
        append(spark.createDataFrame([(m, sizes.get(m, (None,))[0], None, False) for m in sorted(failed)], AUDIT).coalesce(1), audit)
    return good


def stream_months(spark: SparkSession, folder: str, schema: StructType, checkpoint: str, upsert: Callable[[DataFrame], None]):
    """Reads the files of a landing folder that are new since the last run, and gives them to an upsert, batch by batch."""
    rows = spark.readStream.schema(schema).parquet(folder).withColumn("month", F.col("month").cast("string"))
    return rows.writeStream.foreachBatch(lambda batch, _: upsert(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
