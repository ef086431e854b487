"""Sinks: verified landing of months, exports, logs, and the months still to do."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.quality import GateError, enforce, unreconciled

AUDIT = "month string, source_rows long, landed_rows long, verified boolean"


def write_months(rows: DataFrame, path: str, max_rows_per_file: int = 0) -> None:
    """Overwrites the months that rows has and no other. Files are balanced by size; a large month has several."""
    rows.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_rows_per_file).partitionBy("month").parquet(path)


def landed_counts(spark: SparkSession, months: list[str], path: str) -> DataFrame:
    """month, landed_rows of the asked months that the table has. No column is read: the counts are those of the files' footers."""
    table = spark.read.parquet(path).select(F.col("month").cast("string").alias("month"))
    return table.where(F.col("month").isin(months)).groupBy("month").agg(F.count("*").alias("landed_rows"))


def land(spark: SparkSession, rows: DataFrame, months: list[str], path: str) -> DataFrame:
    """Lands the requested months, reading the source once: month, source_rows, landed_rows, verified.

    A row of any other month (or of none) fails the write, which then leaves the table as it was. The source's rows are
    counted on their way to the files; the landed ones are counted in the table afterwards. Where the two differ the
    source is counted again, since tasks that ran twice count twice. Months are a short list.
    """
    asked = F.coalesce(F.col("month").isin(months), F.lit(False))
    rule = f"there are rows of other months than {months}"
    gated = rows.withColumn("month", F.when(asked, F.col("month")).otherwise(F.raise_error(F.lit(rule)).cast("string")))
    seen = Observation()
    try:
        write_months(gated.observe(seen, *[F.count_if(F.col("month") == m).alias(m) for m in months]) if months else gated, path)
    except Exception as e:
        if rule in str(e):
            raise GateError(rule) from None
        raise
    try:
        counted = {m: n for m, n in seen.get.items() if n} if months else {}
    except Py4JJavaError:  # the optimizer saw that there are no rows, and took the counts out too
        counted = None
    landed = dict(map(tuple, landed_counts(spark, months, path).collect())) if counted else {}
    if counted != landed:  # also where nothing was observed
        counted = dict(map(tuple, rows.groupBy("month").agg(F.count("*")).collect()))
    audit = [(m, counted.get(m), landed.get(m), counted.get(m) is not None and counted.get(m) == landed.get(m)) for m in months]
    return spark.createDataFrame(audit, AUDIT)


def land_one(spark: SparkSession, batch: DataFrame, month_column: str, month: str, path: str) -> DataFrame:
    """A batch that must be of one month, written with or without a hyphen; its key becomes the requested month."""
    own = F.regexp_replace(F.col(month_column).cast("string"), "-", "")
    audit = land(spark, batch.withColumn("month", own).drop(*{month_column} - {"month"}), [month], path)
    enforce(unreconciled(audit), f"{month} was not landed whole")
    return audit


def write_sorted(rows: DataFrame, path: str, *by: str, files: int | None = None) -> None:
    """Overwrites path with rows in the order of `by`: files have ranges of keys that follow one another, each file in order.

    The ranges come from a sample of the keys, so files are about as large as each other. Rows of one key are in one file.
    """
    dealt = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    dealt.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def read_sorted(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a sorted table with `position`, their place in its order, from 0. Files are counted, not rows sorted."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each file
    return rows.join(F.broadcast(sizes.select("_file", before.alias("_before"))), "_file").withColumn("position", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table to which columns were added: older files have null there."""
    return spark.read.option("mergeSchema", True).parquet(path)


def unprocessed(requested: DataFrame, processed: DataFrame) -> DataFrame:
    return requested.select("month").distinct().join(processed, "month", "left_anti")
