"""Readers of landed files."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


#: Holds a malformed line as it stands.
BROKEN = "_tide_broken"


def _header(spark: SparkSession, file: str) -> list[str]:
    """The column names in the first line of a CSV file, of which no more than a buffer is read; none where it is empty."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = place.getFileSystem(conf).open(place)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return next(csv.reader([line.removeprefix("\ufeff")]), []) if line else []


def _by_header(spark: SparkSession, path: str | list[str], columns: list[str]) -> list[tuple[list[str], list[str]]]:
    """The files of path (files, folders, patterns) by the header they share, each as (header, files)."""
    files = [unquote(f) for f in spark.read.text(path).inputFiles()]
    if not files:
        raise FileNotFoundError("no file to read")
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: _header(spark, f), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        if lost := [c for c in columns if c not in header]:
            raise ValueError(f"{file} has no column {', '.join(lost)}")
        if len(set(header)) < len(header):
            raise ValueError(f"{file} repeats a column name")
        found.setdefault(tuple(header), []).append(file)
    return [(list(header), sorted(files)) for header, files in sorted(found.items())]


def _csv(spark: SparkSession, path: str | list[str], columns: list[str], more: list[str]) -> DataFrame:
    """One scan for each header: the named columns, and those of `more`. Fields are only counted where none is skipped."""
    parts = []
    for header, files in _by_header(spark, path, columns):
        schema = StructType([StructField(c, StringType()) for c in [*header, *more]])
        parts.append(spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", not more).csv(files).select(*columns, *more))
    return reduce(DataFrame.unionByName, parts)


def csv_columns(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """The named columns of CSV files with headers, all text. Columns are found by name; a missing one is an error.

    Each file is read by its own header, so columns may stand in any order; all files of one header are one scan. What a
    short line lacks is null, and what a long one has beyond the header is left out: `csv_routes` sets both apart.
    """
    return _csv(spark, path, columns, [])


def csv_routes(spark: SparkSession, path: str | list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of `csv_columns` whose lines have as many fields as their header, and the lines of the others, as `line`.

    A quote that is left open takes the fields after it into one, so such a line is malformed too, unless it is its last field
    that opens it: that one then begins with the quote. Empty lines are no rows.
    """
    # Spark reads no file for BROKEN alone, so a column goes with it: a length is never negative.
    rows = _csv(spark, path, columns, [BROKEN]).where(F.coalesce(F.length(columns[0]), F.lit(0)) >= 0)
    return rows.where(F.col(BROKEN).isNull()).drop(BROKEN), rows.where(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("line"))


def typed(rows: DataFrame, number: str, quarantine: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Casts a text column to double: strictly, or with the rows that fail set apart."""
    if not quarantine:
        return rows.withColumn(number, F.col(number).cast("double")), None
    good = F.col(number).isNull() | F.col(number).try_cast("double").isNotNull()
    return rows.where(good).withColumn(number, F.col(number).try_cast("double")), rows.where(~good)


def renamed(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """One vocabulary: the columns of `names`, under their new names."""
    return rows.select(*[F.col(old).alias(new) for old, new in names.items()])


def month_of(spark: SparkSession, path: str, month: str) -> DataFrame:
    """One month of a table partitioned by month (yyyyMM); an absent month is an error."""
    rows = spark.read.parquet(path).withColumn("month", F.col("month").cast("string")).where(F.col("month") == month)
    if rows.isEmpty():
        raise FileNotFoundError(f"{path} has no month {month}")
    return rows


def months_between(spark: SparkSession, path: str, first: str, last: str, of: DataFrame | None = None) -> DataFrame:
    """The months first to last (yyyyMM) of a table partitioned by month, only those that `of` (month) has where it is given.

    The bounds prune folders before anything is read. `of`, a small table with a row for each month, is broadcast, and its
    months prune the folders that are left when the query runs.
    """
    rows = spark.read.schema(spark.read.parquet(path).drop("month").schema.add("month", "string")).parquet(path)
    rows = rows.where(F.col("month").between(first, last))
    return rows if of is None else rows.join(F.broadcast(of.select("month").distinct()), "month")


def json_series(rows: DataFrame, key: str, body: Column) -> DataFrame:
    """One row for each {date, items} of a JSON array: key, month, items."""
    parsed = rows.select(key, F.explode(F.from_json(body, "array<struct<date: string, items: double>>")).alias("_p"))
    return parsed.select(key, F.trunc(F.to_date("_p.date"), "month").alias("month"), F.col("_p.items").alias("items"))
