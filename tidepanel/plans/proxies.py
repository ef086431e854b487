"""The library's inputs, read from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import first_of_month
from ..functions.text import chemical_name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("month", first_of_month(F.col("l_shipdate"))).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))


def facts(spark: SparkSession, sf_dir: str, by: str = "brand") -> DataFrame:
    """code, name, month, practice, items: order lines as prescriptions, by brand, by part or by chemical."""
    lines = _lines(spark, sf_dir)
    code, name = {"brand": (F.col("p_brand"), F.concat(F.lit("brand "), F.col("p_brand"))), "part": (F.col("p_partkey").cast("string"), F.col("p_name")), "chemical": (F.concat_ws(" ", "p_name", "p_type"),) * 2}[by]
    return lines.select(code.alias("code"), name.alias("name"), "month", F.col("l_suppkey").alias("practice"), F.col("l_quantity").alias("items"))


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pack, drug, chemical, month: large returned lines as events; some drugs are named another way."""
    kind = F.when(F.col("l_discount") >= 0.1, " sr - ").otherwise(" ")
    drug = F.concat("p_name", F.lit(" "), "p_type", kind, F.col("p_size").cast("string"), F.lit("mg tablets"))
    events = _lines(spark, sf_dir).where("l_returnflag = 'R' AND l_quantity >= 45")
    return events.select(F.col("l_partkey").alias("pack"), drug.alias("drug"), chemical_name(drug).alias("chemical"), "month")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chemical, month, total_items."""
    return facts(spark, sf_dir, "chemical").groupBy(F.col("code").alias("chemical"), "month").agg(F.sum("items").alias("total_items"))
