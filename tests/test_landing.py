"""Landing in one read, several months in one write, pruned reads and sorted tables."""

import shutil
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidepanel.operators.quality import GateError
from tidepanel.sources import landing, tables
from tidepanel.streaming import increment

from .test_panel import rows


def source(spark, months, n=50, reads=None):
    """n rows a month; `reads` counts the rows that are read."""
    df = spark.createDataFrame([(i, m) for m in months for i in range(n)], "x long, month string")

    def seen(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    return df.mapInPandas(seen, df.schema) if reads is not None else df


def jobs(spark, run):
    """Spark jobs of a call."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_landing_reads_its_source_once(spark, tmp_path):
    reads, table = spark.sparkContext.accumulator(0), str(tmp_path / "t")
    audit = landing.land(spark, source(spark, ["202001", "202002"], reads=reads), ["202001", "202002", "202003"], table)
    assert rows(audit, "month") == [("202001", 50, 50, True), ("202002", 50, 50, True), ("202003", None, None, False)]
    assert reads.value == 100
    assert jobs(spark, lambda: landing.land(spark, source(spark, ["202001"]), ["202001"], table)) <= 6
    assert spark.read.parquet(table).count() == 100


def test_a_lost_file_is_found(spark, tmp_path, monkeypatch):
    table, write = str(tmp_path / "t"), landing.write_months

    def lossy(df, path, *args):
        write(df, path, *args)
        next((Path(path) / "month=202002").glob("*.parquet")).unlink()

    monkeypatch.setattr(landing, "write_months", lossy)
    audit = landing.land(spark, source(spark, ["202001", "202002"]), ["202001", "202002"], table)
    assert rows(audit, "month") == [("202001", 50, 50, True), ("202002", 50, None, False)]


def test_a_row_of_another_month_leaves_the_table_as_it_was(spark, tmp_path):
    table = str(tmp_path / "t")
    landing.land(spark, source(spark, ["202001"]), ["202001"], table)
    for wrong in (source(spark, ["202001", "202009"], 3), source(spark, ["202001"], 3).unionByName(spark.createDataFrame([(1, None)], "x long, month string"))):
        with pytest.raises(GateError):
            landing.land(spark, wrong, ["202001"], table)
    assert spark.read.parquet(table).count() == 50
    assert rows(landing.land(spark, source(spark, []), ["202001"], str(tmp_path / "none")), "month") == [("202001", None, None, False)]


def batches(spark, wrong=(), missing=()):
    def of(month):
        if month in missing:
            return spark.read.parquet(f"/nowhere/{month}")
        own = "2019-07" if month in wrong else f"{month[:4]}-{month[4:]}"
        return spark.createDataFrame([(own, float(i)) for i in range(5)], "ym string, x double")

    return of


MONTHS = ["202001", "202002", "202003"]


@pytest.mark.parametrize("broken", [{"wrong": ["202002"]}, {"missing": ["202002"]}])
def test_a_failed_month_is_kept_out_and_done_later(spark, tmp_path, broken):
    table, audit = str(tmp_path / "t"), str(tmp_path / "a")
    run = lambda of, **k: increment.process_months(spark, MONTHS, of, "ym", table, audit, **k)
    assert run(batches(spark, **broken), stop=False) == ["202001", "202003"]
    assert rows(spark.read.parquet(table).groupBy(F.col("month").cast("string")).count(), "month") == [("202001", 5), ("202003", 5)]
    assert rows(spark.read.parquet(audit).select("month", "verified"), "month") == [("202001", True), ("202002", False), ("202003", True)]
    assert run(batches(spark), stop=False) == ["202002"] and run(batches(spark), stop=False) == []
    assert spark.read.parquet(table).count() == 15


def test_with_stop_nothing_after_the_failed_month_lands(spark, tmp_path):
    table, audit = str(tmp_path / "t"), str(tmp_path / "a")
    with pytest.raises(GateError, match="202002"):
        increment.process_months(spark, MONTHS, batches(spark, wrong=["202002"]), "ym", table, audit)
    assert rows(spark.read.parquet(audit).select("month"), "month") == [("202001",)]
    assert increment.process_months(spark, MONTHS, batches(spark), "ym", table, audit) == ["202002", "202003"]


def test_jobs_do_not_grow_with_the_months(spark, tmp_path):
    many = [f"20{y:02d}{m:02d}" for y in (10, 11) for m in range(1, 13)]
    run = lambda months, name: jobs(spark, lambda: increment.process_months(spark, months, batches(spark), "ym", str(tmp_path / name), str(tmp_path / f"{name}-audit")))
    few, most = run(many[:2], "few"), run(many, "many")
    assert most <= few + 3
    assert spark.read.parquet(str(tmp_path / "many")).count() == 5 * 24


def test_a_batch_whose_key_is_named_month(spark, tmp_path):
    audit = landing.land_one(spark, spark.createDataFrame([("2020-01", 1)], "month string, x int"), "month", "202001", str(tmp_path / "t"))
    assert rows(audit, "month") == [("202001", 1, 1, True)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_are_pruned(spark, tmp_path):
    table = str(tmp_path / "t")
    months = [f"2020{m:02d}" for m in range(1, 13)]
    landing.write_months(source(spark, months), table)
    wanted = spark.createDataFrame([(m, i) for i, m in enumerate(months)], "month string, n int").where("n % 5 = 2")
    df = tables.months_between(spark, table, "202003", "202010", wanted).select("x", "month")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(month" in text and "dynamicpruning" in text.lower()
    assert rows(df.groupBy("month").count(), "month") == [("202003", 50), ("202008", 50)]
    assert rows(tables.month_of(spark, table, "202003").agg(F.count("*")), "count(1)") == [(50,)]
    for month in months:  # folders outside are not opened: they could as well be broken
        if month not in ("202003", "202008"):
            shutil.rmtree(Path(table) / f"month={month}")
            (Path(table) / f"month={month}").mkdir()
            (Path(table) / f"month={month}" / "part-0.parquet").write_bytes(b"no parquet")
    schema = "x long, month string"
    broken = spark.read.schema(schema).parquet(table).where(F.col("month").between("202003", "202010")).join(F.broadcast(wanted.select("month")), "month")
    assert broken.count() == 100


def test_sorted_tables_have_files_that_do_not_overlap(spark, tmp_path):
    table = str(tmp_path / "t")
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.lit("v").alias("v"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")).alias("m"))
    landing.write_sorted(df, table, "k", "m", files=6)
    found = []
    for f in sorted(Path(table).glob("*.parquet")):
        column = pq.ParquetFile(f).metadata.row_group(0).column(0).statistics
        keys = pq.read_table(f).column("k").to_pylist()
        assert keys == sorted(keys) and (keys[0], keys[-1]) == (column.min, column.max)
        found.append((column.min, column.max))
    assert len(found) == 6 and all(a[1] < b[0] for a, b in zip(found, found[1:]))
    got = rows(landing.read_sorted(spark, table).select("position", "k"), "position")
    assert [p for p, _ in got] == list(range(5000)) and [k for _, k in got] == sorted(k for _, k in got)
    landing.write_sorted(df.limit(0), table, "k")
    assert landing.read_sorted(spark, table).count() == 0
