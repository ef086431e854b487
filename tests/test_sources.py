"""Malformed CSV lines, many files in few scans, and upserts that break off."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import upsert
from tidepanel.sources import landing, tables

WHEN, LATER = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)


def rows(df, *by):
    return [tuple(r) for r in (df.orderBy(*by) if by else df).collect()]


def test_malformed_lines_have_their_own_route(spark, tmp_path):
    (tmp_path / "a 1.csv").write_text('CODE,NAME,ITEMS\nc1,"a, b",1\nc2,x\nc3,"open,3\nc4,y,4,5\nc5,,5\n\n')
    (tmp_path / "b.csv").write_text('ITEMS,CODE\n6,c6\n7,c7,more\n')
    (tmp_path / "c.csv").write_text("CODE,NAME,ITEMS\n")
    good, broken = tables.csv_routes(spark, str(tmp_path), ["CODE", "ITEMS"])
    assert rows(good, "CODE") == [("c1", "1"), ("c5", "5"), ("c6", "6")]
    assert sorted(r.line for r in broken.collect()) == sorted(['c2,x', 'c3,"open,3', "c4,y,4,5", "7,c7,more"])
    assert good.count() == 3 and broken.count() == 4 and good.select("ITEMS").where("ITEMS > 4").count() == 2
    assert tables.csv_columns(spark, str(tmp_path), ["CODE", "ITEMS"]).count() == 7


def test_files_of_one_header_are_one_scan(spark, tmp_path):
    def scans(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.csv").write_text(f"CODE,ITEMS\nc{i},{i}\n" if i % 2 else f"ITEMS,CODE\n{i},c{i}\n")
        read = tables.csv_columns(spark, [str(folder / f"{i}.csv") for i in range(n)], ["CODE", "ITEMS"])
        assert {(r.CODE, r.ITEMS) for r in read.collect()} == {(f"c{i}", str(i)) for i in range(n)}
        return read._jdf.queryExecution().executedPlan().toString().count("FileScan csv")

    assert scans(4) == scans(20) == 2


def test_faulty_headers(spark, tmp_path):
    import gzip

    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "twice.csv").write_text("A,A\n1,2\n")
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress('﻿A,"B, c"\n1,2\n'.encode()))
    for name in ("empty.csv", "twice.csv"):
        with pytest.raises(ValueError):
            tables.csv_columns(spark, str(tmp_path / name), ["A"])
    assert rows(tables.csv_columns(spark, str(tmp_path / "z.csv.gz"), ["A", "B, c"])) == [("1", "2")]


def table(spark, tmp_path):
    start = spark.createDataFrame([("a", "202001", 1.0), ("a", "202002", 1.0)], "k string, month string, x double")
    landing.write_months(start.withColumns({"came": F.lit(WHEN), "seen": F.lit(WHEN)}), str(tmp_path / "t"))
    return str(tmp_path / "t"), str(tmp_path / "s")


def shown(spark, path):
    return rows(landing.read_evolved(spark, path).select("k", F.col("month").cast("string"), "x", F.day("came"), F.day("seen")), "month", "k")


BEFORE = [("a", "202001", 1.0, 1, 1), ("a", "202002", 1.0, 1, 1)]
AFTER = [("a", "202001", 1.0, 1, 1), ("a", "202002", 5.0, 1, 2), ("b", "202002", 6.0, 2, 2)]


def run(spark, path, staging):
    batch = spark.createDataFrame([("a", "202002", 5.0), ("b", "202002", 6.0)], "k string, month string, x double")
    return upsert.upsert_months(spark, path, staging, batch, ["k", "month"], ["x"], came=["came"], seen=["seen"], now=F.lit(LATER))


def test_clock_columns(spark, tmp_path):
    path, staging = table(spark, tmp_path)
    assert run(spark, path, staging) == ["202002"] and shown(spark, path) == AFTER
    assert upsert.recover(spark, path, staging) == []
    state = spark.createDataFrame([("a", None)], "k string, seen timestamp")
    now = upsert.merged(state, spark.createDataFrame([("a",)], "k string"), ["k"], [], seen=["seen"]).first().seen
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - now).total_seconds()) < 15 * 3600


@pytest.mark.parametrize("after_staging", [False, True])
def test_a_run_that_breaks_off_is_finished_or_left_out(spark, tmp_path, monkeypatch, after_staging):
    path, staging = table(spark, tmp_path)
    with monkeypatch.context() as patched:
        patched.setattr(upsert, "_overwrite" if after_staging else "_record", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, path, staging)
    assert shown(spark, path) == BEFORE
    assert upsert.recover(spark, path, staging) == (["202002"] if after_staging else [])
    assert shown(spark, path) == (AFTER if after_staging else BEFORE)
    assert run(spark, path, staging) == ["202002"] and [r[:4] for r in shown(spark, path)] == [r[:4] for r in AFTER]


def test_a_run_that_loses_a_month_while_it_overwrites_is_finished(spark, tmp_path, monkeypatch):
    path, staging = table(spark, tmp_path)

    def half(spark_, path_, staging_, month):
        for part in (tmp_path / "t" / "month=202002").iterdir():
            part.unlink()
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(upsert, "_overwrite", half)
        with pytest.raises(OSError):
            run(spark, path, staging)
    other = spark.createDataFrame([("c", "202001", 9.0, "new")], "k string, month string, x double, told string")
    assert upsert.upsert_months(spark, path, staging, other, ["k", "month"], ["x"], came=["came"], seen=["seen"], now=F.lit(LATER)) == ["202001"]
    assert shown(spark, path) == [AFTER[0], ("c", "202001", 9.0, 2, 2), *AFTER[1:]]
    told = landing.read_evolved(spark, path).select("k", "told")
    assert set(rows(told)) == {("a", None), ("b", None), ("c", "new")}
