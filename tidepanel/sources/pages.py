"""Tables and links on landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import month_from_name
from ..functions.text import number, strip

#: Shapes of the lines of a monthly page.
HEADER = r"(?i)\b(January|February|March|April|May|June|July|August|September|October|November|December)\s+(\d{4})\b"
ROW = r"^\|\s*([^|]+?)\s*\|\s*([^|]+?)\s*\|\s*£([\d,]+(?:\.\d+)?)\s*(?:\(previously\s+£([\d,]+(?:\.\d+)?)\))?"
TOTAL = r"(?i)total[^0-9]*(\d+)\D*$"
MONTH_TOKEN = r"(20(?:1[4-9]|2[0-9])(?:0[1-9]|1[0-2]))"
ANCHOR = r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'


def page_lines(spark: SparkSession, path: str) -> DataFrame:
    """page, line_no, line of the text files of a folder."""
    pages = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("page"), "value")
    return pages.select("page", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def page_rows(lines: DataFrame) -> DataFrame:
    """lines: page, line_no, line -> page, line_no, drug, pack, price, previous_price of the table's rows."""
    got = lambda i: F.regexp_extract("line", ROW, i)
    rows = lines.where(F.col("line").rlike(ROW))
    return rows.select("page", "line_no", strip(got(1)).alias("drug"), strip(got(2)).alias("pack"), number(got(3)).alias("price"), number(F.nullif(got(4), F.lit(""))).alias("previous_price"))


def page_facts(lines: DataFrame) -> DataFrame:
    """page, month (of its first header), stated_total (at the end of its last line that is not blank), n_rows.

    Lines are aggregated; a page's text is never put together again.
    """
    head = F.when(F.col("line").rlike(HEADER), F.struct("line_no", F.regexp_extract("line", HEADER, 1).alias("m"), F.regexp_extract("line", HEADER, 2).alias("y")))
    last = F.max(F.when(strip(F.col("line")) != "", F.struct("line_no", "line")))
    out = lines.groupBy("page").agg(F.min(head).alias("_h"), last.alias("_l"), F.count_if(F.col("line").rlike(ROW)).alias("n_rows"))
    return out.select("page", month_from_name(F.col("_h.m"), F.col("_h.y")).alias("month"), F.nullif(F.regexp_extract("_l.line", TOTAL, 1), F.lit("")).cast("long").alias("stated_total"), "n_rows")


def bad_pages(facts: DataFrame) -> DataFrame:
    """Pages without a month, without rows, or whose stated total is not their number of rows; no total is no fault."""
    fault = F.when(F.col("month").isNull(), "no month").when(F.col("n_rows") == 0, "no rows").when(F.col("stated_total") != F.col("n_rows"), "total differs")
    return facts.withColumn("fault", fault).where("fault IS NOT NULL")


def links(pages: DataFrame) -> DataFrame:
    """pages: page_id, html -> page_id, position, href, text of each anchor; tags inside the text are dropped."""
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("text"))
    one = pages.select("page_id", F.posexplode(both).alias("position", "_a"))
    return one.select("page_id", "position", F.col("_a.href").alias("href"), strip(F.regexp_replace("_a.text", "<[^>]*>", "")).alias("text"))


def absolute(href: Column, host: str) -> Column:
    return F.when(href.startswith("/"), F.concat(F.lit(host), href)).otherwise(href)


def first_link(found: DataFrame, test: Column, host: str) -> DataFrame:
    """page_id, href: the first anchor of each page that passes the test."""
    hit = found.where(test).groupBy("page_id").agg(F.min_by("href", "position").alias("_href"))
    return hit.select("page_id", absolute(F.col("_href"), host).alias("href"))


def holds(token: str) -> Column:
    """The token in an anchor's text or target."""
    return F.col("text").contains(token) | F.col("href").contains(token)


def text_holds(words: str) -> Column:
    return F.lower("text").contains(words.lower())


def latest_token(found: DataFrame, pattern: str = MONTH_TOKEN) -> DataFrame:
    """page_id, latest: the greatest match in any anchor's text and target; pages without one are not in the result."""
    tokens = F.regexp_extract_all(F.concat_ws(" ", "text", "href"), F.lit(pattern), F.lit(1))
    return found.select("page_id", F.explode(tokens).alias("t")).groupBy("page_id").agg(F.max("t").alias("latest"))
