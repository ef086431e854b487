"""Baselines and measures of ranked scores, none of which gathers a group.

Every measure counts the rows of each score first, writes that table, and goes on from there: its input is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import written

BUCKETS = 256


def baselines(labelled: DataFrame, burn_in: int = 12, drop_last: bool = True) -> DataFrame:
    """labelled: month, y, more -> its test months with base_rate and seasonal_rate of the months before.

    Months are summed first; what is ordered is a row a month. The seasonal rate is of the same calendar month in
    earlier years, or else the base rate. The first `burn_in` months are no test months, nor is the last on request.
    """
    months = labelled.groupBy("month").agg(F.sum("y").alias("s"), F.count("y").alias("n"))
    order = Window.orderBy("month")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    season = Window.partitionBy(F.month("month")).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    base = F.sum("s").over(past) / F.sum("n").over(past)
    rates = months.select("month", base.alias("base_rate"), F.coalesce(F.sum("s").over(season) / F.sum("n").over(season), base).alias("seasonal_rate"), F.row_number().over(order).alias("_r"), F.count("*").over(Window.partitionBy()).alias("_m"))
    tested = rates.where((F.col("_r") > burn_in) & (F.col("_r") <= F.col("_m") - int(drop_last))).drop("_r", "_m")
    return labelled.join(tested, "month")


def ranked_prefix_sums(ranked: DataFrame, score: str, sums: list[str], descending: bool = True) -> DataFrame:
    """ranked: distinct scores and columns to sum -> with before_<c>, the sums over all better scores.

    Scores are cut at a fixed number of edges, which one action finds and the plan holds as literals, so each branch
    sees the same buckets. Totals of buckets are added up over at most BUCKETS + 1 rows, scores within a bucket apart.
    """
    found = ranked.agg(F.percentile_approx(score, [i / BUCKETS for i in range(1, BUCKETS)], 10_000)).first()[0] or []
    edges = F.array(*[F.lit(float(e)) for e in sorted(set(found))]).cast("array<double>")
    dealt = ranked.withColumn("_b", F.size(F.filter(edges, lambda e: e < F.col(score))))
    way = (lambda c: F.col(c).desc()) if descending else F.col
    earlier = Window.orderBy(way("_b")).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_b").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    offsets = totals.select("_b", *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in sums])
    inside = Window.partitionBy("_b").orderBy(way(score)).rowsBetween(Window.unboundedPreceding, -1)
    joined = dealt.join(F.broadcast(offsets), "_b")  # a row for each bucket
    return joined.select(*ranked.columns, *[(F.col(f"_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"before_{c}") for c in sums])


def counted(rows: DataFrame, score: str, *groups: str) -> DataFrame:
    """groups, score, n, hits (rows with y = 1): a written table, with which measures go on."""
    return written(rows.groupBy(*groups, F.col(score).alias("score")).agg(F.count("*").alias("n"), F.sum("y").alias("hits")))


def _by_score(counts: DataFrame) -> DataFrame:
    return counts.groupBy("score").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))


def _average_precision(counts: DataFrame) -> DataFrame:
    ranked = ranked_prefix_sums(_by_score(counts), "score", ["n", "hits"])
    at = (F.col("before_hits") + F.col("hits")) / (F.col("before_n") + F.col("n"))
    return ranked.agg((F.sum(F.col("hits") * at) / F.nullif(F.sum("hits"), F.lit(0.0))).alias("average_precision"))


def average_precision(rows: DataFrame, score: str) -> DataFrame:
    """One row: the sum over distinct scores, the best first, of the recall gained times the precision there."""
    return _average_precision(counted(rows, score))


def _precision_at_k(counts: DataFrame, k: int, group: str) -> DataFrame:
    sizes = counts.groupBy(group).agg(F.sum("n").alias("_size"))
    best = Window.partitionBy(group).orderBy(F.col("score").desc())
    top = counts.withColumn("_r", F.row_number().over(best)).where(f"_r <= {int(k)}")
    before = F.coalesce(F.sum("n").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = top.withColumn("_taken", F.least(F.col("n"), F.greatest(F.lit(k) - before, F.lit(0))))
    hits = taken.groupBy(group).agg(F.sum(F.col("hits") * F.col("_taken") / F.col("n")).alias("_hits"))
    return hits.join(sizes, group).select(group, (F.col("_hits") / F.least(F.lit(k), F.col("_size"))).alias("precision"))


def precision_at_k(rows: DataFrame, score: str, k: int = 10, group: str = "month") -> DataFrame:
    """group, precision: the expected precision among the k best of each group when ties are drawn at random.

    k is capped at the group's size. Distinct scores are counted first, and at most k of them are ranked.
    """
    return _precision_at_k(counted(rows, score, group), k, group)


def drawn_top_k(rows: DataFrame, score: str, entity: str, seed: int, k: int = 10, group: str = "month") -> DataFrame:
    """The k best rows of each group, with their `rank`; ties are drawn by a hash of seed, group and entity.

    The same seed draws the same rows on each run; over many seeds each of the tied rows is drawn equally often. Rows that
    repeat an entity in a group are drawn next to each other. Null scores come last.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string"), F.col(entity).cast("string")).cast("binary"))
    best = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last(), draw, entity)
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def drawn_precision_at_k(rows: DataFrame, score: str, entity: str, seed: int, k: int = 10, group: str = "month") -> DataFrame:
    """group, precision: that of the rows `drawn_top_k` draws. Its mean over seeds is what `precision_at_k` expects."""
    return drawn_top_k(rows, score, entity, seed, k, group).groupBy(group).agg(F.avg("y").alias("precision"))


def summary(rows: DataFrame, score: str, k: int = 10) -> DataFrame:
    """One row: average_precision, mean_precision_at_k, test_months, n_rows, n_positives, base_rate."""
    by_month = counted(rows, score, "month")
    counts = by_month.groupBy("month").agg(F.sum("n").alias("n"), F.sum("hits").alias("s")).agg(F.count("*").alias("test_months"), F.sum("n").alias("n_rows"), F.sum("s").alias("n_positives"))
    mean = _precision_at_k(by_month, k, "month").agg(F.avg("precision").alias("mean_precision_at_k"))
    one = _average_precision(by_month).crossJoin(F.broadcast(mean)).crossJoin(F.broadcast(counts))  # one row each
    return one.withColumn("base_rate", F.col("n_positives") / F.col("n_rows"))


def _quantiles(counts: DataFrame, at: list[float]) -> list[float]:
    ranked = ranked_prefix_sums(_by_score(counts).where("score IS NOT NULL"), "score", ["n"], descending=False)
    total = counts.where("score IS NOT NULL").agg(F.sum("n")).first()[0] or 0
    ranks = sorted({r for q in at for r in (int(q * (total - 1)), min(total - 1, int(q * (total - 1)) + 1))}) if total else []
    wanted = F.explode(F.filter(F.array(*[F.lit(r) for r in ranks]), lambda r: (r >= F.col("before_n")) & (r < F.col("before_n") + F.col("n"))))
    values = {r["rank"]: r["score"] for r in ranked.select("score", wanted.alias("rank")).collect()} if ranks else {}
    out = []
    for q in at if ranks else []:
        low = int(q * (total - 1))
        out.append(values[low] + (q * (total - 1) - low) * (values[min(total - 1, low + 1)] - values[low]))
    return out


def quantiles(rows: DataFrame, score: str, at: list[float]) -> list[float]:
    """Quantiles with linear interpolation between order statistics; at most two rows for each reach the driver."""
    return _quantiles(counted(rows.withColumn("y", F.lit(0)), score), at)


def calibration(rows: DataFrame, score: str, bins: int = 10, gap: float = 0.03) -> DataFrame:
    """bin, n, mean_prediction, observed_rate, off for each quantile bin that has rows; off when the two differ by the gap."""
    counts = counted(rows, score)
    edges = _quantiles(counts, [i / bins for i in range(1, bins)])
    bin_of = F.size(F.filter(F.array(*[F.lit(e) for e in edges]).cast("array<double>"), lambda e: e < F.col("score")))
    sums = counts.groupBy(bin_of.alias("bin")).agg(F.sum("n").alias("n"), (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("mean_prediction"), (F.sum("hits") / F.sum("n")).alias("observed_rate"))
    return sums.withColumn("off", F.abs(F.col("mean_prediction") - F.col("observed_rate")) >= gap)
