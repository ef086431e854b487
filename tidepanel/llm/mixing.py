"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Each document of a source is wanted target / size times. The whole part is taken; the fraction is a probability that
dependent rounding turns into 0 or 1. Two documents meet, and mass moves between them at random until one of the two
is whole; the sum of size x probability stays as it was, so the words a source gives differ from its target by one
document at most. Documents meet in a tree: groups of about LEAF by hash, whose residuals (one each) meet in the next
level, until one is left, which a last draw rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, documents, durable, shards_for, text_of

LEAF = 48
#: Rows that repeat one document and are numbered in one task.
PART_ROWS = 100_000
#: A probability this near 0 or 1 is whole.
NEAR = 1e-9


def _draw(*seed: Column) -> Column:
    """A number in [0, 1) that depends on the seed alone."""
    return (F.xxhash64(*seed).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, cap: float = 3.0) -> DataFrame:
    """source, source_size -> the same and target.

    Sources in code-point order, null last, weigh 1, 2, 3 and again; together they share the sum of all sizes. No
    target is above cap x its source's size: the level at which water poured into vessels of width weight and volume
    cap x size holds the sum gives what resharing the excess ends at. The table has a row for each source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", (F.row_number().over(ordered) - 1) % 3 + 1)
    fill = Window.orderBy(cap * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    room = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0.0))
    width = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = weighed.withColumn("level", room / width)
    return level.select("source", "source_size", F.least(cap * F.col("source_size"), F.max("level").over(everything) * F.col("weight")).cast("double").alias("target"))


def _snap(p: Column) -> Column:
    return F.when(p < NEAR, 0.0).when(p > 1 - NEAR, 1.0).otherwise(p)


def _meet(level: int):
    """One step of the pivotal method: the carried document and the next one."""

    def step(acc: Column, x: Column) -> Column:
        a = acc["carry"]
        ratio = x["s"] / a["s"]
        up, down = F.least(1 - a["p"], x["p"] * ratio), F.least(a["p"], (1 - x["p"]) * ratio)
        won = F.coalesce(_draw(F.lit(level), a["rank"], x["rank"]) * (up + down) < down, F.lit(False))
        pa = _snap(F.when(won, a["p"] + up).otherwise(a["p"] - down))
        px = _snap(F.when(won, x["p"] - up / ratio).otherwise(x["p"] + down / ratio))
        a1, x1 = a.withField("p", pa), x.withField("p", px)
        whole = (pa == 0.0) | (pa == 1.0)
        return F.struct(F.when(whole, x1).otherwise(a1).alias("carry"), F.array_append(acc["done"], F.when(whole, a1).otherwise(x1)).alias("done"))

    return step


def round_fractions(units: DataFrame, key: str, largest: int) -> DataFrame:
    """units: key, s (size above 0), p (0 to 1), n (units of the key), rank (long, orders the units), more -> the same with p 0 or 1.

    `largest` is the size of the largest key: the tree's height follows from it.
    """
    columns = ["rank", *[c for c in units.columns if c not in ("rank", key)]]
    rest, out, groups, level = units, [], largest, 0
    empty = None
    while True:
        groups, level = shards_for(groups, LEAF), level + 1
        mine = F.col("n")
        for _ in range(level):
            mine = F.ceil(mine / LEAF)
        member = F.struct(*columns)
        met = (
            rest.groupBy(key, F.pmod(F.xxhash64(F.lit(level), "rank"), mine).alias("_group"))
            .agg(F.sort_array(F.collect_list(member)).alias("_all"))
            .select(key, F.aggregate(F.slice("_all", 2, F.size("_all")), F.struct(F.col("_all")[0].alias("carry"), F.slice("_all", 1, 0).alias("done")), _meet(level)).alias("_met"))
        )
        met = durable(met.select(key, "_met.carry", "_met.done"))
        out.append(met.select(key, F.explode("done").alias("_u")).select(key, "_u.*"))
        rest = met.select(key, "carry.*")
        if groups <= 1:
            break
    last = rest.withColumn("p", F.when((F.col("p") > 0) & (F.col("p") < 1), (_draw(F.lit("last"), F.col("rank")) < F.col("p")).cast("double")).otherwise(F.col("p")))
    result = last
    for part in out:
        result = result.unionByName(part)
    return result


def mix(docs: DataFrame, cap: float = 3.0) -> DataFrame:
    """source, doc_id, text_hash, rows, size, source_size, target, base, extra: how often each document is taken.

    docs: doc_id, text, source; more columns are ignored. Size is the number of words; null texts have none. Rows that
    agree in source, doc_id and text (rows counts them) are each taken base times, and `extra` of them once more: what the
    rows ask for together in whole copies, and at most one that the rounding adds. Documents without words are rounded by
    a draw of their own. A source without words has the target 0. An empty table gives an empty result.
    """
    text = text_of()
    units = (
        docs.select("source", "doc_id", F.xxhash64(text).alias("text_hash"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
        .groupBy("source", "doc_id", "text_hash")
        .agg(F.max("size").alias("size"), F.count("*").alias("rows"))
    )
    units = durable(units)
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    sizes = durable(sizes)
    wanted = durable(source_targets(sizes.select("source", "source_size"), cap).join(sizes.select(F.col("source").alias("_s"), "n"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    largest = wanted.agg(F.max("n")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    asked = F.greatest(rate - F.col("base"), F.lit(0.0)) * F.col("rows")
    all_units = (
        units.join(wanted.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("base", F.floor(rate + NEAR))
        .withColumn("whole", F.floor(asked + NEAR))
        .withColumn("p", F.greatest(asked - F.col("whole"), F.lit(0.0)))
        .withColumn("rank", F.xxhash64("doc_id", "text_hash"))
        .withColumn("s", F.col("size").cast("double"))
    )
    free = (F.col("s") > 0) & (F.col("p") > NEAR)
    alone = all_units.where(~free).withColumn("p", F.when(F.col("p") > NEAR, (_draw(F.lit("empty"), F.col("rank")) < F.col("p")).cast("double")).otherwise(0.0))
    rounded = round_fractions(all_units.where(free), "source", largest) if largest else all_units.where(free)
    return rounded.unionByName(alone).select("source", "doc_id", "text_hash", "rows", "size", "source_size", "target", "base", (F.col("whole") + F.col("p").cast("long")).alias("extra"))


def mixed_documents(docs: DataFrame, cap: float = 3.0) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with all its columns.

    Null texts are empty and are taken as documents without words; an empty table gives an empty result. Of rows that
    agree in source, doc_id and text the first few, by their place in docs, are those taken once more.
    """
    taken = durable(mix(docs, cap).where("base + extra > 0"))
    own = taken.select(F.col("source").alias("_tide_s"), F.col("doc_id").alias("_tide_d"), F.col("text_hash").alias("_tide_h"), F.col("base").alias("_tide_b"), F.col("extra").alias("_tide_e"), F.col("rows").alias("_tide_r"))
    same = F.col("doc_id").eqNullSafe(F.col("_tide_d")) & F.col("source").eqNullSafe(F.col("_tide_s")) & (F.xxhash64(text_of()) == F.col("_tide_h"))
    names, met = [F.col(f"`{c}`") for c in docs.columns], docs.join(own.hint("merge"), same)  # both grow alike
    single = met.where("_tide_r = 1").withColumn("_tide_n", F.col("_tide_b") + F.col("_tide_e")).select(*names, "_tide_n")
    most = taken.agg(F.max("rows")).first()[0] or 0
    both = single.unionByName(_numbered(met.where("_tide_r > 1"), most).select(*names, "_tide_n")) if most > 1 else single
    return both.where("_tide_n > 0").withColumn("_tide_copy", F.explode(F.sequence(F.lit(1), F.col("_tide_n").cast("int")))).select(*names)


def _numbered(met: DataFrame, most: int) -> DataFrame:
    """Rows that repeat, with _tide_n: within parts, dealt evenly, they are numbered, so that no task gets all of a hot document's."""
    again = met.withColumn("_tide_at", F.monotonically_increasing_id())
    again = durable(again.withColumn("_tide_part", F.pmod("_tide_at", F.lit(shards_for(most, PART_ROWS)))))
    key = ["_tide_s", "_tide_d", "_tide_h"]
    parts = again.groupBy(*key, "_tide_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*key).orderBy("_tide_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select(*[F.col(k).alias(f"{k}_") for k in key], F.col("_tide_part").alias("_tide_part_"), before.alias("_tide_before"))
    same = F.col("_tide_part") == F.col("_tide_part_")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    number = F.col("_tide_before") + F.row_number().over(Window.partitionBy(*key, "_tide_part").orderBy("_tide_at")) - 1
    return again.join(offsets, same).withColumn("_tide_n", F.col("_tide_b") + (number < F.col("_tide_e")).cast("long"))


def op6(spark, sf_dir: str) -> DataFrame:
    found = mix(documents(spark, sf_dir)).withColumn("_row", F.explode(F.sequence(F.lit(0), F.col("rows").cast("int") - 1)))
    copies = F.col("base") + (F.col("_row") < F.col("extra")).cast("long")
    return found.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"))
