"""From a sparse archive of events to a dense panel of entities and months."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import written

#: Cells of a panel that one task holds, about.
CELLS = 250_000


def canonical_names(events: DataFrame) -> DataFrame:
    """events: pack, chemical, month -> pack, chemical: the name in the pack's latest month, the greatest of several."""
    return events.groupBy("pack").agg(F.max_by("chemical", F.struct("month", "chemical")).alias("chemical"))


def names_per_pack(events: DataFrame) -> DataFrame:
    """Packs that had more than one name, with their number."""
    return events.select("pack", "chemical").distinct().groupBy("pack").agg(F.count("*").alias("n_names")).where("n_names > 1")


def attach_names(events: DataFrame, names: DataFrame) -> DataFrame:
    """events with the canonical chemical in place of their own; a pack without one has null, which `unmapped` shows."""
    return events.drop("chemical").join(names, "pack", "left")


def unmapped(events: DataFrame) -> DataFrame:
    return events.where(F.col("chemical").isNull())


def dense_panel(events: DataFrame, entity: str) -> DataFrame:
    """entity, month, on_concession for every entity in every month from the first to the last event.

    The events are shuffled, with one row for each entity and month that has any; the cells are made after that, where their
    entity is. The panel has one partition for about CELLS of its cells, so a task that sorts them stays as it is when the panel grows.
    """
    marks = written(events.select(entity, "month").distinct())
    lo, hi, n, months = marks.agg(F.min("month"), F.max("month"), F.approx_count_distinct(entity), F.count_distinct("month")).first()
    span = 12 * (hi.year - lo.year) + hi.month - lo.month + 1 if lo else 1
    one = marks.repartition(max(1, ceil(n * max(span, months) / CELLS)), entity).groupBy(entity).agg(F.collect_set("month").alias("_marks"))
    calendar = F.sequence(F.lit(lo), F.lit(hi), F.expr("interval 1 month")) if lo else F.array().cast(f"array<{marks.schema['month'].dataType.simpleString()}>")
    cells = one.select(entity, "_marks", F.explode(calendar).alias("month"))
    return cells.select(entity, "month", (F.col(entity).isNotNull() & F.array_contains("_marks", F.col("month"))).alias("on_concession"))


def persistence_and_onset(panel: DataFrame, entity: str) -> DataFrame:
    """One row: how often an entity that is on (off) in a month is on in the next, and of how many transitions."""
    after = panel.withColumn("next", F.lead("on_concession").over(Window.partitionBy(entity).orderBy("month"))).where("next IS NOT NULL")
    share = lambda on: F.avg(F.when(F.col("on_concession") == on, F.col("next").cast("double")))
    return after.agg(share(True).alias("persistence_rate"), share(False).alias("onset_rate"), F.count_if("on_concession").alias("n_on_transitions"), F.count_if(~F.col("on_concession")).alias("n_off_transitions"))


def recent_rows(panel: DataFrame, entity: str, n: int) -> DataFrame:
    """The last n months of each entity."""
    latest = Window.partitionBy(entity).orderBy(F.col("month").desc())
    return panel.withColumn("_r", F.row_number().over(latest)).where(F.col("_r") <= n).drop("_r")
