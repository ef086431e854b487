"""Features of an entity's past that know nothing of its future, and the label that does."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.months import month_index


def history_features(panel: DataFrame, entity: str) -> DataFrame:
    """panel: entity, month, on_concession, one row a month -> the same with features and label_onset_next_month.

    All windows stand on the entity and its months, so the panel is sorted once, and shuffled only if it is not dealt by entity. The rate at a month counts transitions that began
    in an earlier row; without one it is null.
    """
    w = Window.partitionBy(entity).orderBy("month")
    so_far, earlier = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    on = F.col("on_concession")
    base = panel.withColumns({"_prev": F.lag(on).over(w), "_next": F.lead(on).over(w), "_index": month_index(F.col("month")), "_at": F.row_number().over(w)})
    clear = ~on & F.col("_next").isNotNull()
    marked = base.withColumns(
        {
            "_since": F.last(F.when(~on.eqNullSafe(F.col("_prev")), F.col("_at")), ignorenulls=True).over(so_far),
            "_last_on": F.last(F.when(on, F.col("_index")), ignorenulls=True).over(so_far),
            "n_previous_episodes": F.sum((on & ~F.coalesce("_prev", F.lit(False))).cast("int")).over(so_far),
            "_onsets": F.sum((clear & F.col("_next")).cast("int")).over(earlier),
            "_clear": F.coalesce(F.sum(clear.cast("int")).over(earlier), F.lit(0)),
            "label_onset_next_month": F.when(clear, F.col("_next").cast("double")),
        }
    )
    return marked.select(
        entity, "month", "on_concession",
        (F.col("_at") - F.col("_since") + 1).alias("streak_length"),
        (F.col("_index") - F.col("_last_on")).alias("time_since_last_concession"),
        F.col("_last_on").isNull().alias("never_seen_on_concession"),
        "n_previous_episodes",
        F.when(F.col("_clear") > 0, F.col("_onsets") / F.col("_clear")).alias("chemical_historical_onset_rate"),
        F.col("_clear").alias("n_prior_valid_transitions"),
        F.year("month").alias("year"), F.month("month").alias("month_of_year"),
        "label_onset_next_month",
    )
