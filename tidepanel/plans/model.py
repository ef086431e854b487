"""Model frames, training, scoring and walk-forward evaluation with MLlib."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..operators.evaluate import baselines
from ..sources.staging import written

#: Stands for "never on" in the model frame.
NEVER = 999
HISTORY = ["streak_length", "time_since", "n_previous_episodes", "n_prior_valid_transitions", "month_sin", "month_cos", "rate_filled"]
WITH_VOLUME = [*HISTORY, "growth_filled", "log_items_epd"]
WITH_CONCENTRATION = [*HISTORY, "log_items_epd", "log_practices_epd", "hhi_epd"]


def model_frame(features: DataFrame) -> DataFrame:
    """Adds y (the label, null where there is none) and the derived columns that need no fitted value; training and scoring share it."""
    angle = 2 * F.pi() * F.month("month") / 12
    return features.withColumns({
        "y": F.col("label_onset_next_month"), "time_since": F.coalesce("time_since_last_concession", F.lit(NEVER)).cast("double"),
        "month_sin": F.sin(angle), "month_cos": F.cos(angle),
    })


def labelled(frame: DataFrame) -> DataFrame:
    return frame.where("y IS NOT NULL")


def at_risk(frame: DataFrame, month: Column | None = None) -> DataFrame:
    """Rows that are clear in a month, the latest one by default."""
    clear = frame.where(~F.col("on_concession"))
    if month is not None:
        return clear.where(F.col("month") == month)
    latest = frame.agg(F.max("month").alias("_latest"))
    return clear.join(F.broadcast(latest), F.col("month") == F.col("_latest")).drop("_latest")  # one row


def filled(frame: DataFrame, rate: float) -> DataFrame:
    """Fills the onset rate with the training rows' mean label, and shows an infinite growth as a large one."""
    out = frame.withColumn("rate_filled", F.coalesce("chemical_historical_onset_rate", F.lit(float(rate))))
    if "items_mom_growth_epd" in frame.columns:
        growth = F.col("items_mom_growth_epd")
        out = out.withColumn("growth_filled", F.when(F.abs(growth) == float("inf"), F.signum(growth) * 1e6).otherwise(growth))
    return out


@dataclass
class Bundle:
    """A fitted model with what scoring needs."""

    model: PipelineModel
    columns: list[str]
    fallback_rate: float
    n_rows: int
    n_onsets: int
    trained_through: object

    def score(self, frame: DataFrame, name: str = "score") -> DataFrame:
        scored = self.model.transform(filled(frame, self.fallback_rate))
        return scored.withColumn(name, vector_to_array("probability")[1]).drop("_features", "rawPrediction", "probability", "prediction")


def trees(rounds: int = 100, depth: int = 3, rate: float = 0.1, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(featuresCol="_features", labelCol="y", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed)


def logistic(n: int) -> LogisticRegression:
    """The L2 penalty with C = 1 on the sum of n losses."""
    return LogisticRegression(featuresCol="_features", labelCol="y", maxIter=1000, regParam=1.0 / max(1, n), elasticNetParam=0.0, standardization=False)


def train(frame: DataFrame, columns: list[str], learner: Callable[[int], object] = lambda n: trees()) -> Bundle:
    """Fits on the labelled rows of a frame, which are written once."""
    rows = written(labelled(frame))
    n, onsets, rate, last = rows.agg(F.count("*"), F.sum("y"), F.avg("y"), F.max("month")).first()
    fitted = Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="_features"), learner(n)]).fit(filled(rows, rate))
    for stage in fitted.stages:
        if getattr(stage, "hasSummary", False):  # it holds on to the session, which can't be sent to executors once rows were observed
            stage._java_obj.setSummary(frame.sparkSession._jvm.scala.Option.empty())
    return Bundle(fitted, columns, rate, n, int(onsets), last)


def walk_forward(frame: DataFrame, models: dict[str, tuple[list[str], Callable[[int], object]]], burn_in: int = 12, drop_last: bool = True, least: int = 50, threads: int = 4) -> DataFrame:
    """The test months' rows with the two baselines' rates and a score of each model, fitted on the months before.

    The fill value is that of each cutoff's training rows. Months with fewer than `least` training rows, or of one label
    only, are skipped. Fits are submitted from a few driver threads; each runs on the cluster.
    """
    rows = labelled(frame).persist(StorageLevel.DISK_ONLY_2)
    monthly = [tuple(r) for r in rows.groupBy("month").agg(F.count("*"), F.sum("y")).orderBy("month").collect()]
    tested = baselines(rows, burn_in, drop_last).persist(StorageLevel.DISK_ONLY_2)

    def at(i: int) -> DataFrame | None:
        month, n, s = monthly[i][0], sum(m[1] for m in monthly[:i]), sum(m[2] for m in monthly[:i])
        if n < least or s in (0, n):
            return None
        before, test = rows.where(F.col("month") < F.lit(month)), tested.where(F.col("month") == F.lit(month))
        for name, (columns, learner) in models.items():
            test = train(before, columns, learner).score(test, name).drop("rate_filled", "growth_filled")
        return test

    with ThreadPoolExecutor(threads) as pool:
        parts = [p for p in pool.map(at, range(burn_in, len(monthly) - int(drop_last))) if p is not None]
    if not parts:
        raise ValueError("there are too few months to test")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def contributions(bundle: Bundle, rows: DataFrame, training: DataFrame, key: list[str]) -> DataFrame:
    """key, and for each feature its exact Shapley value against the training mean: they add up to the row's log-odds less the mean row's.

    Each row becomes 2^features variants, of which each takes some features from the mean row; one transform scores
    them all. For the few rows to explain.
    """
    columns = bundle.columns
    mean = filled(labelled(training), bundle.fallback_rate).agg(*[F.avg(c).alias(f"_mean_{c}") for c in columns])
    subsets = F.array(*[F.array(*[F.lit(bool(b)) for b in bits]) for bits in product((0, 1), repeat=len(columns))])
    wide = filled(rows, bundle.fallback_rate).crossJoin(F.broadcast(mean))  # one row of means
    variants = wide.select(*key, F.explode(subsets).alias("_s"), *columns, *[f"_mean_{c}" for c in columns])
    variants = variants.select(*key, "_s", *[F.when(F.col("_s")[i], F.col(c)).otherwise(F.col(f"_mean_{c}")).alias(c) for i, c in enumerate(columns)])
    p = F.greatest(F.least(vector_to_array("probability")[1], F.lit(1 - 1e-12)), F.lit(1e-12))
    scored = bundle.model.transform(variants).withColumn("_odds", F.log(p / (1 - p)))
    size = F.aggregate("_s", F.lit(0), lambda a, b: a + b.cast("int"))
    n = len(columns)
    # A subset of size k with the feature weighs (k - 1)! (n - k)! / n!, one of size k without it k! (n - k - 1)! / n!.
    fact = [1.0]
    for i in range(1, n + 1):
        fact.append(fact[-1] * i)
    with_it = F.element_at(F.array(*[F.lit(fact[max(k - 1, 0)] * fact[n - k] / fact[n]) for k in range(n + 1)]), size + 1)
    without = F.element_at(F.array(*[F.lit(fact[k] * fact[max(n - k - 1, 0)] / fact[n]) for k in range(n + 1)]), size + 1)
    return scored.groupBy(*key).agg(*[F.sum(F.when(F.col("_s")[i], with_it * F.col("_odds")).otherwise(-without * F.col("_odds"))).alias(c) for i, c in enumerate(columns)])


@dataclass
class Leaves:
    """The leaves of boosted trees: their log-odds, and for each feature the bounds of their rows, above `low` and up to `high`."""

    odds: np.ndarray
    low: np.ndarray
    high: np.ndarray


def leaves(bundle: Bundle) -> Leaves:
    """Every path from a root to a leaf; their number is bounded by the model's rounds and depth, whatever the data."""
    forest, width, found = bundle.model.stages[-1], len(bundle.columns), []
    for weight, tree in zip(forest.treeWeights, forest.trees):
        open_ = [(tree._java_obj.rootNode(), np.full(width, -np.inf), np.full(width, np.inf))]
        while open_:
            node, low, high = open_.pop()
            if node.getClass().getSimpleName() == "LeafNode":
                found.append((2 * weight * node.prediction(), low, high))  # the loss takes twice the sum of the trees for the log-odds
                continue
            feature, at = node.split().featureIndex(), node.split().threshold()
            below, above = high.copy(), low.copy()
            below[feature], above[feature] = min(high[feature], at), max(low[feature], at)
            open_ += [(node.leftChild(), low, below), (node.rightChild(), above, high)]
    return Leaves(*(np.array(part) for part in zip(*found)))


def path_shares(table: Leaves, rows: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Exact Shapley values of each row's features against the mean row, in log-odds, a leaf at a time.

    A subset of the features reaches a leaf when it has all a features whose bounds hold for the row alone and none of the b
    whose bounds hold for the mean alone; so each of the first adds (a - 1)! b! / (a + b)! of the leaf, and each of the others
    takes a! (b - 1)! / (a + b)! of it.
    """

    def inside(x: np.ndarray) -> np.ndarray:
        at = x[..., None, :]
        return ((at <= table.high) | np.isposinf(table.high)) & (~(at <= table.low) | np.isneginf(table.low))

    fact = np.array([float(factorial(i)) for i in range(len(mean) + 1)])
    own, other = inside(rows), inside(mean)
    mine, theirs = own & ~other, ~own & other
    a, b = mine.sum(axis=-1), theirs.sum(axis=-1)
    odds = table.odds * (own | other).all(axis=-1) / fact[a + b]
    adds, takes = odds * fact[np.maximum(a - 1, 0)] * fact[b], odds * fact[a] * fact[np.maximum(b - 1, 0)]
    return np.einsum("nlf,nl->nf", mine, adds) - np.einsum("nlf,nl->nf", theirs, takes)


def tree_contributions(bundle: Bundle, rows: DataFrame, training: DataFrame, key: list[str], block: int = 500) -> DataFrame:
    """`contributions` of boosted trees, for any number of rows: a pass over the rows, with the trees' leaves at hand.

    The time a row takes grows with the leaves and the features, not with the features' subsets.
    """
    columns, table = bundle.columns, leaves(bundle)
    mean = np.array(filled(labelled(training), bundle.fallback_rate).agg(*[F.avg(c) for c in columns]).first(), np.float64)
    asked = filled(rows, bundle.fallback_rate).select(*key, *[F.col(c).cast("double").alias(c) for c in columns])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns]).astype(np.float64)
            got = np.concatenate([np.empty((0, len(columns))), *[path_shares(table, x[i : i + block], mean) for i in range(0, len(x), block)]])
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in key], *[pa.array(got[:, i]) for i in range(len(columns))]], names=[*key, *columns])

    return asked.mapInArrow(share, asked.schema)


def facts_weights(frame: DataFrame) -> DataFrame:
    """Simple weights for facts where no model is asked: distances of the features from their mean over the month.

    Means are one row a month, so a month's entities never meet in one task.
    """
    names = {"streak": "streak_length", "since": "time_since", "episodes": "n_previous_episodes", "rate": "chemical_historical_onset_rate", "sin": "month_sin", "cos": "month_cos"}
    means = frame.groupBy(F.col("month").alias("_m")).agg(*[F.avg(c).alias(f"_mean_{k}") for k, c in names.items()])
    out = frame.join(F.broadcast(means), F.col("month") == F.col("_m"))
    return out.withColumns({f"_w_{k}": F.coalesce(F.col(c) - F.col(f"_mean_{k}"), F.lit(0.0)) for k, c in names.items()}).drop("_m", *[f"_mean_{k}" for k in names])
