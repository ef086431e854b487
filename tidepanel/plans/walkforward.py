"""Walk-forward of a logistic model: the fits of all cutoffs advance together, one pass over the rows a step.

A pass gives every cutoff the loss, gradient and Hessian of the rows before it. Each task adds up its rows' shares, a shuffle
adds the tasks', and the driver solves one small Newton system for each cutoff. So the number of jobs is that of the Newton
steps, whatever the number of months, and no row is copied to the cutoffs after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import baselines
from ..sources.staging import written
from .model import filled, labelled

STEPS, CLOSE = 60, 1e-10
#: Stands in the feature lists for the onset rate, filled with the mean label of the cutoff's own training rows.
RATE = "rate_filled"


@dataclass
class Cutoffs:
    """For each test month that can be fitted: the fill value, and the intercept followed by a weight for each column."""

    months: list[dt.date]
    fills: np.ndarray
    weights: np.ndarray
    passes: int


def _design(rows: DataFrame, columns: list[str]) -> DataFrame:
    """day (of the month, since the epoch), y and the columns as doubles; an unknown onset rate is null, other nulls are not allowed."""
    shown = filled(rows, 0.0).drop(RATE).withColumn(RATE, F.col("chemical_historical_onset_rate"))
    return shown.select(F.unix_date("month").alias("day"), F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])


def _shares(design: DataFrame, columns: list[str], days: np.ndarray, fills: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each cutoff, over the rows before it: the loss, its gradient and its Hessian, one after another."""
    k, p = weights.shape
    names, rate = [f"x{i}" for i in range(len(columns))], columns.index(RATE) if RATE in columns else None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 1 + p + p * p))
        for batch in batches:
            day, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("day", "y"))
            x = np.column_stack([np.ones(len(day)), *[batch.column(c).to_numpy(zero_copy_only=False) for c in names]])
            order = np.argsort(day, kind="stable")
            day, y, x = day[order], y[order], x[order]
            unknown = np.isnan(x[:, 1 + rate]) if rate is not None else None
            for c, (before, fill, w) in enumerate(zip(np.searchsorted(day, days), fills, weights)):
                a, b = x[:before].copy(), y[:before]
                if rate is not None:
                    a[unknown[:before], 1 + rate] = fill
                z = a @ w
                q = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                total[c, 0] += (np.logaddexp(0, z) - b * z).sum()
                total[c, 1 : 1 + p] += (q - b) @ a
                total[c, 1 + p :] += ((a * (q * (1 - q))[:, None]).T @ a).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["place", "v"])

    found = design.mapInArrow(add, "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).orderBy("place").collect()
    return np.array([r["v"] for r in found]).reshape(k, 1 + p + p * p)


def fit_cutoffs(rows: DataFrame, columns: list[str], burn_in: int = 12, drop_last: bool = True, least: int = 50, penalty: float = 1.0) -> Cutoffs:
    """Logistic fits with half the squared weights (not the intercept) times the penalty, on the labelled rows before each test month.

    Test months with fewer than `least` rows before them, or rows of one label only, have no fit. Newton steps that raise a
    cutoff's loss are halved.
    """
    monthly = [tuple(r) for r in rows.groupBy("month").agg(F.count("*"), F.sum("y")).orderBy("month").collect()]  # a row a month
    ends, n, ones = [], 0, 0.0
    for i, (month, count, hits) in enumerate(monthly):
        if burn_in <= i < len(monthly) - int(drop_last) and n >= least and 0 < ones < n:
            ends.append((month, ones / n))
        n, ones = n + count, ones + hits
    months, fills, p = [m for m, _ in ends], np.array([r for _, r in ends]), 1 + len(columns)
    weights = np.zeros((len(ends), p))
    if not ends:
        return Cutoffs(months, fills, weights, 0)
    weights[:, 0] = np.log(fills / (1 - fills))
    design, days = written(_design(rows, columns)), np.array([(m - dt.date(1970, 1, 1)).days for m in months])
    ridge = penalty * np.r_[0.0, np.ones(p - 1)]
    going, accepted, last, step = np.arange(len(ends)), weights.copy(), np.full(len(ends), np.inf), np.zeros_like(weights)
    for passes in range(1, STEPS + 1):
        found = _shares(design, columns, days[going], fills[going], weights[going])
        still = []
        for c, share in zip(going, found):
            w = weights[c]
            loss = share[0] + 0.5 * float(ridge @ (w * w))
            if loss > last[c] + 1e-9 * abs(last[c]):
                step[c] /= 2
                weights[c] = accepted[c] + step[c]
                still.append(c)
                continue
            accepted[c], last[c] = w, loss
            gradient, hessian = share[1 : 1 + p] + ridge * w, share[1 + p :].reshape(p, p) + np.diag(ridge)
            scale = 1 / np.sqrt(np.maximum(np.diag(hessian), 1e-300))
            step[c] = -scale * np.linalg.solve(hessian * np.outer(scale, scale), scale * gradient)
            weights[c] = w + step[c]
            if np.abs(step[c] / scale).max() > CLOSE * np.sqrt(1 + abs(loss)):
                still.append(c)
        going = np.array(still, np.int64)
        if not len(going):
            return Cutoffs(months, fills, weights, passes)
    raise ArithmeticError(f"{len(going)} of {len(ends)} cutoffs did not converge in {STEPS} steps")


def walk_forward_logistic(frame: DataFrame, models: dict[str, list[str]], burn_in: int = 12, drop_last: bool = True, least: int = 50, penalty: float = 1.0) -> DataFrame:
    """The test months' rows with both baselines' rates and, for each model (a name and its columns), a score fitted on the months before.

    Rows of test months without a fit are left out. A column that is null makes a row's score null; rows to fit must have
    all columns but the onset rate. A frame without test months gives an empty result.
    """
    rows = written(labelled(frame))
    out = baselines(rows, burn_in, drop_last)
    spark = frame.sparkSession
    for name, columns in models.items():
        found = fit_cutoffs(rows, columns, burn_in, drop_last, least, penalty)
        table = spark.createDataFrame([(m, float(f), [float(x) for x in w]) for m, f, w in zip(found.months, found.fills, found.weights)], "month date, _fill double, _w array<double>")
        joined = filled(out.join(F.broadcast(table), "month"), 0.0)  # a row for each test month
        joined = joined.withColumn(RATE, F.coalesce("chemical_historical_onset_rate", "_fill"))
        odds = F.col("_w")[0]
        for i, c in enumerate(columns):
            odds = odds + F.col("_w")[i + 1] * F.col(c)
        out = joined.withColumn(name, 1 / (1 + F.exp(-odds))).drop("_fill", "_w", RATE, "growth_filled")
    return out
