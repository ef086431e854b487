"""Walk-forward of all cutoffs together, seeded draws, and measures that read their input once."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import evaluate
from tidepanel.plans import model, walkforward

from .test_panel import M, planted, rows, scored

COLUMNS = ["time_since", "n_previous_episodes", "rate_filled", "month_sin"]


@pytest.fixture(scope="module")
def frame(spark):
    return model.model_frame(planted(spark)).cache()


def test_cutoffs_have_the_coefficients_of_single_fits(spark, frame):
    found = walkforward.fit_cutoffs(model.labelled(frame), COLUMNS, burn_in=12)
    assert found.months == M[12:28] and found.passes < 20
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    for i in (0, 7, 15):
        before = model.labelled(frame).where(F.col("month") < F.lit(found.months[i]))
        n, rate = before.agg(F.count("*"), F.avg("y")).first()
        assert found.fills[i] == pytest.approx(rate)
        plain = Pipeline(stages=[VectorAssembler(inputCols=COLUMNS, outputCol="_features"), model.logistic(n).setTol(1e-14)]).fit(model.filled(before, rate)).stages[1]
        assert np.allclose(found.weights[i], [plain.intercept, *plain.coefficients], atol=1e-6)


def test_scores_of_test_months(spark, frame):
    out = walkforward.walk_forward_logistic(frame, {"history": COLUMNS, "episodes": ["n_previous_episodes"]}, burn_in=12)
    assert [r[0] for r in rows(out.select("month").distinct(), "month")] == M[12:28]
    assert out.where("history IS NULL OR episodes IS NULL OR history NOT BETWEEN 0 AND 1").count() == 0
    found = walkforward.fit_cutoffs(model.labelled(frame), ["n_previous_episodes"], burn_in=12)
    for r in out.where(F.col("month") == F.lit(M[20])).collect():
        w = found.weights[8]
        assert r.episodes == pytest.approx(1 / (1 + math.exp(-w[0] - w[1] * r.n_previous_episodes)))
    summary = evaluate.summary(out, "history").first()
    assert summary.average_precision > 1.2 * summary.base_rate
    # No score knows its own month or a later one.
    early = walkforward.walk_forward_logistic(frame.where(F.col("month") < F.lit(M[22])), {"history": COLUMNS}, burn_in=12, drop_last=False)
    both = early.select("entity", "month", F.col("history").alias("h")).join(out, ["entity", "month"])
    assert both.count() > 0 and both.where("abs(h - history) > 1e-9").count() == 0


def test_months_without_a_fit(spark, frame):
    assert walkforward.walk_forward_logistic(frame, {"m": COLUMNS}, burn_in=40).count() == 0
    assert walkforward.walk_forward_logistic(frame.limit(0), {"m": COLUMNS}).count() == 0
    short = walkforward.fit_cutoffs(model.labelled(frame), COLUMNS, burn_in=1, drop_last=False, least=100)
    assert M[1] not in short.months and short.months[-1] == M[28]  # too few rows before the first
    one_label = walkforward.fit_cutoffs(model.labelled(frame).withColumn("y", F.lit(1.0)), COLUMNS)
    assert one_label.months == []


def test_seeded_draws_meet_the_expected_precision(spark):
    values = [(M[0], 0.5, float(i % 3 == 0), f"e{i}") for i in range(30)] + [(M[0], 0.9, 1.0, "best"), (M[1], 0.5, 1.0, "only")]
    df = spark.createDataFrame(values, "month date, score double, y double, entity string")
    draw = lambda seed: rows(evaluate.drawn_top_k(df, "score", "entity", seed, 5).select("month", "rank", "entity"), "month", "rank")
    assert draw(1) == draw(1) != draw(2)
    assert draw(1)[0][2] == "best" and len(draw(1)) == 6
    seeds = spark.range(200).withColumnRenamed("id", "seed")
    draws = F.md5(F.concat_ws(":", F.col("seed").cast("string"), F.col("month").cast("string"), "entity").cast("binary"))
    from pyspark.sql import Window

    each = df.crossJoin(F.broadcast(seeds)).withColumn("r", F.row_number().over(Window.partitionBy("seed", "month").orderBy(F.col("score").desc(), draws)))
    mean = each.where("r <= 5").groupBy("seed", "month").agg(F.avg("y").alias("p")).groupBy("month").agg(F.avg("p")).collect()
    expected = dict(rows(evaluate.precision_at_k(df, "score", 5), "month"))
    assert dict(map(tuple, mean))[M[0]] == pytest.approx(expected[M[0]], abs=0.04) and expected[M[1]] == 1
    one = dict(rows(evaluate.drawn_precision_at_k(df, "score", "entity", 7, 5), "month"))
    assert one[M[1]] == 1 and one[M[0]] in (0.2, 0.4, 0.6, 0.8, 1.0)


@pytest.mark.parametrize("measure", [evaluate.average_precision, evaluate.precision_at_k, evaluate.summary, evaluate.calibration])
def test_measures_read_their_input_once(spark, measure):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    df = scored(spark, [(M[i % 4], (i * 7 % 50) / 50, float(i % 3 == 0)) for i in range(200)]).mapInPandas(seen, "month date, score double, y double")
    measure(df, "score").collect()
    assert reads.value == 200
