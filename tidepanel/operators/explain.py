"""Facts about a scored row, a sentence from them, and audits of a text against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import percent, plural

#: Words of the numbers 0 to 20, in order: fixed values of the audits.
NUMBER_WORDS = [
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten",
    "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty",
]
#: What a fact holds, and what a text about it must hold, all of it: words, in lower case and whole.
SIGNATURES = [
    ("never on concession", ["never"]), ("came off concession", ["came off|last month"]), ("clear of concession", ["clear"]), ("previous episode", ["episodes?"]),
    ("onset rate", ["rate"]), ("above average", ["above", "average"]), ("below average", ["below", "average"]),
]
#: The contributions that facts are ranked by.
WEIGHTS = ["streak", "since", "episodes", "rate", "sin", "cos"]


def _fact(weight: Column, ordinal: int, text: Column) -> Column:
    return F.struct((-weight).alias("w"), F.lit(ordinal).alias("o"), text.alias("fact"))


def ranked_facts(weights: dict[str, Column], keep: int = 3) -> Column:
    """The `keep` weightiest of four facts of a row, ties in the order recency, episodes, rate, season.

    weights: the contribution of each of WEIGHTS. Streak and time since the last concession tell the same, so the larger of
    them is the weight of recency; the season weighs what its two halves do together, and their sum says whether it lies above
    the average. The columns of `history_features` are read.
    """
    streak = F.col("streak_length")
    recency = F.when(F.col("never_seen_on_concession"), "never on concession before").when(streak <= 1, "came off concession last month").otherwise(F.concat(F.lit("clear of concession for "), plural(streak, "month")))
    episodes = plural(F.col("n_previous_episodes"), "previous episode")
    n = F.col("n_prior_valid_transitions")
    rate = F.when(F.col("chemical_historical_onset_rate").isNull(), "no onset rate known").otherwise(F.concat(F.lit("onset rate "), percent(F.col("chemical_historical_onset_rate")), F.lit(" over "), plural(n, "month")))
    way = F.when(weights["sin"] + weights["cos"] > 0, "above").otherwise("below")
    season = F.concat(F.lit("onsets in "), F.date_format("month", "MMMM"), F.lit(" are "), way, F.lit(" average"))
    told = [
        (F.greatest(F.abs(weights["streak"]), F.abs(weights["since"])), recency), (F.abs(weights["episodes"]), episodes), (F.abs(weights["rate"]), rate),
        (F.abs(weights["sin"]) + F.abs(weights["cos"]), season),
    ]
    facts = F.array(*[_fact(w, i, t) for i, (w, t) in enumerate(told)])
    return F.transform(F.slice(F.array_sort(facts), 1, keep), lambda f: f["fact"])


def sentence(entity: Column, score: Column, facts: Column) -> Column:
    return F.concat(entity, F.lit(" has a "), percent(score), F.lit(" chance of onset next month: "), F.array_join(facts, "; "), F.lit("."))


def lost_percentages(facts: Column, text: Column) -> Column:
    """Percentages of the facts that the text does not hold as they are."""
    found = F.flatten(F.transform(facts, lambda f: F.regexp_extract_all(f, F.lit(r"\d+%"), F.lit(0))))
    return F.filter(found, lambda p: ~F.contains(text, p))


def lost_integers(facts: Column, text: Column) -> Column:
    """Other integers of the facts that the text holds neither in digits nor, up to 20, in words."""
    found = F.flatten(F.transform(facts, lambda f: F.regexp_extract_all(f, F.lit(r"\d+(?![\d%])"), F.lit(0))))
    words = F.array(*[F.lit(w) for w in NUMBER_WORDS])
    word = lambda i: F.when(F.length(i) <= 2, F.get(words, i.cast("int")))
    held = lambda i: F.contains(text, i) | F.coalesce(F.contains(F.lower(text), word(i)), F.lit(False))
    return F.filter(found, lambda i: ~held(i))


def lost_facts(facts: Column, text: Column) -> Column:
    """Facts of which the text lacks the words, the direction of the season included; the first signature that a fact has decides."""
    low = F.lower(text)

    def missing(fact: Column) -> Column:
        out = F.lit(False)
        for sign, needed in reversed(SIGNATURES):
            held = F.lit(True)
            for words in needed:
                held = held & low.rlike(rf"\b({words})\b")
            out = F.when(F.contains(fact, F.lit(sign)), ~held).otherwise(out)
        return out

    return F.filter(facts, missing)


def problems(facts: Column, text: Column) -> Column:
    return F.concat(lost_percentages(facts, text), lost_integers(facts, text), lost_facts(facts, text))


def explain_top(scored: DataFrame, entity: str, weights: dict[str, Column], n: int = 10) -> DataFrame:
    """scored with explanation and explanation_method; only the n best rows have them, the others are null."""
    top = scored.orderBy(F.col("score").desc_nulls_last(), entity).limit(n)
    told = top.select(F.col(entity).alias("_e"), F.col("month").alias("_m"), sentence(F.col(entity), F.col("score"), ranked_facts(weights)).alias("explanation")).withColumn("explanation_method", F.lit("template"))
    return scored.join(F.broadcast(told), (F.col(entity) == F.col("_e")) & (F.col("month") == F.col("_m")), "left").drop("_e", "_m")  # n rows


def latest_predictions(scores: DataFrame, entity: str, limit: int = 20) -> DataFrame:
    """The best rows of the latest month, scores rounded to 4 digits; null scores last."""
    latest = scores.agg(F.max("month").alias("_latest"))
    return scores.join(F.broadcast(latest), F.col("month") == F.col("_latest")).drop("_latest").orderBy(F.col("score").desc_nulls_last(), entity).limit(limit).withColumn("score", F.round("score", 4))


def entity_history(scores: DataFrame, entity: str, months: int = 12) -> DataFrame:
    """The last months of every entity in one pass; `rank` 1 is the latest."""
    w = Window.partitionBy(entity).orderBy(F.col("month").desc())
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= months)


def totals(scores: DataFrame, features: DataFrame) -> DataFrame:
    """One row: rows of both tables and the latest month of each."""
    a = scores.agg(F.count("*").alias("n_predictions"), F.max("month").alias("latest_prediction"))
    return a.crossJoin(F.broadcast(features.agg(F.count("*").alias("n_features"), F.max("month").alias("latest_features"))))  # one row each
