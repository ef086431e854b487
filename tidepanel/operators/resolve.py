"""Names resolved to codes of a dimension, and volumes summed over the codes of a name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..sources.staging import written

OK, AMBIGUOUS, APPROXIMATE, NO_MATCH = "ok (prefix match)", "AMBIGUOUS", "APPROXIMATE", "no match"


#: Codes that one task compares with the names of a gram; a gram of more codes is split.
HOT_GRAM = 20_000
#: Lengths of grams. A name is looked for by grams of the greatest that it reaches, so by more than half of its own length.
SIZES = (1, 2, 4, 8, 16, 32, 64)


def _grams(text: Column, sizes: list[int]) -> Column:
    """Hashes of the distinct strings of so many characters in a text."""
    at = lambda n: F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.xxhash64(F.substring(text, i, F.lit(n))))).otherwise(F.array())
    return F.array_distinct(F.concat(*[at(n) for n in sizes]))


def _lower(text: str) -> Column:
    """What is compared: lower case, without white space at the ends."""
    return F.lower(strip(F.col(text)))


def meetings(asked: DataFrame, low: DataFrame, hot: int) -> DataFrame:
    """asked: name (distinct), _name; low: _row, _low -> name, _row of all pairs whose rarest gram of the name is in the other's text.

    Grams of a fixed length are shared by ever more codes as the dimension grows; these are as long as the name allows (SIZES), so
    what meets is close to what matches. They travel as hashes with the place of their code, without any text. Codes of a gram
    that more than `hot` of them hold are dealt to several parts, and the names that meet there go to each part; codes of a hot
    gram by which no name is looked for stay out.

    An explosion has many more bytes than Spark expects, so its joins are asked to sort and not to broadcast.
    """
    size = F.greatest(*[F.when(F.length("_name") >= n, n) for n in SIZES])
    sizes = sorted(r[0] for r in asked.select(size).distinct().collect()) or [SIZES[0]]  # at most len(SIZES)
    holders = low.select("_row", F.explode(_grams(F.col("_low"), sizes)).alias("_gram"))
    frequency = written(holders.groupBy("_gram").agg(F.count("*").alias("_n")))
    grams = asked.select("name", F.explode(F.coalesce(*[F.when(size == n, _grams(F.col("_name"), [n])) for n in sizes])).alias("_gram"))
    counted = grams.join(frequency.hint("merge"), "_gram", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    rarest = written(counted.groupBy("name").agg(F.min_by("_gram", "_n").alias("_gram"), F.min("_n").alias("_n")).where("_n > 0"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_n") / hot)).cast("int")
    wanted = rarest.where(F.col("_n") > hot).select("_gram", F.lit(True).alias("_wanted")).distinct()
    split = frequency.where(F.col("_n") > hot).join(wanted, "_gram", "left").select("_gram", F.when(F.col("_wanted"), parts).otherwise(0).alias("_parts"))
    # The table of hot grams has less than one row for `hot` rows of holders.
    dealt = holders.join(F.broadcast(split), "_gram", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1))).where("_parts > 0")
    dealt = dealt.select("_gram", F.pmod(F.xxhash64("_row"), "_parts").cast("int").alias("_part"), "_row")
    sought = rarest.select("name", "_gram", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    return sought.join(dealt.hint("merge"), ["_gram", "_part"]).select("name", "_row")


def name_matches(names: DataFrame, dimension: DataFrame, hot: int = HOT_GRAM) -> DataFrame:
    """names: name; dimension: code, code_name, section -> name, code, code_name, section, is_prefix of each code whose name holds the name.

    Both are compared in lower case without white space at their ends. A code name that holds a name holds all its grams, so
    the two meet on the rarest of them (`meetings`), and the pairs that meet are tested. A name that is empty or null has no match.
    """
    asked = written(names.select("name").distinct().withColumn("_name", _lower("name")).where(F.length("_name") > 0))
    low = dimension.select("code", "code_name", "section", _lower("code_name").alias("_low"), F.monotonically_increasing_id().alias("_row"))
    low = written(low.repartition("_row"))  # a small file of many rows would be exploded in one task
    met = meetings(asked, low, hot).join(low.hint("merge"), "_row").where(F.col("_low").contains(_lower("name")))
    return met.select("name", "code", "code_name", "section", F.col("_low").startswith(_lower("name")).alias("is_prefix"))


def resolve(names: DataFrame, dimension: DataFrame) -> DataFrame:
    return resolved(names, name_matches(names, dimension))


def resolved(names: DataFrame, found: DataFrame) -> DataFrame:
    """found: what `name_matches` gives for the names -> name, status, code, code_name, n_candidates for each distinct name.

    One prefix match is ok, several are ambiguous (no code); without one, a match inside is approximate (the lowest
    code); else there is none. `candidates` renders the matches.
    """
    best = found.groupBy("name").agg(
        F.count_if("is_prefix").alias("_prefix"), F.count("*").alias("_all"),
        F.min(F.when(F.col("is_prefix"), F.struct("code", "code_name"))).alias("_p"), F.min(F.struct("code", "code_name")).alias("_a"),
    )
    one = F.when(F.col("_prefix") == 1, F.col("_p")).when(F.coalesce("_prefix", F.lit(0)) == 0, F.col("_a"))
    status = F.when(F.col("_prefix") == 1, OK).when(F.col("_prefix") > 1, AMBIGUOUS).when(F.col("_all") > 0, APPROXIMATE).otherwise(NO_MATCH)
    n = F.when(F.col("_prefix") > 0, F.col("_prefix")).otherwise(F.coalesce("_all", F.lit(0)))
    return names.select("name").distinct().join(best, "name", "left").select("name", status.alias("status"), one["code"].alias("code"), one["code_name"].alias("code_name"), n.alias("n_candidates"))


def candidates(found: DataFrame) -> DataFrame:
    """name, all_candidates: `code=name (section)` in order of code, of the prefix matches where there are several, else of all matches."""
    text = F.concat(F.col("code"), F.lit("="), F.col("code_name"), F.lit(" ("), F.col("section"), F.lit(")"))
    listed = found.groupBy("name").agg(F.count_if("is_prefix").alias("_n"), F.sort_array(F.collect_list(F.struct("code", text.alias("t"), "is_prefix"))).alias("_c"))
    shown = F.filter("_c", lambda c: c["is_prefix"] | (F.col("_n") < 2))
    return listed.select("name", F.array_join(F.transform(shown, lambda c: c["t"]), "; ").alias("all_candidates"))


def tally(resolved: DataFrame) -> DataFrame:
    return resolved.agg(*[F.count_if(F.col("status") == s).alias(k) for k, s in (("n_ok", OK), ("n_ambiguous", AMBIGUOUS), ("n_approximate", APPROXIMATE), ("n_failed", NO_MATCH))])


def known_answers(resolved: DataFrame, expected: DataFrame) -> DataFrame:
    """expected: name, expected_code -> name, code, expected_code, correct; null answers are compared too."""
    return expected.join(resolved.select("name", "code"), "name", "left").withColumn("correct", F.col("code").eqNullSafe(F.col("expected_code")))


def codes_of(resolved: DataFrame, code_pattern: str = "([A-Za-z0-9]{9})=") -> DataFrame:
    """resolved: name, code, all_candidates -> name, code: its own, or each that its candidates name, repeats kept."""
    listed = F.regexp_extract_all("all_candidates", F.lit(code_pattern), F.lit(1))
    return resolved.select("name", F.explode(F.when(F.col("code").isNotNull(), F.array("code")).otherwise(listed)).alias("code"))


def matched_codes(resolved: DataFrame, found: DataFrame) -> DataFrame:
    """resolved: name, status, code; found: what `name_matches` gives -> name, code: its own, or each that its candidates name, repeats kept.

    As `codes_of` the text of `candidates`, which is one value for a name however many codes it has; here each is a row.
    """
    several = resolved.where(F.col("code").isNull() & (F.col("status") != NO_MATCH)).select("name", "status")
    listed = found.where(F.col("code").isNotNull() & F.col("section").isNotNull()).join(several, "name").where(F.col("is_prefix") | (F.col("status") != AMBIGUOUS))
    return resolved.where(F.col("code").isNotNull()).select("name", "code").unionByName(listed.select("name", "code"))


def volume_over_codes(codes: DataFrame, series: DataFrame, failed: DataFrame) -> DataFrame:
    """name, month, total_items, n_codes_summed, n_codes_failed; the counts are of the name, on each of its months.

    A code listed twice is summed and counted twice. Codes in `failed` have no series; a code with an empty series is
    in neither count.
    """
    with_data = series.select("code").distinct().withColumn("_has", F.lit(True))
    lost = failed.select("code").distinct().withColumn("_lost", F.lit(True))
    counts = codes.join(with_data, "code", "left").join(lost, "code", "left").groupBy("name").agg(F.count("_has").alias("n_codes_summed"), F.count_if(F.col("_lost") & F.col("_has").isNull()).alias("n_codes_failed"))
    sums = codes.join(series, "code").groupBy("name", "month").agg(F.sum("items").alias("total_items"))
    return sums.join(counts, "name")


def partial_names(volume: DataFrame) -> DataFrame:
    """Names of which a code failed, with both counts; all of them."""
    return volume.where("n_codes_failed > 0").select("name", "n_codes_summed", "n_codes_failed").distinct()
