"""The panel library on small tables whose answers are known."""

import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from tidepanel.functions import months, text
from tidepanel.operators import concentration, evaluate, explain, history, lagjoin, panel, quality, resolve, upsert
from tidepanel.plans import model
from tidepanel.sources import landing, pages, tables
from tidepanel.streaming import increment

M = [dt.date(2020 + i // 12, i % 12 + 1, 1) for i in range(36)]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def facts(spark, values):
    return spark.createDataFrame(values, "code string, name string, month date, practice string, items double")


def test_volume_null_practice_and_zero_total(spark):
    f = facts(spark, [("a", "A", M[0], "p", 100.0), ("a", "A", M[0], "p", 50.0), ("a", "A", M[0], "q", 150.0), ("a", "A", M[0], None, 30.0), ("z", "Z", M[0], "p", 0.0), ("n", "N", M[0], "p", None)])
    got = {r.code: r for r in concentration.volume_and_concentration(f).collect()}
    assert got["a"].total_items == 330 and got["a"].n_distinct_practices == 2
    assert got["a"].hhi == pytest.approx((150**2 * 2 + 30**2) / 330**2)
    assert got["z"].hhi is None and got["n"].hhi is None
    assert concentration.volume_and_concentration(facts(spark, [])).count() == 0


def test_month_and_name_functions(spark):
    d = spark.createDataFrame([("2020-03",), ("202003",), ("2020-03-15",), ("x",)], "s string")
    assert [r[0] for r in d.select(months.parse_month(F.col("s"))).collect()] == [M[2], M[2], M[2], None]
    n = spark.createDataFrame([("Aspirin - 75mg tabs",), ("\tOil \n",), ("5mg",), ("B-12 x",)], "s string")
    assert [r[0] for r in n.select(text.chemical_name(F.col("s"))).collect()] == ["Aspirin", "Oil", "", "B"]
    p = spark.createDataFrame([(0.125,), (0.135,)], "x double")
    assert [r[0] for r in p.select(text.percent(F.col("x"))).collect()] == ["12%", "14%"]


def state_panel(spark, states, entity="e"):
    return spark.createDataFrame([(entity, M[i], s == "1") for i, s in enumerate(states)], "entity string, month date, on_concession boolean")


def test_history_by_hand(spark):
    got = rows(history.history_features(state_panel(spark, "00110100"), "entity"), "month")
    names = history.history_features(state_panel(spark, "0"), "entity").columns
    col = lambda n: [r[names.index(n)] for r in got]
    assert col("streak_length") == [1, 2, 1, 2, 1, 1, 1, 2]
    assert col("time_since_last_concession") == [None, None, 0, 0, 1, 0, 1, 2]
    assert col("n_previous_episodes") == [0, 0, 1, 1, 1, 2, 2, 2]
    assert col("n_prior_valid_transitions") == [0, 1, 2, 2, 2, 3, 3, 4]
    assert col("chemical_historical_onset_rate") == [None, 0, 0.5, 0.5, 0.5, pytest.approx(2 / 3), pytest.approx(2 / 3), 0.5]
    assert col("label_onset_next_month") == [0, 1, None, None, 1, None, 0, None]


def test_features_do_not_know_the_future(spark):
    states = "0010110010011"
    whole = rows(history.history_features(state_panel(spark, states), "entity").drop("label_onset_next_month"), "month")
    for n in (4, 9):
        assert rows(history.history_features(state_panel(spark, states[:n]), "entity").drop("label_onset_next_month"), "month") == whole[:n]


def test_dense_panel_and_names(spark):
    ev = spark.createDataFrame([("p", "old", M[0]), ("p", "new", M[3]), ("p", "other", M[3]), ("q", "x", M[1]), ("q", "x", M[1])], "pack string, chemical string, month date")
    assert rows(panel.canonical_names(ev), "pack") == [("p", "other"), ("q", "x")]
    assert rows(panel.names_per_pack(ev), "pack") == [("p", 3)]
    dense = panel.dense_panel(ev, "pack")
    assert dense.count() == 8 and dense.where("on_concession").count() == 3
    lost = panel.attach_names(ev, panel.canonical_names(ev.where("pack = 'p'")))
    assert panel.unmapped(lost).count() == 2
    with pytest.raises(quality.GateError):
        quality.enforce(panel.unmapped(lost), "no unmapped pack")
    assert panel.dense_panel(ev.limit(0), "pack").count() == 0


def test_growth_gaps_and_lag(spark):
    s = spark.createDataFrame([("a", M[0], 0.0), ("a", M[1], 5.0), ("a", M[3], 10.0), ("b", M[0], 0.0), ("b", M[1], 0.0)], "k string, month date, total_items double")
    got = {(r.k, r.month): r.items_mom_growth for r in lagjoin.series_features(s, "k").collect()}
    assert got[("a", M[1])] == math.inf and got[("a", M[3])] == 1 and got[("b", M[1])] is None and got[("a", M[0])] is None
    assert lagjoin.series_features(s, "k", keep_inf=False).where("k = 'a'").orderBy("month").collect()[1].items_mom_growth is None
    f = spark.createDataFrame([("a", m, 1.0) for m in M[1:6]], "k string, month date, label_onset_next_month double")
    joined = lagjoin.lagged_join(f, lagjoin.series_features(s, "k"), "k")
    assert [r.total_items_epd for r in joined.orderBy("month").collect()] == [None, 0, 5, None, 10]
    assert lagjoin.fair_set(joined, ["items_mom_growth_epd"]).count() == 2  # +inf is a value
    assert lagjoin.coverage(joined, "total_items_epd").first().coverage == 0.6


def scored(spark, values):
    return spark.createDataFrame(values, "month date, score double, y double")


def test_measures_against_brute_force(spark):
    import random

    rng = random.Random(3)
    values = [(M[rng.randrange(4)], round(rng.random(), 1), float(rng.random() < 0.3)) for _ in range(400)]
    df = scored(spark, values)
    total, ap, seen, hits = sum(v[2] for v in values), 0.0, 0, 0.0
    for s in sorted({v[1] for v in values}, reverse=True):
        here = [v[2] for v in values if v[1] == s]
        seen, hits = seen + len(here), hits + sum(here)
        ap += sum(here) / total * hits / seen
    assert evaluate.average_precision(df, "score").first()[0] == pytest.approx(ap)
    assert evaluate.average_precision(df, "score").first()[0] == evaluate.average_precision(df, "score").first()[0]
    for month, p in rows(evaluate.precision_at_k(df, "score", 7), "month"):
        mine = sorted((v for v in values if v[0] == month), key=lambda v: -v[1])
        edge = mine[6][1]
        above, tied = [v[2] for v in mine if v[1] > edge], [v[2] for v in mine if v[1] == edge]
        assert p == pytest.approx((sum(above) + (7 - len(above)) * sum(tied) / len(tied)) / 7)
    import numpy as np

    at = [0.1, 0.33, 0.5, 0.9]
    assert evaluate.quantiles(df, "score", at) == pytest.approx(list(np.quantile([v[1] for v in values], at)))
    assert evaluate.calibration(df, "score").agg(F.sum("n")).first()[0] == 400
    assert rows(evaluate.precision_at_k(scored(spark, [(M[0], 0.5, 1.0)]), "score"), "month") == [(M[0], 1.0)]


def test_baselines_are_strictly_prior(spark):
    df = scored(spark, [(m, 0.0, float(i % 3 == 0)) for i, m in enumerate(M[:26])])
    got = {r.month: r for r in evaluate.baselines(df, burn_in=12).collect()}
    assert min(got) == M[12] and max(got) == M[24]
    assert evaluate.baselines(df, burn_in=2, drop_last=False).agg(F.max("month")).first()[0] == M[25]
    assert got[M[13]].base_rate == pytest.approx(5 / 13) and got[M[13]].seasonal_rate == 0.0
    assert got[M[24]].seasonal_rate == 1.0


def test_upsert_policies(spark):
    keys = ["k", "month"]
    state = spark.createDataFrame([("a", "1", 1.0, "t"), ("b", "1", 2.0, "t")], "k string, month string, x double, told string")
    batch = spark.createDataFrame([("a", "1", 9.0, None), ("c", "1", 3.0, "n")], "k string, month string, x double, told string")
    assert rows(upsert.upsert(state, batch, keys, ["x"]), "k") == [("a", "1", 9.0, "t"), ("b", "1", 2.0, "t"), ("c", "1", 3.0, "n")]
    assert rows(upsert.upsert(state, batch, keys, ["x", "told"]), "k")[0] == ("a", "1", 9.0, None)
    with pytest.raises(quality.GateError):
        upsert.upsert(state, batch.unionByName(batch), keys, ["x"])


def test_upsert_touches_the_batch_months_only(spark, tmp_path):
    table, staging = str(tmp_path / "t"), str(tmp_path / "s")
    landing.write_months(spark.createDataFrame([("a", "202001", 1.0), ("a", "202002", 1.0)], "k string, month string, x double"), table)
    before = sorted(p.name for p in (tmp_path / "t" / "month=202001").glob("*.parquet"))
    batch = spark.createDataFrame([("a", "202002", 5.0), ("b", "202002", 6.0)], "k string, month string, x double")
    assert upsert.upsert_months(spark, table, staging, batch, ["k", "month"], ["x"]) == ["202002"]
    got = spark.read.parquet(table).select("k", F.col("month").cast("string"), "x")
    assert rows(got, "month", "k") == [("a", "202001", 1.0), ("a", "202002", 5.0), ("b", "202002", 6.0)]
    assert sorted(p.name for p in (tmp_path / "t" / "month=202001").glob("*.parquet")) == before


def test_increment_lands_once_and_stops_on_a_wrong_month(spark, tmp_path):
    table, audit = str(tmp_path / "t"), str(tmp_path / "audit")
    batch = lambda m: spark.createDataFrame([(f"{m[:4]}-{m[4:]}", float(i)) for i in range(5)], "ym string, x double")
    assert increment.process_months(spark, ["202001", "202002"], batch, "ym", table, audit) == ["202001", "202002"]
    assert increment.process_months(spark, ["202001", "202002"], batch, "ym", table, audit) == []
    assert spark.read.parquet(audit).where("verified").count() == 2 and spark.read.parquet(table).count() == 10
    with pytest.raises(quality.GateError):
        increment.process_months(spark, ["202003"], lambda m: batch("202001"), "ym", table, audit)
    assert spark.read.parquet(table).count() == 10


def test_a_stream_gives_new_files_once(spark, tmp_path):
    src, out, done = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    df = spark.createDataFrame([("a", "202001")], "k string, month string")
    df.write.mode("append").parquet(src)
    run = lambda: increment.stream_months(spark, src, df.schema, done, lambda b: landing.append(b, out)).awaitTermination(60)
    run(), run()
    assert spark.read.parquet(out).count() == 1


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("EXTRA,CODE,ITEMS\nx,c1,1\n")
    (tmp_path / "b.csv").write_text("ITEMS,CODE\n2,c2\nbad,c3\n")
    got = tables.csv_columns(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ["CODE", "ITEMS"])
    assert rows(got, "CODE") == [("c1", "1"), ("c2", "2"), ("c3", "bad")]
    good, bad = tables.typed(got, "ITEMS", quarantine=True)
    assert good.agg(F.sum("ITEMS")).first()[0] == 3 and bad.count() == 1
    with pytest.raises(ValueError):
        tables.csv_columns(spark, str(tmp_path / "b.csv"), ["EXTRA"])
    landing.write_months(spark.createDataFrame([(1, "202001")], "x int, month string"), str(tmp_path / "t"))
    assert tables.month_of(spark, str(tmp_path / "t"), "202001").count() == 1
    with pytest.raises(FileNotFoundError):
        tables.month_of(spark, str(tmp_path / "t"), "202002")


def test_exports_and_evolved_tables(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "x int")
    landing.export_csv(one, str(tmp_path / "c"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "c")), "x") == [("1",)]
    landing.append(one, str(tmp_path / "p"))
    landing.append(one.withColumn("told", F.lit("t")), str(tmp_path / "p"))
    assert landing.read_evolved(spark, str(tmp_path / "p")).where("told IS NULL").count() == 1


def test_resolver(spark):
    dim = spark.createDataFrame([("000000001", "Dexamfetamine", "s"), ("000000002", "Lisdexamfetamine", "s"), ("000000003", "Iron salts", "s"), ("000000004", "Iron sucrose", "t"), ("000000005", "Oil", "s")], "code string, code_name string, section string")
    names = spark.createDataFrame([(n,) for n in ("dexamfetamine", "Iron s", "sucrose", "nothing", "i", "il", "")], "name string")
    got = {r.name: r for r in resolve.resolve(names, dim).collect()}
    assert (got["dexamfetamine"].status, got["dexamfetamine"].code) == (resolve.OK, "000000001")
    assert (got["Iron s"].status, got["Iron s"].n_candidates, got["Iron s"].code) == (resolve.AMBIGUOUS, 2, None)
    assert (got["sucrose"].status, got["sucrose"].code) == (resolve.APPROXIMATE, "000000004")
    assert got["nothing"].status == resolve.NO_MATCH == got[""].status
    assert got["i"].status == resolve.AMBIGUOUS and got["il"].status == resolve.APPROXIMATE
    listed = resolve.candidates(resolve.name_matches(names, dim))
    assert {r.name: r.all_candidates for r in listed.collect()}["Iron s"] == "000000003=Iron salts (s); 000000004=Iron sucrose (t)"
    assert {r.name: r.all_candidates for r in listed.collect()}["dexamfetamine"] == "000000001=Dexamfetamine (s); 000000002=Lisdexamfetamine (s)"
    codes = resolve.codes_of(resolve.resolve(names, dim).join(listed, "name", "left").where("name IN ('Iron s', 'sucrose')"))
    assert rows(codes, "name", "code") == [("Iron s", "000000003"), ("Iron s", "000000004"), ("sucrose", "000000004")]


def test_resolver_against_all_pairs(spark):
    """Odd names over a dimension in which some grams are hot and split; white space at the ends counts for nothing."""
    import random

    rng = random.Random(6)
    syllables = ["ac", "ic", "lo", "vir", " ", "so", "dium", "ox", "e"]
    dim = [(f"{i:09d}", ("  " if i % 7 == 0 else "") + "".join(rng.choice(syllables) for _ in range(4)).title(), "s") for i in range(150)]
    names = sorted({"".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(60)} | {" Aciclo", "aciclo\t", "", " ", "a", "ox"})
    want = {}
    for n in names:
        low = n.strip().lower()
        hits = [(c, d) for c, d, _ in dim if low and low in d.strip().lower()]
        first = [h for h in hits if h[1].strip().lower().startswith(low)]
        one = first[0][0] if len(first) == 1 else min(hits)[0] if hits and not first else None
        status = resolve.OK if len(first) == 1 else resolve.AMBIGUOUS if first else resolve.APPROXIMATE if hits else resolve.NO_MATCH
        want[n] = (status, one, len(first) or len(hits))
    asked, codes = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string"), spark.createDataFrame(dim, "code string, code_name string, section string")
    for hot in (20_000, 5):
        got = {r.name: (r.status, r.code, r.n_candidates) for r in resolve.resolved(asked, resolve.name_matches(asked, codes, hot)).collect()}
        assert got.pop(None) == (resolve.NO_MATCH, None, 0) and got == want
    assert resolve.resolve(asked.limit(0), codes).count() == 0 and {r.status for r in resolve.resolve(asked, codes.limit(0)).collect()} == {resolve.NO_MATCH}


def test_names_meet_few_codes_more_than_they_match(spark):
    """At two sizes of the dimension: grams are as long as the names allow, so their frequency does not grow with the codes."""
    met, matched = [], []
    for n in (2000, 4000):
        dim = spark.range(n).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("code"), F.concat(F.lit("Red ring no "), F.col("id")).alias("code_name"), F.lit("s").alias("section"))
        names = dim.where("id % 2 = 0").select(F.col("code_name").alias("name"))
        asked, low = names.withColumn("_name", F.lower("name")), dim.select(F.lower("code_name").alias("_low"), F.col("code").alias("_row"))
        met.append(resolve.meetings(asked, low, 500).count())
        found = resolve.name_matches(names, dim, 500)
        matched.append(found.count())
    lines = [(len(x) - len(x.lstrip(" :+-")), x) for x in found._jdf.queryExecution().executedPlan().toString().splitlines()]
    for i, (deep, line) in enumerate(lines):
        if "BroadcastExchange" in line:  # no explosion goes through the driver
            assert not any("Generate" in x for d, x in itertools.takewhile(lambda r: r[0] > deep, lines[i + 1 :]))
    assert all(b <= a < 2 * b for a, b in zip(met, matched))
    want = sum(str(j).startswith(str(i)) for i in range(0, 2000, 2) for j in range(2000))
    assert matched[0] == want


def test_codes_from_matches_are_those_of_the_candidates(spark):
    """Codes that repeat, null sections and a null code; a name with one prefix match, several, and only matches inside."""
    dim = spark.createDataFrame([("000000001", "Iron a", "s"), ("000000001", "Iron a", "s"), ("000000002", "Iron b", None), ("000000003", "Oil of iron", "t"), (None, "Zinc oxide", "s"), ("000000005", "More zinc oxide", "s"), ("000000006", "Tin", "s")], "code string, code_name string, section string")
    names = spark.createDataFrame([(n,) for n in ("iron", "zinc oxide", "oxide", "tin", "iron a", "of iron", "none")], "name string")
    found = resolve.name_matches(names, dim)
    answers = resolve.resolved(names, found)
    old = resolve.codes_of(answers.where(F.col("status") != resolve.NO_MATCH).join(resolve.candidates(found), "name", "left"))
    got = rows(resolve.matched_codes(answers, found), "name", "code")
    assert got == rows(old, "name", "code") and {"iron", "tin", "zinc oxide"} <= {r[0] for r in got}


def test_the_gate_report_has_the_counts_of_the_single_gates(spark):
    values = [("a", M[0]), ("a", M[1]), ("b", M[1]), ("b", M[1]), ("c", M[5]), (None, M[2]), ("d", None)]
    df = spark.createDataFrame(values, "pack string, month date")
    asked = F.col("month") < F.lit(M[4])
    got = {r.gate: (r.n_violations, r.passed) for r in quality.gate_report(df, "pack", 1, F.lit(M[4]), asked).collect()}
    single = {
        "unmapped": panel.unmapped(df.withColumnRenamed("pack", "chemical")).count(), "duplicate_keys": quality.duplicate_keys(df, ["pack", "month"]).count(),
        "wrong_month_sizes": quality.wrong_month_sizes(df, 1).count(), "other_months": df.where(~F.coalesce(asked, F.lit(False))).count(),
        "late_starts": quality.late_starts(df.where("month IS NOT NULL"), "pack", F.lit(M[4])).count(),
    }
    assert got == {k: (n, n == 0) for k, n in single.items()} and single["duplicate_keys"] == 1 == single["late_starts"]
    assert all(r.passed for r in quality.gate_report(df.limit(0), "pack", 1, F.lit(M[4]), asked).collect())
    report = quality.gate_report(df, "pack", 1, F.lit(M[4]), asked)
    assert report._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1  # one read


def test_page_gates_and_links(spark, tmp_path):
    (tmp_path / "good.md").write_text("Prices for August 2026\n| Drug | Pack | Price |\n| A oil | 28 | £1,234.50 (previously £1,000.00) |\n| B | 10 ml | £2.5 |\n\nTotal: 2\n")
    (tmp_path / "bad.md").write_text("| A | 28 | £1 |\nTotal lines 3")
    lines = pages.page_lines(spark, str(tmp_path))
    assert [(r.drug, r.pack, r.price, r.previous_price) for r in pages.page_rows(lines).where("page LIKE '%good.md'").orderBy("line_no").collect()] == [("A oil", "28", 1234.5, 1000.0), ("B", "10 ml", 2.5, None)]
    facts_ = {r.page.rsplit("/", 1)[1]: r for r in pages.page_facts(lines).collect()}
    assert facts_["good.md"].month == dt.date(2026, 8, 1) and facts_["good.md"].stated_total == 2
    assert [r.fault for r in pages.bad_pages(pages.page_facts(lines)).collect()] == ["no month"]
    html = spark.createDataFrame([(1, '<a class="x" href="/f_202503.csv"><b>March</b> data</a><a href="http://h/g">202504</a>'), (2, "no anchor")], "page_id int, html string")
    found = pages.links(html)
    assert rows(found.select("position", "text"), "position") == [(0, "March data"), (1, "202504")]
    assert rows(pages.first_link(found, pages.holds("202503"), "http://x"), "page_id") == [(1, "http://x/f_202503.csv")]
    assert rows(pages.latest_token(found), "page_id") == [(1, "202504")]


def fact_rows(spark):
    values = [("c", M[4], 2, 2, False, 1, 0.125, 8), ("new", M[6], 5, None, True, 0, None, 0), ("fresh", M[0], 1, 1, False, 3, 0.5, 1)]
    return spark.createDataFrame(values, "chemical string, month date, streak_length int, time_since_last_concession int, never_seen_on_concession boolean, n_previous_episodes int, chemical_historical_onset_rate double, n_prior_valid_transitions int")


def weights(**given):
    return {k: F.lit(float(given.get(k, 0.0))) for k in explain.WEIGHTS}


def test_ranked_facts(spark):
    told = lambda n, **w: [r.f for r in fact_rows(spark).select(explain.ranked_facts(weights(**w), n).alias("f")).collect()]
    assert [f[0] for f in told(1, since=-0.5)] == ["clear of concession for 2 months", "never on concession before", "came off concession last month"]
    assert told(4, streak=0.1, since=0.5, episodes=-0.5, rate=0.1, sin=0.05, cos=0.06)[0] == ["clear of concession for 2 months", "1 previous episode", "onsets in May are above average", "onset rate 12% over 8 months"]
    assert told(1, sin=-0.3, cos=0.1)[1] == ["onsets in July are below average"]
    assert told(3, rate=1.0)[1] == ["no onset rate known", "never on concession before", "0 previous episodes"]


def test_facts_and_audits(spark):
    told = fact_rows(spark).where("chemical = 'c'").withColumn("facts", explain.ranked_facts(weights(since=0.5, episodes=0.5, rate=0.1), 3))
    check = lambda text_: told.select(explain.problems(F.col("facts"), F.lit(text_))).first()[0]
    assert check("Clear for two months, one episode, rate 12% over eight") == []
    assert check("clear for two months, one episode, rate 13% over 8") == ["12%"]
    assert check("clear for two months, one episode, rate 12% over nine") == ["8"]
    assert "1 previous episode" in check("clear for 2 months, rate 12% over 8, 1")
    assert check("clear for 2 months, 1 episode, a moderate 12% over 8") == ["onset rate 12% over 8 months"]  # words are whole
    season = fact_rows(spark).where("chemical = 'c'").withColumn("facts", explain.ranked_facts(weights(sin=0.5), 1))
    lost = lambda text_: season.select(explain.lost_facts(F.col("facts"), F.lit(text_))).first()[0]
    assert lost("In May onsets are above average.") == []
    assert lost("c has a 5% chance of onset next month: nothing.") == ["onsets in May are above average"] == lost("In May onsets are below average.")
    sent = season.select(explain.sentence(F.col("chemical"), F.lit(0.05), F.col("facts")).alias("s")).first().s
    assert sent == "c has a 5% chance of onset next month: onsets in May are above average." and lost(sent) == []


def planted(spark, n=40, months_=30):
    """Entities whose onset follows their number of episodes."""
    import random

    rng = random.Random(5)
    cells = []
    for e in range(n):
        on, p = False, 0.05 if e % 2 else 0.45
        for m in M[:months_]:
            cells.append((f"e{e}", m, on))
            on = rng.random() < (0.5 if on else p)
    return history.history_features(spark.createDataFrame(cells, "entity string, month date, on_concession boolean"), "entity")


def test_models_beat_the_base_rate_and_contributions_add_up(spark):
    frame = model.model_frame(planted(spark)).cache()
    columns = ["time_since", "n_previous_episodes", "rate_filled"]
    out = model.walk_forward(frame, {"logit": (columns, model.logistic)}, burn_in=24)
    measured = evaluate.summary(out, "logit").first()
    assert measured.average_precision > 1.3 * measured.base_rate and measured.test_months == 4
    bundle = model.train(frame, columns, lambda n: model.trees(rounds=5))
    assert bundle.trained_through == M[28] and bundle.n_onsets > 0
    risk = model.at_risk(frame)
    assert risk.select("month").distinct().count() == 1
    scores = bundle.score(risk)
    shares = model.contributions(bundle, risk, frame, ["entity"])
    mean = model.filled(model.labelled(frame), bundle.fallback_rate).agg(*[F.avg(c).alias(c) for c in columns])
    from pyspark.ml.functions import vector_to_array

    p0 = bundle.model.transform(mean).select(vector_to_array("probability")[1]).first()[0]
    for r in scores.join(shares.withColumn("_sum", sum(F.col(f"`{c}`") for c in columns)).select("entity", "_sum"), "entity").collect():
        assert r["_sum"] == pytest.approx(math.log(r.score / (1 - r.score)) - math.log(p0 / (1 - p0)), abs=1e-6)


@pytest.mark.parametrize("columns", [["time_since", "rate_filled"], model.HISTORY])
def test_shares_of_trees_by_their_paths_are_the_exact_ones(spark, columns):
    frame = model.model_frame(planted(spark))
    bundle = model.train(frame, columns, lambda n: model.trees(rounds=6))
    risk = model.at_risk(frame)
    exact = {r.entity: r for r in model.contributions(bundle, risk, frame, ["entity"]).collect()}
    got = model.tree_contributions(bundle, risk, frame, ["entity"], block=3).collect()
    assert len(got) == len(exact) > 3
    assert all(r[c] == pytest.approx(exact[r.entity][c], abs=1e-9) for r in got for c in columns)
    assert len({round(sum(r[c] for c in columns), 6) for r in got}) > 1
    assert model.tree_contributions(bundle, risk.limit(0), frame, ["entity"]).count() == 0


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_a_panel_has_partitions_by_its_cells_and_is_sorted_once(spark, monkeypatch):
    """Also a null entity, which is never on, a null month, and no event at all."""
    monkeypatch.setattr(panel, "CELLS", 40)
    values = [(f"e{i}", M[i % 6]) for i in range(60)] + [(None, M[1]), ("f", None)]
    events = spark.createDataFrame(values, "entity string, month date")
    dense = panel.dense_panel(events, "entity")
    assert 62 * 6 / 40 * 0.8 < dense.rdd.getNumPartitions() < 62 * 6 / 40 * 1.3 + 1
    assert rows(dense.select(F.coalesce("entity", F.lit("")), "month", "on_concession"), "month", "coalesce(entity, )") == sorted(((e, m, (e, m) in values) for e in [*(f"e{i}" for i in range(60)), "", "f"] for m in M[:6]), key=lambda r: (r[1], r[0]))
    plan = history.history_features(dense, "entity")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert panel.dense_panel(events.limit(0), "entity").count() == 0
