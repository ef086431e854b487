"""Every registered query of the panel library, and the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog_sql import ORACLES
from .functions.months import month_text, parse_month
from .operators import concentration, evaluate, explain, history, lagjoin, panel, quality, resolve, upsert
from .plans import model, proxies, walkforward
from .sources import landing, pages, tables
from .sources.staging import fresh_path, written

__all__ = ["ORACLES", "QUERIES"]

DIGITS = 8
#: First month of the batch that the upserts bring, and the months that are asked for.
BATCH_FROM, ASKED_FROM = "200001", "199901"


def _flat(df: DataFrame) -> DataFrame:
    """Dates as yyyyMM, doubles rounded, counts as longs."""
    out = []
    for f in df.schema:
        kind, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        out.append({"date": month_text(c), "double": F.round(c, DIGITS), "int": c.cast("long")}.get(kind, c).alias(f.name))
    return df.select(*out)


def _chemical_events(spark, d) -> DataFrame:
    events = proxies.archive(spark, d)
    return panel.attach_names(events, panel.canonical_names(events))


def _chemical_features(spark, d) -> DataFrame:
    return history.history_features(panel.dense_panel(_chemical_events(spark, d), "chemical"), "chemical")


def _lagged(spark, d) -> DataFrame:
    return lagjoin.lagged_join(_chemical_features(spark, d), lagjoin.series_features(proxies.series(spark, d), "chemical"), "chemical")


def _scored(spark, d) -> DataFrame:
    """Test rows with the historical rate, or else the base rate, as their score."""
    rows = model.labelled(model.model_frame(_chemical_features(spark, d)))
    return evaluate.baselines(rows).withColumn("score", F.coalesce("chemical_historical_onset_rate", "base_rate"))


def volume_hhi_brand(spark, d):
    return _flat(concentration.volume_and_concentration(proxies.facts(spark, d, "brand")))


def volume_hhi_part(spark, d):
    return _flat(concentration.volume_and_concentration(proxies.facts(spark, d, "part")))


def volume_hhi_members(spark, d):
    wanted = proxies.facts(spark, d, "brand").where(F.col("code").isin("Brand#1", "Brand#2", "Brand#17"))
    return _flat(concentration.volume_and_concentration(wanted))


def volume_cross_check(spark, d):
    computed = concentration.volume_and_concentration(proxies.facts(spark, d, "brand")).groupBy("code").agg(F.sum("total_items").alias("total_items"))
    expected = proxies.table(spark, d, "part").join(proxies.table(spark, d, "lineitem"), F.col("p_partkey") == F.col("l_partkey")).groupBy(F.col("p_brand").alias("code")).agg(F.sum(F.col("l_quantity") + F.when(F.col("p_brand") == "Brand#3", 1).otherwise(0)).alias("total_items"))
    return _flat(concentration.cross_check(computed, expected, "code", "total_items"))


def series_profile(spark, d):
    return _flat(concentration.profile(proxies.series(spark, d), "chemical"))


def canonical_names(spark, d):
    return panel.canonical_names(proxies.archive(spark, d))


def unstable_packs(spark, d):
    return panel.names_per_pack(proxies.archive(spark, d))


def pack_history(spark, d):
    return _flat(history.history_features(panel.dense_panel(proxies.archive(spark, d), "pack"), "pack"))


def chemical_history(spark, d):
    return _flat(_chemical_features(spark, d))


def persistence_pack(spark, d):
    return _flat(panel.persistence_and_onset(panel.dense_panel(proxies.archive(spark, d), "pack"), "pack"))


def persistence_chemical(spark, d):
    return _flat(panel.persistence_and_onset(panel.dense_panel(_chemical_events(spark, d), "chemical"), "chemical"))


def recent_panel_rows(spark, d):
    return _flat(panel.recent_rows(panel.dense_panel(_chemical_events(spark, d), "chemical"), "chemical", 3))


def lagged_features(spark, d):
    return _flat(_lagged(spark, d).select("chemical", "month", "total_items_epd", "items_mom_growth_epd", "log_items_epd"))


def lagged_coverage(spark, d):
    return _flat(lagjoin.coverage(_lagged(spark, d), "total_items_epd"))


def fair_comparison_set(spark, d):
    rows = lagjoin.fair_set(_lagged(spark, d), ["items_mom_growth_epd", "log_items_epd"])
    return _flat(rows.select("chemical", "month", "label_onset_next_month", "items_mom_growth_epd", "log_items_epd"))


def lagged_through_codes(spark, d):
    resolved = written(resolve.resolve(*_names(spark, d)).where(F.col("status") == resolve.OK).select(F.col("name").alias("chemical"), "code"))
    values = proxies.table(spark, d, "lineitem").groupBy(F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("code"), F.trunc("l_shipdate", "month").alias("month")).agg(F.sum("l_quantity").alias("total_items"))
    months = values.select("month").distinct()
    wanted = lagjoin.through_map(resolved.select("chemical"), resolved, "chemical").crossJoin(F.broadcast(months))  # a row a month
    return _flat(lagjoin.lagged_join(wanted, values, "code", 2, "_lag"))


def baseline_rates(spark, d):
    return _flat(_scored(spark, d).select("chemical", "month", "y", "base_rate", "seasonal_rate"))


def average_precision(spark, d):
    return _flat(evaluate.average_precision(_scored(spark, d), "score"))


def precision_at_10(spark, d):
    return _flat(evaluate.precision_at_k(_scored(spark, d), "score"))


def evaluation_summary(spark, d):
    return _flat(evaluate.summary(_scored(spark, d), "score"))


def calibration_bins(spark, d):
    return _flat(evaluate.calibration(_scored(spark, d), "score"))


def drawn_top_10(spark, d):
    return _flat(evaluate.drawn_top_k(_scored(spark, d), "score", "chemical", 42).select("month", "chemical", "score", "y", "rank"))


def walk_forward_scores(spark, d):
    """Every test month's rows with the scores of logistic fits on the months before, all cutoffs fitted together."""
    frame = model.model_frame(_chemical_features(spark, d))
    found = walkforward.walk_forward_logistic(frame, {"history": model.HISTORY})
    return _flat(found.select("chemical", "month", "y", "base_rate", "seasonal_rate", "history"))


def walk_forward_comparison(spark, d):
    """A row for each feature set and burn-in: its measures on the rows that have all features."""
    rows = written(lagjoin.fair_set(model.model_frame(_lagged(spark, d)), ["items_mom_growth_epd", "log_items_epd"]))
    out = None
    for burn_in in (12, 6):
        scores = written(walkforward.walk_forward_logistic(rows, {"history": model.HISTORY, "with_volume": model.WITH_VOLUME}, burn_in))
        for name in ("history", "with_volume", "base_rate", "seasonal_rate"):
            one = evaluate.summary(scores, name).select(F.lit(name).alias("model"), F.lit(burn_in).alias("burn_in"), "average_precision", "mean_precision_at_k", "test_months", "n_rows", "n_positives", F.col("base_rate").alias("positive_rate"))
            out = one if out is None else out.unionByName(one)
    return _flat(out)


def landed_range(spark, d):
    """Order lines landed by month; volume and concentration of two years, read from the busy months' folders alone."""
    path, lines = fresh_path(spark), proxies.facts(spark, d, "brand").withColumn("month", month_text(F.col("month")))
    months = [r[0] for r in lines.select("month").distinct().collect()]  # a row a month
    quality.enforce(quality.unreconciled(landing.land(spark, lines, sorted(months), path)), "a month was not landed whole")
    busy = proxies.table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("month")).agg(F.count("*").alias("n")).where("n % 2 = 0")
    rows = tables.months_between(spark, path, "199701", "199812", busy)
    return _flat(concentration.volume_and_concentration(rows.withColumn("month", parse_month(F.col("month")))))


def sorted_panel(spark, d):
    """The panel as a sorted table, with each row's place in it."""
    path = fresh_path(spark)
    landing.write_sorted(panel.dense_panel(_chemical_events(spark, d), "chemical"), path, "chemical", "month")
    return _flat(landing.read_sorted(spark, path))


def gate_report(spark, d):
    start, end = (parse_month(F.lit(m)) for m in (ASKED_FROM, BATCH_FROM))
    rows = proxies.archive(spark, d).select("pack", "month")
    return _flat(quality.gate_report(rows, "pack", 12, start, F.col("month") < end))


def _state_and_batch(spark, d) -> tuple[DataFrame, DataFrame]:
    early = concentration.volume_and_concentration(proxies.facts(spark, d, "brand").where("practice % 2 = 0"))
    now = concentration.volume_and_concentration(proxies.facts(spark, d, "brand"))
    start = parse_month(F.lit(BATCH_FROM))
    return early.where(F.col("code") != "Brand#5").withColumn("run", F.lit(1)), now.where(F.col("month") >= start).withColumn("run", F.lit(2))


def upsert_features(spark, d):
    state, batch = _state_and_batch(spark, d)
    return _flat(upsert.upsert(state, batch, ["code", "month"], ["name", "total_items", "n_distinct_practices", "hhi"]))


def _predictions(rows: DataFrame, told) -> DataFrame:
    return rows.select("code", "month", F.col("hhi").alias("score"), F.when(told, F.concat(F.lit("told "), "code")).alias("explanation"), "run")


def upsert_scores_keep_text(spark, d):
    state, batch = _state_and_batch(spark, d)
    return _flat(upsert.upsert(_predictions(state, F.month("month") < 7), _predictions(batch, F.month("month") < 4), ["code", "month"], ["score", "run"]))


def upsert_scores_take_text(spark, d):
    state, batch = _state_and_batch(spark, d)
    return _flat(upsert.upsert(_predictions(state, F.month("month") < 7), _predictions(batch, F.month("month") < 4), ["code", "month"], ["score", "explanation", "run"]))


def upsert_outcomes(spark, d):
    state, batch = _state_and_batch(spark, d)
    outcome = lambda rows: rows.select("code", "month", (F.col("total_items") > 100).alias("on_concession"), F.col("run").alias("recorded_run"))
    return _flat(upsert.upsert(outcome(state), outcome(batch), ["code", "month"], ["on_concession"]))


def upsert_clocked(spark, d):
    """A landed table after an upsert of its late months: when a key came, and when a batch last had it."""
    state, batch = (rows.withColumn("month", month_text(F.col("month"))).select("code", "month", "total_items") for rows in _state_and_batch(spark, d))
    path, staging, clocks = fresh_path(spark), fresh_path(spark), ["came_at", "seen_at"]
    landing.write_months(state.withColumns({c: F.lit("2020-01-01").cast("timestamp") for c in clocks}), path)
    upsert.upsert_months(spark, path, staging, batch, ["code", "month"], ["total_items"], came=clocks[:1], seen=clocks[1:], now=F.lit("2020-02-01").cast("timestamp"))
    told = landing.read_evolved(spark, path).withColumn("month", F.col("month").cast("string"))
    return _flat(told.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in clocks}))


def csv_order_lines(spark, d):
    """Orders written as CSV in two orders of columns, some lines with a field too many, too few or an open quote: the rows read back, and the lines set apart."""
    k, names = F.col("o_orderkey"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
    orders = proxies.table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    paths = []
    for i, order in enumerate((names, [names[3], names[2], names[0], names[1]])):
        whole = F.concat_ws(",", *order)
        line = F.when(k % 97 == 0, F.concat(whole, F.lit(",more"))).when(k % 89 == 0, F.col(order[0]).cast("string")).when(k % 83 == 0, F.concat_ws(",", order[0], F.concat(F.lit('"'), order[1]), *order[2:])).otherwise(whole)
        paths.append(fresh_path(spark))
        # One column, whose name is the header: nothing in it is a separator or a quote to this writer.
        orders.where(k % 2 == i).select(line.alias(",".join(order))).write.option("header", True).option("sep", "\x01").option("quote", "\x02").csv(paths[-1])
    good, broken = tables.csv_routes(spark, paths, names)
    return good.withColumns({c: F.col(c).cast("long") for c in names[:2]}).unionByName(broken, allowMissingColumns=True)


def duplicate_code_months(spark, d):
    both = proxies.facts(spark, d, "part").groupBy("code", "month", "practice").agg(F.sum("items").alias("x"))
    return _flat(quality.duplicate_keys(both, ["code", "month"]))


def month_sizes_off(spark, d):
    return _flat(quality.wrong_month_sizes(proxies.series(spark, d), 200))


def overlapping_months(spark, d):
    s = proxies.series(spark, d)
    return _flat(quality.overlapping_months(s.where(F.col("month") < parse_month(F.lit(BATCH_FROM))), s.where(F.col("month") >= parse_month(F.lit(ASKED_FROM)))))


def merged_sources(spark, d):
    old = tables.renamed(proxies.series(spark, d).where(F.year("month") < 2000), {"chemical": "chemical_name", "month": "month", "total_items": "total_items"})
    new = tables.renamed(proxies.facts(spark, d, "chemical").where(F.year("month") >= 2000), {"name": "chemical_name", "month": "month", "items": "total_items"})
    return _flat(old.unionByName(new.groupBy("chemical_name", "month").agg(F.sum("total_items").alias("total_items"))))


def packs_without_events(spark, d):
    return quality.without_series(proxies.table(spark, d, "part").select(F.col("p_partkey").alias("pack")), proxies.archive(spark, d), "pack")


def late_start_packs(spark, d):
    return _flat(quality.late_starts(proxies.archive(spark, d), "pack", parse_month(F.lit(ASKED_FROM))))


def unprocessed_months(spark, d):
    s = proxies.series(spark, d)
    return _flat(landing.unprocessed(s, s.where("total_items > 700").select("month").distinct()))


def wrong_month_rows(spark, d):
    rows = proxies.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("ym"))
    return quality.other_months(rows, F.col("ym"), ASKED_FROM)


def run_metrics(spark, d):
    frame = model.model_frame(_chemical_features(spark, d))
    scored = model.at_risk(frame).withColumn("explanation", F.when(F.col("n_previous_episodes") > 5, "told"))
    return _flat(upsert.run_metrics(model.labelled(frame), scored))


def _names(spark, d) -> tuple[DataFrame, DataFrame]:
    """Names to resolve, some cut, some changed, and the dimension of codes of nine digits."""
    part = proxies.table(spark, d, "part")
    k = F.col("p_partkey")
    dimension = part.select(F.lpad(k.cast("string"), 9, "0").alias("code"), F.concat_ws(" ", "p_name", "p_type", F.concat(F.lit("no "), k.cast("string"))).alias("code_name"), F.col("p_brand").alias("section"))
    full = F.concat_ws(" ", "p_name", "p_type", F.concat(F.lit("no "), k.cast("string")))
    name = F.when(k % 5 == 0, full).when(k % 5 == 1, F.concat_ws(" ", "p_name", "p_type")).when(k % 5 == 2, F.concat(F.lit("no "), k.cast("string"))).when(k % 5 == 3, F.concat(F.lit("un"), full)).otherwise(F.upper(full))
    return part.select(name.alias("name")), dimension


def resolved_names(spark, d):
    return _flat(resolve.resolve(*_names(spark, d)))


def resolution_tally(spark, d):
    return _flat(resolve.tally(resolve.resolve(*_names(spark, d))))


def resolver_known_answers(spark, d):
    names, dimension = _names(spark, d)
    expected = dimension.select(F.col("code_name").alias("name"), F.when(F.col("section") != "Brand#4", F.col("code")).alias("expected_code"))
    return resolve.known_answers(resolve.resolve(names, dimension), expected.join(names.distinct(), "name", "left_semi"))


def _volume(spark, d) -> DataFrame:
    names, dimension = _names(spark, d)
    found = written(resolve.name_matches(names, dimension))
    codes = resolve.matched_codes(resolve.resolved(names, found), found)
    values = proxies.table(spark, d, "lineitem").groupBy(F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("code"), F.trunc("l_shipdate", "month").alias("month")).agg(F.sum("l_quantity").alias("items"))
    lost = F.col("code").endswith("7")
    return resolve.volume_over_codes(codes, values.where(~lost), dimension.where(lost))


def volume_over_codes(spark, d):
    return _flat(_volume(spark, d))


def partial_volume_names(spark, d):
    return _flat(resolve.partial_names(_volume(spark, d)))


def json_series(spark, d):
    rows = proxies.table(spark, d, "events").select("user_id", F.concat(F.lit('[{"date": "'), F.date_format("ts", "yyyy-MM-dd"), F.lit('", "items": '), F.get_json_object("props", "$.k"), F.lit("}]")).alias("body"))
    return _flat(tables.json_series(rows, "user_id", F.col("body")))


def page_links(spark, d):
    return _flat(pages.links(proxies.table(spark, d, "pages").select("page_id", "html")))


def page_month_links(spark, d):
    return pages.first_link(pages.links(proxies.table(spark, d, "pages").select("page_id", "html")), pages.holds("th"), "https://example.org")


def page_text_links(spark, d):
    return pages.first_link(pages.links(proxies.table(spark, d, "pages").select("page_id", "html")), pages.text_holds("THE"), "https://example.org")


def page_latest_tokens(spark, d):
    return pages.latest_token(pages.links(proxies.table(spark, d, "pages").select("page_id", "html")), "([a-z]{4,})")


def _price_lines(spark, d) -> DataFrame:
    """Lines of a page a month: a header, a row for each order line, and a footer with their number; one month states another."""
    rows = proxies._lines(spark, d).select(F.date_format("month", "yyyyMM").alias("page"), "month", F.concat(F.lit("| "), "p_name", F.lit(" | "), F.col("p_size").cast("string"), F.lit(" | £"), F.format_number("l_extendedprice", 2), F.when(F.col("l_linenumber") == 1, F.concat(F.lit(" (previously £"), F.format_number("p_retailprice", 2), F.lit(")"))).otherwise(""), F.lit(" |")).alias("line"), (F.col("l_orderkey") * 8 + F.col("l_linenumber") + 1).alias("line_no"))
    pages_ = rows.groupBy("page", "month").agg(F.count("*").alias("n"), F.max("line_no").alias("last"))
    head = pages_.select("page", F.lit(0).cast("long").alias("line_no"), F.concat(F.lit("Prices of "), F.date_format("month", "MMMM yyyy")).alias("line"))
    n = F.col("n") + F.when(F.col("page").endswith("03"), 1).otherwise(0)
    foot = pages_.select("page", (F.col("last") + 1).alias("line_no"), F.concat(F.lit("Total rows: "), n.cast("string")).alias("line"))
    return rows.select("page", "line_no", "line").unionByName(head).unionByName(foot)


def price_page_rows(spark, d):
    return _flat(pages.page_rows(_price_lines(spark, d)))


def price_page_faults(spark, d):
    return _flat(pages.bad_pages(pages.page_facts(_price_lines(spark, d))))


def _facts(spark, d) -> DataFrame:
    frame = model.at_risk(model.model_frame(_chemical_features(spark, d)))
    weighed = model.facts_weights(frame).withColumn("score", F.coalesce("chemical_historical_onset_rate", F.lit(0.0)))
    return weighed.withColumn("facts", explain.ranked_facts(_weights()))


def _weights() -> dict:
    return {k: F.round(f"_w_{k}", 9) for k in explain.WEIGHTS}


def fact_sentences(spark, d):
    return _facts(spark, d).select("chemical", explain.sentence(F.col("chemical"), F.col("score"), F.col("facts")).alias("sentence"))


def sentence_audits(spark, d):
    told = _facts(spark, d).withColumn("text", explain.sentence(F.col("chemical"), F.col("score"), F.col("facts")))
    changed = told.withColumn("text", F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "month", "day"), "below average", "above average"), "[1-4]", "9"))
    shown = lambda problems: F.array_join(problems, ";")
    return changed.select("chemical", shown(explain.lost_percentages(F.col("facts"), F.col("text"))).alias("percentages"), shown(explain.lost_integers(F.col("facts"), F.col("text"))).alias("integers"), shown(explain.lost_facts(F.col("facts"), F.col("text"))).alias("lost"))


def explained_top(spark, d):
    scored = _facts(spark, d)
    told = explain.explain_top(scored, "chemical", _weights())
    return _flat(told.select("chemical", "month", "score", "explanation", "explanation_method"))


def _log(spark, d) -> DataFrame:
    return proxies.series(spark, d).withColumn("score", F.round(F.col("total_items") / 7777, 12))


def latest_predictions(spark, d):
    return _flat(explain.latest_predictions(_log(spark, d), "chemical"))


def entity_history(spark, d):
    return _flat(explain.entity_history(_log(spark, d), "chemical"))


def table_totals(spark, d):
    return _flat(explain.totals(_log(spark, d), proxies.series(spark, d)))


def trained_scores(spark, d):
    """Full training of the boosted trees, and the scores of the clear rows of the latest month."""
    frame = model.model_frame(_chemical_features(spark, d))
    bundle = model.train(frame, model.HISTORY)
    return bundle.score(model.at_risk(frame)).select("chemical", month_text(F.col("month")).alias("month"), "score")


def explained_by_trees(spark, d):
    """The ten best rows of the latest month, told by what the fully trained trees add for each feature."""
    frame = written(model.model_frame(_chemical_features(spark, d)))
    bundle = model.train(frame, model.HISTORY)
    top = written(bundle.score(model.at_risk(frame)).orderBy(F.col("score").desc_nulls_last(), "chemical").limit(10))
    told_by = dict(zip(explain.WEIGHTS, ("streak_length", "time_since", "n_previous_episodes", "rate_filled", "month_sin", "month_cos")))
    shares = model.tree_contributions(bundle, top, frame, ["chemical"]).select("chemical", *[F.col(c).alias(f"_w_{k}") for k, c in told_by.items()])
    told = explain.explain_top(top.join(F.broadcast(shares), "chemical"), "chemical", _weights())  # ten rows
    return told.select("chemical", month_text(F.col("month")).alias("month"), "score", "explanation", "explanation_method")


QUERIES = {f.__name__: f for f in (
    volume_hhi_brand, volume_hhi_part, volume_hhi_members, volume_cross_check, series_profile, canonical_names, unstable_packs, pack_history, chemical_history,
    persistence_pack, persistence_chemical, recent_panel_rows, lagged_features, lagged_coverage, fair_comparison_set, lagged_through_codes, baseline_rates,
    average_precision, precision_at_10, evaluation_summary, calibration_bins, upsert_features, upsert_scores_keep_text, upsert_scores_take_text, upsert_outcomes,
    duplicate_code_months, month_sizes_off, overlapping_months, merged_sources, packs_without_events, late_start_packs, unprocessed_months, wrong_month_rows,
    run_metrics, resolved_names, resolution_tally, resolver_known_answers, volume_over_codes, partial_volume_names, json_series, page_links, page_month_links,
    page_text_links, page_latest_tokens, price_page_rows, price_page_faults, fact_sentences, sentence_audits, explained_top, latest_predictions, entity_history,
    table_totals, trained_scores, drawn_top_10, walk_forward_scores, walk_forward_comparison, landed_range, sorted_panel, gate_report,
    upsert_clocked, csv_order_lines, explained_by_trees,
)}
