"""DuckDB SQL for the catalog's queries, written from their meaning and not from their Spark plans."""

from __future__ import annotations

EPD = """
epd AS (SELECT p_brand, p_name, p_type, p_partkey, p_size, p_retailprice, l_suppkey AS practice, l_quantity AS items, l_discount, l_returnflag, l_extendedprice, l_orderkey, l_linenumber,
               date_trunc('month', l_shipdate)::DATE AS month
        FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def volume(code: str, name: str, where: str = "true", alias: str = "vol") -> str:
    return f"""
{alias} AS (SELECT code, name, month, sum(x) AS total_items, count(practice) AS n_distinct_practices, CASE WHEN sum(x) > 0 THEN sum((x / t) ** 2) END AS hhi
        FROM (SELECT *, sum(x) OVER (PARTITION BY code, name, month) AS t
              FROM (SELECT {code} AS code, {name} AS name, month, practice, sum(items) AS x FROM epd WHERE {where} GROUP BY ALL))
        GROUP BY ALL)"""


BRAND = ("p_brand", "'brand ' || p_brand")
VOLUME_OUT = "SELECT code, name, strftime(month, '%Y%m') AS month, round(total_items, 8) AS total_items, n_distinct_practices, round(hhi, 8) AS hhi FROM vol"

ARCHIVE = (
    EPD
    + r""",
archive AS (SELECT p_partkey AS pack, month, trim(p_name || ' ' || p_type || CASE WHEN l_discount >= 0.1 THEN ' sr' ELSE '' END) AS chemical
            FROM epd WHERE l_returnflag = 'R' AND items >= 45),
canon AS (SELECT pack, chemical FROM (SELECT pack, chemical, row_number() OVER (PARTITION BY pack ORDER BY month DESC, chemical DESC) AS r FROM archive) WHERE r = 1),
chem_events AS (SELECT DISTINCT c.chemical, a.month FROM archive a JOIN canon c USING (pack))"""
)


def dense(events: str, entity: str) -> str:
    return f"""
ev AS (SELECT DISTINCT {entity} AS entity, month FROM {events}),
dense AS (SELECT e.entity, m.month, EXISTS (SELECT 1 FROM ev x WHERE x.entity = e.entity AND x.month = m.month) AS on_concession
          FROM (SELECT DISTINCT entity FROM ev) e,
               (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH))::DATE AS month FROM ev) m),
steps AS (SELECT *, lead(on_concession) OVER w AS nxt, lag(on_concession) OVER w AS prv, datediff('month', DATE '1990-01-01', month) AS i
          FROM dense WINDOW w AS (PARTITION BY entity ORDER BY month))"""


# Streaks from the last month of the other state, times from the last month that was on, rates from running sums.
HISTORY = """
hist AS (SELECT entity, month, on_concession,
                i - coalesce(max(CASE WHEN on_concession THEN NULL ELSE i END) OVER u, min(i) OVER (PARTITION BY entity) - 1) AS run_on,
                i - coalesce(max(CASE WHEN on_concession THEN i END) OVER u, min(i) OVER (PARTITION BY entity) - 1) AS run_off,
                i - max(CASE WHEN on_concession THEN i END) OVER u AS since,
                sum(CASE WHEN on_concession AND NOT coalesce(prv, false) THEN 1 ELSE 0 END) OVER u AS episodes,
                coalesce(sum(CASE WHEN NOT on_concession AND nxt IS NOT NULL THEN 1 ELSE 0 END) OVER p, 0) AS clear,
                coalesce(sum(CASE WHEN NOT on_concession AND nxt THEN 1 ELSE 0 END) OVER p, 0) AS onsets,
                CASE WHEN NOT on_concession AND nxt IS NOT NULL THEN nxt::INT::DOUBLE END AS label
         FROM steps
         WINDOW u AS (PARTITION BY entity ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                p AS (PARTITION BY entity ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
feat AS (SELECT entity, month, on_concession, CASE WHEN on_concession THEN run_on ELSE run_off END AS streak_length, since AS time_since_last_concession,
                since IS NULL AS never_seen_on_concession, episodes::BIGINT AS n_previous_episodes, CASE WHEN clear > 0 THEN onsets / clear END AS rate, clear::BIGINT AS n_prior, label
         FROM hist)"""

CHEM = ARCHIVE + "," + dense("chem_events", "chemical") + "," + HISTORY
PACK = ARCHIVE + "," + dense("archive", "pack") + "," + HISTORY


def history_out(entity: str) -> str:
    return f"""SELECT entity AS {entity}, strftime(month, '%Y%m') AS month, on_concession, streak_length::BIGINT AS streak_length, time_since_last_concession::BIGINT AS time_since_last_concession,
       never_seen_on_concession, n_previous_episodes, round(rate, 8) AS chemical_historical_onset_rate, n_prior AS n_prior_valid_transitions,
       year(month)::BIGINT AS year, month(month)::BIGINT AS month_of_year, label AS label_onset_next_month FROM feat"""


PERSISTENCE = """SELECT round(avg(nxt::INT) FILTER (WHERE on_concession), 8) AS persistence_rate, round(avg(nxt::INT) FILTER (WHERE NOT on_concession), 8) AS onset_rate,
       count(*) FILTER (WHERE on_concession) AS n_on_transitions, count(*) FILTER (WHERE NOT on_concession) AS n_off_transitions FROM steps WHERE nxt IS NOT NULL"""

SERIES = "series AS (SELECT p_name || ' ' || p_type AS chemical, month, sum(items) AS total_items FROM epd GROUP BY ALL)"
LAGGED = (
    CHEM
    + ","
    + SERIES
    + """,
grown AS (SELECT *, CASE WHEN before = 0 THEN CASE WHEN total_items > 0 THEN 'inf'::DOUBLE END ELSE total_items / before - 1 END AS growth
          FROM (SELECT *, lag(total_items) OVER (PARTITION BY chemical ORDER BY month) AS before FROM series)),
lagged AS (SELECT f.entity AS chemical, f.month, f.label, g.total_items, g.growth, ln(1 + g.total_items) AS logged
           FROM feat f LEFT JOIN grown g ON g.chemical = f.entity AND g.month = f.month - INTERVAL 2 MONTH)"""
)

SCORED = (
    CHEM
    + """,
lab AS (SELECT entity AS chemical, month, label AS y, rate FROM feat WHERE label IS NOT NULL),
months AS (SELECT month, sum(y) AS s, count(*) AS n FROM lab GROUP BY month),
rates AS (SELECT a.month, sum(b.s) / sum(b.n) AS base_rate,
                 coalesce(sum(b.s) FILTER (WHERE month(b.month) = month(a.month)) / sum(b.n) FILTER (WHERE month(b.month) = month(a.month)), sum(b.s) / sum(b.n)) AS seasonal_rate
          FROM months a JOIN months b ON b.month < a.month GROUP BY a.month),
tested AS (SELECT month FROM (SELECT month, row_number() OVER (ORDER BY month) AS r, count(*) OVER () AS m FROM months) WHERE r > 12 AND r < m),
scored AS (SELECT l.*, r.base_rate, r.seasonal_rate, coalesce(l.rate, r.base_rate) AS score FROM lab l JOIN tested USING (month) JOIN rates r USING (month))"""
)
AVERAGE_PRECISION = """
ap AS (SELECT sum(h * ch / cn) / (SELECT sum(y) FROM scored) AS average_precision
       FROM (SELECT h, sum(h) OVER w AS ch, sum(n) OVER w AS cn FROM (SELECT score, count(*) AS n, sum(y) AS h FROM scored GROUP BY score) WINDOW w AS (ORDER BY score DESC)))"""
PRECISION = """
pk AS (SELECT month, sum(h * greatest(0, least(n, 10 - b)) / n) / least(10, sum(n)) AS precision
       FROM (SELECT month, n, h, coalesce(sum(n) OVER (PARTITION BY month ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
             FROM (SELECT month, score, count(*) AS n, sum(y) AS h FROM scored GROUP BY month, score)) GROUP BY month)"""

STATE = EPD + "," + volume(*BRAND, "practice % 2 = 0 AND p_brand <> 'Brand#5'", "s0") + "," + volume(*BRAND, "month >= DATE '2000-01-01'", "b0") + """,
st AS (SELECT *, 1 AS run FROM s0), ba AS (SELECT *, 2 AS run FROM b0)"""
BOTH = "FROM st FULL OUTER JOIN ba ON st.code = ba.code AND st.month = ba.month"
KEY = "coalesce(st.code, ba.code) AS code, strftime(coalesce(st.month, ba.month), '%Y%m') AS month"
TOLD = "CASE WHEN month({t}.month) < {m} THEN 'told ' || {t}.code END"

NAMES = """
dim AS (SELECT lpad(p_partkey::VARCHAR, 9, '0') AS code, p_name || ' ' || p_type || ' no ' || p_partkey AS code_name, p_brand AS section FROM part),
names AS (SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN full_name WHEN 1 THEN p_name || ' ' || p_type WHEN 2 THEN 'no ' || p_partkey WHEN 3 THEN 'un' || full_name ELSE upper(full_name) END AS name
          FROM (SELECT *, p_name || ' ' || p_type || ' no ' || p_partkey AS full_name FROM part)),
hits AS (SELECT name, code, code_name, section, starts_with(lower(code_name), lower(name)) AS is_prefix FROM names, dim WHERE contains(lower(code_name), lower(name))),
best AS (SELECT name, count(*) FILTER (WHERE is_prefix) AS p, count(*) AS a, min(code) FILTER (WHERE is_prefix) AS pc, min(code) AS ac FROM hits GROUP BY name),
resolved AS (SELECT n.name, CASE WHEN p = 1 THEN 'ok (prefix match)' WHEN p > 1 THEN 'AMBIGUOUS' WHEN a > 0 THEN 'APPROXIMATE' ELSE 'no match' END AS status,
                    CASE WHEN p = 1 THEN pc WHEN coalesce(p, 0) = 0 THEN ac END AS code, CASE WHEN p > 0 THEN p ELSE coalesce(a, 0) END AS n_candidates
             FROM names n LEFT JOIN best USING (name))"""
VOLUME_CODES = NAMES + """,
codes AS (SELECT name, code FROM resolved WHERE code IS NOT NULL UNION ALL SELECT h.name, h.code FROM hits h JOIN resolved r USING (name) WHERE r.code IS NULL AND h.is_prefix),
vals AS (SELECT lpad(l_partkey::VARCHAR, 9, '0') AS code, date_trunc('month', l_shipdate)::DATE AS month, sum(l_quantity) AS items FROM lineitem WHERE l_partkey % 10 <> 7 GROUP BY ALL),
counted AS (SELECT name, count(*) FILTER (WHERE code IN (SELECT code FROM vals)) AS n_codes_summed, count(*) FILTER (WHERE code LIKE '%7') AS n_codes_failed FROM codes GROUP BY name),
summed AS (SELECT name, month, sum(items) AS total_items FROM codes JOIN vals USING (code) GROUP BY ALL)"""

LINKS = r"""
tags AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>')) AS tag, unnest(range(len(regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>')))) AS position FROM pages),
links AS (SELECT page_id, position, regexp_extract(tag, '(?is)^<a\s[^>]*href="([^"]*)"', 1) AS href,
                 regexp_replace(regexp_replace(regexp_extract(tag, '(?is)^<a\s[^>]*>(.*)</a>$', 1), '<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g') AS text FROM tags)"""


def first_link(test: str) -> str:
    return f"WITH {LINKS} SELECT page_id, CASE WHEN href LIKE '/%' THEN 'https://example.org' || href ELSE href END AS href FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY position) AS r FROM links WHERE {test}) WHERE r = 1"


LATEST = CHEM + """,
risk AS (SELECT *, coalesce(time_since_last_concession, 999) AS ts, sin(2 * pi() * month(month) / 12) AS ms, cos(2 * pi() * month(month) / 12) AS mc, coalesce(rate, 0) AS score
         FROM feat WHERE NOT on_concession AND month = (SELECT max(month) FROM feat)),
weighed AS (SELECT *, round(coalesce(streak_length - avg(streak_length) OVER (), 0), 9) AS ws, round(coalesce(ts - avg(ts) OVER (), 0), 9) AS w0, round(coalesce(n_previous_episodes - avg(n_previous_episodes) OVER (), 0), 9) AS w1,
                   round(coalesce(rate - avg(rate) OVER (), 0), 9) AS w2, round(coalesce(ms - avg(ms) OVER (), 0), 9) AS w3, round(coalesce(mc - avg(mc) OVER (), 0), 9) AS w4 FROM risk),
named AS (SELECT *, CASE WHEN never_seen_on_concession THEN 'never on concession before' WHEN streak_length <= 1 THEN 'came off concession last month' ELSE 'clear of concession for ' || streak_length::BIGINT || ' months' END AS f0,
                 n_previous_episodes || ' previous episode' || CASE WHEN n_previous_episodes = 1 THEN '' ELSE 's' END AS f1,
                 CASE WHEN rate IS NULL THEN 'no onset rate known' ELSE 'onset rate ' || round_even(rate * 100, 0)::BIGINT || '% over ' || n_prior || ' month' || CASE WHEN n_prior = 1 THEN '' ELSE 's' END END AS f2,
                 'onsets in ' || strftime(month, '%B') || ' are ' || CASE WHEN w3 + w4 > 0 THEN 'above' ELSE 'below' END || ' average' AS f3 FROM weighed),
long AS (SELECT entity, score, greatest(abs(ws), abs(w0)) AS w, 0 AS o, f0 AS f FROM named UNION ALL SELECT entity, score, abs(w1), 1, f1 FROM named UNION ALL SELECT entity, score, abs(w2), 2, f2 FROM named UNION ALL SELECT entity, score, abs(w3) + abs(w4), 3, f3 FROM named),
top3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY w DESC, o) AS r FROM long) WHERE r <= 3),
told AS (SELECT entity, any_value(score) AS score, entity || ' has a ' || round_even(any_value(score) * 100, 0)::BIGINT || '% chance of onset next month: ' || string_agg(f, '; ' ORDER BY r) || '.' AS sentence FROM top3 GROUP BY entity)"""

LOG = EPD + "," + SERIES + ", log AS (SELECT *, round(total_items / 7777, 12) AS score FROM series)"

ORACLES = {
    "volume_hhi_brand": f"WITH {EPD}, {volume(*BRAND)} {VOLUME_OUT}",
    "volume_hhi_part": f"WITH {EPD}, {volume('p_partkey::VARCHAR', 'p_name')} {VOLUME_OUT}",
    "volume_hhi_members": f"WITH {EPD}, {volume(*BRAND)} {VOLUME_OUT} WHERE code IN ('Brand#1', 'Brand#2', 'Brand#17')",
    "volume_cross_check": f"""WITH {EPD} SELECT p_brand AS code, sum(items) AS total_items, sum(items) + CASE WHEN p_brand = 'Brand#3' THEN count(*) ELSE 0 END AS expected_total_items,
        CASE WHEN p_brand = 'Brand#3' THEN 'MISMATCH' ELSE 'MATCH' END AS "check" FROM epd GROUP BY p_brand""",
    "series_profile": f"WITH {EPD}, {SERIES} SELECT count(*) AS n_rows, count(DISTINCT chemical) AS n_entities, count(DISTINCT month) AS n_months, strftime(min(month), '%Y%m') AS first_month, strftime(max(month), '%Y%m') AS last_month FROM series",
    "canonical_names": f"WITH {ARCHIVE} SELECT pack, chemical FROM canon",
    "unstable_packs": f"WITH {ARCHIVE} SELECT pack, count(DISTINCT chemical) AS n_names FROM archive GROUP BY pack HAVING count(DISTINCT chemical) > 1",
    "pack_history": f"WITH {PACK} {history_out('pack')}",
    "chemical_history": f"WITH {CHEM} {history_out('chemical')}",
    "persistence_pack": f"WITH {PACK} {PERSISTENCE}",
    "persistence_chemical": f"WITH {CHEM} {PERSISTENCE}",
    "recent_panel_rows": f"WITH {CHEM} SELECT entity AS chemical, strftime(month, '%Y%m') AS month, on_concession FROM dense WHERE month > (SELECT max(month) FROM dense) - INTERVAL 3 MONTH",
    "lagged_features": f"WITH {LAGGED} SELECT chemical, strftime(month, '%Y%m') AS month, total_items AS total_items_epd, round(growth, 8) AS items_mom_growth_epd, round(logged, 8) AS log_items_epd FROM lagged",
    "lagged_coverage": f"WITH {LAGGED} SELECT round(count(total_items) / count(*), 8) AS coverage, count(*) AS n_rows FROM lagged",
    "fair_comparison_set": f"WITH {LAGGED} SELECT chemical, strftime(month, '%Y%m') AS month, label AS label_onset_next_month, round(growth, 8) AS items_mom_growth_epd, round(logged, 8) AS log_items_epd FROM lagged WHERE label IS NOT NULL AND growth IS NOT NULL AND logged IS NOT NULL",
    "lagged_through_codes": f"""WITH {NAMES}, v AS (SELECT lpad(l_partkey::VARCHAR, 9, '0') AS code, date_trunc('month', l_shipdate)::DATE AS month, sum(l_quantity) AS t FROM lineitem GROUP BY ALL)
        SELECT r.name AS chemical, strftime(m.month, '%Y%m') AS month, r.code, v.t AS total_items_lag
        FROM (SELECT name, code FROM resolved WHERE status = 'ok (prefix match)') r JOIN (SELECT DISTINCT month FROM v) m ON true LEFT JOIN v ON v.code = r.code AND v.month = m.month - INTERVAL 2 MONTH""",
    "baseline_rates": f"WITH {SCORED} SELECT chemical, strftime(month, '%Y%m') AS month, y, round(base_rate, 8) AS base_rate, round(seasonal_rate, 8) AS seasonal_rate FROM scored",
    "average_precision": f"WITH {SCORED}, {AVERAGE_PRECISION} SELECT round(average_precision, 8) AS average_precision FROM ap",
    "precision_at_10": f"WITH {SCORED}, {PRECISION} SELECT strftime(month, '%Y%m') AS month, round(precision, 8) AS precision FROM pk",
    "evaluation_summary": f"""WITH {SCORED}, {AVERAGE_PRECISION}, {PRECISION} SELECT round((SELECT average_precision FROM ap), 8) AS average_precision, round((SELECT avg(precision) FROM pk), 8) AS mean_precision_at_k,
        count(DISTINCT month) AS test_months, count(*) AS n_rows, sum(y) AS n_positives, round(sum(y) / count(*), 8) AS base_rate FROM scored""",
    "calibration_bins": f"""WITH {SCORED}, q AS (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM scored)
        SELECT bin, count(*) AS n, round(avg(score), 8) AS mean_prediction, round(avg(y), 8) AS observed_rate, abs(avg(score) - avg(y)) >= 0.03 AS off
        FROM (SELECT score, y, (e[1] < score)::INT + (e[2] < score)::INT + (e[3] < score)::INT + (e[4] < score)::INT + (e[5] < score)::INT + (e[6] < score)::INT + (e[7] < score)::INT + (e[8] < score)::INT + (e[9] < score)::INT AS bin FROM scored, q) GROUP BY bin""",
    "upsert_features": f"WITH {STATE} SELECT {KEY}, coalesce(ba.name, st.name) AS name, CASE WHEN ba.code IS NULL THEN st.total_items ELSE ba.total_items END AS total_items, CASE WHEN ba.code IS NULL THEN st.n_distinct_practices ELSE ba.n_distinct_practices END AS n_distinct_practices, round(CASE WHEN ba.code IS NULL THEN st.hhi ELSE ba.hhi END, 8) AS hhi, coalesce(st.run, ba.run)::BIGINT AS run {BOTH}",
    "upsert_scores_keep_text": f"WITH {STATE} SELECT {KEY}, round(CASE WHEN ba.code IS NULL THEN st.hhi ELSE ba.hhi END, 8) AS score, CASE WHEN st.code IS NULL THEN {TOLD.format(t='ba', m=4)} ELSE {TOLD.format(t='st', m=7)} END AS explanation, coalesce(ba.run, st.run)::BIGINT AS run {BOTH}",
    "upsert_scores_take_text": f"WITH {STATE} SELECT {KEY}, round(CASE WHEN ba.code IS NULL THEN st.hhi ELSE ba.hhi END, 8) AS score, CASE WHEN ba.code IS NULL THEN {TOLD.format(t='st', m=7)} ELSE {TOLD.format(t='ba', m=4)} END AS explanation, coalesce(ba.run, st.run)::BIGINT AS run {BOTH}",
    "upsert_outcomes": f"WITH {STATE} SELECT {KEY}, coalesce(ba.total_items, st.total_items) > 100 AS on_concession, coalesce(st.run, ba.run)::BIGINT AS recorded_run {BOTH}",
    "upsert_clocked": f"WITH {STATE} SELECT {KEY}, CASE WHEN ba.code IS NULL THEN st.total_items ELSE ba.total_items END AS total_items, CASE WHEN st.code IS NULL THEN '2020-02-01' ELSE '2020-01-01' END AS came_at, CASE WHEN ba.code IS NULL THEN '2020-01-01' ELSE '2020-02-01' END AS seen_at {BOTH}",
    "csv_order_lines": """WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 97 = 0 AS more, o_orderkey % 89 = 0 AS less, o_orderkey % 83 = 0 AS quoted, o_orderkey % 2 = 0 AS even FROM orders)
        SELECT CASE WHEN NOT (more OR less OR quoted) THEN o_orderkey END AS o_orderkey, CASE WHEN NOT (more OR less OR quoted) THEN o_custkey END AS o_custkey,
        CASE WHEN NOT (more OR less OR quoted) THEN o_orderstatus END AS o_orderstatus, CASE WHEN NOT (more OR less OR quoted) THEN day END AS o_orderdate,
        CASE WHEN more AND even THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, day, 'more') WHEN more THEN concat_ws(',', day, o_orderstatus, o_orderkey, o_custkey, 'more')
        WHEN less AND even THEN o_orderkey::VARCHAR WHEN less THEN day
        WHEN quoted AND even THEN concat(o_orderkey, ',"', concat_ws(',', o_custkey, o_orderstatus, day)) WHEN quoted THEN concat(day, ',"', concat_ws(',', o_orderstatus, o_orderkey, o_custkey)) END AS line FROM o""",
    "duplicate_code_months": f"WITH {EPD} SELECT p_partkey::VARCHAR AS code, strftime(month, '%Y%m') AS month, count(DISTINCT practice) AS n_rows FROM epd GROUP BY ALL HAVING count(DISTINCT practice) > 1",
    "month_sizes_off": f"WITH {EPD}, {SERIES} SELECT strftime(month, '%Y%m') AS month, count(*) AS n_rows FROM series GROUP BY ALL HAVING count(*) <> 200",
    "overlapping_months": f"WITH {EPD}, {SERIES} SELECT DISTINCT strftime(month, '%Y%m') AS month FROM series WHERE month < DATE '2000-01-01' AND month >= DATE '1999-01-01'",
    "merged_sources": f"WITH {EPD}, {SERIES} SELECT chemical AS chemical_name, strftime(month, '%Y%m') AS month, total_items FROM series",
    "packs_without_events": f"WITH {ARCHIVE} SELECT p_partkey AS pack FROM part WHERE p_partkey NOT IN (SELECT pack FROM archive)",
    "late_start_packs": f"WITH {ARCHIVE} SELECT pack, strftime(min(month), '%Y%m') AS first_month FROM archive GROUP BY pack HAVING min(month) >= DATE '1999-01-01'",
    "unprocessed_months": f"WITH {EPD}, {SERIES} SELECT strftime(month, '%Y%m') AS month FROM series GROUP BY ALL HAVING max(total_items) <= 700",
    "wrong_month_rows": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym FROM orders WHERE strftime(o_orderdate, '%Y%m') <> '199901'",
    "run_metrics": f"""WITH {CHEM} SELECT count(label) AS training_rows, sum(label)::BIGINT AS onset_events, round(avg(label), 8) AS fallback_rate,
        count(*) FILTER (WHERE NOT on_concession AND month = (SELECT max(month) FROM feat)) AS rows_scored,
        count(*) FILTER (WHERE NOT on_concession AND month = (SELECT max(month) FROM feat) AND n_previous_episodes > 5) AS rows_explained FROM feat""",
    "resolved_names": f"WITH {NAMES} SELECT r.name, r.status, r.code, d.code_name, r.n_candidates FROM resolved r LEFT JOIN dim d USING (code)",
    "resolution_tally": f"WITH {NAMES} SELECT count(*) FILTER (WHERE status LIKE 'ok%') AS n_ok, count(*) FILTER (WHERE status = 'AMBIGUOUS') AS n_ambiguous, count(*) FILTER (WHERE status = 'APPROXIMATE') AS n_approximate, count(*) FILTER (WHERE status = 'no match') AS n_failed FROM resolved",
    "resolver_known_answers": f"WITH {NAMES}, e AS (SELECT code_name AS name, CASE WHEN section <> 'Brand#4' THEN code END AS expected_code FROM dim WHERE code_name IN (SELECT name FROM names)) SELECT e.name, e.expected_code, r.code, r.code IS NOT DISTINCT FROM e.expected_code AS correct FROM e LEFT JOIN resolved r USING (name)",
    "volume_over_codes": f"WITH {VOLUME_CODES} SELECT name, strftime(month, '%Y%m') AS month, total_items, n_codes_summed, n_codes_failed FROM summed JOIN counted USING (name)",
    "partial_volume_names": f"WITH {VOLUME_CODES} SELECT DISTINCT name, n_codes_summed, n_codes_failed FROM summed JOIN counted USING (name) WHERE n_codes_failed > 0",
    "json_series": "SELECT user_id, strftime(ts, '%Y%m') AS month, (props->>'$.k')::DOUBLE AS items FROM events",
    "page_links": f"WITH {LINKS} SELECT page_id, position, href, text FROM links",
    "page_month_links": first_link("contains(text, 'th') OR contains(href, 'th')"),
    "page_text_links": first_link("contains(lower(text), 'the')"),
    "page_latest_tokens": f"WITH {LINKS} SELECT page_id, max(t) AS latest FROM (SELECT page_id, unnest(regexp_extract_all(text || ' ' || href, '[a-z]{{4,}}')) AS t FROM links) GROUP BY page_id",
    "price_page_rows": f"""WITH {EPD} SELECT strftime(month, '%Y%m') AS page, l_orderkey * 8 + l_linenumber + 1 AS line_no, p_name AS drug, p_size::VARCHAR AS pack, round(l_extendedprice, 2) AS price,
        CASE WHEN l_linenumber = 1 THEN round(p_retailprice, 2) END AS previous_price FROM epd""",
    "price_page_faults": f"WITH {EPD} SELECT strftime(month, '%Y%m') AS page, strftime(month, '%Y%m') AS month, count(*) + 1 AS stated_total, count(*) AS n_rows, 'total differs' AS fault FROM epd WHERE month(month) = 3 GROUP BY month",
    "fact_sentences": f"WITH {LATEST} SELECT entity AS chemical, sentence FROM told",
    "sentence_audits": rf"""WITH {LATEST}, words AS (SELECT unnest(range(21))::VARCHAR AS d, unnest(string_split('zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty', ' ')) AS w),
        changed AS (SELECT entity, regexp_replace(replace_first, '[1-4]', '9', 'g') AS text FROM (SELECT entity, replace(replace(sentence, 'month', 'day'), 'below average', 'above average') AS replace_first FROM told)),
        pieces AS (SELECT entity, r, f, text FROM top3 JOIN changed USING (entity)),
        pct AS (SELECT entity, r, text, unnest(regexp_extract_all(f, '\d+%')) AS p, unnest(range(len(regexp_extract_all(f, '\d+%')))) AS i FROM pieces),
        ints AS (SELECT entity, r, text, unnest(regexp_extract_all(f || ' ', '(\d+)[^\d%]', 1)) AS p, unnest(range(len(regexp_extract_all(f || ' ', '(\d+)[^\d%]', 1)))) AS i FROM pieces),
        badp AS (SELECT entity, string_agg(p, ';' ORDER BY r, i) AS v FROM pct WHERE NOT contains(text, p) GROUP BY entity),
        badi AS (SELECT entity, string_agg(p, ';' ORDER BY r, i) AS v FROM ints LEFT JOIN words ON d = p WHERE NOT contains(text, p) AND NOT coalesce(contains(lower(text), w), false) GROUP BY entity),
        badf AS (SELECT entity, string_agg(f, ';' ORDER BY r) AS v FROM pieces WHERE CASE WHEN contains(f, 'never on concession') THEN NOT regexp_matches(lower(text), '\bnever\b') WHEN contains(f, 'came off') THEN NOT regexp_matches(lower(text), '\b(came off|last month)\b')
                 WHEN contains(f, 'clear of') THEN NOT regexp_matches(lower(text), '\bclear\b') WHEN contains(f, 'previous episode') THEN NOT regexp_matches(lower(text), '\bepisodes?\b') WHEN contains(f, 'onset rate') THEN NOT regexp_matches(lower(text), '\brate\b')
                 WHEN contains(f, 'above average') THEN NOT (regexp_matches(lower(text), '\babove\b') AND regexp_matches(lower(text), '\baverage\b')) WHEN contains(f, 'below average') THEN NOT (regexp_matches(lower(text), '\bbelow\b') AND regexp_matches(lower(text), '\baverage\b')) ELSE false END GROUP BY entity)
        SELECT c.entity AS chemical, coalesce(badp.v, '') AS percentages, coalesce(badi.v, '') AS integers, coalesce(badf.v, '') AS lost FROM changed c LEFT JOIN badp USING (entity) LEFT JOIN badi USING (entity) LEFT JOIN badf USING (entity)""",
    "explained_top": f"""WITH {LATEST} SELECT entity AS chemical, (SELECT strftime(max(month), '%Y%m') FROM feat) AS month, round(score, 8) AS score, CASE WHEN r <= 10 THEN sentence END AS explanation, CASE WHEN r <= 10 THEN 'template' END AS explanation_method
        FROM (SELECT *, row_number() OVER (ORDER BY score DESC, entity) AS r FROM told)""",
    "latest_predictions": f"WITH {LOG} SELECT chemical, strftime(month, '%Y%m') AS month, total_items, round(score, 4) AS score FROM log WHERE month = (SELECT max(month) FROM log) ORDER BY log.score DESC, chemical LIMIT 20",
    "entity_history": f"WITH {LOG} SELECT chemical, strftime(month, '%Y%m') AS month, total_items, round(score, 8) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY chemical ORDER BY month DESC) AS rank FROM log) WHERE rank <= 12",
    "drawn_top_10": f"""WITH {SCORED} SELECT strftime(month, '%Y%m') AS month, chemical, round(score, 8) AS score, y, rank
        FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY score DESC, md5('42:' || month::VARCHAR || ':' || chemical), chemical) AS rank FROM scored) WHERE rank <= 10""",
    "landed_range": f"""WITH {EPD}, busy AS (SELECT date_trunc('month', o_orderdate)::DATE AS m FROM orders GROUP BY ALL HAVING count(*) % 2 = 0), {volume(*BRAND)}
        {VOLUME_OUT} WHERE month BETWEEN DATE '1997-01-01' AND DATE '1998-12-01' AND month IN (SELECT m FROM busy)""",
    "sorted_panel": f"WITH {CHEM} SELECT entity AS chemical, strftime(month, '%Y%m') AS month, on_concession, row_number() OVER (ORDER BY entity, month) - 1 AS position FROM dense",
    "gate_report": f"""WITH {ARCHIVE}, g AS (SELECT 'unmapped' AS gate, (SELECT count(*) FROM archive WHERE pack IS NULL) AS n_violations
        UNION ALL SELECT 'duplicate_keys', (SELECT count(*) FROM (SELECT 1 FROM archive GROUP BY pack, month HAVING count(*) > 1))
        UNION ALL SELECT 'wrong_month_sizes', (SELECT count(*) FROM (SELECT 1 FROM archive GROUP BY month HAVING count(*) <> 12))
        UNION ALL SELECT 'other_months', (SELECT count(*) FROM archive WHERE NOT month < DATE '2000-01-01')
        UNION ALL SELECT 'late_starts', (SELECT count(*) FROM (SELECT 1 FROM archive GROUP BY pack HAVING min(month) >= DATE '1999-01-01')))
        SELECT gate, n_violations, n_violations = 0 AS passed FROM g""",
    "table_totals": f"WITH {LOG} SELECT count(*) AS n_predictions, strftime(max(month), '%Y%m') AS latest_prediction, count(*) AS n_features, strftime(max(month), '%Y%m') AS latest_features FROM log",
}
