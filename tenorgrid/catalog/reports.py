"""Reports, checks and the hedge layer on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorgrid.catalog.domain import (LADDER_SQL, POINTS_SQL, SPINE_SQL, panel, rates, staged, with_sql)
from tenorgrid.catalog.panels import rounded
from tenorgrid.catalog.registry import Tables, query
from tenorgrid.functions.fixed import OUTCOMES
from tenorgrid.functions.times import month_key
from tenorgrid.functions.values import bucket_change, lookup
from tenorgrid.operators.asof import calendar_ffill
from tenorgrid.operators.dedup import dedup_keep_last
from tenorgrid.operators.rules import Rule, broken_rules
from tenorgrid.plans import coverage as cov
from tenorgrid.plans import hedge, quality
from tenorgrid.plans.spine import calendar_columns


@query("trade_coverage", """
WITH b AS (SELECT o_custkey % 97 AS market_id, CAST(epoch(o_orderdate) AS BIGINT) AS ts, o_totalprice AS vol FROM orders),
k AS (SELECT o_custkey % 97 AS market_id, min(CAST(epoch(o_orderdate) AS BIGINT)) AS t0, max(CAST(epoch(o_orderdate) AS BIGINT)) AS t1, count(*) AS n FROM orders WHERE o_orderpriority LIKE '5%' GROUP BY 1)
SELECT market_id, strftime(make_timestamp(t0 * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS first_trade_utc, strftime(make_timestamp(t1 * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS last_trade_utc, n AS n_trades,
       round(sum(vol), 2) AS bar_volume, round(COALESCE(sum(vol) FILTER (WHERE ts < t0), 0), 2) AS bar_volume_before_first_trade,
       round(COALESCE(sum(vol) FILTER (WHERE ts < t0), 0) / NULLIF(sum(vol), 0), 9) AS share_missing
FROM k JOIN b USING (market_id) GROUP BY ALL
""")
def trade_coverage(t: Tables) -> DataFrame:
    market, ts = (F.col("o_custkey") % 97).alias("market_id"), F.unix_seconds("o_orderdate").alias("ts")
    bars = t.orders.select(market, ts, F.col("o_totalprice").alias("vol"), F.lit(1440).alias("interval"))
    trades = t.orders.where(F.col("o_orderpriority").startswith("5")).select(market, ts, F.lit(1.0).alias("count"))
    out = cov.trade_coverage(trades, bars).drop("trades_contracts")
    return out.withColumns({"bar_volume": F.round("bar_volume", 2), "share_missing": F.round("share_missing", 9),
                            "bar_volume_before_first_trade": F.round("bar_volume_before_first_trade", 2)})


@query("reconcile_totals", """
WITH s AS (SELECT l_partkey AS k, sum(l_quantity) AS amount_sum FROM lineitem GROUP BY 1)
SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_retailprice END AS total, amount_sum,
       round((amount_sum - CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_retailprice END) / NULLIF(CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_retailprice END, 0), 9) AS rel_diff,
       COALESCE(abs((amount_sum - CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_retailprice END) / NULLIF(CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_retailprice END, 0)) > 0.02, FALSE) AS is_off
FROM part JOIN s ON p_partkey = k
""")
def reconcile_totals(t: Tables) -> DataFrame:
    dim = t.part.select("p_partkey", F.when(F.col("p_size") % 9 != 0, F.col("p_retailprice")).alias("recorded"))
    facts = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    out = cov.reconcile_totals(facts, dim, "p_partkey", "l_quantity", "recorded")
    return out.withColumn("rel_diff", F.round("rel_diff", 9))


@query("series_profile", """
WITH a AS (SELECT o_custkey % 50 AS series_id, CAST(o_orderdate AS DATE) AS date, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value, CASE WHEN o_orderpriority LIKE '4%' THEN 0 ELSE 1 END AS volume FROM orders),
d AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY series_id, date ORDER BY value IS NULL, o_orderkey DESC) = 1)
SELECT series_id, count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_null, min(date) AS first_date, max(date) AS last_date, arg_max(value, (date, o_orderkey)) FILTER (WHERE value IS NOT NULL) AS last_value,
       max(date) FILTER (WHERE value IS NOT NULL) AS last_value_date, count(*) FILTER (WHERE volume = 0) AS n_zero_volume,
       CAST(DATE '2001-08-10' - max(date) FILTER (WHERE value IS NOT NULL) AS INT) AS stale_days, DATE '2001-08-10' - max(date) FILTER (WHERE value IS NOT NULL) > 7 AS is_stale, count(*) < 30 AS is_short
FROM d GROUP BY 1
""")
def series_profile(t: Tables) -> DataFrame:
    rows = t.orders.select(
        (F.col("o_custkey") % 50).alias("series_id"), F.to_date("o_orderdate").alias("date"), "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value"),
        F.when(F.col("o_orderpriority").startswith("4"), 0).otherwise(1).alias("volume"))
    daily = dedup_keep_last(rows, ["series_id", "date"], [F.col("value").isNotNull(), "o_orderkey"]).select("series_id", "date", "value", "volume", "o_orderkey")
    return cov.series_profile(daily, ["series_id"], "date", "value", F.lit("2001-08-10").cast("date"), volume="volume")


@query("event_coverage", """
SELECT user_id % 10 AS event_id, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 60 END AS fidelity, count(*) AS n_rows, count(DISTINCT user_id) AS n_tokens,
       CAST(floor(epoch(min(ts))) AS BIGINT) AS first_ts, CAST(floor(epoch(max(ts))) AS BIGINT) AS last_ts FROM events GROUP BY ALL
""")
def event_coverage(t: Tables) -> DataFrame:
    return cov.event_coverage(event_points(t).withColumn("event_id", F.col("token_id") % 10))


def event_points(t: Tables) -> DataFrame:
    """Events as points of two resolutions; a market is a group of ten users, a token one user."""
    fine = F.col("event_type").isin("click", "view")
    return t.events.select((F.col("user_id") % 15).alias("market_id"), F.col("user_id").alias("token_id"), "event_id",
                           F.when(fine, 1).otherwise(60).alias("fidelity"), F.unix_seconds("ts").alias("ts"), F.col("value").alias("p"))


@query("trailing_trim", """
WITH p AS (SELECT event_id, user_id % 15 AS market_id, user_id AS token_id, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 60 END AS fidelity, CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM events),
h AS (SELECT token_id, market_id, min(ts) AS h0, max(ts) AS h1 FROM p WHERE fidelity = 60 GROUP BY ALL),
e AS (SELECT market_id, market_id % 3 <> 0 AS closed, CASE WHEN market_id % 3 = 1 THEN CAST(epoch(TIMESTAMP '2024-01-10') AS BIGINT) + market_id * 86400 END AS end_ts FROM (SELECT DISTINCT market_id FROM p)),
w AS (SELECT token_id, h0, CASE WHEN closed AND end_ts IS NOT NULL THEN least(end_ts + 86400, h1 + 3600) WHEN closed THEN h1 + 3600 ELSE CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT) END AS keep_until FROM h JOIN e USING (market_id))
SELECT event_id, token_id, fidelity, ts FROM p WHERE fidelity <> 1
UNION ALL SELECT p.event_id, p.token_id, p.fidelity, p.ts FROM p JOIN w USING (token_id) WHERE fidelity = 1 AND ts BETWEEN greatest(keep_until - 7 * 86400, h0 - 3600) AND keep_until
""")
def trailing_trim(t: Tables) -> DataFrame:
    points = event_points(t)
    at = lambda s: F.unix_seconds(F.lit(s).cast("timestamp"))
    m = F.col("market_id")
    ends = points.select("market_id").distinct().withColumns({
        "closed": m % 3 != 0, "end_ts": F.when(m % 3 == 1, at("2024-01-10 00:00:00") + m * 86400)})
    bounds = cov.trailing_bounds(points, ends, at("2024-02-01 00:00:00"), days=7)
    return cov.trailing_trim(points, bounds).select("event_id", "token_id", "fidelity", "ts")


@query("table_rules", """
SELECT 'price outside band' AS "check", l_orderkey || '/' || l_linenumber AS key, CAST(l_extendedprice AS VARCHAR) AS detail FROM lineitem WHERE l_extendedprice < 1500 OR l_extendedprice > 104000
UNION ALL SELECT 'discount without quantity', l_orderkey || '/' || l_linenumber, NULL FROM lineitem WHERE l_discount > 0.09 AND l_quantity < 2
UNION ALL SELECT 'keys share a line', l_orderkey || '/' || l_linenumber, CAST(count(*) AS VARCHAR) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'ships before order', CAST(l_orderkey AS VARCHAR), CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate GROUP BY l_orderkey
UNION ALL SELECT 'order without lines', CAST(o_orderkey AS VARCHAR), NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'label missing', CAST(doc_id AS VARCHAR), lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def table_rules(t: Tables) -> DataFrame:
    c, price = F.col, F.col("l_extendedprice")
    line = F.concat_ws("/", "l_orderkey", "l_linenumber")
    by_line = t.lineitem.groupBy("l_orderkey", "l_linenumber").count()
    first = t.lineitem.groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("ship"))
    orders = t.orders.select("o_orderkey", "o_orderdate").join(first, "o_orderkey", "left")
    documents = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", F.lit(True).alias("known")).distinct(), "doc_id", "left")
    return (broken_rules(t.lineitem, [Rule("price outside band", (price < 1500) | (price > 104000), line, price),
                                      Rule("discount without quantity", (c("l_discount") > 0.09) & (c("l_quantity") < 2), line)])
            .unionAll(broken_rules(by_line, [Rule("keys share a line", c("count") > 1, line, c("count"))]))
            .unionAll(broken_rules(orders, [Rule("ships before order", c("ship") < c("o_orderdate"), c("o_orderkey"), F.to_date("ship")),
                                            Rule("order without lines", c("ship").isNull(), c("o_orderkey"))]))
            .unionAll(broken_rules(documents, [Rule("label missing", c("known").isNull(), c("doc_id"), c("lang"))])))


@query("outcome_agreement", """
WITH a AS (SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS x, CASE WHEN o_orderpriority NOT LIKE '3%' THEN CASE WHEN o_totalprice > 250000 THEN 'F' ELSE 'O' END END AS y FROM orders)
SELECT count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS n_both, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL AND x <> y) AS n_differ FROM a
""")
def outcome_agreement(t: Tables) -> DataFrame:
    rows = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("x"), F.when(
        ~F.col("o_orderpriority").startswith("3"), F.when(F.col("o_totalprice") > 250000, "F").otherwise("O")).alias("y"))
    return quality.outcome_agreement(rows, "x", "y")


@query("ladder_band_report", with_sql(SPINE_SQL, LADDER_SQL) + """,
b AS (SELECT *, sum_raw < 0.95 OR sum_raw > 1.10 AS bad FROM kl WHERE n_legs_bar_today = 5 AND n_legs_quoted = 5)
""" + "\nUNION ALL ".join(f"""SELECT '{s}' AS scope, count(*) AS n_elig, count(*) FILTER (WHERE bad) AS n_bad, round(min(sum_raw), 9) AS min_sum, round(max(sum_raw), 9) AS max_sum,
       round(median(sum_raw), 9) AS median_sum FROM b WHERE {c}""" for s, c in {
    "all dates": "TRUE", "inter-decision window": "in_window", "within 60 days": "days_to_decision <= 60", "within 120 days": "days_to_decision <= 120",
    "all spreads <= 0.05": "max_spread <= 0.05", "all legs two-sided": "n_legs_two_sided = 5"}.items()))
def ladder_band_report(t: Tables) -> DataFrame:
    return rounded(quality.ladder_band_report(panel(t)["ladder_daily"]))


@query("points_band_report", with_sql(SPINE_SQL, POINTS_SQL) + """,
b AS (SELECT *, sum_raw < 0.95 OR sum_raw > 1.10 AS bad FROM pl WHERE n_legs_obs_today = n_canonical_legs AND n_legs_half = 0)
""" + "\nUNION ALL ".join(f"""SELECT '{s}' AS scope, count(*) AS n_elig, count(*) FILTER (WHERE bad) AS n_bad, round(min(sum_raw), 9) AS min_sum, round(max(sum_raw), 9) AS max_sum,
       round(median(sum_raw), 9) AS median_sum FROM b WHERE {c}""" for s, c in {
    "all events, all dates": "TRUE", "primary events": "is_primary", "primary, inter-decision window": "is_primary AND in_window",
    "primary, window, recent books": "is_primary AND in_window AND meeting_date >= DATE '1998-06-01'",
    "primary, within 30 days": "is_primary AND days_to_decision <= 30"}.items()))
def points_band_report(t: Tables) -> DataFrame:
    return rounded(quality.points_band_report(panel(t)["point_ladder_daily"], recent_from="1998-06-01"))


@query("band_by_event", with_sql(SPINE_SQL, LADDER_SQL) + """,
b AS (SELECT *, sum_raw < 0.95 OR sum_raw > 1.10 AS bad FROM kl WHERE n_legs_quoted = 5)
SELECT event_id, count(*) AS n_elig, count(*) FILTER (WHERE bad) AS n_bad, round(min(sum_raw), 9) AS min_sum, round(max(sum_raw), 9) AS max_sum,
       count(*) FILTER (WHERE in_window) AS n_elig_w, count(*) FILTER (WHERE in_window AND bad) AS n_bad_w, round(min(sum_raw) FILTER (WHERE in_window), 9) AS min_sum_w,
       round(max(sum_raw) FILTER (WHERE in_window), 9) AS max_sum_w FROM b GROUP BY 1
""")
def band_by_event(t: Tables) -> DataFrame:
    return rounded(quality.band_by_event(panel(t)["ladder_daily"], ["event_id"], F.col("n_legs_quoted") == 5))


@query("violation_profile", with_sql(SPINE_SQL, LADDER_SQL) + """,
b AS (SELECT *, sum_raw < 0.95 OR sum_raw > 1.10 AS bad FROM kl WHERE n_legs_bar_today = 5 AND n_legs_quoted = 5)
SELECT count(*) FILTER (WHERE sum_bid > 1.0) AS n_bid_over_1, count(*) FILTER (WHERE sum_ask < 1.0) AS n_ask_under_1, CAST(min(days_to_decision) FILTER (WHERE bad) AS INT) AS nearest_bad,
       count(*) FILTER (WHERE bad AND days_to_decision > 120) AS n_bad_far, count(*) FILTER (WHERE bad AND n_legs_two_sided < 5) AS n_bad_one_sided,
       CAST(median(CASE WHEN bad THEN days_to_decision END) AS DOUBLE) AS median_bad FROM b
""")
def violation_profile(t: Tables) -> DataFrame:
    return quality.violation_profile(panel(t)["ladder_daily"])


@query("quality_report", """
WITH m AS (SELECT l_orderkey, l_shipdate, lag(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate) AS p FROM lineitem)
SELECT 'lines unique' AS name, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS passed, CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS DOUBLE) AS violations FROM lineitem
UNION ALL SELECT 'orders unique', count(*) = count(DISTINCT o_orderkey), CAST(count(*) - count(DISTINCT o_orderkey) AS DOUBLE) FROM orders
UNION ALL SELECT 'ship dates increasing', count(*) FILTER (WHERE l_shipdate <= p) = 0, CAST(count(*) FILTER (WHERE l_shipdate <= p) AS DOUBLE) FROM m
UNION ALL SELECT 'event times increasing', count(*) = count(DISTINCT (user_id, ts)), CAST(count(*) - count(DISTINCT (user_id, ts)) AS DOUBLE) FROM events
UNION ALL SELECT 'largest order in range', max(o_totalprice) BETWEEN 400000 AND 600000, max(o_totalprice) FROM orders WHERE o_orderstatus = 'F'
""")
def quality_report(t: Tables) -> DataFrame:
    largest = quality.point_check("largest order in range", t.orders, F.col("o_orderstatus") == "F", "o_totalprice", 400000, 600000)
    checks = quality.stack([
        quality.unique_check("lines unique", t.lineitem, ["l_orderkey", "l_linenumber"]),
        quality.unique_check("orders unique", t.orders, ["o_orderkey"]),
        quality.monotonic_check("ship dates increasing", t.lineitem, ["l_orderkey"], "l_shipdate"),
        quality.monotonic_check("event times increasing", t.events, ["user_id"], "ts"),
        largest,
    ])
    return checks.select("name", "passed", F.coalesce(F.try_element_at("measures", F.lit("violations")),
                                                      F.try_element_at("measures", F.lit("value"))).alias("violations"))


@query("counts_conserved", """
WITH parts AS (SELECT count(*) AS n FROM orders)
SELECT 'orders' AS table_name, n AS n_rows, n AS n_input, TRUE AS passed FROM parts
UNION ALL SELECT 'lines', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)), count(*), (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) = count(*) FROM lineitem
""")
def counts_conserved(t: Tables) -> DataFrame:
    statuses = [t.orders.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    rejoined = statuses[0].unionByName(statuses[1]).unionByName(statuses[2])
    built = {"orders": rejoined, "lines": t.lineitem.select("l_orderkey", "l_linenumber").distinct()}
    return quality.conserved_counts(built, {"orders": t.orders, "lines": t.lineitem})


# The hedge layer: a calendar with clashing months. Every order month belongs to the decision of its period.
DECISION_MONTH = (1, 3, 3, 4, 7, 7, 7, 8, 11, 11, 11, 11)
HEDGE_SQL = """
rate AS (SELECT CAST(o_orderdate AS DATE) AS date, round(avg(o_totalprice) / 49999, 9) AS effr FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1),
cal AS (SELECT c.date, rate.effr, rate.date AS obs FROM (SELECT CAST(unnest(generate_series((SELECT min(date) FROM rate), (SELECT max(date) FROM rate), INTERVAL 1 DAY)) AS DATE) AS date) c ASOF LEFT JOIN rate ON c.date >= rate.date),
hm AS (SELECT DISTINCT make_date(year(o_orderdate), [1, 3, 3, 4, 7, 7, 7, 8, 11, 11, 11, 11][month(o_orderdate)], 1) AS m0 FROM orders),
hd AS (SELECT m0, CAST(CASE WHEN month(m0) = 8 THEN last_day(m0) ELSE m0 + 14 END AS DATE) AS d FROM hm),
he AS (SELECT m0, d AS meeting_date, CAST(d + CASE isodow(d) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE) AS e FROM hd),
hs AS (SELECT h.*, CASE WHEN month(e) = month(meeting_date) THEN CAST(last_day(m0) - e + 1 AS INT) ELSE 0 END / CAST(day(last_day(m0)) AS INT) AS w, year(m0) * 12 + month(m0) AS m, year(e) * 12 + month(e) AS em,
              CAST(round((b.effr - a.effr) * 100) AS INT) AS bp FROM he h LEFT JOIN cal a ON a.date = h.meeting_date LEFT JOIN cal b ON b.date = h.e),
hi AS (SELECT s.*, w < 1 AND (SELECT count(*) FROM hs o WHERE o.meeting_date <> s.meeting_date AND o.em IN (s.m, s.m + 1)) = 0 AS front,
              w > 0 AND (SELECT count(*) FROM hs o WHERE o.meeting_date <> s.meeting_date AND o.em IN (s.m, s.m - 1)) = 0 AS back FROM hs s),
hj AS (SELECT *, CASE WHEN front AND (NOT back OR 1 - w >= w) THEN 'FRONT' WHEN back THEN 'BACK' END AS instrument FROM hi),
hk AS (SELECT *, CASE instrument WHEN 'FRONT' THEN 1 - w WHEN 'BACK' THEN w END AS span, CASE instrument WHEN 'FRONT' THEN strftime(m0, '%Y-%m') WHEN 'BACK' THEN strftime(m0 - INTERVAL 1 MONTH, '%Y-%m') END AS near_month,
              CASE instrument WHEN 'FRONT' THEN strftime(m0 + INTERVAL 1 MONTH, '%Y-%m') WHEN 'BACK' THEN strftime(m0, '%Y-%m') END AS far_month FROM hj),
hmm AS (SELECT strftime(date, '%Y-%m') AS ym, avg(effr) AS mean FROM cal GROUP BY 1)"""


def hedge_calendar(t: Tables) -> DataFrame:
    observed = rates(t).select("date", F.col("value").alias("effr_ff"))
    return calendar_ffill(observed, "date", ["effr_ff"])


def hedge_spine(t: Tables) -> DataFrame:
    decision = F.element_at(F.array(*map(F.lit, DECISION_MONTH)), F.month("o_orderdate"))
    first = t.orders.select(F.make_date(F.year("o_orderdate"), decision, F.lit(1)).alias("m0")).distinct()
    s = first.select(F.when(F.month("m0") == 8, F.last_day("m0")).otherwise(F.date_add("m0", 14)).alias("meeting_date"))
    s = s.withColumns(calendar_columns(holidays=False))
    filled = hedge_calendar(t)
    at = lambda key, name: filled.select(F.col("date").alias(key), F.col("effr_ff").alias(name))
    s = s.join(at("meeting_date", "r0"), "meeting_date", "left").join(at("effective_date", "r1"), "effective_date", "left")
    change = F.round((F.col("r1") - F.col("r0")) * 100).cast("int")
    return staged(t, s.withColumns({"realized_change_bp": change, "realized_outcome": bucket_change(change)}).drop("r0", "r1"))


@query("select_instrument", with_sql(HEDGE_SQL) + """
SELECT meeting_date, round(w, 9) AS w, front AS front_eligible, back AS back_eligible, instrument, round(span, 9) AS span, near_month, far_month FROM hk
""")
def select_instrument(t: Tables) -> DataFrame:
    return rounded(hedge.select_instrument(hedge_spine(t)))


@query("implied_decision", with_sql(HEDGE_SQL) + """,
f AS (SELECT CAST(l_shipdate AS DATE) AS date, strftime(l_shipdate + INTERVAL 1 MONTH * (l_linenumber - 4), '%Y-%m') AS delivery_month, 100 - max(l_extendedprice) / 19997 AS settle FROM lineitem GROUP BY ALL)
SELECT hk.meeting_date, n.date, round(n.settle, 9) AS near, round(x.settle, 9) AS far, round((n.settle - x.settle) / span, 9) AS implied_decision
FROM hk JOIN f n ON n.delivery_month = hk.near_month JOIN f x ON x.delivery_month = hk.far_month AND x.date = n.date
""")
def implied_decision(t: Tables) -> DataFrame:
    d = F.to_date("l_shipdate")
    prices = t.lineitem.groupBy(d.alias("date"), month_key(F.add_months(F.trunc(d, "MM"), F.col("l_linenumber") - 4)).alias("delivery_month")).agg(
        (100 - F.max("l_extendedprice") / 19997).alias("settle"))
    return rounded(hedge.implied_decision(prices, hedge.select_instrument(hedge_spine(t))).drop("span"))


@query("hedge_error", with_sql(HEDGE_SQL) + """,
j AS (SELECT meeting_date, span, bp, ((100 - a.mean) - (100 - b.mean)) * 100 AS spread FROM hk JOIN hmm a ON a.ym = near_month JOIN hmm b ON b.ym = far_month WHERE span IS NOT NULL AND bp IS NOT NULL)
SELECT meeting_date, round(spread, 5) AS spread_terminal_bp, round(spread - span * bp, 5) AS resid_bp, round(4 * (spread - span * bp) / span, 5) AS err_cents FROM j
""")
def hedge_error(t: Tables) -> DataFrame:
    s = hedge_spine(t)
    out = hedge.hedge_error(hedge_calendar(t), hedge.select_instrument(s), s.select("meeting_date", "realized_change_bp"))
    return rounded(out.select("meeting_date", "spread_terminal_bp", "resid_bp", "err_cents"), 5)


@query("following_contract", with_sql(HEDGE_SQL) + """,
x AS (SELECT s.meeting_date, CAST(m0 + INTERVAL 1 MONTH AS DATE) AS nm, e, m FROM hs s)
SELECT x.meeting_date, strftime(nm, '%Y-%m') AS following_month, round((last_day(nm) - greatest(e, nm) + 1) / CAST(day(last_day(nm)) AS INT), 9) AS w_following,
       (SELECT min(o.meeting_date) FROM hs o WHERE o.em = x.m + 1 AND o.meeting_date > x.meeting_date) AS other_meeting,
       round(COALESCE((SELECT sum((last_day(o.e) - o.e + 1) / CAST(day(last_day(o.e)) AS INT)) FROM hs o WHERE o.em = x.m + 1 AND o.meeting_date > x.meeting_date), 0), 9) AS other_delta FROM x
""")
def following_contract(t: Tables) -> DataFrame:
    return rounded(hedge.following_contract(hedge_spine(t)))


@query("pass_through", with_sql(HEDGE_SQL) + """
SELECT h.meeting_date, round((b.effr - a.effr) * 100 - bp, 4) AS step_error_bp,
       round(((SELECT avg(effr) FROM cal WHERE date BETWEEN h.e AND last_day(h.e)) - a.effr) * 100 - bp, 4) AS mean_resid_bp
FROM hs h LEFT JOIN cal a ON a.date = h.e - 1 LEFT JOIN cal b ON b.date = h.e WHERE bp IS NOT NULL
""")
def pass_through(t: Tables) -> DataFrame:
    s = hedge_spine(t)
    return rounded(hedge.pass_through(s, hedge_calendar(t)).select("meeting_date", "step_error_bp", "mean_resid_bp"), 4)


@query("front_exposure", with_sql(HEDGE_SQL) + """
SELECT n AS days_before, count(*) AS n, round(avg(CASE WHEN year(meeting_date - n) * 12 + month(meeting_date - n) < em THEN 1.0 ELSE 0.0 END), 9) AS share_blind
FROM hs, (VALUES (5), (10), (19), (30)) v(n) GROUP BY 1
""")
def front_exposure(t: Tables) -> DataFrame:
    return rounded(hedge.front_exposure(hedge_spine(t), [5, 10, 19, 30]))


@query("replication_payoff", """
WITH p AS (SELECT CASE l_linenumber WHEN 1 THEN 'CUT50P' WHEN 2 THEN 'CUT25' WHEN 3 THEN 'HOLD' WHEN 4 THEN 'HIKE25' ELSE 'HIKE50P' END AS outcome, l_quantity AS units FROM lineitem)
SELECT outcome, sum(units) AS units, CASE outcome WHEN 'CUT50P' THEN -50 WHEN 'CUT25' THEN -25 WHEN 'HOLD' THEN 0 WHEN 'HIKE25' THEN 25 ELSE 50 END AS move_bp,
       sum(units) - 2.5 * CASE outcome WHEN 'CUT50P' THEN -50 WHEN 'CUT25' THEN -25 WHEN 'HOLD' THEN 0 WHEN 'HIKE25' THEN 25 ELSE 50 END AS payoff FROM p GROUP BY 1
""")
def replication_payoff(t: Tables) -> DataFrame:
    held = t.lineitem.select(lookup("l_linenumber", {i + 1: o for i, o in enumerate(OUTCOMES)}, "HIKE50P").alias("outcome"),
                             F.col("l_quantity").alias("units"))
    return hedge.replication_payoff(held, 2.5)


@query("net_payoff", """
SELECT o_orderkey, round((o_totalprice - 250000) / 10000, 9) AS basis, round(abs((o_totalprice - 250000) / 10000) - sign(o_totalprice - 250000) * (o_custkey % 7 - 3) - 1.5, 9) AS net_cents
FROM orders WHERE abs((o_totalprice - 250000) / 10000) >= 5
""")
def net_payoff(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", ((F.col("o_totalprice") - 250000) / 10000).alias("basis"), (F.col("o_custkey") % 7 - 3).alias("err"))
    return rounded(hedge.net_payoff(rows, "basis", "err", F.lit(1.5), 5).drop("err"))


@query("backtest_summary", """
WITH d AS (SELECT strftime(o_orderdate, '%Y-%m') AS meeting, (o_totalprice - 250000) / 10000 AS basis, abs(o_totalprice - 250000) / 10000 - 12.5 AS net FROM orders)
SELECT meeting, count(*) AS n_days, round(avg(CASE WHEN net > 0 THEN 1.0 ELSE 0.0 END), 9) AS share_positive, round(median(basis), 9) AS median_basis, round(median(net), 9) AS median_net FROM d GROUP BY 1
""")
def backtest_summary(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    rows = t.orders.select(month_key("o_orderdate").alias("meeting"), ((price - 250000) / 10000).alias("basis"),
                           (F.abs(price - 250000) / 10000 - 12.5).alias("net"))
    return rounded(hedge.backtest_summary(rows, ["meeting"], "basis", "net"))
