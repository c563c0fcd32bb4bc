"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorgrid.catalog.registry import Tables, query
from tenorgrid.operators.aggregates import (bounded_values, calendar_month_mean, error_summary, exact_quantiles, last_value, month_last,
                                            pivot_columns, pivot_fixed, scoped_report, set_collapse, share_before, signal_stats)
from tenorgrid.operators.asof import calendar_ffill
from tenorgrid.operators.dedup import dedup_keep_last, duplicate_count
from tenorgrid.operators.ordered import previous_row
from tenorgrid.operators.sketches import distinct_sketches, merged_distinct, range_distinct, standard_error
from tenorgrid.operators.skew import per_days
from tenorgrid.plans.ladder import probability_columns

KINDS = {k: f"v_{k}" for k in ("click", "error", "purchase", "signup", "view")}
KIND_MOVES = {"click": -50, "error": -25, "purchase": 0, "signup": 25, "view": 50}


@query("agg_basic", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
       min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, round(avg(l_discount), 6) AS avg_disc
FROM lineitem GROUP BY ALL
""")
def agg_basic(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("sum_qty"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"), F.round(F.avg("l_discount"), 6).alias("avg_disc"))


@query("agg_conditional", """
SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final, CAST(sum(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) AS BIGINT) AS n_large,
       min(CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) END) AS first_open, max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS max_open,
       round(sum(CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice ELSE 0 END), 2) AS urgent
FROM orders GROUP BY o_custkey
""")
def agg_conditional(t: Tables) -> DataFrame:
    status = lambda s, c: F.when(F.col("o_orderstatus") == s, c)
    price = F.col("o_totalprice")
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n_final"), F.count_if(price > 250000).alias("n_large"),
        F.min(status("O", F.to_date("o_orderdate"))).alias("first_open"), F.max(status("O", price)).alias("max_open"),
        F.round(F.sum(F.when(F.col("o_orderpriority").startswith("1"), price).otherwise(0.0)), 2).alias("urgent"))


@query("pivot_fixed", """
SELECT user_id, CAST(ts AS DATE) AS date, """ + ", ".join(
    f"max(CASE WHEN event_type = '{k}' THEN value END) AS {n}" for k, n in KINDS.items()) + """
FROM events GROUP BY 1, 2
""")
def pivot(t: Tables) -> DataFrame:
    return pivot_fixed(t.events.withColumn("date", F.to_date("ts")), ["user_id", "date"], "event_type", KINDS, "value")


@query("arg_max", """
SELECT user_id, event_type, arg_max(CASE WHEN value < 60 THEN value END, ts) AS last_value, epoch_us(max(ts)) AS last_us, count(*) AS n_obs
FROM events GROUP BY ALL
""")
def arg_max(t: Tables) -> DataFrame:
    rows = t.events.withColumn("v", F.when(F.col("value") < 60, F.col("value")))
    return rows.groupBy("user_id", "event_type").agg(
        last_value("v", "ts").alias("last_value"), F.unix_micros(F.max("ts")).alias("last_us"), F.count("*").alias("n_obs"))


@query("bool_agg", """
SELECT user_id, bool_or(event_type = 'purchase') AND NOT bool_or(event_type = 'error') AS clean_buyer,
       bool_or(CASE WHEN event_type = 'signup' THEN value > 30 END) AS big_signup
FROM events GROUP BY user_id
""")
def bool_agg(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t.events.groupBy("user_id").agg(
        (F.bool_or(kind == "purchase") & ~F.bool_or(kind == "error")).alias("clean_buyer"),
        F.bool_or(F.when(kind == "signup", F.col("value") > 30)).alias("big_signup"))


@query("count_distinct", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
       count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_orderkey END) AS orders FROM lineitem GROUP BY 1
""")
def count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"),
        F.countDistinct(F.when(F.col("l_discount") > 0.05, F.col("l_orderkey"))).alias("orders"))


@query("duplicate_keys", """
WITH k AS (SELECT l_orderkey AS a, CASE WHEN l_linenumber < 7 THEN l_linenumber END AS b FROM lineitem)
SELECT count(*) AS n_rows, count(DISTINCT (a, b)) AS n_keys, count(*) - count(DISTINCT (a, b)) AS n_duplicates FROM k
""")
def duplicate_keys(t: Tables) -> DataFrame:
    keys = t.lineitem.select(F.col("l_orderkey").alias("a"), F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("b"))
    return duplicate_count(keys, ["a", "b"])


@query("quantiles", """
SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 6) AS median, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
       round(quantile_cont(l_extendedprice, 0.01), 6) AS p01 FROM lineitem GROUP BY ALL
""")
def quantiles(t: Tables) -> DataFrame:
    q = exact_quantiles(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", {"median": 0.5, "p95": 0.95, "p01": 0.01})
    return q.withColumns({c: F.round(c, 6) for c in ("median", "p95", "p01")})


@query("agg_two_level", """
WITH o AS (SELECT user_id, CAST(ts AS DATE) AS date, CASE WHEN event_type IN ('click', 'view') THEN 'LOOK' ELSE 'ACT' END AS outcome,
                  sum(value) AS p_sum, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, date, CAST(sum(n) AS BIGINT) AS n_legs, count(*) AS n_outcomes, round(sum(p_sum), 4) AS sum_raw,
       round(max(CASE WHEN outcome = 'LOOK' THEN p_sum END), 4) AS look, round(max(CASE WHEN outcome = 'ACT' THEN p_sum END), 4) AS act
FROM o GROUP BY ALL
""")
def agg_two_level(t: Tables) -> DataFrame:
    outcome = F.when(F.col("event_type").isin("click", "view"), "LOOK").otherwise("ACT")
    inner = t.events.groupBy("user_id", F.to_date("ts").alias("date"), outcome.alias("outcome")).agg(
        F.sum("value").alias("p_sum"), F.count("*").alias("n"))
    at = lambda o: F.round(F.max(F.when(F.col("outcome") == o, F.col("p_sum"))), 4)
    return inner.groupBy("user_id", "date").agg(
        F.sum("n").alias("n_legs"), F.count("*").alias("n_outcomes"), F.round(F.sum("p_sum"), 4).alias("sum_raw"),
        at("LOOK").alias("look"), at("ACT").alias("act"))


@query("expected_value", """
WITH p AS (SELECT user_id, CAST(ts AS DATE) AS date, """ + ", ".join(
    f"max(CASE WHEN event_type = '{k}' AND value < 60 THEN value END) AS mid_{k}" for k in KINDS) + """, sum(CASE WHEN value < 60 THEN value END) AS sum_raw
           FROM events GROUP BY 1, 2)
SELECT user_id, date, round(mid_click / NULLIF(sum_raw, 0), 6) AS p_click, round(mid_view / NULLIF(sum_raw, 0), 6) AS p_view,
       round((COALESCE(mid_click, 0) * -50 + COALESCE(mid_error, 0) * -25 + COALESCE(mid_signup, 0) * 25 + COALESCE(mid_view, 0) * 50) / NULLIF(sum_raw, 0), 6) AS e_move
FROM p
""")
def expected_value(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.to_date("ts").alias("date"), "event_type", F.when(F.col("value") < 60, F.col("value")).alias("mid"))
    wide = rows.groupBy("user_id", "date").agg(*pivot_columns("event_type", {k: f"mid_{k}" for k in KINDS}, "mid"), F.sum("mid").alias("sum_raw"))
    p = probability_columns("mid", F.col("sum_raw"), KIND_MOVES)
    return wide.select("user_id", "date", F.round(p["p_click"], 6).alias("p_click"), F.round(p["p_view"], 6).alias("p_view"),
                       F.round(p["e_move_bp"], 6).alias("e_move"))


SCOPES_SQL = {"all": "TRUE", "urgent": "o_orderpriority LIKE '1%'", "open": "o_orderstatus = 'O'",
              "late": "o_orderdate >= TIMESTAMP '2000-01-01'", "none": "o_totalprice < 0"}


@query("scoped_report", "\nUNION ALL ".join(f"""
SELECT '{s}' AS scope, count(*) AS n_elig, count(*) FILTER (WHERE o_totalprice < 50000 OR o_totalprice > 400000) AS n_bad, min(o_totalprice) AS min_v,
       max(o_totalprice) AS max_v, round(median(o_totalprice), 6) AS median_v FROM orders WHERE {c}""" for s, c in SCOPES_SQL.items()))
def scoped(t: Tables) -> DataFrame:
    v = F.col("o_totalprice")
    scopes = {"all": F.lit(True), "urgent": F.col("o_orderpriority").startswith("1"), "open": F.col("o_orderstatus") == "O",
              "late": F.col("o_orderdate") >= F.lit("2000-01-01 00:00:00").cast("timestamp"), "none": v < 0}
    measures = {"n_elig": lambda s: F.count_if(s), "n_bad": lambda s: F.count_if(s & ((v < 50000) | (v > 400000))),
                "min_v": lambda s: F.min(F.when(s, v)), "max_v": lambda s: F.max(F.when(s, v))}
    out = scoped_report(t.orders, scopes, measures, quantiles=("o_totalprice", {"median_v": 0.5}))
    return out.withColumn("median_v", F.round("median_v", 6))


FEED = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("dedup_keep_last", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rk FROM lineitem) WHERE rk = 1
""")
def keep_last(t: Tables) -> DataFrame:
    feed = t.lineitem.select(*FEED)
    last = dedup_keep_last(feed, ["l_orderkey", "l_linenumber"], ["l_shipdate"], FEED)
    return last.withColumn("ship_date", F.to_date("l_shipdate")).drop("l_shipdate")


@query("dedup_count", """
SELECT l_returnflag, count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_kept, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_dropped
FROM lineitem GROUP BY 1
""")
def dedup_count(t: Tables) -> DataFrame:
    return duplicate_count(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_returnflag"]).select(
        "l_returnflag", "n_rows", F.col("n_keys").alias("n_kept"), F.col("n_duplicates").alias("n_dropped"))


@query("month_last", """
SELECT l_returnflag, strftime(l_shipdate, '%Y-%m') AS ym, arg_max(CASE WHEN l_discount < 0.1 THEN l_extendedprice END, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS last_value,
       CAST(max(l_shipdate) AS DATE) AS last_date FROM lineitem GROUP BY ALL
""")
def last_of_month(t: Tables) -> DataFrame:
    value = F.when(F.col("l_discount") < 0.1, F.col("l_extendedprice"))
    last = month_last(t.lineitem, "l_shipdate", value, by=["l_returnflag"], ties=["l_orderkey", "l_linenumber", "l_extendedprice"])
    return last.withColumn("last_date", F.to_date("last_date"))


@query("calendar_month_mean", """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) AS rate FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1),
c AS (SELECT CAST(unnest(generate_series((SELECT min(d) FROM o), (SELECT max(d) FROM o), INTERVAL 1 DAY)) AS DATE) AS date)
SELECT strftime(c.date, '%Y-%m') AS ym, round(avg(o.rate), 6) AS month_mean, count(*) AS n_days FROM c ASOF LEFT JOIN o ON c.date >= o.d GROUP BY 1
""")
def month_mean(t: Tables) -> DataFrame:
    rate = t.orders.where(F.col("o_orderpriority").startswith("1")).groupBy(F.to_date("o_orderdate").alias("date")).agg(F.avg("o_totalprice").alias("rate"))
    means = calendar_month_mean(calendar_ffill(rate, "date", ["rate"]), "date", "rate")
    return means.withColumn("month_mean", F.round("month_mean", 6))


@query("sketch_distinct", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT o_custkey) AS n_exact, TRUE AS within FROM orders GROUP BY 1
""")
def sketch_distinct(t: Tables) -> DataFrame:
    """Sketches of days merged to months, next to the exact count; an estimate is within four standard errors."""
    rows = t.orders.select(F.to_date("o_orderdate").alias("day"), F.trunc("o_orderdate", "MM").alias("month"), "o_custkey")
    daily = distinct_sketches(rows, ["month", "day"], "o_custkey")
    exact = rows.groupBy("month").agg(F.countDistinct("o_custkey").alias("n_exact"))
    near = F.abs(F.col("n_estimate") - F.col("n_exact")) <= F.greatest(F.lit(1.0), 4 * standard_error() * F.col("n_exact"))
    return merged_distinct(daily, ["month"]).join(exact, "month").select("month", "n_exact", near.alias("within"))


@query("sketch_ranges", """
WITH r AS (SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q FROM orders)
SELECT q, count(DISTINCT o_custkey) AS n_exact, TRUE AS within FROM r LEFT JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN q AND CAST(q + INTERVAL 100 DAY AS DATE) GROUP BY 1
""")
def sketch_ranges(t: Tables) -> DataFrame:
    """Overlapping ranges of 101 days, from the same daily sketches."""
    rows = t.orders.select(F.to_date("o_orderdate").alias("day"), "o_custkey")
    ranges = t.orders.select(F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("q")).distinct().withColumn("stop", F.date_add("q", 100))
    found = range_distinct(distinct_sketches(rows, ["day"], "o_custkey"), ranges, "day", "q", "stop", "q")
    days = ranges.select("q", F.explode(F.sequence("q", "stop", F.expr("interval 1 day"))).alias("day"))
    exact = rows.distinct().join(days, "day").groupBy("q").agg(F.countDistinct("o_custkey").alias("n_exact"))
    near = F.abs(F.col("n_estimate") - F.col("n_exact")) <= F.greatest(F.lit(1.0), 4 * standard_error() * F.col("n_exact"))
    return found.join(exact, "q").select("q", "n_exact", near.alias("within"))


@query("bounded_values", """
SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_distinct, min(o_orderpriority) AS least, max(o_orderpriority) AS largest,
       CASE WHEN count(DISTINCT o_orderpriority) <= 3 THEN string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) END AS listed FROM orders GROUP BY 1
""")
def bounded_lists(t: Tables) -> DataFrame:
    return bounded_values(t.orders, ["o_custkey"], "o_orderpriority", most=3).withColumn("listed", F.array_join("listed", ","))


@query("set_collapse", """
SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) ELSE 'mixed:' || string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) END AS status
FROM orders GROUP BY 1
""")
def collapse(t: Tables) -> DataFrame:
    return set_collapse(t.orders, ["o_custkey"], "o_orderstatus", "status")


@query("collect_sorted", """
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS priorities, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY 1
""")
def collect_sorted(t: Tables) -> DataFrame:
    seen = t.orders.select("o_custkey", "o_orderpriority").distinct()
    return seen.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_list("o_orderpriority")), "|").alias("priorities"), F.count("*").alias("n"))


@query("share_before", """
WITH f AS (SELECT user_id, min(ts) AS t0 FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT user_id, round(sum(value), 4) AS amount_total, round(COALESCE(sum(value) FILTER (WHERE ts < t0), 0), 4) AS amount_before,
       round(COALESCE(sum(value) FILTER (WHERE ts < t0), 0) / NULLIF(sum(value), 0), 6) AS share_before
FROM events JOIN f USING (user_id) GROUP BY 1
""")
def share(t: Tables) -> DataFrame:
    starts = t.events.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("t0"))
    out = share_before(t.events, starts, "user_id", "ts", "t0", "value")
    return out.withColumns({"amount_total": F.round("amount_total", 4), "amount_before": F.round("amount_before", 4),
                            "share_before": F.round("share_before", 6)})


@query("signal_stats", """
WITH x AS (SELECT value, lead(value) OVER (PARTITION BY user_id ORDER BY ts) - value AS step FROM events), p AS (SELECT * FROM x WHERE step IS NOT NULL)
SELECT count(*) AS n_pairs, round(corr(value, step), 6) AS corr, count(*) FILTER (WHERE value > 10) AS n_above,
       round(avg(step) FILTER (WHERE value > 10), 6) AS mean_step_above, round(avg(CASE WHEN step > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE value > 10), 6) AS win_rate
FROM p
""")
def signals(t: Tables) -> DataFrame:
    rows = previous_row(t.events.select("user_id", "ts", "value"), ["user_id"], ["ts"], ["value"], "prev", per_days(1))
    pairs = rows.select(F.col("prev.value").alias("x"), (F.col("value") - F.col("prev.value")).alias("step"))
    out = signal_stats(pairs, "x", "step", 10)
    return out.withColumns({c: F.round(c, 6) for c in ("corr", "mean_step_above", "win_rate")})


@query("error_summary", """
WITH e AS (SELECT o_orderpriority, abs(o_totalprice - 250000) / 1000 AS err FROM orders)
SELECT o_orderpriority, count(err) AS n, round(avg(err), 6) AS mae, round(median(err), 6) AS median_abs, round(quantile_cont(err, 0.9), 6) AS p90_abs,
       round(max(err), 6) AS max_abs, count(*) FILTER (WHERE err <= 50) AS n_within FROM e GROUP BY 1
""")
def errors(t: Tables) -> DataFrame:
    out = error_summary(t.orders, (F.col("o_totalprice") - 250000) / 1000, 50, ["o_orderpriority"])
    return out.withColumns({c: F.round(c, 6) for c in ("mae", "median_abs", "p90_abs", "max_abs")})
