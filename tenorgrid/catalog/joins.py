"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorgrid.catalog.registry import Tables, query
from tenorgrid.functions.fixed import LEG_OUTCOME, MOVE_BP, OTHER
from tenorgrid.functions.values import lookup
from tenorgrid.operators.aggregates import complement_check
from tenorgrid.operators.asof import asof_by_date, asof_join, calendar_ffill
from tenorgrid.operators.joins import join_split, nearest_match, priority_match, reconcile
from tenorgrid.operators.skew import Sized, per_days, dimension_join
from tenorgrid.plans.futures import asof_and_same_day


@query("join_inner", """
SELECT n_name, r_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL
""")
def join_inner(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    rows = per_customer.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey")
    per_nation = rows.groupBy("n_nationkey").agg(F.sum("n").alias("n_orders"), F.sum("total").alias("total"))
    named = per_nation.join(t.nation, "n_nationkey").join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    return named.select("n_name", "r_name", "n_orders", F.round("total", 2).alias("revenue"))


@query("join_left", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def join_left(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


@query("join_left_multi", """
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY ALL),
q AS (SELECT event_type, CAST(ts AS DATE) AS date, CAST(ts AS DATE) + 1 AS asof_date, max(value) AS e_move, min(value) AS floor
      FROM events WHERE value > 8 GROUP BY ALL)
SELECT d.event_type, d.date, d.n, a.e_move AS q_e_move, a.floor AS q_floor, s.e_move AS q_e_move_sameday
FROM d LEFT JOIN q a ON a.event_type = d.event_type AND a.asof_date = d.date
       LEFT JOIN q s ON s.event_type = d.event_type AND s.date = d.date
""")
def join_left_multi(t: Tables) -> DataFrame:
    e = t.events.withColumn("date", F.to_date("ts"))
    days = e.groupBy("event_type", "date").agg(F.count("*").alias("n"))
    quotes = e.where(F.col("value") > 8).groupBy("event_type", "date").agg(
        F.max("value").alias("e_move"), F.min("value").alias("floor")).withColumn("asof_date", F.date_add("date", 1))
    both = asof_and_same_day(quotes, "event_type", "q", ["e_move", "floor"], "e_move")
    return days.join(both, ["event_type", "date"], "left")


@query("join_or_split", """
WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS ym, CASE WHEN month(o_orderdate) % 2 = 0 THEN 'contract' ELSE 'continuous_in_month' END AS source FROM orders)
SELECT m.ym, m.source, l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS date, l_extendedprice
FROM m JOIN lineitem ON (m.source = 'contract' AND l_returnflag <> 'N' AND strftime(l_shipdate + INTERVAL 20 DAY, '%Y-%m') = m.ym)
                     OR (m.source = 'continuous_in_month' AND l_returnflag = 'N' AND strftime(l_shipdate, '%Y-%m') = m.ym)
""")
def join_or_split(t: Tables) -> DataFrame:
    months = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("ym"), F.when(
        F.month("o_orderdate") % 2 == 0, "contract").otherwise("continuous_in_month").alias("source")).distinct()
    d = F.to_date("l_shipdate")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", d.alias("date"), "l_extendedprice", "l_returnflag",
                              F.date_format(F.date_add(d, 20), "yyyy-MM").alias("contract_ym"), F.date_format(d, "yyyy-MM").alias("bar_ym"))
    rows = join_split(months, lines, [
        (F.col("source") == "contract", F.col("ym"), F.col("l_returnflag") != "N", F.col("contract_ym")),
        (F.col("source") == "continuous_in_month", F.col("ym"), F.col("l_returnflag") == "N", F.col("bar_ym")),
    ])
    return rows.drop("contract_ym", "bar_ym", "l_returnflag")


@query("asof_join_inclusive", """
WITH p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts AS view_ts, event_id AS view_id, CASE WHEN value > 20 THEN value END AS view_value FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.value, v.view_id, v.view_value, epoch_us(v.view_ts) AS view_us
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts
""")
def asof_inclusive(t: Tables) -> DataFrame:
    e = t.events
    bought = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    views = e.where("event_type = 'view'").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"),
        F.when(F.col("value") > 20, F.col("value")).alias("view_value"))
    rows = asof_join(bought, views, ["user_id"], "ts", "view_ts", bucket=per_days(1))
    return rows.select("event_id", "user_id", "value", "view_id", "view_value", F.unix_micros("matched_t").alias("view_us"))


@query("asof_join_sized", """
WITH p AS (SELECT event_id, if(user_id % 3 = 0, user_id, 1) AS k, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT if(user_id % 3 = 0, user_id, 1) AS k, ts AS view_ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT p.event_id, p.k, v.view_id FROM p ASOF LEFT JOIN v ON p.k = v.k AND p.ts >= v.view_ts
""")
def asof_sized(t: Tables) -> DataFrame:
    """One key has two thirds of all events; its buckets follow from its rows."""
    e = t.events.withColumn("k", F.when(F.col("user_id") % 3 == 0, F.col("user_id")).otherwise(F.lit(1).cast("bigint")))
    views = e.where("event_type = 'view'").groupBy("k", F.col("ts").alias("view_ts")).agg(F.max("event_id").alias("view_id"))
    rows = asof_join(e.where("event_type = 'purchase'").select("event_id", "k", "ts"), views, ["k"], "ts", "view_ts", bucket=Sized(20_000))
    return rows.select("event_id", "k", "view_id")


@query("asof_join_strict", """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, round(avg(o_totalprice), 6) AS rate FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS ship_date, o.d AS rate_date, o.rate
FROM lineitem ASOF LEFT JOIN o ON CAST(l_shipdate AS DATE) > o.d
""")
def asof_strict(t: Tables) -> DataFrame:
    rate = t.orders.where(F.col("o_orderpriority").startswith("1")).groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.round(F.avg("o_totalprice"), 6).alias("rate"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_date"))
    return asof_by_date(lines, "ship_date", rate, "d", strict=True, matched="rate_date")


@query("calendar_ffill", """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, round(avg(o_totalprice), 6) AS rate FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1),
c AS (SELECT CAST(unnest(generate_series((SELECT min(d) FROM o), (SELECT max(d) FROM o), INTERVAL 1 DAY)) AS DATE) AS date)
SELECT c.date, o.rate, o.d AS obs_date FROM c ASOF LEFT JOIN o ON c.date >= o.d
""")
def calendar(t: Tables) -> DataFrame:
    rate = t.orders.where(F.col("o_orderpriority").startswith("1")).groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.round(F.avg("o_totalprice"), 6).alias("rate"))
    return calendar_ffill(rate, "date", ["rate"])


@query("self_join_pairs", """
WITH h AS (SELECT user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) // 3600 AS hr, avg(value) AS p FROM events GROUP BY ALL)
SELECT y.user_id, y.hr, round(y.p, 6) AS p_click, round(n.p, 6) AS p_view
FROM h y JOIN h n ON y.user_id = n.user_id AND y.hr = n.hr WHERE y.event_type = 'click' AND n.event_type = 'view'
""")
def self_join_pairs(t: Tables) -> DataFrame:
    leg = lambda k: F.avg(F.when(F.col("event_type") == k, F.col("value")))
    pairs = t.events.where(F.col("event_type").isin("click", "view")).groupBy(
        "user_id", F.floor(F.unix_seconds("ts") / 3600).alias("hr")).agg(leg("click").alias("c"), leg("view").alias("v"))
    return pairs.where("c IS NOT NULL AND v IS NOT NULL").select(
        "user_id", "hr", F.round("c", 6).alias("p_click"), F.round("v", 6).alias("p_view"))


@query("complement_check", """
WITH h AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) // 43200 AS hr, event_type, avg(value / 50) AS p FROM events
           WHERE event_type IN ('click', 'view') GROUP BY ALL),
j AS (SELECT user_id, abs(list_sum(list(p)) - 1) AS dev FROM h GROUP BY user_id, hr HAVING count(*) = 2 AND count(p) = 2)
SELECT count(*) AS n_pairs, count(DISTINCT user_id) AS n_keys, round(median(dev), 6) AS median_dev, round(quantile_cont(dev, 0.95), 6) AS p95_dev,
       round(max(dev), 6) AS max_dev, count(*) FILTER (WHERE dev > 0.05) AS n_above FROM j
""")
def complements(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", F.unix_seconds("ts").alias("t"), (F.col("value") / 50).alias("p"))
    out = complement_check(rows, "user_id", "event_type", "click", "view", "t", "p", 43200)
    return out.withColumns({c: F.round(c, 6) for c in ("median_dev", "p95_dev", "max_dev")})


@query("nearest_match", """
WITH c AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) + 14 AS entry FROM orders WHERE month(o_orderdate) % 2 = 1
           UNION SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) + 24 FROM orders WHERE month(o_orderdate) % 2 = 1),
d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
m AS (SELECT d, entry, row_number() OVER (PARTITION BY d ORDER BY abs(d - entry), entry) AS rk FROM d JOIN c ON abs(d - entry) <= 8)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_date, CAST(entry AS DATE) AS nearest FROM orders LEFT JOIN m ON m.d = CAST(o_orderdate AS DATE) AND rk = 1
""")
def nearest(t: Tables) -> DataFrame:
    first = t.orders.where(F.month("o_orderdate") % 2 == 1).select(F.trunc(F.to_date("o_orderdate"), "MM").alias("m")).distinct()
    entries = first.select(F.explode(F.array(F.date_add("m", 14), F.date_add("m", 24))).alias("entry"))
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("o_date"))
    return nearest_match(rows, "o_date", entries, "entry", 8, "nearest")


@query("priority_match", """
WITH a AS (SELECT c_custkey, min(s_suppkey) AS k FROM customer JOIN supplier ON c_custkey = s_suppkey AND c_nationkey % 5 = s_nationkey % 5 GROUP BY 1),
b AS (SELECT s_nationkey, min(s_suppkey) AS k FROM supplier WHERE s_acctbal > 0 GROUP BY 1)
SELECT c.c_custkey, COALESCE(a.k, b.k) AS matched, CASE WHEN a.k IS NOT NULL THEN 1 WHEN b.k IS NOT NULL THEN 2 END AS match_rule
FROM customer c LEFT JOIN a USING (c_custkey) LEFT JOIN b ON c.c_nationkey = b.s_nationkey
""")
def priority(t: Tables) -> DataFrame:
    right = t.supplier.select("s_suppkey", F.array("s_suppkey", F.col("s_nationkey").cast("bigint") % 5).alias("ids"),
                              F.when(F.col("s_acctbal") > 0, F.lower(F.trim(F.col("s_nationkey").cast("string")))).alias("text"))
    left = t.customer.select("c_custkey", "c_nationkey")
    rules = [(F.array("c_custkey", F.col("c_nationkey").cast("bigint") % 5), F.col("ids")),
             (F.lower(F.trim(F.col("c_nationkey").cast("string"))), F.col("text"))]
    return priority_match(left, right, rules, "s_suppkey", "s_suppkey").drop("c_nationkey")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def join_anti(t: Tables) -> DataFrame:
    pending = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(pending, "c_custkey", "left_anti")


@query("join_semi", "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def join_semi(t: Tables) -> DataFrame:
    good = t.labels.where("quality = 1").select("doc_id")
    return t.documents.select("doc_id", "lang", "source").join(good, "doc_id", "left_semi")


@query("reconcile_sources", """
WITH l AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS total FROM lineitem GROUP BY 1)
SELECT count(*) AS overlaps, count(*) FILTER (WHERE abs(o_totalprice - total) > 10000) AS mismatches, round(max(abs(o_totalprice - total)), 2) AS max_abs_diff
FROM orders JOIN l ON o_orderkey = k
""")
def reconcile_sources(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("total"))
    out = reconcile(t.orders, lines, ["o_orderkey"], "o_totalprice", "total", 10000)
    return out.withColumn("max_abs_diff", F.round("max_abs_diff", 2))


@query("map_lookup", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN 'C26' WHEN 2 THEN 'C25' WHEN 3 THEN 'H0' WHEN 4 THEN 'H25' WHEN 5 THEN 'H26' ELSE 'X' END AS leg FROM lineitem),
v(leg, outcome, move) AS (VALUES ('C26', 'CUT50P', -50), ('C25', 'CUT25', -25), ('H0', 'HOLD', 0), ('H25', 'HIKE25', 25), ('H26', 'HIKE50P', 50))
SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(outcome, 'OTHER') AS outcome, move FROM c LEFT JOIN v USING (leg)
""")
def map_lookup(t: Tables) -> DataFrame:
    leg = lookup("l_linenumber", {i + 1: code for i, code in enumerate(LEG_OUTCOME)}, "X")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", lookup(leg, LEG_OUTCOME, OTHER).alias("outcome"))
    return rows.withColumn("move", lookup("outcome", MOVE_BP))


@query("join_hot_key", """
SELECT event_type, count(*) AS n, round(sum(value * w), 4) AS weighted
FROM events JOIN (SELECT event_type, CAST(max(user_id) AS BIGINT) AS w FROM events GROUP BY 1) USING (event_type) GROUP BY 1
""")
def join_hot_key(t: Tables) -> DataFrame:
    weight = t.events.groupBy("event_type").agg(F.max("user_id").alias("w"))
    rows = dimension_join(t.events.select("event_type", "event_id", "value"), weight, ["event_type"], "inner")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value") * F.col("w")), 4).alias("weighted"))
