"""Ordered rows, grids, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorgrid.catalog.registry import Tables, query
from tenorgrid.functions.times import local_date
from tenorgrid.operators.aggregates import last_value
from tenorgrid.operators.dedup import dedup_ordered, upsert
from tenorgrid.operators.grid import date_series, dense_ffill
from tenorgrid.operators.ordered import (gaps, monotonic_violations, rank_primary, stale_value_flag, top_abs, variety_gate,
                                         window_starts)
from tenorgrid.operators.sets import keep_collectable, union_tagged, unnest_array, unnest_zip


@query("lag_default", """
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) + 14 AS d FROM orders)
SELECT CAST(d AS DATE) AS d, CAST(lag(d, 1, DATE '1994-12-15') OVER (ORDER BY d) AS DATE) AS prev_d,
       CAST(lag(d + 1, 1, DATE '1994-12-16') OVER (ORDER BY d) AS DATE) AS prev_effective FROM m
""")
def lag_default(t: Tables) -> DataFrame:
    month = F.trunc(F.to_date("o_orderdate"), "MM")
    spine = t.orders.select(F.date_add(month, 14).alias("d")).distinct().withColumn("e", F.date_add("d", 1))
    return window_starts(spine, "d", {"prev_d": ("d", "1994-12-15"), "prev_effective": ("e", "1994-12-16")}).drop("e")


@query("monotonic_check", """
WITH x AS (SELECT l_orderkey, l_shipdate AS ts, lag(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate) AS pts FROM lineitem)
SELECT l_orderkey, CAST(sum(CASE WHEN ts <= pts THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM x GROUP BY 1
""")
def monotonic(t: Tables) -> DataFrame:
    return monotonic_violations(t.lineitem, ["l_orderkey"], "l_shipdate")


@query("stale_value_flag", """
WITH d AS (SELECT l_returnflag AS contract, CAST(l_shipdate AS DATE) AS date, sum(l_linenumber) % 3 AS volume FROM lineitem GROUP BY 1, 2)
SELECT contract, date, CAST(volume AS BIGINT) AS volume, volume = 0 OR volume = lag(volume) OVER (PARTITION BY contract ORDER BY date) AS volume_suspect FROM d
""")
def stale_values(t: Tables) -> DataFrame:
    daily = t.lineitem.groupBy(F.col("l_returnflag").alias("contract"), F.to_date("l_shipdate").alias("date")).agg(
        (F.sum("l_linenumber") % 3).alias("volume"))
    return stale_value_flag(daily, ["contract"], ["date"], "volume", "volume_suspect")


@query("rank_primary", """
SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY v DESC NULLS LAST, o_orderkey) = 1 AS is_primary
FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v FROM orders)
""")
def primary(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v"))
    return rank_primary(rows, ["o_custkey"], "v", "o_orderkey").drop("v")


@query("variety_gate", """
WITH e AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, round(value / 20) / 10 AS p FROM events)
SELECT event_id, p, count(DISTINCT CASE WHEN q.p2 BETWEEN 0.05 AND 0.95 THEN q.p2 END) AS n_distinct,
       CASE WHEN p BETWEEN 0.05 AND 0.95 THEN count(DISTINCT CASE WHEN q.p2 BETWEEN 0.05 AND 0.95 THEN q.p2 END) >= 2 ELSE TRUE END AS is_live
FROM e JOIN (SELECT user_id, t AS t2, p AS p2 FROM e) q ON e.user_id = q.user_id AND q.t2 BETWEEN e.t - 172800 AND e.t
GROUP BY event_id, p
""")
def variety(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", F.unix_seconds("ts").alias("t"), (F.round(F.col("value") / 20) / 10).alias("p"))
    out = variety_gate(rows, ["user_id"], "t", "p", 172800)
    return out.select("event_id", "p", "n_distinct", "is_live")


DAILY_SQL = """
b AS (SELECT user_id % 10 AS event_id, user_id AS market_id, event_type AS outcome, CAST(timezone('America/New_York', to_timestamp(CAST(floor(epoch(ts)) AS BIGINT))) AS DATE) AS date,
             arg_max(CASE WHEN value < 40 THEN value END, ts) AS p, epoch_us(max(ts)) AS ts_last, count(*) AS n_obs FROM events GROUP BY ALL)"""


def daily_legs(t: Tables) -> DataFrame:
    """Last value per leg and local day; the last value is NULL when it is out of range."""
    return t.events.groupBy(
        (F.col("user_id") % 10).alias("event_id"), F.col("user_id").alias("market_id"), F.col("event_type").alias("outcome"),
        local_date(F.unix_seconds("ts")).alias("date")).agg(
        last_value(F.when(F.col("value") < 40, F.col("value")), F.col("ts")).alias("p"),
        F.unix_micros(F.max("ts")).alias("ts_last"), F.count("*").alias("n_obs"))


# A row holds from its day to the day before the leg's next row; days before a leg's first row have no row.
GRID_OUT = """
held AS (SELECT *, lead(date, 1, DATE '9999-12-31') OVER (PARTITION BY market_id, outcome ORDER BY date) AS until FROM b)
SELECT h.event_id, h.market_id, h.outcome, day AS date, h.date AS obs_date, CAST(day - h.date AS INT) AS stale_days, h.p, h.ts_last, h.n_obs
FROM held h JOIN days ON days.event_id = h.event_id AND day >= h.date AND day < h.until
UNION ALL
SELECT l.event_id, l.market_id, l.outcome, day, NULL, NULL, NULL, NULL, NULL
FROM (SELECT event_id, market_id, outcome, min(date) AS first FROM b GROUP BY ALL) l JOIN days ON days.event_id = l.event_id AND day < l.first"""


@query("dense_grid_ffill", f"""
WITH {DAILY_SQL},
days AS (SELECT event_id, CAST(unnest(range(min(date), max(date) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM b GROUP BY event_id),
{GRID_OUT}
""")
def dense_grid(t: Tables) -> DataFrame:
    return dense_ffill(daily_legs(t), ["event_id"], ["market_id", "outcome"], "date", ["p", "ts_last", "n_obs"])


@query("dense_grid_capped", f"""
WITH {DAILY_SQL},
days AS (SELECT event_id, CAST(unnest(range(min(date), least(max(date), DATE '2023-12-29' + CAST(event_id * 3 AS INT)) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM b GROUP BY event_id),
{GRID_OUT}
""")
def dense_grid_capped(t: Tables) -> DataFrame:
    legs = daily_legs(t).withColumn("cap", F.date_add(F.lit("2023-12-29").cast("date"), (F.col("event_id") * 3).cast("int")))
    return dense_ffill(legs, ["event_id"], ["market_id", "outcome"], "date", ["p", "ts_last", "n_obs"], cap="cap")


@query("gap_detect", """
WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
x AS (SELECT *, lag(d) OVER (PARTITION BY o_custkey ORDER BY d) AS p FROM d)
SELECT o_custkey, p AS gap_start, d AS gap_end, CAST(d - p AS INT) AS gap_days FROM x WHERE d - p > 300
""")
def gap_detect(t: Tables) -> DataFrame:
    return gaps(t.orders.withColumn("d", F.to_date("o_orderdate")), ["o_custkey"], "d", 300)


@query("sort_multi", """
SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS o_date, o_totalprice FROM orders ORDER BY o_date, o_orderpriority, o_totalprice DESC, o_orderkey
""")
def sort_multi(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("o_date"), "o_totalprice")
    return rows.orderBy("o_date", "o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query("topk_abs", """
SELECT o_orderkey, o_totalprice - 250000 AS dev FROM orders ORDER BY abs(o_totalprice - 250000) DESC, o_orderkey LIMIT 25
""")
def topk(t: Tables) -> DataFrame:
    return top_abs(t.orders.select("o_orderkey", (F.col("o_totalprice") - 250000).alias("dev")), "dev", 25, "o_orderkey")


@query("union_tagged", """
SELECT o_custkey AS key, 'order' AS role, count(*) AS n FROM orders GROUP BY 1
UNION ALL SELECT s_suppkey, 'supplier', count(*) FROM supplier GROUP BY 1
""")
def tagged(t: Tables) -> DataFrame:
    parts = {"order": t.orders.select(F.col("o_custkey").alias("key")), "supplier": t.supplier.select(F.col("s_suppkey").alias("key"))}
    return union_tagged({k: v.groupBy("key").agg(F.count("*").alias("n")) for k, v in parts.items()}, "role")


@query("unnest_array", """
SELECT p_partkey, unnest(CASE WHEN p_size % 5 = 0 THEN [] WHEN p_size % 7 = 0 THEN NULL ELSE string_split(p_name, ' ') END) AS token FROM part
""")
def unnest(t: Tables) -> DataFrame:
    size = F.col("p_size")
    tokens = F.when(size % 5 == 0, F.array().cast("array<string>")).when(size % 7 == 0, None).otherwise(F.split("p_name", " "))
    return unnest_array(t.part.select("p_partkey", tokens.alias("tokens")), "tokens", "token")


@query("date_series", """
WITH b AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d0, max(CAST(o_orderdate AS DATE)) AS d1 FROM orders GROUP BY 1)
SELECT o_custkey, CAST(unnest(generate_series(date_trunc('month', d0), d1, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM b
""")
def series(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    bounds = t.orders.groupBy("o_custkey").agg(F.trunc(F.min(d), "MM").alias("d0"), F.max(d).alias("d1"))
    return date_series(bounds, "d0", "d1", "month_start", "1 month")


@query("upsert_merge", """
WITH o AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) // 86400 AS day, max(value) AS p FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL),
n AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) // 86400 AS day, min(value) AS p FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY ALL)
SELECT user_id, day, CASE WHEN n.p IS NOT NULL THEN n.p ELSE o.p END AS p FROM o FULL JOIN n USING (user_id, day)
""")
def upserts(t: Tables) -> DataFrame:
    day = F.floor(F.unix_seconds("ts") / 86400).alias("day")
    pull = lambda kinds, agg: t.events.where(F.col("event_type").isin(*kinds)).groupBy("user_id", day).agg(agg("value").alias("p"))
    return upsert(pull(["click", "view"], F.max), pull(["purchase", "signup"], F.min), ["user_id", "day"])


@query("distinct_keys", "SELECT DISTINCT user_id % 10 AS event_id, user_id AS market_id, event_type AS outcome FROM events")
def distinct_keys(t: Tables) -> DataFrame:
    return t.events.select((F.col("user_id") % 10).alias("event_id"), F.col("user_id").alias("market_id"),
                           F.col("event_type").alias("outcome")).distinct()


@query("set_difference", """
WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)
SELECT k, 'only_a' AS side FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT k, 'both' FROM (SELECT k FROM a INTERSECT SELECT k FROM b)
""")
def set_difference(t: Tables) -> DataFrame:
    part = lambda f: t.lineitem.where((F.col("l_returnflag") == f) & (F.col("l_quantity") > 45)).select(F.col("l_partkey").alias("k"))
    a, b = part("A"), part("R")
    return union_tagged({"only_a": a.subtract(b), "both": a.intersect(b)}, "side")


@query("unnest_zip", """
WITH m AS (SELECT p_partkey, p_type, string_split(p_name, ' ') || [p_brand] AS toks,
                  CASE WHEN p_size % 4 = 0 THEN ['Yes', 'No'] WHEN p_size % 4 = 1 THEN ['Yes', 'No', 'Maybe'] ELSE ['Up'] END AS labels FROM part),
u AS (SELECT *, unnest(range(1, len(toks) + 1)) AS i FROM m)
SELECT p_partkey, toks[i] AS token, COALESCE(labels[i], 'idx' || (i - 1)) AS label FROM u
WHERE COALESCE(labels[i], '') = 'Yes' OR NOT list_contains(labels, 'Yes') OR (p_type = 'ECONOMY' AND COALESCE(labels[i], '') = 'No')
""")
def zipped(t: Tables) -> DataFrame:
    size = F.col("p_size")
    arr = lambda *xs: F.array(*map(F.lit, xs))
    labels = F.when(size % 4 == 0, arr("Yes", "No")).when(size % 4 == 1, arr("Yes", "No", "Maybe")).otherwise(arr("Up"))
    rows = t.part.select("p_partkey", "p_type", F.concat(F.split("p_name", " "), F.array("p_brand")).alias("toks"),
                         labels.alias("labels"), labels.alias("all_labels"))
    flat = unnest_zip(rows, "toks", "labels", "token", "label")
    keep = keep_collectable(F.col("all_labels"), F.col("label"), F.col("p_type") == "ECONOMY")
    return flat.where(keep).select("p_partkey", "token", "label")


@query("dedup_ordered", "SELECT text, min(conv_id * 1000 + turn) AS pos FROM conversations GROUP BY 1")
def ordered(t: Tables) -> DataFrame:
    rows = t.conversations.select("text", (F.col("conv_id") * 1000 + F.col("turn")).alias("pos"))
    return dedup_ordered(rows, "text", "pos")
