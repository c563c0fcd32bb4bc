"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorgrid.catalog.registry import Tables, query
from tenorgrid.functions.times import iso_epoch
from tenorgrid.functions.values import bucket_change, clamp01, mid_price, number, quality_ok, taker_fee, tick_probability


@query("derive_columns", """
SELECT * REPLACE (CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate),
       l_extendedprice * (1 - l_discount) AS disc_price, l_tax - l_discount AS spread
FROM lineitem
""")
def derive_columns(t: Tables) -> DataFrame:
    return t.lineitem.withColumns({
        "l_linenumber": F.col("l_linenumber").cast("double"), "l_shipdate": F.to_date("l_shipdate"),
        "disc_price": F.col("l_extendedprice") * (1 - F.col("l_discount")), "spread": F.col("l_tax") - F.col("l_discount"),
    })


@query("safe_cast", """
WITH x AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                  WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') WHEN 2 THEN '  ' ELSE o_orderpriority END AS txt,
                  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE substr(o_orderpriority, 1, 1 + CAST(o_orderkey % 2 AS INT)) END AS num
           FROM orders)
SELECT o_orderkey, CAST(epoch(TRY_CAST(NULLIF(trim(txt), '') AS TIMESTAMP)) AS BIGINT) AS ts,
       TRY_CAST(NULLIF(trim(num), '') AS DOUBLE) AS num
FROM x
""")
def safe_cast(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    text = (F.when(k % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(k % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(k % 4 == 2, "  ").otherwise(F.col("o_orderpriority")))
    num = F.when(k % 3 == 0, "").otherwise(F.substring("o_orderpriority", F.lit(1), (1 + k % 2).cast("int")))
    return t.orders.select("o_orderkey", iso_epoch(text).alias("ts"), number(num).alias("num"))


@query("case_null", """
SELECT l_orderkey, l_linenumber, l_partkey, l_discount AS bid, l_quantity / 50 AS ask,
       CASE WHEN NOT (l_discount = 0 AND l_quantity / 50 >= 0.99) THEN (l_discount + l_quantity / 50) / 2 END AS mid
FROM lineitem
""")
def case_null(t: Tables) -> DataFrame:
    ask = F.col("l_quantity") / 50
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_discount").alias("bid"), ask.alias("ask"),
                             mid_price("l_discount", ask).alias("mid"))


@query("filter_between", """
SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem
WHERE l_discount BETWEEN 0.05 AND 0.07 AND strftime(l_shipdate, '%Y-%m') BETWEEN '1996-03' AND '1998-10'
""")
def filter_between(t: Tables) -> DataFrame:
    ship = F.col("l_shipdate")
    months = (ship >= F.lit("1996-03-01").cast("timestamp")) & (ship < F.lit("1998-11-01").cast("timestamp"))
    return t.lineitem.where(F.col("l_discount").between(0.05, 0.07) & months).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.to_date(ship).alias("ship_date"))


@query("filter_prefix", "SELECT p_partkey, p_brand, p_type FROM part WHERE p_type LIKE 'EC%'")
def filter_prefix(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_type").startswith("EC")).select("p_partkey", "p_brand", "p_type")


@query("filter_in_null", """
SELECT d.doc_id, d.lang, COALESCE(l.quality, -1) AS quality, l.toxic
FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE d.lang IN ('en', 'fr', 'de') AND d.source <> 'web' AND (l.quality IS NULL OR NOT (l.toxic = 1 AND l.quality = 0))
""")
def filter_in_null(t: Tables) -> DataFrame:
    docs = t.documents.where(F.col("lang").isin("en", "fr", "de") & (F.col("source") != "web")).select("doc_id", "lang")
    rows = docs.join(t.labels, "doc_id", "left")
    keep = F.col("quality").isNull() | ~((F.col("toxic") == 1) & (F.col("quality") == 0))
    return rows.where(keep).select("doc_id", "lang", F.coalesce("quality", F.lit(-1)).alias("quality"), "toxic")


@query("boolean_flags", """
SELECT event_id, (value > 1 AND value < 40) AS two_sided, (event_type IN ('view', 'click')) AS quoted,
       (CAST(ts AS DATE) > DATE '2024-01-05' AND CAST(ts AS DATE) <= DATE '2024-01-20') AS in_window,
       (ts < TIMESTAMP '2024-01-20') AS pre_decision,
       (CASE WHEN event_type <> 'error' THEN value END) = 0.5 OR event_type = 'view' AS p_is_half
FROM events
""")
def boolean_flags(t: Tables) -> DataFrame:
    d, value, kind = F.to_date("ts"), F.col("value"), F.col("event_type")
    day = lambda s: F.lit(s).cast("date")
    return t.events.select(
        "event_id", ((value > 1) & (value < 40)).alias("two_sided"), kind.isin("view", "click").alias("quoted"),
        ((d > day("2024-01-05")) & (d <= day("2024-01-20"))).alias("in_window"),
        (F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp")).alias("pre_decision"),
        ((F.when(kind != "error", value) == 0.5) | (kind == "view")).alias("p_is_half"))


@query("quality_flag", """
WITH o AS (SELECT l_orderkey, sum(l_quantity) / (count(*) * 25) AS sum_raw, count(*) AS n,
                  max(CASE WHEN l_returnflag = 'R' THEN l_linenumber - 3 END) AS stale
           FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, (sum_raw BETWEEN 0.95 AND 1.10 AND n = 4 AND COALESCE(stale, 99) <= 1) AS ladder_ok,
       (sum_raw BETWEEN 0.95 AND 1.10 AND COALESCE(stale, 0) = 0) AS points_ok
FROM o
""")
def quality_flag(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(
        (F.sum("l_quantity") / (F.count("*") * 25)).alias("sum_raw"), F.count("*").alias("n"),
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_linenumber") - 3)).alias("stale"))
    total, stale = F.col("sum_raw"), F.col("stale")
    return per.select("l_orderkey", quality_ok(total, stale, F.col("n"), 4).alias("ladder_ok"),
                      quality_ok(total, F.lit(0), half=stale).alias("points_ok"))


@query("filter_regex", """
SELECT p_partkey, p_name, p_brand, regexp_full_match(p_name, '(red|blue|small) [a-z]+') AS is_decision
FROM part WHERE regexp_full_match(p_brand, 'Brand#[12]\\d')
""")
def filter_regex(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_brand").rlike(r"^Brand#[12]\d$")).select(
        "p_partkey", "p_name", "p_brand", F.col("p_name").rlike("^(red|blue|small) [a-z]+$").alias("is_decision"))


@query("clamp", """
WITH m AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN (o_totalprice - 250000) / 10000 END AS move FROM orders)
SELECT o_orderkey, LEAST(1, GREATEST(0, move / 25)) AS p_up, LEAST(1, GREATEST(0, -move / 25)) AS p_down,
       1 - LEAST(1, GREATEST(0, move / 25)) - LEAST(1, GREATEST(0, -move / 25)) AS p_hold
FROM m
""")
def clamp(t: Tables) -> DataFrame:
    move = F.when(F.col("o_orderstatus") != "P", (F.col("o_totalprice") - 250000) / 10000)
    up, down = clamp01(move / 25), clamp01(-move / 25)
    return t.orders.select("o_orderkey", up.alias("p_up"), down.alias("p_down"), (1 - up - down).alias("p_hold"))


@query("fee_formula", """
SELECT l_orderkey, l_linenumber, l_partkey, ceil(round(CAST(0.07 AS DOUBLE) * 100 * l_linenumber * (l_quantity / 51) * (1 - l_quantity / 51), 9)) / 100 AS fee,
       0.0025 / NULLIF(CAST(0.25 AS DOUBLE) * l_discount, 0) AS tick_p
FROM lineitem
""")
def fee_formula(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             taker_fee(F.col("l_linenumber"), F.col("l_quantity") / 51).alias("fee"),
                             tick_probability(F.lit(0.0025), F.col("l_discount")).alias("tick_p"))


@query("bucketize", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_linenumber - 4) * 25 + CASE WHEN l_returnflag = 'R' THEN 5 ELSE 0 END AS bp FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, bp, CASE WHEN bp <= -50 THEN 'CUT50P' WHEN bp = -25 THEN 'CUT25' WHEN bp = 0 THEN 'HOLD'
       WHEN bp = 25 THEN 'HIKE25' WHEN bp >= 50 THEN 'HIKE50P' ELSE 'OTHER' END AS outcome
FROM c
""")
def bucketize(t: Tables) -> DataFrame:
    bp = (F.col("l_linenumber") - 4) * 25 + F.when(F.col("l_returnflag") == "R", 5).otherwise(0)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", bp.alias("bp"), bucket_change(bp).alias("outcome"))
