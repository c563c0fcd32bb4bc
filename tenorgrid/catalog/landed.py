"""Landing operators on bodies built from the test tables, one record per body, with independent SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, functions as F

from tenorgrid.catalog.registry import Tables, query
from tenorgrid.functions.fixed import MONTH_CODES
from tenorgrid.functions.text import event_month
from tenorgrid.plans.futures import decade_counts, settlement_outrights
from tenorgrid.plans.hedge import basis_cents, before_decision
from tenorgrid.session import shared_folder
from tenorgrid.sources.landing import (flatten_candles, flatten_history, flatten_markets, flatten_trades, history_list,
                                       unreadable, unreadable_markets)
from tenorgrid.sources.readers import assemble_parts, manifest_value, read_series_csv, series_header_check, unreadable_dates
from tenorgrid.sources.schemas import ordered
from tenorgrid.sources.sinks import materialise, register_views, write_sorted


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())))


def _text(c: str) -> Column:
    return F.col(c).cast("string")


@query("flatten_candles", """
SELECT 'm' || (o_custkey % 20) AS market_id, CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS ts, arg_max(o_totalprice / 4, o_orderkey) AS bid_close,
       arg_max(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, o_orderkey) AS ask_close, arg_max(CAST(o_orderkey % 7 AS DOUBLE), o_orderkey) AS vol,
       date_trunc('day', o_orderdate) > TIMESTAMP '1997-01-01' AS is_partial
FROM (SELECT * REPLACE (round(o_totalprice * 4) / 4 AS o_totalprice) FROM orders) GROUP BY ALL
""".replace("arg_max(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, o_orderkey)",
            "nullif(arg_max(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE -1 END, o_orderkey), -1)"))
def candles(t: Tables):
    price = F.round(F.col("o_totalprice") * 4) / 4
    body = F.to_json(F.array(F.struct(
        F.unix_seconds(F.date_trunc("day", "o_orderdate")).alias("end_period_ts"),
        F.struct((price / 4).cast("string").alias("close_dollars")).alias("yes_bid"),
        F.struct(F.when(F.col("o_orderstatus") != "P", price.cast("string")).otherwise("").alias("close_dollars")).alias("yes_ask"),
        (F.col("o_orderkey") % 7).cast("string").alias("volume_fp"))))
    landed = t.orders.select(F.lit("e").alias("event_id"), F.concat(F.lit("m"), F.col("o_custkey") % 20).alias("market_id"),
                             F.lit("HOLD").alias("outcome"), F.lit(1440).alias("interval"), body.alias("body"), F.col("o_orderkey").alias("arrival"))
    at = F.unix_seconds(F.lit("1997-01-01").cast("timestamp"))
    return flatten_candles(landed, now=at).select("market_id", "ts", "bid_close", "ask_close", "vol", "is_partial")


@query("flatten_trades", """
SELECT CAST(o_orderkey % 4000 AS VARCHAR) AS trade_id, arg_max(CAST(epoch(o_orderdate) AS BIGINT), o_orderkey) AS ts, arg_max(CAST(o_custkey % 9 AS DOUBLE), o_orderkey) AS "count",
       arg_max(o_totalprice, o_orderkey) AS yes_price, arg_max(o_orderstatus = 'F', o_orderkey) AS is_block_trade
FROM orders GROUP BY 1
""")
def trades(t: Tables):
    trade = F.struct(F.lit(None).cast("string").alias("taker_side"), (F.col("o_orderkey") % 4000).cast("string").alias("trade_id"),
                     F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_time"),
                     (F.col("o_custkey") % 9).cast("string").alias("count_fp"), _text("o_totalprice").alias("yes_price_dollars"),
                     F.when(F.col("o_orderstatus") == "F", F.lit(True)).alias("is_block_trade"))
    landed = t.orders.select(F.lit("e").alias("event_id"), F.lit("m").alias("market_id"), F.lit("HOLD").alias("outcome"),
                             _json(trades=F.array(trade)).alias("body"), F.col("o_orderkey").alias("arrival"))
    return flatten_trades(landed).select("trade_id", "ts", "count", "yes_price", "is_block_trade")


def _history(t: Tables):
    point = F.struct((F.floor(F.unix_seconds("ts") / 86400) * 86400).alias("t"), F.col("value").alias("p"))
    body = _json(history=F.array(point))
    broken = F.when(F.col("event_id") % 11 == 0, F.substring(body, 1, 18)).otherwise(body)
    return t.events.select(F.lit("e").alias("event_id"), F.lit("m").alias("market_id"), _text("user_id").alias("token_id"), F.lit("HOLD").alias("outcome"),
                           F.lit("Yes").alias("outcome_label"), F.lit(60).alias("fidelity"), broken.alias("body"), F.col("event_id").alias("arrival"))


@query("flatten_history", """
SELECT CAST(user_id AS VARCHAR) AS token_id, CAST(floor(epoch(ts) / 86400) AS BIGINT) * 86400 AS ts, arg_max(value, event_id) AS p
FROM events WHERE event_id % 11 <> 0 GROUP BY ALL
""")
def history(t: Tables):
    return flatten_history(_history(t)).select("token_id", "ts", "p")


@query("unreadable_history", """
SELECT event_id AS arrival, CAST(user_id AS VARCHAR) AS token_id, 'unreadable_body' AS rule FROM events WHERE event_id % 11 = 0
""")
def broken_history(t: Tables):
    return unreadable(_history(t), history_list()).select("arrival", "token_id", "rule")


def _markets(t: Tables):
    body = _json(ticker=_text("p_partkey"), event_ticker=F.col("p_brand"), subtitle=F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(""),
                 yes_sub_title=F.col("p_type"), cap_strike=_text("p_retailprice"), can_close_early=F.col("p_size") > 25,
                 price_ranges=F.array(F.struct(F.lit("0.01").alias("step"))))
    broken = F.when(F.col("p_partkey") % 13 == 0, F.concat(F.lit("<"), body)).otherwise(body)
    return t.part.select(F.col("p_partkey"), F.lit("S").alias("series_ticker"), F.when(F.col("p_size") < 10, "H0").otherwise("?").alias("leg"),
                         _json(fee_type=F.lit("q"), fee_multiplier=F.col("p_size")).alias("series_body"), broken.alias("body"))


@query("flatten_markets", """
SELECT CAST(p_partkey AS VARCHAR) AS market_id, p_brand AS event_id, CASE WHEN p_size < 10 THEN 'HOLD' ELSE 'OTHER' END AS outcome,
       CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_type END AS subtitle, p_retailprice AS cap_strike, CAST(0.01 AS DOUBLE) AS tick_size,
       CAST(p_size AS DOUBLE) AS fee_multiplier, p_size > 25 AS can_close_early
FROM part WHERE p_partkey % 13 <> 0
""")
def markets(t: Tables):
    return flatten_markets(_markets(t), now=F.lit(0)).select("market_id", "event_id", "outcome", "subtitle", "cap_strike", "tick_size",
                                                             "fee_multiplier", "can_close_early")


@query("unreadable_markets", "SELECT p_partkey, 'unreadable_body' AS rule FROM part WHERE p_partkey % 13 = 0")
def broken_markets(t: Tables):
    return unreadable_markets(_markets(t)).select("p_partkey", "rule")


@query("event_month", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN '20' || strftime(o_orderdate, '%y-%m') END AS ym, CASE WHEN o_orderkey % 5 NOT IN (0, 1) THEN CAST(day(o_orderdate) AS INT) END AS day
FROM orders
""")
def months(t: Tables):
    stem = F.upper(F.date_format("o_orderdate", "yyMMM"))
    ticker = (F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("OTHER-"), stem)).when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("KXFEDDECISION-"), stem))
              .otherwise(F.concat(F.lit("FEDDECISION-"), stem, F.date_format("o_orderdate", "dd"))))
    return t.orders.select("o_orderkey", event_month(ticker).alias("m")).select("o_orderkey", "m.ym", "m.day")


def _feed(t: Tables):
    """Settlements of contracts up to 70 months ahead; beyond 60 no decade or another one fits."""
    ahead = F.add_months(F.trunc(F.to_date("o_orderdate"), "MM"), (F.col("o_custkey") % 70).cast("int"))
    symbol = F.concat(F.lit("ZQ"), F.substring(F.lit(MONTH_CODES), F.month(ahead), F.lit(1)), (F.year(ahead) % 10).cast("string"))
    return t.orders.select(F.to_date("o_orderdate").alias("trade_date"), symbol.alias("symbol"), F.col("o_totalprice").alias("price"),
                           F.lit(1).alias("stat_flags"), F.col("o_custkey").alias("instrument_id"), F.timestamp_seconds("o_orderkey").alias("ts_recv"))


FEED_SQL = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS trade_date, CAST(date_trunc('month', o_orderdate) + to_months(CAST(o_custkey % 70 AS INT)) AS DATE) AS m0, o_totalprice AS price, o_orderkey FROM orders),
s AS (SELECT *, 'ZQ' || substr('FGHJKMNQUVXZ', CAST(month(m0) AS INT), 1) || (year(m0) % 10) AS symbol FROM o),
f AS (SELECT trade_date, symbol, arg_max(price, o_orderkey) AS price, any_value(month(m0)) AS m, any_value(year(m0) % 10) AS digit FROM s GROUP BY 1, 2),
c AS (SELECT f.*, y FROM f, range(1980, 2020) r(y) WHERE y % 10 = digit AND (y - year(trade_date)) * 12 + m - month(trade_date) BETWEEN -1 AND 60)
"""


@query("settlement_outrights", FEED_SQL + """
SELECT trade_date, symbol, min(y) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS dm, CAST((min(y) - year(trade_date)) * 12 + m - month(trade_date) AS INT) AS h, price
FROM c GROUP BY trade_date, symbol, m, price HAVING count(*) = 1
""")
def outrights(t: Tables):
    return settlement_outrights(_feed(t), first_year=1990).select("trade_date", "symbol", "dm", "h", "price")


@query("decade_counts", FEED_SQL + """, n AS (SELECT f.trade_date, f.symbol, count(c.y) AS k FROM f LEFT JOIN c USING (trade_date, symbol) GROUP BY 1, 2)
SELECT CAST(k AS INT) AS n_decades, count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols FROM n GROUP BY 1
""")
def decades(t: Tables):
    return decade_counts(_feed(t), first_year=1990)


@query("basis_cents", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, round(4 * (l_extendedprice - l_quantity), 6) AS cents
FROM lineitem WHERE CAST(l_shipdate AS DATE) < last_day(CAST(l_shipdate AS DATE)) - CAST(l_linenumber AS INT)
""")
def cents(t: Tables):
    d = F.to_date("l_shipdate")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", d.alias("date"), F.date_sub(F.last_day(d), F.col("l_linenumber")).alias("meeting_date"),
                             F.round(basis_cents(F.col("l_extendedprice"), F.col("l_quantity")), 6).alias("cents"))
    return before_decision(rows).drop("meeting_date")


# Files that a query writes to the shared folder and reads back.
SERIES = {"EFFR": "1-URGENT", "SOFR": "2-HIGH"}


def _series_files(t: Tables) -> list[str]:
    """One folder of CSV parts per series; days with an even order count have no value, every 17th no date."""
    folder = shared_folder(t.spark)
    for name, priority in SERIES.items():
        daily = t.orders.where(F.col("o_orderpriority") == priority).groupBy(F.to_date("o_orderdate").alias("d")).agg(
            F.round(F.max("o_totalprice"), 2).alias("v"), F.count("*").alias("n"))
        daily.select(F.when(F.dayofyear("d") % 17 == 0, "n/a").otherwise(F.col("d").cast("string")).alias("observation_date"),
                     F.when(F.col("n") % 2 == 0, ".").otherwise(F.col("v").cast("string")).alias(name)).write.csv(f"{folder}/{name}.csv", header=True)
    return [f"{folder}/{name}.csv" for name in SERIES]


SERIES_SQL = """
WITH s AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'EFFR' ELSE 'SOFR' END AS series_id, CAST(o_orderdate AS DATE) AS date, CASE WHEN count(*) % 2 = 1 THEN max(o_totalprice) END AS value
           FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2)
"""


@query("read_series_csv", SERIES_SQL + "SELECT series_id, date, value, CAST(epoch(date) AS BIGINT) AS ts FROM s WHERE dayofyear(date) % 17 <> 0")
def series(t: Tables):
    return read_series_csv(t.spark, _series_files(t)).select("series_id", "date", "value", "ts")


@query("unreadable_dates", SERIES_SQL + "SELECT series_id, 'n/a' AS raw_date, count(*) AS n FROM s WHERE dayofyear(date) % 17 = 0 GROUP BY 1")
def undated(t: Tables):
    return unreadable_dates(t.spark, _series_files(t)).groupBy("series_id", "raw_date").agg(F.count("*").alias("n"))


@query("series_header_check", "SELECT DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'EFFR' ELSE 'SOFR' END AS series_id, TRUE AS header_ok FROM orders WHERE o_orderpriority < '3'")
def headers(t: Tables):
    return series_header_check(t.spark, _series_files(t))


@query("manifest_value", """
WITH m AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders)
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), d) <= 30 AS recent FROM orders, m
""")
def manifest(t: Tables):
    path = shared_folder(t.spark)
    t.orders.agg(F.max(F.to_date("o_orderdate")).cast("string").alias("fetched"), F.count("*").alias("rows")).write.json(path)
    fetched = manifest_value(t.spark, path, "fetched").scalar().cast("date")
    return t.orders.select("o_orderkey", (F.datediff(fetched, F.to_date("o_orderdate")) <= 30).alias("recent"))


@query("assemble_parts", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice FROM orders")
def parts(t: Tables):
    """Parts of one table staged in folders of their own; one part lacks a column."""
    folder = shared_folder(t.spark)
    for status in "FOP":
        part = t.orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus", "o_totalprice")
        write_sorted(part.drop("o_totalprice") if status == "P" else part, f"{folder}/{status}", ["o_orderkey"])
    return assemble_parts(t.spark, folder, ordered("o_orderkey bigint, o_orderstatus string, o_totalprice double"))


@query("materialised_view", "SELECT o_orderpriority, count(*) AS n, round(max(o_totalprice), 2) AS top FROM orders GROUP BY 1")
def materialised(t: Tables):
    name = f"orders_{uuid.uuid4().hex}"
    built = materialise(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), name)
    view, = register_views({f"v_{name}": built})
    return t.spark.sql(f"SELECT o_orderpriority, count(*) AS n, round(max(o_totalprice), 2) AS top FROM {view} GROUP BY 1")
