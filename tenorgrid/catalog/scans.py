"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorgrid.catalog.registry import Tables, query
from tenorgrid.session import shared_folder
from tenorgrid.sources.landing import normalise_bars
from tenorgrid.sources.readers import read_union_by_name
from tenorgrid.sources.schemas import TEST_TABLES, ordered
from tenorgrid.sources.sinks import table_counts, write_sorted


@query("scan_parquet", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
""")
def scan_parquet(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("scan_union_by_name", """
SELECT o_orderkey, o_custkey, o_totalprice, NULL::BIGINT AS c_custkey, NULL::VARCHAR AS c_name, NULL::DOUBLE AS c_acctbal FROM orders
UNION ALL BY NAME
SELECT c_custkey, c_name, c_acctbal FROM customer
""")
def scan_union_by_name(t: Tables) -> DataFrame:
    columns = ordered("o_orderkey bigint, o_custkey bigint, o_totalprice double, c_custkey bigint, c_name string, c_acctbal double")
    return read_union_by_name(t.spark, [t.path("orders"), t.path("customer")], columns)


@query("write_roundtrip", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_date, o_totalprice FROM orders
""")
def write_roundtrip(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_date"), "o_totalprice")
    path = shared_folder(t.spark)
    write_sorted(rows, path, ["o_custkey", "o_date", "o_orderkey"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query("table_counts", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TEST_TABLES))
def counts(t: Tables) -> DataFrame:
    return table_counts({n: getattr(t, n) for n in TEST_TABLES})


SHIP_SYMBOL_SQL = """
CASE WHEN l_returnflag = 'N' THEN 'ZQ=F'
     ELSE 'ZQ' || substr('FGHJKMNQUVXZ', month(l_shipdate)::INT, 1) || strftime(l_shipdate, '%y') || '.CBT' END"""


def ship_bars(lineitem: DataFrame) -> DataFrame:
    """Daily bars of a continuous and of monthly symbols from line items; a single-trade day has NaN volume."""
    d = F.to_date("l_shipdate")
    label = F.concat(F.lit("ZQ"), F.substring(F.lit("FGHJKMNQUVXZ"), F.month(d), F.lit(1)), F.date_format(d, "yy"), F.lit(".CBT"))
    symbol = F.when(F.col("l_returnflag") == "N", "ZQ=F").otherwise(label)
    trade = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    return lineitem.groupBy(symbol.alias("symbol"), d.alias("date")).agg(
        F.min(trade)["l_extendedprice"].alias("open"), F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"), F.max(trade)["l_extendedprice"].alias("close"),
        F.when(F.count("*") == 1, F.lit(float("nan"))).otherwise(F.sum("l_quantity")).alias("volume"))


@query("normalise_bars", f"""
WITH s AS (
    SELECT {SHIP_SYMBOL_SQL} AS symbol, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, l_extendedprice, l_quantity
    FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS a,
             row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS z
      FROM s),
b AS (SELECT symbol, date, max(CASE WHEN a = 1 THEN l_extendedprice END) AS open, max(l_extendedprice) AS high,
             min(l_extendedprice) AS low, max(CASE WHEN z = 1 THEN l_extendedprice END) AS close,
             CASE WHEN count(*) > 1 THEN CAST(sum(l_quantity) AS BIGINT) END AS volume
      FROM o GROUP BY symbol, date)
SELECT CASE WHEN symbol = 'ZQ=F' THEN strftime(date, '%Y-%m') ELSE '20' || substr(symbol, 4, 2) || '-' || lpad(CAST(position(substr(symbol, 3, 1) IN 'FGHJKMNQUVXZ') AS VARCHAR), 2, '0') END AS event_id,
       split_part(symbol, '.', 1) AS contract, symbol AS source_symbol, 'ZQ' AS product,
       CASE WHEN symbol <> 'ZQ=F' THEN '20' || substr(symbol, 4, 2) || '-' || lpad(CAST(position(substr(symbol, 3, 1) IN 'FGHJKMNQUVXZ') AS VARCHAR), 2, '0') END AS delivery_month,
       CASE WHEN symbol = 'ZQ=F' THEN 'ZQ' || substr('FGHJKMNQUVXZ', month(date)::INT, 1) || strftime(date, '%y') END AS front_contract_est,
       CAST(epoch(date) AS BIGINT) AS ts, date, open, high, low, close, close AS settle, volume
FROM b
""")
def bars(t: Tables) -> DataFrame:
    return normalise_bars(ship_bars(t.lineitem), "symbol").select(
        "event_id", "contract", "source_symbol", "product", "delivery_month", "front_contract_est", "ts", "date", "open",
        "high", "low", "close", "settle", "volume")
