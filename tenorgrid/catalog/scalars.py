"""Time, text and JSON functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorgrid.catalog.registry import Tables, query
from tenorgrid.functions.fixed import BAR_END_SHIFT_S
from tenorgrid.functions.text import normalise_text
from tenorgrid.functions.times import (epoch_iso, local_date, month_contract, month_key, next_business_day, time_bucket)
from tenorgrid.operators.classify import classify_questions
from tenorgrid.operators.joins import join_dimension_array
from tenorgrid.plans.spine import calendar_columns


@query("epoch_to_ts", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS ts, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS iso,
       epoch_us(ts) AS ts_us
FROM events
""")
def epoch_to_ts(t: Tables) -> DataFrame:
    s = F.unix_seconds("ts")
    return t.events.select("event_id", s.alias("ts"), epoch_iso(s).alias("iso"), F.unix_micros("ts").alias("ts_us"))


@query("local_date", """
SELECT event_id, CAST(timezone('America/New_York', to_timestamp(CAST(floor(epoch(ts)) AS BIGINT))) AS DATE) AS day_local,
       CAST(timezone('Asia/Tokyo', to_timestamp(CAST(floor(epoch(ts)) AS BIGINT))) AS DATE) AS day_east
FROM events
""")
def local_dates(t: Tables) -> DataFrame:
    s = F.unix_seconds("ts")
    return t.events.select("event_id", local_date(s).alias("day_local"), local_date(s, "Asia/Tokyo").alias("day_east"))


@query("local_date_shifted", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(timezone('America/New_York', to_timestamp(CAST(epoch(l_shipdate) AS BIGINT) + 14400 + 3600 * (l_linenumber % 2) - 43200)) AS DATE) AS trade_date
FROM lineitem
""")
def local_date_shifted(t: Tables) -> DataFrame:
    bar_end = F.unix_seconds("l_shipdate") + 14400 + 3600 * (F.col("l_linenumber") % 2)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", local_date(bar_end, shift_s=BAR_END_SHIFT_S).alias("trade_date"))


@query("date_diff", """
SELECT o_orderkey, CAST(DATE '2001-12-31' - CAST(o_orderdate AS DATE) AS INT) AS days_to_decision,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE) AS asof_date
FROM orders
""")
def date_diff(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.datediff(F.lit("2001-12-31").cast("date"), d).alias("days_to_decision"),
                           F.date_add(d, 1).alias("asof_date"))


@query("month_key", "SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders GROUP BY 1")
def month_keys(t: Tables) -> DataFrame:
    return t.orders.groupBy(month_key("o_orderdate").alias("ym")).agg(F.count("*").alias("n"))


@query("time_bucket", """
SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) // 3600 AS hr, CAST(floor(epoch(ts)) AS BIGINT) // 60 AS mn, count(*) AS n
FROM events GROUP BY ALL
""")
def time_buckets(t: Tables) -> DataFrame:
    s = F.unix_seconds("ts")
    return t.events.groupBy("event_type", time_bucket(s, 3600).alias("hr"), time_bucket(s, 60).alias("mn")).agg(F.count("*").alias("n"))


@query("month_fraction", """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
e AS (SELECT *, d + CASE isodow(d) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS effective_date FROM d),
p AS (SELECT *, CASE WHEN month(effective_date) = month(d) THEN CAST(last_day(d) - effective_date + 1 AS INT) ELSE 0 END AS days_post,
             CAST(day(last_day(d)) AS INT) AS days_in_month FROM e)
SELECT o_orderkey, strftime(d, '%Y-%m') AS meeting_month, CAST(effective_date AS DATE) AS effective_date, last_day(d) AS month_end,
       days_in_month, days_post, days_post / days_in_month AS delta
FROM p
""")
def month_fraction(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return rows.withColumns(calendar_columns("d", holidays=False)).drop("d", "contract_symbol")


@query("next_business_day", """
WITH y AS (SELECT unnest(generate_series(1994, 2003)) AS y),
fixed AS (SELECT make_date(y, m, d) AS h FROM y, (VALUES (1, 1), (7, 4), (11, 11), (12, 25)) v(m, d)),
observed AS (SELECT CASE isodow(h) WHEN 6 THEN h - 1 WHEN 7 THEN h + 1 ELSE h END AS h FROM fixed),
nth AS (SELECT make_date(y, m, 1) + CAST((w - isodow(make_date(y, m, 1)) + 7) % 7 + 7 * (k - 1) AS INT) AS h
        FROM y, (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) v(m, w, k)),
memorial AS (SELECT make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INT) AS h FROM y),
closed AS (SELECT CAST(h AS DATE) AS h FROM observed UNION SELECT CAST(h AS DATE) FROM nth UNION SELECT CAST(h AS DATE) FROM memorial),
open_days AS (SELECT CAST(c AS DATE) AS c FROM (SELECT unnest(generate_series(DATE '1994-12-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS c)
              WHERE isodow(c) < 6 AND CAST(c AS DATE) NOT IN (SELECT h FROM closed))
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_date, c AS effective_date
FROM orders ASOF JOIN open_days ON CAST(o_orderdate AS DATE) < c
""")
def next_business_days(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", d.alias("o_date"), next_business_day(d).alias("effective_date"))


@query("month_contract_label", """
SELECT substr('FGHJKMNQUVXZ', CAST(month(o_orderdate) AS INT), 1) AS code,
       'ZQ' || substr('FGHJKMNQUVXZ', CAST(month(o_orderdate) AS INT), 1) || strftime(o_orderdate, '%y') AS contract, count(*) AS n
FROM orders GROUP BY 1, 2
""")
def month_contract_label(t: Tables) -> DataFrame:
    contract = month_contract("o_orderdate", "ZQ")
    return t.orders.groupBy(F.substring(contract, 3, 1).alias("code"), contract.alias("contract")).agg(F.count("*").alias("n"))


@query("rounding", """
SELECT o_orderkey, abs(o_totalprice - 250000) AS dev, CAST(round(o_totalprice) AS BIGINT) AS whole,
       CAST(round((o_totalprice - 250000) / 1000) AS INT) AS change_bp
FROM orders
""")
def rounding(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.abs(price - 250000).alias("dev"), F.round(price).cast("bigint").alias("whole"),
                           F.round((price - 250000) / 1000).cast("int").alias("change_bp"))


URL = r"^https?://([^/]+)/([a-z]{2})/(\d+)"


@query("regex_extract", rf"""
SELECT page_id, regexp_extract(url, '{URL}', 1) AS host, regexp_extract(url, '{URL}', 2) AS lang,
       TRY_CAST(regexp_extract(url, '{URL}', 3) AS INT) AS number
FROM pages
""")
def regex_extract(t: Tables) -> DataFrame:
    part = lambda i: F.regexp_extract("url", URL, i)
    return t.pages.select("page_id", part(1).alias("host"), part(2).alias("lang"), part(3).try_cast("int").alias("number"))


@query("text_normalise", """
SELECT doc_id, md5(regexp_replace(replace(replace(lower(text), '≤', '<='), '≥', '>='), '[–—-]', '-', 'g')) AS digest,
       length(regexp_replace(replace(replace(lower(text), '≤', '<='), '≥', '>='), '[–—-]', '-', 'g')) AS n
FROM documents
""")
def text_normalise(t: Tables) -> DataFrame:
    s = normalise_text("text")
    return t.documents.select("doc_id", F.md5(s).alias("digest"), F.length(s).cast("bigint").alias("n"))


@query("substring_cast", """
SELECT c_custkey, substr(c_name, 1, 8) AS stem, CAST(substr(c_name, 10) AS INT) AS number,
       lower(c_mktsegment) || '#' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS fallback_key
FROM customer
""")
def substring_cast(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.substring("c_name", 1, 8).alias("stem"), F.substring("c_name", 10, 20).cast("int").alias("number"),
        F.concat_ws("#", F.lower("c_mktsegment"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("fallback_key"))


@query("json_parse", """
WITH j AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k, json_extract_string(props, '$.missing') AS gone FROM events)
SELECT event_id, k, gone, CAST(len(CASE WHEN k % 3 = 0 THEN [] ELSE ['Yes', 'No'] END) AS INT) AS n_labels,
       CASE WHEN k % 3 = 0 THEN NULL ELSE 'No' END AS second, '{"k":' || k || ',"t":"' || event_type || '"}' AS text
FROM j
""")
def json_parse(t: Tables) -> DataFrame:
    parsed = t.events.withColumn("j", F.from_json("props", "k int, missing string")).withColumn(
        "labels", F.from_json(F.when(F.col("j.k") % 3 == 0, "[]").otherwise('["Yes","No"]'), "array<string>"))
    second = F.get("labels", F.nullif(F.array_position("labels", "No"), F.lit(0)).cast("int") - 1)
    return parsed.select("event_id", F.col("j.k").alias("k"), F.col("j.missing").alias("gone"), F.size("labels").alias("n_labels"),
                         second.alias("second"), F.to_json(F.struct(F.col("j.k").alias("k"), F.col("event_type").alias("t"))).alias("text"))


@query("array_lookup_sum", """
WITH tok AS (SELECT p_partkey, p_size, unnest(string_split(p_name, ' ')) AS token FROM part),
weight AS (SELECT token, CAST(sum(p_size) AS BIGINT) AS w FROM tok WHERE token <> 'ring' GROUP BY token)
SELECT p_partkey, CAST(sum(COALESCE(w, 0)) AS BIGINT) AS total FROM tok LEFT JOIN weight USING (token) GROUP BY p_partkey
""")
def array_lookup_sum(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_size", F.split("p_name", " ").alias("tokens"))
    weight = parts.select("p_size", F.explode("tokens").alias("token")).where("token <> 'ring'").groupBy("token").agg(F.sum("p_size").alias("w"))
    return join_dimension_array(parts, "p_partkey", "tokens", weight, "token", "w", "total")


QUESTION_SQL = """
CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'No change in rates after the meeting?'
     WHEN l_returnflag = 'N' AND l_linenumber = 2 THEN 'Will a member dissent?'
     WHEN l_returnflag = 'N' AND l_linenumber = 3 THEN 'Will it be cut–pause–hike?'
     WHEN l_returnflag = 'N' AND l_linenumber = 4 THEN 'Will they set interest rates above ' || CAST(l_quantity AS INT) || '%?'
     WHEN l_returnflag = 'N' THEN 'Something else'
     ELSE 'Fed ' || CASE WHEN l_returnflag = 'A' THEN 'decreases' ELSE 'Raises' END || ' interest rates by ' || (l_linenumber - 1) * 25
          || CASE WHEN l_linestatus = 'F' THEN '+' ELSE '' END || ' bps after the meeting?' END"""


@query("classify_text", r"""
WITH size AS (SELECT l_returnflag AS f, l_linestatus = 'F' AS plus, (l_linenumber - 1) * 25 AS n, l_linenumber AS k, CAST(l_quantity AS INT) AS lvl FROM lineitem),
shape AS (
    SELECT CASE WHEN f = 'N' THEN CASE WHEN k = 1 THEN 'HOLD' ELSE 'OTHER' END
                WHEN f = 'A' THEN CASE WHEN n >= 50 THEN 'CUT50P' WHEN n = 25 AND NOT plus THEN 'CUT25' ELSE 'OTHER' END
                ELSE CASE WHEN n = 0 THEN 'HOLD' WHEN n >= 50 OR plus THEN 'HIKE50P' ELSE 'HIKE25' END END AS outcome,
           CASE WHEN f = 'N' THEN CASE k WHEN 1 THEN 'HOLD' WHEN 2 THEN 'DISSENT_INDIVIDUAL' WHEN 3 THEN 'PATH_CUT_PAUSE_HIKE'
                                         WHEN 4 THEN 'THRESHOLD_ABOVE_' || lvl || 'PCT' ELSE 'UNMAPPED' END
                WHEN f = 'R' AND n = 0 THEN 'HOLD_0BP'
                ELSE CASE WHEN f = 'A' THEN 'CUT' ELSE 'HIKE' END || n || CASE WHEN plus THEN 'P' ELSE '' END END AS detail
    FROM size),
doc AS (SELECT CASE WHEN regexp_matches(lower(text), '\bno change\b') THEN 'HOLD' ELSE 'OTHER' END AS outcome,
               CASE WHEN contains(lower(text), 'dissent') THEN 'DISSENT_INDIVIDUAL'
                    WHEN regexp_matches(lower(text), '\bno change\b') THEN 'HOLD' ELSE 'UNMAPPED' END AS detail FROM documents)
SELECT 'line' AS src, outcome, detail, count(*) AS n FROM shape GROUP BY ALL
UNION ALL SELECT 'doc', outcome, detail, count(*) FROM doc GROUP BY ALL
""")
def classify_text(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.lit("line").alias("src"), F.expr(QUESTION_SQL).alias("q"))
    docs = t.documents.select(F.lit("doc").alias("src"), F.col("text").alias("q"))
    return classify_questions(lines.unionByName(docs), "q").groupBy("src", "outcome", "detail").agg(F.count("*").alias("n"))
