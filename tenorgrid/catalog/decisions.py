"""Decisions and events of both venues from the test tables: the spine, the landing of events, and their anomalies.

Dates are moved by 30 years, into the range that event tickers and contract codes can name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenorgrid.catalog import domain
from tenorgrid.catalog.registry import Tables, query
from tenorgrid.functions.fixed import DAY_BAR, MONTH_CODES
from tenorgrid.plans import coverage as cov
from tenorgrid.plans.spine import build_spine
from tenorgrid.sources import schemas
from tenorgrid.sources.landing import event_anomalies, event_markets, match_events, unreadable_events

LEGS = {"1": "C26", "2": "C25", "3": "H0", "4": "H25", "5": "X9"}


def _moved(c: str) -> Column:
    return F.add_months(F.to_date(c), 360)


def _decision(m0: Column) -> Column:
    return F.when(F.month(m0) % 6 == 0, F.last_day(m0)).otherwise(F.date_add(m0, 14))


def _by_month(df: DataFrame, d: str) -> DataFrame:
    return df.withColumn("d", _moved(d)).withColumn("m0", F.trunc("d", "MM"))


def calendar(t: Tables) -> DataFrame:
    return _by_month(t.orders, "o_orderdate").select(_decision(F.col("m0")).alias("meeting_date")).distinct()


def _ladder_event() -> Column:
    month = F.upper(F.date_format("m0", "yyMMM"))
    return (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("KXFEDDECISION-"), month))
            .when(F.col("o_orderstatus") == "O", F.concat(F.lit("FEDDECISION-"), month, F.when(F.month("m0") % 3 == 0, "16").otherwise("15")))
            .otherwise(F.concat(F.lit("PARTIAL-"), month)))


def ladder_events(t: Tables) -> DataFrame:
    return _by_month(t.orders, "o_orderdate").groupBy(_ladder_event().alias("event_id")).agg(F.min("o_orderkey").alias("seq"))


def legs(t: Tables) -> DataFrame:
    per = _by_month(t.orders, "o_orderdate").groupBy("m0", _ladder_event().alias("event_id"), F.substring("o_orderpriority", 1, 1).alias("p")).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("k"), F.max("d").alias("d1"))
    leg = F.create_map(*(F.lit(x) for pair in LEGS.items() for x in pair))[F.col("p")]
    day = F.when(F.col("n") % 2 == 0, _decision(F.col("m0"))).otherwise(F.col("d1"))
    return per.select("event_id", leg.alias("leg"), F.when(F.col("n") % 3 == 0, "active").otherwise("finalized").alias("status"),
                      F.when(F.col("k") % 4 == 0, "yes").otherwise("no").alias("result"), F.concat(day.cast("string"), F.lit("T19:00:00Z")).alias("close"))


def point_events(t: Tables) -> DataFrame:
    per = _by_month(t.lineitem, "l_shipdate").groupBy("m0", "l_returnflag").agg(F.max("d").alias("d1"))
    flag, month, name = F.col("l_returnflag"), F.month("m0"), F.date_format("m0", "MMMM")
    decision = _decision(F.col("m0")).cast("string")
    title = (F.when(flag == "A", F.concat(F.lit("Fed decision in "), name, F.lit("?")))
             .when(flag == "R", F.concat(F.lit("Fed Interest Rates: "), name, F.date_format("m0", " yyyy")))
             .when(month % 5 != 0, F.concat(F.lit("Dissents in "), name)))
    end = (F.when(flag == "A", decision)
           .when(flag == "R", F.when(month % 3 == 0, F.col("d1").cast("string")).otherwise(F.concat(decision, F.lit("T12:00:00Z"))))
           .when(month % 4 == 1, "soon").when(month % 4 != 0, decision))
    return per.select(F.concat(F.lit("fed-"), F.date_format("m0", "yyyy-MM"), F.lit("-"), F.lower(flag)).alias("event_id"), title.alias("title"), end.alias("end"))


def target(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority").startswith("1"))
    return urgent.groupBy(_moved("o_orderdate").alias("date")).agg(F.round(F.avg("o_totalprice") / 49999, 9).alias("value"))


def futures_months(t: Tables) -> DataFrame:
    months = _by_month(t.lineitem, "l_shipdate").select("m0").distinct()
    ym, month = F.date_format("m0", "yyyy-MM"), F.month("m0")
    code = F.concat(F.lit("ZQ"), F.substring(F.lit(MONTH_CODES), month, F.lit(1)), F.date_format("m0", "yy"))
    both = F.array_compact(F.array(F.when(month % 2 == 0, code), F.when(month % 5 != 0, "ZQ=F")))
    return months.select(F.explode(both).alias("contract"), ym.alias("event_id"))


def decisions(t: Tables) -> DataFrame:
    return build_spine(calendar(t), ladder_events(t), legs(t), point_events(t), target(t), futures_months(t))


DECISION_SQL = """
dates AS (SELECT CAST(unnest(generate_series(DATE '2021-12-01', DATE '2035-01-01', INTERVAL 1 DAY)) AS DATE) AS x),
closed_day AS (
  SELECT CASE isodow(x) WHEN 6 THEN x - 1 WHEN 7 THEN x + 1 ELSE x END AS h FROM dates WHERE (month(x), day(x)) IN ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))
  UNION SELECT x FROM dates WHERE isodow(x) = 1 AND ((month(x) <= 2 AND day(x) BETWEEN 15 AND 21) OR (month(x) = 5 AND day(x) > 24)
    OR (month(x) = 9 AND day(x) < 8) OR (month(x) = 10 AND day(x) BETWEEN 8 AND 14)) OR (isodow(x) = 4 AND month(x) = 11 AND day(x) BETWEEN 22 AND 28)),
open_day AS (SELECT x FROM dates WHERE isodow(x) < 6 AND x NOT IN (SELECT h FROM closed_day)),
mo AS (SELECT *, CAST(o_orderdate + INTERVAL 30 YEAR AS DATE) AS d FROM orders),
ml AS (SELECT *, CAST(l_shipdate + INTERVAL 30 YEAR AS DATE) AS d FROM lineitem),
oo AS (SELECT *, CAST(date_trunc('month', d) AS DATE) AS m0, CASE WHEN month(d) IN (6, 12) THEN last_day(d) ELSE CAST(date_trunc('month', d) AS DATE) + 14 END AS md,
         CASE o_orderstatus WHEN 'F' THEN 'KXFEDDECISION-' WHEN 'O' THEN 'FEDDECISION-' ELSE 'PARTIAL-' END || upper(strftime(d, '%y%b'))
           || CASE WHEN o_orderstatus = 'O' THEN CASE WHEN month(d) % 3 = 0 THEN '16' ELSE '15' END ELSE '' END AS event_id FROM mo),
ll AS (SELECT *, CAST(date_trunc('month', d) AS DATE) AS m0, CASE WHEN month(d) IN (6, 12) THEN last_day(d) ELSE CAST(date_trunc('month', d) AS DATE) + 14 END AS md FROM ml),
ev AS (SELECT event_id, any_value(m0) AS m0, any_value(o_orderstatus) AS st, min(o_orderkey) AS seq FROM oo GROUP BY 1),
leg AS (SELECT event_id, any_value(md) AS md, ['C26', 'C25', 'H0', 'H25', 'X9'][CAST(left(o_orderpriority, 1) AS INT)] AS leg,
          ['CUT50P', 'CUT25', 'HOLD', 'HIKE25', 'OTHER'][CAST(left(o_orderpriority, 1) AS INT)] AS outcome, if(count(*) % 3 = 0, 'active', 'finalized') AS status,
          if(min(o_orderkey) % 4 = 0, 'yes', 'no') AS result, CAST(if(count(*) % 2 = 0, any_value(md), max(d)) AS VARCHAR) || 'T19:00:00Z' AS "close"
        FROM oo GROUP BY event_id, o_orderpriority),
pe AS (SELECT 'fed-' || strftime(m0, '%Y-%m') || '-' || lower(l_returnflag) AS event_id,
         CASE l_returnflag WHEN 'A' THEN 'decision' WHEN 'R' THEN 'decision' ELSE 'other' END AS role,
         CASE l_returnflag WHEN 'A' THEN CAST(any_value(md) AS VARCHAR) WHEN 'R' THEN if(month(m0) % 3 = 0, CAST(max(d) AS VARCHAR), CAST(any_value(md) AS VARCHAR) || 'T12:00:00Z')
           ELSE CASE month(m0) % 4 WHEN 1 THEN 'soon' WHEN 0 THEN NULL ELSE CAST(any_value(md) AS VARCHAR) END END AS "end" FROM ll GROUP BY m0, l_returnflag),
pd AS (SELECT *, TRY_CAST(left("end", 10) AS DATE) AS md FROM pe),
rate AS (SELECT d, round(avg(o_totalprice) / 49999, 9) AS r FROM oo WHERE o_orderpriority LIKE '1%' GROUP BY 1),
linked AS (SELECT m0, arg_min(event_id, seq) AS event_id FROM ev WHERE st <> 'P' GROUP BY 1),
paid AS (SELECT event_id, min("close") AS first_close, if(count_if(result = 'yes') = 1, max(if(result = 'yes', outcome, NULL)), NULL) AS paid,
           CASE WHEN count(DISTINCT status) = 1 THEN min(status) ELSE 'mixed:' || string_agg(DISTINCT status, ',' ORDER BY status) END AS status FROM leg GROUP BY 1),
dec AS (SELECT DISTINCT m0, md, (SELECT min(x) FROM open_day WHERE x > md) AS eff FROM oo),
sp AS (
  SELECT md AS meeting_date, strftime(m0, '%Y-%m') AS meeting_month, l.event_id AS ladder_event, p.status AS ladder_status, p.first_close AS ladder_close,
    p.paid AS ladder_result_outcome,
    coalesce((SELECT string_agg(event_id, ',' ORDER BY event_id) FROM pd WHERE pd.md = dec.md), '') AS point_events,
    coalesce((SELECT string_agg(event_id, ',' ORDER BY event_id) FROM pd WHERE pd.md = dec.md AND role = 'decision'), '') AS point_events_decision,
    coalesce((SELECT string_agg(event_id, ',' ORDER BY event_id) FROM pd WHERE pd.md = dec.md AND role = 'other'), '') AS point_events_other,
    'ZQ' || substr('FGHJKMNQUVXZ', month(m0), 1) || strftime(m0, '%y') AS contract_symbol,
    m0 IN (SELECT m0 FROM ll) AS ships, eff AS effective_date, last_day(md) AS month_end, day(last_day(md)) AS days_in_month,
    if(month(eff) = month(md), date_diff('day', eff, last_day(md)) + 1, 0) AS days_post, CAST(round(((SELECT r FROM rate WHERE d = eff) - (SELECT r FROM rate WHERE d = md)) * 100) AS INT) AS realized_change_bp
  FROM dec LEFT JOIN linked l USING (m0) LEFT JOIN paid p ON p.event_id = l.event_id),
spine AS (
  SELECT * EXCLUDE (ships, days_in_month, days_post), CAST(days_in_month AS INT) AS days_in_month, CAST(days_post AS INT) AS days_post,
    if(ships AND month(meeting_date) % 2 = 0, 'contract', 'continuous_in_month') AS contract_source,
    if(ships AND month(meeting_date) % 2 = 0, contract_symbol || '.CBT', 'ZQ=F') AS contract_source_symbol,
    ships AND (month(meeting_date) % 2 = 0 OR month(meeting_date) % 5 <> 0) AS contract_data_available, days_post / days_in_month AS delta,
    CASE WHEN realized_change_bp <= -50 THEN 'CUT50P' WHEN realized_change_bp >= 50 THEN 'HIKE50P' WHEN realized_change_bp = -25 THEN 'CUT25'
      WHEN realized_change_bp = 0 THEN 'HOLD' WHEN realized_change_bp = 25 THEN 'HIKE25' WHEN realized_change_bp IS NOT NULL THEN 'OTHER' END AS realized_outcome FROM sp)
"""


@query("decision_spine", f"WITH {DECISION_SQL} SELECT * REPLACE (round(delta, 12) AS delta) FROM spine")
def decision_spine(t: Tables) -> DataFrame:
    lists = ("point_events", "point_events_decision", "point_events_other")
    return decisions(t).withColumns({**{c: F.array_join(c, ",") for c in lists}, "delta": F.round("delta", 12)})


AS_OF = "1998-08-10"
# Rules on points, trades and series, then those that hold between the decisions and the events.
ANOMALY_SQL = f"""
, line AS (SELECT *, strftime(l_shipdate, '%Y-%m') || if(l_returnflag = 'N', '-b', '-a') AS event, CAST(epoch(l_shipdate) AS BIGINT) + 43200 + l_orderkey % 36000 AS ts,
             if(l_orderkey % 50 = 49, 0.5, (l_orderkey % 50 + 1) / 97) * 2.02 AS p FROM lineitem),
mk AS (SELECT event, l_linenumber AS n, event || '#' || l_linenumber AS market, max(ts) AS last_ts, count_if(p > 1) AS n_out, month(any_value(l_shipdate)) AS mon,
         CAST(max(epoch(l_shipdate)) AS BIGINT) + (l_linenumber - 4) * 86400 AS end_ts, CAST(max(l_shipdate) AS DATE) AS last_day, sum(l_extendedprice) AS volume,
         CASE WHEN month(any_value(l_shipdate)) IN (6, 12) THEN last_day(any_value(l_shipdate)) ELSE CAST(date_trunc('month', any_value(l_shipdate)) AS DATE) + 14 END AS decision
       FROM line GROUP BY 1, 2),
outcome AS (SELECT *, if(mon % 2 = 1 AND n = 5, 'OTHER', ['CUT50P', 'CUT50P', 'CUT25', 'HOLD', 'HIKE25', 'HIKE50P', 'OTHER'][n]) AS o FROM mk),
bar AS (SELECT strftime(o_orderdate, '%Y-%m') || '/' || o_orderpriority AS market, CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT) + 104400 AS ts, count(*) AS vol, max(o_custkey) AS c
        FROM orders GROUP BY ALL),
ft AS (SELECT strftime(o_orderdate, '%Y-%m') || '/' || o_orderpriority AS market, CAST(min(epoch(o_orderdate)) AS BIGINT) AS ts FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
tm AS (SELECT market, min(ft.ts) AS first, sum(vol) AS total, coalesce(sum(vol) FILTER (WHERE bar.ts < ft.ts), 0) AS before, sum(vol) * (1 + max(c) % 5 / 100.0) AS fp
       FROM bar LEFT JOIN ft USING (market) GROUP BY market),
ser AS (SELECT 'mode ' || l_suppkey % 40 AS id, CAST(l_shipdate AS DATE) AS d, max(if(l_quantity > 1, l_quantity, NULL)) AS v FROM lineitem GROUP BY ALL
        UNION ALL SELECT 'customer ' || o_custkey % 200, CAST(o_orderdate AS DATE), max(o_totalprice) FROM orders GROUP BY ALL),
gap AS (SELECT *, lag(d) OVER (PARTITION BY id ORDER BY d) AS b FROM ser),
sm AS (SELECT id, count(*) AS n, count_if(d - b > 10) AS gaps, arg_min(b, d) FILTER (WHERE d - b > 10) AS b, min(d) FILTER (WHERE d - b > 10) AS e, max(d) AS last,
         max(d) FILTER (WHERE v IS NOT NULL) AS seen FROM gap GROUP BY 1),
mm AS (SELECT strftime(ev.m0, '%Y-%m') AS ym, count(*) AS n, arg_min(event_id, seq) AS kept, any_value(dec.md) AS md FROM ev LEFT JOIN dec USING (m0) WHERE st <> 'P' GROUP BY 1),
found("check", key, detail) AS (
  SELECT 'series ends early', market || 'Y', CAST(round((end_ts - last_ts) / 86400, 1) AS VARCHAR) FROM mk WHERE n % 2 = 1 AND last_ts + 3600 < end_ts - 172800
  UNION ALL SELECT 'series runs past end', market || 'Y', CAST(round((last_ts - end_ts) / 86400, 1) AS VARCHAR) FROM mk WHERE n % 2 = 1 AND last_ts > end_ts + 259200
  UNION ALL SELECT 'price outside 0..1', market || 'Y', CAST(n_out AS VARCHAR) FROM mk WHERE n_out > 0
  UNION ALL SELECT 'end before decision', market, CAST(last_day AS VARCHAR) FROM mk WHERE last_day < decision
  UNION ALL SELECT 'volume is null', market, CAST(n AS VARCHAR) FROM mk WHERE n = 7 AND mon % 2 = 1
  UNION ALL SELECT 'legs share an outcome', event, o FROM outcome WHERE o <> 'OTHER' GROUP BY event, o HAVING count(*) > 1
  UNION ALL SELECT 'market without trades', market, NULL FROM tm WHERE first IS NULL
  UNION ALL SELECT 'trades begin late', market, CAST(CAST(round(10000 * before / total) AS BIGINT) AS VARCHAR) FROM tm WHERE before > 0
  UNION ALL SELECT 'volume is off', market, CAST(CAST(round(10000 * (total - fp) / fp) AS BIGINT) AS VARCHAR) FROM tm WHERE abs((total - fp) / fp) > 0.02
  UNION ALL SELECT 'long gap', id, gaps || '/' || b || '/' || e FROM sm WHERE gaps > 0
  UNION ALL SELECT 'short series', id, CAST(n AS VARCHAR) FROM sm WHERE n < 30
  UNION ALL SELECT 'stale series', id, CAST(seen AS VARCHAR) FROM sm WHERE DATE '{AS_OF}' - seen > 7
  UNION ALL SELECT 'last bar in progress', id, CAST(last AS VARCHAR) FROM sm WHERE last >= DATE '{AS_OF}'
  UNION ALL SELECT 'ticker does not parse', event_id, NULL FROM ev WHERE st = 'P'
  UNION ALL SELECT 'several events in a month', ym, kept FROM mm WHERE n > 1
  UNION ALL SELECT 'event month without decision', kept, ym FROM mm WHERE md IS NULL
  UNION ALL SELECT 'ticker day differs', kept, right(kept, 2) FROM mm WHERE kept NOT LIKE 'KX%' AND CAST(right(kept, 2) AS INT) <> day(md)
  UNION ALL SELECT 'close differs from decision', event_id || '/' || leg, "close" FROM leg JOIN linked USING (event_id) WHERE left("close", 10) <> CAST(md AS VARCHAR)
  UNION ALL SELECT 'unknown leg code', event_id || '/' || leg, leg FROM leg WHERE leg = 'X9'
  UNION ALL SELECT 'several legs paid', event_id, CAST(count(*) AS VARCHAR) FROM leg WHERE result = 'yes' GROUP BY event_id HAVING count(*) > 1
  UNION ALL SELECT 'closes differ', event_id, min("close") || '/' || max("close") FROM leg GROUP BY event_id HAVING count(DISTINCT "close") > 1
  UNION ALL SELECT 'event end unreadable', event_id, "end" FROM pd WHERE md IS NULL
  UNION ALL SELECT 'event not linked', event_id, "end" FROM pd WHERE md IS NOT NULL AND md NOT IN (SELECT md FROM dec)
  UNION ALL SELECT 'several decision events', CAST(meeting_date AS VARCHAR), point_events_decision FROM spine WHERE contains(point_events_decision, ',')
  UNION ALL SELECT 'effective next month', CAST(meeting_date AS VARCHAR), CAST(effective_date AS VARCHAR) FROM spine WHERE month(effective_date) <> month(meeting_date)
  UNION ALL SELECT 'outcomes disagree', CAST(meeting_date AS VARCHAR), ladder_result_outcome || '/' || realized_outcome FROM spine WHERE ladder_result_outcome <> realized_outcome)
SELECT * FROM found
"""


@query("anomaly_table", f"WITH {DECISION_SQL} {ANOMALY_SQL}")
def anomaly_table(t: Tables) -> DataFrame:
    line = F.element_at(F.split("market_id", "#"), -1).cast("int")
    points = domain.points(t).withColumn("p", F.col("p") * 2.02)
    markets = domain.point_markets(t).withColumns({
        "closed": line % 2 == 1, "ts": F.unix_seconds(F.col("end_date").cast("timestamp")) + (line - 4) * 86400, "venue_volume": line,
        "volume": F.when(~((line == 7) & (F.month("end_date") % 2 == 1)), F.col("volume"))})
    bars = domain.quote_bars(t)
    market = F.concat_ws("/", F.date_format("o_orderdate", "yyyy-MM"), "o_orderpriority")
    recorded = t.orders.groupBy(market.alias("market_id")).agg((F.count("*") * (1 + F.max("o_custkey") % 5 / 100.0)).alias("volume_fp"))
    ships = t.lineitem.groupBy(F.concat(F.lit("mode "), F.col("l_suppkey") % 40).alias("series_id"), F.to_date("l_shipdate").alias("date")).agg(
        F.max(F.when(F.col("l_quantity") > 1, F.col("l_quantity"))).alias("value"))
    buys = t.orders.groupBy(F.concat(F.lit("customer "), F.col("o_custkey") % 200).alias("series_id"), F.to_date("o_orderdate").alias("date")).agg(
        F.max("o_totalprice").alias("value"))
    return cov.anomalies(points, markets, domain.staged(t, decisions(t)), ladder_events(t), legs(t), point_events(t), domain.trades(t),
                         bars.where(F.col("interval") == DAY_BAR), recorded, ships.unionAll(buys), F.lit(AS_OF).cast("date"))


# Events of 32 order keys each. The inventory lists an event's orders by key, the venue's record by falling key.
def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())))


def event_bodies(t: Tables) -> tuple[DataFrame, DataFrame]:
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    number = F.floor(k / 32)
    d = F.to_date("o_orderdate")
    question = F.concat((F.when(F.col("o_orderstatus") == "F", "Will there be no change in rates").when(F.col("o_orderstatus") == "O", "Fed decreases interest rates by 25 bps")
                         .otherwise("What happens")), F.lit(" ("), F.when(cust % 9 == 0, "again").otherwise(k.cast("string")), F.lit(")?"))
    tokens = F.to_json(F.array(F.concat(k, F.lit("y")), F.concat(k, F.lit("n"))))
    labels = F.when(cust % 7 == 0, '["Cut","Hold"]').otherwise('["Yes","No"]')
    ours = F.struct(k.alias("k"), question.alias("q"), F.when(cust % 5 != 0, tokens).alias("tokens"), F.when(cust % 4 != 0, labels).alias("outcomes"),
                    F.when(cust % 3 == 0, F.concat(F.date_add(d, 2).cast("string"), F.lit("T00:00:00Z"))).alias("end"), (F.col("o_orderstatus") == "F").alias("closed"),
                    F.when(cust % 8 != 0, F.col("o_totalprice")).alias("vol"))
    theirs = F.struct((-k).alias("k"), k.cast("string").alias("id"), F.concat(F.lit("slug-"), k).alias("slug"), F.when(k % 11 != 0, F.concat(F.lit("0x"), F.hex(k))).alias("conditionId"),
                      F.concat(F.lit("q"), k).alias("questionID"), F.concat(F.lit("  "), F.upper(question)).alias("question"),
                      F.when(cust % 10 != 0, tokens).alias("clobTokenIds"), labels.alias("outcomes"), F.lit('["1","0"]').alias("outcomePrices"), d.cast("string").alias("startDate"),
                      F.date_add(d, 3).cast("string").alias("endDate"), F.col("o_totalprice").alias("volumeNum"), (F.col("o_orderpriority") == "1-URGENT").alias("negRisk"),
                      F.lit("resolved").alias("umaResolutionStatus"), F.when(cust % 2 == 0, "paper").alias("resolutionSource"), F.col("o_orderpriority").alias("description"))
    per = t.orders.groupBy(number.alias("n")).agg(F.min(d).alias("d0"), F.max(d).alias("d1"), F.sort_array(F.collect_list(ours)).alias("ours"),
                                                  F.sort_array(F.collect_list(F.when(k % 6 != 0, theirs))).alias("theirs"))
    event = F.concat(F.lit("event-"), F.col("n"))
    half = lambda body, rule: F.when(rule, F.expr("substring(body, 1, cast(length(body) / 2 as int))")).otherwise(F.col(body))
    inventory = per.select("n", event.alias("event_id"), _json(title=event, start=F.when(F.col("n") % 7 == 0, "").otherwise(F.col("d0").cast("string")),
                                                               end=F.col("d1").cast("string"), closed=F.col("n") % 2 == 0, markets=F.col("ours")).alias("body"))
    venue = per.where("n % 13 <> 0").select("n", event.alias("event_id"), _json(id=F.concat(F.lit("v"), F.col("n")), negRisk=F.col("n") % 3 == 0,
                                                                             resolutionSource=F.lit("board"), markets=F.col("theirs")).alias("body"))
    return (inventory.withColumn("body", half("body", F.col("n") % 19 == 0)).drop("n"), venue.withColumn("body", half("body", F.col("n") % 17 == 0)).drop("n"))


def _matched(t: Tables) -> DataFrame:
    inventory, venue = event_bodies(t)
    days = t.orders.select(F.trunc("o_orderdate", "MM").alias("m0")).distinct().select(_decision(F.col("m0")).alias("decision_day"))
    return match_events(inventory, venue, days, "decision_day")


EVENT_SQL = """
WITH ord AS (SELECT *, o_orderkey // 32 AS n, CAST(o_orderdate AS DATE) AS d, CASE o_orderstatus WHEN 'F' THEN 'Will there be no change in rates' WHEN 'O' THEN 'Fed decreases interest rates by 25 bps'
               ELSE 'What happens' END || ' (' || if(o_custkey % 9 = 0, 'again', CAST(o_orderkey AS VARCHAR)) || ')?' AS q FROM orders),
ev AS (SELECT n, min(d) AS d0, max(d) AS d1 FROM ord GROUP BY n),
cal AS (SELECT DISTINCT CASE WHEN month(d) IN (6, 12) THEN last_day(d) ELSE CAST(date_trunc('month', d) AS DATE) + 14 END AS c FROM ord),
near AS (SELECT n, arg_min(c, (abs(d1 - c), c)) AS decision FROM ev, cal WHERE abs(d1 - c) <= 8 GROUP BY n),
rec AS (SELECT * FROM ord WHERE o_orderkey % 6 <> 0 AND n % 13 <> 0 AND n % 17 <> 0),
hit AS (SELECT a.o_orderkey AS k, coalesce(max(b.o_orderkey) FILTER (WHERE b.o_orderkey = a.o_orderkey AND a.o_custkey % 5 <> 0 AND b.o_custkey % 10 <> 0),
          max(b.o_orderkey) FILTER (WHERE lower(b.q) = lower(a.q))) AS r FROM ord a LEFT JOIN rec b ON b.n = a.n AND (b.o_orderkey = a.o_orderkey OR lower(b.q) = lower(a.q)) GROUP BY 1),
m AS (SELECT a.*, 'event-' || a.n AS event, row_number() OVER (PARTITION BY a.n ORDER BY a.o_orderkey) - 1 AS idx, ev.d0, ev.d1, near.decision, b.o_orderkey AS rk, b.o_custkey AS rc, b.d AS rd, b.o_totalprice AS rp,
        b.o_orderpriority AS rpri, if(b.o_orderkey % 11 <> 0, '0x' || upper(to_hex(b.o_orderkey)), NULL) AS cond, (SELECT count(*) FROM rec WHERE rec.n = a.n) AS n_rec,
        if(a.o_custkey % 5 <> 0, a.o_orderkey, if(b.o_custkey % 10 <> 0, b.o_orderkey, NULL)) AS tok, coalesce(if(a.o_custkey % 4 <> 0, a.o_custkey, NULL), b.o_custkey) % 7 = 0 AS cut,
        a.o_custkey % 4 <> 0 OR b.o_custkey IS NOT NULL AS labelled
      FROM ord a JOIN ev USING (n) LEFT JOIN near USING (n) JOIN hit ON k = a.o_orderkey LEFT JOIN ord b ON b.o_orderkey = hit.r WHERE a.n % 19 <> 0),
named AS (SELECT *, coalesce(cond, event || '#' || idx) AS market FROM m)
"""


@query("flatten_events", EVENT_SQL + """
SELECT event AS event_id, market AS market_id, CASE o_orderstatus WHEN 'F' THEN 'HOLD' WHEN 'O' THEN 'CUT25' ELSE 'OTHER' END AS outcome,
  CASE o_orderstatus WHEN 'F' THEN 'HOLD' WHEN 'O' THEN 'CUT25' ELSE 'UNMAPPED' END AS outcome_detail, CAST(epoch(if(o_custkey % 3 = 0, d + 2, d1)) AS BIGINT) AS ts,
  q AS question, if(labelled, if(cut, '["Cut","Hold"]', '["Yes","No"]'), '[]') AS outcomes, coalesce('["' || tok || 'y","' || tok || 'n"]', '[]') AS token_ids,
  if(labelled AND NOT cut, coalesce(tok || 'y', ''), '') AS yes_token_id, if(labelled AND NOT cut, coalesce(tok || 'n', ''), '') AS no_token_id,
  if(n % 7 = 0, '', CAST(d0 AS VARCHAR)) AS start_date, if(o_custkey % 3 = 0, CAST(d + 2 AS VARCHAR) || 'T00:00:00Z', CAST(d1 AS VARCHAR)) AS end_date, CAST(decision AS VARCHAR) AS decision_date,
  o_orderstatus = 'F' AS closed, n % 2 = 0 AS event_closed, if(o_custkey % 8 <> 0, o_totalprice, NULL) AS volume, rp AS venue_volume,
  (n % 3 = 0 AND n % 13 <> 0 AND n % 17 <> 0) OR coalesce(rpri = '1-URGENT', FALSE) AS neg_risk, if(rk IS NULL, '[]', '["1","0"]') AS final_outcome_prices, coalesce(rpri, '') AS description,
  if(n % 13 <> 0 AND n % 17 <> 0, 'v' || n, '') AS venue_event_id, coalesce(CAST(rk AS VARCHAR), '') AS venue_market_id, coalesce('slug-' || rk, '') AS market_slug, coalesce(cond, '') AS condition_id,
  coalesce('q' || rk, '') AS question_id, coalesce(CAST(rd AS VARCHAR), '') AS venue_start_date, coalesce(CAST(rd + 3 AS VARCHAR), '') AS venue_end_date, if(rk IS NULL, '', 'resolved') AS resolution_status,
  if(rc % 2 = 0, 'paper', if(n % 13 <> 0 AND n % 17 <> 0, 'board', '')) AS resolution_source
FROM named
""")
def flatten_events(t: Tables) -> DataFrame:
    return event_markets(_matched(t)).drop("venue", "mapping_note", "event_title", "closed_time", "venue_liquidity", "enable_order_book")


@query("event_anomalies", EVENT_SQL + """
SELECT 'event start is empty' AS "check", 'event-' || n AS key, CAST(d1 AS VARCHAR) AS detail FROM ev WHERE n % 7 = 0 AND n % 19 <> 0
UNION ALL SELECT 'no decision near the end', 'event-' || n, CAST(d1 AS VARCHAR) FROM ev LEFT JOIN near USING (n) WHERE decision IS NULL AND n % 19 <> 0
UNION ALL SELECT 'venue record unreadable', 'event-' || n, NULL FROM ev WHERE n % 17 = 0 AND n % 13 <> 0 AND n % 19 <> 0
UNION ALL SELECT 'no matching venue record', market, q FROM named WHERE rk IS NULL AND n_rec > 0
UNION ALL SELECT 'tokens recovered', market, q FROM named WHERE o_custkey % 5 = 0 AND tok IS NOT NULL
UNION ALL SELECT 'tokens missing', market, q FROM named WHERE tok IS NULL
UNION ALL SELECT 'question not mapped', market, q FROM named WHERE o_orderstatus = 'P'
UNION ALL SELECT 'no condition id', market, q FROM named WHERE cond IS NULL
UNION ALL SELECT 'no Yes label', market, if(labelled, '["Cut","Hold"]', '[]') FROM named WHERE cut OR NOT labelled
UNION ALL SELECT 'market end differs', market, CAST(d + 2 AS VARCHAR) || 'T00:00:00Z' FROM named WHERE o_custkey % 3 = 0 AND d + 2 <> d1
""")
def landing_anomalies(t: Tables) -> DataFrame:
    return event_anomalies(_matched(t))


@query("unreadable_events", """
SELECT 'inventory' AS source, 'event-' || n AS event_id, 'unreadable_body' AS rule FROM (SELECT DISTINCT o_orderkey // 32 AS n FROM orders) WHERE n % 19 = 0
UNION ALL SELECT 'venue', 'event-' || n, 'unreadable_body' FROM (SELECT DISTINCT o_orderkey // 32 AS n FROM orders) WHERE n % 17 = 0 AND n % 13 <> 0
""")
def unreadable_event_bodies(t: Tables) -> DataFrame:
    inventory, venue = event_bodies(t)
    broken = unreadable_events(inventory).withColumn("source", F.lit("inventory")).unionByName(
        unreadable_events(venue, schemas.VENUE_EVENT_JSON).withColumn("source", F.lit("venue")))
    return broken.select("source", "event_id", "rule")
