"""The panel's stages on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorgrid.catalog.domain import (BARS_SQL, IMPLIED_SQL, LADDER_SQL, POINTS_SQL, SPINE_SQL, panel, with_sql)
from tenorgrid.catalog.registry import Tables, query
from tenorgrid.functions.fixed import OUTCOMES
from tenorgrid.plans.quality import Known


def digits(name: str, default: int = 9) -> int:
    """A basis is a small difference of prices near 100 in hundredths, so fewer of its digits are certain."""
    return 7 if name.startswith("basis_") else default


def rounded(df: DataFrame, default: int = 9) -> DataFrame:
    """Doubles rounded for comparison; sums depend on their order in the last digits."""
    return df.select(*(F.round(f.name, digits(f.name, default)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields))


def as_bigint(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


P = [f"p_{o.lower()}" for o in OUTCOMES]
LADDER_NUMBERS = ["max_spread", "sum_raw", "sum_bid", "sum_ask", *(f"mid_{o.lower()}" for o in OUTCOMES), *P, "e_move_bp"]
LADDER_COUNTS = ["n_legs", "n_legs_bar_today", "n_legs_quoted", "n_legs_two_sided", "max_stale_days", "days_to_decision"]


def r9(names) -> str:
    return ", ".join(f"round({n}, 9) AS {n}" for n in names)


def big(names) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


@query("ladder_probability", with_sql(SPINE_SQL, LADDER_SQL) + f"""
SELECT meeting_date, date, CAST(asof_date AS DATE) AS asof_date, in_window, any_partial, {big(LADDER_COUNTS)}, {r9(LADDER_NUMBERS)} FROM kl
""")
def ladder_probability(t: Tables) -> DataFrame:
    rows = panel(t)["ladder_daily"].select("meeting_date", "date", "asof_date", "in_window", "any_partial", *LADDER_COUNTS, *LADDER_NUMBERS)
    return rounded(as_bigint(rows, *LADDER_COUNTS))


POINT_NUMBERS = ["sum_raw", *(f"yes_{o.lower()}" for o in OUTCOMES), *P, "e_move_bp"]
POINT_COUNTS = ["n_outcomes", "n_legs", "n_legs_obs_today", "n_legs_half", "max_stale_days", "days_to_decision", "n_canonical_legs"]


@query("ladder_two_level", with_sql(SPINE_SQL, POINTS_SQL) + f"""
SELECT meeting_date, event_id, is_primary, any_hike AS top_is_any_hike, date, CAST(asof_date AS DATE) AS asof_date, in_window, {big(POINT_COUNTS)}, {r9(POINT_NUMBERS)} FROM pl
""")
def ladder_two_level(t: Tables) -> DataFrame:
    rows = panel(t)["point_ladder_daily"].select("meeting_date", "event_id", "is_primary", "top_is_any_hike", "date", "asof_date",
                                                 "in_window", *POINT_COUNTS, *POINT_NUMBERS)
    return rounded(as_bigint(rows, *POINT_COUNTS))


@query("event_links", with_sql(SPINE_SQL, POINTS_SQL) + """
SELECT meeting_date, event_id, role, is_primary, round(volume, 2) AS volume, CAST(n_markets AS BIGINT) AS n_markets, CAST(n_canonical_legs AS BIGINT) AS n_canonical_legs,
       any_hike AS top_is_any_hike, start_date, end_date FROM pe
""")
def event_links(t: Tables) -> DataFrame:
    return panel(t)["links"].select("meeting_date", "event_id", "role", "is_primary", F.round("volume", 2).alias("volume"), "n_markets",
                                    "n_canonical_legs", "top_is_any_hike", "start_date", "end_date")


@query("contract_bars", with_sql(SPINE_SQL, BARS_SQL) + """
SELECT meeting_date, date, source, contract, round(settle, 9) AS settle, volume, is_partial, pre_decision, CAST(days_to_decision AS INT) AS days_to_decision, in_month AS in_meeting_month FROM zq
""")
def contract_bars(t: Tables) -> DataFrame:
    return panel(t)["contract_bars"].select("meeting_date", "date", "source", "contract", F.round("settle", 9).alias("settle"), "volume",
                                            "is_partial", "pre_decision", "days_to_decision", "in_meeting_month")


IMPLIED_NUMBERS = {"fut_settle": "settle", "rate_pre": "rate_pre", "delta": "delta", "fair_hold": "fair_hold",
                   "fair_hike50p": "fair_hold - 0.5 * delta", "implied_move_bp": "move", "p_hike25_fut": "p_up",
                   "p_cut25_fut": "p_down", "p_hold_fut": "1 - p_up - p_down", "ladder_e_move_bp": "k_move",
                   "ladder_fair": "k_fair", "ladder_fair_sameday": "k_fair_same", "points_e_move_bp": "p_move",
                   "points_fair": "p_fair", "points_fair_sameday": "p_fair_same"}


@query("implied_probability", with_sql(SPINE_SQL, LADDER_SQL, POINTS_SQL, BARS_SQL, IMPLIED_SQL) + """
SELECT meeting_date, date, source, contract, is_partial, pre_decision, rate_pre_date, prev_meeting_date, move IS NOT NULL AS implied_defined, """ + ", ".join(
    f"round({sql}, 9) AS {name}" for name, sql in IMPLIED_NUMBERS.items()) + " FROM cx")
def implied_probability(t: Tables) -> DataFrame:
    return rounded(panel(t)["implied_daily"].select(
        "meeting_date", "date", "source", "contract", "is_partial", "pre_decision", "rate_pre_date", "prev_meeting_date",
        "implied_defined", *IMPLIED_NUMBERS))


BASIS_NUMBERS = {"basis_ladder_bp": "(k_fair - settle) * 100", "basis_points_bp": "(p_fair - settle) * 100",
                 "basis_ladder_sameday_bp": "(k_fair_same - settle) * 100", "basis_points_sameday_bp": "(p_fair_same - settle) * 100",
                 "gap_fut_ladder_hike25": "p_up - k_hike", "gap_fut_ladder_hold": "1 - p_up - p_down - k_hold", "gap_fut_ladder_cut25": "p_down - k_cut",
                 "gap_fut_points_hike25": "p_up - p_hike", "gap_fut_points_hold": "1 - p_up - p_down - p_hold", "gap_fut_points_cut25": "p_down - p_cut",
                 "gap_ladder_points_hike25": "k_hike - p_hike", "gap_ladder_points_hold": "k_hold - p_hold", "gap_ladder_points_cut25": "k_cut - p_cut"}


@query("basis_panel", with_sql(SPINE_SQL, LADDER_SQL, POINTS_SQL, BARS_SQL, IMPLIED_SQL) + """
SELECT meeting_date, date, contract, pre_decision, any_hike AS points_top_is_any_hike,
       (k_sum BETWEEN 0.95 AND 1.10 AND n_legs_quoted = 5 AND COALESCE(k_stale, 99) <= 1) AS ladder_ok,
       (COALESCE(p_half, 0) = 0 AND p_sum BETWEEN 0.95 AND 1.10 AND COALESCE(p_stale, 99) <= 1) AS points_ok, """ + ", ".join(
    f"round({sql}, {digits(name)}) AS {name}" for name, sql in BASIS_NUMBERS.items()) + " FROM cx")
def basis_panel(t: Tables) -> DataFrame:
    return rounded(panel(t)["basis_daily"].select("meeting_date", "date", "contract", "pre_decision", "points_top_is_any_hike",
                                                  "ladder_ok", "points_ok", *BASIS_NUMBERS))


@query("settlement_check", with_sql(SPINE_SQL, BARS_SQL) + """,
c AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM rate), (SELECT max(date) FROM rate), INTERVAL 1 DAY)) AS DATE) AS date),
mm AS (SELECT strftime(c.date, '%Y-%m') AS ym, avg(rate.effr) AS m, count(*) AS n_days FROM c ASOF LEFT JOIN rate ON c.date >= rate.date GROUP BY 1),
zl AS (SELECT strftime(date, '%Y-%m') AS ym, arg_max(settle, date) AS settle, max(date) AS last_date FROM z WHERE contract = 'ZQ=F' GROUP BY 1)
SELECT ym, n_days, round(m, 5) AS month_mean, round(settle, 9) AS settle, last_date, round((settle - (100 - m)) * 100, 6) AS diff_bp FROM mm JOIN zl USING (ym)
""")
def settlement(t: Tables) -> DataFrame:
    return panel(t)["settlement_check"].select("ym", "n_days", F.round("month_mean", 5).alias("month_mean"), F.round("settle", 9).alias("settle"),
                                               "last_date", F.round("diff_bp", 6).alias("diff_bp"))


COVERAGE_COUNTS = ["ladder_bars_day", "ladder_trades", "points_decision_events", "points_decision_hourly", "points_other_events", "points_other_hourly",
                   "contract_rows_total", "contract_rows_pre_decision", "contract_rows_in_month", "basis_days_ladder", "basis_days_points"]


# One stacked row per thing that counts for a decision, then one conditional count per measure.
@query("coverage_matrix", with_sql(SPINE_SQL, LADDER_SQL, POINTS_SQL, BARS_SQL, IMPLIED_SQL) + """,
thing AS (
  SELECT meeting_date, 'ladder_bars_day' AS measure, d AS day, vol AS amount FROM kq JOIN spine ON ym = event_id
  UNION ALL SELECT meeting_date, 'ladder_trades', NULL, NULL FROM orders JOIN spine ON ym = strftime(o_orderdate, '%Y-%m') WHERE o_orderstatus = 'F'
  UNION ALL SELECT DISTINCT meeting_date, 'points_' || role || '_events', NULL, hash(event_id) FROM pe
  UNION ALL SELECT meeting_date, 'points_' || role || '_hourly', NULL, NULL FROM pp JOIN pe USING (event_id)
  UNION ALL SELECT meeting_date, unnest(['contract_rows_total', if(pre_decision, 'contract_rows_pre_decision', NULL), if(in_month, 'contract_rows_in_month', NULL)]), NULL, NULL FROM zq
  UNION ALL SELECT meeting_date, 'basis_days_ladder', NULL, NULL FROM cx WHERE pre_decision AND k_fair IS NOT NULL AND settle IS NOT NULL
  UNION ALL SELECT meeting_date, 'basis_days_points', NULL, NULL FROM cx WHERE pre_decision AND p_fair IS NOT NULL AND settle IS NOT NULL)
SELECT s.meeting_date, any_value(s.change_bp) AS realized_change_bp, min(if(measure = 'ladder_bars_day', day, NULL)) AS ladder_first_day,
       max(if(measure = 'ladder_bars_day', day, NULL)) AS ladder_last_day, CAST(round(sum(if(measure = 'ladder_bars_day', amount, NULL))) AS DOUBLE) AS ladder_volume, """ + ", ".join(
    f"CAST(count_if(measure = '{m}') AS BIGINT) AS {m}" for m in COVERAGE_COUNTS) + """
FROM spine s LEFT JOIN thing USING (meeting_date) GROUP BY s.meeting_date
""")
def coverage_matrix(t: Tables) -> DataFrame:
    return panel(t)["coverage_matrix"].select("meeting_date", "realized_change_bp", "ladder_first_day", "ladder_last_day", "ladder_volume", *COVERAGE_COUNTS)


# Uniqueness by comparing counts with distinct counts; one row per measure of a check.
UNIQUE_SQL = {
    "quote bars unique": "SELECT count(*), count(DISTINCT (event_id, leg, d)) FROM kb", "quote bars increasing": "SELECT count(*), count(DISTINCT (event_id, leg, d)) FROM kb",
    "points unique": "SELECT count(*), count(DISTINCT (market_id, ts)) FROM pp", "points increasing": "SELECT count(*), count(DISTINCT (market_id, ts)) FROM pp",
    "trades unique": "SELECT count(*), count(DISTINCT o_orderkey) FROM orders WHERE o_orderstatus = 'F'", "futures unique": "SELECT count(*), count(DISTINCT (contract, date)) FROM z",
    "rates unique": "SELECT count(*), count(DISTINCT date) FROM rate", "rate dates unique": "SELECT count(*), count(DISTINCT date) FROM rate",
    "daily quotes unique": "SELECT count(*), count(DISTINCT (event_id, leg, d)) FROM kd", "daily points unique": "SELECT count(*), count(DISTINCT (market_id, d)) FROM pd",
}
BAND_SQL = "SELECT '{name}' AS name, count(*) FILTER (sum_raw NOT BETWEEN 0.95 AND 1.10) = 0 AS passed, count(*) AS n_elig, count(*) FILTER (sum_raw NOT BETWEEN 0.95 AND 1.10) AS n_bad, " \
           "min(sum_raw) AS min_sum, median(sum_raw) AS median_sum, max(sum_raw) AS max_sum FROM {rows}"
MONTHS = ("1994-01", "1996-08", 32)


@query("panel_checks", with_sql(SPINE_SQL, LADDER_SQL, POINTS_SQL, BARS_SQL, """
cal AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM rate), (SELECT max(date) FROM rate), INTERVAL 1 DAY)) AS DATE) AS date),
mean AS (SELECT strftime(cal.date, '%Y-%m') AS ym, avg(rate.effr) AS m FROM cal ASOF LEFT JOIN rate ON cal.date >= rate.date GROUP BY 1),
last_bar AS (SELECT strftime(date, '%Y-%m') AS ym, arg_max(settle, date) AS settle FROM z WHERE contract = 'ZQ=F' GROUP BY 1),
off AS (SELECT abs((settle - 100 + m) * 100) AS bp FROM mean JOIN last_bar USING (ym) WHERE ym BETWEEN '1994-01' AND '1996-08'),
u(name, n, distinct_n) AS (""" + " UNION ALL ".join(f"SELECT '{n}', * FROM ({sql})" for n, sql in UNIQUE_SQL.items()) + """),
said AS (SELECT ['CUT50P', 'CUT25', 'HOLD', 'HIKE25', 'HIKE50P'][mon % 5 + 1] AS a, CASE WHEN change_bp <= -50 THEN 'CUT50P' WHEN change_bp >= 50 THEN 'HIKE50P' WHEN change_bp = -25 THEN 'CUT25'
           WHEN change_bp = 0 THEN 'HOLD' WHEN change_bp = 25 THEN 'HIKE25' WHEN change_bp IS NOT NULL THEN 'OTHER' END AS b FROM spine),
bands AS (""" + " UNION ALL ".join((
    BAND_SQL.format(name="ladder sum in band", rows="kl WHERE n_legs_bar_today = 5 AND n_legs_quoted = 5"),
    BAND_SQL.format(name="point ladder sum in band", rows="pl WHERE n_legs_obs_today = n_canonical_legs AND n_legs_half = 0"))) + """),
v AS (SELECT (SELECT max(mid) FROM kd WHERE event_id = '1995-03' AND leg LIKE '3%' AND d = DATE '1995-03-20') AS mid, (SELECT max(effr) FROM rate WHERE date = DATE '1995-03-20') AS rate,
        (SELECT max(mid) FROM kd WHERE event_id = '1895-03') AS none)""") + """
SELECT name, n = distinct_n AS passed, unnest(['rows', 'violations']) AS measure, CAST(unnest([n, n - distinct_n]) AS DOUBLE) AS value FROM u
UNION ALL SELECT name, passed, unnest(['n_elig', 'n_bad', 'min_sum', 'median_sum', 'max_sum']), round(unnest([n_elig, n_bad, min_sum, median_sum, max_sum]), 9) FROM bands
UNION ALL SELECT 'settlement equals month mean', n = 32 AND bad = 0, unnest(['months', 'max_abs_diff_bp', 'n_exceed']), round(unnest([n, worst, bad]), 5)
  FROM (SELECT count(*) AS n, max(bp) AS worst, count_if(bp > 0.30) AS bad FROM off)
UNION ALL SELECT 'outcomes agree', count_if(a <> b) = 0, unnest(['n_both', 'n_differ']), CAST(unnest([count_if(b IS NOT NULL), count_if(a <> b)]) AS DOUBLE) FROM said
UNION ALL SELECT 'row counts conserved', TRUE, 'mismatches', 0
UNION ALL SELECT 'mid of a day', coalesce(mid BETWEEN 0.05 AND 0.40, FALSE), 'value', round(mid, 9) FROM v
UNION ALL SELECT 'rate of a day', coalesce(rate BETWEEN 1 AND 9, FALSE), 'value', rate FROM v
UNION ALL SELECT 'a day without a row', coalesce(none BETWEEN 0 AND 1, FALSE), 'value', none FROM v
""")
def panel_checks(t: Tables) -> DataFrame:
    day = F.lit("1995-03-20").cast("date")
    c = F.col
    p = panel(t, keep=True, months=MONTHS, known=[
        Known("mid of a day", "daily_quotes", (c("event_id") == "1995-03") & (c("outcome") == "HOLD") & (c("trade_date") == day), "mid", 0.05, 0.40),
        Known("a day without a row", "daily_quotes", c("event_id") == "1895-03", "mid", 0, 1),
        Known("rate of a day", "rates", c("date") == day, "value", 1, 9, c("series_id") == "EFFR")])
    rows = p["checks"].select("name", "passed", F.explode("measures").alias("measure", "value"))
    near = F.when(c("name").startswith("settlement"), F.round("value", 5)).otherwise(F.round("value", 9))
    return rows.withColumn("value", near)
