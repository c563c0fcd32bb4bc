"""Coverage, reconciliation and anomaly reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenorgrid.functions.fixed import DAY_BAR, HOUR_BAR, LEG_OUTCOME, MINUTE_BAR, OTHER
from tenorgrid.functions.text import event_month
from tenorgrid.functions.times import epoch_iso, month_key
from tenorgrid.operators.aggregates import last_value, share_before
from tenorgrid.operators.rules import Rule, broken_rules
from tenorgrid.operators.skew import dimension_join

DAY_S = 86400


def coverage(spine: DataFrame, bars: DataFrame, trades: DataFrame, links: DataFrame, points: DataFrame,
             contract_rows: DataFrame, basis: DataFrame) -> DataFrame:
    """One row per decision: what each source holds for it, zero where a source holds nothing.

    Every fact is reduced to its entity before it meets the spine.
    """
    at = lambda res, c: F.when(F.col("interval") == res, F.col(c))
    kc = bars.groupBy(F.col("event_id").alias("ladder_event")).agg(
        F.count_if(F.col("interval") == DAY_BAR).alias("ladder_bars_day"),
        F.count_if(F.col("interval") == HOUR_BAR).alias("ladder_bars_hour"),
        F.count_if(F.col("interval") == MINUTE_BAR).alias("ladder_bars_minute"),
        F.min(at(DAY_BAR, "trade_date")).alias("ladder_first_day"), F.max(at(DAY_BAR, "trade_date")).alias("ladder_last_day"),
        F.round(F.sum(F.when(F.col("interval") == DAY_BAR, F.col("vol")).otherwise(0.0))).alias("ladder_volume"))
    kt = trades.groupBy(F.col("event_id").alias("ladder_event")).agg(
        F.count("*").alias("ladder_trades"), F.to_date(F.timestamp_seconds(F.min("ts"))).alias("ladder_first_trade"))

    hourly = F.col("fidelity") == HOUR_BAR
    per_event = points.groupBy("event_id").agg(
        F.count_if(hourly).alias("h"), F.count_if(F.col("fidelity") == MINUTE_BAR).alias("m"),
        F.min(F.when(hourly, F.col("ts"))).alias("t0"), F.max(F.when(hourly, F.col("ts"))).alias("t1"))
    role = lambda r, c: F.when(F.col("role") == r, F.col(c))
    day = lambda c: F.to_date(F.timestamp_seconds(c))
    pp = links.select("meeting_date", "role", "event_id").join(per_event, "event_id", "left").groupBy("meeting_date").agg(
        F.countDistinct(role("decision", "event_id")).alias("points_decision_events"),
        F.sum(role("decision", "h")).alias("points_decision_hourly"), F.sum(role("decision", "m")).alias("points_decision_minute"),
        day(F.min(role("decision", "t0"))).alias("points_first_day"), day(F.max(role("decision", "t1"))).alias("points_last_day"),
        F.countDistinct(role("other", "event_id")).alias("points_other_events"),
        F.sum(role("other", "h")).alias("points_other_hourly"), F.sum(role("other", "m")).alias("points_other_minute"))
    zq = contract_rows.groupBy("meeting_date").agg(
        F.count("*").alias("contract_rows_total"), F.count_if("pre_decision").alias("contract_rows_pre_decision"),
        F.count_if("in_meeting_month").alias("contract_rows_in_month"), F.min("date").alias("contract_first_day"),
        F.max("date").alias("contract_last_day"))
    bs = basis.groupBy("meeting_date").agg(
        F.count_if(F.col("basis_ladder_bp").isNotNull() & F.col("pre_decision")).alias("basis_days_ladder"),
        F.count_if(F.col("basis_points_bp").isNotNull() & F.col("pre_decision")).alias("basis_days_points"))

    out = spine.select("meeting_date", "meeting_month", "realized_outcome", "ladder_event", "ladder_status",
                       "ladder_result_outcome", "contract_source", "contract_symbol", "contract_data_available",
                       "realized_change_bp")
    for facts, key in ((kc, "ladder_event"), (kt, "ladder_event"), (pp, "meeting_date"), (zq, "meeting_date"),
                       (bs, "meeting_date")):
        out = out.join(facts, key, "left")
    counts = [c for c in out.columns if c.startswith((
        "ladder_bars", "ladder_trades", "points_decision", "points_other", "contract_rows", "basis_days"))]
    return out.fillna(0, subset=counts)


def trade_coverage(trades: DataFrame, bars: DataFrame) -> DataFrame:
    """Per market: trades held, and the share of daily bar volume that lies before the first of them."""
    per = trades.groupBy("market_id").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n_trades"),
        F.sum("count").alias("trades_contracts"))
    daily = bars.where(F.col("interval") == DAY_BAR)
    share = share_before(daily, per, "market_id", "ts", "first_ts", "vol")
    return per.join(share, "market_id", "left").select(
        "market_id", epoch_iso("first_ts").alias("first_trade_utc"), epoch_iso("last_ts").alias("last_trade_utc"),
        "n_trades", "trades_contracts", F.coalesce("amount_total", F.lit(0.0)).alias("bar_volume"),
        F.coalesce("amount_before", F.lit(0.0)).alias("bar_volume_before_first_trade"),
        F.col("share_before").alias("share_missing"))


def reconcile_totals(facts: DataFrame, dim: DataFrame, key: str, amount: str, total: str, tol: float = 0.02) -> DataFrame:
    """Per key with facts: summed amount against a recorded total, relative difference, and a flag beyond ``tol``."""
    summed = facts.groupBy(key).agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias("amount_sum"))
    rows = dim.select(key, F.coalesce(F.col(total), F.lit(0.0)).alias("total")).join(summed, key)
    rel = (F.col("amount_sum") - F.col("total")) / F.nullif(F.col("total"), F.lit(0.0))
    return rows.withColumns({"rel_diff": rel, "is_off": F.coalesce(F.abs(rel) > tol, F.lit(False))})


def series_profile(df: DataFrame, by: Sequence[str], d: str, value: str, as_of: Column, volume: str | None = None,
                   max_stale: int = 7, min_rows: int = 30) -> DataFrame:
    """Rows, NULLs, first and last date, last non-NULL value with its date and age, and two flags per series."""
    seen = F.when(F.col(value).isNotNull(), F.col(d))
    aggs = [F.count("*").alias("n_rows"), F.count_if(F.col(value).isNull()).alias("n_null"), F.min(d).alias("first_date"),
            F.max(d).alias("last_date"), last_value(value, d).alias("last_value"), F.max(seen).alias("last_value_date")]
    if volume is not None:
        aggs.append(F.count_if(F.coalesce(F.col(volume), F.lit(0)) == 0).alias("n_zero_volume"))
    out = df.groupBy(*by).agg(*aggs).withColumn("stale_days", F.datediff(as_of, "last_value_date"))
    return out.withColumns({"is_stale": F.col("stale_days") > max_stale, "is_short": F.col("n_rows") < min_rows})


def event_coverage(points: DataFrame) -> DataFrame:
    """Rows, tokens, first and last time per event and resolution."""
    return points.groupBy("event_id", "fidelity").agg(
        F.count("*").alias("n_rows"), F.countDistinct("token_id").alias("n_tokens"), F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"))


def trailing_bounds(points: DataFrame, ends: DataFrame, now: Column, days: int = 45) -> DataFrame:
    """Per token: the window to keep. ``ends`` is (``market_id``, ``closed``, ``end_ts``).

    A closed market ends at its nominal end plus a day or at its last hourly point plus an hour, whichever is
    first; an open one ends now. The window never starts before the first hourly point less an hour.
    """
    hours = points.where(F.col("fidelity") == HOUR_BAR).groupBy("market_id", "token_id").agg(
        F.min("ts").alias("h0"), F.max("ts").alias("h1"))
    rows = dimension_join(hours, ends.select("market_id", "closed", "end_ts"), ["market_id"])
    closed = F.coalesce("closed", F.lit(False))
    end = F.when(closed, F.least(F.col("end_ts") + DAY_S, F.col("h1") + 3600)).otherwise(now)
    return rows.withColumn("keep_until", end).withColumn(
        "keep_from", F.greatest(F.col("keep_until") - days * DAY_S, F.col("h0") - 3600)).select(
        "market_id", "token_id", "keep_from", "keep_until")


def trailing_trim(points: DataFrame, bounds: DataFrame, fidelity: int = MINUTE_BAR) -> DataFrame:
    """Keep all other resolutions, and of this one the points inside their token's window."""
    rows = dimension_join(points, bounds.select("token_id", "keep_from", "keep_until"), ["token_id"])
    inside = F.coalesce(F.col("ts").between(F.col("keep_from"), F.col("keep_until")), F.lit(False))
    return rows.where((F.col("fidelity") != fidelity) | inside).select(*points.columns)


def point_anomalies(points: DataFrame, markets: DataFrame) -> DataFrame:
    """Series against their markets: points by token once, markets once by row and once by outcome of an event."""
    col = F.col
    days = lambda a, b: F.round((a - b) / DAY_S, 1)
    ends = markets.select("market_id", "closed", F.when(col("ts") >= 0, col("ts")).alias("end_ts"))
    tokens = points.groupBy("market_id", "token_id").agg(
        F.max(F.when(col("fidelity") == HOUR_BAR, col("ts"))).alias("last_ts"),
        F.count_if((col("p") < 0) | (col("p") > 1)).alias("n_outside"))
    tokens = dimension_join(tokens, ends, ["market_id"])
    end_d, decision_d = col("end_date").try_cast("date"), col("decision_date").try_cast("date")
    legs = markets.where(col("outcome") != OTHER).groupBy("event_id", "outcome").agg(F.count("*").alias("n"))
    return broken_rules(tokens, [
        Rule("series ends early", col("closed") & (col("last_ts") + 3600 < col("end_ts") - 2 * DAY_S), col("token_id"), days(col("end_ts"), col("last_ts"))),
        Rule("series runs past end", col("closed") & (col("last_ts") > col("end_ts") + 3 * DAY_S), col("token_id"), days(col("last_ts"), col("end_ts"))),
        Rule("price outside 0..1", col("n_outside") > 0, col("token_id"), col("n_outside")),
    ]).unionAll(broken_rules(markets, [
        Rule("end before decision", end_d < decision_d, col("market_id"), col("end_date")),
        Rule("volume is null", col("volume").isNull(), col("market_id"), col("venue_volume")),
    ])).unionAll(broken_rules(legs, [Rule("legs share an outcome", col("n") > 1, col("event_id"), col("outcome"))]))


def link_anomalies(spine: DataFrame, ladder_events: DataFrame, legs: DataFrame, point_events: DataFrame) -> DataFrame:
    """What does not fit between the decisions and the events of both venues.

    Events are checked by row (their ticker) and by month, legs by row and by event. Of several events of a month only
    the first is linked, so only its day and its month are compared with the decision.
    """
    col = F.col
    decisions = spine.select("meeting_date", "meeting_month", "ladder_event")
    parsed = ladder_events.select("event_id", "seq", event_month("event_id").alias("m"))
    first = F.min(F.struct("seq", "event_id", col("m.day").alias("day")))
    months = parsed.where("m.ym IS NOT NULL").groupBy(col("m.ym").alias("meeting_month")).agg(
        F.count("*").alias("n"), first.alias("kept")).join(decisions.drop("ladder_event"), "meeting_month", "left")
    dated = legs.join(decisions.withColumnRenamed("ladder_event", "event_id"), "event_id", "left")
    leg_name = F.concat_ws("/", "event_id", "leg")
    events = legs.groupBy("event_id").agg(F.count_if(col("result") == "yes").alias("n_paid"), F.min("close").alias("c0"), F.max("close").alias("c1"))
    linked = point_events.withColumn("meeting_date", F.substring("end", 1, 10).try_cast("date")).join(
        decisions.select("meeting_date", F.lit(True).alias("known")), "meeting_date", "left")
    per_month = spine.groupBy("meeting_month").agg(F.count("*").alias("n"))
    found = [
        broken_rules(parsed, [Rule("ticker does not parse", col("m.ym").isNull(), col("event_id"))]),
        broken_rules(months, [
            Rule("several events in a month", col("n") > 1, col("meeting_month"), col("kept.event_id")),
            Rule("event month without decision", col("meeting_date").isNull(), col("kept.event_id"), col("meeting_month")),
            Rule("ticker day differs", col("kept.day") != F.dayofmonth("meeting_date"), col("kept.event_id"), col("kept.day")),
        ]),
        broken_rules(dated, [
            Rule("close differs from decision", F.substring("close", 1, 10) != col("meeting_date").cast("string"), leg_name, col("close")),
            Rule("unknown leg code", ~col("leg").isin(*LEG_OUTCOME), leg_name, col("leg")),
        ]),
        broken_rules(events, [
            Rule("several legs paid", col("n_paid") > 1, col("event_id"), col("n_paid")),
            Rule("closes differ", col("c0") != col("c1"), col("event_id"), F.concat_ws("/", "c0", "c1")),
        ]),
        broken_rules(linked, [
            Rule("event end unreadable", col("meeting_date").isNull(), col("event_id"), col("end")),
            Rule("event not linked", col("meeting_date").isNotNull() & col("known").isNull(), col("event_id"), col("end")),
        ]),
        broken_rules(spine, [
            Rule("several decision events", F.size("point_events_decision") > 1, col("meeting_date"), F.array_join("point_events_decision", ",")),
            Rule("effective next month", month_key("effective_date") != col("meeting_month"), col("meeting_date"), col("effective_date")),
            Rule("outcomes disagree", col("ladder_result_outcome") != col("realized_outcome"), col("meeting_date"),
                 F.concat_ws("/", "ladder_result_outcome", "realized_outcome")),
        ]),
        broken_rules(per_month, [Rule("several decisions in a month", col("n") > 1, col("meeting_month"), col("n"))]),
    ]
    return reduce(DataFrame.unionAll, found)


def trade_anomalies(trades: DataFrame, bars: DataFrame, ladder_markets: DataFrame, tol: float = 0.02) -> DataFrame:
    """Markets with bars against their trades and their recorded volume: trades and bars are each read once.

    Shares and differences are given in hundredths of a percent.
    """
    col = F.col
    first = trades.groupBy("market_id").agg(F.min("ts").alias("first_trade"))
    daily = F.when(col("interval") == DAY_BAR, F.coalesce("vol", F.lit(0.0))).otherwise(0.0)
    per = dimension_join(bars.select("market_id", "interval", "ts", "vol"), first, ["market_id"]).groupBy("market_id").agg(
        F.max("first_trade").alias("first_trade"), F.sum(daily).alias("total"),
        F.sum(F.when(col("ts") < col("first_trade"), daily).otherwise(0.0)).alias("before"))
    rows = dimension_join(per, ladder_markets.select("market_id", "volume_fp"), ["market_id"])
    rel = (col("total") - col("volume_fp")) / F.nullif("volume_fp", F.lit(0.0))
    return broken_rules(rows, [
        Rule("market without trades", col("first_trade").isNull(), col("market_id")),
        Rule("trades begin late", col("before") > 0, col("market_id"), F.round(10000 * col("before") / col("total")).cast("bigint")),
        Rule("volume is off", F.abs(rel) > tol, col("market_id"), F.round(10000 * rel).cast("bigint")),
    ])


def series_anomalies(series: DataFrame, as_of: Column, max_gap: int = 10, min_rows: int = 30, max_stale: int = 7) -> DataFrame:
    """Daily series (``series_id``, ``date``, ``value``, one row a day at most): gaps, length, age, bar in progress."""
    col = F.col
    before = F.lag("date").over(Window.partitionBy("series_id").orderBy("date"))
    gap = F.datediff("date", "before") > max_gap
    per = series.withColumn("before", before).groupBy("series_id").agg(
        F.count("*").alias("n"), F.count_if(gap).alias("n_gaps"), F.min(F.when(gap, F.struct("before", "date"))).alias("gap"),
        F.max("date").alias("last"), F.max(F.when(col("value").isNotNull(), col("date"))).alias("last_value"))
    return broken_rules(per, [
        Rule("long gap", col("n_gaps") > 0, col("series_id"), F.concat_ws("/", "n_gaps", "gap.before", "gap.date")),
        Rule("short series", col("n") < min_rows, col("series_id"), col("n")),
        Rule("stale series", F.datediff(as_of, "last_value") > max_stale, col("series_id"), col("last_value")),
        Rule("last bar in progress", col("last") >= as_of, col("series_id"), col("last")),
    ])


def anomalies(points: DataFrame, markets: DataFrame, spine: DataFrame, ladder_events: DataFrame, legs: DataFrame,
              point_events: DataFrame, trades: DataFrame | None = None, bars: DataFrame | None = None,
              ladder_markets: DataFrame | None = None, series: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """Structural anomalies of all sources as (``check``, ``key``, ``detail``).

    Every input is read once for each grain that its rules have; rules of one grain share the scan. Landed events have
    rules of their own, ``sources.landing.event_anomalies``.
    """
    found = [point_anomalies(points, markets), link_anomalies(spine, ladder_events, legs, point_events)]
    if trades is not None and bars is not None and ladder_markets is not None:
        found.append(trade_anomalies(trades, bars, ladder_markets))
    if series is not None:
        found.append(series_anomalies(series, F.current_date() if as_of is None else as_of))
    return reduce(DataFrame.unionAll, found)
