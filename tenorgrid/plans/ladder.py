"""Ladders of digital contracts: dense daily quotes, probabilities and expected moves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tenorgrid.functions.fixed import (BAR_END_SHIFT_S, DAY_BAR, EVENT_PREFIX, HOUR_BAR, MOVE_BP, OTHER, OUTCOMES)
from tenorgrid.functions.times import local_date
from tenorgrid.functions.values import mid_price, ratio
from tenorgrid.operators.aggregates import last_value, pivot_columns
from tenorgrid.operators.dedup import dedup_keep_last
from tenorgrid.operators.grid import dense_ffill
from tenorgrid.operators.skew import dimension_join


def rung_names(prefix: str, rungs: Sequence[str] = OUTCOMES) -> dict[str, str]:
    return {r: f"{prefix}_{r.lower()}" for r in rungs}


def probability_columns(price: str, total: Column, moves: Mapping[str, int | Column]) -> dict[str, Column]:
    """``p_k`` = rung price over the sum, and the expected move; a missing rung is NULL but weighs zero."""
    cols = {f"p_{k.lower()}": ratio(F.col(f"{price}_{k.lower()}"), total) for k in moves}
    weighted = sum((F.coalesce(F.col(f"{price}_{k.lower()}"), F.lit(0.0)) * m for k, m in moves.items()), F.lit(0.0))
    return {**cols, "e_move_bp": ratio(weighted, total)}


def quote_bars(bars: DataFrame) -> DataFrame:
    """Quote bars with bar end, the local day a daily bar covers, mid and spread."""
    return bars.withColumns({
        "bar_end_utc": F.timestamp_seconds("ts"),
        "trade_date": F.when(F.col("interval") == DAY_BAR, local_date("ts", shift_s=BAR_END_SHIFT_S)),
        "mid": mid_price("bid_close", "ask_close"),
        "spread": F.col("ask_close") - F.col("bid_close"),
    })


def daily_quotes(bars: DataFrame, event_prefix: str = EVENT_PREFIX) -> DataFrame:
    """Dense daily quotes: the last daily bar of each leg carried over its event's span, whatever its mid.

    Where a trade day has several daily bars (a repeated pull, a change of the clock) the latest by ``ts`` counts.
    """
    daily = bars.where((F.col("interval") == DAY_BAR) & F.col("event_id").startswith(event_prefix))
    carry = ["ts", "bid_close", "ask_close", "mid", "spread", "price_close", "price_mean", "vol", "oi", "is_partial"]
    leg_day = ["event_id", "market_id", "outcome", "trade_date"]
    daily = dedup_keep_last(daily.select(*leg_day, *carry), leg_day, ["ts"])
    grid = dense_ffill(daily, ["event_id"], ["market_id", "outcome"], "trade_date", carry, observed="bar_trade_date")
    return grid.withColumnRenamed("ts", "bar_ts").withColumns({
        "asof_date": F.date_add("trade_date", 1),
        "two_sided": (F.col("bid_close") > 0) & (F.col("ask_close") < 1),
        "quoted": F.col("mid").isNotNull(),
    })


def daily_points(points: DataFrame, markets: DataFrame) -> DataFrame:
    """Dense daily points: the last hourly Yes point per local day, carried up to the decision date.

    Points are reduced to one row per token and day before they meet their market.
    """
    hourly = points.where((F.col("fidelity") == HOUR_BAR) & (F.col("outcome_label") == "Yes"))
    last = hourly.groupBy("event_id", "market_id", "token_id", local_date("ts").alias("date")).agg(
        last_value("p", "ts").alias("p"), F.max("ts").alias("ts_last"), F.count("*").alias("n_obs"))
    dim = markets.where(F.col("outcome") != OTHER).select(
        "market_id", "outcome", "outcome_detail", F.col("decision_date").try_cast("date").alias("decision_date"))
    legs = dimension_join(last, dim, ["market_id"], "inner")
    grid = dense_ffill(legs, ["event_id"], ["market_id", "token_id", "outcome", "outcome_detail", "decision_date"],
                       "date", ["p", "ts_last", "n_obs"], cap="decision_date")
    return grid.withColumn("p_is_half", F.col("p") == 0.5)


def in_window(d: Column, prev_effective: Column, decision: Column) -> Column:
    return (d > prev_effective) & (d <= decision)


def ladder_daily(quotes: DataFrame, spine: DataFrame, windows: DataFrame) -> DataFrame:
    """Probabilities of the quoted ladder per decision and day."""
    quoted = lambda c: F.when(F.col("quoted"), F.col(c))
    agg = quotes.groupBy("event_id", F.col("trade_date").alias("date"), "asof_date").agg(
        F.count("*").alias("n_legs"), F.count_if(F.col("stale_days") == 0).alias("n_legs_bar_today"),
        F.count_if("quoted").alias("n_legs_quoted"), F.count_if("two_sided").alias("n_legs_two_sided"),
        F.max("stale_days").alias("max_stale_days"), F.max(quoted("spread")).alias("max_spread"),
        F.sum("mid").alias("sum_raw"), F.sum(quoted("bid_close")).alias("sum_bid"),
        F.sum(quoted("ask_close")).alias("sum_ask"), F.sum("vol").alias("vol_day"), F.sum("oi").alias("oi_total"),
        F.bool_or("is_partial").alias("any_partial"), *pivot_columns("outcome", rung_names("mid"), "mid"),
        *pivot_columns("outcome", rung_names("bid"), "bid_close"), *pivot_columns("outcome", rung_names("ask"), "ask_close"))
    agg = agg.withColumns(probability_columns("mid", F.col("sum_raw"), MOVE_BP))
    dim = spine.join(windows.select("meeting_date", "prev_effective_date"), "meeting_date").select(
        "meeting_date", F.col("ladder_event").alias("event_id"), "prev_effective_date", "ladder_status", "ladder_result_outcome")
    rows = dimension_join(agg, dim, ["event_id"], "inner")
    return rows.withColumns({
        "days_to_decision": F.datediff("meeting_date", "date"),
        "in_window": in_window(F.col("date"), F.col("prev_effective_date"), F.col("meeting_date")),
    }).drop("prev_effective_date")


def point_ladder_daily(points: DataFrame, links: DataFrame, windows: DataFrame) -> DataFrame:
    """Probabilities of the point ladder: legs that share an outcome are summed before the pivot."""
    by_outcome = points.groupBy("event_id", "date", "outcome", "decision_date").agg(
        F.sum("p").alias("p_sum"), F.count("*").alias("n"), F.count_if(F.col("stale_days") == 0).alias("n_today"),
        F.count_if("p_is_half").alias("n_half"), F.max("stale_days").alias("stale"))
    agg = by_outcome.groupBy("event_id", "date").agg(
        F.max("decision_date").alias("decision_date"), F.sum("n").alias("n_legs"),
        F.sum("n_today").alias("n_legs_obs_today"), F.sum("n_half").alias("n_legs_half"),
        F.max("stale").alias("max_stale_days"), F.count("*").alias("n_outcomes"), F.sum("p_sum").alias("sum_raw"),
        *pivot_columns("outcome", rung_names("yes"), "p_sum"))
    dim = links.where(F.col("role") == "decision").join(
        windows.select("meeting_date", "prev_effective_date"), "meeting_date").select(
        "event_id", "meeting_date", "is_primary", "top_is_any_hike", "n_canonical_legs", "event_title", "prev_effective_date")
    rows = dimension_join(agg, dim, ["event_id"], "inner")
    moves = {**{k: F.lit(v) for k, v in MOVE_BP.items()},
             "HIKE50P": F.when(F.col("top_is_any_hike"), 25).otherwise(MOVE_BP["HIKE50P"])}
    return rows.withColumns(probability_columns("yes", F.col("sum_raw"), moves)).withColumns({
        "asof_date": F.date_add("date", 1),
        "days_to_decision": F.datediff("meeting_date", "date"),
        "in_window": in_window(F.col("date"), F.col("prev_effective_date"), F.col("meeting_date")),
    }).drop("prev_effective_date", "decision_date")
