"""Futures side: contract bars per decision, the daily rate, implied probabilities and the basis panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tenorgrid.functions.fixed import (CONTINUOUS_SUFFIX, FAIR_PRICE_BAND, OUTRIGHT_SYMBOL, MONTH_CODES, PRODUCT,
                                       RATE_SERIES)
from tenorgrid.functions.times import month_key
from tenorgrid.functions.values import clamp01, quality_ok
from tenorgrid.operators.aggregates import calendar_month_mean, month_last, pivot_fixed
from tenorgrid.operators.asof import asof_by_date, calendar_ffill
from tenorgrid.operators.dedup import dedup_keep_last
from tenorgrid.operators.joins import join_split
from tenorgrid.operators.ordered import stale_value_flag


def futures_bars(raw: DataFrame, fetched_day: Column, product: str = PRODUCT) -> DataFrame:
    """Futures bars with continuous, in-progress, month and suspicious-volume columns."""
    bars = raw.withColumns({
        "is_continuous": F.col("contract") == product + CONTINUOUS_SUFFIX,
        "is_partial": F.col("date") >= fetched_day,
        "contract_month": F.coalesce("delivery_month", "event_id"),
    })
    return stale_value_flag(bars, ["contract"], ["date"], "volume", "volume_suspect")


def rates_wide(rates: DataFrame) -> DataFrame:
    """One row per date, one column per series."""
    return pivot_fixed(rates, ["date"], "series_id", RATE_SERIES, "value")


def rate_calendar(wide: DataFrame, rate: str = "effr") -> DataFrame:
    """The rate on every calendar day between its first and last observation."""
    observed = wide.where(F.col(rate).isNotNull()).select("date", rate)
    filled = calendar_ffill(observed, "date", [rate])
    return filled.withColumnRenamed(rate, f"{rate}_ff").withColumn("ym", month_key("date"))


def contract_bars(spine: DataFrame, bars: DataFrame) -> DataFrame:
    """Bars per decision: its named contract, or the continuous series within the decision's month."""
    s = spine.select("meeting_date", "meeting_month", F.col("contract_source").alias("source"), "contract_symbol")
    b = bars.select("date", "contract", "source_symbol", "open", "high", "low", "close", "settle", "volume",
                    "is_partial", "is_continuous", month_key("date").alias("__ym"))
    rows = join_split(s, b, [
        (F.col("source") == "contract", F.col("contract_symbol"), F.lit(True), F.col("contract")),
        (F.col("source") == "continuous_in_month", F.col("meeting_month"), F.col("is_continuous"), F.col("__ym")),
    ])
    return rows.withColumns({
        "pre_decision": F.col("date") < F.col("meeting_date"),
        "days_to_decision": F.datediff("meeting_date", "date"),
        "in_meeting_month": F.col("__ym") == F.col("meeting_month"),
    }).drop("__ym", "contract_symbol", "is_continuous")


def fair_prices(rate: Column, delta: Column, settle: Column) -> dict[str, Column]:
    """Fair price per outcome and the implied move; the move is undefined when no day carries the new rate."""
    hold = 100 - rate
    implied = F.when(delta > 0, (hold - settle) * 100 / F.nullif(delta, F.lit(0.0)))
    return {
        "fair_hold": hold, "fair_cut25": hold + 0.25 * delta, "fair_cut50p": hold + 0.50 * delta,
        "fair_hike25": hold - 0.25 * delta, "fair_hike50p": hold - 0.50 * delta, "implied_move_bp": implied,
    }


def implied_probabilities(move: Column) -> dict[str, Column]:
    """Hold-against-25 probabilities, unclamped and clamped.

    The clamps ignore NULL, so an undefined move gives a certain hold; ``implied_defined`` tells the two apart.
    """
    up, down = clamp01(move / 25), clamp01(-move / 25)
    return {
        "p_hike25_binary": move / 25, "p_cut25_binary": -move / 25, "p_hike25_fut": up, "p_cut25_fut": down,
        "p_hold_fut": 1 - up - down, "implied_defined": move.isNotNull(),
    }


def asof_and_same_day(df: DataFrame, key: str, prefix: str, columns: Sequence[str], same_day: str,
                      d: str = "date", asof: str = "asof_date") -> DataFrame:
    """Per key and date: the row known at the start of the date and, apart, one value as of its end.

    One grouping serves both roles; joining the table twice would move it twice.
    """
    role = F.explode(F.array(F.struct(F.col(asof).alias("date"), F.lit(True).alias("asof")),
                             F.struct(F.col(d).alias("date"), F.lit(False).alias("asof"))))
    rows = df.select(key, F.struct(*columns).alias("__row"), F.col(same_day).alias("__same"), role.alias("__r"))
    both = rows.groupBy(key, F.col("__r.date").alias(d)).agg(
        F.max(F.when(F.col("__r.asof"), F.col("__row"))).alias("__a"),
        F.max(F.when(~F.col("__r.asof"), F.col("__same"))).alias(f"{prefix}_{same_day}_sameday"))
    return both.select(key, d, *(F.col(f"__a.{c}").alias(f"{prefix}_{c}") for c in columns),
                       f"{prefix}_{same_day}_sameday")


LADDER_COLUMNS = ["e_move_bp", "p_hike25", "p_hold", "p_cut25", "n_legs_quoted", "sum_raw", "max_stale_days"]
POINT_COLUMNS = ["e_move_bp", "p_hike25", "p_hold", "p_cut25", "top_is_any_hike", "n_legs_obs_today", "sum_raw",
                 "n_legs_half", "max_stale_days"]


def implied_daily(bars: DataFrame, spine: DataFrame, windows: DataFrame, rates: DataFrame, ladder: DataFrame,
                  points: DataFrame, rate: str = "effr") -> DataFrame:
    """Futures-implied probabilities and ladder-implied fair prices per decision and day.

    Only dates after the previous decision took effect count, and the rate is the last one strictly before the
    date. The quality gate on the point ladder uses its as-of row in both variants.
    """
    dim = spine.select("meeting_date", "delta", "days_post", "days_in_month").join(
        windows.select("meeting_date", "prev_meeting_date", "prev_effective_date"), "meeting_date")
    base = bars.join(dim, "meeting_date").where(F.col("date") > F.col("prev_effective_date"))
    observed = rates.where(F.col(rate).isNotNull()).select(F.col("date").alias("obs"), F.col(rate).alias("rate_pre"))
    base = asof_by_date(base, "date", observed, "obs", strict=True, carry=["rate_pre"], matched="rate_pre_date")
    base = base.withColumnRenamed("settle", "fut_settle")
    base = base.withColumns(fair_prices(F.col("rate_pre"), F.col("delta"), F.col("fut_settle")))
    base = base.withColumns(implied_probabilities(F.col("implied_move_bp")))
    on = ["meeting_date", "date"]
    base = base.join(asof_and_same_day(ladder, "meeting_date", "ladder", LADDER_COLUMNS, "e_move_bp"), on, "left")
    primary = points.where("is_primary")
    base = base.join(asof_and_same_day(primary, "meeting_date", "points", POINT_COLUMNS, "e_move_bp"), on, "left")
    fair = lambda move: F.col("fair_hold") - F.col("delta") * F.col(move) / 100
    gate = (F.coalesce("points_n_legs_half", F.lit(0)) == 0) & F.col("points_sum_raw").between(*FAIR_PRICE_BAND)
    return base.withColumns({
        "ladder_fair": fair("ladder_e_move_bp"), "ladder_fair_sameday": fair("ladder_e_move_bp_sameday"),
        "points_fair": F.when(gate, fair("points_e_move_bp")),
        "points_fair_sameday": F.when(gate, fair("points_e_move_bp_sameday")),
    })


def basis_columns() -> dict[str, Column]:
    """Basis in basis points, pairwise probability gaps, and the quality screens consumers filter on."""
    c = F.col
    cols = {}
    for side in ("ladder", "points"):
        for variant in ("", "_sameday"):
            cols[f"basis_{side}{variant}_bp"] = (c(f"{side}_fair{variant}") - c("fut_settle")) * 100
    for a, b in (("fut", "ladder"), ("fut", "points"), ("ladder", "points")):
        for o in ("hike25", "hold", "cut25"):
            p = lambda v: c(f"p_{o}_fut") if v == "fut" else c(f"{v}_p_{o}")
            cols[f"gap_{a}_{b}_{o}"] = p(a) - p(b)
    cols["ladder_ok"] = quality_ok(c("ladder_sum_raw"), c("ladder_max_stale_days"), c("ladder_n_legs_quoted"), 5)
    cols["points_ok"] = quality_ok(c("points_sum_raw"), c("points_max_stale_days"), half=c("points_n_legs_half"))
    return cols


def basis_daily(implied: DataFrame) -> DataFrame:
    return implied.withColumns(basis_columns())


def settlement_check(bars: DataFrame, calendar: DataFrame, price: str = "settle", rate: str = "effr_ff",
                     within_days: int | None = 4) -> DataFrame:
    """Per month: last price of the continuous series against 100 minus the calendar-day mean rate, in bp.

    ``within_days`` keeps the months whose last bar is close enough to the month's end to be complete.
    """
    last = month_last(bars, "date", price)
    rows = last.join(calendar_month_mean(calendar, "date", rate), "ym")
    if within_days is not None:
        rows = rows.where(F.datediff(F.last_day("last_date"), "last_date") <= within_days)
    return rows.select("ym", "n_days", "month_mean", (100 - F.col("month_mean")).alias("implied_settle"),
                       F.col("last_value").alias("settle"), "last_date",
                       ((F.col("last_value") - (100 - F.col("month_mean"))) * 100).alias("diff_bp"))


def resolve_decade(rows: DataFrame, symbol: str = "symbol", trade_date: str = "trade_date", lo: int = -1,
                   hi: int = 60) -> DataFrame:
    """Delivery month of symbols with a one-digit year: the decade whose horizon lies in [lo, hi] months.

    ``n_decades`` counts the decades that fit; only rows with exactly one have a delivery month.
    """
    month = F.position(F.regexp_extract(symbol, OUTRIGHT_SYMBOL, 1), F.lit(MONTH_CODES))
    digit = F.regexp_extract(symbol, OUTRIGHT_SYMBOL, 2).try_cast("int")
    year = F.year(trade_date)
    base = year - year % 10 + digit
    years = F.transform(F.array(F.lit(-10), F.lit(0), F.lit(10)), lambda k: base + k)
    horizon = lambda y: (y - year) * 12 + month - F.month(trade_date)
    fits = F.filter(years, lambda y: horizon(y).between(lo, hi))
    only = F.when(F.size("__fits") == 1, F.get("__fits", 0))
    return rows.withColumn("__fits", F.when(F.col(symbol).rlike(OUTRIGHT_SYMBOL), fits)).withColumns({
        "n_decades": F.size("__fits"), "year": only, "m": F.when(F.size("__fits") == 1, month),
    }).withColumns({
        "delivery_month": F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("m").cast("string"), 2, "0")),
        "h": (F.col("year") - year) * 12 + F.col("m") - F.month(trade_date),
    }).drop("__fits")


def _outright_rows(feed: DataFrame, first_year: int, stat_type: int | None) -> DataFrame:
    rows = feed if stat_type is None or "stat_type" not in feed.columns else feed.where(
        F.col("stat_type") == stat_type).drop("stat_type")
    last = dedup_keep_last(rows, ["trade_date", "symbol"], ["ts_recv"])
    return resolve_decade(last.where((F.year("trade_date") >= first_year) & F.col("symbol").rlike(OUTRIGHT_SYMBOL)))


def settlement_outrights(feed: DataFrame, first_year: int = 2000, stat_type: int | None = 3) -> DataFrame:
    """Settlement feed to outright settlements: the last arrival per day and symbol, outrights only.

    Symbols that fit no decade, or several, have no delivery month; ``decade_counts`` counts them.
    """
    return _outright_rows(feed, first_year, stat_type).where(F.col("n_decades") == 1).select(
        "trade_date", "symbol", F.col("delivery_month").alias("dm"), "year", "m", "h", "price", "instrument_id", "ts_recv")


def decade_counts(feed: DataFrame, first_year: int = 2000, stat_type: int | None = 3) -> DataFrame:
    """Outright rows by the number of decades that fit their symbol: n_decades, n_rows, n_symbols."""
    return _outright_rows(feed, first_year, stat_type).groupBy("n_decades").agg(
        F.count("*").alias("n_rows"), F.count_distinct("symbol").alias("n_symbols"))
