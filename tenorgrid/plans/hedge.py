"""Calendar-spread instrument, hedge error, payoff and backtest tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tenorgrid.functions.fixed import DIGITALS_PER_SPREAD, DOLLARS_PER_BP, MOVE_BP
from tenorgrid.functions.times import month_index
from tenorgrid.functions.values import lookup, ratio
from tenorgrid.operators.aggregates import calendar_month_mean, exact_quantiles
from tenorgrid.operators.asof import asof_by_date


def _month_text(index: Column) -> Column:
    """Month index (12 * year + month) to ``yyyy-MM``."""
    year = F.floor((index - 1) / 12).cast("int")
    return F.concat(year.cast("string"), F.lit("-"), F.lpad((index - year * 12).cast("string"), 2, "0"))


def select_instrument(spine: DataFrame) -> DataFrame:
    """The calendar spread of each decision, from the calendar alone.

    A front spread uses the decision's month and the next, a back spread the previous month and the
    decision's. A month in which another decision takes effect disqualifies the spreads that use it; of the
    eligible ones the larger span is taken.
    """
    own = spine.select("meeting_date", F.col("delta").alias("w"), month_index("meeting_date").alias("m"))
    changes = spine.select(F.col("meeting_date").alias("__other"), month_index("effective_date").alias("month"))
    near = own.select("meeting_date", "m", F.explode(F.sequence(F.col("m") - 1, F.col("m") + 1)).alias("month"))
    clash = near.join(changes, "month").where(F.col("__other") != F.col("meeting_date"))
    at = lambda k: F.count_if(F.col("month") == F.col("m") + k)
    others = clash.groupBy("meeting_date").agg(at(-1).alias("prev"), at(0).alias("same"), at(1).alias("next"))
    rows = own.join(others, "meeting_date", "left").fillna(0, subset=["prev", "same", "next"])
    front = (F.col("same") == 0) & (F.col("next") == 0) & (F.col("w") < 1)
    back = (F.col("same") == 0) & (F.col("prev") == 0) & (F.col("w") > 0)
    rows = rows.withColumns({
        "front_eligible": front, "back_eligible": back,
        "front_span": F.when(front, 1 - F.col("w")), "back_span": F.when(back, F.col("w")),
    })
    is_front = F.coalesce(F.col("front_span") >= F.coalesce("back_span", F.lit(0.0)), F.lit(False))
    rows = rows.withColumns({
        "span": F.greatest("front_span", "back_span"),
        "instrument": F.when(is_front, "FRONT").when(back, "BACK"),
    })
    shift = F.when(F.col("instrument") == "FRONT", 0).when(F.col("instrument") == "BACK", -1)
    return rows.select("meeting_date", "w", "front_eligible", "back_eligible", "instrument", "span",
                       _month_text(F.col("m") + shift).alias("near_month"),
                       _month_text(F.col("m") + shift + 1).alias("far_month"))


def implied_decision(prices: DataFrame, instruments: DataFrame) -> DataFrame:
    """Decision in percentage points implied by the spread, per decision and date.

    ``prices`` is (``date``, ``delivery_month``, ``settle``). Both legs are looked up in one join.
    """
    legs = instruments.where("span IS NOT NULL").select("meeting_date", "span", F.explode(F.array(
        F.struct(F.lit("near").alias("leg"), F.col("near_month").alias("delivery_month")),
        F.struct(F.lit("far").alias("leg"), F.col("far_month").alias("delivery_month")))).alias("l"))
    legs = legs.select("meeting_date", "span", "l.*")
    leg = lambda name: F.max(F.when(F.col("leg") == name, F.col("settle")))
    both = prices.join(legs, "delivery_month").groupBy("meeting_date", "span", "date").agg(
        leg("near").alias("near"), leg("far").alias("far"))
    return both.where("near IS NOT NULL AND far IS NOT NULL").withColumn(
        "implied_decision", (F.col("near") - F.col("far")) / F.col("span"))


def basis_cents(futures_bp: Column, venue_bp: Column) -> Column:
    """Basis in cents per contract that pays one dollar on a 25 bp move."""
    return 4 * (futures_bp - venue_bp)


def digitals_per_spread(span: Column) -> Column:
    return DIGITALS_PER_SPREAD * span


def friction_per_digital(round_trip_dollars: Column, w: Column) -> Column:
    """Futures round trip in cents per hedged 25 bp digital; grows as the affected share shrinks."""
    return ratio(round_trip_dollars * 100, F.lit(DOLLARS_PER_BP * 25) * w)


def hedge_error(calendar: DataFrame, instruments: DataFrame, changes: DataFrame, rate: str = "effr_ff") -> DataFrame:
    """What the hedge misses at settlement, computed from calendar-day month means of the published rate.

    ``changes`` is (``meeting_date``, ``realized_change_bp``).
    """
    means = calendar_month_mean(calendar, "date", rate)
    at = lambda key, name: means.select(F.col("ym").alias(key), F.col("month_mean").alias(name))
    rows = instruments.where("span IS NOT NULL").join(changes, "meeting_date").where("realized_change_bp IS NOT NULL")
    rows = rows.join(at("near_month", "mean_near"), "near_month").join(at("far_month", "mean_far"), "far_month")
    spread = ((100 - F.col("mean_near")) - (100 - F.col("mean_far"))) * 100
    return rows.withColumn("spread_terminal_bp", spread).withColumn(
        "resid_bp", F.col("spread_terminal_bp") - F.col("span") * F.col("realized_change_bp")).withColumn(
        "err_cents", 4 * F.col("resid_bp") / F.col("span"))


def net_payoff(df: DataFrame, basis: str, err: str, costs: Column, gate: float) -> DataFrame:
    """Payoff in cents of days whose basis clears the gate, both legs held to settlement."""
    b = F.col(basis)
    return df.where(F.abs(b) >= gate).withColumn("net_cents", F.abs(b) - F.signum(b) * F.col(err) - costs)


def backtest_summary(df: DataFrame, by: Sequence[str], basis: str, net: str) -> DataFrame:
    """Per event: days, median basis, median net, share of days with a positive net."""
    base = df.groupBy(*by).agg(F.count("*").alias("n_days"),
                               F.avg((F.col(net) > 0).cast("double")).alias("share_positive"))
    for column, name in ((basis, "median_basis"), (net, "median_net")):
        base = base.join(exact_quantiles(df, by, column, {name: 0.5}), list(by), "left")
    return base


def following_contract(spine: DataFrame) -> DataFrame:
    """The contract of the month after each decision, its share at the new rate, and any later decision inside it.

    The later decision's contribution, ``other_delta`` times its expected move, is to be subtracted.
    """
    m = month_index("meeting_date")
    first = F.trunc(F.add_months("meeting_date", 1), "MM")
    own = spine.select("meeting_date", m.alias("m"), (m + 1).alias("month"), first.alias("__first"), "effective_date")
    post = F.datediff(F.last_day("__first"), F.greatest("effective_date", "__first")) + 1
    own = own.withColumn("w_following", post / F.dayofmonth(F.last_day("__first")))
    other = spine.select(
        F.col("meeting_date").alias("other_meeting"), month_index("effective_date").alias("month"),
        ((F.datediff(F.last_day("effective_date"), "effective_date") + 1) / F.dayofmonth(F.last_day("effective_date"))
         ).alias("other_delta"))
    joined = own.join(other, "month", "left")
    later = F.col("other_meeting") > F.col("meeting_date")
    return joined.groupBy("meeting_date", "month", "w_following").agg(
        F.min(F.when(later, F.col("other_meeting"))).alias("other_meeting"),
        F.coalesce(F.sum(F.when(later, F.col("other_delta"))), F.lit(0.0)).alias("other_delta"),
    ).withColumn("following_month", _month_text(F.col("month"))).drop("month")


def replication_payoff(portfolio: DataFrame, linear: float = 1.0) -> DataFrame:
    """Payoff per state of a portfolio of legs (``outcome``, ``units``) against a linear claim on the move.

    Exactly one leg pays in a state, so the payoff is that leg's units less the linear claim. A single leg
    leaves the other states open.
    """
    held = portfolio.groupBy("outcome").agg(F.sum("units").alias("units"))
    return held.withColumn("move_bp", lookup("outcome", MOVE_BP)).withColumn(
        "payoff", F.col("units") - F.lit(float(linear)) * F.col("move_bp"))


def pass_through(spine: DataFrame, calendar: DataFrame, rate: str = "effr_ff") -> DataFrame:
    """Rate step on the effective date against the target change, and the residual of the month's later mean."""
    known = spine.where("realized_change_bp IS NOT NULL").select(
        "meeting_date", "effective_date", "month_end", "realized_change_bp")
    series = calendar.select(F.col("date").alias("obs"), F.col(rate).alias("rate"))
    rows = asof_by_date(known, "effective_date", series.withColumnRenamed("rate", "rate_before"), "obs", strict=True,
                        carry=["rate_before"], matched="before_date")
    rows = asof_by_date(rows, "effective_date", series.withColumnRenamed("rate", "rate_after"), "obs",
                        carry=["rate_after"], matched="after_date")
    days = rows.select("meeting_date", F.explode(F.when(
        F.col("effective_date") <= F.last_day("effective_date"),
        F.sequence("effective_date", F.last_day("effective_date"), F.expr("interval 1 day")))).alias("obs"))
    later = days.join(series, "obs").groupBy("meeting_date").agg(F.avg("rate").alias("mean_after"))
    rows = rows.join(later, "meeting_date", "left")
    return rows.withColumn("step_bp", (F.col("rate_after") - F.col("rate_before")) * 100).withColumns({
        "step_error_bp": F.col("step_bp") - F.col("realized_change_bp"),
        "mean_resid_bp": (F.col("mean_after") - F.col("rate_before")) * 100 - F.col("realized_change_bp"),
    })


def front_exposure(spine: DataFrame, offsets: Sequence[int]) -> DataFrame:
    """Share of decisions to which the front contract has no exposure, per number of days before the decision."""
    rows = spine.select("meeting_date", "effective_date", F.explode(F.array(*map(F.lit, offsets))).alias("days_before"))
    blind = month_index(F.date_sub("meeting_date", F.col("days_before"))) < month_index("effective_date")
    return rows.groupBy("days_before").agg(F.count("*").alias("n"), F.avg(blind.cast("double")).alias("share_blind"))


def before_decision(df: DataFrame, d: str = "date", decision: str = "meeting_date") -> DataFrame:
    """Drop the decision day: its settlement already contains the outcome."""
    return df.where(F.col(d) < F.col(decision))
