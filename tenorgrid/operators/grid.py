"""Dense daily grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenorgrid.operators.skew import dimension_join


def day_range(first: Column, last: Column, step: str = "1 day") -> Column:
    """Dates from ``first`` to ``last``, both included; no dates when the range is empty."""
    return F.when(first <= last, F.sequence(first, last, F.expr(f"interval {step}")))


def date_series(bounds: DataFrame, first: str, last: str, out: str, step: str = "1 day") -> DataFrame:
    """One row per step between two date columns; empty ranges give no row."""
    days = F.explode(day_range(F.col(first), F.col(last), step))
    return bounds.select(*(c for c in bounds.columns if c not in (first, last)), days.alias(out))


def dense_ffill(daily: DataFrame, group: Sequence[str], leg: Sequence[str], d: str, carry: Sequence[str],
                cap: str | None = None, observed: str = "obs_date", stale: str = "stale_days") -> DataFrame:
    """Dense daily grid per (group, leg) over the group's date span, with the last row carried forward.

    ``daily`` has at most one row per (group, leg, day). The span is the group's, not the leg's, and ends at
    ``least(last day, max(cap))`` when ``cap`` is given. The whole row is carried, NULL fields included.

    Every row is spread over the days until the leg's next row, and the first one also backwards to the start
    of the span as days without an observation. That takes one ordered pass over the observations of a leg
    (at most one per calendar day) and neither a grid join nor a fill over the grid.
    """
    key = [*group, *leg]
    last_day = F.max(d) if cap is None else F.least(F.max(d), F.max(cap))
    span = daily.groupBy(*group).agg(F.min(d).alias("__d0"), last_day.alias("__d1"))
    per_leg = Window.partitionBy(*key).orderBy(d)
    rows = daily.select(*key, d, *(c for c in carry if c not in key)).withColumns({
        "__next": F.lead(d).over(per_leg),
        "__first": F.lag(d).over(per_leg).isNull(),
    })
    rows = dimension_join(rows, span, group, "inner")
    day, start, end = F.col(d), F.col("__d0"), F.col("__d1")
    own_end = F.least(F.coalesce(F.date_sub(F.col("__next"), 1), end), end)
    before = F.when(F.col("__first"), day_range(start, F.least(F.date_sub(day, 1), end)))
    none = F.array().cast("array<date>")
    days = F.concat(F.coalesce(before, none), F.coalesce(day_range(day, own_end), none))
    grid = rows.withColumn("__day", F.explode(days))
    seen = F.col("__day") >= day
    return grid.select(
        *key,
        F.col("__day").alias(d),
        F.when(seen, day).alias(observed),
        F.when(seen, F.datediff("__day", day)).alias(stale),
        *(F.when(seen, F.col(c)).alias(c) for c in carry if c not in key),
    )
