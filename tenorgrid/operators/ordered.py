"""Operators over ordered rows of a key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenorgrid.operators.skew import Bucket, carry_forward, per_seconds, running_total, dimension_join


def previous_row(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], out: str = "prev",
                 bucket: Bucket | None = None) -> DataFrame:
    """Struct ``out`` with ``cols`` of the row before, per key; NULL on the first row."""
    return carry_forward(df, by, order, F.struct(*cols), out, bucket)


def stale_value_flag(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str,
                     bucket: Bucket | None = None) -> DataFrame:
    """True where a value is zero or repeats the row before; three-valued."""
    rows = previous_row(df, by, order, [value], "__prev", bucket)
    v = F.col(value)
    return rows.withColumn(out, (v == 0) | (v == F.col(f"__prev.{value}"))).drop("__prev")


def gaps(df: DataFrame, by: Sequence[str], d: str, min_days: int, bucket: Bucket | None = None) -> DataFrame:
    """Pairs of consecutive dates more than ``min_days`` apart."""
    dates = df.select(*by, d).where(F.col(d).isNotNull()).distinct()
    rows = previous_row(dates, by, [d], [d], "__prev", bucket)
    days = F.datediff(d, F.col(f"__prev.{d}"))
    return rows.where(days > min_days).select(
        *by, F.col(f"__prev.{d}").alias("gap_start"), F.col(d).alias("gap_end"), days.alias("gap_days"))


def monotonic_violations(df: DataFrame, by: Sequence[str], t: str) -> DataFrame:
    """Rows per key whose time does not exceed the time before it in time order.

    In time order only a repeated time can fail, so counting repeats gives the answer with map-side partial
    counts and no ordered pass.
    """
    seen = df.where(F.col(t).isNotNull()).groupBy(*by, t).agg(F.count("*").alias("__n"))
    return seen.groupBy(*by).agg(F.sum(F.col("__n") - 1).alias("violations"))


def window_starts(spine: DataFrame, d: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Value of a column on the previous spine row. ``columns``: new name -> (column, default date).

    The spine is the calendar of decisions, one row per decision date, so a single ordering is bounded.
    """
    w = Window.orderBy(d)
    return spine.withColumns({
        new: F.lag(old, 1, date.fromisoformat(default)).over(w) for new, (old, default) in columns.items()})


def rank_primary(df: DataFrame, by: Sequence[str], value: str, key: str, out: str = "is_primary") -> DataFrame:
    """Flag the row with the largest ``value`` per group, NULLs last, ties to the smaller ``key``.

    The winner is a partial aggregate joined back, so a group of any size stays spread over tasks.
    """
    rank = F.struct(F.col(value).isNull(), -F.col(value), F.col(key))
    best = df.groupBy(*by).agg(F.min(rank).alias("__best"))
    best = best.select(*by, F.col("__best").getField(key).alias("__key"))
    return dimension_join(df, best, by).withColumn(out, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def variety_gate(df: DataFrame, by: Sequence[str], t: str, value: str, window_s: int, lo: float = 0.05,
                 hi: float = 0.95, min_distinct: int = 2, bucket: Bucket | None = None) -> DataFrame:
    """Distinct values of the trailing window, counted only for values in [lo, hi], and whether they suffice.

    ``t`` is epoch seconds; the window is closed on both ends. A value counts from an occurrence until one
    window after it, and repeats within that time only extend its stay. The count at a time is therefore a
    running total of +1 where a stay begins and -1 where it ends, which needs no list of values per row.
    """
    bucket = bucket or per_seconds(window_s)
    counted = F.col(value).between(lo, hi)
    seen = df.where(counted).select(*by, value, t).distinct()
    stays = previous_row(seen, [*by, value], [t], [t], "__prev", bucket)
    before = F.col(f"__prev.{t}")
    begins = stays.where(before.isNull() | (F.col(t) - before > window_s))
    step = lambda at, n: F.struct(at.cast("long").alias("at"), F.lit(n).cast("long").alias("n"))
    changes = begins.select(*by, F.explode(F.array_compact(F.array(
        step(F.col(t), 1), F.when(before.isNotNull(), step(before + window_s + 1, -1))))).alias("c"))
    last = seen.groupBy(*by, value).agg(F.max(t).alias("__last"))
    changes = changes.unionByName(last.select(*by, step(F.col("__last") + window_s + 1, -1).alias("c")))
    steps = changes.groupBy(*by, F.col("c.at").alias("__t")).agg(F.sum("c.n").alias("__n")).withColumn("__tag", F.lit(0))
    rows = df.select(*by, F.col(t).cast("long").alias("__t"), F.lit(0).cast("long").alias("__n"), F.lit(1).alias("__tag"),
                     F.struct("*").alias("__in"))
    totals = running_total(rows.unionByName(steps, allowMissingColumns=True), by, ["__t", "__tag"], F.col("__n"),
                           "n_distinct", bucket)
    out = totals.where(F.col("__tag") == 1).select("__in.*", "n_distinct")
    return out.withColumn("is_live", F.when(counted, F.col("n_distinct") >= min_distinct).otherwise(F.lit(True)))


def top_abs(df: DataFrame, c: str | Column, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows with the largest absolute value; ``ties`` make the order total."""
    return df.orderBy(F.abs(c).desc_nulls_last(), *ties).limit(k)
