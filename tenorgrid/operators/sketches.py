"""Distinct counts from mergeable sketches: kept once per day, merged to any range of days without the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LOG2_CELLS = 12


def standard_error(log2_cells: int = LOG2_CELLS) -> float:
    """Relative standard error of an estimate; sets below a few hundred values are counted exactly."""
    return 1.04 / 2 ** (log2_cells / 2)


def distinct_sketches(df: DataFrame, by: Sequence[str], value: str, log2_cells: int = LOG2_CELLS) -> DataFrame:
    """Per group one sketch of the distinct values, of at most ``2 ** log2_cells`` bytes whatever the group holds.

    Partial sketches are merged behind the shuffle, so a hot group moves one of them per task. NULL is no value.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(log2_cells)).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group of sketches the estimated number of distinct values in all of them together."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("n_estimate"))


def range_distinct(daily: DataFrame, ranges: DataFrame, day: str, start: str, stop: str, name: str) -> DataFrame:
    """Estimates for named ranges of days (``start`` to ``stop``, both included) that may overlap.

    Every range asks for its days by equality, so the work is days in ranges, not facts.
    """
    asked = ranges.select(name, F.explode(F.sequence(F.col(start), F.col(stop), F.expr("interval 1 day"))).alias("__day"))
    found = asked.join(daily.select(F.col(day).alias("__day"), "sketch"), "__day")
    return ranges.select(name).join(merged_distinct(found, [name]), name, "left").fillna(0, ["n_estimate"])
