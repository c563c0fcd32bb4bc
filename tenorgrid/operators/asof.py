"""As-of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tenorgrid.operators.grid import day_range
from tenorgrid.operators.skew import Bucket, carry_forward


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_t: str, right_t: str,
              strict: bool = False, carry: Sequence[str] | None = None, matched: str = "matched_t",
              bucket: Bucket | None = None) -> DataFrame:
    """Left outer as-of join: the last right row at or before (``strict``: before) each left row, per key.

    Both sides are stacked, ordered by time with ties resolved by side, and the last right row is carried
    forward as a whole, so a NULL inside it stays NULL. Give ``bucket`` when a key can be large.
    """
    carry = list(carry if carry is not None else [c for c in right.columns if c not in (*by, right_t)])
    t, tag, lrow, rrow = "__t", "__tag", "__left", "__right"
    right_tag = 1 if strict else 0
    payload = F.struct(F.col(right_t).alias("t"), *carry)
    reachable = F.col(left_t).isNotNull()
    for k in by:
        reachable = reachable & F.col(k).isNotNull()
    l = left.where(reachable).select(*by, F.col(left_t).alias(t), F.lit(1 - right_tag).alias(tag), F.struct("*").alias(lrow))
    r = right.where(F.col(right_t).isNotNull()).select(
        *by, F.col(right_t).alias(t), F.lit(right_tag).alias(tag), payload.alias(rrow))
    both = l.unionByName(r, allowMissingColumns=True)
    joined = carry_forward(both, by, [t, tag, rrow], F.col(rrow), "__match", bucket)
    found = joined.where(F.col(lrow).isNotNull()).select(
        f"{lrow}.*", F.col("__match.t").alias(matched), *(F.col(f"__match.{c}").alias(c) for c in carry))
    # A row without a key or a time matches nothing; it stays where it is, out of every ordered group.
    return found.unionByName(left.where(~reachable), allowMissingColumns=True)


def asof_by_date(left: DataFrame, left_d: str, series: DataFrame, d: str, strict: bool = False,
                 carry: Sequence[str] | None = None, matched: str = "matched_t") -> DataFrame:
    """As-of join without a key: each left date to the last row of one daily series.

    The series, reduced to one row per day, is spread over the days up to its next row, shifted by a day when
    ``strict``; what remains is an equality join on the date, and later dates take the series' last row. The facts
    are read once and enter no ordered pass.
    """
    carry = list(carry if carry is not None else [c for c in series.columns if c != d])
    shift = 1 if strict else 0
    daily = series.where(F.col(d).isNotNull()).groupBy(F.col(d).cast("date").alias("t")).agg(
        F.max(F.struct(*carry)).alias("row"))
    following = F.lead("t").over(Window.orderBy("t"))
    spread = daily.withColumn("until", F.coalesce(F.date_sub(following, 1), "t")).select(
        F.explode(day_range(F.date_add("t", shift), F.date_add("until", shift))).alias("__day"),
        F.struct("t", "row").alias("__hit"))
    last = daily.agg(F.max(F.struct("t", "row")).alias("last")).scalar()
    joined = left.join(spread, F.col(left_d) == F.col("__day"), "left").withColumn(
        "__hit", F.when(F.col(left_d) >= F.date_add(last["t"], shift), last).otherwise(F.col("__hit")))
    return joined.select(*left.columns, F.col("__hit.t").alias(matched), *(F.col(f"__hit.row.{c}").alias(c) for c in carry))


def calendar_ffill(series: DataFrame, d: str, values: Sequence[str], by: Sequence[str] = (),
                   observed: str = "obs_date") -> DataFrame:
    """Every calendar day between the first and last observation, with the last observation carried forward.

    Each observation is spread over the days up to the next one: an ordered pass over the observations (one
    per day and key), and no join with a calendar.
    """
    seen = series.where(F.col(d).isNotNull())
    following = F.lead(d).over(Window.partitionBy(*by).orderBy(d))
    until = F.coalesce(F.date_sub(following, 1), F.col(d))
    spread = seen.withColumn("__until", until).select(
        *by, F.col(d).alias(observed), *values, F.explode(day_range(F.col(d), F.col("__until"))).alias("__day"))
    return spread.select(*by, F.col("__day").alias(d), *values, observed)
