"""Joins and ordered carries that keep a hot key spread over many tasks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenorgrid.session import shared_folder

@dataclass(frozen=True)
class Sized:
    """Buckets of about ``target`` rows, from the data: nothing has to be known of the times of a key."""

    target: int = 1_000_000


Bucket = Callable[[Column], Column] | Sized
FINE = 32  # fine bins for each bucket that a key needs


def per_days(n: int) -> Bucket:
    """Bucket dates or timestamps into runs of ``n`` days."""
    return lambda t: F.floor(F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")) / F.lit(n)).cast("long")


def per_seconds(n: int) -> Bucket:
    """Bucket epoch seconds into runs of ``n`` seconds."""
    return lambda t: F.floor(t / F.lit(n)).cast("long")


def dimension_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                   salt_by: Sequence[str] = (), salts: int | None = None) -> DataFrame:
    """Join a table with hot keys to a table with one row per key.

    By default it is a plain join: adaptive execution broadcasts the right side when its measured size allows and
    splits skewed partitions of the left side otherwise, and only the columns in use are read. Name ``salt_by`` where
    the split has to be in the plan: stable id columns of the left side, never sums, which a recomputed task may
    return with another last digit. The right side is then repeated once per salt, ``salts`` times (by default one
    per shuffle partition).
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"dimension_join cannot preserve right rows: {how}")
    if not salt_by:
        return left.join(right, list(on), how)
    floating = [c for c in salt_by if dict(left.dtypes)[c] in ("float", "double")]
    if floating:
        raise ValueError(f"not stable enough for a salt: {floating}")
    n = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(n)).cast("int")
    return left.withColumn("__salt", salt).join(spread, [*on, "__salt"], how).drop("__salt")


def _enter_buckets(rows: DataFrame, heads: DataFrame, by: Sequence[str], order: Sequence[str], x: str) -> tuple[DataFrame, list]:
    """Rows packed with one extra first row per bucket that brings ``x`` in from the earlier buckets.

    Returns the stacked table and the ordering inside a bucket. ``__own`` is 1 on real rows.
    """
    kept = [c for c in rows.columns if c not in (*by, _BUCKET, x)]
    body = rows.select(*by, _BUCKET, F.lit(1).alias("__own"), x, F.struct(*kept).alias("__row"))
    first = heads.select(*by, _BUCKET, F.lit(0).alias("__own"), x,
                         F.lit(None).cast(body.schema["__row"].dataType).alias("__row"))
    ordering = [F.col("__own"), *(F.col(f"__row.{c}") if c in kept else F.col(c) for c in order)]
    return body.unionByName(first), ordering


def _unpack(stacked: DataFrame, by: Sequence[str], columns: Sequence[str], out: str) -> DataFrame:
    return stacked.where(F.col("__own") == 1).select(
        *(F.col(c) if c in by else F.col(f"__row.{c}").alias(c) for c in columns), out)


_BUCKET, _X, _TAIL = "__bucket", "__x", "__tail"


def _number(df: DataFrame, t: str) -> Column:
    """The order of ``t`` as a number."""
    kind = dict(df.dtypes)[t]
    return {"date": F.unix_date, "timestamp": F.unix_micros}.get(kind, lambda c: c)(F.col(t)).cast("double")


def _written(df: DataFrame) -> DataFrame:
    """A small table, written once to the shared folder, so that what it was made from is not computed again."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _refined(rows: DataFrame, key: list[str], t: Column, target: int, out: str) -> tuple[DataFrame, bool]:
    """``out``: buckets of about ``target`` rows of each ``key``, in the order of ``t``; one bucket where it has no more.
    Also whether one came out more than twice as large.

    The range of a large key is cut into fine bins of equal length, which are counted, and the running count says
    where a bucket ends. Equal times share a bin. Only keys above the target have bins, so both tables that the rows
    meet are small: at most one key, and ``FINE`` bins, for each ``target`` rows.
    """
    large = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), F.min(t).alias("__lo"), F.max(t).alias("__hi")).where(F.col("__n") > target)
    parts = F.ceil(F.col("__n") / F.lit(target)) * FINE
    width = F.greatest((F.col("__hi") - F.col("__lo")) / parts, F.lit(1e-9))
    large = _written(large.select(*(F.col(k).alias(f"__{k}") for k in key), "__lo", width.alias("__width")))
    none = F.lit(0).cast("long")
    if not large.limit(1).count():
        return rows.withColumn(out, none), False
    same = lambda side: reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(side[f"__{k}"]) for k in key])
    fine = F.when(F.col("__width").isNull(), none).otherwise(F.coalesce(F.floor((t - F.col("__lo")) / F.col("__width")), F.lit(-1)).cast("long"))
    placed = rows.join(large, same(large), "left").withColumn("__fine", fine).drop(*(f"__{k}" for k in key), "__lo")
    bins = placed.where(F.col("__width").isNotNull()).groupBy(*key, "__fine").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(*key).orderBy("__fine")
    before, big = F.sum("__n").over(upto) - F.col("__n"), (F.col("__n") > target).cast("long")
    number = F.floor(before / F.lit(target)).cast("long") + 2 * F.sum(big).over(upto) - big  # a bin above the target stands alone
    bins = _written(bins.select(*(F.col(k).alias(f"__{k}") for k in key), F.col("__fine").alias("__bin"), "__n", number.alias(out)))
    uneven = bins.groupBy(*(f"__{k}" for k in key), out).agg(F.sum("__n").alias("n")).where(F.col("n") > 2 * target).limit(1).count() > 0
    bins = bins.drop("__n")
    found = placed.join(bins, same(bins) & (F.col("__fine") == F.col("__bin")), "left")
    return found.withColumn(out, F.coalesce(out, none)).drop(*(f"__{k}" for k in key), "__bin", "__fine", "__width"), uneven


def with_buckets(rows: DataFrame, by: Sequence[str], t: str, bucket: Bucket) -> DataFrame:
    """``rows`` with their bucket, non-decreasing in ``t`` within a key.

    ``Sized`` buckets are cut a second time within themselves where a key's rows crowd into a small part of its range.
    The bins are small written tables, so ``rows`` is read once for each of them and once for the result.
    """
    if not isinstance(bucket, Sized):
        return rows.withColumn(_BUCKET, bucket(F.col(t)))
    x = _number(rows, t)
    once, uneven = _refined(rows, list(by), x, bucket.target, "__coarse")
    twice = _refined(once, [*by, "__coarse"], x, bucket.target, "__part")[0] if uneven else once.withColumn("__part", F.lit(0).cast("long"))
    return twice.withColumn(_BUCKET, F.struct("__coarse", "__part")).drop("__coarse", "__part")


def carry_forward(df: DataFrame, by: Sequence[str], order: Sequence[str], payload: Column, out: str,
                  bucket: Bucket | None = None) -> DataFrame:
    """Last non-NULL ``payload`` over the rows strictly before each row, per ``by`` in ``order``.

    Without ``bucket`` it is one window per key: right where a key has at most one row per calendar day. With
    ``bucket`` (``Sized``, or a column non-decreasing in the first order column) a key is cut into buckets; each bucket's last payload
    is aggregated, carried over the short list of buckets, and enters its bucket as a first row. The result is
    the same, and no task ever holds more than one bucket of one key.
    """
    rows = df.withColumn(_X, payload)
    if bucket is None:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(out, F.last(_X, ignorenulls=True).over(w)).drop(_X)

    rows = with_buckets(rows, by, order[0], bucket)
    tails = rows.groupBy(*by, _BUCKET).agg(
        F.max(F.when(F.col(_X).isNotNull(), F.struct(*order, F.col(_X)))).alias(_TAIL))
    past = Window.partitionBy(*by).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    heads = tails.select(*by, _BUCKET, F.last(F.col(f"{_TAIL}.{_X}"), ignorenulls=True).over(past).alias(_X))
    stacked, ordering = _enter_buckets(rows, heads.where(F.col(_X).isNotNull()), by, order, _X)
    within = Window.partitionBy(*by, _BUCKET).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
    return _unpack(stacked.withColumn(out, F.last(_X, ignorenulls=True).over(within)), by, df.columns, out)


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[str], amount: Column, out: str,
                  bucket: Bucket | None = None) -> DataFrame:
    """Sum of ``amount`` up to and including each row, per ``by`` in ``order``; bucketed like ``carry_forward``."""
    rows = df.withColumn(_X, amount)
    if bucket is None:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn(out, F.sum(_X).over(w)).drop(_X)

    rows = with_buckets(rows, by, order[0], bucket)
    totals = rows.groupBy(*by, _BUCKET).agg(F.sum(_X).alias(_X))
    past = Window.partitionBy(*by).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    heads = totals.select(*by, _BUCKET, F.sum(_X).over(past).alias("__sum")).withColumnRenamed("__sum", _X)
    stacked, ordering = _enter_buckets(rows, heads.where(F.col(_X).isNotNull()), by, order, _X)
    within = Window.partitionBy(*by, _BUCKET).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, 0)
    return _unpack(stacked.withColumn(out, F.sum(_X).over(within)), by, df.columns, out)
