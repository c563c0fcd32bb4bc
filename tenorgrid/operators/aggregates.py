"""Aggregations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenorgrid.operators.skew import dimension_join

QUANTILE_BINS = 64


def last_value(value: Column | str, order: Column | str) -> Column:
    """Value at the largest ``order`` among rows where the value is not NULL, as an aggregate."""
    v = F.col(value) if isinstance(value, str) else value
    o = F.col(order) if isinstance(order, str) else order
    return F.max_by(v, F.when(v.isNotNull(), o))


def pivot_columns(key: str, values: Mapping[str, str], value: str, agg: Callable[[Column], Column] = F.max) -> list[Column]:
    """Fixed pivot as aggregates: one column per key value, in the same pass as any other aggregate."""
    return [agg(F.when(F.col(key) == k, F.col(value))).alias(name) for k, name in values.items()]


def pivot_fixed(df: DataFrame, by: Sequence[str], key: str, values: Mapping[str, str], value: str,
                agg: Callable[[Column], Column] = F.max) -> DataFrame:
    return df.groupBy(*by).agg(*pivot_columns(key, values, value, agg))


def _edges_below(lo: int, hi: int) -> str:
    """SQL of a binary search: how many of the sorted edges lie below the value."""
    if lo == hi:
        return str(lo)
    mid = (lo + hi) // 2
    return f"CASE WHEN __v > __edges[{mid}] THEN {_edges_below(mid + 1, hi)} ELSE {_edges_below(lo, mid)} END"


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group, without holding a group in one task.

    Values are first counted per distinct value. Approximate edges split each group's distinct values into
    bins of similar size; cumulative bin counts show which bins hold the wanted ranks, and only those bins are
    ordered. The edges affect balance only, never the result.
    """
    g = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*g, F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    key = g or ["__all"]
    if not g:
        counted = counted.withColumn("__all", F.lit(1))
    cuts = [i / QUANTILE_BINS for i in range(1, QUANTILE_BINS)]
    edges = counted.groupBy(*key).agg(
        F.percentile_approx("__v", cuts, 100 * QUANTILE_BINS).alias("__edges"), F.sum("__n").alias("__total"))
    # Without a group the edges are one row, read by a scalar subquery.
    binned = dimension_join(counted, edges, key, "inner") if g else _attach(counted, edges.drop("__all"))
    binned = binned.withColumn("__bin", F.expr(_edges_below(0, len(cuts))))
    bins = binned.groupBy(*key, "__bin").agg(F.sum("__n").alias("__bn"), F.min("__total").alias("__total"))
    upto = Window.partitionBy(*key).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("__before", F.coalesce(F.sum("__bn").over(upto), F.lit(0)))

    rank = {name: F.lit(float(p)) * (F.col("__total") - 1) for name, p in probs.items()}
    lo = {name: F.floor(r) for name, r in rank.items()}
    hi = {name: F.ceil(r) for name, r in rank.items()}

    def holds(r: Column, before: Column, n: Column) -> Column:
        return (before <= r) & (r < before + n)

    wanted = None
    for r in [*lo.values(), *hi.values()]:
        h = holds(r, F.col("__before"), F.col("__bn"))
        wanted = h if wanted is None else wanted | h
    bins = bins.where(wanted).select(*key, "__bin", "__before")
    inside = Window.partitionBy(*key, "__bin").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = binned.drop("__edges").join(bins, [*key, "__bin"]).withColumn(
        "__before", F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0)))

    at = lambda r: F.max(F.when(holds(r, F.col("__before"), F.col("__n")), F.col("__v")))
    aggs = [F.max("__total").alias("__total")]
    for name in probs:
        aggs += [at(lo[name]).alias(f"__lo_{name}"), at(hi[name]).alias(f"__hi_{name}")]
    picked = ranked.groupBy(*key).agg(*aggs)
    out = [
        (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * (rank[n] - F.floor(rank[n]))).alias(n)
        for n in probs
    ]
    return picked.select(*g, *out)


Measure = Callable[[Column], Column]


def scoped_report(df: DataFrame, scopes: Mapping[str, Column], measures: Mapping[str, Measure],
                  by: Sequence[str] = (), quantiles: tuple[str, Mapping[str, float]] | None = None) -> DataFrame:
    """The same measures under several overlapping predicates, one row per scope (and ``by`` group).

    All scopes are filtered aggregates of one pass, so rows are not repeated per scope and a scope without
    rows still reports. A measure maps the scope's predicate to an aggregate. Quantiles of one column are
    added by the exact distributed method.
    """
    cells = [
        F.struct(F.lit(name).alias("scope"), *(m(F.coalesce(cond, F.lit(False))).alias(k) for k, m in measures.items()))
        for name, cond in scopes.items()
    ]
    flat = df.groupBy(*by).agg(F.array(*cells).alias("__cells"))
    out = flat.select(*by, F.explode("__cells").alias("__c")).select(*by, "__c.*")
    if quantiles is None:
        return out
    value, probs = quantiles
    matching = F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in scopes.items())))
    tagged = df.select(*by, value, F.explode(matching).alias("scope"))
    q = exact_quantiles(tagged, [*by, "scope"], value, probs)
    return out.join(q, [*by, "scope"], "left")


def calendar_month_mean(calendar: DataFrame, d: str, value: str, ym: str = "ym") -> DataFrame:
    """Mean over the calendar days of each month of a series already filled forward."""
    return calendar.groupBy(F.date_format(d, "yyyy-MM").alias(ym)).agg(
        F.avg(value).alias("month_mean"), F.count("*").alias("n_days"))


def month_last(df: DataFrame, d: str, value: Column | str, ym: str = "ym", by: Sequence[str] = (), ties: Sequence[str] = ()) -> DataFrame:
    """Last non-NULL value of each month, of rows of one date the last by ``ties``, and the last date present."""
    return df.groupBy(*by, F.date_format(d, "yyyy-MM").alias(ym)).agg(
        last_value(value, F.struct(d, *ties)).alias("last_value"), F.max(d).alias("last_date"))


def bounded_values(df: DataFrame, by: Sequence[str], value: str, most: int = 100) -> DataFrame:
    """Per group ``n_distinct``, ``least``, ``largest``, and ``listed``: all distinct values in order if they are at most
    ``most``, otherwise NULL; ``distinct_values`` has them as rows then. A list never holds more than ``most + 1`` values.
    """
    distinct = distinct_values(df, by, value)
    per = df.groupBy(*by).agg(F.count_if(F.lit(False)).alias("__none")).drop("__none")
    counts = distinct.groupBy(*by).agg(F.count("*").alias("n_distinct"), F.min(value).alias("least"), F.max(value).alias("largest"))
    first = distinct.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(value))).where(F.col("__r") <= most + 1)
    lists = first.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("listed"))
    out = per
    for side in (counts, lists):
        same = reduce(lambda a, b: a & b, [out[c].eqNullSafe(side[c]) for c in by])
        out = out.join(side, same, "left").select(*(out[c] for c in out.columns), *(side[c] for c in side.columns if c not in by))
    n = F.coalesce("n_distinct", F.lit(0).cast("long"))
    return out.select(*by, n.alias("n_distinct"), "least", "largest", F.when(n <= most, F.coalesce("listed", F.array().cast(first.select(
        F.array(value)).schema[0].dataType))).alias("listed"))


def distinct_values(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The distinct values of each group, one per row."""
    return df.where(F.col(value).isNotNull()).select(*by, value).distinct()


def set_collapse(df: DataFrame, by: Sequence[str], value: str, out: str, most: int = 100) -> DataFrame:
    """The value when a group has one distinct value, otherwise ``mixed:`` and the sorted values, or, of more than ``most``,
    their number with the least and the largest.
    """
    many = F.concat_ws("", F.lit("mixed:"), "n_distinct", F.lit(" from "), "least", F.lit(" to "), "largest")
    return bounded_values(df, by, value, most).select(*by, F.when(F.col("n_distinct") == 1, F.col("least")).when(
        F.col("listed").isNull(), many).when(F.col("n_distinct") > 1, F.concat(F.lit("mixed:"), F.array_join("listed", ","))).alias(out))


def share_before(facts: DataFrame, starts: DataFrame, key: str, t: str, start: str, amount: str) -> DataFrame:
    """Per key: total amount, amount before the key's start, and the share of the total it makes up."""
    rows = dimension_join(facts.select(key, t, amount), starts.select(key, start), [key], "inner")
    return rows.groupBy(key).agg(
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("amount_total"),
        F.coalesce(F.sum(F.when(F.col(t) < F.col(start), F.col(amount))), F.lit(0.0)).alias("amount_before"),
    ).withColumn("share_before", F.col("amount_before") / F.nullif(F.col("amount_total"), F.lit(0.0)))


def _attach(base: DataFrame, one_row: DataFrame) -> DataFrame:
    """Columns of a one-row table beside those of another, read by one scalar subquery."""
    row = base.withColumn("__row", one_row.select(F.struct("*")).scalar())
    return row.select(*base.columns, *(F.col(f"__row.{c}").alias(c) for c in one_row.columns))


def error_summary(df: DataFrame, err: Column, tol: float, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, median, 90th percentile and maximum of absolute errors, and how many are within ``tol``."""
    e = df.select(*by, F.abs(err).alias("abs_err"))
    base = e.groupBy(*by).agg(F.count("abs_err").alias("n"), F.avg("abs_err").alias("mae"),
                              F.max("abs_err").alias("max_abs"), F.count_if(F.col("abs_err") <= tol).alias("n_within"))
    q = exact_quantiles(e, by, "abs_err", {"median_abs": 0.5, "p90_abs": 0.9})
    if by:
        return base.join(q, list(by), "left")
    return _attach(base, q)


def signal_stats(df: DataFrame, x: str, step: str, threshold: float) -> DataFrame:
    """Correlation of a signal with the next step, and mean step and win rate above a threshold."""
    both = df.where(F.col(x).isNotNull() & F.col(step).isNotNull())
    above = F.col(x) > threshold
    return both.agg(
        F.count("*").alias("n_pairs"), F.corr(x, step).alias("corr"), F.count_if(above).alias("n_above"),
        F.avg(F.when(above, F.col(step))).alias("mean_step_above"),
        F.avg(F.when(above, (F.col(step) > 0).cast("double"))).alias("win_rate"),
    )


def complement_check(df: DataFrame, key: str, label: str, yes: str, no: str, t: str, value: str, bucket_s: int,
                     tol: float = 0.05) -> DataFrame:
    """How far the two complementary legs of a key are from summing to one, per time bucket.

    Both legs are averaged in one grouping by (key, bucket) instead of joining the table to itself.
    """
    leg = lambda name: F.avg(F.when(F.col(label) == name, F.col(value)))
    pairs = df.groupBy(key, F.floor(F.col(t) / F.lit(bucket_s)).alias("bucket")).agg(
        leg(yes).alias("y"), leg(no).alias("n")).where("y IS NOT NULL AND n IS NOT NULL")
    dev = pairs.withColumn("dev", F.abs(F.col("y") + F.col("n") - 1))
    base = dev.agg(F.count("*").alias("n_pairs"), F.countDistinct(key).alias("n_keys"),
                   F.max("dev").alias("max_dev"), F.count_if(F.col("dev") > tol).alias("n_above"))
    q = exact_quantiles(dev, [], "dev", {"median_dev": 0.5, "p95_dev": 0.95})
    return _attach(base, q)
