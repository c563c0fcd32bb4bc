"""Join shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tenorgrid.operators.skew import dimension_join


def join_split(dim: DataFrame, facts: DataFrame, branches: Sequence[tuple[Column, Column, Column, Column]]) -> DataFrame:
    """Inner join on a disjunction whose branches exclude each other on the dimension side.

    A branch is (dimension predicate, dimension key, fact predicate, fact key); keys of all branches share a
    type. An OR as join condition would compare all pairs. Here a fact offers one key per branch it satisfies,
    a dimension row asks for the key of its branch, and (branch, key) is one equality join: the facts are read
    and moved once.
    """
    on = ["__branch", "__key"]
    side = lambda i, key: F.struct(F.lit(i).alias("branch"), key.alias("key"))
    asked = F.coalesce(*(F.when(keep, side(i, key)) for i, (keep, key, _, _) in enumerate(branches)))
    offers = F.array_compact(F.array(*(F.when(keep, side(i, key)) for i, (_, _, keep, key) in enumerate(branches))))
    flat = lambda df, s: df.withColumns({"__branch": s["branch"], "__key": s["key"]})
    d = flat(dim.withColumn("__s", asked).where("__s IS NOT NULL"), F.col("__s")).drop("__s")
    f = flat(facts.withColumn("__s", F.explode(offers)), F.col("__s")).drop("__s")
    return dimension_join(f, d, on, "inner").drop(*on)


def nearest_match(df: DataFrame, d: str, dim: DataFrame, dim_d: str, tol_days: int, out: str) -> DataFrame:
    """Nearest date of a calendar within a tolerance, ties to the earlier entry; NULL beyond it.

    Every calendar entry offers itself to the days around it and the best offer per day is kept, which leaves
    an equality join on the day.
    """
    offers = dim.select(F.col(dim_d).alias("__entry"), F.explode(F.sequence(
        F.date_sub(dim_d, tol_days), F.date_add(dim_d, tol_days), F.expr("interval 1 day"))).alias("__day"))
    best = offers.groupBy("__day").agg(
        F.min(F.struct(F.abs(F.datediff("__day", "__entry")).alias("gap"), F.col("__entry").alias("entry"))).alias("__b"))
    best = best.select(F.col("__day").alias("__key"), F.col("__b.entry").alias(out))
    keyed = df.withColumn("__key", F.col(d))
    return dimension_join(keyed, best, ["__key"]).drop("__key")


def priority_match(left: DataFrame, right: DataFrame, rules: Sequence[tuple[Column, Column]], take: str,
                   order: str, out: str = "matched", rule: str = "match_rule") -> DataFrame:
    """Match by rules in order of priority; within a rule the first right row by ``order`` wins.

    A rule is (left key, right key). Each rule is one equality join to the right side reduced to one row per
    key.
    """
    rows = left
    hits = []
    for i, (lk, rk) in enumerate(rules):
        first = right.select(rk.alias(f"__k{i}"), F.col(take).alias(f"__v{i}"), F.col(order).alias("__o"))
        first = first.where(F.col(f"__k{i}").isNotNull()).groupBy(f"__k{i}").agg(
            F.min(F.struct("__o", f"__v{i}")).getField(f"__v{i}").alias(f"__v{i}"))
        rows = dimension_join(rows.withColumn(f"__k{i}", lk), first, [f"__k{i}"]).drop(f"__k{i}")
        hits.append(f"__v{i}")
    which = F.coalesce(*(F.when(F.col(h).isNotNull(), F.lit(i + 1)) for i, h in enumerate(hits)))
    return rows.withColumns({out: F.coalesce(*hits), rule: which}).drop(*hits)


def reconcile(a: DataFrame, b: DataFrame, on: Sequence[str], value_a: str, value_b: str, tol: float) -> DataFrame:
    """One row: keys in both sources, values further apart than ``tol``, and the largest difference."""
    diff = F.abs(F.col("__a") - F.col("__b"))
    both = a.select(*on, F.col(value_a).alias("__a")).join(b.select(*on, F.col(value_b).alias("__b")), list(on))
    return both.agg(F.count("*").alias("overlaps"), F.count_if(diff > tol).alias("mismatches"),
                    F.max(diff).alias("max_abs_diff"))


def join_dimension_array(df: DataFrame, key: str, array: str, lookup: DataFrame, on: str, value: str,
                         out: str) -> DataFrame:
    """Sum of a looked-up value over the elements of an array column; unknown elements count zero."""
    items = df.select(key, F.explode_outer(array).alias(on))
    found = dimension_join(items, lookup.select(on, value), [on])
    return found.groupBy(key).agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias(out))
