"""Duplicate handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def dedup_keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str | Column],
                    tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One whole row per key: the last in ``order``, NULLs first, ties to the largest ``tiebreak`` columns.

    A maximum of a struct, which is combined before the shuffle: copies of one key collapse where they are
    read, and the result depends neither on input order nor on chunking.
    """
    rest = [c for c in (tiebreak or df.columns) if c not in key]
    named = {f"__o{i}": F.col(o) if isinstance(o, str) else o for i, o in enumerate(order)}
    plain = [o for o in order if isinstance(o, str)]
    # Every column travels once: the ordering, the tie-break, then what is left of the row.
    first = [named[n].alias(o if isinstance(o, str) and o not in key else n) for n, o in zip(named, order)]
    seen = {o for o in plain if o not in key}
    body = [c for c in [*rest, *(c for c in df.columns if c not in key and c not in rest)] if c not in seen]
    best = df.groupBy(*key).agg(F.max(F.struct(*first, *(F.col(c) for c in body))).alias("__m"))
    return best.select(*(F.col(c) if c in key else F.col(f"__m.{c}").alias(c) for c in df.columns))


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Later pull over earlier pull: the new row wins where both have the key."""
    stacked = old.withColumn("__src", F.lit(0)).unionByName(new.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    return dedup_keep_last(stacked, key, ["__src"]).drop("__src")


def duplicate_count(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys (NULL parts count as values) and the difference: one row, or one for each group of ``by``."""
    per_key = df.groupBy(*by, *key).agg(F.count("*").alias("__n"))
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def dedup_ordered(df: DataFrame, text: str, position: str) -> DataFrame:
    """Distinct texts with the position of their first appearance."""
    return df.groupBy(text).agg(F.min(position).alias(position))
