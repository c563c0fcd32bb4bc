"""Stacking, unnesting and key sets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def union_tagged(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack tables, each row tagged with the name of its part."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def unnest_array(df: DataFrame, array: str, out: str) -> DataFrame:
    """One row per element; an empty or NULL array gives no row."""
    return df.select(*(c for c in df.columns if c != array), F.explode(array).alias(out))


def unnest_zip(df: DataFrame, items: str, labels: str, item: str, label: str) -> DataFrame:
    """Unnest an array by position with a parallel array of labels; a missing label becomes ``idx<i>``."""
    rows = df.select("*", F.posexplode(items).alias("pos", item))
    named = F.coalesce(F.get(F.col(labels), F.col("pos")), F.concat(F.lit("idx"), F.col("pos")))
    return rows.withColumn(label, named).drop(items, labels)


def keep_collectable(labels: Column, label: Column, canonical: Column, yes: str = "Yes", no: str = "No") -> Column:
    """Which tokens to keep: the Yes token; the No token of canonical outcomes; all of them without a Yes."""
    return (label == yes) | ~F.array_contains(labels, yes) | (canonical & (label == no))
