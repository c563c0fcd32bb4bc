"""Rules over tables as one pass: every row gives the rules it breaks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

ANOMALY = "check string, key string, detail string"


@dataclass(frozen=True)
class Rule:
    """``name`` is broken where ``broken`` is true (NULL is not); ``key`` and ``detail`` describe the row as text."""

    name: str
    broken: Column
    key: Column
    detail: Column | None = None


def broken_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(``check``, ``key``, ``detail``) for each rule that a row breaks, whatever the number of rules from one scan."""
    def row(r: Rule) -> Column:
        detail = F.lit(None) if r.detail is None else r.detail
        return F.when(r.broken, F.struct(F.lit(r.name).alias("check"), r.key.cast("string").alias("key"), detail.cast("string").alias("detail")))

    found = df.select(F.explode(F.array_compact(F.array(*map(row, rules)))).alias("found"))
    return found.select("found.check", "found.key", "found.detail")
