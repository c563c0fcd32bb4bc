"""Sinks, views and the table list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (),
                 files: int | None = None, mode: str = "overwrite") -> None:
    """Parquet with zstd, range-partitioned and sorted by ``keys``; row groups stay selective on them."""
    by = [*partition_by, *keys]
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    writer = ranged.sortWithinPartitions(*by).write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def materialise(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table, replacing an earlier build of it, and read it back: later plans start from the files."""
    writer = df.write.mode("overwrite").format("parquet").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Name each table as a temporary view, so that it can be used in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count; the counts are independent aggregates of one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionAll(one)
    return out


def named_table_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return table_counts({n: spark.table(n) for n in names})
