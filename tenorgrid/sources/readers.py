"""Readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tenorgrid.functions.values import number


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One typed table. Zone-less timestamps are read as UTC instants, so filters on them reach the scan."""
    return spark.read.schema(schema).parquet(path)


def read_union_by_name(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Many files as one table, columns matched by name, missing ones NULL.

    With a schema every file is read against it in one scan; without one the footers are merged.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(*paths)
    return spark.read.option("mergeSchema", True).parquet(*paths)


def assemble_parts(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All parts staged below a folder as one table."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)


def manifest_value(spark: SparkSession, path: str, field: str) -> DataFrame:
    """One row with one field of a JSON manifest; use ``.scalar()`` on it as a query parameter."""
    schema = T.StructType([T.StructField(field, T.StringType())])
    return spark.read.schema(schema).json(path, multiLine=True).select(field)


def _series_name() -> Column:
    """The name before ``.csv`` of a file, or of a folder of part files."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.csv(?:/[^/]+)?$", 1).alias("series_id")


def _series_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    raw = spark.read.schema("date string, value string").csv(list(paths), header=True)
    return raw.select(_series_name(),
                      F.col("date").alias("raw_date"), F.col("date").try_cast("date").alias("date"),
                      F.col("value").alias("raw_value"), number("value").alias("value"))


def read_series_csv(spark: SparkSession, paths: Sequence[str], venue: str = "rates") -> DataFrame:
    """Two-column series files, one series per file and named by it, to typed long rows.

    Unreadable values (a lone dot) become NULL and keep their row; of several rows of one date one with a value
    counts, the largest. Rows without a readable date are those of ``unreadable_dates``. ``series_header_check``
    tests the headers.
    """
    typed = _series_rows(spark, paths).where("date IS NOT NULL")
    rows = typed.groupBy("series_id", "date").agg(F.max("value").alias("value"))
    return rows.select(
        F.lit(venue).alias("venue"), F.col("series_id").alias("event_id"), F.col("series_id").alias("market_id"),
        F.lit("OTHER").alias("outcome"), (F.unix_date("date").cast("bigint") * 86400).alias("ts"),
        "date", "series_id", "value")


def unreadable_dates(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows of series files whose date does not parse: series_id, raw_date, raw_value, rule."""
    return _series_rows(spark, paths).where("date IS NULL").select(
        "series_id", "raw_date", "raw_value", F.lit("unreadable_date").alias("rule"))


def series_header_check(spark: SparkSession, paths: Sequence[str], date_name: str = "observation_date") -> DataFrame:
    """One row per series file: whether its first line is the date column and the series id."""
    text = spark.read.text(list(paths), wholetext=False).select(
        _series_name(), (F.col("_metadata.file_block_start")).alias("at"), "value")
    # Only the block at the start of a file is looked at; the header is the one line of it that can match.
    head = text.where("at = 0")
    header = F.concat_ws(",", F.lit(date_name), F.col("series_id"))
    return head.groupBy("series_id").agg(F.bool_or(F.col("value") == header).alias("header_ok"))
