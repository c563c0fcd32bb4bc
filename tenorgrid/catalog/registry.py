"""Query registry over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tenorgrid.session import use_utc
from tenorgrid.sources.readers import read_table
from tenorgrid.sources.schemas import TEST_TABLES


class Tables:
    """The tables of one folder, read on access with their declared schema."""

    def __init__(self, spark: SparkSession, folder: str):
        use_utc(spark)
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TEST_TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.path(name), TEST_TABLES[name])


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Entry(build, sql)
        return build

    return register
