"""What the operators share: tables in the shared folder, bounded id filters, input guards."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Whitespace that separates words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where that is unset, a local session sets a temporary folder of its own; a cluster has to name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def keep(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mark_maybe(df: DataFrame, key: Column, ids: DataFrame, id_column: str, log2_bits: int = 23) -> DataFrame:
    """``df`` with ``_maybe``: true for every row whose key is among ``ids``, and for few others.

    The ids become a bitmap of ``2 ** log2_bits`` bits, in 64-bit words, so what is broadcast has at most
    ``2 ** (log2_bits - 6)`` rows whatever the number of ids.
    """
    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << log2_bits))

    bitmap = (ids.select(place(F.col(id_column)).alias("_p"))
              .groupBy((F.shiftright("_p", 6)).alias("_word"))
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(_p & 63 as int))")).alias("_bits")))
    return (df.withColumn("_p", place(key)).withColumn("_w", F.shiftright(F.col("_p"), 6))
            .join(F.broadcast(bitmap), F.col("_w") == F.col("_word"), "left")
            .withColumn("_maybe", F.coalesce(F.expr("(_bits & shiftleft(1L, cast(_p & 63 as int))) != 0"), F.lit(False)))
            .drop("_p", "_w", "_word", "_bits"))


def maybe_in(df: DataFrame, key: Column, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows of ``df`` whose key may be among ``ids``: thins out the wide side before an exact join.

    The exact join should be an inner one; a semi join would be pushed below this filter.
    """
    return mark_maybe(df, key, ids, id_column).where("_maybe").drop("_maybe")


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def free(taken: list[str], *wanted: str) -> list[str]:
    """Names for new columns, each as wanted or with underscores in front, that no column of the caller has."""
    used = {name.lower() for name in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


class Sheltered:
    """The columns of a caller under inner names ``c0``, ``c1`` ..., so that columns added inside cannot meet them.

    ``df`` is the renamed table, ``self[name]`` the inner name of a column, ``back`` restores columns and names.
    """

    def __init__(self, table: DataFrame):
        self.names = table.columns
        self.inner = [f"c{k}" for k in range(len(self.names))]
        self.df = table.toDF(*self.inner)

    def __contains__(self, name: str | None) -> bool:
        return name in self.names

    def __getitem__(self, name: str) -> str:
        return self.inner[self.names.index(name)]

    def back(self, df: DataFrame) -> DataFrame:
        return df.select(*self.inner).toDF(*self.names)


def task_count(rows: int, per_task: int) -> int:
    """Number of partitions or shards that grows with the rows."""
    return max(1, -(-rows // per_task))
