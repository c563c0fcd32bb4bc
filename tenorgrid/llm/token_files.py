"""Token-id files: Parquet list columns in ascending document order, read back column by column.

A file (shard) is one range of document ids. Its columns are the row number, the id, the number of ids before the
document in the shard, the document's length and the ids. The ids use dictionary encoding (a vocabulary fits one
dictionary page), the counters delta encoding, row groups and pages are of set sizes and carry column and offset
indexes, so that a reader takes single documents, or only the counters, without the rest.

Null text is an empty text; every document ends with id 0. Rows of one id keep an order by their text's hash; null
ids come first. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenorgrid.llm.common import shared_folder
from tenorgrid.llm.tokens import coder, slices, tokenizer_path

LAYOUT = "shard int, row bigint, doc_id bigint, at bigint, n_tokens int, ids array<int>"
FILE_FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#row": "false",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#at": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = at = 0
        for whole in batches:
            for batch in slices(whole, 2):
                ids, edge = coder(path).encode(batch.column(2))
                n = np.diff(edge)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.arange(row, row + len(n))), batch.column(1), pa.array(at + edge[:-1]),
                     pa.array(n.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(ids))],
                    names=["shard", "row", "doc_id", "at", "n_tokens", "ids"])
                row, at = row + len(n), at + int(edge[-1])
    return run


def write_tokens(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> None:
    """Encode ``docs`` and write them to the folder ``path``, one file per range of ids."""
    ordered = (docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    (ordered.select(F.spark_partition_id().alias("shard"), "doc_id", "text")
     .mapInArrow(_encode(vocabulary or tokenizer_path()), LAYOUT).write.options(**FILE_FORMAT).parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LAYOUT).parquet(path)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        edge = lists.offsets.to_numpy()
        ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(edge).astype(np.int64)),
             pa.array([zlib.crc32(ids[a:b]) for a, b in zip(edge[:-1], edge[1:])], pa.int64())],
            names=["shard", "at", "doc_id", "n_tokens", "ids_crc32"])


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """From the files: per document its id, the ids before it, its number of ids and their checksum."""
    rows = read_tokens(spark, path).select("shard", "at", "doc_id", "ids").mapInArrow(
        _sums, "shard int, at bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    # One row per file: only its last document's place and length are read.
    totals = read_tokens(spark, path).groupBy("shard").agg(F.max(F.col("at") + F.col("n_tokens")).alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    return rows.join(before, "shard").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token ids in ascending id order and digest what the files hold."""
    path = shared_folder(spark)
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return token_digest(spark, path)
