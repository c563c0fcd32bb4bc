"""Packing of token sequences by shortest-pack-first over the length histogram.

A document's ids are cut into pieces of the sequence length and one remainder. The histogram of piece lengths, at
most one row per length, goes to the driver, where lengths are placed longest first, each into the packs with the
most room; packs of equal content are one pattern with a count. Patterns then meet the pieces by rank: pieces of one
length are numbered, and a run of numbers belongs to one place of one pattern.

The numbering is distributed: ranks are counted per (length, bucket of the id's hash), so a length that a third of
all pieces share is many groups. The table of runs depends on the sequence length alone, not on the corpus, and is
broadcast.

Null text is an empty text of one id, the end id. Repeated rows are documents of their own. Extra columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenorgrid.llm.common import keep, task_count
from tenorgrid.llm.tokens import coder, slices, tokenizer_path

LENGTH = 1024
BUCKET = 10_000
PIECE = "doc_id bigint, start bigint, length int, ids_crc32 bigint, doc_tokens bigint"
RUN = "run_length int, low bigint, high bigint, sequence bigint, per_sequence int, place int"


def _pieces(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                out = []
                ids, edge = coder(path).encode(batch.column(1))
                ids = ids.astype("<u4")
                for doc, first, stop in zip(batch.column(0).to_pylist(), edge[:-1].tolist(), edge[1:].tolist()):
                    for at in range(first, stop, size):
                        part = ids[at: min(at + size, stop)]
                        out.append((doc, at - first, len(part), zlib.crc32(part), stop - first))
                columns = list(zip(*out)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ``([(length, times), ...], packs)`` that place every length of the histogram.

    Longest first; each length goes one by one into the emptiest packs that have room, a whole pattern count at a
    time, and opens new packs when none has.
    """
    room: list[tuple[int, int, list[tuple[int, int]], int]] = []
    order = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if room and -room[0][0] >= length:
                space, _, pattern, packs = heapq.heappop(room)
                used = min(packs, left)
                grown = pattern[:-1] + [(length, pattern[-1][1] + 1)] if pattern[-1][0] == length else pattern + [(length, 1)]
                new = [(space + length, grown, used)] + ([(space, pattern, packs - used)] if packs > used else [])
                left -= used
            else:
                times = min(size // length, left)
                packs = left // times
                new = [(length * times - size, [(length, times)], packs)]
                left -= times * packs
            for space, pattern, packs in new:
                heapq.heappush(room, (space, order := order + 1, pattern, packs))
    return [(pattern, packs) for _, _, pattern, packs in sorted(room, key=lambda x: x[1])]


def pattern_runs(patterns: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Runs of ranks: length, first rank, rank after the last, first sequence, pieces per sequence, place of the first."""
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for pattern, packs in patterns:
        place = 0
        for length, times in pattern:
            low = used.get(length, 0)
            used[length] = low + times * packs
            runs.append((length, low, used[length], sequence, times, place))
            place += length * times
        sequence += packs
    return runs


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = keep(docs.select(F.col(id).cast("long"), F.col(text)).mapInArrow(_pieces(vocabulary or tokenizer_path(), size), PIECE))
    counted = pieces.groupBy("length").count().collect()  # at most ``size`` rows
    histogram = {r["length"]: r["count"] for r in counted}
    runs = spark.createDataFrame(pattern_runs(shortest_pack_first(histogram, size)), RUN)
    buckets = task_count(sum(histogram.values()), BUCKET)
    placed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    sums = placed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sums.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32"))
    ranked = placed.withColumn("rank", rank - 1).join(before, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("before"))
    inside = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    return ranked.join(F.broadcast(runs), inside).select(
        F.col("doc_id").alias(id), "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(nth / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("place") + (nth % F.col("per_sequence")) * F.col("length")).cast("long").alias("offset"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
