"""Removal of word passages that occur more than once in a corpus, by FM-indexes of routed shards.

A window is ``width`` consecutive words of one document. Searching every document in an index of every other would
grow with the square of the corpus, so windows are first routed: a window belongs to the smallest hash of its
``anchor``-word runs, and neighbouring windows of one anchor form a segment. Equal windows have the same anchor, so
only anchors that occur twice can hold repeated windows; their segments, equal ones once with a multiplicity, go to
the anchor's shard. Each shard builds an FM-index of its segments over a wavelet matrix and takes the matching
statistics of the segments it is streamed by backward search; windows whose interval has two or more suffixes, or
whose segment has a multiplicity, are repeated. The hits return to their documents, which drop the covered words.

An anchor with many occurrences (a passage in a large part of the corpus, with other words around it) would fill one
shard. Above ``HOT`` occurrences the anchor's windows are routed one by one by the hash of the whole window: equal
windows collapse to one row before the shuffle, unequal ones spread over all shards.

Words are told apart by 64-bit hashes. Null, empty and short texts have no window and lose nothing. Repeated rows are
copies and lose their windows like other copies. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorgrid.llm.common import keep, maybe_in, task_count
from tenorgrid.llm.fm_index import repeated_windows
from tenorgrid.llm.words import Words, grams, words

WIDTH, ANCHOR = 35, 16
HOT = 2048
SHARD = 4096
SEEN = 50_000


def anchors(run: Words, width: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Segments of all rows of a run: row, first window (word in the row), number of windows, key."""
    n = len(run.hash)
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none
    gram = grams(run.hash, anchor)
    spread = width - anchor + 1
    view = np.lib.stride_tricks.sliding_window_view(gram, spread)
    row = np.repeat(np.arange(len(run.ptr) - 1), np.diff(run.ptr))
    starts = np.arange(n - width + 1)
    starts = starts[row[: n - width + 1] == row[width - 1:]]
    if not len(starts):
        return none, none, none, none
    place = np.empty(len(starts), np.int64)
    for at in range(0, len(starts), 1 << 16):
        part = starts[at: at + (1 << 16)]
        place[at: at + (1 << 16)] = part + view[part].argmin(axis=1)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(starts)))
    owner = row[starts[first]]
    return owner, starts[first] - run.ptr[owner], count, gram[place[first]].view(np.int64)


def _joined(text: str | None) -> tuple[int, str]:
    parts = (text or "").encode().split()
    return len(parts), hashlib.sha256(b" ".join(parts)).hexdigest()


def _scan(width: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(2), []
            for part in words(texts):
                owner, first, count, key = anchors(part, width, anchor)
                lists.append((np.bincount(owner, minlength=len(part.ptr) - 1), first, count, key))
            per_row = np.concatenate([x[0] for x in lists]) if lists else np.zeros(0, np.int64)
            at = pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32))

            def column(k: int, kind: type) -> pa.Array:
                flat = np.concatenate([x[k] for x in lists]) if lists else np.zeros(0, np.int64)
                return pa.ListArray.from_arrays(at, pa.array(flat.astype(kind)))

            figures = [_joined(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in figures], pa.int64()),
                 pa.array([x[1] for x in figures], pa.string()), column(1, np.int32), column(2, np.int32), column(3, np.int64)],
                names=["id", "rid", "n_words", "whole_sha256", "first", "count", "key"])
    return run


def _segments(width: int):
    """Documents with their repeated anchors to segment rows; a content is written when a task meets it first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rids, found, weights = batch.column(0), batch.column(2), batch.column(3).to_pylist()
            out: dict[str, list] = {k: [] for k in ("rid", "rows", "first", "count", "key", "seg", "content")}
            for part in words(batch.column(1)):
                for r in range(len(part.ptr) - 1):
                    value = part.hash[part.ptr[r]: part.ptr[r + 1]]
                    rid = rids[part.first + r].as_py()
                    for a in found[part.first + r].as_py():
                        for first, count in ([(a["first"] + k, 1) for k in range(a["count"])] if a["hot"] else [(a["first"], a["count"])]):
                            content = value[first: first + count + width - 1].tobytes()
                            seg = xxhash.xxh3_64_intdigest(content)
                            new = seg not in seen
                            if new:
                                if len(seen) >= SEEN:
                                    seen.clear()
                                seen.add(seg)
                            seg -= 1 << 63
                            out["rid"].append(rid)
                            out["rows"].append(weights[part.first + r])
                            out["first"].append(first)
                            out["count"].append(count)
                            out["key"].append(seg if a["hot"] else a["key"])
                            out["seg"].append(seg)
                            out["content"].append(content if new else None)
                if len(out["rid"]) > 20_000:
                    yield _rows(out)
                    out = {k: [] for k in out}
            yield _rows(out)
    return run


SEGMENT = "rid bigint, rows bigint, first int, count int, key bigint, seg bigint, content binary"


def _rows(out: dict[str, list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def _search(width: int):
    """A shard: one row per segment with its copies, and its content from every task that has met it."""
    def run(table: pa.Table) -> pa.Table:
        bare = table.column("content").is_null().to_numpy()
        seg, copies = table.column("seg").to_numpy(), table.column("copies").to_numpy()
        order = np.argsort(seg[bare])
        full = table.filter(pa.array(~bare))
        _, first = np.unique(full.column("seg").to_numpy(), return_index=True)
        full = full.take(pa.array(first))
        times = copies[bare][order][np.searchsorted(seg[bare][order], full.column("seg").to_numpy())]
        flat = np.frombuffer(b"".join(c.as_buffer() for c in full.column("content").combine_chunks()), dtype=np.uint64)
        count = full.column("count").to_numpy().astype(np.int64)
        start = np.concatenate([[0], np.cumsum(count + width - 1)[:-1]])
        mask = repeated_windows(flat, start, count, width)
        mask = np.where(times > 1, (np.int64(1) << count) - 1, mask)
        return pa.table({"key": full.column("key"), "seg": full.column("seg"), "hits": pa.array(mask)}).filter(pa.array(mask != 0))
    return run


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, digests, texts = [], [], []
            for rid, text, hits in zip(*(batch.column(k) for k in range(3))):
                parts = text.as_py().encode().split()
                edge = np.zeros(len(parts) + 1, np.int64)
                for h in hits.as_py():
                    w = h["first"] + np.flatnonzero((h["hits"] >> np.arange(62)) & 1)
                    np.add.at(edge, w, 1)
                    np.add.at(edge, w + width, -1)
                covered = np.cumsum(edge[:-1]) > 0
                left = b" ".join([p for p, c in zip(parts, covered.tolist()) if not c])
                gone.append(int(covered.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                texts.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                names=["rid", "n_removed", "kept_sha256", "kept_text"])
    return run


def repeated_hits(docs: DataFrame, scan: DataFrame, width: int) -> DataFrame:
    """``(rid, hits)``: of each document with repeated windows, its segments' first window and mask of repeated ones."""
    each = scan.select("rid", F.explode(F.arrays_zip("key", "first", "count")).alias("a")).select(
        "rid", "a.key", "a.first", "a.count")
    keys = keep(each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", (F.col("n") > HOT).alias("hot")))
    mine = (maybe_in(each, F.col("key"), keys, "key").join(keys, "key")
            .groupBy("rid").agg(F.collect_set(F.struct("first", "count", "key", "hot")).alias("found")))
    mine = keep(mine)
    text = maybe_in(docs.select("rid", "text"), F.col("rid"), mine, "rid")
    once = text.groupBy("rid").agg(F.max("text").alias("text"), F.count("*").alias("rows"))
    segments = keep(once.join(mine, "rid").select("rid", "text", "found", "rows").mapInArrow(_segments(width), SEGMENT))
    copies = keep(segments.groupBy("key", "seg").agg(F.sum("rows").alias("copies")))
    shards = task_count(copies.count(), SHARD)
    rows = copies.select("key", "seg", "copies", F.lit(0).alias("count"), F.lit(None).cast("binary").alias("content")).union(
        segments.where(F.col("content").isNotNull()).select("key", "seg", F.lit(0).cast("long"), "count", "content"))
    hits = keep(rows.groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
                .applyInArrow(_search(width), "key bigint, seg bigint, hits bigint"))
    return (segments.select("rid", "first", "key", "seg").join(hits, ["key", "seg"])
            .groupBy("rid").agg(F.collect_list(F.struct("first", "hits")).alias("hits")))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256, and kept_text where words were removed.

    ``kept_text`` is the kept words joined by one space; null means that the text is left as it is. The windows around an
    anchor are counted in the bits of one number, so ``width - anchor`` is at most 61.
    """
    if not 0 < anchor <= width <= anchor + 61:
        raise ValueError("the anchor must have from width - 61 to width words")
    named = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).withColumn("rid", F.xxhash64("id", "text"))
    scan = keep(named.select("id", "rid", "text").mapInArrow(
        _scan(width, anchor), "id bigint, rid bigint, n_words bigint, whole_sha256 string, first array<int>, count array<int>, key array<bigint>"))
    hits = keep(repeated_hits(named, scan, width))
    texts = maybe_in(named.select("rid", "text"), F.col("rid"), hits, "rid").dropDuplicates(["rid"])
    cut = texts.join(hits, "rid").select("rid", "text", "hits").mapInArrow(
        _cut(width), "rid bigint, n_removed bigint, kept_sha256 string, kept_text string")
    return scan.select("id", "rid", "n_words", "whole_sha256").join(cut, "rid", "left").select(
        F.col("id").alias(id), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"), "kept_text")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number of words lost to 35-word windows that occur again, and the digest of the rest."""
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept_text")


SQL = rf"""
WITH tok AS (SELECT doc_id, row_number() OVER () AS rn, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (SELECT rn, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM tok),
win AS (SELECT rn, i, md5(string_agg(x, ' ') OVER p) AS g, count(*) OVER p AS k FROM word
        WINDOW p AS (PARTITION BY rn ORDER BY i ROWS BETWEEN CURRENT ROW AND {WIDTH - 1} FOLLOWING)),
hit AS (SELECT rn, i FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM win WHERE k = {WIDTH}) WHERE n > 1),
left_over AS (SELECT word.rn, word.i, x, coalesce(word.i - hit.i < {WIDTH}, FALSE) AS gone FROM word ASOF LEFT JOIN hit ON word.rn = hit.rn AND word.i >= hit.i),
kept AS (SELECT rn, count_if(gone) AS n, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (NOT gone), '') AS t FROM left_over GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM tok LEFT JOIN kept USING (rn)
"""
