"""Near-duplicate documents by b-bit MinHash.

Each document's distinct word shingles give ``N_MIN`` minima. Bands of minima propose candidates; the two low bits of
every minimum, packed into longs, estimate the similarity by bit counts, corrected for chance collisions; candidates
whose estimate is not far below the limit are confirmed on the full shingle sets.

Large groups cost no pair lists. Documents with equal sets are one class with one representative. In a bucket each
member is first compared with the bucket's most connected member only; components of the confirmed links are formed;
what is left are members of one bucket in different components. Those get a finer signature and are compared in full,
in blocks of bounded size, so no link between components is lost, and pairs inside a component are never formed.

With 32 bands of 4 minima a pair at similarity 0.8 shares no band with probability 5e-8; an estimate falls below the
candidate limit, 4.5 standard deviations under the similarity, with probability 4e-6.

Null, empty and blank texts have no shingles and link with nothing. A text of fewer words than a shingle is one
shingle. Repeated rows are copies. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorgrid.llm.common import keep, maybe_in
from tenorgrid.llm.components import components
from tenorgrid.llm.words import grams, mix, words

N_MIN, BITS, BANDS, ROWS = 256, 2, 32, 4
LONGS = N_MIN * BITS // 64
FINE_MIN = 2048  # of one bit each
FINE_LONGS = FINE_MIN // 64
BLOCK = 256
SIGNATURE = "id bigint, n_shingles bigint, set_hi bigint, set_lo bigint, " + ", ".join(
    f"s{k} bigint" for k in range(LONGS)) + ", bands array<bigint>"


def shingles(value: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles of one document's word hashes."""
    return np.unique(grams(value, width))


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (draw[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (draw[n:] >> np.uint64(32)).astype(np.uint32)


def minima(sets: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 1024) -> np.ndarray:
    """One minimum per multiplier of one set, in blocks that stay in the processor's cache."""
    low = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), np.uint32(0xFFFFFFFF))
    for at in range(0, len(low), block):
        part = low[at: at + block]
        out = np.minimum(out, (a[:, None] * part[None, :] + b[:, None]).min(axis=1))
    return _finish(out)


def _finish(x: np.ndarray) -> np.ndarray:
    """Spread the minima, whose own low bits are those of small numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x45D9F3B)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x45D9F3B)
    return x ^ (x >> np.uint32(16))


def _packed(minimum: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of all minima in longs."""
    low = ((minimum[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
    return np.packbits(low.reshape(-1), bitorder="little").view(np.int64)


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _seeds(N_MIN)
        tens = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for batch in batches:
            ids, counts, high, low, packed, bands = batch.column(0), [], [], [], [], []
            for run in words(batch.column(1), lower=True):
                for r in range(len(run.ptr) - 1):
                    found = shingles(run.hash[run.ptr[r]: run.ptr[r + 1]], width)
                    counts.append(len(found))
                    digest = xxhash.xxh3_128_intdigest(found.tobytes())
                    high.append(digest >> 64)
                    low.append(digest & 0xFFFFFFFFFFFFFFFF)
                    if len(found):
                        m = minima(found, a, b)
                        packed.append(_packed(m, BITS))
                        key = tens.copy()
                        for col in m[: BANDS * ROWS].reshape(BANDS, ROWS).T:
                            key = mix(key ^ col)
                        bands.append(key.view(np.int64))
                    else:
                        packed.append(np.zeros(LONGS, np.int64))
                        bands.append(np.zeros(0, np.int64))
            sig = np.stack(packed) if packed else np.zeros((0, LONGS), np.int64)
            places = np.concatenate([[0], np.cumsum([len(x) for x in bands])]).astype(np.int32)
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(np.array(high, np.uint64).view(np.int64)),
                 pa.array(np.array(low, np.uint64).view(np.int64)), *(pa.array(sig[:, k]) for k in range(LONGS)),
                 pa.ListArray.from_arrays(pa.array(places), pa.array(flat))],
                names=["id", "n_shingles", "set_hi", "set_lo", *(f"s{k}" for k in range(LONGS)), "bands"])
    return run


def signatures(docs: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """Per document: id, size and 128-bit hash of its shingle set, packed low bits and band keys."""
    return docs.select(F.col(id).cast("long"), F.col(text)).mapInArrow(_signatures(width), SIGNATURE)


def _fine(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _seeds(FINE_MIN)
        for batch in batches:
            packed = [_packed(minima(shingles(run.hash[run.ptr[r]: run.ptr[r + 1]], width), a, b, 128), 1)
                      for run in words(batch.column(1), lower=True) for r in range(len(run.ptr) - 1)]
            sig = np.stack(packed) if packed else np.zeros((0, FINE_LONGS), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(sig[:, k]) for k in range(FINE_LONGS))],
                                             names=["id", *(f"s{k}" for k in range(FINE_LONGS))])
    return run


def estimate(left: str, right: str, longs: int = LONGS, bits: int = BITS) -> Column:
    """Similarity from packed bits: equal groups of bits, less those that agree by chance."""
    odd = F.lit(0)
    for k in range(longs):
        x = F.col(f"{left}.s{k}").bitwiseXOR(F.col(f"{right}.s{k}"))
        if bits == 2:
            x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        odd = odd + F.bit_count(x)
    chance = 0.5 ** bits
    return ((F.lit(1.0) - odd / F.lit(64.0 * longs / bits)) - chance) / (1 - chance)


def candidate_limit(percent: int, n: int = N_MIN, bits: int = BITS) -> float:
    chance = 0.5 ** bits
    match = chance + (1 - chance) * percent / 100
    return percent / 100 - 4.5 * (match * (1 - match) / n) ** 0.5 / (1 - chance)


def _confirm(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for column in (batch.column(2), batch.column(3)):
                found = []
                last = text = None
                for i in range(len(column)):  # rows of one representative come together
                    if last is None or column[i] != text:
                        text = column[i]
                        last = shingles(next(words(column.slice(i, 1), lower=True)).hash, width)
                    found.append(last)
                sets.append(found)
            good = []
            for x, y in zip(*sets):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are alike enough."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(width, percent), "a bigint, b bigint")


def _likely(pairs: DataFrame, sigs: DataFrame, limit: float) -> DataFrame:
    cols = [F.col(f"s{k}") for k in range(LONGS)]
    one = sigs.select("id", F.struct(*cols).alias("x"))
    return (pairs.join(one.select(F.col("id").alias("a"), F.col("x").alias("x")), "a")
            .join(one.select(F.col("id").alias("b"), F.col("x").alias("y")), "b")
            .where(estimate("x", "y") >= limit).select("a", "b"))


def _first_pairs(shared: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's most connected member."""
    weight = shared.groupBy("id").agg(F.sum("n").alias("w"))
    hub = (shared.join(weight, "id").groupBy("key")
           .agg(F.max(F.struct("w", (-F.col("id")).alias("low"))).alias("top"))
           .select("key", (-F.col("top.low")).alias("hub")))
    return (shared.join(hub, "key").where("id != hub")
            .select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct())


def _open_buckets(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets in which some pair has not been compared and spans two components."""
    placed = (shared.where("n > 2").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")))
    parts = placed.groupBy("key", "root").agg(F.count("*").alias("m"))
    buckets = (parts.groupBy("key").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("all"), F.count("*").alias("k"))
               .where("k > 1").select("key", F.col("top.root").alias("main"),
                                      F.ceil(F.col("all") / BLOCK).cast("int").alias("n_all"),
                                      F.ceil((F.col("all") - F.col("top.m")) / BLOCK).cast("int").alias("n_rest")))
    return placed.join(buckets, "key").select("key", "id", "root", "main", "n_all", "n_rest")


def _left_pairs(members: DataFrame, fine: DataFrame, bands: DataFrame, limit: float) -> DataFrame:
    """Likely pairs of one bucket in different components, formed block by block, each in its first common bucket."""
    cols = [F.col(f"s{k}") for k in range(FINE_LONGS)]
    rows = members.join(fine.join(bands, "id").select("id", F.struct(*cols, "bands").alias("x")), "id")
    alike = ((estimate("x", "y", FINE_LONGS, 1) >= limit)
             & (F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("rest.key")))

    def place(n: str, salt: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")

    whole = rows.select("key", place("n_all", 1).alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_rest") - 1)).alias("j"),
                        F.col("id").alias("b"), F.col("root").alias("root_b"), F.col("x").alias("y"))
    rest = rows.where("root != main").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)).alias("i"), place("n_rest", 2).alias("j"),
        F.col("id").alias("a"), F.col("root").alias("root_a"), "x")
    rest, whole = rest.alias("rest"), whole.alias("whole")
    return (rest.join(whole, (F.col("rest.key") == F.col("whole.key")) & (F.col("rest.i") == F.col("whole.i")) & (F.col("rest.j") == F.col("whole.j"))
                      & (F.col("root_a") != F.col("root_b")) & alike)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept; see the module's text."""
    sigs = keep(signatures(docs, id, text, width))
    sets = ["set_hi", "set_lo"]
    classes = sigs.where("n_shingles > 0").groupBy(*sets).agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = keep(classes)
    reps = sigs.join(classes.select(F.col("rep").alias("id")), "id", "left_semi").where("n_shingles > 0").dropDuplicates(["id"])
    band = reps.select("id", F.explode("bands").alias("key"))
    sizes = band.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keep(band.join(sizes, "key"))
    bits = keep(reps.drop("n_shingles", *sets).join(shared.select("id").distinct(), "id", "left_semi"))
    first = keep(_likely(_first_pairs(shared), bits, candidate_limit(percent)))
    every = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))

    def texts(ids: DataFrame) -> DataFrame:
        thin = maybe_in(every, F.col("id"), ids, "id")
        return keep(thin.join(ids.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id")).drop("_id").dropDuplicates(["id"]))

    ends = keep(first.select(F.col("a").alias("id")).union(first.select(F.col("b").alias("id"))).distinct())
    links = keep(confirmed(first, texts(ends), width, percent))
    roots = keep(components(links))
    members = keep(_open_buckets(shared, roots))
    some = texts(keep(members.select("id").distinct()))
    fine = keep(some.mapInArrow(_fine(width), "id bigint, " + ", ".join(f"s{k} bigint" for k in range(FINE_LONGS))))
    left = _left_pairs(members, fine, bits.select("id", "bands"), candidate_limit(percent, FINE_MIN, 1))
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = keep(left.join(done, ["a", "b"], "left_anti"))
    more = keep(confirmed(left, some, width, percent))
    roots = components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).union(more))
    named = classes.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select(
        *sets, F.coalesce("root", "rep").alias("component_id"))
    return (sigs.select("id", "n_shingles", *sets).join(named, sets, "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id")))
            .select(F.col("id").alias(id), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept")))


def op3_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents over four-word shingles at 80 percent."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=4)


SQL = r"""
WITH RECURSIVE tok AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM tok),
win AS (SELECT doc_id, n, i, string_agg(x, ' ') OVER p AS g FROM word
        WINDOW p AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
shingle AS (SELECT DISTINCT doc_id, g FROM win WHERE i <= greatest(1, n - 3)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * pair.n >= 80 * (x.n + y.n - pair.n)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
root AS (SELECT a, min(b) AS r FROM reach GROUP BY 1)
SELECT tok.doc_id, coalesce(size.n, 0) AS n_shingles, least(tok.doc_id, coalesce(r, tok.doc_id)) AS component_id, tok.doc_id <= coalesce(r, tok.doc_id) AS kept
FROM tok LEFT JOIN size USING (doc_id) LEFT JOIN root ON root.a = tok.doc_id
"""
