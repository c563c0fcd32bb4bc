"""Mixing sources to target weights by entropy balancing.

Every word of a document is a unit whose rate may move away from the document's base rate, at the cost of the bounded
relative entropy between both; the words taken from each source must reach its target. The dual of this problem is
convex, one multiplier per source, and its solution tilts every document's rate exponentially by its source's
multiplier, held below ``cap``:  rate = cap * b * e^m / (cap - b + b * e^m).  Newton steps find the multipliers: each
is one distributed sum of the constraint and its derivative over cells of equal (source, base rate).

Rates become copies: the whole part of a rate is taken for sure; of the documents of a source in a keyed random order
(order sampling, so that a larger fraction comes first more often) so many get one more copy that the source's words
reach the target; the document at the edge gives only its first words. Running sums are distributed over buckets of
the order, so a source that holds a third of all rows is many groups. Sums are exact decimals, so reruns agree.

Null text has no words; such documents take part with size 0. The null source is a source, the last. Repeated rows
are documents of their own. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenorgrid.llm.common import WORD, Sheltered, keep, task_count

CAP = 2.0
WEIGHTS = (3, 1, 2)
SHARE = 1.5
BUCKET = 10_000
STEPS, TOLERANCE = 60, 1e-12
EXACT = "decimal(38,12)"


def words_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def weighted_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Targets per source from ``(source, source_size)``: ``share`` of all words by weight, none above ``cap`` sizes.

    What a capped source leaves goes to the others by weight. With sources in the order of size per weight the capped
    ones are a prefix, and the level of the others follows from running sums.
    """
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (at % len(weights) + 1).cast("int"))
    every = sizes.withColumn("weight", pick)
    ratio = F.col("source_size") * F.lit(cap) / F.col("weight")
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(cap))
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    placed = every.withColumn("ratio", ratio).withColumn("level", level)
    # The first source that the level leaves below its cap sets the level of all that follow.
    found = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(whole)["level"]
    target = F.least(F.col("source_size") * F.lit(cap), F.coalesce(F.col("weight") * found, F.col("source_size") * F.lit(cap)))
    return placed.select("source", "source_size", "weight", target.alias("target"))


def _rate(cap: float) -> Column:
    tilt = F.col("base") * F.exp("multiplier")
    return F.when(F.col("full"), F.lit(cap)).otherwise(F.lit(cap) * tilt / (F.lit(cap) - F.col("base") + tilt))


def balance(cells: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """Multiplier per source: ``(source, full, multiplier)``; ``full`` sources are taken ``cap`` times whole.

    ``cells`` has source, base (a rate above 0 and below ``cap``) and size.
    """
    spark = cells.sparkSession
    wanted = targets.select(F.col("source").alias("s"), "target", (F.col("target") >= F.col("source_size") * F.lit(cap)).alias("full"))
    now = keep(wanted.withColumn("multiplier", F.lit(0.0)))
    for _ in range(STEPS):
        rate = _rate(cap)
        sums = (cells.join(now, F.col("source").eqNullSafe(F.col("s")))
                .groupBy("s", "target", "full", "multiplier")
                .agg(F.sum((F.col("size") * rate).cast(EXACT)).cast("double").alias("got"),
                     F.sum((F.col("size") * rate * (1 - rate / F.lit(cap))).cast(EXACT)).cast("double").alias("slope")))
        gap = F.col("got") - F.col("target")
        step = F.when(F.col("full") | (F.col("slope") <= 0), F.lit(0.0)).otherwise(
            F.least(F.greatest(gap / F.col("slope"), F.lit(-2.0)), F.lit(2.0)))
        done = F.col("full") | (F.abs(gap) <= F.lit(TOLERANCE) * F.greatest("target", F.lit(1.0))) | (F.col("slope") <= 0)
        moved = keep(sums.select("s", "target", "full", (F.col("multiplier") - step).alias("multiplier"), done.alias("done")))
        open_ = moved.where(~F.col("done")).limit(1).count()
        now = moved.drop("done")
        if not open_:
            break
    return now.select(F.col("s").alias("source"), "full", "multiplier")


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
        share: float = SHARE, cap: float = CAP, base: Column | None = None, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, rate, taken; ``base`` is a column of base rates."""
    sized = keep(docs.select(F.col(id).cast("long").alias("id"), F.col(source).alias("source"), words_of(text).alias("size"),
                             (F.lit(1.0) if base is None else base).cast("double").alias("base")))
    cells = keep(sized.groupBy("source", "base").agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    targets = keep(weighted_targets(cells.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap))
    multipliers = balance(cells, targets, cap)
    per_source = keep(targets.join(multipliers.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
                      .select(F.xxhash64("source", F.col("source").isNull()).alias("key"), "source_size", "target", "full", "multiplier"))
    rows = cells.agg(F.sum("n")).first()[0] or 0
    rated = (sized.withColumn("key", F.xxhash64("source", F.col("source").isNull())).join(per_source, "key")
             .withColumn("rate", F.round(_rate(cap), 12)).withColumn("sure", F.floor("rate"))
             .withColumn("part", F.col("rate") - F.col("sure")))
    u = (F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    odds = u / (1 - u) * (1 - F.col("part")) / F.col("part")
    rated = rated.withColumn("order", F.when(F.col("part") > 0, odds / (1 + odds)).otherwise(F.lit(1.0)))
    buckets = task_count(rows, BUCKET)
    rated = rated.withColumn("bucket", F.least(F.floor(F.col("order") * buckets), F.lit(buckets)))
    sums = (rated.groupBy("key", "bucket").agg(F.sum(F.when(F.col("part") > 0, F.col("size")).otherwise(0)).alias("n"),
                                               F.sum(F.col("sure") * F.col("size")).alias("sure_words")))
    by_source = Window.partitionBy("key")
    before = sums.select("key", "bucket", (F.sum("n").over(by_source.orderBy("bucket")) - F.col("n")).alias("before"),
                         F.sum("sure_words").over(by_source).alias("sure_words"))
    inside = Window.partitionBy("key", "bucket").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    mine = F.when(F.col("part") > 0, F.col("size")).otherwise(F.lit(0))
    room = (F.round("target").cast("long") - F.col("sure_words") - F.col("before") - F.col("earlier"))
    extra = F.greatest(F.lit(0), F.least(mine, room))
    return (rated.withColumn("earlier", F.coalesce(F.sum(mine).over(inside), F.lit(0))).join(before, ["key", "bucket"])
            .select(F.col("id").alias(id), "size", "source_size", "target", "rate",
                    (F.col("sure") * F.col("size") + extra).cast("long").alias("taken")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to their sources' targets."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", length: str | None = "n_chars", **settings) -> DataFrame:
    """The mix itself, in the columns of ``docs``: whole copies as repeated rows, then the first words of a cut document.

    Ids must be unique; documents without words, or with a null id, are not in the mix. ``length``, where it is a
    column, follows the text of a cut document.
    """
    taken = mix(docs, id, text, **settings).where("taken > 0").select(
        F.col(id).alias("_id"), F.floor(F.col("taken") / F.col("size")).alias("_whole"), (F.col("taken") % F.col("size")).alias("_left"))
    inside = Sheltered(docs)
    t, copies, left = inside[text], F.col("_whole"), F.col("_left")
    rows = inside.df.join(taken, F.col(inside[id]) == F.col("_id")).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies + (left > 0).cast("long"))))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(t), F.lit(WORD), F.lit(0)), F.lit(1), left.cast("int")), " ")
    rows = rows.withColumn("_cut", F.when(F.col("_copy") > copies, cut))
    if length in inside:
        n = inside[length]
        rows = rows.withColumn(n, F.when(F.col("_cut").isNotNull(), F.length("_cut").cast(docs.schema[length].dataType)).otherwise(F.col(n)))
    return inside.back(rows.withColumn(t, F.coalesce("_cut", F.col(t))))
