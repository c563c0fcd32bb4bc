"""Quality rules from cross-document line frequency, in DataFrame functions only.

Lines are normalised and hashed; for each host the distinct documents that hold a line are counted. Lines above the
host's limit are boilerplate: they are removed from all documents but the first that has them, and a document of
which too little is left is rejected. Besides, every document gets its base figures and is rejected if they fail.

Two decisions keep sound documents. Copies of a text are not a template, so "distinct documents" counts distinct
texts, by the hash of the whole text. And the first document of a host keeps its lines, so that no content leaves the
corpus altogether.

Null text: no words, no lines; base rules reject it. Null host: one host of its own. Repeated rows: each is judged as
a row. Other columns of the input are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorgrid.llm.common import SPACES, WORD, Sheltered, keep

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_DOCS = 30
MAX_SHARE = 0.03
MIN_LEFT = 0.3
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal_line(line: Column) -> Column:
    """Lower case A-Z, digits as 0, runs of white space as one space, trimmed."""
    plain = F.translate(line, UPPER + "123456789", LOWER + "000000000")
    return F.trim(F.regexp_replace(plain, r"[\x20\x09-\x0D]+", " "))


def ink(text: Column) -> Column:
    """Code points that are not white space."""
    return F.length(F.translate(text, SPACES, "")).cast("long")


def document_figures(docs: DataFrame, id: str, text: str, host: str) -> DataFrame:
    """One row per row of ``docs``: id, host key, base figures, hash of the text and the hashed lines with their ink."""
    one = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(host)).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    one = one.select("id", "host", "t", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("w"),
                     F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD)).alias("l"))
    one = one.select(
        "id", "host", F.size("w").cast("long").alias("n_words"), ink(F.col("t")).alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.xxhash64("t").alias("copy"),
        F.transform("l", lambda x: F.struct(F.xxhash64(normal_line(x)).alias("h"), ink(x).alias("c"))).alias("lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
    grams = F.when(F.col("n_words") >= 5, F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - 5).cast("int")),
        lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(5)]))).otherwise(F.array().cast("array<bigint>"))
    one = one.withColumn("g", grams).drop("w")
    # Only texts that repeat a window need its places.
    one = one.withColumn("s", F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array(
        F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("g")
    again = F.filter("s", lambda x, i: F.coalesce(x["h"] == F.get("s", i - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get("s", i + 1)["h"], F.lit(False)))
    one = one.withColumn("p", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("s")
    covered = F.aggregate(F.zip_with("p", F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))),
                                     lambda a, b: F.least(F.lit(5), F.coalesce(b - a, F.lit(5)))),
                          F.lit(0).cast("long"), lambda acc, x: acc + x)
    return one.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("p")


def frequent_lines(figures: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Lines of each host in more than ``min_docs`` distinct documents and more than ``max_share`` of the host's."""
    lines = figures.select("id", "host", "copy", F.explode("lines.h").alias("h"))
    per_text = lines.groupBy("host", "h", "copy").agg(F.min("id").alias("first"))
    counts = per_text.groupBy("host", "h").agg(F.count("*").alias("n"), F.min("first").alias("first"))
    hosts = (figures.select("host", "copy").groupBy("host", "copy").agg(F.lit(1).alias("one"))
             .groupBy("host").agg(F.count("*").alias("docs")))
    return (counts.where(F.col("n") > min_docs).join(hosts, "host")
            .where(F.col("n") > F.col("docs") * F.lit(max_share)).select("host", "h", "n", "first"))


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source",
          min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per row of ``docs``: its id, base figures, ``removed_chars``, ``base_failed``, ``depleted``, ``kept``."""
    figures = keep(document_figures(docs, id, text, host).withColumn("row", F.monotonically_increasing_id()))
    return verdicts(figures, frequent_lines(figures, min_docs, max_share), id, min_left)


def verdicts(figures: DataFrame, often: DataFrame, id: str = "doc_id", min_left: float = MIN_LEFT) -> DataFrame:
    """What ``judge`` returns, from figures with a ``row`` number and the frequent lines."""
    lines = figures.select("row", "id", "host", F.explode("lines").alias("l")).select("row", "id", "host", "l.h", "l.c")
    removed = (lines.join(often, ["host", "h"]).where(F.coalesce(F.col("id") != F.col("first"), F.lit(True)))
               .groupBy("row").agg(F.sum("c").alias("removed_chars")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("word_chars") - F.col("removed_chars")
    return (figures.drop("lines").join(removed, "row", "left")
            .withColumn("removed_chars", F.coalesce("removed_chars", F.lit(0).cast("long")))
            .withColumn("base_failed", failed)
            .withColumn("depleted", left < F.col("word_chars") * F.lit(min_left))
            .select(F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "removed_chars", "base_failed", "depleted", (~F.col("base_failed") & ~F.col("depleted")).alias("kept")))


def without_frequent_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source",
                           min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """``docs`` with the frequent lines taken out of ``text``; the first document of a host keeps them.

    Ids must be unique here. A null text stays null.
    """
    figures = keep(document_figures(docs, id, text, host))
    return take_out(docs, figures, frequent_lines(figures, min_docs, max_share), id, text)


def take_out(docs: DataFrame, figures: DataFrame, often: DataFrame, id: str = "doc_id", text: str = "text",
             length: str | None = None) -> DataFrame:
    """``docs`` without the lines ``often`` of their hosts in ``text``; ``length``, where it is a column, follows a text
    that changes.
    """
    bad = (figures.select("id", "host", F.explode("lines.h").alias("h")).join(often, ["host", "h"])
           .where(F.col("id") != F.col("first")).groupBy(F.col("id").alias("_id")).agg(F.collect_set("h").alias("_bad")))
    inside = Sheltered(docs)
    t = inside[text]
    kept = F.array_join(F.filter(F.split(t, "\n", -1), lambda x: ~(
        x.rlike(WORD) & F.array_contains("_bad", F.xxhash64(normal_line(x))))), "\n")
    done = inside.df.join(bad, F.col(inside[id]) == F.col("_id"), "left").withColumn("_new", F.when(F.col("_bad").isNotNull(), kept))
    if length in inside:
        n = inside[length]
        done = done.withColumn(n, F.when(F.col("_new") != F.col(t), F.length("_new").cast(docs.schema[length].dataType)).otherwise(F.col(n)))
    return inside.back(done.withColumn(t, F.coalesce("_new", F.col(t))))


def accepted(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", length: str | None = "n_chars",
             min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """The kept documents of ``judge`` with their frequent lines taken out of ``text``, from one table of figures.

    Of the documents that change, ``length`` becomes the number of characters. Rows with a null id leave.
    """
    figures = keep(document_figures(docs, id, text, host).withColumn("row", F.monotonically_increasing_id()))
    often = keep(frequent_lines(figures, min_docs, max_share))
    judged = verdicts(figures, often, id, min_left).where("kept").select(id)
    return take_out(docs.join(judged, id, "left_semi").select(docs.columns), figures, often, id, text, length)


def op9_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base figures and the verdict of the line frequencies."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def rules_sql(docs: str) -> str:
    """SQL of ``judge`` over the relation ``docs``, by counting windows and lines as rows."""
    return rf"""
    WITH src AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS rn FROM {docs}),
    toks AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM src),
    word AS (SELECT rn, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM toks),
    gram AS (SELECT rn, i, string_agg(x, ' ') OVER five AS g, count(*) OVER five AS k FROM word
             WINDOW five AS (PARTITION BY rn ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
    hit AS (SELECT rn, i FROM gram WHERE k = 5 QUALIFY count(*) OVER (PARTITION BY rn, g) > 1),
    rep AS (SELECT rn, count(DISTINCT i + d) AS n FROM hit, range(5) AS r(d) GROUP BY rn),
    line AS (SELECT rn, doc_id, source, unnest(string_split(t, chr(10))) AS l FROM toks),
    full_line AS (SELECT rn, doc_id, source, l,
                    trim(regexp_replace(translate(l, '{UPPER}123456789', '{LOWER}000000000'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS nl,
                    length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS c
                  FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
    dup AS (SELECT rn, count(*) - count(DISTINCT l) AS n FROM full_line GROUP BY rn),
    hosts AS (SELECT source, count(DISTINCT t) AS docs FROM toks GROUP BY source),
    often AS (SELECT f.source, nl, min(f.doc_id) AS first FROM full_line f JOIN toks USING (rn)
                JOIN hosts h ON h.source IS NOT DISTINCT FROM f.source
              GROUP BY f.source, nl, docs HAVING count(DISTINCT t) > {MIN_DOCS} AND count(DISTINCT t) > docs * {MAX_SHARE}),
    gone AS (SELECT rn, sum(c) AS c FROM full_line f JOIN often o ON o.source IS NOT DISTINCT FROM f.source AND o.nl = f.nl
             WHERE f.doc_id <> o.first GROUP BY rn),
    fig AS (SELECT s.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
              length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
              coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.c, 0)::BIGINT AS removed_chars
            FROM toks s LEFT JOIN rep USING (rn) LEFT JOIN dup USING (rn) LEFT JOIN gone USING (rn))
    SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
           (word_chars - removed_chars < word_chars * {MIN_LEFT}) AS depleted,
           NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
             AND NOT (word_chars - removed_chars < word_chars * {MIN_LEFT}) AS kept
    FROM fig"""


SQL = rules_sql("documents")
