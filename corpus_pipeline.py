"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents``, further ones included, whatever they are called; where a stage
changes a text, ``n_chars`` follows. Rows with a null id cannot be decided on and leave in the first stage, as do null
and empty texts, which have fewer words than the rules ask for. Texts are taken whole, however long. Ids are taken to be
unique apart from repeated rows, of which the second stage keeps one; of equal texts the smallest id stays. A null source is
a source. An empty table gives no rows in any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenorgrid.llm import line_frequency, minhash, mixing, packing, secrets
from tenorgrid.llm.common import keep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line frequencies accept, without the frequent lines of their hosts."""
    return line_frequency.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate group over five-word shingles at 80 percent."""
    kept = minhash.near_duplicates(docs, width=5, percent=80).where("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the found secrets replaced."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def packing_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("packing", packing_),
]

# Near-duplicate classes, the mix and the tokenizer need code; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = keep(docs)
    return docs
