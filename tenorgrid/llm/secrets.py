"""Secret scans with an incremental ledger of blobs.

A blob is a text under its SHA-256. Every version of every path that has the same text is one blob, scanned once for a
version of the rules: blobs that the ledger has for this version are skipped, the others are scanned and entered, with
or without findings. Findings are then joined back to all versions and paths of their blobs.

A cheap pattern, which every finding of every rule satisfies, decides in the scan of the table whether a text is
carried to the blob's row at all; blobs without it are entered as scanned and clean. Copies collapse before the
shuffle, so a text that a third of all rows share is one blob row.

Null text is the empty text. Repeated rows are versions of the same blob. Extra columns are not read. An empty table
adds nothing to the ledger.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorgrid.llm.common import Sheltered, keep, named

RULES_VERSION = 3
LEDGER = "blob string, rules_version int, spans array<struct<kind:string,start:int,end:int>>"

# A private key ends at its END line, which lies before the next BEGIN. Without one it has the headers and the base64
# block behind BEGIN: long runs, and shorter ones that fill a line. Line breaks may be written as \n in a string. A
# header fills a line and its value ends with the line, so headers are read in one way only, without going back.
_B64, _BREAK, _GAP = r"[A-Za-z0-9+/]", r"(?:\r?\n|\r|(?:\\r)?\\n)", r"(?:[\s>\"',]|\\[nr])++"
_HEADER = rf"{_BREAK}[\x20\t>\"']*+[A-Za-z-]++:\x20[^\r\n\\]*+"
PRIVATE_KEY = (
    r"-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z0-9 ]{0,30}PRIVATE KEY-----"
    rf"|(?:(?:{_HEADER})++(?={_GAP}{_B64}{{16}}))?"
    rf"(?:{_GAP}{_B64}{{24,}}+={{0,2}}|{_BREAK}[\x20\t>\"']*+{_B64}++={{0,2}}(?=[\x20\t\"',;]*(?:{_BREAK}|\Z)))*+)")

# The rules, in the order of their listing. The first three are the base rules; a match of `assign`
# counts with 12 or more characters in group 2. The others are the published shapes of common credentials.
RULES: list[tuple[str, re.Pattern]] = [
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)),
    ("access", re.compile(r"AKIA[A-Z0-9]{14,}")),
    ("hex", re.compile(r"[0-9a-f]{16,}")),
    ("private_key", re.compile(PRIVATE_KEY)),
    ("github", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", re.compile(r"xox[abeoprs]-[A-Za-z0-9-]{10,}")),
    ("google", re.compile(r"AIza[A-Za-z0-9_-]{35}")),
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
]
BASE = ("assign", "access", "hex")
ORDER = {kind: k for k, (kind, _) in enumerate(RULES)}
ASSIGN_LEAST = 12
# Holds for every text with a finding.
SCREEN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
          r"|AKIA[A-Z0-9]{14}|[0-9a-f]{16}|-----BEGIN |gh[pousr]_|xox[abeoprs]-|AIza|eyJ")


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans ``(kind, start, end)`` in code points, by start, then in the rules' order; leftmost per kind."""
    spans = [(kind, m.start(), m.end()) for kind, rule in RULES for m in rule.finditer(text)
             if kind != "assign" or m.end(2) - m.start(2) >= ASSIGN_LEAST]
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t or "")] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([RULES_VERSION] * len(batch), pa.int32()), pa.array(spans, kind)],
            names=["blob", "rules_version", "spans"])


def blob_of(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _screened(versions: DataFrame, text: str) -> DataFrame:
    """Blob of every row, and its text where the screen lets it pass."""
    return versions.select(blob_of(text).alias("blob"), F.when(F.col(text).rlike(SCREEN), F.col(text)).alias("text"))


def _unseen(screened: DataFrame, ledger: DataFrame | None) -> DataFrame:
    blobs = screened.groupBy("blob").agg(F.max("text").alias("text"))
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rules_version") == RULES_VERSION).select("blob"), "blob", "left_anti")
    return blobs.mapInArrow(_scan, LEDGER)


def update_ledger(versions: DataFrame, text: str = "text", ledger: DataFrame | None = None) -> DataFrame:
    """Ledger rows for the blobs of ``versions`` that ``ledger`` does not have under the present rules."""
    return _unseen(_screened(versions, text), ledger)


def _present(entries: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The rows of both under the present rules, one for a blob."""
    if ledger is None:
        return entries
    return entries.union(ledger.where(F.col("rules_version") == RULES_VERSION).select(entries.columns).dropDuplicates(["blob"]))


def findings(versions: DataFrame, keys: list[str], ledger: DataFrame, text: str = "text") -> DataFrame:
    """Keys, blob and spans of every row of ``versions``, from a ledger that has all of their blobs."""
    with_spans = ledger.where(F.size("spans") > 0).select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans"))
    rows = versions.select(*map(named, keys), blob_of(text).alias("_of"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return rows.join(with_spans, F.col("_of") == F.col("_blob"), "left").select(
        *map(named, keys), F.col("_of").alias("blob"), F.coalesce("_spans", none).alias("spans"))


def scan(versions: DataFrame, keys: list[str], text: str = "text", ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(findings, entries)``: keys, blob and spans of every row of ``versions``; the rows to add to the ledger.

    ``keys`` must not be called ``blob``, ``spans``, ``_of``, ``_blob`` or ``_spans``.
    """
    taken = {"blob", "spans", "_of", "_blob", "_spans"} & set(keys)
    if taken:
        raise ValueError(f"rename the key columns {sorted(taken)}")
    entries = keep(update_ledger(versions, text, ledger))
    return findings(versions, keys, _present(entries, ledger), text), entries


def scan_in_steps(versions: DataFrame, keys: list[str], step: Column, steps: int, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(findings, ledger)`` of versions that arrive one step (0, 1, ... of ``steps``) after the other.

    Each step reads the ledger that the steps before wrote, scans the blobs that it does not have and enters them; at
    the end the findings are joined back to the rows of all steps.
    """
    ledger = None
    for k in range(steps):
        _, entries = scan(versions.where(step == k), keys, text, ledger)
        ledger = entries if ledger is None else ledger.union(entries)
    return findings(versions, keys, ledger, text), ledger


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            out, at = [], 0
            for s in spans:
                if s["end"] > at:
                    out += [text[at: max(at, s["start"])], "[secret]" if s["start"] >= at else ""]
                    at = s["end"]
            texts.append("".join(out) + text[at:])
        yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(texts, pa.string())], names=["blob", "clean"])


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars", ledger: DataFrame | None = None) -> DataFrame:
    """``docs`` with every found span replaced by ``[secret]``; other texts and all other columns stay as they are, but
    for ``length``, where it is a column: it becomes the number of characters of a text that changes.

    Every text is hashed and screened once into a table that has only the texts with a possible finding.
    """
    inside = Sheltered(docs)
    t = inside[text]
    screened = keep(_screened(inside.df, t))
    entries = keep(_unseen(screened, ledger))
    dirty = _present(entries, ledger).where(F.size("spans") > 0).select("blob", "spans")
    once = screened.where(F.col("text").isNotNull()).groupBy("blob").agg(F.max("text").alias("t"))
    clean = keep(once.join(dirty, "blob").select("t", "spans", "blob").mapInArrow(_hide, "blob string, clean string"))
    done = inside.df.join(clean, blob_of(t) == F.col("blob"), "left")
    if length in inside:
        n = inside[length]
        done = done.withColumn(n, F.when(F.col("clean").isNotNull(), F.length("clean").cast(docs.schema[length].dataType)).otherwise(F.col(n)))
    return inside.back(done.withColumn(t, F.coalesce("clean", F.col(t))))


STEPS = 3


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of every document; the sources arrive in ``STEPS`` steps, each scanned against the ledger so far."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found, _ = scan_in_steps(docs, ["doc_id"], F.pmod(F.xxhash64("source"), F.lit(STEPS)), STEPS)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(spans_text(base), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))
