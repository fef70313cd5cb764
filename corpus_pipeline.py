"""From raw documents to packed training sequences, as stages that each apply one operator.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and returns rows with
the same columns; the last returns the pieces and where they are packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.llm import lines, minhash, packing, quality, secret_scan
from tasteloom.shared import settle
from tasteloom.spread import unused


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, the count of characters brought up to date with the text."""
    size = F.length("text").cast("long").alias("n_chars")
    return docs.select(*[size if c == "n_chars" else F.col(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    (by,) = unused(docs.columns, "rejected_by")
    return quality.cascade(docs, out=by).filter(F.col(by).isNull()).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sites share (but for the first place of each)."""
    counts = unused(docs.columns, "n_lines", "n_removed")
    return _measured(lines.remove_lines(docs, counts=tuple(counts)), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8."""
    return minhash.keep_one(docs)


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    (spans,) = unused(docs.columns, "spans")
    found, _ = secret_scan.scan_history(docs, out=spans)
    clean = found.withColumn("text", secret_scan.redact(F.col("text"), F.col(spans)))
    return _measured(clean, docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("secret scans", secret_removal),
    ("best-fit packing", packing_stage),
]

# Quality rules, sketches of lines, signatures, regular expressions and token ids are beyond
# one SQL statement; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
