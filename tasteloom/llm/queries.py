"""The registered queries of this package; ``oracles`` has the SQL of those that SQL can state.

Each query applies its operator to the whole table and derives the columns of its contract.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.llm import (
    ann, bpe, clustering, licenses, lines, minhash, mixing, packing, quality, resampling, secret_scan, sharding, substrings,
)
from tasteloom.llm.oracles import ORACLE  # noqa: F401
from tasteloom.shared import settle

RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir))
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    own = F.transform("found", lambda f: f["label"])
    best = F.array_max(F.transform("found", lambda f: f["containment"]))
    starts = F.transform("places", lambda p: p["at"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(_table(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    coded = bpe.round_trip(_table(spark, sf_dir), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_lines(_table(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


def op7_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = _table(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.assign(docs, "doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base rules first; then all rules, of which the ledger leaves those that no blob has seen."""
    docs = _table(spark, sf_dir).select("doc_id", "text")
    seen = settle(secret_scan.scan_unseen(docs, None, secret_scan.BASE), "base-ledger")
    found, _ = secret_scan.scan_history(docs, seen)
    kinds = [rule.kind for rule in secret_scan.BASE]
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>"))

    def joined(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[number(kind) for kind in kinds],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir).select("doc_id", "text")
    judged = quality.cascade(docs, measured=True)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measured = judged.select("doc_id", *[F.col("measures")[c].alias(c) for c in names], F.col("rejected_by").isNull().alias("passed"))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("passed")).drop("passed")


def op10_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(_table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.scores(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, each = mixing.mix(_table(spark, sf_dir))
    return each


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_best_fit_packing, op3_minhash_near_dedup, op4_substring_dedup, op5_byte_bpe,
        op6_line_dedup, op7_ring_sharding, op8_secret_scan, op9_quality_rules, op10_one_bit_search,
        op11_centroid_clustering, op12_importance_resampling, op13_source_mixing,
    )
}
