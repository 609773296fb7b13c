"""The registered queries of this folder: each applies its operator to its whole table and
derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    decontamination,
    exact_dedup,
    hard_negatives,
    licenses,
    line_dedup,
    near_dedup,
    ngram_join,
    packing,
    pii,
    resampling,
    sharding,
    toxicity,
    warc,
)
from .license_texts import LICENSES
from .token_ids import Vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

VOCABULARY = Vocabulary(
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


SHARDS = 40


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents in sequences of 1,024 tokens."""
    pieces = packing.pack(_table(spark, sf, "documents"), VOCABULARY)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    """All pages as WARC records, read back from the archives."""
    records = warc.read_archives(warc.write_archives(_table(spark, sf, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in 40 shards of equal weight by rendezvous hashing."""
    placed = sharding.assign_shards(_table(spark, sf, "documents"), [1.0] * SHARDS, grown=1.0)
    return placed.withColumnRenamed("id", "doc_id").withColumn("law", F.lit("key"))


@query
def op4_licenses(spark: SparkSession, sf: str) -> DataFrame:
    """Licence notices in all documents."""
    return licenses.scan_licenses(_table(spark, sf, "documents"), LICENSES).withColumnRenamed("id", "doc_id")


@query
def op5_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents that share at least 85 % of their three-word shingles."""
    groups = near_dedup.near_groups(_table(spark, sf, "documents"), words=3, percent=85)
    return groups.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


@query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity scores of all documents, by a network fitted on labelled rows that are not held out."""
    docs = _table(spark, sf, "documents")
    scored = toxicity.score(toxicity.fit_on(docs, _table(spark, sf, "labels")), docs)
    return scored.select(
        F.col("id").alias("doc_id"),
        toxicity.held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op7_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents with equal normalised texts."""
    groups = exact_dedup.exact_groups(_table(spark, sf, "documents"), digest=True)
    return groups.withColumnsRenamed({"id": "doc_id", "sha256": "text_sha256"})


@query
def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the lines that at least five of them share."""
    kept = line_dedup.dedup_lines(_table(spark, sf, "documents"))
    return kept.select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


@query
def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in all documents; counts and checksum of what the fixed patterns find."""
    docs = _table(spark, sf, "documents")
    found = pii.find_personal_data(docs, pii.train(pii.sample_texts(docs)))

    def listed(spans: str):
        one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(one, ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind) for kind in pii.KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


@query
def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the benchmark items of which they hold a window of ten words."""
    found = decontamination.find_contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op11_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents that share at least 85 % of their four-word shingles."""
    groups = ngram_join.ngram_join(_table(spark, sf, "documents"), words=4, percent=85)
    return groups.withColumnRenamed("id", "doc_id")


@query
def op12_resampling(spark: SparkSession, sf: str) -> DataFrame:
    """All documents weighed by their words against the benchmark, and the rank of those drawn."""
    drawn = resampling.importance(
        _table(spark, sf, "documents"), _table(spark, sf, "benchmark"), low=1, high=1, buckets=10_000, min_words=20,
        percent=10, seed=2024,
    )
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


@query
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Up to five hard negatives for each of the five positives of every hundredth vector."""
    vectors = _table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)
