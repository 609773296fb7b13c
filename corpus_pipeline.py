"""The corpus pipeline: STAGES in their order, each over all that the one before kept.

All stages take any table with the columns ``doc_id`` and ``text``. A null text is kept as it is by the
filters (it scores 0, equals the empty text, has no shingles and no words) and packed as one
closing id. Rows without an id take part through their text. Rows that repeat an id are
judged by their own texts, and of those that repeat id and text one stays. Further columns, whatever their
names, come out unchanged of all stages but the last. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sftprep.llm import decontamination, exact_dedup, near_dedup, packing, toxicity
from sftprep.llm.common import write_through
from sftprep.llm.queries import VOCABULARY


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones among them, does not reject."""
    return toxicity.remove_toxic(docs, toxicity.fit_on(docs, _table(spark, sf_dir, "labels")))


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of texts that are equal but for blanks."""
    return exact_dedup.deduplicate(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    return near_dedup.deduplicate(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of what is left, as pieces of sequences."""
    return packing.pack(docs, VOCABULARY)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_exact_copies),
    ("near dedup", remove_near_copies),
    ("benchmark decontamination", remove_benchmark),
    ("packing", pack_tokens),
]
ORACLE_SQL = None  # a trained model decides; tests compare the stages with plain computations


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; what a stage returns is stored before the next one reads it."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
