"""Shards by rendezvous hashing: every record goes to the shard that scores highest for its key.

The score of a shard depends on the key and that shard alone, so a further shard takes
records only into itself, and a shard's share follows its weight.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordering import running_total
from .common import write_through

RECORD_OVERHEAD = 16  # bytes of a record besides its text
ROWS_PER_BLOCK = 20_000  # rows numbered together, on average
COPIES_PER_ROW = 10_000


def shard_scores(key: Column, weights: Sequence[float]) -> Column:
    """Per shard (-ln(u) / weight, shard), u uniform by key and shard; the smallest wins."""
    shares = F.array(*[F.lit(float(w)) for w in weights])

    def score(shard):
        draw = (F.shiftrightunsigned(F.xxhash64(key, shard), 11) + F.lit(0.5)) / F.lit(2.0**53)
        return F.struct((-F.log(draw) / F.get(shares, shard)).alias("score"), shard.alias("shard"))

    return F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), score)


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float],
    grown: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``size``, ``text_crc32``, ``shard``, ``slot`` and, with the
    weight ``grown`` of one more shard, ``grown_shard``.

    The key is the id as text (null: the word null), so rows that repeat an id share a shard.
    Slots number the rows of a shard without gaps. They are counted per block of hashes,
    never by one task per shard; rows that repeat id, size and checksum are one row with a
    count until the end. A null text counts as empty. An empty table gives no rows; other
    columns are not read.
    """
    if not weights or min([*weights, grown or 1.0]) <= 0:
        raise ValueError("every shard needs a positive weight")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("key"),
        (F.octet_length(text) + RECORD_OVERHEAD).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    counted = rows.groupBy("id", "key", "size", "text_crc32").agg(F.count("*").alias("copies"))
    scores = shard_scores(F.col("key"), [*weights, *([grown] if grown else [])])
    scored = counted.withColumn("scores", scores).select(
        "id",
        "size",
        "text_crc32",
        "copies",
        F.xxhash64("key", "size", "text_crc32").alias("place"),
        F.array_min(F.slice("scores", 1, len(weights)))["shard"].alias("shard"),
        F.array_min("scores")["shard"].alias("grown_shard"),
    )
    stored = write_through(scored if grown else scored.drop("grown_shard"), "shards")
    blocks = stored.count() / len(weights) / ROWS_PER_BLOCK
    bits = max(1, math.ceil(math.log2(max(blocks, 1))))
    block = F.shiftrightunsigned("place", 64 - bits)
    numbered = running_total(
        stored, F.col("copies"), block, ["place", "id", "size", "text_crc32"], "slot", within=["shard"]
    )
    stretch = F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(COPIES_PER_ROW))).alias("from")
    upto = F.least(F.col("from") + (COPIES_PER_ROW - 1), F.col("copies") - 1)
    return (
        numbered.select("*", stretch)
        .select("*", F.explode(F.sequence("from", upto)).alias("copy"))
        .withColumn("slot", F.col("slot") + F.col("copy"))
        .drop("place", "copies", "from", "copy")
    )
