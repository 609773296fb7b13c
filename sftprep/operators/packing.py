"""Packing: examples laid end to end and cut into full blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..storage import write_through

PACK_ROWS = 1000  # fixed value: rows per packing group


def pack_blocks(
    pieces: DataFrame,
    block_size: int,
    eos_id: int | None = None,
    pack_rows: int = PACK_ROWS,
    order: Sequence[str] = ("row_idx",),
    bounded: bool = True,
) -> DataFrame:
    """Full blocks of ``block_size`` tokens from ``ids`` and ``labels``.

    A group is ``pack_rows`` consecutive values of the first ``order`` column, so the
    blocks do not depend on partitions or workers; what is left of a group is dropped.
    ``eos_id`` ends a group with one eos, which counts only where it completes a block.

    ``bounded`` says that a row is one piece. Then a group is at most ``pack_rows`` rows
    and its offsets come from one window over them. Otherwise (chunks of conversations of
    any length) the pieces are stored, offsets come from their lengths alone, and meet the
    pieces on a unique key, so that no task holds a whole group.
    """
    if block_size < 2:
        raise ValueError("block_size must be at least 2")
    order = list(order)
    numbered = pieces.withColumn("pack_group", F.expr(f"{order[0]} div {pack_rows}")).withColumn(
        "_n", F.size("ids").cast("bigint")
    )
    before = Window.partitionBy("pack_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("_off")
    if bounded:
        placed = numbered.select("*", offset)
    else:
        stored = write_through(numbered, "pieces")
        offsets = stored.select("pack_group", *order, "_n").select("pack_group", *order, offset)
        placed = stored.join(offsets, ["pack_group", *order])

    first, last = F.col("_off"), F.col("_off") + F.col("_n") - 1
    size = F.lit(block_size).cast("bigint")

    def part(b):
        start = F.greatest(b * size - F.col("_off"), F.lit(0))
        stop = F.least((b + 1) * size - F.col("_off"), F.col("_n"))
        length = (stop - start).cast("int")
        at = (start + 1).cast("int")
        return F.struct(
            b.alias("block"), F.slice("ids", at, length).alias("ids"), F.slice("labels", at, length).alias("labels")
        )

    # cut inside the row: exploding block numbers would copy the whole row per block
    parts = placed.select(
        "pack_group",
        *order,
        F.explode(
            F.transform(
                F.when(F.col("_n") > 0, F.sequence(F.floor(first / block_size), F.floor(last / block_size))).otherwise(
                    F.lit([]).cast("array<bigint>")
                ),
                part,
            )
        ).alias("part"),
    )
    blocks = parts.groupBy("pack_group", F.col("part.block").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(*order, "part.ids", "part.labels"))).alias("parts"),
        F.sum(F.size("part.ids")).alias("tokens"),
    )
    full = F.col("tokens") == block_size
    if eos_id is not None:
        full = F.col("tokens") >= block_size - 1
    joined = blocks.filter(full).select(
        "pack_group", "block", F.flatten("parts.ids").alias("input_ids"), F.flatten("parts.labels").alias("labels")
    )
    if eos_id is not None:
        # only the last block of a group can be one token short
        eos = F.array(F.lit(eos_id))
        short = F.size("input_ids") == block_size - 1
        joined = joined.select(
            "pack_group",
            "block",
            F.when(short, F.concat("input_ids", eos)).otherwise(F.col("input_ids")).alias("input_ids"),
            F.when(short, F.concat("labels", eos)).otherwise(F.col("labels")).alias("labels"),
        )
    return joined.select(
        "pack_group", "block", "input_ids", F.array_repeat(F.lit(1), block_size).alias("attention_mask"), "labels"
    )
