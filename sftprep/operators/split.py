"""Train/eval split and shuffles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ordering import at_or_below, seeded_hash, smallest_cut

TINY = 1e-6  # fixed value: below it there is no validation set
BUFFER_SIZE = 16384  # fixed value: default shuffle buffer


def split_train_eval(
    df: DataFrame, val_size: float, seed: int = 42, id_col: str = "row_idx", do_train: bool = True
) -> dict[str, DataFrame]:
    """``{"train": …, "eval": …}`` by a seeded draw of ``val_size`` rows.

    Above 1 it is a count, below 1 a fraction (rounded up). The draw is a cut through
    the hashes of the ids; both parts are filters over ``df`` and nothing is shuffled.
    """
    if not do_train:
        return {"eval": df}
    if val_size <= TINY:
        return {"train": df}
    if val_size == 1:
        raise ValueError("val_size 1 is neither a count above 1 nor a fraction below 1")

    def wanted(total: int) -> int:
        k = int(val_size) if val_size > 1 else math.ceil(val_size * total)
        if k >= total:
            raise ValueError(f"val_size {val_size} leaves no training rows out of {total}")
        return k

    hashed = df.withColumn("_draw", seeded_hash(seed, id_col))
    _, _, cut = smallest_cut(hashed, "_draw", id_col, wanted)
    chosen = at_or_below(cut, "_draw", id_col)
    return {"train": hashed.filter(~chosen).drop("_draw"), "eval": hashed.filter(chosen).drop("_draw")}


def buffer_shuffle(
    df: DataFrame, buffer_size: int = BUFFER_SIZE, seed: int = 42, index: str = "row_idx"
) -> DataFrame:
    """Shuffle within runs of ``buffer_size`` rows: ``shuffled_idx`` is the new order."""
    run = F.expr(f"{index} div {buffer_size}")
    order = Window.partitionBy("_run").orderBy(seeded_hash(seed, index), index)
    return (
        df.withColumn("_run", run)
        .withColumn("shuffled_idx", F.col("_run") * buffer_size + F.row_number().over(order) - 1)
        .drop("_run")
    )


def buffer_slot(place: Column, buffer_size: int, seed: int) -> Column:
    """Where in the buffer the row of this place (from ``buffer_size`` on) goes: a seeded draw. The first rows
    fill the buffer in their order."""
    draw = F.concat_ws(":", F.lit(str(seed)), (place - buffer_size).cast("string"))
    drawn = F.conv(F.substring(F.md5(draw), 1, 8), 16, 10).cast("bigint") % buffer_size
    return F.when(place < buffer_size, place).otherwise(drawn)


def left_in_buffer(df: DataFrame, seed: int, index: str, start: int, out: str) -> DataFrame:
    """Rows that no later row drives out of the buffer, ``buffer_size`` at most, in seeded order from ``start`` on."""
    order = Window.orderBy(seeded_hash(seed, index), index)
    return df.withColumn(out, F.row_number().over(order).cast("bigint") + (start - 1))


def moving_shuffle(
    df: DataFrame, buffer_size: int = BUFFER_SIZE, seed: int = 42, index: str = "row_idx"
) -> DataFrame:
    """Shuffle through a buffer that moves along the rows: ``shuffled_idx`` is the new order.

    ``index`` is dense from 0. The first ``buffer_size`` rows fill the buffer. Every later one draws a slot,
    drives out the row in it and takes its place; at the end the buffer comes out in seeded
    order. A row thus leaves with the next row that draws its slot: one window per slot, so ``buffer_size``
    groups side by side instead of a walk along the rows.
    """
    if buffer_size < 1:
        raise ValueError("buffer_size must be at least 1")
    following = F.lead(index).over(Window.partitionBy("_slot").orderBy(index))
    placed = df.withColumn("_slot", buffer_slot(F.col(index), buffer_size, seed)).withColumn("_next", following)
    gone = placed.filter(F.col("_next").isNotNull()).withColumn("shuffled_idx", F.col("_next") - buffer_size)
    rows = df.count()
    kept = left_in_buffer(placed.filter(F.col("_next").isNull()), seed, index, max(0, rows - buffer_size), "shuffled_idx")
    return gone.unionByName(kept).drop("_slot", "_next")


def full_shuffle(df: DataFrame, seed: int = 42, id_col: str = "row_idx") -> DataFrame:
    """All rows in seeded random order."""
    return df.withColumn("_draw", seeded_hash(seed, id_col)).orderBy("_draw", id_col).drop("_draw")
