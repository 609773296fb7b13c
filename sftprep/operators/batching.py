"""Fixed-size batches, padded to one length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.tokenizers import IGNORE_INDEX

PAD_MULTIPLE = 4  # fixed value: right-padded batches are rounded up to it


def assign_batches(df: DataFrame, batch_size: int, index: str = "row_idx") -> DataFrame:
    return df.withColumn("batch", F.expr(f"{index} div {int(batch_size)}"))


def _padded(values: str, width: Column, filler: int, left: bool) -> Column:
    fill = F.array_repeat(F.lit(filler), width - F.size(values))
    return F.concat(fill, F.col(values)) if left else F.concat(F.col(values), fill)


def pad_batches(
    df: DataFrame,
    pad_id: int,
    side: str = "right",
    ignore_pad_token_for_loss: bool = True,
    multiple: int | None = None,
) -> DataFrame:
    """Pad ``input_ids`` (pad id), ``attention_mask`` (0) and ``labels`` (-100) per ``batch``.

    Ids and labels each go to their own longest row; on the right the length is rounded
    up to a multiple of 4. A group is one batch, so the window is bounded.
    """
    if side not in ("right", "left"):
        raise ValueError("side is 'right' or 'left'")
    if multiple is None:
        multiple = PAD_MULTIPLE if side == "right" else 1
    batch = Window.partitionBy("batch")

    def width(column: str) -> Column:
        longest = F.max(F.size(column)).over(batch)
        return (F.ceil(longest / multiple) * multiple).cast("int")

    left = side == "left"
    label_filler = IGNORE_INDEX if ignore_pad_token_for_loss else pad_id
    wide = df.withColumn("_w", width("input_ids")).withColumn("_lw", width("labels"))
    return (
        wide.withColumn("input_ids", _padded("input_ids", F.col("_w"), pad_id, left))
        .withColumn("attention_mask", _padded("attention_mask", F.col("_w"), 0, left))
        .withColumn("labels", _padded("labels", F.col("_lw"), label_filler, left))
        .drop("_w", "_lw")
    )
