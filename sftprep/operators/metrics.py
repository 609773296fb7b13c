"""Accuracy and what leads up to it. All of it is partial aggregation or per-row work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.tokenizers import Tokenizer, tidy_spacing, IGNORE_INDEX


def accuracy(
    df: DataFrame,
    predictions: str = "predictions",
    references: str = "references",
    normalize: bool = True,
    weight: str | None = None,
) -> DataFrame:
    """One row, ``accuracy double``: share (or number, or weight) of equal rows.

    Array columns count as equal only if every label is.
    """
    hit = F.col(predictions).eqNullSafe(F.col(references)).cast("double")
    if weight is None:
        value = F.avg(hit) if normalize else F.sum(hit)
    else:
        w = F.col(weight).cast("double")
        value = F.sum(w * hit) / F.sum(w) if normalize else F.sum(w * hit)
    return df.agg(value.alias("accuracy"))


def shifted_token_accuracy(
    df: DataFrame, predictions: str = "preds", labels: str = "labels", ignore_index: int | None = None
) -> DataFrame:
    """Labels from the second position against predictions up to the last but one.

    Counted inside each row, without exploding tokens. By default -100 positions count
    too; ``ignore_index`` leaves them out.
    """
    n = F.greatest(F.size(labels) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(labels, F.lit(2), n),
        F.slice(predictions, F.lit(1), n),
        lambda y, p: F.struct(y.alias("y"), p.alias("p")),
    )
    if ignore_index is not None:
        pairs = F.filter(pairs, lambda x: x["y"] != ignore_index)
    counted = df.select(pairs.alias("pairs")).select(
        F.size(F.filter("pairs", lambda x: x["y"] == x["p"])).alias("hits"), F.size("pairs").alias("n")
    )
    return counted.agg((F.sum("hits").cast("double") / F.sum("n")).alias("accuracy"))


def argmax(scores: Column) -> Column:
    """0-based place of the largest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def blank_prompt(generated: Column, prompt_len: Column, pad_id: int) -> Column:
    """Generated ids with the prompt part replaced by the pad id."""
    return F.transform(generated, lambda x, i: F.when(i < prompt_len, F.lit(pad_id)).otherwise(x))


def prediction_records(
    df: DataFrame,
    tokenizer: Tokenizer,
    predictions: str = "preds",
    labels: str = "labels",
    tidy: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``label, predict`` texts: -100 becomes pad, special tokens are skipped."""

    def text(column: str) -> Column:
        ids = F.transform(column, lambda x: F.when(x == IGNORE_INDEX, F.lit(tokenizer.special.pad_id)).otherwise(x))
        decoded = tokenizer.decode(ids, skip_special_tokens=True)
        return tidy_spacing(decoded) if tidy else decoded

    return df.select(*keep, text(labels).alias("label"), text(predictions).alias("predict"))
