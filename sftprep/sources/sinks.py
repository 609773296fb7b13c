"""Where results go: prediction records, metrics, a look at the first examples."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..functions.tokenizers import IGNORE_INDEX, Tokenizer


def write_predictions(records: DataFrame, path: str) -> None:
    """JSON lines ``{"label", "predict"}``; text outside ASCII stays as it is."""
    records.select("label", "predict").write.mode("overwrite").option("ignoreNullFields", False).json(path)


def metrics_table(
    spark: SparkSession, split: str, metrics: Mapping[str, float], predict_with_generate: bool = False
) -> DataFrame:
    """``split, metric, value``; under generation there is no evaluation loss."""
    kept = {k: float(v) for k, v in metrics.items() if not (predict_with_generate and k == "eval_loss")}
    return spark.createDataFrame([(split, k, v) for k, v in kept.items()], "split string, metric string, value double")


def append_metrics(table: DataFrame, path: str) -> None:
    table.write.mode("append").parquet(path)


def preview_table(encoded: DataFrame, tokenizer: Tokenizer, n: int, order: str) -> DataFrame:
    """The first ``n`` examples in ``order``, with their ids decoded; labels without the
    ignored places."""
    shown = []
    for column in ("input_ids", "labels", "prompt_ids", "chosen_ids", "rejected_ids"):
        if column in encoded.columns:
            ids = F.col(column)
            if column == "labels":
                ids = F.filter(ids, lambda x: x != IGNORE_INDEX)
            shown += [F.col(column), tokenizer.decode(ids).alias(column.replace("_ids", "") + "_text")]
    return encoded.orderBy(order).limit(n).select(order, *shown)


def preview(encoded: DataFrame, tokenizer: Tokenizer, n: int = 1, order: str = "row_idx") -> list[Row]:
    """A few examples to look at; none at all is an error."""
    rows = preview_table(encoded, tokenizer, n, order).collect()
    if not rows:
        raise RuntimeError("there is no example to show: the encoded data has no rows")
    return rows
