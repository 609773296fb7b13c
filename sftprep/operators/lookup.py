"""Model names to chat templates, for tables that carry a model per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.templates import FAMILY_TEMPLATE, MODEL_FAMILY


def with_template_name(df: DataFrame, model: str = "model", out: str = "template") -> DataFrame:
    """Add the template name; an unknown model raises. The lookup table is a constant."""
    spark = df.sparkSession
    table = spark.createDataFrame(
        [(m, FAMILY_TEMPLATE[f]) for m, f in MODEL_FAMILY.items()], f"{model} string, _template string"
    )
    unknown = F.raise_error(F.concat(F.lit("unknown model: "), F.col(model)))
    return (
        df.join(F.broadcast(table), model, "left")
        .withColumn(out, F.coalesce("_template", unknown))
        .drop("_template")
    )
