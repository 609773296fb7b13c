"""Encoded data and intermediate results kept in storage."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..storage import path_exists, shared_dir


def encoded_cache(spark: SparkSession, cache_path: str | None, build: Callable[[], DataFrame]) -> DataFrame:
    """Load ``cache_path`` if it is complete, else build, save there and read back."""
    if cache_path is None:
        return build()
    if not path_exists(spark, f"{cache_path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(cache_path)
    return spark.read.parquet(cache_path)


def reused(spark: SparkSession, name: str, recipe: str, build: Callable[[], DataFrame], overwrite: bool = False) -> DataFrame:
    """Keep a transform's result in the shared folder under a digest of its recipe.

    ``recipe`` is any text that changes when the result would. ``overwrite`` computes anew.
    """
    digest = hashlib.sha1(recipe.encode()).hexdigest()
    path = f"{shared_dir(spark)}/reuse-{name}-{digest}"
    if overwrite or not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
