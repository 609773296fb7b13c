"""What several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..storage import write_through

SMALL_ROWS = 200_000  # narrow rows that may be broadcast once a count has shown that there are no more

__all__ = ["SMALL_ROWS", "ascii_lower", "if_small", "whole_row", "write_through"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that columns an operator adds cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def if_small(table: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``table`` with a broadcast hint if a count shows that it is small; else it is joined by shuffle."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other characters as they are."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
