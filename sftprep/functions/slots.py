"""Slot substitution in template strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SYSTEM, QUERY, IDX = "{{system}}", "{{query}}", "{{idx}}"


def replace_first(text: Column, needle: str, value: Column) -> Column:
    """Replace the first occurrence only (Spark's ``replace`` takes all)."""
    at = F.locate(needle, text)
    return F.when(
        at > 0,
        F.concat(F.substring(text, F.lit(1), at - 1), value, F.substring(text, at + len(needle), F.length(text))),
    ).otherwise(text)


def _joined(parts: list) -> Column:
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts if not (isinstance(p, str) and p == "")]
    if not columns:
        return F.lit("")
    return columns[0] if len(columns) == 1 else F.concat(*columns)


def fill(
    element: str, system: Column | None = None, query: Column | None = None, idx: Column | None = None
) -> Column:
    """Fill each given slot once, in the order system, query, idx.

    A slot that stands in the template's own leading literal is resolved while the
    plan is built. Behind a filled-in value the first occurrence depends on the data
    (a query may itself hold ``{{idx}}``), so there the search runs per row.
    """
    parts: list = [element]
    for slot, value in ((SYSTEM, system), (QUERY, query), (IDX, idx)):
        if value is None:
            continue
        if slot in parts[0]:
            before, after = parts[0].split(slot, 1)
            parts = [before, value, after] + parts[1:]
        elif len(parts) > 1:
            parts = ["", replace_first(_joined(parts), slot, value)]
    return _joined(parts)


def fill_all(element: str, slot: str, value: Column) -> Column:
    """Fill every occurrence of one slot."""
    pieces = element.split(slot)
    parts: list = [pieces[0]]
    for piece in pieces[1:]:
        parts += [value, piece]
    return _joined(parts)
