"""Row order, running totals and exact cuts without one-task windows.

DataFrames have no row order, but packing, interleaving and take/skip are defined by
one. The helpers here number rows in two levels: totals per block (partial
aggregation), a running sum over the small block table, and a local window inside each
block. No task ever holds more than one block of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..storage import write_through

BLOCK_BITS = 16  # 65,536 keys per block, and 65,536 blocks per node of the tree above them
KEY_BITS = 64


def running_total(
    df: DataFrame,
    value: Column | int,
    block: Column,
    order: Sequence[str],
    out: str,
    within: Sequence[str] = (),
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the same ``within`` group.

    ``block`` must rise with ``order`` and hold a bounded number of rows. ``block_bits`` says how many bits its
    numbers take; above 16 the blocks are summed up in a tree, so that no task holds more than one of its nodes
    even if every row has a block of its own.
    """
    value = F.lit(value) if isinstance(value, int) else value
    within = list(within)
    blocked = df.withColumn("_block", block).withColumn("_value", value)
    totals = blocked.groupBy(*within, "_block").agg(F.sum("_value").alias("_total"))
    offsets = _block_offsets(totals, within, block_bits)
    local = Window.partitionBy(*within, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.join(offsets, [*within, "_block"])
        .withColumn(out, (F.col("_offset") + F.coalesce(F.sum("_value").over(local), F.lit(0))).cast("bigint"))
        .drop("_block", "_value", "_offset")
    )


def _block_offsets(totals: DataFrame, within: list[str], bits: int) -> DataFrame:
    """``_block, _offset``: the sum of ``_total`` over all earlier blocks, from that over earlier nodes and a window in
    the own one. The root, at most 65,536 rows, is one window."""
    node = [] if bits <= BLOCK_BITS else ["_node"]
    nodes = totals.withColumn("_node", F.shiftright("_block", BLOCK_BITS)) if node else totals
    before = Window.partitionBy(*within, *node).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("bigint")
    if not node:
        return nodes.select(*within, "_block", offset.alias("_offset"))
    above = nodes.groupBy(*within, F.col("_node").alias("_block")).agg(F.sum("_total").alias("_total"))
    above = _block_offsets(above, within, bits - BLOCK_BITS).withColumnRenamed("_block", "_node")
    inside = nodes.select(*within, "_node", "_block", offset.alias("_inside"))
    joined = inside.join(above.withColumnRenamed("_offset", "_above"), [*within, "_node"])
    return joined.select(*within, "_block", (F.col("_above") + F.col("_inside")).alias("_offset"))


def row_index(
    df: DataFrame, key: str, within: Sequence[str] = (), out: str = "row_idx", key_bits: int = KEY_BITS
) -> DataFrame:
    """Dense 0-based index by a unique integer key (unique per ``within`` group).

    A block is a range of 65,536 key values, so with unique keys it holds at most that many rows. Keys may lie
    any distance apart; who knows that they take fewer bits can say so in ``key_bits`` and saves levels of the tree.
    """
    bits = min(key_bits, INTEGER_BITS.get(df.schema[key].dataType.simpleString(), KEY_BITS))
    block = F.shiftright(F.col(key).cast("bigint"), BLOCK_BITS)
    return running_total(df, 1, block, [key], out, within, max(bits - BLOCK_BITS, 1))


INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32}


def range_index(df: DataFrame, *order: Column, out: str = "row_idx") -> DataFrame:
    """Dense 0-based index by any ordering, for example count descending then token.

    Rows are range-partitioned and sorted once and that layout is stored, so the
    numbering reads one fixed layout; range boundaries come from a sample and would
    differ between two runs.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = write_through(spread.withColumn("_place", F.monotonically_increasing_id()), "range-index")
    part = F.shiftright(F.col("_place"), 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition
    offsets = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.col("_place") - F.col("_first"))
        .drop("_part", "_place", "_first", "_offset")
    )


BROADCAST_ROWS = 200_000  # of a few dozen bytes and a path each


def join_if_small(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Join a table of one row per file or block: by broadcast if a count shows that it
    is small, so that the rows stay where they are, else by shuffle."""
    few = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(table) if few else table, keys)


def file_index(df: DataFrame, out: str = "row_idx") -> DataFrame:
    """Dense 0-based index of a Parquet scan, by file path and position in the file.

    ``df`` must be a plain scan: the position is the hidden ``_metadata.row_index``.
    No row is shuffled for it; only one size per file travels.
    """
    placed = df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_pos", F.col("_metadata.row_index"))
    sizes = placed.groupBy("_file").agg((F.max("_pos") + 1).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    joined = join_if_small(placed, offsets, ["_file"])
    return joined.withColumn(out, F.col("_offset") + F.col("_pos")).drop("_file", "_pos", "_offset")


PLACES = ("_file", "_start", "_place")  # file, block in it, and a number that rises in the block


def scan_index(*scans: DataFrame, out: str = "row_idx") -> DataFrame:
    """Dense 0-based index of text, CSV or JSON scans, by file, block and line.

    Such files carry no row numbers. Each row is stored once with its block and a
    number that rises inside the block, and is counted from the stored copy. Scans that bring
    ``PLACES`` of their own keep them.
    """
    tagged = [
        df if set(PLACES) <= set(df.columns) else df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_place"),
        )
        for df in scans
    ]
    placed = write_through(reduce(DataFrame.unionByName, tagged), "scan-index")
    sizes = placed.groupBy("_file", "_start").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        join_if_small(placed, offsets, ["_file", "_start"])
        .withColumn(out, F.col("_offset") + F.col("_place") - F.col("_first"))
        .drop("_file", "_start", "_place", "_first", "_offset")
    )


def key_cut(df: DataFrame, key: str, n: int) -> int | None:
    """The n-th smallest value (n ≥ 1) of a unique integer key, None if there are fewer rows.

    Found by going down a tree of counts, 65,536 ranges of keys at a time, over counts per block that are
    stored once; then the keys of one block are ordered.
    """
    counted = df.groupBy(F.shiftright(F.col(key).cast("bigint"), BLOCK_BITS).alias("_block")).agg(F.count("*").alias("_n"))
    counts, left = write_through(counted, "key-counts"), n
    upto = Window.orderBy("_node").rowsBetween(Window.unboundedPreceding, 0)  # over 65,536 rows at most
    for shift in range(KEY_BITS - 2 * BLOCK_BITS, -1, -BLOCK_BITS):
        nodes = counts.groupBy(F.shiftright("_block", shift).alias("_node")).agg(F.sum("_n").alias("_n"))
        crossing = nodes.withColumn("_upto", F.sum("_n").over(upto)).filter(F.col("_upto") >= left)
        found = crossing.orderBy("_node").limit(1).first()
        if found is None:
            return None
        left -= found["_upto"] - found["_n"]
        counts = counts.filter(F.shiftright("_block", shift) == found["_node"])
    low = found["_node"] << BLOCK_BITS
    inside = df.select(F.col(key).alias("k")).filter(F.col("k").between(low, low + 2**BLOCK_BITS - 1))
    return inside.orderBy("k").limit(left).agg(F.max("k")).first()[0]


def first_by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest values of a unique integer key: a plain filter on
    the key, which reaches the scan."""
    if n < 0:
        raise ValueError("max_samples must not be negative")
    if n == 0:
        return df.filter(F.lit(False))
    cut = key_cut(df, key, n)
    return df if cut is None else df.filter(F.col(key) <= cut)


# -- seeded order -----------------------------------------------------------------


def seeded_hash(seed: int, *ids: str) -> Column:
    """A hash that orders rows at random but always the same way for one seed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


PREFIX_STEP = 3  # hex digits fixed per pass: at most 4,096 counts come to the driver
FINAL_ROWS = 10_000


def smallest_cut(
    df: DataFrame, hash_col: str, id_col: str, wanted: Callable[[int], int]
) -> tuple[int, int, tuple[str, object] | None]:
    """Find the (hash, id) of the k-th smallest row, ``k = wanted(row count)``.

    Works digit by digit on counts per hash prefix, so the rows themselves are never
    sorted or moved: with the cut known, a split is a plain filter. Returns
    (row count, k, cut); the cut is None for k = 0.
    """
    prefix, left, total, k = "", 0, None, 0
    keys = df.select(hash_col, id_col)
    while True:
        part = keys.filter(F.col(hash_col).startswith(prefix)) if prefix else keys
        digits = F.substring(hash_col, len(prefix) + 1, PREFIX_STEP).alias("digits")
        counts = sorted((r["digits"], r["n"]) for r in part.groupBy(digits).agg(F.count("*").alias("n")).collect())
        if total is None:
            total = sum(n for _, n in counts)
            k = left = wanted(total)
            if k <= 0:
                return total, 0, None
            if k > total:
                raise ValueError(f"cannot take {k} of {total} rows")
        for piece, n in counts:
            if left <= n:
                prefix += piece
                break
            left -= n
        if n <= FINAL_ROWS:
            break
        if len(prefix) >= 32:
            raise ValueError(f"{n} rows share one {id_col}: the id must be unique")
    last = keys.filter(F.col(hash_col).startswith(prefix)).orderBy(hash_col, id_col).limit(left)
    row = last.agg(F.max(F.struct(hash_col, id_col)).alias("cut")).first()["cut"]
    tied = keys.filter((F.col(hash_col) == row[0]) & (F.col(id_col) == F.lit(row[1]))).limit(2).count()
    if tied > 1:
        raise ValueError(f"several rows share the {id_col} {row[1]}: the id must be unique")
    return total, k, (row[0], row[1])


def at_or_below(cut: tuple[str, object], hash_col: str, id_col: str) -> Column:
    h, i = cut
    return (F.col(hash_col) < h) | ((F.col(hash_col) == h) & (F.col(id_col) <= F.lit(i)))


def first_rows(df: DataFrame, n: int, index: str = "row_idx") -> DataFrame:
    """The first ``n`` rows by a dense index (a filter, so it reaches a stored index column)."""
    if n < 0:
        raise ValueError("max_samples must not be negative")
    return df.filter(F.col(index) < n)
