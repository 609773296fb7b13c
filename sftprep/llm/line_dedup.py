"""Lines that many documents share, as compressed keep bitmaps per document.

Only DataFrame functions. Every long line becomes one narrow row: the hash of its key, its
document and its position. Keys with very many lines are found by counting (their number
is bounded by the share that makes a key frequent); for them a count of documents and the
last document are aggregated and broadcast. All other lines are range-partitioned by hash
and sorted by document and position inside: one pass over the sorted rows sees the
occurrences that stay first, numbers the documents, and so decides every line. What is
returned are runs of kept lines per document, not text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SMALL_ROWS, ascii_lower, write_through

MIN_CHARS = 40
MIN_DOCS = 5
FREQUENT_LINES = 2_000  # a key with more lines is decided by aggregates, if it also holds
FREQUENT_SHARE = 1 / 50_000  # more than this share of all lines: at most 50,000 keys
SMALL_RUNS = 1_000_000

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_hash(id_col: str, text_col: str) -> list[Column]:
    """A 128-bit name for (id, text): rows that repeat both are the same document."""
    return [F.xxhash64(F.lit(i), F.col(id_col), F.col(text_col)).alias(f"row{i}") for i in (1, 2)]


def _keep_runs(dropped: Column, n_lines: Column) -> Column:
    """Runs of kept lines from sorted dropped positions: run-length coding of the bitmap."""
    starts = F.filter(dropped, lambda p, i: (i == 0) | (F.get(dropped, i - 1) != p - 1))
    ends = F.filter(dropped, lambda p, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != p + 1))
    opens = F.concat(F.array(F.lit(0)), F.transform(ends, lambda p: p + 1))
    closes = F.concat(starts, F.array(n_lines))
    runs = F.zip_with(opens, closes, lambda a, b: F.struct(a.alias("start"), (b - a).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """One row per line that goes: ``row1``, ``row2`` (the document) and ``pos``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents
    loses its lines everywhere but in the largest id that holds it. Rows with one id are one
    document; a null id is smaller than all others.
    """
    lines = (
        docs.select(F.col(id_col).alias("id"), *_row_hash(id_col, text_col), F.posexplode(_lines(F.col(text_col))))
        .filter(F.length("col") >= min_chars)
        .select("id", "row1", "row2", "pos", line_key(F.col("col")).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select(F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"), "id", "row1", "row2", "pos")
    )
    stored = write_through(lines, "lines")
    total = stored.count()
    limit = max(FREQUENT_LINES, int(total * FREQUENT_SHARE))
    counts = stored.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    frequent = F.broadcast(write_through(counts.select("h1", "h2"), "frequent-lines"))  # at most 50,000 rows

    last = (
        stored.join(frequent, ["h1", "h2"])
        .select("h1", "h2", "id")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("id").alias("last"))
        .filter(F.col("n_docs") >= min_docs)
    )
    of_frequent = stored.join(F.broadcast(last), ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("last")))

    same = Window.partitionBy("h1", "h2")
    ordered = same.orderBy(F.col("id").desc_nulls_last())
    spread = stored.join(frequent, ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2")
    of_others = (
        spread.sortWithinPartitions("h1", "h2", F.col("id").desc_nulls_last(), "pos")
        .withColumn("nth_doc", F.dense_rank().over(ordered))
        .withColumn("n_docs", F.max("nth_doc").over(same))
        .filter((F.col("n_docs") >= min_docs) & (F.col("nth_doc") > 1))
    )
    return of_frequent.select("row1", "row2", "pos").unionByName(of_others.select("row1", "row2", "pos"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Documents that lose lines: ``row1``, ``row2``, ``n_dropped`` and ``keep_runs``, the keep bitmap as runs.

    The last run is open: it ends where the document does.
    """
    dropped = F.sort_array(F.collect_set("pos"))
    return (
        shared_lines(docs, id_col, text_col, **limits)
        .groupBy("row1", "row2")
        .agg(dropped.alias("dropped"))
        .select(
            "row1",
            "row2",
            F.size("dropped").cast("bigint").alias("n_dropped"),
            _keep_runs(F.col("dropped"), F.lit(2**31 - 1)).alias("keep_runs"),
        )
    )


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The text of the kept runs; the whole text where the bitmap is null."""
    lines = _lines(text)
    parts = F.transform(keep_runs, lambda r: F.slice(lines, r["start"] + 1, r["length"]))
    return F.when(keep_runs.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.flatten(parts), "\n"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_lines``, ``n_dropped``, ``keep_runs`` and ``text``, what is kept.

    A null or empty text is one empty line. Rows that repeat id and text get the same result.
    An empty table gives no rows; other columns are not read.
    """
    maps = write_through(keep_bitmaps(docs, id_col, text_col, **limits), "line-bitmaps")
    size = maps.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("keep_runs")), F.lit(0)).alias("runs")).first()
    small = size["n"] <= SMALL_ROWS and size["runs"] <= SMALL_RUNS
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *_row_hash(id_col, text_col))
    return texts.join(F.broadcast(maps) if small else maps, ["row1", "row2"], "left").select(
        "id",
        F.size(_lines(F.col("text"))).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"),
        "keep_runs",
        kept_text(F.col("text"), F.col("keep_runs")).alias("text"),
    )
