"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Only DataFrame functions. A first pass over the texts yields two numbers per document, its
length and a hash of its first characters. Lengths that occur once are out, then pairs of
length and prefix hash that occur once. A second pass hashes whole texts, but only those of
the pairs that are left; what it finds is stored, and the groups come from the stored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import if_small, whole_row, write_through

PREFIX = 256  # characters in the prefix hash
SALTS = 256  # parts that the rows of one full hash are dealt to

# runs of blanks other than a single space, which stays as it is
_BLANK_RUNS = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalised(text: Column) -> Column:
    """The text with every run of ASCII blanks as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BLANK_RUNS, " ")


def _sized(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*", F.length("norm").alias("length"), F.xxhash64(F.substring("norm", 1, PREFIX)).alias("prefix")
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False, digest: bool = False
) -> DataFrame:
    """For every row of ``docs``: ``id``, ``keep_id``, ``group_size``, ``kept``.

    Of equal normalised texts the row with the smallest id stays; a null id comes after all
    others, and of rows that repeat an id and a text exactly one stays. Null and empty texts
    are equal. ``whole`` adds the row as struct ``doc``, ``digest`` the SHA-256 of each
    normalised text as ``sha256``. An empty table gives no rows. Columns of ``docs`` never
    clash with the ones added.
    """
    texts = docs.select(
        F.col(id_col).alias("id"),
        normalised(F.col(text_col)).alias("norm"),
        *([whole_row(docs).alias("doc")] if whole else []),
    )
    sizes = write_through(_sized(texts.select("norm")).select("length", "prefix"), "exact-sizes")
    lengths = sizes.groupBy("length").agg(F.count("*").alias("n")).filter("n > 1").select("length")
    pairs = (
        sizes.join(if_small(lengths), "length", "left_semi")
        .groupBy("length", "prefix")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select("length", "prefix", F.lit(True).alias("shared"))
    )
    found = _sized(texts).join(if_small(write_through(pairs, "exact-pairs")), ["length", "prefix"], "left")
    stored = write_through(
        found.select(
            "id",
            F.monotonically_increasing_id().alias("row"),
            F.when(F.col("shared"), F.sha2("norm", 256)).alias("full"),
            F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("salt"),
            *([F.sha2("norm", 256).alias("sha256")] if digest else []),
            *(["doc"] if whole else []),
        ),
        "exact-rows",
    )
    extra = [c for c in ("sha256", "doc") if c in stored.columns]
    lone = stored.filter(F.col("full").isNull()).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), *extra
    )
    shared = stored.filter(F.col("full").isNotNull())
    # A group is counted per salt and then as a whole, and goes back to the salts that its rows
    # have: never more rows than the group, and no task meets a large group in one piece.
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "row")).alias("first")
    parts = shared.groupBy("full", "salt").agg(first, F.count("*").alias("n"))
    groups = parts.groupBy("full").agg(
        F.min("first").alias("first"), F.sum("n").alias("group_size"), F.collect_list("salt").alias("salts")
    )
    dealt = groups.select("full", "first", "group_size", F.explode("salts").alias("salt"))
    joined = shared.join(dealt, ["full", "salt"]).select(
        "id",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        *extra,
    )
    return lone.unionByName(joined)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text equals that of a row that stays."""
    return exact_groups(docs, id_col, text_col, whole=True).filter("kept").select("doc.*")
