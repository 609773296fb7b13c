"""A vocabulary table: built from a corpus, applied by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordering import range_index

HOT_TOKENS = 10_000
HOT_LENGTH = 1_000  # characters; with HOT_TOKENS it bounds the broadcast list
INT_MIN = -(2**31)


def build_vocabulary(df: DataFrame, text: str = "text", first_id: int = 0) -> DataFrame:
    """``token, n, token_id``: ids by falling count, ties by token. Tokens are what stands
    between spaces."""
    tokens = df.select(F.explode(F.split(text, " ")).alias("token")).filter(F.col("token") != "")
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    ranked = range_index(counts, F.col("n").desc(), F.col("token"), out="token_id")
    return ranked.withColumn("token_id", F.col("token_id") + first_id)


def _hot_and_cold(vocabulary: DataFrame, first_id: int) -> tuple[DataFrame, DataFrame]:
    """Tokens of high rank and moderate length, at most ``HOT_TOKENS`` since ids are ranks, and all others."""
    is_hot = (F.col("token_id") < first_id + HOT_TOKENS) & (F.length("token") <= HOT_LENGTH)
    return vocabulary.filter(is_hot), vocabulary.filter(~is_hot)


def _look_up(
    rows: DataFrame, vocabulary: DataFrame, first_id: int, by: str, wanted: str
) -> tuple[DataFrame, DataFrame]:
    """Add ``_found``: the vocabulary's ``wanted`` column for ``by``, null where there is none. Rows come in two parts,
    settled where they are and met by a shuffle.

    Hot tokens are joined by broadcast, a list whose size is bounded by construction.
    Every other token is rarer than 1 / ``HOT_TOKENS`` of the vocabulary's corpus, so the
    shuffle join of the rest has no hot key. A null ``by`` stays out of that shuffle.
    """
    hot, cold = _hot_and_cold(vocabulary, first_id)
    marked = rows.join(F.broadcast(hot.select(by, F.col(wanted).alias("_hot"))), by, "left")
    settled = F.col("_hot").isNotNull() | F.col(by).isNull()
    near = marked.filter(settled).withColumnRenamed("_hot", "_found")
    far = marked.filter(~settled).drop("_hot").join(cold.select(by, F.col(wanted).alias("_found")), by, "left")
    return near, far


def _gathered(parts: tuple[DataFrame, DataFrame], key: str, item: Column) -> DataFrame:
    """``key, _items``: the items of both parts of a look-up, sorted.

    Each part is gathered by itself, so that settled rows of a table that is dealt out by ``key`` already are not shuffled.
    """
    lists = [part.groupBy(key).agg(F.collect_list(item).alias("_items")) for part in parts]
    both = lists[0].unionByName(lists[1]).groupBy(key).agg(F.flatten(F.collect_list("_items")).alias("_items"))
    return both.withColumn("_items", F.sort_array("_items"))


def encode_with_vocabulary(
    df: DataFrame, vocabulary: DataFrame, key: str, text: str = "text", first_id: int = 0, unknown_id: int = -1
) -> DataFrame:
    """``key, input_ids``: each text as vocabulary ids, in order."""
    listed = F.filter(F.split(text, " "), lambda w: w != "")
    # an empty text keeps one row, without a token
    tokens = df.select(key, F.posexplode_outer(listed).alias("pos", "token"))
    parts = _look_up(tokens, vocabulary, first_id, "token", "token_id")
    number = F.coalesce("_found", F.lit(unknown_id)).cast("int")
    # a position and an id in one number: a fourth of the room of a struct in an array
    item = F.shiftleft(F.col("pos").cast("bigint"), 32) + number - INT_MIN
    found = _gathered(parts, key, item)
    return found.select(key, F.transform("_items", lambda x: (x.bitwiseAND(2**32 - 1) + INT_MIN).cast("int")).alias("input_ids"))


def decode_with_vocabulary(
    df: DataFrame, vocabulary: DataFrame, key: str, ids: str = "input_ids", first_id: int = 0
) -> DataFrame:
    """``key, text``: ids back to words joined by single spaces. An id that is not in
    the vocabulary raises."""
    numbers = df.select(key, F.posexplode_outer(ids).alias("pos", "token_id"))
    parts = _look_up(numbers, vocabulary, first_id, "token_id", "token")
    unknown = F.raise_error(F.concat(F.lit("id not in the vocabulary: "), F.col("token_id").cast("string")))
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("_found", unknown).alias("w")))
    found = _gathered(parts, key, item)
    return found.select(key, F.array_join(F.transform("_items", lambda x: x["w"]), " ").alias("text"))
