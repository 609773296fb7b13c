"""Turn-per-row tables to conversations, in bounded pieces.

A conversation is gathered in chunks of ``width`` pairs, so no task collects an
unbounded group even if one conversation holds a large share of the table. A short
conversation is one chunk and needs nothing else; only chunks of long ones meet again,
through a table of per-conversation totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .normalize import apply_order_policy, message_pairs, roles_alternate
from .ordering import KEY_BITS, row_index

CHUNK_PAIRS = 4096
CHUNKS_PER_KEY = 16  # chunks of one conversation that share a join key


def conversation_parts(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    width: int = CHUNK_PAIRS,
    on_bad_order: str = "raise",
    longest: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """One row per conversation and chunk: conversations of one chunk, and longer ones.

    ``longest``, the largest turn if it is known (:func:`longest_turn`), keeps a plan small: if it
    shows that there is no longer conversation, the second part is None.

    Columns: ``conv``, ``chunk``, ``first_idx`` (number of the chunk's first pair),
    ``pairs array<struct<q,r>>``, ``n_pairs`` and ``last struct<q,r>`` of the whole
    conversation, and ``order_ok`` under ``quarantine``.

    ``turn`` must number the messages 0, 1, 2 … without gaps; anything else raises. The
    last chunk of a long conversation may hold a lone message and then no pair.
    """
    messages = width * 2
    gathered = df.groupBy(conv, F.expr(f"{turn} div {messages}").alias("chunk")).agg(
        F.expr(f"sort_array(collect_list(struct({turn} as turn, {role} as role, {content} as text)))").alias("m")
    )
    # What rows are kept by is computed from the gathered array, not from the pairs:
    # a filter is pushed below the projection and would build the pairs a second time.
    # The check of the numbering sits in n, which every row's filter reads.
    broken = f"raise_error('{turn} has gaps or repeats in a conversation')"
    dense = f"forall(transform(m, (x, i) -> x.turn = chunk * {messages} + i), in_place -> in_place)"
    chunks = gathered.select(
        conv,
        "chunk",
        F.expr(f"if({dense}, size(m), {broken})").alias("n"),
        F.expr("size(m) div 2").alias("here"),
        F.expr(f"chunk * {width}").alias("first_idx"),
        message_pairs("m", "text").alias("pairs"),
        roles_alternate("m").alias("ok"),
        F.expr("if(size(m) >= 2, m[0].role, null)").alias("ur"),
        F.expr("get(m, 1).role").alias("ar"),
        F.expr(
            """if(size(m) >= 2,
                  struct(m[size(m) - 2 - size(m) % 2].text as q, m[size(m) - 1 - size(m) % 2].text as r), null)"""
        ).alias("last"),
    )
    # One test that needs the gathered size, so it stays above the aggregate and both
    # branches below read the same shuffle.
    whole = f"if(chunk = 0, n, {messages}) < {messages}"
    closed = chunks.filter(f"{whole} and here > 0").selectExpr(
        conv, "chunk", "first_idx", "pairs", "here as n_pairs", "last", "ok as order_ok"
    )
    if longest is not None and longest < messages - 1:
        return apply_order_policy(closed, "order_ok", on_bad_order), None
    parts = chunks.filter(f"not ({whole})")
    totals = parts.groupBy(conv).agg(
        F.expr("min(chunk) = 0 and count(*) = max(chunk) + 1").alias("unbroken"),
        F.expr(f"sum(n) = max(chunk) * {messages} + max_by(n, chunk)").alias("filled"),
        F.expr("max(chunk)").alias("last_chunk"),
        F.expr("sum(here)").alias("n_pairs"),
        F.expr("max_by(last, if(here > 0, chunk, null))").alias("last"),
        F.expr("bool_and(ok) and min(ur) <=> max(ur) and min(ar) <=> max(ar)").alias("order_ok"),
    )
    # Rows without a pair are pruned before their totals are looked at, so broken numbering
    # has a branch of its own: it gives no rows, it only raises.
    guard = totals.filter(f"if(unbroken and filled, false, {broken})").selectExpr(
        conv, "last_chunk as chunk", "last_chunk as first_idx", "array_repeat(last, int(n_pairs)) as pairs", "n_pairs",
        "last", "order_ok",
    )
    totals = totals.selectExpr(
        conv,
        f"if(unbroken and filled, n_pairs, {broken}) as n_pairs",
        "last",
        "order_ok",
        f"explode(sequence(0L, last_chunk div {CHUNKS_PER_KEY})) as _share",
    )
    long_ones = (
        parts.selectExpr(conv, "chunk", "first_idx", "pairs", f"chunk div {CHUNKS_PER_KEY} as _share")
        .join(totals, [conv, "_share"])
        .select(conv, "chunk", "first_idx", "pairs", "n_pairs", "last", "order_ok")
    )
    parts = closed, long_ones.unionByName(guard)
    return tuple(apply_order_policy(part, "order_ok", on_bad_order) for part in parts)


def conversation_chunks(df: DataFrame, *names: str, **options) -> DataFrame:
    """All rows of :func:`conversation_parts`, which takes the same arguments."""
    short, long = conversation_parts(df, *names, **options)
    return short if long is None else short.unionByName(long)


def longest_turn(df: DataFrame, turn: str = "turn") -> int | None:
    """The largest turn, from one column of the table; None if some row has none."""
    seen = df.agg(F.max(turn).alias("top"), F.count_if(F.col(turn).isNull()).alias("missing")).first()
    return None if seen["missing"] else seen["top"]


def pair_rows(chunks: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per (query, response) pair, numbered from 0 within its conversation."""
    return chunks.select(conv, "first_idx", "n_pairs", F.posexplode("pairs").alias("pos", "p")).select(
        conv,
        (F.col("first_idx") + F.col("pos")).alias("idx"),
        "n_pairs",
        F.col("p.q").alias("query"),
        F.col("p.r").alias("response"),
    )


def _is_head() -> Column:
    """The first chunk of a conversation, tested above the aggregate (see above)."""
    return F.expr("if(n_pairs > 0, chunk, null) = 0")


def examples_from_turns(chunks: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One example per conversation, with ``n_pairs``, the pairs of the whole conversation.

    The history of a conversation longer than the chunk width stops at that width. Encoders
    of whole conversations (``supervised_conversations`` and others) take the parts instead,
    and packing takes :func:`conversation_chunks`.
    """
    flag = ["order_ok"] if "order_ok" in chunks.columns else []
    return chunks.filter(_is_head()).selectExpr(
        conv,
        *flag,
        "n_pairs",
        "last.q as prompt",
        "'' as query",
        "last.r as response",
        "if(size(pairs) = n_pairs, slice(pairs, 1, size(pairs) - 1), pairs) as history",
    )


def role_order_report(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role"
) -> DataFrame:
    """Per conversation: number of whole pairs and whether the roles alternate."""
    chunks = conversation_chunks(
        df.withColumn("_none", F.lit("")), conv, turn, role, "_none", on_bad_order="quarantine"
    )
    return chunks.filter(_is_head()).select(conv, "n_pairs", "order_ok")


def index_conversations(
    chunks: DataFrame, conv: str = "conv_id", width: int = CHUNK_PAIRS, key_bits: int = KEY_BITS
) -> DataFrame:
    """Add ``row_idx``: the dense number of the conversation in ``conv`` order."""
    heads = row_index(chunks.filter(_is_head()).select(conv, "n_pairs"), conv, key_bits=key_bits)
    last_chunk = F.expr(f"(n_pairs - 1) div {width}")
    shares = heads.select(
        conv,
        "row_idx",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last_chunk / CHUNKS_PER_KEY))).alias("_share"),
    )
    return (
        chunks.withColumn("_share", F.expr(f"chunk div {CHUNKS_PER_KEY}")).join(shares, [conv, "_share"]).drop("_share")
    )
