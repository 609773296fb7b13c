"""Examples to token ids and loss labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.templates import (
    ChatTemplate,
    assemble_turns,
    conversation_turns,
    id_array,
    system_or_default,
    text_units,
)
from ..functions.tokenizers import IGNORE_INDEX, Tokenizer
from .normalize import full_query
from .ordering import running_total
from .turns import CHUNK_PAIRS, examples_from_turns

MODES = ("sft", "packed", "predict", "pairwise")


def check_request(template: ChatTemplate, train_on_prompt: bool = False) -> None:
    if train_on_prompt and template.efficient_eos:
        raise ValueError("train_on_prompt needs a template that ends every turn with eos")


def check_shortened(template: ChatTemplate, tokenizer: Tokenizer, cutoff_len: int, width: int = CHUNK_PAIRS) -> None:
    """Is a history that stops after ``width`` pairs long enough for this cutoff?"""
    if not 3 <= cutoff_len <= width:
        raise ValueError(f"cutoff_len must lie in 3..{width} for examples taken from a turn table")
    if not template.always_emits(tokenizer.special):
        raise ValueError("a template that may emit nothing for a pair needs whole message arrays")


# -- validity ---------------------------------------------------------------------


def valid_for_sft(df: DataFrame) -> DataFrame:
    if "response" not in df.columns:
        if "responses" in df.columns:  # ranked answers are not a text: no row is usable here
            return df.withColumn("response", F.lit(None).cast("string")).filter(F.lit(False))
        raise ValueError("there is no response column to train on")
    return df.filter((full_query(df) != "") & (F.col("response") != ""))


def valid_for_predict(df: DataFrame) -> DataFrame:
    return df.filter(full_query(df) != "")


def valid_for_pairwise(df: DataFrame) -> DataFrame:
    if "responses" not in df.columns:
        raise ValueError("preference data needs a list of responses")
    return df.filter((full_query(df) != "") & (F.size("responses") > 1))


# -- turns ------------------------------------------------------------------------


def without_nulls(turns: str) -> Column:
    """The turns, or an error if a text is null. Part of the value, so it cannot be pruned."""
    missing = F.exists(turns, lambda t: t["q"].isNull() | t["r"].isNull())
    return F.when(missing, F.raise_error(F.lit("a conversation holds a null text"))).otherwise(F.col(turns))


def _encoded_turns(
    df: DataFrame,
    template: ChatTemplate,
    tokenizer: Tokenizer,
    turns: Column,
    keep: Sequence[str],
    first_idx: Column | int = 0,
) -> DataFrame:
    """Add ``enc array<struct<src,tgt>>`` (lists of id arrays): texts first, then one tokenizer call, then assembly."""
    system = F.col("system") if "system" in df.columns else None
    at = first_idx if isinstance(first_idx, int) else F.col("_first")
    base = df.select(
        *keep,
        turns.alias("_given"),
        system_or_default(template, system).alias("_system"),
        *([] if isinstance(first_idx, int) else [first_idx.alias("_first")]),
    )
    first = [] if isinstance(first_idx, int) else ["_first"]
    base = base.select(*keep, *first, "_system", without_nulls("_given").alias("_turns"))
    units = base.select(
        *keep,
        *first,
        "_turns",
        tokenizer.encode_units(text_units(template, F.col("_turns"), F.col("_system"), at)).alias("_units"),
    )
    return units.select(
        *keep, *first, assemble_turns(template, tokenizer, F.col("_turns"), F.col("_units"), at).alias("enc")
    )


def example_turns(df: DataFrame, template: ChatTemplate, response: Column) -> Column:
    return conversation_turns(
        template, full_query(df), response, F.col("history") if "history" in df.columns else None
    )


def _share(cutoff_len: int, part: Column, total: Column) -> Column:
    """``int(cutoff * (part / total))``: keep this order of floating-point steps."""
    return (F.lit(cutoff_len) * (part / total)).cast("int")


def _length(parts: Column) -> Column:
    """Number of ids in a list of id arrays."""
    return F.aggregate(parts, F.lit(0), lambda n, p: n + F.size(p))


def _first(parts: Column, length: Column, limit: Column) -> Column:
    """The list cut to ``limit`` ids; only lists that are too long are joined for it."""
    return F.when(length > limit, F.array(F.slice(F.flatten(parts), F.lit(1), limit))).otherwise(parts)


def _mask(
    src: Column, n: Column, idx: Column, template: ChatTemplate, eos_id: int, train_on_prompt: bool, strict_align: bool
) -> Column:
    """Labels of a source of ``n`` ids, as a list of arrays."""
    if train_on_prompt:
        return src
    ignored = F.array(F.array_repeat(F.lit(IGNORE_INDEX), n))
    if not template.efficient_eos:
        return ignored
    after_eos = F.array(id_array([eos_id]), F.array_repeat(F.lit(IGNORE_INDEX), n - 1))
    later = (idx != 0) & (n > 0) if strict_align else idx != 0
    return F.when(later, after_eos).otherwise(ignored)


def _joined(pieces: str, tail: list[int]) -> Column:
    """All ids of the turns and a constant end, copied once."""
    lists = F.flatten(pieces)
    return F.flatten(F.concat(lists, F.array(id_array(tail))) if tail else lists)


def _cut_turns(
    enc: DataFrame,
    keep: Sequence[str],
    template: ChatTemplate,
    eos: int,
    cutoff_len: int,
    train_on_prompt: bool,
    strict_align: bool,
    first_idx: Column | int = 0,
) -> DataFrame:
    """Ids and labels of each turn, cut in proportion to its two sides, as ``_pieces``."""

    def measured(t: Column) -> Column:
        return F.struct(t["src"].alias("src"), t["tgt"].alias("tgt"), _length(t["src"]).alias("s"), _length(t["tgt"]).alias("r"))

    def piece(t: Column, i: Column) -> Column:
        total = t["s"] + t["r"]
        most_s, most_r = _share(cutoff_len, t["s"], total), _share(cutoff_len, t["r"], total)
        src, tgt = _first(t["src"], t["s"], most_s), _first(t["tgt"], t["r"], most_r)
        mask = _mask(src, F.least(t["s"], most_s), i + first_idx, template, eos, train_on_prompt, strict_align)
        return F.struct(F.concat(src, tgt).alias("ids"), F.concat(mask, tgt).alias("labels"))

    return enc.select(*keep, F.transform(F.transform("enc", measured), piece).alias("_pieces"))


def supervised(
    df: DataFrame,
    template: ChatTemplate,
    tokenizer: Tokenizer,
    cutoff_len: int = 1024,
    train_on_prompt: bool = False,
    strict_align: bool = False,
    keep: Sequence[str] = ("row_idx",),
) -> DataFrame:
    """``input_ids, attention_mask, labels``; every turn is cut in proportion to its two sides.

    ``strict_align`` leaves out the one label too many that a later turn gets when its
    source is cut to nothing.
    """
    check_request(template, train_on_prompt)
    eos = tokenizer.special.eos_id
    rows = valid_for_sft(df)
    enc = _encoded_turns(rows, template, tokenizer, example_turns(rows, template, F.col("response")), keep)

    pieces = _cut_turns(enc, keep, template, eos, cutoff_len, train_on_prompt, strict_align)
    tail = [eos] if template.efficient_eos else []
    joined = pieces.select(
        *keep, _joined("_pieces.ids", tail).alias("_ids"), _joined("_pieces.labels", tail).alias("_labels")
    )
    return _cut_ids(joined, F.size("_ids") > cutoff_len, cutoff_len, keep)


def _cut_ids(joined: DataFrame, long: Column, cutoff_len: int, keep: Sequence[str]) -> DataFrame:
    """Both lists are cut if the ids are too long, and neither if not."""
    return joined.select(
        *keep,
        F.when(long, F.slice("_ids", 1, cutoff_len)).otherwise(F.col("_ids")).alias("input_ids"),
        F.array_repeat(F.lit(1), F.least(F.size("_ids"), F.lit(cutoff_len))).alias("attention_mask"),
        F.when(long, F.slice("_labels", 1, cutoff_len)).otherwise(F.col("_labels")).alias("labels"),
    )


def predict(
    df: DataFrame,
    template: ChatTemplate,
    tokenizer: Tokenizer,
    cutoff_len: int = 1024,
    null_response: str = "raise",
    keep: Sequence[str] = ("row_idx",),
) -> DataFrame:
    """``input_ids`` = everything up to the last answer, ``labels`` = that answer; each cut on its own."""
    if null_response not in ("raise", "empty"):
        raise ValueError("null_response is 'raise' or 'empty'")
    if "response" not in df.columns:
        raise ValueError("prediction data needs a response column with one text per row")
    rows = valid_for_predict(df)
    response = F.col("response")
    if null_response == "empty":
        response = F.coalesce(response, F.lit(""))
    enc = _encoded_turns(rows, template, tokenizer, example_turns(rows, template, response), keep)
    labels = F.element_at("enc", -1)["tgt"]
    if template.efficient_eos:
        labels = F.concat(labels, F.array(id_array([tokenizer.special.eos_id])))
    labels = F.flatten(labels)
    return enc.select(
        *keep, F.slice(one_turn_prompt(F.col("enc")), 1, cutoff_len).alias("input_ids"),
        F.slice(labels, 1, cutoff_len).alias("labels"),
    ).select(*keep, "input_ids", F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask"), "labels")


def one_turn_prompt(enc: Column) -> Column:
    """All ids before the last answer."""
    earlier = F.slice(enc, F.lit(1), F.size(enc) - 1)
    lists = F.flatten(F.transform(earlier, lambda t: F.concat(t["src"], t["tgt"])))
    return F.flatten(F.concat(lists, F.element_at(enc, -1)["src"]))


# -- conversations of any length --------------------------------------------------


def _reaching(long: DataFrame, template: ChatTemplate, tokenizer: Tokenizer, cutoff_len: int, other: Column) -> DataFrame:
    """Chunks that may lie below the cutoff: each pair before yields a token, if the template always does."""
    if not template.always_emits(tokenizer.special):
        return long
    return long.filter((F.col("first_idx") < cutoff_len) | other)


def _within_budget(pieces: DataFrame, conv: str, cutoff_len: int, lists: Sequence[str], *others: Column) -> DataFrame:
    """One row per conversation: its chunks' ``lists`` joined in order, from chunks that begin
    below the cutoff; ``_total``, the ids of all chunks, and ``others``.

    ``pieces`` holds ``chunk``, its number of ids ``n`` and lists of at most ``cutoff_len`` ids.
    Totals run over narrow block sums, and what is gathered is bounded by the cutoff.
    """
    block = F.floor(F.col("chunk") / CHUNK_PAIRS)
    placed = running_total(pieces, F.col("n"), block, ["chunk"], "_start", [conv])
    part = F.when(F.col("_start") < cutoff_len, F.struct("chunk", *lists))
    gathered = placed.groupBy(conv).agg(
        F.sort_array(F.collect_list(part)).alias("_parts"), F.max(F.col("_start") + F.col("n")).alias("_total"), *others
    )
    return gathered.select("*", *[F.flatten(f"_parts.{x}").alias(f"_{x}") for x in lists]).drop("_parts")


def supervised_conversations(
    parts: tuple[DataFrame, DataFrame | None],
    template: ChatTemplate,
    tokenizer: Tokenizer,
    cutoff_len: int = 1024,
    train_on_prompt: bool = False,
    strict_align: bool = False,
    conv: str = "conv_id",
) -> DataFrame:
    """:func:`supervised` for ``conversation_parts``, with any number of messages and any cutoff.

    A long conversation is encoded chunk by chunk; its chunks count against the cutoff from
    its start, and only those that begin below it meet in one row.
    """
    short, long = parts
    options = (template, tokenizer, cutoff_len, train_on_prompt, strict_align)
    brief = supervised(examples_from_turns(short, conv), *options, keep=(conv,))
    if long is None:
        return brief
    eos = tokenizer.special.eos_id
    valid = long.filter((F.col("last.q") != "") & (F.col("last.r") != ""))
    rows = _reaching(valid, template, tokenizer, cutoff_len, F.lit(False))
    keep = (conv, "chunk", "n_pairs", "_end")
    rows = rows.withColumn("_end", F.col("first_idx") + F.size("pairs"))
    enc = _encoded_turns(rows, template, tokenizer, F.col("pairs"), keep, F.col("first_idx"))
    cut = _cut_turns(enc, keep, template, eos, cutoff_len, train_on_prompt, strict_align, F.col("_first"))
    pieces = cut.select(*keep, _joined("_pieces.ids", []).alias("ids"), _joined("_pieces.labels", []).alias("labels"))
    over = F.size("ids") > cutoff_len
    pieces = pieces.select(
        *keep,
        F.size("ids").alias("n"),
        *[F.when(over, F.slice(x, 1, cutoff_len)).otherwise(F.col(x)).alias(x) for x in ("ids", "labels")],
    )
    left_out = (F.max("n_pairs") - F.max("_end")).alias("_left_out")  # pairs, of a token or more each
    whole = _within_budget(pieces, conv, cutoff_len, ("ids", "labels"), left_out)
    tail = [eos] if template.efficient_eos else []
    too_long = F.col("_total") + F.col("_left_out") + len(tail) > cutoff_len
    if tail:
        whole = whole.withColumns({x: F.concat(x, id_array(tail)) for x in ("_ids", "_labels")})
    return brief.unionByName(_cut_ids(whole, too_long, cutoff_len, (conv,)))


def predict_conversations(
    parts: tuple[DataFrame, DataFrame | None],
    template: ChatTemplate,
    tokenizer: Tokenizer,
    cutoff_len: int = 1024,
    null_response: str = "raise",
    conv: str = "conv_id",
) -> DataFrame:
    """:func:`predict` for ``conversation_parts``, with any number of messages and any cutoff."""
    short, long = parts
    brief = predict(examples_from_turns(short, conv), template, tokenizer, cutoff_len, null_response, keep=(conv,))
    if long is None:
        return brief
    rows = long.filter(F.col("last.q") != "").withColumn(
        "_last", (F.size("pairs") > 0) & (F.col("first_idx") + F.size("pairs") == F.col("n_pairs"))
    )
    rows = _reaching(rows, template, tokenizer, cutoff_len, F.col("_last"))
    turns = F.col("pairs")
    if null_response == "empty":
        answered = F.struct(F.col("last.q").alias("q"), F.coalesce("last.r", F.lit("")).alias("r"))
        turns = F.when(F.col("_last"), F.concat(F.slice("pairs", F.lit(1), F.size("pairs") - 1), F.array(answered))).otherwise(turns)
    keep = (conv, "chunk", "_last")
    enc = _encoded_turns(rows, template, tokenizer, turns, keep, F.col("first_idx"))
    tail = F.array(id_array([tokenizer.special.eos_id] if template.efficient_eos else []))
    ids = F.when(F.col("_last"), one_turn_prompt(F.col("enc"))).otherwise(
        F.flatten(F.flatten(F.transform("enc", lambda t: F.concat(t["src"], t["tgt"]))))
    )
    answer = F.when(F.col("_last"), F.slice(F.flatten(F.concat(F.element_at("enc", -1)["tgt"], tail)), 1, cutoff_len))
    pieces = enc.select(*keep, ids.alias("ids"), answer.alias("labels")).select(
        conv, "chunk", F.size("ids").alias("n"), F.slice("ids", 1, cutoff_len).alias("ids"), "labels"
    )
    whole = _within_budget(pieces, conv, cutoff_len, ("ids",), F.first("labels", ignorenulls=True).alias("labels"))
    whole = whole.select(conv, F.slice("_ids", 1, cutoff_len).alias("input_ids"), "labels")
    ones = F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask")
    return brief.unionByName(whole.select(conv, "input_ids", ones, "labels"))


def pairwise(
    df: DataFrame,
    template: ChatTemplate,
    tokenizer: Tokenizer,
    cutoff_len: int = 1024,
    keep: Sequence[str] = ("row_idx",),
) -> DataFrame:
    """``prompt_ids, chosen_ids, rejected_ids``, cut in proportion to prompt and longer answer.

    The prompt is encoded once: the rejected answer rides along as one more text.
    """
    rows = valid_for_pairwise(df)
    turns = example_turns(rows, template, F.get("responses", F.lit(0)))
    rows = rows.withColumn("_rejected", F.get("responses", F.lit(1)))
    system = F.col("system") if "system" in df.columns else None
    base = rows.select(
        *keep, turns.alias("_turns"), system_or_default(template, system).alias("_system"), "_rejected"
    )
    texts = F.concat(text_units(template, F.col("_turns"), F.col("_system")), F.array("_rejected"))
    units = base.select(*keep, "_turns", tokenizer.encode_units(texts).alias("_units"))
    enc = units.select(
        *keep,
        assemble_turns(template, tokenizer, F.col("_turns"), F.col("_units")).alias("enc"),
        F.element_at("_units", -1).alias("_rejected"),
    )
    # every answer ends in eos: per turn, or once at the end
    eos = F.array(F.lit(tokenizer.special.eos_id))
    chosen = F.flatten(F.element_at("enc", -1)["tgt"])
    sides = enc.select(
        *keep,
        one_turn_prompt(F.col("enc")).alias("p"),
        (F.concat(chosen, eos) if template.efficient_eos else chosen).alias("c"),
        F.concat("_rejected", eos).alias("r"),
    )
    answer = F.greatest(F.size("c"), F.size("r"))
    total = F.size("p") + answer
    sides = sides.select(
        *keep, "p", "c", "r",
        _share(cutoff_len, F.size("p"), total).alias("_ps"), _share(cutoff_len, answer, total).alias("_as"),
    )
    return sides.select(
        *keep,
        F.slice("p", F.lit(1), F.col("_ps")).alias("prompt_ids"),
        F.slice("c", F.lit(1), F.col("_as")).alias("chosen_ids"),
        F.slice("r", F.lit(1), F.col("_as")).alias("rejected_ids"),
    )


def training_pieces(
    df: DataFrame,
    template: ChatTemplate,
    tokenizer: Tokenizer,
    turns: Column,
    train_on_prompt: bool = False,
    keep: Sequence[str] = ("row_idx",),
    first_idx: Column | int = 0,
) -> DataFrame:
    """Uncut ids and labels of a row (or of one chunk of a conversation), for packing."""
    check_request(template, train_on_prompt)
    eos = tokenizer.special.eos_id
    enc = _encoded_turns(df, template, tokenizer, turns, keep, first_idx)
    at = first_idx if isinstance(first_idx, int) else F.col("_first")

    def piece(t: Column, i: Column) -> Column:
        mask = _mask(t["src"], _length(t["src"]), i + at, template, eos, train_on_prompt, False)
        return F.struct(F.concat(t["src"], t["tgt"]).alias("ids"), F.concat(mask, t["tgt"]).alias("labels"))

    return enc.select(*keep, F.transform("enc", piece).alias("_pieces")).select(
        *keep, _joined("_pieces.ids", []).alias("ids"), _joined("_pieces.labels", []).alias("labels")
    )
