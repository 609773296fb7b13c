"""Raw rows to one example shape: prompt, query, response(s), history, system."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.templates import TURNS_TYPE

CANONICAL = ("prompt", "query", "response", "responses", "history", "system")
ON_BAD_ORDER = ("raise", "drop", "quarantine")
BAD_ORDER = "the messages of a conversation must alternate (u/a/u/a), beginning with the user"


def rename_columns(df: DataFrame, mapping: Mapping[str, str | None], keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical name -> source column. Unmapped columns that already bear a canonical
    name are kept too; everything else is dropped."""
    chosen: dict[str, str] = {}
    for target in CANONICAL:
        source = mapping.get(target)
        if source is None:
            if target in df.columns and target not in mapping.values():
                chosen[target] = target
            continue
        if source not in df.columns:
            raise ValueError(f"column {source!r} (for {target!r}) is not among {df.columns}")
        chosen[target] = source
    return df.select(*[c for c in keep if c in df.columns], *[F.col(s).alias(t) for t, s in chosen.items()])


def pairs_from_lists(history: Column) -> Column:
    """On-disk ``array<array<string>>`` history to ``array<struct<q,r>>``."""
    return F.transform(history, lambda h: F.struct(F.get(h, F.lit(0)).alias("q"), F.get(h, F.lit(1)).alias("r")))


def message_pairs(messages: str, content: str = "content") -> Column:
    """Consecutive messages as ``array<struct<q,r>>``; an odd last message is left out."""
    return F.expr(
        f"""transform(
          if(size({messages}) >= 2, sequence(0, size({messages}) - 2 - size({messages}) % 2, 2), array()),
          k -> struct(get({messages}, k).`{content}` as q, get({messages}, k + 1).`{content}` as r))"""
    )


def roles_alternate(messages: str, role: str = "role") -> Column:
    """The first pair fixes the two role names; every later whole pair must repeat them.

    Looks at the roles alone: rows are filtered by it, and a filter is pushed below the
    projection that builds the pairs.
    """
    return F.expr(
        f"""forall(
          transform(slice({messages}, 1, size({messages}) - size({messages}) % 2),
                    (x, i) -> x.`{role}` <=> get({messages}, i % 2).`{role}`),
          same -> same)"""
    )


def apply_order_policy(df: DataFrame, ok: str, policy: str) -> DataFrame:
    """What happens to conversations whose roles do not alternate.

    The raising form is a filter on purpose: an unused check column would be pruned.
    """
    if policy not in ON_BAD_ORDER:
        raise ValueError(f"on_bad_order is one of {ON_BAD_ORDER}")
    if policy == "quarantine":
        return df
    if policy == "drop":
        return df.filter(F.col(ok)).drop(ok)
    return df.filter(F.when(F.col(ok), F.lit(True)).otherwise(F.raise_error(F.lit(BAD_ORDER)).cast("boolean"))).drop(ok)


def quarantined(df: DataFrame, ok: str = "order_ok") -> tuple[DataFrame, DataFrame]:
    """The good rows and the bad ones."""
    return df.filter(F.col(ok)).drop(ok), df.filter(~F.col(ok)).drop(ok)


def examples_from_messages(
    df: DataFrame,
    messages: str = "conversations",
    role: str = "from",
    content: str = "value",
    on_bad_order: str = "raise",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Message arrays (one conversation per row) to examples. Conversations without a
    whole pair are dropped; so are all source columns but ``keep``."""
    messages = f"`{messages}`"
    kept = df.filter(F.size(F.col(messages)) >= 2).withColumn("order_ok", roles_alternate(messages, role))
    kept = apply_order_policy(kept, "order_ok", on_bad_order)
    flag = ["order_ok"] if on_bad_order == "quarantine" else []
    paired = kept.select(*keep, *flag, message_pairs(messages, content).alias("_pairs"))
    last = F.element_at("_pairs", -1)
    return paired.select(
        *keep,
        *flag,
        last["q"].alias("prompt"),
        F.lit("").alias("query"),
        last["r"].alias("response"),
        F.slice("_pairs", F.lit(1), F.size("_pairs") - 1).alias("history"),
    )


def full_query(df: DataFrame) -> Column:
    """Prompt, and the query on a line of its own if there is one."""
    prompt = F.col("prompt")
    if "query" not in df.columns:
        return prompt
    extra = F.coalesce(F.col("query"), F.lit(""))
    return F.when(extra != "", F.concat(prompt, F.lit("\n"), extra)).otherwise(prompt)


def with_system(df: DataFrame, system_prompt: str | None) -> DataFrame:
    """A constant system text for one dataset; an empty one leaves the column alone."""
    return df.withColumn("system", F.lit(system_prompt)) if system_prompt else df


def spread_system_prompts(system_prompt: str | None, n_datasets: int) -> list[str | None]:
    """``|``-separated texts dealt to the datasets in turn, each equally often."""
    given = system_prompt.split("|") if system_prompt else [None]
    if n_datasets % len(given):
        raise AssertionError(f"{len(given)} system texts cannot be dealt evenly to {n_datasets} datasets")
    return [given[i % len(given)] for i in range(n_datasets)]


def empty_history() -> Column:
    return F.lit([]).cast(TURNS_TYPE)
