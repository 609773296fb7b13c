"""Mixing datasets: concatenation and interleaving, with a dense order key.

All functions work on a *stack*: rows of every dataset with ``source_no`` (place in the
list) and ``row_idx`` (dense within the source). They return a dense ``mix_idx``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .ordering import running_total

STRATEGIES = ("concat", "interleave_under", "interleave_over")
DRAWS = ("pcg64", "md5")
INLINE_CYCLES = 1_000  # repeats of one row produced in place
REPEATS_PER_KEY = 100_000  # slots that may share one copy of a row in a join


def stack(datasets: Sequence[DataFrame]) -> DataFrame:
    """Put datasets (each with ``row_idx``) under each other; missing columns become null."""
    numbered = [df.withColumn("source_no", F.lit(i)) for i, df in enumerate(datasets)]
    out = numbered[0]
    for df in numbered[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def source_sizes(stacked: DataFrame, n_sources: int) -> list[int]:
    """Row count per source: as many numbers as there are datasets."""
    counted = {r["source_no"]: r["n"] for r in stacked.groupBy("source_no").agg(F.count("*").alias("n")).collect()}
    return [counted.get(i, 0) for i in range(n_sources)]


def per_source(values: Sequence[int]) -> Column:
    return F.get(F.array(*[F.lit(int(v)).cast("bigint") for v in values]), F.col("source_no"))


def concat(stacked: DataFrame, sizes: Sequence[int]) -> DataFrame:
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    return stacked.withColumn("mix_idx", per_source(starts) + F.col("row_idx"))


def _round_robin_key(slot: Column, k: int) -> Column:
    return slot * k + F.col("source_no")


def interleave_under(stacked: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Round-robin until the shortest source ends. No row moves for it."""
    return stacked.filter(F.col("row_idx") < min(sizes)).withColumn(
        "mix_idx", _round_robin_key(F.col("row_idx"), len(sizes))
    )


def interleave_over(stacked: DataFrame, sizes: Sequence[int], inline_cycles: int = INLINE_CYCLES) -> DataFrame:
    """Round-robin to the end of the longest source; shorter ones start again.

    A row that comes up a moderate number of times is repeated in place. The rows of a
    very short source would come up without bound, so its slots are generated as rows
    of their own and meet it in a join.
    """
    _no_empty(sizes)
    k, longest = len(sizes), max(sizes)
    short = [i for i, n in enumerate(sizes) if -(-longest // n) > inline_cycles]
    near = stacked.filter(~F.col("source_no").isin(short)) if short else stacked
    out = near.withColumn(
        "_slot", F.explode(F.sequence(F.col("row_idx"), F.lit(longest - 1).cast("bigint"), per_source(sizes)))
    )
    if short:
        spark = stacked.sparkSession
        slots = spark.range(longest * len(short)).select(
            F.get(F.array(*[F.lit(i) for i in short]), F.floor(F.col("id") / longest).cast("int")).alias("source_no"),
            (F.col("id") % longest).alias("_slot"),
        )
        repeats = [-(-longest // n) for n in sizes]
        far = _meet(slots, "_slot", stacked.filter(F.col("source_no").isin(short)), sizes, repeats)
        out = out.unionByName(far)
    return out.withColumn("mix_idx", _round_robin_key(F.col("_slot"), k)).drop("_slot")


def _no_empty(sizes: Sequence[int]) -> None:
    if min(sizes) <= 0:
        raise ValueError("an empty dataset cannot be interleaved")


def _meet(
    slots: DataFrame, draw: str, stacked: DataFrame, sizes: Sequence[int], repeats: Sequence[int],
    per_key: int = REPEATS_PER_KEY,
) -> DataFrame:
    """Join slots to rows by (source, draw mod size).

    A row drawn more than ``per_key`` times gets several copies, and the draws are dealt
    out among them, so no join key holds an unbounded number of slots.
    """
    size = per_source(sizes)
    slots = slots.withColumn("row_idx", F.col(draw) % size).withColumn(
        "_copy", F.floor(F.floor(F.col(draw) / size) / per_key)
    )
    copies = [max(0, (r - 1) // per_key) for r in repeats]
    if any(copies):
        rows = stacked.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), per_source(copies))))
        return slots.join(rows, ["source_no", "row_idx", "_copy"]).drop("_copy")
    return slots.drop("_copy").join(stacked, ["source_no", "row_idx"])


# -- weighted ---------------------------------------------------------------------


def check_strategy(strategy: str) -> None:
    if not strategy.startswith("interleave"):
        raise ValueError(f"Unknown way of mixing {strategy!r}; there are {', '.join(STRATEGIES)}")


def check_probabilities(probabilities: Sequence[float], sizes: Sequence[int], over: bool) -> None:
    if len(probabilities) != len(sizes):
        raise ValueError("there must be one probability per dataset")
    if min(probabilities) < 0 or abs(sum(probabilities) - 1) > 1e-8:
        raise ValueError("probabilities must not be negative and must sum to 1")
    if over and min(probabilities) == 0:
        raise ValueError("a dataset with probability 0 is never exhausted")
    _no_empty(sizes)


def _cumulative(probabilities: Sequence[float]) -> list[float]:
    cdf = np.cumsum(np.asarray(probabilities, dtype=float))
    return [float(x) for x in cdf / cdf[-1]]


def uniform_draws(spark: SparkSession, n_slots: int, seed: int, draws: str = "pcg64", start: int = 0) -> DataFrame:
    """``slot bigint, u double``: one uniform draw per slot from ``start`` on, each a function of (seed, slot).

    ``pcg64`` gives the numbers of NumPy's default generator: every batch jumps ahead to
    its first slot, so tasks need not run in sequence. ``md5`` stays in SQL expressions.
    """
    slots = spark.range(start, start + n_slots).withColumnRenamed("id", "slot")
    if draws == "md5":
        head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("slot").cast("string"))), 1, 8)
        return slots.withColumn("u", F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0))
    if draws != "pcg64":
        raise ValueError(f"draws is one of {DRAWS}")

    def generate(batches):
        for batch in batches:
            if len(batch) == 0:
                continue
            slot = batch["slot"].to_numpy()
            low, high = int(slot.min()), int(slot.max()) + 1
            u = np.random.Generator(np.random.PCG64(seed).advance(low)).random(high - low)
            yield batch.assign(u=u[slot - low])

    return slots.mapInPandas(generate, "slot bigint, u double")


def weighted_slots(
    spark: SparkSession,
    n_slots: int,
    probabilities: Sequence[float],
    seed: int,
    draws: str = "pcg64",
    start: int = 0,
    drawn: Sequence[int] | None = None,
) -> DataFrame:
    """``slot, source_no, draw``: which source each slot takes, and the how-manieth time.

    From slot ``start`` on, if ``drawn`` says how often the slots before took each source.
    """
    cdf = _cumulative(probabilities)
    source = F.lit(len(cdf) - 1)
    for i in reversed(range(len(cdf) - 1)):
        source = F.when(F.col("u") < cdf[i], F.lit(i)).otherwise(source)
    chosen = uniform_draws(spark, n_slots, seed, draws, start).select("slot", source.alias("source_no"))
    counted = running_total(chosen, 1, F.shiftright("slot", 16), ["slot"], "draw", within=["source_no"])
    return counted.withColumn("draw", F.col("draw") + per_source(drawn)) if drawn else counted


def interleave_weighted(
    stacked: DataFrame,
    sizes: Sequence[int],
    probabilities: Sequence[float],
    seed: int,
    over: bool = False,
    draws: str = "pcg64",
) -> DataFrame:
    """Seeded draws choose the source of each slot.

    Stops with the slot that hands out the last row of the first source to run out
    (``over``: of the last one to do so for the first time; sources start again).
    """
    check_probabilities(probabilities, sizes, over)
    spark = stacked.sparkSession
    live = [(n, p) for n, p in zip(sizes, probabilities) if p > 0]
    expected = [(n + 6 * n**0.5 + 50) / p for n, p in live]
    n_slots = int(max(expected) if over else min(expected))
    while True:
        slots = weighted_slots(spark, n_slots, probabilities, seed, draws)
        ends = slots.filter(F.col("draw") == per_source(sizes) - 1)
        found = [r["slot"] for r in ends.select("slot").collect()]  # at most one per source
        if len(found) == len(live) or (not over and found):
            break
        n_slots *= 2
    stop = max(found) if over else min(found)
    used = slots.filter(F.col("slot") <= stop)
    repeats = [-(-(stop + 1) // n) for n in sizes] if over else [1] * len(sizes)
    return _meet(used, "draw", stacked, sizes, repeats).withColumnRenamed("slot", "mix_idx").drop("draw")


def slots_before_any_ends(
    spark: SparkSession, seen: Sequence[int], emitted: Sequence[int], probabilities: Sequence[float], seed: int,
    draws: str = "pcg64",
) -> DataFrame:
    """The slots after those handed out, up to the one that hands out the last row seen of any source.

    ``seen`` and ``emitted`` count rows per source; there are no slots while a source has no row left.
    """
    left = [(n - m, p) for n, m, p in zip(seen, emitted, probabilities) if p > 0]
    start, n_slots = sum(emitted), int(min((n + 6 * n**0.5 + 50) / p for n, p in left))
    if min(n for n, _ in left) <= 0:
        return weighted_slots(spark, 0, probabilities, seed, draws, start, emitted)
    while True:
        slots = weighted_slots(spark, n_slots, probabilities, seed, draws, start, emitted)
        stop = slots.filter(F.col("draw") == per_source(seen) - 1).agg(F.min("slot")).first()[0]
        if stop is not None:
            return slots.filter(F.col("slot") <= stop)
        n_slots *= 2


def mix(
    stacked: DataFrame,
    n_sources: int,
    strategy: str = "concat",
    probabilities: Sequence[float] | None = None,
    seed: int = 42,
    draws: str = "pcg64",
) -> DataFrame:
    """Mix by strategy name. One dataset passes through; an unknown name raises.

    The result's ``row_idx`` is the order in the mixture.
    """
    if n_sources == 1:
        return stacked.drop("source_no")
    if strategy != "concat":
        check_strategy(strategy)
    sizes = source_sizes(stacked, n_sources)
    over = not strategy.endswith("under")
    if strategy == "concat":
        mixed = concat(stacked, sizes)
    elif probabilities is not None:
        mixed = interleave_weighted(stacked, sizes, probabilities, seed, over, draws)
    elif over:
        mixed = interleave_over(stacked, sizes)
    else:
        mixed = interleave_under(stacked, sizes)
    return mixed.drop("row_idx", "source_no").withColumnRenamed("mix_idx", "row_idx")
