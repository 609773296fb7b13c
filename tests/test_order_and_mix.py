import hashlib
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sftprep.operators import mixing, ordering, split

from . import plain


def test_row_index(spark):
    keys = random.Random(1).sample(range(-300_000, 300_000), 400) + [2**40, 2**40 + 1]
    df = spark.createDataFrame([(k, k % 3) for k in keys], "k bigint, g bigint").repartition(5)
    got = {r.k: r.row_idx for r in ordering.row_index(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    within = {(r.g, r.k): r.row_idx for r in ordering.row_index(df, "k", ["g"]).collect()}
    for g in range(3):
        members = sorted(k for k in keys if k % 3 == g)
        assert [within[g, k] for k in members] == list(range(len(members)))


def test_first_by_key(spark):
    keys = random.Random(2).sample(range(-200_000, 200_000), 300)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    for n in (0, 1, 150, 299, 300, 301):
        assert sorted(r.k for r in ordering.first_by_key(df, "k", n).collect()) == sorted(keys)[:n]
    with pytest.raises(ValueError):
        ordering.first_by_key(df, "k", -1)


def test_file_index_beyond_the_broadcast_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordering, "BROADCAST_ROWS", 1)
    spark.range(0, 100, 1, 4).write.parquet(str(tmp_path / "p"))
    assert all(r.id == r.row_idx for r in ordering.file_index(spark.read.parquet(str(tmp_path / "p"))).collect())


def test_row_index_needs_no_single_task(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    plan = ordering.row_index(df, "k")._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) <= 1  # the block table only


def test_keys_far_apart(spark, monkeypatch):
    keys = [i << 40 for i in range(-700, 700)] + [5, 2**62, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(k, k % 2) for k in keys], "k bigint, g bigint").repartition(5)
    want = {k: i for i, k in enumerate(sorted(keys))}
    for bits in (64, 16):  # fewer bits than keys take cost room only
        assert {r.k: r.row_idx for r in ordering.row_index(df, "k", key_bits=bits).collect()} == want
    odd = sorted(k for k in keys if k % 2)
    got = ordering.row_index(df, "k", ["g"]).filter("g = 1").orderBy("k").collect()
    assert [(r.k, r.row_idx) for r in got] == [(k, i) for i, k in enumerate(odd)]
    assert [ordering.key_cut(df, "k", n) for n in (1, 3, 701, 1404, 1405)] == [*[sorted(keys)[n - 1] for n in (1, 3, 701, 1404)], None]
    plan = ordering.row_index(df, "k")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 4 and sum(w.count("], [") == 2 for w in windows) == 3  # the root alone has no partition
    seen = []
    monkeypatch.setattr(ordering, "_block_offsets", lambda t, w, bits, real=ordering._block_offsets: (
        seen.append((bits, t.groupBy(F.shiftright("_block", 16)).count().agg(F.max("count")).first()[0])), real(t, w, bits))[1])
    ordering.row_index(df, "k").count()
    assert [bits for bits, _ in seen] == [48, 32, 16] and max(n for _, n in seen) <= 65_536


def test_range_index_with_many_ties(spark):
    df = spark.createDataFrame([(i % 3, f"t{i:03d}") for i in range(300)], "n int, t string").repartition(7)
    got = {r.t: r.row_idx for r in ordering.range_index(df, F.col("n").desc(), F.col("t")).collect()}
    want = sorted(((-(i % 3)), f"t{i:03d}") for i in range(300))
    assert got == {t: i for i, (_, t) in enumerate(want)}


def test_file_and_scan_index(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), F.concat(F.lit("line "), "id").alias("value"))
    spread = df.repartitionByRange(5, "id").sortWithinPartitions("id")
    spread.write.parquet(str(tmp_path / "p"))
    got = ordering.file_index(spark.read.parquet(str(tmp_path / "p")))
    assert all(r.id == r.row_idx for r in got.collect()) and got.count() == 1000
    spread.select("value").write.text(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # several blocks per file
    try:
        got = ordering.scan_index(spark.read.text(str(tmp_path / "t"))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.row_idx: r.value for r in got} == {i: f"line {i}" for i in range(1000)}


@pytest.mark.parametrize("final", [10_000, 3])
def test_cut(spark, monkeypatch, final):
    monkeypatch.setattr(ordering, "FINAL_ROWS", final)
    monkeypatch.setattr(ordering, "PREFIX_STEP", 1)
    df = spark.range(500).withColumn("h", ordering.seeded_hash(7, "id"))
    ranked = sorted((hashlib.md5(f"7:{i}".encode()).hexdigest(), i) for i in range(500))
    for k in (1, 17, 499, 500):
        total, n, cut = ordering.smallest_cut(df, "h", "id", lambda _: k)
        assert (total, n, cut) == (500, k, ranked[k - 1])
    assert ordering.smallest_cut(df, "h", "id", lambda _: 0)[2] is None
    with pytest.raises(ValueError):
        ordering.smallest_cut(df, "h", "id", lambda _: 501)
    same = spark.range(40).select(F.lit(3).alias("id")).withColumn("h", ordering.seeded_hash(7, "id"))
    with pytest.raises(ValueError, match="unique"):
        ordering.smallest_cut(same, "h", "id", lambda _: 20)


@pytest.mark.parametrize("val_size,n", [(0.1, 21), (0.5, 101), (2, 2), (50, 50)])
def test_split(spark, val_size, n):
    df = spark.range(201).withColumnRenamed("id", "row_idx")
    parts = split.split_train_eval(df, val_size, seed=3)
    train, ev = ({r.row_idx for r in parts[p].collect()} for p in ("train", "eval"))
    assert len(ev) == n and not train & ev and train | ev == set(range(201))
    again = split.split_train_eval(df.repartition(6), val_size, seed=3)
    assert {r.row_idx for r in again["eval"].collect()} == ev
    assert {r.row_idx for r in split.split_train_eval(df, val_size, seed=4)["eval"].collect()} != ev
    assert "Exchange" not in parts["train"]._jdf.queryExecution().executedPlan().toString()


def test_split_corner_cases(spark):
    df = spark.range(5).withColumnRenamed("id", "row_idx")
    assert list(split.split_train_eval(df, 0)) == ["train"]
    assert list(split.split_train_eval(df, 0.5, do_train=False)) == ["eval"]
    for bad in (1, 5, 9):
        with pytest.raises(ValueError):
            split.split_train_eval(df, bad)


def test_shuffles(spark):
    df = spark.range(100).withColumnRenamed("id", "row_idx")
    got = split.buffer_shuffle(df, 16, 5).collect()
    assert sorted(r.shuffled_idx for r in got) == list(range(100))
    assert all(r.shuffled_idx // 16 == r.row_idx // 16 for r in got)
    assert any(r.shuffled_idx != r.row_idx for r in got)
    full = [r.row_idx for r in split.full_shuffle(df, 5).collect()]
    assert full != sorted(full) and sorted(full) == list(range(100))


# -- mixing -----------------------------------------------------------------------


def sources(spark, sizes):
    frames = [
        spark.range(n).select(F.col("id").alias("row_idx"), F.concat(F.lit("abcdef"[i]), "id").alias("name"))
        for i, n in enumerate(sizes)
    ]
    return mixing.stack(frames)


def names(df):
    rows = sorted((r.row_idx, r.name) for r in df.collect())
    assert [i for i, _ in rows] == list(range(len(rows)))
    return [n for _, n in rows]


def test_round_robin(spark):
    stacked = sources(spark, [5, 3, 4])
    assert names(mixing.mix(stacked, 3, "interleave_under")) == "a0 b0 c0 a1 b1 c1 a2 b2 c2".split()
    want = "a0 b0 c0 a1 b1 c1 a2 b2 c2 a3 b0 c3 a4 b1 c0".split()
    assert names(mixing.mix(stacked, 3, "interleave_over")) == want
    assert names(mixing.mix(stacked, 3)) == "a0 a1 a2 a3 a4 b0 b1 b2 c0 c1 c2 c3".split()


@pytest.mark.parametrize("inline,per_key", [(1, 100_000), (1, 2), (3, 1), (1000, 5)])
def test_very_short_sources_repeat_by_join(spark, monkeypatch, inline, per_key):
    monkeypatch.setattr(mixing, "_meet", lambda *a, _m=mixing._meet, **k: _m(*a, per_key=per_key))
    sizes = [23, 1, 2, 11]
    got = mixing.interleave_over(sources(spark, sizes), sizes, inline_cycles=inline)
    got = names(got.drop("row_idx").withColumnRenamed("mix_idx", "row_idx"))
    assert got == [f"{'abcd'[s]}{i % sizes[s]}" for i in range(23) for s in range(4)]


def md5_uniform(seed):
    return lambda slot: int(hashlib.md5(f"{seed}:{slot}".encode()).hexdigest()[:8], 16) / 4294967296


def library_uniform(seed):
    """The library's own way: chunks of 1000 draws from one generator."""
    rng, drawn = np.random.default_rng(seed), []

    def u(slot):
        while slot >= len(drawn):
            drawn.extend(rng.random(1000))
        return drawn[slot]

    return u


@pytest.mark.parametrize("draws", ["md5", "pcg64"])
@pytest.mark.parametrize("over", [False, True])
@pytest.mark.parametrize("sizes,shares", [([40, 11, 20], [0.5, 0.2, 0.3]), ([3, 300], [0.6, 0.4])])
def test_weighted(spark, draws, over, sizes, shares):
    uniform = (md5_uniform if draws == "md5" else library_uniform)(9)
    want = [f"{'abc'[s]}{i}" for s, i in plain.weighted(uniform, sizes, shares, over)]
    strategy = "interleave_over" if over else "interleave_under"
    assert names(mixing.mix(sources(spark, sizes), len(sizes), strategy, shares, 9, draws)) == want


def test_draws_are_those_of_choice(spark):
    """Chunked choice() with probabilities, as the public library draws its sources."""
    shares = [0.3, 0.05, 0.65]
    rng = np.random.default_rng(42)
    want = [int(i) for _ in range(3) for i in rng.choice(3, size=1000, p=shares)]
    rows = mixing.weighted_slots(spark, 3000, shares, 42).orderBy("slot").collect()
    assert [r.source_no for r in rows] == want


def test_hot_rows_in_weighted_mixing(spark, monkeypatch):
    sizes, shares = [2, 200], [0.7, 0.3]
    want = [f"{'ab'[s]}{i}" for s, i in plain.weighted(md5_uniform(1), sizes, shares, True)]
    monkeypatch.setattr(mixing, "_meet", lambda *a, _m=mixing._meet, **k: _m(*a, per_key=7))
    assert names(mixing.mix(sources(spark, sizes), 2, "interleave_over", shares, 1, "md5")) == want


def test_mixing_guards(spark):
    stacked = sources(spark, [3, 2])
    with pytest.raises(ValueError, match="Unknown"):
        mixing.mix(stacked, 2, "shuffle")
    for bad in ([0.5], [0.5, 0.6], [-0.5, 1.5]):
        with pytest.raises(ValueError):
            mixing.mix(stacked, 2, "interleave_under", bad)
    with pytest.raises(ValueError, match="never"):
        mixing.mix(stacked, 2, "interleave_over", [0, 1])
    assert names(mixing.mix(stacked, 2, "interleave_under", [0, 1], 1)) == ["b0", "b1"]
    with pytest.raises(ValueError, match="empty"):
        mixing.mix(sources(spark, [3, 0]), 2, "interleave_over")
    assert mixing.mix(sources(spark, [3]), 1, "anything").count() == 3


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(1, 9), min_size=2, max_size=4))
def test_round_robin_lengths(spark, sizes):
    stacked = sources(spark, sizes)
    assert mixing.mix(stacked, len(sizes), "interleave_under").count() == len(sizes) * min(sizes)
    assert mixing.mix(stacked, len(sizes), "interleave_over").count() == len(sizes) * max(sizes)
