"""N-gram join, importance resampling and hard negatives."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sftprep.llm import hard_negatives, ngram_join, resampling, shingles
from sftprep.llm.divide_skip import InvertedLists, divide_skip
from sftprep.llm.queries import QUERIES

from .cases import odd_texts, prose, table
from .test_groups import edited, plain_components

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def checkpoint_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


# -- n-gram join --------------------------------------------------------------------


def joined(rows):
    """Per id the sorted (size, component) pairs."""
    key = lambda v: sorted(v, key=str)
    got = defaultdict(list)
    for x in rows:
        got[str(x["id"])].append((x["n_shingles"], x["component_id"]))
    return {k: key(v) for k, v in got.items()}


def plain_join(texts, size, percent):
    want = defaultdict(list)
    for (i, _), found in zip(texts, plain_components(texts, size, percent), strict=True):
        want[str(i)].append(found)
    return {k: sorted(v, key=str) for k, v in want.items()}


@pytest.mark.parametrize(("block", "frequent", "percent"), [(1 << 17, 1 << 17, 85), (3000, 0, 85), (6000, 40, 60), (4000, 1 << 17, 30)])
def test_ngram_join(spark, monkeypatch, block, frequent, percent):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "CHUNK", 3000)
    r = random.Random(9)
    texts = odd_texts()
    shared = prose(77, 60)
    for g in range(3):
        words = prose(100 + g, 120).split(" ")
        texts += [(1000 * (g + 1) + i, edited(words, r, r.choice([0, 1, 2, 3, 5, 7]))) for i in range(25)]
        texts += [(5000 + 100 * g + i, f"{shared} {prose(300 + 30 * g + i, r.choice([4, 8, 12, 40]))}") for i in range(12)]
    r.shuffle(texts)
    rows = ngram_join.ngram_join(table(spark, texts), words=4, percent=percent).collect()
    assert joined(rows) == plain_join(texts, 4, percent)


def test_ngram_join_of_repeated_and_missing_ids(spark):
    a, b = prose(1, 150).split(" "), prose(2, 150).split(" ")
    near = lambda words: " ".join([*words[:70], "altered", *words[71:]])
    texts = [(3, near(b)), (5, " ".join(a)), (5, " ".join(b)), (6, near(a)), (None, prose(3, 150)), (None, near(prose(3, 150).split(" ")))]
    far = prose(4, 150).split(" ")
    middle = " ".join([*far[:70], "altered", *far[71:]])
    texts += [(8, " ".join(far)), (None, middle), (9, " ".join([*middle.split(" ")[:30], "again", *middle.split(" ")[31:]]))]
    rows = ngram_join.ngram_join(table(spark, texts), words=4, percent=90).collect()
    assert joined(rows) == plain_join(texts, 4, 90)
    assert ngram_join.ngram_join(table(spark, [])).collect() == []
    with pytest.raises(ValueError):
        ngram_join.ngram_join(table(spark, []), percent=0)


def test_divide_skip():
    r = random.Random(5)
    for _ in range(300):
        universe = r.choice([5, 40, 400])
        sets = [np.array(sorted(r.sample(range(universe), r.randint(0, min(universe, 30)))), np.uint64) for _ in range(r.randint(1, 12))]
        query = np.array(sorted(r.sample(range(universe), r.randint(1, min(universe, 30)))), np.uint64)
        shared = [len(np.intersect1d(query, s)) for s in sets]
        least = r.randint(1, 8)
        needed = [least + r.randint(0, 3) for _ in sets]
        lists = InvertedLists(sets).of(query)
        assert sorted(divide_skip(lists, least, needed)) == [i for i, n in enumerate(shared) if n >= needed[i]]
        wanted = np.array([r.random() < 0.6 for _ in sets])
        some = InvertedLists(sets).of(query, wanted)
        assert all(some) and sorted(divide_skip(some, least, needed)) == [i for i, n in enumerate(shared) if n >= needed[i] and wanted[i]]


def test_bitmaps_never_rule_out_a_link():
    r = np.random.default_rng(4)
    for n in (1, 20, 31, 33, 64, 100, 117, 300, 700):
        a = np.unique(r.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: len(a) - len(a) // 20], r.integers(0, 1 << 62, max(1, n // 12)).astype(np.uint64))))
        size, labels, sides = np.array([len(a), len(b)]), np.array([0, 1]), np.ones(2, dtype=bool)
        common = len(np.intersect1d(a, b))
        linked = 100 * common >= 80 * (len(a) + len(b) - common)
        hit = ngram_join.plausible(size, labels, [ngram_join.parity(a), ngram_join.parity(b)], sides, sides, 80)
        assert hit.all() or not linked


def test_prefixes_of_linked_sets_meet():
    one = shingles.shingle_set(prose(1, 300), 4)
    two = np.sort(np.concatenate((one[:-20], one[:20] + np.uint64(1))))
    for values, counts in ((np.empty(0, np.uint64), np.empty(0, np.int64)), (one[::2], np.arange(len(one[::2])) % 7)):
        parts = [ngram_join.prefix(s, 85, values, counts) for s in (one, two)]
        assert len(np.intersect1d(*parts)) and all(len(p) == len(s) - -(-85 * len(s) // 100) + 1 for p, s in zip(parts, (one, two)))
        assert not len(values) or not np.isin(parts[0], values).any()


def test_ngram_query(spark):
    docs = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = QUERIES["op11_ngram_join"](spark, SMALL).withColumnRenamed("doc_id", "id").collect()
    assert joined(rows) == plain_join(docs, 4, 85)


# -- importance resampling ----------------------------------------------------------


def plain_runs(text, low, high):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]).encode() for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def plain_importance(texts, target, low, high, buckets, min_words, percent, seed):
    """Sorted (id, words, features, weight, score), and the (score, id) of those drawn in their order."""
    bucket = lambda run: zlib.crc32(run) % buckets
    source, wanted = Counter(), Counter()
    for _, text in texts:
        source.update(map(bucket, plain_runs(text, low, high)[1]))
    for text in target:
        wanted.update(map(bucket, plain_runs(text, low, high)[1]))
    all_s, all_t = sum(source.values()) + buckets, sum(wanted.values()) + buckets
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1.0) * all_s / ((source[b] + 1.0) * all_t))) for b in source}
    rows = []
    for i, text in texts:
        n, runs = plain_runs(text, low, high)
        weight = sum(gain[bucket(r)] for r in runs)
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = [(r[4], r[0]) for r in able[: len(able) * percent // 100]]
    return sorted(rows, key=str), drawn


@pytest.mark.parametrize(
    ("low", "high", "stretch"), [(1, 1, resampling.STRETCH), (1, 2, 900), (2, 4, 200), (3, 3, resampling.STRETCH)]
)
def test_importance(spark, monkeypatch, low, high, stretch):
    monkeypatch.setattr(resampling, "STRETCH", stretch)
    texts = odd_texts() + [(100 + i, prose(i % 25, 15 + i)) for i in range(60)]
    target = [prose(i, 40) for i in range(20, 23)] + [None, "", "日本語 É é"]
    options = dict(low=low, high=high, buckets=211, min_words=20, percent=30, seed=7)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    rows = resampling.importance(table(spark, texts), wanted, **options).collect()
    all_rows, drawn = plain_importance(texts, target, low, high, 211, 20, 30, 7)
    got = [(r["id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in rows]
    assert sorted(got, key=str) == all_rows
    ranked = sorted((r["rank"], r["score"], r["id"]) for r in rows if r["rank"] is not None)
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1)) and [r[1:] for r in ranked] == drawn
    left = resampling.resample(table(spark, texts), wanted, **options)
    assert left.columns == table(spark, []).columns and left.count() == len(drawn)


def test_importance_of_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert resampling.importance(table(spark, []), none).collect() == []
    rows = resampling.importance(table(spark, odd_texts()), none, percent=100).collect()
    assert len(rows) == len(odd_texts()) and all(r["weight"] == 0 for r in rows if r["n_words"] == 0)
    assert {r["rank"] is not None for r in rows if r["n_words"] >= 20} == {True}
    with pytest.raises(ValueError):
        resampling.importance(table(spark, []), none, low=0)


def test_checksums_of_runs():
    words = [b"a", b"words", b"\xc3\xa9", b"x" * 300, b"z"] * 7
    values = resampling.running_values(b"".join(b" " + w for w in words), 12345)
    for n in (1, 2, 5, 35, 36):
        want = [zlib.crc32(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]
        assert resampling.run_checksums(*values, n).tolist() == want


# -- hard negatives -----------------------------------------------------------------


def plain_negatives(rows, every=100, lowest=80, highest=100):
    """Rows as sorted tuples without the tie between rows that repeat an id."""
    able = []
    for i, vector, label in rows:
        if i is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints = [math.floor(256 * x) for x in vector]
        if sum(x * x for x in ints) < 1 << 62:
            able.append((i, ints, label))
    out = []
    for a, (anchor, vector, label) in enumerate(able):
        if anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, v, strict=True)), i, other)
            for b, (i, v, other) in enumerate(able)
            if a != b and len(v) == len(vector)
        ]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            near = sorted(s for s in scored if s[2] != label and -lowest * p <= -100 * s[0] <= -highest * p)[:5]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(near, start=1)]
    return sorted(out)


def mined(frame, **options):
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0, **options).collect())


SCHEMA = "vec_id bigint, embedding array<float>, label int, row bigint, id bigint, places string, anchor string"


@pytest.mark.parametrize("block_bytes", [1 << 21, 600])
def test_hard_negatives(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(hard_negatives, "CELL_SCORES", 100)
    r = random.Random(3)
    rows = [(i, [r.gauss(0.2, 0.3) for _ in range(9)], r.randrange(4)) for i in range(0, 330)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    rows += [(1000 + i, list(rows[5][1]), rows[5][2]) for i in range(20)]  # ties
    rows += [(1100, list(rows[5][1]), 9), (400, [], 1), (401, [], 1), (402, [], 2), (500, [1.0], 1), (501, [2.0], 1), (502, [2.0], 3)]
    rows += [(600, None, 1), (601, [0.1] * 9, None), (None, [0.1] * 9, 1), (603, [0.1] * 8 + [None], 1)]
    rows += [(604, [float("nan")] * 9, 1), (605, [float("inf")] + [0.0] * 8, 2), (700, [3e30] * 9, 1), (701, [1e4] * 9, 0)]
    frame = spark.createDataFrame([(*x, 1, 2, "x", "y") for x in rows], SCHEMA)
    assert mined(frame) == plain_negatives(rows)
    assert mined(frame, lowest=50, highest=90) == plain_negatives(rows, lowest=50, highest=90)


def test_hard_negatives_of_repeated_ids_and_empty_tables(spark):
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (3, [1.0, 0.0], 2)]
    frame = spark.createDataFrame([(*x, 1, 2, "x", "y") for x in rows], SCHEMA)
    assert mined(frame) == [(100, 100, rank, 3, 65536, 65536) for rank in (1, 1, 2, 2)] == plain_negatives(rows)
    assert mined(frame.limit(0)) == [] and mined(frame.filter("vec_id = 3")) == []


def test_scores_are_exact(monkeypatch):
    r = np.random.default_rng(1)
    for size, dim in ((100, 3), (2**15, 3000), (2**30 // 40, 40), (2**24, 700)):
        a = r.integers(-size, size, (5, dim), dtype=np.int64)
        b = r.integers(-size, size, (7, dim), dtype=np.int64)
        a[0], b[0] = size, -size
        one, two = hard_negatives.Block(a), hard_negatives.Block(b)
        want = [[sum(x * y for x, y in zip(p, q, strict=True)) for q in b.tolist()] for p in a.tolist()]
        assert hard_negatives.scores(one, slice(0, 5), two).tolist() == want
    assert len(hard_negatives.primes_for(2.0**62)) <= len(hard_negatives.PRIMES)
    assert all(all(p % d for d in range(2, p)) for p in hard_negatives.PRIMES)


def test_best_rows_of_ties():
    values = np.array([5, 7, 7, 1, 7, 9, 5])
    assert hard_negatives.best_of(values, np.arange(7), 3).tolist() == [5, 1, 2]
    assert hard_negatives.best_of(values, np.array([0, 3, 6]), 9).tolist() == [0, 6, 3]


def test_hard_negative_query(spark):
    rows = []
    for x in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect():
        rows.append((x["vec_id"], x["embedding"], (x["label"] + 1) % 10 if x["vec_id"] % 7 == 0 else x["label"]))
    assert sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, SMALL).collect()) == plain_negatives(rows)
