"""Exact, near and line duplicates, toxicity, decontamination and the pipeline."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from sftprep.llm import bigru, decontamination, exact_dedup, line_dedup, near_dedup, shingles, toxicity
from sftprep.llm.components import connected_components
from sftprep.llm.queries import QUERIES

from .cases import odd_texts, prose, table

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def checkpoint_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# -- exact duplicates ---------------------------------------------------------------


def test_exact_groups_of_odd_documents(spark):
    texts = odd_texts()
    rows = exact_dedup.exact_groups(table(spark, texts), digest=True).collect()
    ids = defaultdict(list)
    for i, t in texts:
        ids[norm(t)].append(i)
    by_hash = {hashlib.sha256(n.encode()).hexdigest(): v for n, v in ids.items()}
    assert len(rows) == len(texts)
    kept = defaultdict(int)
    for r in rows:
        group = by_hash[r["sha256"]]
        named = [i for i in group if i is not None]
        assert r["keep_id"] == (min(named) if named else None) and r["group_size"] == len(group)
        kept[r["sha256"]] += r["kept"]
        assert not r["kept"] or r["id"] == r["keep_id"]
    assert set(kept.values()) == {1}
    left = exact_dedup.deduplicate(table(spark, texts))
    assert left.columns == table(spark, []).columns and left.count() == len(ids)
    assert exact_dedup.exact_groups(table(spark, [])).collect() == []


def test_exact_copies_differ_after_the_prefix(spark):
    head = "h" * 400
    texts = [(1, head + "a"), (2, head + "b"), (3, head + "a"), (4, "i" * 401)]
    rows = exact_dedup.exact_groups(table(spark, texts)).collect()
    assert {r["id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in rows} == {
        1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False), 4: (4, 1, True)
    }


# -- lines --------------------------------------------------------------------------


def plain_lines(texts, min_chars=40, min_docs=5):
    blanks = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for i, t in texts:
        for line in (t or "").split("\n"):
            key = line.strip(blanks).translate(LOWER)
            if len(key) >= min_chars:
                holders[key].add(i)
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            docs = holders.get(line.strip(blanks).translate(LOWER), ())
            last = max((d for d in docs if d is not None), default=None)
            if len(docs) < min_docs or i == last:
                kept.append(line)
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("frequent", [2, 2000])
def test_lines(spark, monkeypatch, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT_LINES", frequent)
    shared = ["A line that is shared by very many documents of all", "ÉCLAIR line that is shared by very many documents ok"]
    r = random.Random(4)
    texts = odd_texts()
    for i in range(40, 70):
        lines = [prose(i, 8), *r.sample(shared, r.randint(0, 2)), " " + shared[0].upper() + "\t", prose(r.randint(0, 5), 12), ""]
        r.shuffle(lines)
        texts.append((i, "\n".join(lines)))
    texts += [(None, shared[0]), (50, shared[0]), (50, shared[0]), (80, "\n".join([shared[1]] * 3)), (81, shared[1].replace("É", "é"))]
    rows = line_dedup.dedup_lines(table(spark, texts)).collect()
    got = sorted((str(x["id"]), x["n_lines"], x["n_dropped"], x["text"]) for x in rows)
    assert got == plain_lines(texts)
    assert any(x["n_dropped"] for x in rows)
    assert line_dedup.dedup_lines(table(spark, [])).collect() == []


# -- near duplicates ----------------------------------------------------------------


def word_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    run = min(size, len(words))
    return frozenset(tuple(words[i : i + run]) for i in range(len(words) - run + 1)) if run else frozenset()


def plain_components(texts, size, percent):
    nodes = list(range(len(texts)))
    sets = [word_set(t, size) for _, t in texts]
    label = nodes[:]

    def join(a, b):
        old, new = label[a], label[b]
        for x in nodes:
            if label[x] == old:
                label[x] = new

    for a in nodes:
        for b in nodes[:a]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                join(a, b)
    smallest = {}
    for x in nodes:
        i = texts[x][0]
        if i is not None:
            smallest[label[x]] = min(i, smallest.get(label[x], i))
    return [(len(sets[x]), smallest.get(label[x]) if sets[x] else texts[x][0]) for x in nodes]


def edited(words, r, changes):
    out = list(words)
    for _ in range(changes):
        at = r.randrange(len(out))
        out[at : at + 1] = r.choice([[], ["new%d" % r.randrange(10**6)], [out[at], "more"]])
    return " ".join(out)


@pytest.mark.parametrize("block", [4, 256])
def test_near_groups(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    r = random.Random(9)
    texts = odd_texts()
    for g in range(3):
        words = prose(100 + g, 150).split(" ")
        texts += [(1000 * (g + 1) + i, edited(words, r, r.choice([0, 1, 3, 6, 9]))) for i in range(30)]
    r.shuffle(texts)
    rows = near_dedup.near_groups(table(spark, texts), words=3, percent=85).collect()
    want = defaultdict(list)
    for (i, t), found in zip(texts, plain_components(texts, 3, 85), strict=True):
        want[str(i)].append(found)
    got = defaultdict(list)
    for x in rows:
        got[str(x["id"])].append((x["n_shingles"], x["component_id"]))
    key = lambda v: sorted(v, key=str)
    assert {k: key(v) for k, v in got.items()} == {k: key(v) for k, v in want.items()}


def test_near_dedup_keeps_one(spark):
    texts = odd_texts()
    left = near_dedup.deduplicate(table(spark, texts))
    assert left.columns == table(spark, []).columns
    ids = sorted((x["doc_id"] for x in left.collect()), key=str)
    assert ids == sorted([1, 4, 5, 6, 7, 7, 8, 9, 10, 11, 12, None, None], key=str)
    assert near_dedup.near_groups(table(spark, [])).collect() == []


def test_near_groups_of_repeated_and_missing_ids(spark):
    """Texts under one id are nodes of their own: nothing that is not a near copy goes."""
    a, b, c, d = (prose(i, 150).split(" ") for i in range(1, 5))
    near = lambda words, at=70: " ".join([*words[:at], "altered", *words[at + 1 :]])
    texts = [(3, near(b)), (5, " ".join(a)), (5, " ".join(b)), (6, near(a))]
    texts += [(None, " ".join(c)), (None, near(c)), (8, " ".join(d)), (None, near(d)), (9, near(near(d).split(" "), 30))]
    texts += [(20, " ".join(a[::-1])), (20, near(a[::-1])), (20, near(a[::-1]))]
    rows = near_dedup.near_groups(table(spark, texts), words=3, percent=85).collect()
    want = sorted(zip([str(i) for i, _ in texts], plain_components(texts, 3, 85)), key=str)
    assert sorted(((str(x["id"]), (x["n_shingles"], x["component_id"])) for x in rows), key=str) == want
    left = [(r["doc_id"], r["text"]) for r in near_dedup.deduplicate(table(spark, texts), words=3, percent=85).collect()]
    assert sorted((i for i, _ in left if i != 20), key=str) == [3, 5, 8, None]
    assert (3, near(b)) in left and (5, " ".join(a)) in left and len({t for i, t in left if i == 20}) == 1


def test_estimate_follows_similarity(spark):
    r = np.random.default_rng(2)
    rows, truth = [], []
    for share in (0.0, 0.3, 0.6, 0.85, 1.0):
        for _ in range(30):
            both, own = int(400 * share), 400 - int(400 * share)
            values = r.integers(0, 1 << 63, both + 2 * own, dtype=np.uint64) * np.uint64(2)
            a, b = values[: both + own], np.concatenate([values[:both], values[both + own :]])
            sig = [near_dedup.packed(near_dedup.minima(np.sort(x))).tolist() for x in (a, b)]
            rows.append((share, *sig))
            truth.append(both / (both + 2 * own))
    df = spark.createDataFrame(rows, "share double, a array<bigint>, b array<bigint>")
    got = np.array([x[0] for x in df.select(near_dedup.estimated(df["a"], df["b"])).collect()])
    assert abs(got - np.array(truth)).max() < 0.17 and abs((got - np.array(truth)).mean()) < 0.02


def test_word_hashes_do_not_depend_on_stretches(monkeypatch):
    text = prose(8, 500) + " " + "long" * 200 + "  end"
    whole = shingles.word_hashes(text)
    assert len(set(whole.tolist())) == len(set(text.translate(LOWER).split()))
    monkeypatch.setattr(shingles, "_STRETCH", 50)
    assert (shingles.word_hashes(text) == whole).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_near_query(spark):
    docs = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = {x["doc_id"]: x for x in QUERIES["op5_near_dedup"](spark, SMALL).collect()}
    for (i, _), (n, component) in zip(docs, plain_components(docs, 3, 85), strict=True):
        assert (rows[i]["n_shingles"], rows[i]["component_id"], rows[i]["kept"]) == (n, component, component == i)


# -- toxicity -----------------------------------------------------------------------


def test_gradients(monkeypatch):
    rng = np.random.default_rng(0)
    p = bigru.new_parameters(4, 3, 3, rng)
    table_, index = rng.standard_normal((6, 4)).astype(np.float32), rng.integers(0, 6, (3, 5))
    lengths, d = np.array([5, 3, 1]), rng.standard_normal(3).astype(np.float32)
    tape = {}
    bigru.forward(p, table_, index, lengths, tape)
    g, d_table = bigru.backward(p, table_, index, tape, d)
    for name, values, grad in [*((k, p[k], g[k]) for k in p), ("table", table_, d_table)]:
        for at in np.ndindex(values.shape):
            old, out = values[at], []
            for step in (1e-2, -1e-2):
                values[at] = old + step
                out.append(float((bigru.forward(p, table_, index, lengths) * d).sum()))
            values[at] = old
            assert abs((out[0] - out[1]) / 2e-2 - grad[at]) < 5e-3, name


def test_windows_cover_every_word():
    for n in (0, 1, 8, 9, 31, 32, 33, 56, 57, 1000):
        text, first, length = toxicity.windows(np.array([n, 3]))
        mine = text == 0
        seen = {w for f, k in zip(first[mine], length[mine], strict=True) for w in range(f, f + k)}
        assert seen == set(range(n)) and (length > 0).all() and (np.diff(length) <= 0).all()


def test_words_do_not_depend_on_stretches(monkeypatch):
    texts = [prose(8, 300), "", "x" * 300 + " end", prose(9, 50)]
    whole = toxicity.read_words(texts)
    monkeypatch.setattr(toxicity, "READ_BYTES", 64)
    cut = toxicity.read_words(texts)
    for name in ("order", "counts", "rows", "grams", "bounds"):
        assert (getattr(whole, name) == getattr(cut, name)).all(), name


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit_on(docs, labels)
    known = docs.join(labels.select("doc_id", "toxic"), "doc_id").filter(toxicity.held_out(docs["doc_id"]))
    rows = toxicity.score(model, known, whole=True).select("score", "doc.toxic").collect()
    y, s = np.array([x["toxic"] for x in rows]), np.array([x["score"] for x in rows])
    order = s.argsort().argsort()
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    predicted = s >= toxicity.THRESHOLD
    assert auc > 0.97 and predicted[y == 1].mean() > 0.85 and predicted[y == 0].mean() < 0.03
    odd = toxicity.score(model, table(spark, odd_texts())).collect()
    assert len(odd) == len(odd_texts()) and all(0 <= x["score"] <= 1 for x in odd)
    assert all(x["score"] == 0 for x in odd if x["id"] in (4, 5, 6))
    assert toxicity.remove_toxic(table(spark, odd_texts()), model).columns == table(spark, []).columns
    assert toxicity.score(model, table(spark, [])).collect() == []


def test_fit_without_both_classes():
    for labels in ([], [0, 0], [1, 1]):
        model = toxicity.fit(["some words", "other words"][: len(labels)], labels)
        score = toxicity.score_texts(model, ["some words", ""])
        assert (score[0] > 0.5) == bool(labels and labels[0]) and score[1] == 0


# -- decontamination ----------------------------------------------------------------


def plain_hits(text, items, width=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    words, hit, names = split(text), set(), set()
    for name, item in items:
        w = split(item)
        run = min(width, len(w))
        wins = {tuple(w[i : i + run]) for i in range(len(w) - run + 1)} if run else set()
        for i in range(len(words) - run + 1):
            if run and tuple(words[i : i + run]) in wins:
                hit.update(range(i, i + run))
                names.add(str(name) if name is not None else "null")
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [1 << 19, 400])
def test_contamination(spark, block_bytes):
    long_item = prose(50, 30)
    items = [(1, long_item), (2, "Short Item!"), (2, "another short"), (None, prose(51, 12)), (3, None), (4, " ... "), (5, long_item), (10, "é 日本")]
    texts = odd_texts() + [
        (60, f"{prose(52, 20)}; {long_item.upper()} {prose(53, 5)}"),
        (61, "so (short-item) is here, shortitem is not; É. é?日本"),
        (62, " ".join(prose(51, 12).split()[1:11])),
        (63, " ".join(prose(50, 30).split()[3:12])),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.find_contamination(table(spark, texts), bench, block_bytes=block_bytes).collect()
    want = sorted((str(i), *map(str, plain_hits(t, items))) for i, t in texts)
    assert sorted((str(r["id"]), str(r["n_words"]), str(r["n_hit"]), str(list(r["items"]))) for r in rows) == want
    text = dict(texts)
    for r in rows:
        found = [text[r["id"]][a:b] for a, b in r["spans"]]
        assert sum(plain_hits(f, [])[0] for f in found) == r["n_hit"]
        if r["id"] == 61:
            assert found == ["short-item", "é?日本"]
    left = decontamination.decontaminate(table(spark, texts), bench, block_bytes=block_bytes)
    assert left.columns == table(spark, []).columns and left.count() == sum(not plain_hits(t, items)[1] for _, t in texts)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.decontaminate(table(spark, texts), none).count() == len(texts)
    assert decontamination.find_contamination(table(spark, []), bench).collect() == []


# -- pipeline -----------------------------------------------------------------------


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, now = docs.columns, docs
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SMALL).collect(), docs.schema)
        assert now.columns == columns, name
        kept.append([(r["doc_id"], r["text"]) for r in now.collect()])
    first = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_text = defaultdict(list)
    for i, t in kept[0]:
        by_text[norm(t)].append(i)
    assert sorted(i for i, _ in kept[1]) == sorted(min(v) for v in by_text.values())
    groups = plain_components(kept[1], 5, 80)
    assert sorted(i for i, _ in kept[2]) == sorted(i for (i, _), (_, c) in zip(kept[1], groups, strict=True) if c == i)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert sorted(i for i, _ in kept[3]) == sorted(i for i, t in kept[2] if not plain_hits(t, items)[1])
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in kept[3]} <= set(first)


def test_stages_of_odd_documents(spark):
    now = table(spark, odd_texts())
    schema, empty = now.schema, table(spark, [])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SMALL).collect(), schema)
        assert stage(spark, empty, SMALL).collect() == [] and stage(spark, empty, SMALL).columns == empty.columns
    left = sorted(((r["doc_id"], r["text"]) for r in now.collect()), key=str)
    one = {i: t for i, t in odd_texts() if i not in (7, 12)}
    same = [(12, "same id, other text"), (7, "one"), (None, "nameless")]
    want = [(i, one[i]) for i in (1, 4, 6, 8, 9, 10, 11)] + same  # 2, 12: copies of 1; 3: near; 5: empty like 4
    assert left == sorted(want, key=str)
    pack = corpus_pipeline.STAGES[-1][1]
    assert {r["doc_id"] for r in pack(spark, now, SMALL).collect()} == {i for i, _ in want}
    assert pack(spark, empty, SMALL).collect() == []


def test_promising_rows_follow_the_estimate(spark):
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)
    sets = [np.concatenate([base[: 400 - cut], r.integers(0, 1 << 63, cut, dtype=np.uint64) * np.uint64(2)]) for cut in range(0, 400, 20)]
    sigs = np.array([near_dedup.packed(near_dedup.minima(np.sort(s))) for s in sets])
    sizes, labels = np.array([len(s) for s in sets]), np.arange(len(sets)) // 2
    pairs = spark.createDataFrame([(i, j, a.tolist(), b.tolist()) for i, a in enumerate(sigs) for j, b in enumerate(sigs)], "i int, j int, a array<bigint>, b array<bigint>")
    near = pairs.filter(near_dedup.estimated(pairs["a"], pairs["b"]) >= near_dedup.estimate_cut(85)).collect()
    want = {x["i"] for x in near if labels[x["i"]] != labels[x["j"]]}
    got = near_dedup.promising(sigs, sizes, labels, 85)
    assert set(np.flatnonzero(got).tolist()) == want and 0 < len(want) < len(sets)
