"""Toxicity of whole texts: a bidirectional GRU with attention over windows of words.

Every word enters by itself and by its characters: hashed word vectors and the mean of hashed
character n-gram vectors, both learned, beside smoothed log-odds of the word and of its
n-grams in the labelled sample. A text is read in overlapping windows; its score is the
highest of its windows. Labels exist for whole documents only, so training alternates: the
window that a positive document is judged by is the one that scores highest so far.

The model is fitted on the driver from a bounded sample of labelled rows; scoring is a
map over all texts, without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from . import bigru
from .common import whole_row
from .decontamination import word_bytes
from .shingles import hashed_words

STEPS, STRIDE = 32, 24  # words in a window, words between the starts of two
OVERLAP = STEPS - STRIDE
SAMPLE_PER_CLASS = 1500  # labelled documents of each class at most; what one class lacks, the other may have more
SAMPLE_BYTES = 65_536  # longer documents are scored like all others, but not learned from
CANDIDATES = 2  # labelled ids looked up for each text that is learned from
CLEAN_SHARE = 0.985  # of clean calibration texts that stay below the threshold if the classes overlap
THRESHOLD = 0.3
NGRAMS = (3, 4, 5)  # bytes, with the spaces around the word
PREFIXES = tuple(range(6, 15))  # longer n-grams only where they begin a word: stems that take endings
WORD_ROWS = CHAR_ROWS = 1 << 17
LEARNED = 3  # learned dimensions of words and of n-grams
HIDDEN, ATTENTION = 8, 8
ROUNDS, BATCH, RATE = 2, 256, 0.01
UPDATES = 60  # per round
CALIBRATION = 8  # every eighth labelled text sets the threshold instead of being learned from
MIN_TEXTS = 7  # sampled texts that a learned vector needs; rarer words and n-grams have none
SHRINK = 8.0  # documents that a log-odds value needs before half of it counts
GROUP_BYTES = 1 << 19  # of text read together
READ_BYTES = 1 << 19  # of text hashed at a time
WINDOWS_AT_ONCE = 4096

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The distinct words of some texts and where they occur."""

    order: np.ndarray  # per word occurrence: row among the distinct words
    counts: np.ndarray  # per text: how many words
    rows: np.ndarray  # per distinct word: row of the word table
    grams: np.ndarray  # rows of the n-gram table, word after word
    bounds: np.ndarray  # where the n-grams of each distinct word begin


def _hashed_in_stretches(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of all words, a stretch of bounded size (or one word) at a time."""
    parts, start = [], 0
    while start < len(data):
        end = start + READ_BYTES
        if end < len(data):
            blank = data.rfind(b" ", start + 1, end)
            end = blank if blank > 0 else data.find(b" ", end)
            end = len(data) if end < 0 else end
        hashes, starts, ends = hashed_words(data[start:end])
        parts.append((hashes, starts + start, ends + start))
        start = end
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def read_words(texts: list[str]) -> Words:
    pieces = [word_bytes(t) for t in texts]
    data = b" " + b" ".join(pieces) + b" "
    hashes, starts, ends = _hashed_in_stretches(data)
    text_ends = np.cumsum([len(p) + 1 for p in pieces])
    counts = np.bincount(np.searchsorted(text_ends, starts, side="left"), minlength=len(texts))[: len(texts)]
    distinct, first, order = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = starts[first], ends[first]
    chars = np.frombuffer(data + bytes(8), dtype=np.uint8)
    lengths = ends - starts
    per_size = [np.maximum(lengths + 3 - n, 0) for n in NGRAMS] + [(lengths + 1 >= n).astype(np.int64) for n in PREFIXES]
    totals = np.sum(per_size, axis=0)
    bounds = np.concatenate(([0], np.cumsum(totals)))[:-1]
    grams = np.empty(int(totals.sum()), dtype=np.int64)
    into = bounds.copy()
    for n, number in zip(NGRAMS + PREFIXES, per_size, strict=True):
        step = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
        at = np.repeat(starts - 1, number) + step
        code = np.full(len(at), np.uint64(n), dtype=np.uint64)
        for i in range(n):
            code = code * np.uint64(257) + chars[at + i].astype(np.uint64)
        grams[np.repeat(into, number) + step] = ((code * _SPREAD) >> np.uint64(32)).astype(np.int64) % CHAR_ROWS
        into += number
    return Words(order, counts, (distinct % np.uint64(WORD_ROWS)).astype(np.int64), grams, bounds)


@dataclass
class Model:
    word_odds: np.ndarray
    gram_odds: np.ndarray
    parameters: bigru.Parameters

    def vectors(self, words: Words) -> np.ndarray:
        """One row per distinct word."""
        return self.vectors_with(words, self.word_odds[words.rows], self.gram_odds[words.grams])

    def vectors_with(self, words: Words, word_odds: np.ndarray, odds: np.ndarray) -> np.ndarray:
        """The same with other log-odds, one per distinct word and one per n-gram of each."""
        if not len(words.rows):
            return np.zeros((0, 3 + 2 * LEARNED), dtype=np.float32)
        sizes = np.diff(np.append(words.bounds, len(words.grams)))[:, None]
        learned = np.add.reduceat(self.parameters["chars"][words.grams], words.bounds, axis=0) / sizes
        return np.concatenate(
            [
                word_odds[:, None],
                np.maximum.reduceat(odds, words.bounds)[:, None],
                (np.add.reduceat(odds, words.bounds)[:, None] / sizes),
                self.parameters["words"][words.rows],
                learned,
            ],
            axis=1,
        ).astype(np.float32)


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, length) of all windows of texts with so many words, longest first."""
    per_text = np.where(counts > 0, np.maximum(-(-(counts - OVERLAP) // STRIDE), 1), 0)
    text = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    base = np.cumsum(counts) - counts
    length = np.minimum(counts[text] - nth * STRIDE, STEPS)
    order = np.argsort(-length, kind="stable")
    return text[order], (base[text] + nth * STRIDE)[order], length[order]


def _index(order: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    at = first[:, None] + np.minimum(np.arange(STEPS), length[:, None] - 1)
    return order[at]


def window_logits(model: Model, table: np.ndarray, order: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Logits of windows over word occurrences ``order``, which point into ``table``."""
    out = np.empty(len(first), dtype=np.float32)
    for at in range(0, len(first), WINDOWS_AT_ONCE):
        part = slice(at, at + WINDOWS_AT_ONCE)
        out[part] = bigru.forward(model.parameters, table, _index(order, first[part], length[part]), length[part])
    return out


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    """The highest window score of each text; 0 for a text without words."""
    words = read_words(texts)
    text, first, length = windows(words.counts)
    best = np.full(len(texts), -np.inf)
    if len(text):
        np.maximum.at(best, text, window_logits(model, model.vectors(words), words.order, first, length).astype(np.float64))
    return 1 / (1 + np.exp(-np.clip(best, -700, 700))) * (words.counts > 0)


def _log_odds(positive: np.ndarray, negative: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Log-odds of occurring in a positive text, pulled to zero for what is rare."""
    positive, negative = np.maximum(positive, 0), np.maximum(negative, 0)
    n_pos, n_neg = int(labels.sum()), int((1 - labels).sum())
    odds = np.log((positive + 0.5) / (n_pos + 1)) - np.log((negative + 0.5) / (n_neg + 1))
    n = positive + negative
    return (odds * n / (n + SHRINK)).astype(np.float32)


def fit(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """Train on labelled texts; with one class only, every score is that of the class."""
    y = np.array(labels, dtype=np.int64)
    apart = np.arange(len(texts)) % CALIBRATION == CALIBRATION - 1
    if len(set(y[~apart].tolist())) < 2 or len(set(y[apart].tolist())) < 2:
        apart[:] = False
    model = _train([t for t, a in zip(texts, apart, strict=True) if not a], y[~apart], seed)
    if apart.any():
        scores = score_texts(model, [t for t, a in zip(texts, apart, strict=True) if a])
        logit = np.log(np.clip(scores, 1e-9, 1 - 1e-7) / (1 - np.clip(scores, 1e-9, 1 - 1e-7)))
        clean, low = logit[y[apart] == 0], np.quantile(logit[y[apart] == 1], 0.02)
        # the threshold lies where the classes part, nearer to the positive texts, for most texts are
        # clean; if they overlap, above most clean ones, so that no single text decides
        high = clean.max()
        apart_at = 0.4 * high + 0.6 * low if low > high else np.quantile(clean, CLEAN_SHARE)
        model.parameters["oc"] -= np.float32(apart_at - np.log(THRESHOLD / (1 - THRESHOLD)))
    return model


def _train(texts: list[str], y: np.ndarray, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    words = read_words(texts)
    sizes = np.diff(np.append(words.bounds, len(words.grams)))

    def grams_of(distinct: np.ndarray) -> np.ndarray:
        """The n-grams of these words, word after word."""
        n = sizes[distinct]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return words.grams[np.repeat(words.bounds[distinct], n) + within]

    # in how many texts of either class each row of the two tables occurs
    word_texts, gram_texts = np.zeros((2, WORD_ROWS)), np.zeros((2, CHAR_ROWS))
    ends = np.cumsum(words.counts)
    for label, begin, end in zip(y, ends - words.counts, ends, strict=True):
        distinct = np.unique(words.order[begin:end])
        word_texts[label, np.unique(words.rows[distinct])] += 1
        gram_texts[label, np.unique(grams_of(distinct))] += 1
    word_odds, gram_odds = _log_odds(word_texts[1], word_texts[0], y), _log_odds(gram_texts[1], gram_texts[0], y)
    # a training text sees the log-odds as they are without it, else the network would learn to
    # trust rare words, which betray the very texts that they were counted in
    without = [
        tuple(_log_odds(n[1] - label, n[0] - (1 - label), y) for n in (word_texts, gram_texts)) for label in (0, 1)
    ]
    p = bigru.new_parameters(3 + 2 * LEARNED, HIDDEN, ATTENTION, rng)
    p["words"] = (0.01 * rng.standard_normal((WORD_ROWS, LEARNED))).astype(np.float32)
    p["chars"] = (0.01 * rng.standard_normal((CHAR_ROWS, LEARNED))).astype(np.float32)
    known = {"words": word_texts.sum(axis=0) >= MIN_TEXTS, "chars": gram_texts.sum(axis=0) >= MIN_TEXTS}
    for name, rows in known.items():
        p[name] *= rows[:, None]
    model = Model(word_odds, gram_odds, p)
    seen = words.order + np.repeat(y, words.counts) * len(words.rows)  # in a text of which class
    text, first, length = windows(words.counts)
    if len(set(y.tolist())) < 2 or not len(text):
        p["ow"][:] = 0
        p["oc"][0] = 6.0 if y.any() else -6.0
        return model

    adam = bigru.Adam(p, RATE)
    for turn in range(ROUNDS):
        table = np.concatenate([model.vectors_with(words, w[words.rows], g[words.grams]) for w, g in without])
        if turn:
            score = window_logits(model, table, seen, first, length)
        else:  # no model yet: the most suspicious word
            odds = table[:, :2].max(axis=1)
            parts = range(0, len(first), 8192)
            score = np.concatenate([odds[_index(seen, first[i : i + 8192], length[i : i + 8192])].max(axis=1) for i in parts])
        # of each text the window that scores highest, and others of negative texts
        best = np.lexsort((-score, text))
        top = best[np.concatenate(([True], text[best][1:] != text[best][:-1]))]
        clean = np.flatnonzero(y[text] == 0)
        chosen = np.unique(np.concatenate([top, rng.choice(clean, size=min(len(top), len(clean)), replace=False)]))
        rate = (y[text[chosen]] == 1).mean()
        balance = np.where(y == 1, 0.5 / rate, 0.5 / (1 - rate)).astype(np.float32)
        batches = (rng.permutation(chosen)[:BATCH] for _ in range(UPDATES))
        for part in map(np.sort, batches):  # windows are in order of length
            index = _index(seen, first[part], length[part])
            used, local = np.unique(index, return_inverse=True)
            label, used = np.divmod(used, len(words.rows))
            local, n = local.reshape(index.shape), sizes[used]
            few = Words(local, words.counts, words.rows[used], grams_of(used), np.cumsum(n) - n)
            of_gram = np.repeat(label, n)
            word_values = np.where(label, without[1][0][few.rows], without[0][0][few.rows])
            gram_values = np.where(of_gram, without[1][1][few.grams], without[0][1][few.grams])
            table, tape = model.vectors_with(few, word_values, gram_values), {}
            logit = bigru.forward(p, table, local, length[part], tape)
            target = y[text[part]]
            d_logit = ((1 / (1 + np.exp(-logit)) - target) * balance[text[part]] / len(part)).astype(np.float32)
            g, d_table = bigru.backward(p, table, local, tape, d_logit)
            g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
            np.add.at(g["words"], few.rows, d_table[:, 3 : 3 + LEARNED])
            np.add.at(g["chars"], few.grams, np.repeat(d_table[:, 3 + LEARNED :] / n[:, None], n, axis=0))
            for name, rows in known.items():
                g[name] *= rows[:, None]
            adam.update(g)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[list[str], list[int]]:
    """At most ``2 * per_class`` labelled texts of at most SAMPLE_BYTES, half of them of each class, by the hash of their id.

    A class that has fewer leaves the rest to the other. Ids are chosen from the narrow label table, CANDIDATES
    times as many as are wanted because some texts are missing, empty or too long; only their
    texts are looked at, and only those wanted come to the driver.
    """
    place = F.xxhash64("id")
    chosen = [
        labels.filter(F.col("label") == label).select("id", "label").distinct().orderBy(place, "id").limit(2 * CANDIDATES * per_class)
        for label in (0, 1)
    ]
    wanted = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 4 * CANDIDATES * per_class rows
    found = docs.filter(F.octet_length("text").between(1, SAMPLE_BYTES)).join(wanted, "id")
    order = Window.partitionBy("label").orderBy(place, "id", "text")
    first = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= 2 * per_class)
    counts = {r["label"]: r["n"] for r in first.groupBy("label").agg(F.count("*").alias("n")).collect()}
    quota = {k: max(per_class, 2 * per_class - counts.get(1 - k, 0)) for k in (0, 1)}
    rows = first.filter(F.col("nth") <= F.when(F.col("label") == 1, quota[1]).otherwise(quota[0])).collect()
    rows.sort(key=lambda r: hashlib.blake2b(r["text"].encode("utf-8", "surrogatepass")).digest())
    return [r["text"] for r in rows], [r["label"] for r in rows]


def score(model: Model, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id`` and ``score`` (0 to 1); ``whole`` adds the row as struct ``doc``.

    Whole texts of any length are scored, in all their windows. Null texts, empty texts and
    texts without words score 0. Only the text decides. Columns of ``docs`` never clash with
    the ones added; an empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    # a whole row holds its text, which goes to Python once
    sent = whole_row(docs).alias("doc") if whole else F.col(text_col).alias("text")
    rows = docs.select(F.col(id_col).alias("id"), sent)
    doc_type = f", doc {rows.schema['doc'].dataType.simpleString()}" if whole else ""
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, group, held = [], [], 0
            for text in pc.struct_field(batch.column(1), at) if whole else batch.column(1):
                group.append(text.as_py() or "")
                held += len(group[-1])
                if held >= GROUP_BYTES:
                    scores.append(score_texts(shared.value, group))
                    group, held = [], 0
            if group:
                scores.append(score_texts(shared.value, group))
            columns = [batch.column(0), pa.array(np.concatenate([*scores, np.empty(0)])), *(batch.columns[1:] if whole else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score", *(["doc"] if whole else [])])

    return rows.mapInArrow(run, f"id {id_type}, score double{doc_type}")


def held_out(doc_id) -> F.Column:
    """Rows never learned from: every fourth by the checksum of the id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def fit_on(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model from the labelled rows of ``documents`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    known = labels.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    return fit(*training_rows(docs.select(F.col("doc_id").alias("id"), "text"), known, per_class))


def remove_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    return score(model, docs, whole=True).filter(F.col("score") < threshold).select("doc.*")
