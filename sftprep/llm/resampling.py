"""Importance resampling towards a target corpus, over hashed runs of words.

A document is brought to its words with one separator before each and scanned once; the scan
keeps the running CRC at the start and the end of every word. CRC is linear over GF(2), so the
checksum of any run of words follows from two of these values: that at its start, shifted by
the length of the run, cancels out of that at its end. No run is ever spelled out.

Bucket counts per document are stored by that scan; totals, gains and weights are computed
from the stored counts. Only totals per bucket, whose number is a parameter, reach the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import range_index
from .common import whole_row, write_through

BUCKETS = 10_000
MIN_N, MAX_N = 1, 2
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
STRETCH = 1 << 20  # bytes of a text whose running values are held at a time

# A-Z in lower case; every ASCII character that is neither a digit nor a letter as a space
_WORDS = bytes(
    i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else i + 32 if 65 <= i <= 90 else 32 for i in range(256)
)
_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, bits reversed
_ONES = np.uint32(0xFFFFFFFF)


def _byte_steps() -> np.ndarray:
    """What one zero byte makes of each value of the lowest byte."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & np.uint32(1), (steps >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), steps >> np.uint32(1))
    return steps


_STEP = _byte_steps()


def _applied(operator: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear operator on 32 bits, tabulated for each of their four bytes."""
    out = operator[0][values & np.uint32(255)]
    for i in range(1, 4):
        out = out ^ operator[i][(values >> np.uint32(8 * i)) & np.uint32(255)]
    return out


class _Shifts:
    """Operators that append 1, 2, 4, 8 ... zero bytes, each the square of the one before."""

    def __init__(self):
        bytes_ = np.arange(256, dtype=np.uint32)
        values = [bytes_ << np.uint32(8 * i) for i in range(4)]
        self.operators = [np.stack([_STEP[v & np.uint32(255)] ^ (v >> np.uint32(8)) for v in values])]

    def by(self, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Every checksum, moved past as many zero bytes as ``lengths`` says."""
        out = values.copy()
        for bit in range(int(lengths.max(initial=0)).bit_length()):
            if bit == len(self.operators):
                last = self.operators[-1]
                self.operators.append(np.stack([_applied(last, part) for part in last]))
            chosen = np.flatnonzero((lengths >> bit) & 1)
            out[chosen] = _applied(self.operators[bit], out[chosen])
        return out


_shifts = _Shifts()


def running_values(line: bytes, crc: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(running CRC at the start, at the end, length) of each word of a line that goes on from ``crc``.

    A space stands before every word and nowhere else.
    """
    crc32, last = zlib.crc32, crc
    pieces = line.replace(b" ", b"\0 ").split(b"\0")[1:]
    ends = np.array([last := crc32(piece, last) for piece in pieces], dtype=np.uint32)
    state = np.concatenate((np.array([crc], np.uint32), ends[:-1])) ^ _ONES
    starts = _STEP[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8)) ^ _ONES
    spaces = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
    return starts, ends, np.diff(np.append(spaces, len(line))) - 1


def run_checksums(starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """CRC of every run of ``n`` consecutive words, joined by one space."""
    runs = len(starts) - n + 1
    if runs <= 0:
        return np.empty(0, np.uint32)
    upto = np.concatenate(([0], np.cumsum(lengths + 1)))
    size = upto[n:] - upto[:runs] - 1
    return ends[n - 1 :] ^ _shifts.by(starts[:runs], size)


def _line(data: bytes) -> bytes:
    """The words of a text, a space before each."""
    words = data.translate(_WORDS).split()
    return b" " + b" ".join(words) if words else b""


def short_counts(lines: list[bytes], low: int, high: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text; text, bucket and number of what occurs, in that order) of some short texts."""
    whole = b"".join(lines)
    n_words = np.fromiter((line.count(b" ") for line in lines), np.int64, len(lines))
    if not whole:
        return n_words, *(np.empty(0, np.int64),) * 3
    owner = np.repeat(np.arange(len(lines)), n_words)
    values = running_values(whole, 0)
    keys = []
    for n in range(low, high + 1):
        sums = run_checksums(*values, n)
        inside = owner[: len(sums)] == owner[len(owner) - len(sums) :]
        keys.append((owner[: len(sums)] * buckets + sums % np.uint32(buckets))[inside])
    held, counts = np.unique(np.concatenate(keys), return_counts=True)
    return n_words, held // buckets, held % buckets, counts


def long_counts(data: bytes, low: int, high: int, buckets: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(words, buckets that occur, how often) of one text, a stretch at a time."""
    total, crc, start, counts = 0, 0, 0, np.zeros(buckets, np.int64)
    values = (np.empty(0, np.uint32), np.empty(0, np.uint32), np.empty(0, np.int64))
    while start < len(data):
        end = start + STRETCH
        if end < len(data):
            blank = data.rfind(b" ", start, end)
            end = blank if blank > start else data.find(b" ", end)
            end = len(data) if end < 0 else end
        line, start = _line(data[start:end]), end
        if not line:
            continue
        fresh = running_values(line, crc)
        crc, total = int(fresh[1][-1]), total + len(fresh[0])
        tail = min(high - 1, len(values[0]))  # words before, of which runs may go on
        values = tuple(np.concatenate((v[len(v) - tail :], f)) for v, f in zip(values, fresh, strict=True))
        for n in range(low, high + 1):
            sums = run_checksums(*(v[max(0, tail - n + 1) :] for v in values), n)
            counts += np.bincount(sums % np.uint32(buckets), minlength=buckets)
    held = np.flatnonzero(counts)
    return total, held, counts[held]


def feature_counts(
    texts: list[bytes], low: int, high: int, buckets: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, number of buckets that occur; these buckets and how often, end to end) of texts in UTF-8."""
    n_words, sizes = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    held, counts, some, size = [], [], [], 0

    def finish(until: int) -> None:
        nonlocal some, size
        if some:
            first = until - len(some)
            n_words[first:until], owner, buckets_, numbers = short_counts(some, low, high, buckets)
            sizes[first:until] = np.bincount(owner, minlength=len(some))
            held.append(buckets_)
            counts.append(numbers)
            some, size = [], 0

    for i, text in enumerate(texts):
        if len(text) <= STRETCH:
            some.append(_line(text))
            size += len(text)
            if size > STRETCH:
                finish(i + 1)
            continue
        finish(i)
        n_words[i], buckets_, numbers = long_counts(text.translate(_WORDS), low, high, buckets)
        sizes[i] = len(buckets_)
        held.append(buckets_)
        counts.append(numbers)
    finish(len(texts))
    nothing = np.empty(0, np.int64)
    return n_words, sizes, np.concatenate([*held, nothing]), np.concatenate([*counts, nothing])


def features(rows: DataFrame, keep: list[str], low: int, high: int, buckets: int) -> DataFrame:
    """``keep`` columns of ``rows`` (with a column ``text``), ``n_words``, ``buckets`` and ``counts``, stored."""
    kept = rows.select(*keep, "text")
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in kept.drop("text").schema]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column(len(keep))]
            n_words, sizes, held, counts = feature_counts(texts, low, high, buckets)
            ends = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(held, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(counts))]
            columns = [*batch.columns[: len(keep)], pa.array(n_words), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "buckets", "counts"])

    schema = ", ".join([*kinds, "n_words bigint", "buckets array<int>", "counts array<bigint>"])
    return write_through(kept.mapInArrow(scan, schema), "features")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, count) of all rows of a batch, and where each row's end."""
    lists = batch.column("buckets")
    ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
    return lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy(), ends


def bucket_totals(table: DataFrame, buckets: int) -> np.ndarray:
    """How many features of the whole table fall into each bucket; added up in the tasks first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            held, counts, _ = _flat(batch)
            total += np.bincount(held, weights=counts, minlength=buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    parts = table.select("buckets", "counts").mapInArrow(add, "bucket bigint, n bigint")
    totals = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        totals[row["bucket"]] = row["n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: the log ratio of smoothed shares, in thousandths."""
    n, all_source, all_target = len(source), float(source.sum() + len(source)), float(target.sum() + len(target))
    ratio = [(t + 1.0) * all_source / ((s + 1.0) * all_target) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.fromiter((math.floor(1000 * math.log(r)) for r in ratio), np.int64, n)


def importance(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    low: int = MIN_N,
    high: int = MAX_N,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
    whole: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``;
    ``whole`` adds the row as struct ``doc``.

    Features are runs of ``low`` to ``high`` words. The weight sums their gains; the score adds
    noise that only seed and id decide, so that the best scores are a sample without
    replacement in proportion to exp(weight / 1000). Of the rows with ``min_words`` words or
    more, ``percent`` in a hundred (rounded down) are drawn: ranks 1, 2, ... by score, then
    smaller id; ids are last if null, and rows alike in both come in any order. Other rows
    have a null rank. A null or empty text has no words and weight 0; a null id counts as
    the text ``null`` in the noise. Rows that repeat an id are rows of their own. An empty table
    on either side is fine: without a target all buckets are smoothed alike. Columns of
    ``docs`` never clash with the ones added.
    """
    if not 1 <= low <= high or buckets < 1:
        raise ValueError("runs hold one word or more, and there must be a bucket")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), *([whole_row(docs).alias("doc")] if whole else [])
    )
    keep = ["id", "doc"] if whole else ["id"]
    table = features(rows, keep, low, high, buckets)
    wanted = features(target.select(F.col(target_text_col).alias("text")), [], low, high, buckets)
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_totals(table, buckets), bucket_totals(wanted, buckets)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, counts, ends = _flat(batch)
            upto = np.concatenate(([0], np.cumsum(counts)))
            weight = np.concatenate(([0], np.cumsum(gain.value[held] * counts)))
            sums = [pa.array(x[ends[1:]] - x[ends[:-1]], pa.int64()) for x in (upto, weight)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), batch.column("n_words"), *sums], names=[*keep, "n_words", "n_features", "weight"]
            )

    kinds = ", ".join(f"{k} {table.schema[k].dataType.simpleString()}" for k in keep)
    weighed = table.mapInArrow(weigh, f"{kinds}, n_words bigint, n_features bigint, weight bigint")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((draw + 0.5) / F.lit(4294967296.0))))
    scored = write_through(weighed.withColumn("score", F.col("weight") + noise), "weights")

    able = scored.filter(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    # rows alike in score and id are dealt to several tasks by their place in the table
    able = able.withColumn("tie", F.monotonically_increasing_id())
    ranked = range_index(able, F.desc("score"), F.asc_nulls_last("id"), F.asc("tie"), out="place")
    ranked = ranked.withColumn("rank", F.when(F.col("place") < drawn, F.col("place") + 1)).drop("place", "tie")
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``."""
    return importance(docs, target, whole=True, **options).filter(F.col("rank").isNotNull()).select("doc.*")
