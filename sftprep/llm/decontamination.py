"""Benchmark decontamination with one Aho-Corasick automaton.

Every window of words of every benchmark item is a pattern, written with a space before,
between and after the words. A document is brought to the same form, byte by byte so that
offsets stay known, and goes through the automaton once. Hits are mapped back to offsets
of the original text.

The benchmark is broadcast in blocks of bounded size. Normally there is one block and so
one automaton and one pass; a larger benchmark sends each document through one automaton
after another inside the same job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import whole_row

WINDOW = 10
BLOCK_BYTES = 1 << 19  # of benchmark text in one automaton

# A-Z in lower case; every ASCII character that is neither a digit nor a letter as a space
_WORDS = bytes(
    i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else i + 32 if 65 <= i <= 90 else 32 for i in range(256)
)


def word_bytes(text: str) -> bytes:
    """The text with its words in lower case and spaces for all else, byte for byte."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS)


def windows(text: str, width: int = WINDOW) -> set[bytes]:
    """All runs of ``width`` words; a shorter text is one run, one without words none."""
    words = word_bytes(text).split()
    run = min(width, len(words))
    return {b" ".join(words[i : i + run]) for i in range(len(words) - run + 1)} if run else set()


def automaton(items: list[tuple[str, str]], width: int = WINDOW) -> ahocorasick.Automaton:
    """Patterns of all items; the value is (number of words, ids of the items with that window)."""
    owners: dict[bytes, set[str]] = {}
    for name, text in items:
        for window in windows(text, width):
            owners.setdefault(window, set()).add(name)
    found = ahocorasick.Automaton()
    for window, names in owners.items():
        found.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(names)))
    if owners:
        found.make_automaton()
    return found


def hits(words: list[bytes], matcher: ahocorasick.Automaton) -> tuple[np.ndarray, set[str]]:
    """Which words lie in an occurrence of a pattern, and the items whose patterns occur."""
    line = b" " + b" ".join(words) + b" "
    ends = list(matcher.iter(line.decode("latin-1")))
    hit = np.zeros(len(words) + 1, dtype=np.int64)
    names: set[str] = set()
    if ends:
        spaces = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
        last = np.searchsorted(spaces, [end for end, _ in ends])
        for stop, (_, (run, owners)) in zip(last, ends, strict=True):
            hit[stop - run] += 1
            hit[stop] -= 1
            names.update(owners)
    return np.cumsum(hit[:-1]) > 0, names


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where every word starts and ends, in characters of the text."""
    data = text.encode("utf-8", "surrogatepass")
    inside = np.frombuffer(data.translate(_WORDS), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)))
    return chars[edges[::2]], chars[edges[1::2]]


def spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as (start, end) in characters of the original text."""
    starts, ends = word_places(text)
    runs = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(runs[::2], runs[1::2], strict=True)]


_SPANS = "spans array<struct<start:bigint,end:bigint>>"
_SPAN_LISTS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

_built: dict[tuple, ahocorasick.Automaton] = {}


def _matcher(items: list[tuple[str, str]], width: int) -> ahocorasick.Automaton:
    """Built once per Python worker, as long as it serves one benchmark block."""
    key = (width, *items)
    if key not in _built:
        _built.clear()
        _built[key] = automaton(items, width)
    return _built[key]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    whole: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``n_hit``, ``items`` (ids as sorted strings) and
    ``spans`` (start and end of hit passages in the original text); ``whole`` adds the row as struct ``doc``.

    Null texts have no words and no hits. Items without words are never found; items that
    repeat an id are one item, a null id is the item ``null``. An empty table on either
    side is fine. Columns of ``docs`` never clash with the ones added.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("name"),
        F.coalesce(F.col(item_text_col), F.lit("")).alias("text"),
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))

    id_type = docs.schema[id_col].dataType.simpleString()
    doc = [whole_row(docs).alias("doc")] if whole else []
    doc_type = f", doc {docs.select(*doc).schema[0].dataType.simpleString()}" if whole else ""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<bigint>").alias("hit"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        *doc,
    )
    schema = f"id {id_type}, text string, n_words bigint, items array<string>, hit array<bigint>, {_SPANS}{doc_type}"
    for block in range(blocks):
        part = [(r["name"], r["text"]) for r in dealt.filter(F.col("block") == block).select("name", "text").collect()]
        rows = rows.mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(part), window, block == blocks - 1), schema)
    return rows.select(
        "id", "n_words", F.size("hit").cast("bigint").alias("n_hit"), "items", "spans", *(["doc"] if whole else [])
    )


def _scan(items, window: int, last: bool):
    """One pass: adds the hit words and the items of one block to those found before; the last
    pass needs the text no more."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matcher = _matcher(items.value, window)
            counts, names, marks, places = [], [], [], []
            for text, before, hit_before in zip(batch.column(1), batch.column(3), batch.column(4), strict=True):
                words = word_bytes(text.as_py() or "").split()
                counts.append(len(words))
                hit, found = hits(words, matcher) if words and len(matcher) else (np.zeros(len(words), dtype=bool), set())
                hit[hit_before.as_py()] = True
                marks.append(np.flatnonzero(hit).tolist())
                places.append([{"start": a, "end": b} for a, b in spans(text.as_py(), hit)] if marks[-1] else [])
                names.append(sorted(found.union(before.as_py())))
            columns = [
                batch.column(0),
                pa.nulls(len(counts), batch.column(1).type) if last else batch.column(1),
                pa.array(counts, pa.int64()),
                pa.array(names, pa.list_(pa.string())),
                pa.array(marks, pa.list_(pa.int64())),
                pa.array(places, _SPAN_LISTS),
                *batch.columns[6:],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return scan


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a window of a benchmark item."""
    found = find_contamination(docs, benchmark, whole=True, **options)
    return found.filter("n_hit = 0").select("doc.*")
