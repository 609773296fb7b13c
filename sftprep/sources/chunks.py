"""CSV files and JSON arrays read by many tasks, however large one file is.

Where a record ends depends on all that stands before it: a line break may be inside quotes, a
comma inside a string. So a file is read twice in pieces of some bytes. The first pass gives the
effect of each piece on a small scanner: the state it ends in for every state it may begin
in, and how deep brackets are then. The effects of a file's pieces, a few numbers each, are composed in
order, and the second pass cuts every piece exactly: it gives the records that begin in
it and reads on to the end of the last one. Records leave as texts and are parsed in the JVM.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

CHUNK_BYTES = 32 << 20
READ_ON = 1 << 20  # bytes read at a time
READ_FIRST = 1 << 14  # bytes read first behind the end of a piece; twice as many each time, up to READ_ON
TASK_BYTES = 8 << 20  # of pieces that lie side by side and are read by one task
TEXT_BYTES = 4 << 20  # of records in one batch
MAX_TASKS = 20_000
RUN = "file string, start bigint, length bigint"


@dataclass(frozen=True)
class Scanner:
    """Four states, and bytes that change them: the next state by state, for each of ``marks`` and, first, for all
    other bytes. Others must do the same once or many times, so that a run of them counts as one step."""

    marks: bytes
    steps: tuple[tuple[int, int, int, int], ...]


# states: before a field, in a bare field, in quotes, behind a quote in quotes
CSV = Scanner(b'",\n', ((1, 1, 2, 1), (2, 1, 3, 2), (0, 0, 2, 0), (0, 0, 2, 0)))
# states: outside strings, in a string, behind a backslash in a string; one is not used
JSON = Scanner(b'"\\', ((0, 1, 1, 0), (1, 0, 1, 0), (0, 2, 1, 0)))
STATES = range(4)
QUOTED = 2

# A map of four states onto four is one byte, two bits for each; so what two maps do one after the other is looked up.
_MAPS = np.stack([np.arange(256, dtype=np.uint8) >> 2 * s & 3 for s in STATES], axis=1)
_THEN = sum((_MAPS[:, _MAPS[:, s]].T << np.uint8(2 * s)) for s in STATES).astype(np.uint8).ravel()
_DEPTH = np.zeros(256, np.int8)
_DEPTH[list(b"[{")], _DEPTH[list(b"]}")] = 1, -1
_BETWEEN = _DEPTH != 0
_BETWEEN[ord(",")] = True


def as_map(states: Sequence[int]) -> int:
    return sum(int(after) << 2 * s for s, after in enumerate(states))


def steps_of(scanner: Scanner, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, maps) of the steps that bytes take; a run of other bytes is one step."""
    code = np.zeros(256, np.uint8)
    for i, mark in enumerate(scanner.marks, 1):
        code[mark] = i
    kinds = code[data]
    starts = kinds > 0
    starts[:1] = True
    starts[1:] |= kinds[:-1] > 0
    places = np.flatnonzero(starts)
    return places, np.array([as_map(s) for s in scanner.steps], np.uint8)[kinds[places]]


def _in_pairs(maps: np.ndarray) -> np.ndarray:
    even, odd = maps[: len(maps) // 2 * 2 : 2], maps[1::2]
    return _THEN[even.astype(np.uint16) << 8 | odd]


def composed(maps: np.ndarray) -> int:
    """What all maps do, one after the other."""
    if len(maps) == 0:
        return as_map(STATES)
    while len(maps) > 1:
        maps = np.concatenate([_in_pairs(maps), maps[len(maps) // 2 * 2 :]])
    return int(maps[0])


def states_before(maps: np.ndarray, state: int) -> np.ndarray:
    """The state before each step and, last, behind all of them: pairs are solved first, then what is between."""
    out = np.empty(len(maps) + 1, np.uint8)
    if len(maps) < 2:
        out[0] = state
        out[1:] = maps >> np.uint8(2 * state) & 3
        return out
    out[: len(maps) // 2 * 2 + 1 : 2] = states_before(_in_pairs(maps), state)
    even = maps[0::2]
    out[1::2] = even >> 2 * out[0::2][: len(even)] & 3
    return out


def _brackets(data: np.ndarray, places: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of brackets and commas outside strings, and what each adds to the depth."""
    at = np.flatnonzero(_BETWEEN[data])
    at = at[before[np.searchsorted(places, at, "right") - 1] == 0]
    return at, _DEPTH[data[at]]


def effect(scanner: Scanner, data: np.ndarray) -> tuple[list[int], list[int]]:
    """By the state at the start: the state at the end, and the change of depth."""
    states, depths = list(STATES), [0] * len(STATES)
    for begin in range(0, len(data), READ_ON):
        part = data[begin : begin + READ_ON]
        places, maps = steps_of(scanner, part)
        if scanner == JSON:
            change = {s: int(_brackets(part, places, states_before(maps, s))[1].sum()) for s in set(states)}
            depths = [d + change[s] for d, s in zip(depths, states)]
        done = composed(maps)
        states = [done >> 2 * s & 3 for s in states]
    return states, depths


def borders(scanner: Scanner, data: np.ndarray, state: int, depth: int) -> tuple[np.ndarray, int, int]:
    """(positions of the bytes between records, state and depth at the end).

    In a CSV these are line breaks outside quotes; in an array its brackets and the commas between elements.
    """
    places, maps = steps_of(scanner, data)
    before = states_before(maps, state)
    if scanner == CSV:
        return places[(data[places] == ord("\n")) & (before[:-1] != QUOTED)], int(before[-1]), 0
    at, change = _brackets(data, places, before)
    after = depth + np.cumsum(change, dtype=np.int64)
    between = ((change >= 0) & (after == 1)) | ((change < 0) & (after == 0))
    return at[between], int(before[-1]), int(after[-1]) if len(after) else depth


def _open(uri: str):
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(inner)


def begins_array(stream) -> bool:
    """Whether a JSON file is one array."""
    head, at = b"", 0
    while not head and (piece := stream.read_at(64, at)):
        head, at = piece.removeprefix(b"\xef\xbb\xbf" if at == 0 else b"").lstrip(), at + len(piece)
    return head.startswith(b"[")


def records(stream, scanner: Scanner, start: int, end: int, length: int, state: int, depth: int) -> Iterator[bytes]:
    """The records that begin in bytes ``start`` to ``end``, each whole; the open one is read on in growing steps, so
    that a small piece does not cost much more than its own bytes.

    A record of a CSV begins behind a line break, so one whose line break is the last byte of a piece belongs to
    that piece; an element of an array begins behind its bracket or comma.
    """
    held: list[bytes] | None = [] if scanner == CSV and start == 0 else None  # the open record
    at, more = start, READ_FIRST
    while at < length and (at < end or held is not None):
        if at < end:
            step = min(READ_ON, end - at)
        else:
            step, more = min(READ_ON, more, length - at), more * 2
        data = stream.read_at(step, at)
        if not data:
            raise OSError(f"a file ended at byte {at} of {length}: it was changed while it was read")
        found, state, depth_after = borders(scanner, np.frombuffer(data, np.uint8), state, depth)
        last = 0
        for i in found.tolist():
            if held is not None:
                yield b"".join([*held, data[last:i]])
                held = None
            if at + i >= end:
                return
            last, held = i + 1, []
        if held is not None:
            held.append(data[last:])
        at, depth = at + len(data), depth_after
    if scanner == JSON and at >= length and (depth or state):
        raise ValueError("a JSON array has no end")
    if held and scanner == CSV:  # no line break at the end of the file
        yield b"".join(held)


def lines(stream, start: int, end: int, length: int) -> Iterator[bytes]:
    """The lines that begin in bytes ``start`` to ``end``."""
    at, held = (start, [b""]) if start == 0 else (start - 1, None)
    while at < length and (at < end or held is not None):
        data = stream.read_at(min(READ_ON, length - at), at)
        last = 0
        while (i := data.find(b"\n", last)) >= 0:
            if held is not None:
                yield b"".join([*held, data[last:i]])
            if at + i + 1 >= end:
                return
            last, held = i + 1, []
        if held is not None:
            held.append(data[last:])
        at += len(data)
    if held:
        yield b"".join(held)


def _batched(rows: Iterator[tuple[str, int, int, str]]) -> Iterator[pd.DataFrame]:
    """Rows as frames of a bounded number of characters."""
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += len(row[3]) + 64
        if size >= TEXT_BYTES:
            yield pd.DataFrame(part, columns=["_file", "_start", "_place", "value"])
            part, size = [], 0
    if part:
        yield pd.DataFrame(part, columns=["_file", "_start", "_place", "value"])


RECORD = "_file string, _start bigint, _place bigint, value string"


def longest_file(spark: SparkSession, files: list[str]) -> int:
    """In bytes; only the listing is read."""
    return spark.read.format("binaryFile").load(files).agg(F.max("length")).first()[0] or 0


def runs_of(listed: DataFrame, run: int) -> DataFrame:
    """Files (with ``file, length``) in runs of ``run`` bytes."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(run).cast("bigint"))
    return listed.select("file", F.explode(starts).alias("start"), "length")


def check_header(file: str, text: str, names: list[str]) -> None:
    """Spark numbers empty and repeated names; all others must be those of the first file."""
    header = next(csv.reader([text]), [])
    if len(header) != len(names) or any(h not in ("", n) and n != f"{h}{i}" for i, (h, n) in enumerate(zip(header, names))):
        raise ValueError(f"the header of {file} is {header}, that of the first file {names}")


def record_texts(spark: SparkSession, files: list[str], names: list[str] | None, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Records of CSV files with the header ``names``, or elements of JSON arrays if there are none, as ``value``, with
    ``_file``, ``_start`` (of the run of pieces) and ``_place`` in the run. Empty records and elements are left out.

    Tasks are dealt out by bytes, not by pieces: small pieces that lie side by side make a run of ``TASK_BYTES``, which
    one task reads piece by piece."""
    scanner = JSON if names is None else CSV
    run = chunk * max(TASK_BYTES // chunk, 1)
    listed = spark.read.format("binaryFile").load(files).select(F.col("_metadata.file_path").alias("file"), "length")
    runs = runs_of(listed, run)
    n_tasks = min(max(runs.count(), 1), MAX_TASKS)

    def pieces(start, length):
        return [(s, min(s + chunk, length)) for s in range(start, min(start + run, length), chunk)]

    def effects(batches):
        for batch in batches:
            out = []
            for file, start, length in batch.itertuples(index=False):
                with _open(file) as stream:
                    done = [
                        effect(scanner, np.frombuffer(stream.read_at(end - at, at), np.uint8))
                        for at, end in pieces(start, length)
                    ]
                out.append((file, start, length, [s for s, _ in done], [d for _, d in done]))
            yield pd.DataFrame(out, columns=["file", "start", "length", "states", "depths"])

    def compose(pdf):  # a few numbers per piece of one file
        state = depth = 0
        out = []
        for row in pdf.sort_values("start").itertuples(index=False):
            states, depths = [], []
            for after, change in zip(row.states, row.depths):
                states.append(state)
                depths.append(depth)
                state, depth = int(after[state]), depth + int(change[state])
            out.append((row.file, row.start, row.length, states, depths))
        return pd.DataFrame(out, columns=["file", "start", "length", "states", "depths"])

    def texts_of(file, start, length, states, depths):
        with _open(file) as stream:
            for (at, end), state, depth in zip(pieces(start, length), states, depths):
                found = records(stream, scanner, at, end, length, int(state), int(depth))
                texts = (r.decode("utf-8", "replace").strip(" \t\r\n" if names is None else "\r") for r in found)
                if names is not None and at == 0:
                    check_header(file, next(texts, "").removeprefix("\ufeff"), names)
                yield from (t for t in texts if t)

    def cut(batches):
        def rows():
            for batch in batches:
                for row in batch.itertuples(index=False):
                    for place, text in enumerate(texts_of(*row)):
                        yield row.file, row.start, place, text

        return _batched(rows())

    each = "states array<array<int>>, depths array<array<bigint>>"  # per piece: by the state at its start
    known = runs.repartition(n_tasks).mapInPandas(effects, f"{RUN}, {each}")
    starts = known.groupBy("file").applyInPandas(compose, f"{RUN}, states array<int>, depths array<bigint>")
    return starts.repartition(n_tasks).mapInPandas(cut, RECORD)


def streamed_json(listed: DataFrame, chunk: int, n_tasks: int) -> DataFrame:
    """Records of JSON files, each in its own layout, as ``value``; ``listed`` (``file, length``) may be a stream.

    Lines are read in pieces. An array is cut by one task from front to back, as a stream has no
    second pass, with no more in memory than an element and ``READ_ON`` bytes.
    """

    def look(batches):
        for batch in batches:
            arrays = []
            for file in batch["file"]:
                with _open(file) as stream:
                    arrays.append(begins_array(stream))
            yield batch.assign(is_array=arrays)

    def read(batches):
        def rows():
            for batch in batches:
                for file, start, length, end, is_array in batch.itertuples(index=False):
                    with _open(file) as stream:
                        found = records(stream, JSON, 0, length, length, 0, 0) if is_array else lines(stream, start, end, length)
                        for record in found:
                            if text := record.decode("utf-8", "replace").strip("\ufeff \t\r\n"):
                                yield file, start, 0, text

        return _batched(rows())

    looked = listed.mapInPandas(look, "file string, length bigint, is_array boolean")
    zero = F.lit(0).cast("bigint")
    step = F.when(F.col("is_array"), F.greatest("length", F.lit(1))).otherwise(F.lit(chunk)).cast("bigint")
    starts = F.sequence(zero, F.greatest(F.col("length") - 1, zero), step)
    pieces = looked.select("file", F.explode(starts).alias("start"), "length", "is_array")
    end = F.least(F.col("start") + chunk, F.col("length"))
    dealt = pieces.select("file", "start", "length", end.alias("end"), "is_array").repartition(n_tasks)
    return dealt.mapInPandas(read, RECORD).select("value")
