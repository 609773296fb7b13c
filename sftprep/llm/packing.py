"""Packing token ids into fixed windows by minimum bin slack.

Documents are cut at multiples of the window; the whole windows are done, and what is left
of each document (shorter than a window) waits in a pool. The pool is a multiset of
lengths. To fill a window, its longest length is set first; a subset-sum table, one bit per
reachable total, finds which multiset of the other lengths comes closest to the capacity,
and walking back through the table gives how often each length is used. The same multiset
is then used as often as the pool allows.

Pools belong to a task and are bounded, so nothing is shuffled, and a task's sequences are
right whenever the task itself succeeds: a lost executor only means running its tasks
again. At the end of a task, where the pool gets thin, a piece is cut to close a window, and
the last window of all is cut into sequences whose lengths are powers of two, which need no
padding.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .token_ids import WIDTH, Vocabulary, encoder

WINDOW = 1024
POOL = 4096  # remainders that a task gathers before it fills windows
THIN = 512  # pool size at which filling stops while more documents are to come
ROWS_PER_BATCH = 4096
TASK_SHIFT = 40  # sequence numbers of one task


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (each used at most ``counts[length]`` times) whose total is
    the largest that does not exceed ``capacity``.

    Bit ``t`` of ``reach`` says that the total ``t`` can be made. A length that occurs n
    times enters as 1, 2, 4, ... copies, so that a window needs few steps.
    """
    reach, steps, keep = 1, [], (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, copies = min(counts[length], capacity // length), 1
        while left > 0:
            copies = min(copies, left)
            steps.append((length, copies, reach))
            reach |= (reach << (length * copies)) & keep
            left -= copies
            copies *= 2
        if reach >> capacity:
            break
    total, used = reach.bit_length() - 1, {}
    for length, copies, before in reversed(steps):
        if not (before >> total) & 1:
            total -= length * copies
            used[length] = used.get(length, 0) + copies
    return used


def window_plan(counts: dict[int, int], capacity: int, stop: int = 0) -> Iterator[tuple[dict[int, int], int]]:
    """(multiset of lengths, how many windows it fills), until at most ``stop`` lengths are left.

    ``counts`` is used up along the way.
    """
    left = sum(counts.values())
    while left > stop:
        longest = max(counts)
        counts[longest] -= 1
        others = {n: c for n, c in counts.items() if c}
        used = closest_fill(others, capacity - longest)
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[n] // c for n, c in used.items())
        for n, c in used.items():
            counts[n] -= c * times
            if not counts[n]:
                del counts[n]
        left -= times * sum(used.values())
        yield used, times


class Packer:
    """Places pieces (document, start, ids) in numbered sequences."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.pool: dict[int, list[tuple]] = {}
        self.pooled = 0
        self.placed: list[tuple] = []

    def _put(self, pieces: Iterable[tuple]) -> None:
        offset = 0
        for doc, total, start, ids in pieces:
            self.placed.append((doc, start, len(ids) // WIDTH, ids, total, self.sequence, offset))
            offset += len(ids) // WIDTH
        self.sequence += 1

    def add(self, doc, ids: bytes) -> None:
        total, step = len(ids) // WIDTH, self.window * WIDTH
        whole = len(ids) - len(ids) % step
        for at in range(0, whole, step):
            self._put([(doc, total, at // WIDTH, ids[at : at + step])])
        if whole < len(ids):
            self._pool(doc, total, whole // WIDTH, ids[whole:])
        if self.pooled >= POOL:
            self._fill(THIN)

    def _pool(self, doc, total, start, ids) -> None:
        self.pool.setdefault(len(ids) // WIDTH, []).append((doc, total, start, ids))
        self.pooled += 1

    def _take(self, length: int) -> tuple:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
        self.pooled -= 1
        return piece

    def _fill(self, stop: int) -> None:
        for used, times in window_plan({n: len(p) for n, p in self.pool.items()}, self.window, stop):
            if sum(n * c for n, c in used.items()) < self.window:
                break  # too thin for a full window
            for _ in range(times):
                self._put([self._take(n) for n, c in used.items() for _ in range(c)])

    def finish(self) -> None:
        """Empty the pool: close windows by cutting a piece, the last one into powers of two."""
        while self.pool:
            self._fill(0)
            if not self.pool:
                return
            used, _ = next(window_plan({n: len(p) for n, p in self.pool.items()}, self.window))
            pieces = [self._take(n) for n, c in used.items() for _ in range(c)]
            slack = self.window - sum(n * c for n, c in used.items())
            if self.pool:
                doc, total, start, ids = self._take(max(self.pool))
                pieces.append((doc, total, start, ids[: slack * WIDTH]))
                self._pool(doc, total, start + slack, ids[slack * WIDTH :])
                self._put(pieces)
            else:
                self._powers_of_two(pieces, self.window - slack)

    def _powers_of_two(self, pieces: list[tuple], total: int) -> None:
        for size in (1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1):
            held = []
            while size:
                doc, n, start, ids = pieces.pop()
                cut = min(size, len(ids) // WIDTH)
                held.append((doc, n, start, ids[: cut * WIDTH]))
                if cut * WIDTH < len(ids):
                    pieces.append((doc, n, start + cut, ids[cut * WIDTH :]))
                size -= cut
            self._put(held)

    def rows(self) -> list[tuple]:
        placed, self.placed = self.placed, []
        return placed


def pack(
    docs: DataFrame,
    vocabulary: Vocabulary,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
) -> DataFrame:
    """Pack the token ids of every document into sequences of at most ``window`` ids.

    One row per piece: the id column, ``start`` (ids of its document before it), ``length``,
    ``ids`` (little-endian unsigned 32-bit, as binary), ``doc_tokens`` (ids of the whole
    document with ``end_id``), ``sequence_id`` and ``offset`` (place in the sequence).

    A null text counts as empty: such a document is the single id ``end_id``. Rows with a
    null or repeated id are packed like any other. Texts may have any length: they are
    encoded in bounded stretches. An empty table gives no rows. Other columns of ``docs`` are
    not read; an id column named like one of the columns above is refused.
    """
    out = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    if id_col in out:
        raise ValueError(f"rename the id column {id_col}: the result has a column of that name")
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType)]
        + [T.StructField(c, T.BinaryType() if c == "ids" else T.LongType()) for c in out]
    )

    def pack_task(batches):
        encode = encoder(vocabulary, end_id)
        packer = Packer(window, TaskContext.get().partitionId() << TASK_SHIFT)
        target = None

        def emit(rows):
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, target, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        for batch in batches:
            if target is None:
                kinds = {"ids": pa.binary()}
                target = pa.schema([(id_col, batch.schema.field(0).type)] + [(c, kinds.get(c, pa.int64())) for c in out])
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc.as_py(), encode(text.as_py()))
                if len(packer.placed) >= ROWS_PER_BATCH:
                    yield emit(packer.rows())
        packer.finish()
        rows = packer.rows()
        for at in range(0, len(rows), ROWS_PER_BATCH):
            yield emit(rows[at : at + ROWS_PER_BATCH])

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(pack_task, schema)
