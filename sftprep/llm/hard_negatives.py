"""Hard negatives by exact integer scores in a residue number system.

Vectors are scaled to integers. Inner products of a block of anchors with a block of rows are
computed modulo several small primes, each as one product of float32 matrices: residues lie
around zero, and columns are cut so that every partial sum stays below 2^24, where float32 is
exact. The Chinese remainder theorem, in mixed radix with digits around zero, gives the
signed scores; as many primes are used as the lengths of the vectors call for.

Anchors and rows are dealt into blocks of bounded size, and a cell (a block of anchors, a block
of rows) is one group. The first round of cells finds the best rows of an anchor's own label;
they fix the windows in which the second round selects rows of other labels. Either round
returns a few rows per anchor and cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import if_small, write_through

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOWEST, HIGHEST = 80, 100  # percent of the positive's score
BLOCK_BYTES = 1 << 21  # of vectors in one block
CELL_SCORES = 1 << 20  # scores held at a time
# the largest primes of eight bits, so that residues around zero are at most 125
PRIMES = [n for n in range(251, 100, -2) if all(n % d for d in range(3, 16, 2))]
LONGEST = 1 << 62  # squared length from which on a score may not fit a long


def residues(vectors: np.ndarray, prime: int) -> np.ndarray:
    """Remainders in float32, from -(p-1)/2 to (p-1)/2."""
    half = prime // 2
    return (np.mod(vectors + half, prime) - half).astype(np.float32)


def _around_zero(values: np.ndarray, prime: int) -> np.ndarray:
    """Whole numbers in float32, up to 2^16 and a bit, as remainders around zero; all steps are exact."""
    return values - np.rint(values * np.float32(1 / prime)) * np.float32(prime)


class Block:
    """Vectors as columns of numbers, with their residues modulo each prime once they are asked for."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.longest = float(squares.max(initial=0)) ** 0.5
        self._residues: dict[int, np.ndarray] = {}

    def residues(self, prime: int) -> np.ndarray:
        if prime not in self._residues:
            self._residues[prime] = residues(self.vectors, prime)
        return self._residues[prime]


def primes_for(bound: float) -> list[int]:
    """Enough primes to tell all whole numbers from -bound to bound apart."""
    chosen, product = [], 1
    while product <= 2 * bound * (1 + 1e-9) + 2:
        chosen.append(PRIMES[len(chosen)])
        product *= chosen[-1]
    return chosen


def product_modulo(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """a @ b.T of residues, as residues."""
    step = ((1 << 24) - 2 * prime) // (prime // 2) ** 2  # columns whose products stay exact
    total = None
    for at in range(0, a.shape[1], step):
        part = a[:, at : at + step] @ b[:, at : at + step].T
        part = _around_zero(_around_zero(part, prime), prime)  # the first quotient may be off by one
        total = part if total is None else _around_zero(total + part, prime)
    return np.zeros((len(a), len(b)), np.float32) if total is None else total


def scores(anchors: Block, some: slice, rows: Block) -> np.ndarray:
    """Exact inner products of some anchors with all rows of a block."""
    primes = primes_for(anchors.longest * rows.longest)
    digits: list[np.ndarray] = []
    value = np.zeros((len(anchors.vectors[some]), len(rows.vectors)), np.int64)
    weight = 1
    for k, prime in enumerate(primes):
        digit = product_modulo(anchors.residues(prime)[some], rows.residues(prime), prime)
        for earlier, other in zip(digits, primes[:k], strict=True):  # Garner: one digit after another
            digit = _around_zero((digit - earlier) * np.float32(pow(other, -1, prime)), prime)
        digits.append(digit)
        # the value is below 2^62; wrapping on the way to it does no harm
        value += digit.astype(np.int64) * np.uint64(weight % (1 << 64)).astype(np.int64)
        weight *= prime
    return value


def best_of(values: np.ndarray, chosen: np.ndarray, k: int) -> np.ndarray:
    """Of the chosen places (rising) the k with the largest values; equal values in the order of their places."""
    own = values[chosen]
    if len(own) > k:
        least = np.partition(own, len(own) - k)[len(own) - k]
        chosen = chosen[own >= least]
        own = values[chosen]
    return chosen[np.argsort(-own, kind="stable")[:k]]


def prepared(marked: DataFrame, scale: int) -> DataFrame:
    """``row`` (a number of its own), ``id``, ``label``, ``dim`` and ``vec`` (integers, four bytes each) of rows that
    take part, stored."""
    rows = marked.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").select(
        F.monotonically_increasing_id().alias("row"),
        F.col("id").cast("bigint"),
        "label",
        F.col("vector").cast("array<double>"),
    )

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
                ends = np.concatenate(([0], np.cumsum(sizes)))
                squares = np.add.reduceat(np.append(whole * whole, 0.0), ends[:-1]) if len(sizes) else np.empty(0)
                squares[sizes == 0] = 0
                fits = squares < LONGEST  # not so for null (nan) and infinite components
            whole[~np.repeat(fits, sizes)] = 0
            data = whole.astype("<i4").tobytes()
            places = pa.array((4 * ends).astype(np.int32)).buffers()[1]
            vectors = pa.Array.from_buffers(pa.binary(), len(sizes), [None, places, pa.py_buffer(data)])
            columns = [*batch.columns[:3], pa.array(sizes), vectors]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "label", "dim", "vec"]).filter(pa.array(fits))

    kind = rows.schema["label"].dataType.simpleString()
    return write_through(
        rows.mapInArrow(scaled, f"row bigint, id bigint, label {kind}, dim bigint, vec binary"), "vectors"
    )


def _block(n_blocks: str) -> Column:
    return F.pmod(F.xxhash64("row"), F.col(n_blocks))


def _blocks_of(counts: str) -> Column:
    per_block = F.greatest(F.lit(1), F.floor(BLOCK_BYTES / F.greatest(F.col("dim") * 4, F.lit(1))))
    return F.ceil(F.col(counts) / per_block).cast("bigint")


def _all(n_blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n_blocks) - 1))


def _cells(anchors: DataFrame, rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Anchors (``anchor`` is true) and rows, each copied to the cells of its block.

    Every anchor block meets every row block of its dimension once, so a vector travels as
    often as there are blocks on the other side. Blocks are dealt by hash: no label, id or
    vector that stands on many rows makes a cell larger.
    """
    columns, sizes = ["row", "id", "label", "dim", "vec"], if_small(sizes)
    one = anchors.join(sizes, "dim").select(
        F.lit(True).alias("anchor"), *columns, "places", "marks", _block("anchor_blocks").alias("a"), _all("row_blocks").alias("b")
    )
    none = [F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in ("places", "marks")]
    two = rows.join(sizes, "dim").select(
        F.lit(False).alias("anchor"), *columns, *none, _all("anchor_blocks").alias("a"), _block("row_blocks").alias("b")
    )
    return one.unionByName(two)


_FOUND = [("anchor", "bigint"), ("anchor_id", "bigint"), ("place", "int"), ("row", "bigint"), ("id", "bigint"), ("score", "bigint")]


def _search(cells: DataFrame, k: int, window: tuple[int, int] | None) -> DataFrame:
    """Per cell and anchor the ``k`` best rows of the anchor's label; or, with a window in percent, of other labels
    for each of the anchor's ``marks``, the scores of its positives."""

    def vectors(column: pa.ChunkedArray, dim: int) -> Block:
        return Block(np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(len(column), dim).astype(np.int64))

    def chosen(found: np.ndarray, same: np.ndarray, places: list[int], marks: list[int]) -> Iterator[tuple[int, np.ndarray]]:
        if window is None:
            yield 0, best_of(found, np.flatnonzero(same), k)
            return
        bounds = [(-(-window[0] * mark // 100), window[1] * mark // 100) for mark in marks]
        others = np.flatnonzero(~same & (found >= min(bounds)[0]) & (found <= max(high for _, high in bounds)))
        for place, (low, high) in zip(places, bounds, strict=True):
            yield place, best_of(found, others[(found[others] >= low) & (found[others] <= high)], k)

    def search(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by([("id", "ascending"), ("row", "ascending")])
        anchors, rows = cell.filter(cell["anchor"]), cell.filter(pc.invert(cell["anchor"]))
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            dim = cell["dim"][0].as_py()
            a, b = vectors(anchors["vec"], dim), vectors(rows["vec"], dim)
            labels = pa.concat_arrays([*anchors["label"].chunks, *rows["label"].chunks]).dictionary_encode().indices.to_numpy()
            own, others = labels[: anchors.num_rows], labels[anchors.num_rows :]
            numbers, ids = rows["row"].to_numpy(), rows["id"].to_numpy()
            names = list(zip(*(anchors[c].to_pylist() for c in ("row", "id", "places", "marks")), strict=True))
            step = max(1, CELL_SCORES // len(numbers))
            for at in range(0, len(own), step):
                for i, found in enumerate(scores(a, slice(at, at + step), b), start=at):
                    row, name, places, marks = names[i]
                    same = others == own[i]
                    if window is None:
                        same &= numbers != row
                    for place, best in chosen(found, same, places, marks):
                        out += [(row, name, place, int(numbers[j]), int(ids[j]), int(found[j])) for j in best]
        columns = zip(*out, strict=True) if out else [[]] * len(_FOUND)
        arrays = [pa.array(c, pa.int32() if kind == "int" else pa.int64()) for c, (_, kind) in zip(columns, _FOUND, strict=True)]
        return pa.table(arrays, names=[name for name, _ in _FOUND])

    return cells.groupBy("dim", "a", "b").applyInArrow(search, ", ".join(f"{name} {kind}" for name, kind in _FOUND))


def _first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows per anchor and place over all cells, numbered from 1."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become floor(scale * x); scores are inner products of these integers. An anchor
    is a row for which ``is_anchor`` (over the columns of ``embeddings``) is true; its positives are its first
    ``positives`` other rows of its label, by score, then smaller id. For each, the first
    ``negatives`` rows of other labels follow whose score is from ``lowest`` to ``highest`` percent of
    the positive's.

    Rows with a null id, label, vector or component, or one that is not finite, take no part,
    nor do those whose squared integer length reaches 2^62, as scores might not fit a long. Rows
    meet rows of as many components as they have; empty vectors score 0. Rows that repeat an id
    are rows of their own, also as anchors; rows alike in score and id come in any order. An
    empty table, or no anchors, gives no rows. Other columns are not read.
    """
    marked = embeddings.select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    # numbers of rows: odd for anchors, even for others
    anchors = prepared(marked.filter("anchor"), scale).withColumn("row", F.col("row") * 2 + 1)
    rows = anchors.unionByName(prepared(marked.filter("NOT anchor"), scale).withColumn("row", F.col("row") * 2))
    counted = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(F.col("row") % 2 != 0).alias("n_anchors"))
    sizes = write_through(
        counted.filter("n_anchors > 0").select("dim", _blocks_of("n").alias("row_blocks"), _blocks_of("n_anchors").alias("anchor_blocks")),
        "blocks",
    )
    plain = anchors.withColumns({"places": F.lit(None).cast("array<int>"), "marks": F.lit(None).cast("array<bigint>")})
    near = write_through(_first(_search(_cells(plain, rows, sizes), positives, None), positives), "positives")
    near = near.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))

    of_anchor = near.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    open_anchors = anchors.join(if_small(of_anchor), "row").select(
        *anchors.columns, F.col("p.place").alias("places"), F.col("p.positive_score").alias("marks")
    )
    found = _first(_search(_cells(open_anchors, rows, sizes), negatives, (lowest, highest)), negatives)
    return found.join(near, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
