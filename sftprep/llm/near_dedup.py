"""Near duplicates by b-bit MinHash.

1. One pass over the texts: the set of word shingles of each, its minima under 128
   permutations, of which the low bits are kept, packed into longs, and the keys of 24 bands
   of five minima each. Texts with equal sets are one class, a node with a number of its own.
2. Classes that share a band key are candidates. Each class of a bucket is compared with the
   bucket's first class: the similarity estimated from the bit counts, corrected for chance
   collisions of the low bits, decides whether the full sets are fetched and compared. So a
   bucket of any size gives one pair per class.
3. Links join classes into components. Buckets whose other classes still lie in different
   components are compared in full, block by block: first the signatures, then, of classes with
   an estimate above the cut for one of another component, the sets; a block task returns
   only the links that join components. Classes of one component are not compared
   again, so a large group of copies that has come together costs nothing here.

A pair exactly at the threshold shares no band with a probability of 7e-5 at 0.8 and 8e-7 at
0.85, and its estimate falls below the cut with one below 1e-5; every link that is returned
holds on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import if_small, whole_row, write_through
from .components import connected_components
from .shingles import mix, shingle_set

WORDS = 5
PERCENT = 80
PERMUTATIONS = 128
BITS = 4  # low bits kept of each minimum
BANDS, ROWS = 24, 5
DEVIATIONS = 4.5  # of the estimate below the threshold at which full sets are still compared
BLOCK = 256  # classes of a bucket in one block

_LANES = 64 // BITS
_LOW = sum(1 << (BITS * i) for i in range(_LANES))  # the lowest bit of every lane
_draws = np.random.default_rng(20240501)
_A = (_draws.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _draws.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)
_BAND_WEIGHTS = _draws.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each permutation."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(PERMUTATIONS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(values), 4096):
        images = np.multiply.outer(_A, values[at : at + 4096])
        images += _B[:, None]
        np.minimum(best, images.min(axis=1), out=best)
    return best


def packed(best: np.ndarray) -> np.ndarray:
    """The low bits of (mixed) minima, several to a long; works on many rows."""
    low = mix(best.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    lanes = low.reshape(*best.shape[:-1], -1, _LANES) << (np.arange(_LANES, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(lanes, axis=-1).view(np.int64)


def band_keys(best: np.ndarray) -> np.ndarray:
    rows = best[..., : BANDS * ROWS].astype(np.uint64).reshape(*best.shape[:-1], BANDS, ROWS)
    sums = (rows * _BAND_WEIGHTS).sum(axis=-1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    return mix(mix(sums) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def estimated(a: Column, b: Column) -> Column:
    """Similarity from packed signatures: matching lanes by bit count, less chance matches."""

    def differing(x, y):
        z = x.bitwiseXOR(y)
        folded = z
        for i in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(z, i))
        return F.bit_count(folded.bitwiseAND(F.lit(_LOW - (1 << 64) if _LOW >> 63 else _LOW)))

    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    return ((1 - apart / F.lit(float(PERMUTATIONS))) - chance) / (1 - chance)


def promising(sigs: np.ndarray, sizes: np.ndarray, labels: np.ndarray, percent: int) -> np.ndarray:
    """Which rows have another of a different label that their sizes and signatures let be linked."""
    chance, cut = 2.0**-BITS, estimate_cut(percent)
    most = int((1 - (cut * (1 - chance) + chance)) * PERMUTATIONS + 1e-9)  # differing lanes at the cut
    sigs, found = sigs.view(np.uint64), np.zeros(len(sigs), dtype=bool)
    for i in range(len(sigs)):
        fit = np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * percent
        others = np.flatnonzero(fit & (labels != labels[i]))
        z = sigs[others] ^ sigs[i]
        folded = z.copy()
        for b in range(1, BITS):
            folded |= z >> np.uint64(b)
        found[i] = (np.bitwise_count(folded & np.uint64(_LOW)).sum(axis=1) <= most).any()
    return found


def estimate_cut(percent: int) -> float:
    chance, j = 2.0**-BITS, percent / 100
    p = chance + (1 - chance) * j
    return j - DEVIATIONS * (p * (1 - p) / PERMUTATIONS) ** 0.5 / (1 - chance)


def _set_name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _mark(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``id``, ``mark`` (hash of the text), ``n`` (shingles) and, unless there are none, ``set_id``,
    ``sig`` and ``bands``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), _mark(text_col).alias("mark")
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, names, bests = [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), words)
                counts.append(len(shingles))
                names.append(_set_name(shingles) if len(shingles) else None)
                bests.append(minima(shingles))
            best = np.array(bests, dtype=np.uint32).reshape(-1, PERMUTATIONS)
            missing = np.array(counts) == 0
            lists = []
            for values in (packed(best), band_keys(best)):
                ends = np.cumsum(np.append(0, ~missing), dtype=np.int32) * np.int32(values.shape[1])
                flat = pa.array(values[~missing].ravel())
                lists.append(pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(missing)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(names, pa.binary()), *lists],
                names=["id", "mark", "n", "set_id", "sig", "bands"],
            )

    return rows.mapInArrow(sign, f"id {id_type}, mark bigint, n bigint, set_id binary, sig array<bigint>, bands array<bigint>")


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(node, shingles) of the classes in ``wanted`` (node), from another look at one text of each."""
    chosen = classes.join(if_small(wanted), "node", "left_semi").select("node", "set_id", "rep.id", "rep.mark")
    rows = docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("text"), _mark(text_col).alias("own_mark"))
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("own_mark") == F.col("mark"))
    found = rows.filter(F.col("text").isNotNull()).join(if_small(chosen), same).select("node", "set_id", "text")

    def gather(batches):
        for batch in batches:
            nodes, sets = [], []
            for node, name, text in zip(*batch.columns, strict=True):
                shingles = shingle_set(text.as_py(), words)
                if _set_name(shingles) == name.as_py():
                    nodes.append(node.as_py())
                    sets.append(shingles)
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["node", "shingles"]
            )

    stored = write_through(found.mapInArrow(gather, "node bigint, shingles array<bigint>"), "near-sets")
    once = stored.groupBy("node").agg(F.count("*").alias("c")).filter("c > 1").isEmpty()
    return stored if once else write_through(stored.dropDuplicates(["node"]), "near-sets")  # rows that repeat id and text


def joining_links(sets: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between classes of different components, as few as join what the links join.

    All intersections come from one product of the class-by-shingle matrix, built from
    shingles that more than one but not all classes hold, a slice at a time.
    """
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.full((m, m), float((held == m).sum()), dtype=np.float32)
    useful = (held > 1) & (held < m)
    place = np.cumsum(useful) - 1
    mine = useful[column]
    owner, column = owner[mine], place[column[mine]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for at in range(0, int(useful.sum()), 4096):
        lo, hi = np.searchsorted(column, (at, at + 4096))
        part = np.zeros((m, 4096), dtype=np.float32)
        part[owner[lo:hi], column[lo:hi] - at] = 1
        common += part @ part.T
    common = np.rint(common).astype(np.int64)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    labels, links = labels.copy(), []
    for i in range(m):
        near = np.flatnonzero(linked[i] & (labels != labels[i]))
        while len(near):
            j = near[0]
            links.append((i, int(j)))
            labels[labels == labels[j]] = labels[i]
            near = near[labels[near] != labels[i]]
    return links


def _in_blocks(members: DataFrame) -> DataFrame:
    """Pairs of blocks that together hold all pairs of components inside buckets, as rows ``task``, ``node``, ``n``,
    ``component``; ``members``: key, node, n, component.

    Big components of a bucket have blocks of their own, which are not compared with each other.
    """
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("c"))
    blocked = members.join(sizes, ["key", "component"]).select(
        "key",
        "node",
        "n",
        "component",
        F.when(F.col("c") >= BLOCK, F.col("component")).alias("pure"),
        F.when(F.col("c") >= BLOCK, F.ceil(F.col("c") / BLOCK)).alias("parts"),
    )
    rest = blocked.filter("pure IS NULL").groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("rest"))
    placed = write_through(
        blocked.join(rest, "key", "left").select(
            "key", "node", "n", "component", "pure", F.pmod(F.xxhash64("node"), F.coalesce("parts", "rest")).alias("sub")
        ),
        "near-members",
    )
    blocks = placed.select("key", "pure", "sub", F.xxhash64("key", "pure", "sub").alias("block")).distinct()
    one, two = blocks.select("key", F.col("pure").alias("p"), F.col("block").alias("x")), blocks
    tasks = one.join(two, "key").filter("x <= block AND (p IS NULL OR pure IS NULL OR p <> pure)")
    shares = tasks.select(
        F.xxhash64("x", "block").alias("task"), F.explode(F.array_distinct(F.array("x", "block"))).alias("block")
    )
    rows = placed.withColumn("block", F.xxhash64("key", "pure", "sub")).join(shares, "block")
    return rows.select("task", "node", "n", "component")


def _across_blocks(docs: DataFrame, classes: DataFrame, members: DataFrame, percent: int, *texts) -> DataFrame:
    """Links (a, b) between components inside buckets."""

    def sift(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("node")
        labels = pd.factorize(group["component"])[0]
        sigs = np.array(group["sig"].tolist(), dtype=np.int64)
        return group[promising(sigs, group["n"].to_numpy(), labels, percent)][["task", "node", "component"]]

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.reset_index(drop=True)
        labels = pd.factorize(group["component"])[0]
        arrays = [np.asarray(s, dtype=np.int64) for s in group["shingles"]]
        sizes = np.array([len(s) for s in arrays], dtype=np.int64)
        nodes = group["node"]
        links = joining_links(arrays, sizes, labels, percent)
        return pd.DataFrame({"a": [nodes[i] for i, _ in links], "b": [nodes[j] for _, j in links]})

    signed = _in_blocks(members).join(classes.select("node", "sig"), "node")
    left = signed.groupBy("task").applyInPandas(sift, "task bigint, node bigint, component bigint")
    left = write_through(left, "near-sifted")
    sets = _sets(docs, classes, left.select("node").distinct(), *texts)
    return left.join(sets, "node").groupBy("task").applyInPandas(compare, "a bigint, b bigint")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles``, ``component_id``; also ``mark``, a hash of the text, and
    ``stays``: whether it is the row of its group that stays.

    Texts are linked if 100 * shared shingles >= percent * shingles of either; the component is
    the smallest id that links reach. A row counts by its text, so rows that repeat an id each
    have the component of their text, and a row without id takes part through its text; the
    component is null if only such rows are in it. A text without words is linked with
    nothing; its component is its own id, and it stays. Of a group the row with the smallest id (and, among
    texts under that id, one) stays, with the rows that repeat both. An empty table gives no rows;
    other columns are not read.
    """
    signed = write_through(signatures(docs, id_col, text_col, words), "near-signatures")
    # rows without id come last
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "mark")).alias("rep")
    gathered = (
        signed.filter(F.col("set_id").isNotNull())
        .groupBy("set_id")
        .agg(first, F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    )
    classes = write_through(gathered.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    keyed = classes.select("node", "n", F.explode("bands").alias("key"))
    buckets = write_through(
        keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("m")).filter("m > 1").select("key", "pivot"),
        "near-buckets",
    )
    members = write_through(keyed.join(if_small(buckets), "key").filter("node <> pivot"), "near-candidates")

    left = classes.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("sig").alias("pivot_sig"))
    pairs = (
        members.select("pivot", "node")
        .distinct()
        .join(classes.select("node", "n", "sig"), "node")
        .join(left, "pivot")
        .filter(F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * percent)
        .filter(estimated(F.col("sig"), F.col("pivot_sig")) >= estimate_cut(percent))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    )
    pairs = write_through(pairs, "near-pairs")
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets(docs, classes, needed, id_col, text_col, words)
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a"
    )
    common = F.size(F.array_intersect("sa", "sb"))
    links = both.filter(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")
    component = write_through(connected_components(links), "near-components")

    # buckets whose classes, without the pivot, are still in several components
    located = members.join(component, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    mixed = (
        located.groupBy("key")
        .agg(
            F.min("component").alias("lo"),
            F.max("component").alias("hi"),
            F.count("*").alias("m"),
            F.sum(F.shiftright(F.xxhash64("node"), 24)).alias("who"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("also"),
        )
        .filter("lo <> hi")
        .groupBy("lo", "hi", "m", "who", "also")  # the same classes in several bands: once
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    open_members = write_through(located.join(if_small(mixed), "key"), "near-open")
    across = _across_blocks(docs, classes, open_members, percent, id_col, text_col, words)
    more = write_through(across, "near-more")
    steps = more.join(component.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
        component.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left"
    )
    merged = connected_components(steps.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))

    own = classes.select("set_id", "node", "rep").join(component, "node", "left")
    last = own.select("set_id", "rep", F.coalesce("component", "node").alias("node"))
    last = last.join(merged.withColumnRenamed("component", "wider"), "node", "left")
    named = write_through(last.select("set_id", "rep", F.coalesce("wider", "node").alias("node")), "near-named")
    kept = write_through(named.groupBy("node").agg(F.min("rep").alias("kept")), "near-kept")
    final = write_through(named.select("set_id", "node").join(kept, "node").select("set_id", "kept"), "near-final")

    rows = signed.select("id", "mark", F.col("n").alias("n_shingles"), "set_id")
    lone = rows.filter(F.col("set_id").isNull()).drop("set_id")
    lone = lone.withColumns({"component_id": F.col("id"), "stays": F.lit(True)})
    same = F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("mark") == F.col("kept.mark"))
    grouped = rows.filter(F.col("set_id").isNotNull()).join(final, "set_id")
    grouped = grouped.withColumns({"component_id": F.col("kept.id"), "stays": same}).drop("set_id", "kept")
    return lone.unionByName(grouped)


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: that with the smallest id.

    Rows that repeat an id and a text share their fate. A row without an id goes if its group
    has one with an id, or another text of no id that stays.
    """
    groups = near_groups(docs, id_col, text_col, words, percent)
    gone = groups.filter(~F.col("stays")).select(F.col("id").alias("gone"), "mark").distinct()
    rows = docs.select(F.col(id_col).alias("id"), _mark(text_col).alias("mark"), whole_row(docs).alias("doc"))
    gone = if_small(write_through(gone, "near-gone").withColumnRenamed("mark", "gone_mark"))
    same = (F.col("mark") == F.col("gone_mark")) & F.col("id").eqNullSafe(F.col("gone"))
    return rows.join(gone, same, "left_anti").select("doc.*")
