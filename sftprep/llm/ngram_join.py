"""N-gram Jaccard join by T-occurrence search.

A set that is to share enough shingles with another must do so on its short inverted lists: with
fewer than the required number of long lists set aside, at least one of the others holds both.
So only the rarest shingles of each set (its prefix) are dealt out by Spark, and the long lists
of a block of sets are probed where the block is searched.

1. One pass counts shingles that come up again and again, for the order from short lists to long
   ones; any order gives the same links. A second pass stores, per text, the number of its shingles, the
   prefix, and a parity bitmap. Texts with equal sets are one class.
2. Every class on a list meets the first class of that list. Sizes and bitmaps (which differ in at most
   as many bits as the sets differ in shingles) rule pairs out; for those left, the full sets are
   fetched, and the first class searches the inverted lists of the others.
3. Links make components. Lists whose other classes still lie in several components are compared
   block by block: by bitmaps first, then by search in the inverted lists of what these leave.
   A block returns only links that join components, so large groups cost no pairs.

No step drops a link between different texts; no group is handled whole by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import if_small, write_through
from .components import connected_components
from .divide_skip import InvertedLists, divide_skip
from .shingles import shingle_set

WORDS = 5
PERCENT = 80
FREQUENT = 1 << 17  # lists whose lengths are known when shingles are ordered
AT_LEAST = 3  # texts of one chunk that hold a shingle which may be frequent
CHUNK = 1 << 22  # shingles of a chunk
BLOCK = 1 << 17  # shingles of a block, at SET_COST more for each set
SET_COST = 512


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with any set it is linked with, at least."""
    return -(-percent * n // 100)


def overlap(n, m, percent: int):
    """Shingles that linked sets of ``n`` and ``m`` share, at least; also for arrays."""
    return -(-percent * (n + m) // (100 + percent))


def parity(shingles: np.ndarray) -> np.ndarray:
    """A bit for each residue of the shingles, set if an odd number of them has it; some bits per shingle."""
    bits = 64
    while bits < 2 * len(shingles):
        bits *= 2
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _mark(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def frequent_shingles(docs: DataFrame, text_col: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (rising) and how many texts hold them, as far as chunks of texts show it.

    A shingle counts where a chunk holds it several times. The table that comes to the driver is
    of a fixed size, and orders lists only.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate([*held, np.empty(0, np.uint64)]), return_counts=True)
            often = n >= AT_LEAST
            return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(n[often])], names=["shingle", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.append(shingle_set(text.as_py(), words))
                size += len(held[-1])
                if size >= CHUNK:
                    yield counted()
                    held, size = [], 0
        yield counted()

    texts = docs.select(F.col(text_col).alias("text")).filter("text IS NOT NULL")
    parts = texts.mapInArrow(count, "shingle bigint, n bigint")
    summed = write_through(parts.groupBy("shingle").agg(F.sum("n").alias("n")), "join-frequent")
    # the least step of a log scale above which no more than the wanted number lies
    step = F.floor(8 * F.log2("n")).alias("step")
    room, least = FREQUENT, None
    for row in summed.groupBy(step).agg(F.count("*").alias("c")).orderBy(F.desc("step")).collect():  # at most 512
        room -= row["c"]
        if room < 0:
            break
        least = row["step"]
    rows = summed.filter(step >= F.lit(least)).toArrow()
    values, counts = rows["shingle"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(values)
    return values[order], counts[order]


def prefix(shingles: np.ndarray, percent: int, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles whose lists are not set aside: the rarest by count, then by value."""
    size = len(shingles) - least_overlap(len(shingles), percent) + 1
    at = np.searchsorted(values, shingles)
    at[at == len(values)] = 0
    known = values[at] == shingles if len(values) else np.zeros(len(shingles), dtype=bool)
    rare = shingles[~known][:size]
    if len(rare) == size:
        return rare
    others, n = shingles[known], counts[at[known]]
    return np.concatenate((rare, others[np.lexsort((others, n))][: size - len(rare)]))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``id``, ``mark`` (hash of the text), ``n`` (shingles) and, unless there are none, ``set_id``, ``bits``, ``prefix``."""
    spark, id_type = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    known = spark.sparkContext.broadcast(frequent_shingles(docs, text_col, words))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), _mark(text_col).alias("mark"))

    def lists(arrays: list[np.ndarray], missing: np.ndarray) -> pa.ListArray:
        ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
        flat = np.concatenate([*arrays, np.empty(0, np.int64)])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array(missing))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for batch in batches:
            counts, names, bits, prefixes = [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), words)
                some = len(shingles) > 0
                counts.append(len(shingles))
                names.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if some else None)
                bits.append(parity(shingles) if some else none)
                prefixes.append(prefix(shingles, percent, *known.value).view(np.int64) if some else none)
            missing = np.array(counts, dtype=np.int64) == 0
            columns = [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(names, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*columns, lists(bits, missing), lists(prefixes, missing)], names=["id", "mark", "n", "set_id", "bits", "prefix"]
            )

    schema = f"id {id_type}, mark bigint, n bigint, set_id binary, bits array<bigint>, prefix array<bigint>"
    return rows.mapInArrow(sign, schema)


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(node, shingles) of the classes in ``nodes``, from another look at one text of each."""
    wanted = classes.join(if_small(nodes), "node", "left_semi").select("node", "set_id", "rep.id", "rep.mark")
    rows = docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("text"), _mark(text_col).alias("own_mark"))
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("own_mark") == F.col("mark"))
    found = rows.filter("text IS NOT NULL").join(if_small(wanted), same).select("node", "set_id", "text")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for node, name, text in zip(*batch.columns, strict=True):
                data = shingle_set(text.as_py(), words).tobytes()
                if hashlib.blake2b(data, digest_size=16).digest() == name.as_py():
                    out.append((node.as_py(), data))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in out], pa.int64()), pa.array([d for _, d in out], pa.binary())], names=["node", "shingles"]
            )

    stored = write_through(found.mapInArrow(gather, "node bigint, shingles binary"), "join-sets")
    repeated = stored.groupBy("node").agg(F.count("*").alias("c")).filter("c > 1").isEmpty()
    return stored if repeated else write_through(stored.dropDuplicates(["node"]), "join-sets")


def _total(table: DataFrame, weight: Column) -> int:
    return int(table.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0])


def _by_units(rows: DataFrame, unit: list[str], total: int, work: Callable, out: str) -> DataFrame:
    """``work`` over the rows of each unit; small units are handled together, ``total`` being the weight of all.

    ``work`` gets the columns of a unit as lists and yields tuples of bigints.
    """
    bins = max(1, total // (2 * BLOCK))
    names, fields = rows.columns, [f.split(" ")[0] for f in out.split(", ")]

    def each(table: pa.Table) -> pa.Table:
        table = table.sort_by([(u, "ascending") for u in unit])
        columns = {name: table[name].to_pylist() for name in names}
        keys = list(zip(*(columns[u] for u in unit), strict=True))
        found, start = [], 0
        for end in range(1, len(keys) + 1):
            if end == len(keys) or keys[end] != keys[start]:
                found += work({name: values[start:end] for name, values in columns.items()})
                start = end
        values = zip(*found, strict=True) if found else [[]] * len(fields)
        return pa.table([pa.array(v, pa.int64()) for v in values], names=fields)

    return rows.withColumn("bin", F.pmod(F.xxhash64(*unit), F.lit(bins))).groupBy("bin").applyInArrow(each, out)


def _as_set(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint64)


def linked(lists: InvertedLists, query: np.ndarray, percent: int, wanted: np.ndarray | None = None) -> Iterator[int]:
    """The (wanted) sets that ``query`` is linked with."""
    needed = overlap(lists.sizes, len(query), percent).tolist()
    return divide_skip(lists.of(query, wanted), least_overlap(len(query), percent), needed)


def joining_links(sets: list[np.ndarray], labels: np.ndarray, one: np.ndarray, two: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links across sides ``one`` and ``two`` (places of sets) that join components.

    A query searches only for sets that are not in its component yet.
    """
    lists, labels = InvertedLists([sets[k] for k in one]), labels.copy()
    for a in two:
        wanted = labels[one] != labels[a]
        if wanted.any():
            for j in linked(lists, sets[a], percent, wanted):
                b = one[j]
                if labels[a] != labels[b]:
                    labels[labels == labels[b]] = labels[a]
                    yield a, b


def _from_pivots(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among pairs (pivot, node, n): each pivot searches the lists of its candidates, block by block."""
    weight = F.col("n") + SET_COST
    large = pairs.groupBy("pivot").agg(F.sum(weight).alias("w")).filter(F.col("w") > BLOCK)
    parts = F.coalesce(F.ceil(F.col("w") / BLOCK), F.lit(1))
    dealt = pairs.join(if_small(write_through(large, "join-large")), "pivot", "left").select(
        "pivot", "node", "n", F.pmod(F.xxhash64("node"), parts).alias("sub")
    )
    dealt = write_through(dealt, "join-dealt")
    members = dealt.join(sets, "node").select("pivot", "sub", "node", "shingles")
    firsts = dealt.select("pivot", "sub").distinct().withColumn("node", F.col("pivot")).join(sets, "node")
    rows = members.unionByName(firsts)

    def search(unit: dict[str, list]) -> Iterator[tuple[int, int]]:
        pivot, nodes = unit["pivot"][0], unit["node"]
        candidates = [k for k, node in enumerate(nodes) if node != pivot]
        query = _as_set(unit["shingles"][nodes.index(pivot)])
        for j in linked(InvertedLists([_as_set(unit["shingles"][k]) for k in candidates]), query, percent):
            yield pivot, nodes[candidates[j]]

    # a pivot comes with one candidate or more of about its size
    return _by_units(rows, ["pivot", "sub"], 2 * _total(dealt, weight), search, "a bigint, b bigint")


def plausible(n: np.ndarray, labels: np.ndarray, bits: list[np.ndarray], one: np.ndarray, two: np.ndarray, percent: int) -> np.ndarray:
    """Which sets have one of another component on the other side that sizes and bitmaps do not rule out."""
    hit = np.zeros(len(n), dtype=bool)
    width = np.array([len(b) for b in bits])
    for words in np.unique(width):
        own = np.flatnonzero(width == words)
        rows = np.stack([bits[k] for k in own])
        wide = np.flatnonzero(width == 2 * words)
        folded = np.array([bits[k][:words] ^ bits[k][words:] for k in wide], dtype=np.int64).reshape(-1, words)
        others, values = np.concatenate((own, wide)), np.concatenate((rows, folded))
        for k, row in zip(own, rows, strict=True):
            near = (labels[others] != labels[k]) & ((one[k] & two[others]) | (two[k] & one[others]))
            most = n[k] + n[others] - 2 * overlap(n[k], n[others], percent)
            near &= np.minimum(n[k], n[others]) * 100 >= np.maximum(n[k], n[others]) * percent
            at = np.flatnonzero(near)
            at = at[np.bitwise_count((values[at] ^ row).view(np.uint64)).sum(axis=1, dtype=np.int64) <= most[at]]
            hit[k] |= len(at) > 0
            hit[others[at]] = True
        if percent < 50:  # sizes may lie further apart than one fold
            hit |= True
    return hit


def _across_blocks(members: DataFrame, classes: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links (a, b) between components on the same list; ``members``: key, node, n, component.

    Large components of a list have blocks of their own, which are not compared with each other.
    """
    weight = F.col("n") + SET_COST
    whole = members.groupBy("key", "component").agg(F.sum(weight).alias("w")).filter(F.col("w") >= BLOCK)
    marked = members.join(if_small(write_through(whole, "join-large")), ["key", "component"], "left").withColumn(
        "pure", F.when(F.col("w").isNotNull(), F.col("component"))
    )
    rest = write_through(marked.filter("pure IS NULL").groupBy("key").agg(F.sum(weight).alias("rest")), "join-rest")
    parts = F.ceil(F.coalesce("w", "rest") / BLOCK)
    placed = marked.join(if_small(rest), "key", "left").select(
        "key", "node", "n", "component", "pure", F.pmod(F.xxhash64("node"), parts).alias("sub")
    )
    placed = write_through(placed.withColumn("block", F.xxhash64("key", "pure", "sub")), "join-members")
    blocks = placed.select("key", "pure", "block").distinct()
    tasks = blocks.select("key", F.col("pure").alias("p"), F.col("block").alias("x")).join(blocks, "key")
    tasks = tasks.filter("x <= block AND (p IS NULL OR pure IS NULL OR p <> pure)").select("x", F.col("block").alias("y"))
    # a block may be both sides of its task
    shares = write_through(tasks.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block")), "join-tasks")
    rows = placed.select("block", "node", "n", "component").join(shares, "block").join(classes.select("node", "bits"), "node")
    total = _total(shares.join(placed.groupBy("block").agg(F.sum(weight).alias("w")), "block"), F.col("w"))

    def sides(unit: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
        block = np.array(unit["block"])
        return block == unit["x"][0], block == unit["y"][0]

    def sift(unit: dict[str, list]) -> Iterator[tuple[int, ...]]:
        bits = [np.array(b, dtype=np.int64) for b in unit["bits"]]
        hit = plausible(np.array(unit["n"]), np.array(unit["component"]), bits, *sides(unit), percent)
        for k in np.flatnonzero(hit):
            yield tuple(unit[c][k] for c in ("x", "y", "block", "node", "n", "component"))

    columns = ", ".join(f"{c} bigint" for c in ("x", "y", "block", "node", "n", "component"))
    left = write_through(_by_units(rows, ["x", "y"], total, sift, columns), "join-left")
    if left.isEmpty():
        return left.select(F.col("node").alias("a"), F.col("node").alias("b"))
    both = left.join(fetch(left.select("node").distinct()), "node")

    def search(unit: dict[str, list]) -> Iterator[tuple[int, int]]:
        one, two = (np.flatnonzero(side) for side in sides(unit))
        sets, nodes = list(map(_as_set, unit["shingles"])), unit["node"]
        for a, b in joining_links(sets, np.array(unit["component"]), one, two, percent):
            yield nodes[a], nodes[b]

    return _by_units(both, ["x", "y"], _total(left, weight), search, "a bigint, b bigint")


def _differing(a: Column, b: Column) -> Column:
    """Bits in which two bitmaps differ, the wider one folded."""

    def folded(bits: Column, other: Column) -> Column:
        half = (F.size(bits) / 2).cast("int")
        halves = F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) > F.size(other), halves).otherwise(bits)

    apart = F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(apart, F.lit(0), lambda s, x: s + x)


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles``, ``component_id``.

    Texts are linked if 100 * shared shingles >= percent * shingles of either; the component is
    the smallest id that links reach. A row counts by its text, so rows that repeat an id each
    have the component of their text, and a row without id takes part through its text; the
    component is null if only such rows are in it. A text without words (also a null one) is
    linked with nothing, and its component is its own id. An empty table gives no rows; other
    columns are not read.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    signed = write_through(signatures(docs, id_col, text_col, words, percent), "join-signatures")
    gathered = (
        signed.filter(F.col("set_id").isNotNull())
        .groupBy("set_id")
        .agg(F.min("id").alias("id"), F.min(F.struct("id", "mark")).alias("rep"), *[F.first(c).alias(c) for c in ("n", "bits", "prefix")])
    )
    classes = write_through(gathered.withColumn("node", F.monotonically_increasing_id()), "join-classes")

    def fetch(nodes: DataFrame) -> DataFrame:
        return _sets(docs, classes, nodes, id_col, text_col, words)

    keyed = classes.select("node", "n", F.explode("prefix").alias("key"))
    lists = keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("m")).filter("m > 1")
    lists = write_through(lists.select("key", F.col("first.node").alias("pivot"), F.col("first.n").alias("pivot_n")), "join-lists")
    members = write_through(keyed.join(if_small(lists), "key").filter("node <> pivot"), "join-members")

    near = members.filter(F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * percent)
    pairs = near.select("pivot", "pivot_n", "node", "n").distinct()
    if percent >= 50:  # otherwise sizes may lie further apart than one fold
        total = F.col("n") + F.col("pivot_n")
        most = total - 2 * F.ceil(percent * total / (100 + percent))
        bits = classes.select("node", "bits")
        pairs = (
            pairs.join(bits, "node")
            .join(bits.select(F.col("node").alias("pivot"), F.col("bits").alias("pivot_bits")), "pivot")
            .filter(_differing(F.col("bits"), F.col("pivot_bits")) <= most)
        )
    pairs = write_through(pairs.select("pivot", "node", "n"), "join-pairs")
    needed = pairs.select("node").unionByName(pairs.select(F.col("pivot").alias("node"))).distinct()
    links = write_through(_from_pivots(pairs, fetch(needed), percent), "join-links")
    component = write_through(connected_components(links), "join-components")

    # lists whose classes, without the first, are still in several components
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
        .groupBy("lo", "hi", "m", "who", "also")  # the same classes on several lists: once
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    open_members = write_through(located.join(if_small(write_through(mixed, "join-mixed")), "key"), "join-open")
    more = write_through(_across_blocks(open_members, classes, fetch, percent), "join-more")
    wider = connected_components(
        more.join(component.withColumnsRenamed({"node": "a", "component": "ca"}), "a", "left")
        .join(component.withColumnsRenamed({"node": "b", "component": "cb"}), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )

    own = classes.select("set_id", "node", "id").join(component, "node", "left")
    own = own.select("set_id", "id", F.coalesce("component", "node").alias("node"))
    own = own.join(wider.withColumnRenamed("component", "wider"), "node", "left")
    named = write_through(own.select("set_id", "id", F.coalesce("wider", "node").alias("node")), "join-named")
    smallest = write_through(named.groupBy("node").agg(F.min("id").alias("component_id")), "join-smallest")
    final = write_through(named.select("set_id", "node").join(smallest, "node").select("set_id", "component_id"), "join-final")
    rows = signed.select("id", F.col("n").alias("n_shingles"), "set_id")
    lone = rows.filter(F.col("set_id").isNull()).select("id", "n_shingles", F.col("id").alias("component_id"))
    return lone.unionByName(rows.join(final, "set_id").select("id", "n_shingles", "component_id"))
