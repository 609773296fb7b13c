"""Streams of examples. Row-wise operators run on a streaming DataFrame as they are;
what needs row order or counts runs per micro-batch and carries counters and open rows on.

Every micro-batch writes its own folder ``batch=<id>`` in overwrite mode, so a batch
that is run again after a failure replaces its output instead of doubling it. What comes out
only when the input has ended goes to ``batch=-<last id + 1>``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import mixing
from ..operators.ordering import file_index, key_cut, row_index
from ..operators.packing import PACK_ROWS, pack_blocks
from ..operators.split import BUFFER_SIZE, buffer_shuffle, buffer_slot, left_in_buffer
from ..storage import path_exists, write_through
from .state import Carried, ClosedAtEnd


def write_rows(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a row-wise result as Parquet and stop when the input is used up."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _store(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def concat_streams(streams: Sequence[DataFrame]) -> DataFrame:
    """Streams under each other; their rows are not mixed."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def _ordered(batch: DataFrame, key: str | None) -> tuple[DataFrame, str]:
    """A micro-batch with a unique integer key to order by. Without one of its own it is stored once and
    numbered as stored."""
    if key is not None:
        return batch, key
    return file_index(write_through(batch, "micro-batch"), "_row"), "_row"


def _numbered(batch: DataFrame, key: str | None) -> DataFrame:
    """A micro-batch with a dense ``row_idx``."""
    if key is None:
        return file_index(write_through(batch, "micro-batch"))
    return row_index(batch, key)


def _written_before(spark: SparkSession, path: str | None, batch_id: int) -> int:
    if path is None or not path_exists(spark, path):
        return 0
    return spark.read.parquet(path).filter(F.col("batch") < batch_id).count()


def deal_rows(
    stream: DataFrame, shares: Sequence[tuple[int, str]], rest_path: str | None, key: str | None, checkpoint: str
) -> StreamingQuery:
    """Give the first rows to one folder, the next ones to another, and so on.

    ``shares`` lists (number of rows, folder); what comes later goes to ``rest_path`` or
    nowhere. Rows of a micro-batch are ordered by ``key``, unique integers. How many rows a folder still
    takes is kept beside the first one, batch by batch, so a restart goes on where it stopped.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carried = Carried(spark, shares[0][1])
        last = carried.last(batch_id)
        # folders from before there was a ledger are counted
        lefts = last[1]["left"] if last else [n - _written_before(spark, path, batch_id) for n, path in shares]
        carried.put(batch_id, {"left": _deal(batch, batch_id, lefts)})

    def _deal(batch: DataFrame, batch_id: int, lefts: list[int]) -> list[int]:
        if not any(lefts):
            if rest_path:
                _store(batch, rest_path, batch_id)
            return lefts
        rows, order = _ordered(batch, key)

        def clean(part: DataFrame) -> DataFrame:
            return part if key else part.drop(order)

        after = list(lefts)
        for i, (left, (_, path)) in enumerate(zip(lefts, shares)):
            if left == 0:
                continue
            cut = key_cut(rows, order, left)
            if cut is None:  # fewer rows than wanted: all of them
                _store(clean(rows), path, batch_id)
                after[i] = left - rows.count()
                return after
            _store(clean(rows.filter(F.col(order) <= cut)), path, batch_id)
            rows, after[i] = rows.filter(F.col(order) > cut), 0
        if rest_path:
            _store(clean(rows), rest_path, batch_id)
        return after

    return _each_batch(stream, work, checkpoint)


def take_and_skip(
    stream: DataFrame, n: int, key: str | None, head_path: str, rest_path: str | None, checkpoint: str
) -> StreamingQuery:
    """The first ``n`` rows to ``head_path``, all later ones to ``rest_path`` (or nowhere)."""
    return deal_rows(stream, [(n, head_path)], rest_path, key, checkpoint)


def split_stream(
    stream: DataFrame,
    val_size: float,
    key: str | None,
    train_path: str,
    eval_path: str,
    checkpoint: str,
    buffer_size: int = BUFFER_SIZE,
    seed: int = 42,
) -> StreamingQuery:
    """The first rows are for evaluation and the rest, in order, for training; without a
    validation set the training rows are shuffled within the buffer."""
    if 1e-6 < val_size < 1:
        raise ValueError("a stream has no total: give val_size as a number of rows")
    if int(val_size) > 0:
        return take_and_skip(stream, int(val_size), key, eval_path, train_path, checkpoint)
    return shuffle_stream(stream, key, train_path, checkpoint, buffer_size, seed)


def shuffle_stream(
    stream: DataFrame, key: str | None, path: str, checkpoint: str, buffer_size: int = BUFFER_SIZE, seed: int = 42
) -> StreamingQuery:
    """Rows of each micro-batch numbered anew, shuffled within runs of ``buffer_size``."""

    def work(batch: DataFrame, batch_id: int) -> None:
        _store(buffer_shuffle(_numbered(batch, key), buffer_size, seed).drop("row_idx"), path, batch_id)

    return _each_batch(stream, work, checkpoint)


def _batch_after(batch_id: int) -> int:
    """The number under which rows go that come out after the last batch."""
    return -(batch_id + 1)


def moving_shuffle_stream(
    stream: DataFrame, key: str | None, path: str, checkpoint: str, buffer_size: int = BUFFER_SIZE, seed: int = 42
) -> ClosedAtEnd:
    """Rows in the order in which they leave a moving buffer (see ``moving_shuffle``): ``shuffled_idx``.

    The buffer, ``buffer_size`` rows at most, is carried from batch to batch and comes out when
    the input has ended; if the stream goes on later, a new buffer is filled.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        carried = Carried(batch.sparkSession, path)
        last = carried.last(batch_id)
        state = last[1] if last else {"base": 0, "rows": 0, "buffer": None}
        fresh = _numbered(batch, key).withColumn("row_idx", F.col("row_idx") + state["rows"])
        fresh = fresh.withColumn("_slot", buffer_slot(F.col("row_idx"), buffer_size, seed))
        if state["buffer"] is not None:
            schema = T.StructType([*fresh.schema.fields, T.StructField("_next", T.LongType())])
            held = carried.rows("placed", state["buffer"], schema).filter("_next IS NULL")
            fresh = fresh.unionByName(held.drop("_next"))
        following = F.lead("row_idx").over(Window.partitionBy("_slot").orderBy("row_idx"))
        placed = carried.store(fresh.withColumn("_next", following), "placed", batch_id)
        gone = placed.filter("_next IS NOT NULL").withColumn("shuffled_idx", F.col("_next") - buffer_size + state["base"])
        _store(gone.drop("_slot", "_next", "row_idx"), path, batch_id)
        rows = placed.agg(F.max("row_idx")).first()[0]
        carried.put(batch_id, state | {"rows": state["rows"] if rows is None else rows + 1, "buffer": batch_id})

    def close() -> None:
        carried = Carried(stream.sparkSession, path)
        last = carried.last()
        if last is None or last[1]["buffer"] is None:
            return
        batch_id, state = last
        placed = stream.sparkSession.read.parquet(carried.table_path("placed", state["buffer"]))
        start = state["base"] + max(0, state["rows"] - buffer_size)
        kept = left_in_buffer(placed.filter("_next IS NULL"), seed, "row_idx", start, "shuffled_idx")
        _store(kept.drop("_slot", "_next", "row_idx"), path, _batch_after(batch_id))
        carried.put(batch_id, {"base": state["base"] + state["rows"], "rows": 0, "buffer": None})

    return ClosedAtEnd(_each_batch(stream, work, checkpoint), close)


def interleave_streams(
    streams: Sequence[DataFrame],
    key: str | None,
    path: str,
    checkpoint: str,
    strategy: str = "interleave_under",
    probabilities: Sequence[float] | None = None,
    seed: int = 42,
    draws: str = "pcg64",
) -> ClosedAtEnd:
    """The mixture that ``mixing.mix`` gives of all rows, whatever batches they come in.

    ``row_idx`` of the result is the place in the whole mixture. Rows are numbered per source in the order of
    their arrival (inside a batch by ``key``, unique integers) and stored; a batch places all rows up to the first slot whose row has
    not come yet, reading back only the batches that hold them. A strategy that starts sources
    again places the rest when the input has ended; such a mixture takes no more rows then.
    """
    mixing.check_strategy(strategy)
    over, k = not strategy.endswith("under"), len(streams)
    union = concat_streams([s.withColumn("source_no", F.lit(i)) for i, s in enumerate(streams)])
    if probabilities is not None:
        mixing.check_probabilities(probabilities, [1] * k, over)

    def arrived(carried: Carried, schema, parts: list, low: list[int], high: list[int]) -> DataFrame:
        """Rows numbered from ``low`` up to, not with, ``high`` of their source."""
        batches = [b for b, first, end in parts if any(max(f, m) < min(e, n) for f, e, m, n in zip(first, end, low, high))]
        batches = batches or [parts[-1][0]]
        rows = carried.spark.read.schema(schema).parquet(*[carried.table_path("rows", b) for b in batches])
        at = F.col("row_idx")
        return rows.filter((at >= mixing.per_source(low)) & (at < mixing.per_source(high)))

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carried = Carried(spark, path)
        last = carried.last(batch_id)
        state = last[1] if last else {"seen": [0] * k, "placed": [0] * k, "open": []}
        if state.get("closed"):
            raise ValueError("the mixture was closed when its input ended; take a new folder")
        rows, order = _ordered(batch, key)
        numbered = row_index(rows, order, within=["source_no"])
        numbered = numbered.withColumn("row_idx", F.col("row_idx") + mixing.per_source(state["seen"]))
        stored = carried.store(numbered if key else numbered.drop(order), "rows", batch_id)
        seen = [a + b for a, b in zip(state["seen"], mixing.source_sizes(stored, k))]
        parts, low = [*state["open"], [batch_id, state["seen"], seen]], state["placed"]
        if probabilities is None:
            high = [min(seen)] * k
            mixed = arrived(carried, stored.schema, parts, low, high)
            mixed = mixed.withColumn("slot", F.col("row_idx") * k + F.col("source_no"))
        else:
            slots = write_through(mixing.slots_before_any_ends(spark, seen, low, probabilities, seed, draws), "slots")
            high = [a + b for a, b in zip(low, mixing.source_sizes(slots, k))]
            mixed = arrived(carried, stored.schema, parts, low, high)
            mixed = mixed.join(slots.withColumnRenamed("draw", "row_idx"), ["source_no", "row_idx"])
        _store(mixed.drop("row_idx", "source_no").withColumnRenamed("slot", "row_idx"), path, batch_id)
        left = [p for p in parts if any(e > n for e, n in zip(p[2], high))]
        carried.put(batch_id, {"seen": seen, "placed": high, "open": left})

    def close() -> None:
        spark = union.sparkSession
        carried = Carried(spark, path)
        last = carried.last()
        if not over or last is None or last[1].get("closed"):
            return
        batch_id, state = last
        rows = spark.read.parquet(f"{path}/_rows").drop("batch")
        mixed = mixing.mix(rows, k, strategy, probabilities, seed, draws)
        _store(mixed.filter(F.col("row_idx") >= sum(state["placed"])), path, _batch_after(batch_id))
        carried.put(batch_id, state | {"closed": True})

    return ClosedAtEnd(_each_batch(union, work, checkpoint), close)


def pack_stream(
    pieces: DataFrame, key: str | None, block_size: int, path: str, checkpoint: str, eos_id: int | None = None,
    pack_rows: int = PACK_ROWS,
) -> ClosedAtEnd:
    """Packing with groups of ``pack_rows`` rows in the order of their arrival (inside a batch by ``key``).

    A group is packed once all its rows have come, whatever batches they came in; the batches that
    hold rows of the open group are read again by then. When the input has ended, the open
    group is packed with the rows it has, and the next row begins a new one.
    """

    def packed(carried: Carried, schema, parts: list, low: int, high: int) -> DataFrame:
        batches = [b for b, first, end in parts if max(first, low) < min(end, high)] or [parts[-1][0]]
        rows = carried.spark.read.schema(schema).parquet(*[carried.table_path("pieces", b) for b in batches])
        return pack_blocks(rows.filter(F.col("row_idx").between(low, high - 1)), block_size, eos_id, pack_rows)

    def work(batch: DataFrame, batch_id: int) -> None:
        carried = Carried(batch.sparkSession, path)
        last = carried.last(batch_id)
        state = last[1] if last else {"rows": 0, "packed": 0, "open": []}
        numbered = _numbered(batch, key).select((F.col("row_idx") + state["rows"]).alias("row_idx"), "ids", "labels")
        stored = carried.store(numbered, "pieces", batch_id)
        rows = state["rows"] + stored.count()
        done, parts = rows // pack_rows * pack_rows, [*state["open"], [batch_id, state["rows"], rows]]
        _store(packed(carried, stored.schema, parts, state["packed"], done), path, batch_id)
        carried.put(batch_id, {"rows": rows, "packed": done, "open": [p for p in parts if p[2] > done]})

    def close() -> None:
        carried = Carried(pieces.sparkSession, path)
        last = carried.last()
        if last is None or last[1]["rows"] == last[1]["packed"]:
            return
        batch_id, state = last
        schema = carried.spark.read.parquet(carried.table_path("pieces", state["open"][0][0])).schema
        _store(packed(carried, schema, state["open"], state["packed"], state["rows"]), path, _batch_after(batch_id))
        begun = -(-state["rows"] // pack_rows) * pack_rows
        carried.put(batch_id, {"rows": begun, "packed": begun, "open": []})

    return ClosedAtEnd(_each_batch(pieces, work, checkpoint), close)
