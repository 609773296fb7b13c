"""Registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.templates import (
    MODEL_FAMILY,
    TEMPLATES,
    conversation_turns,
    render_turns,
    system_or_default,
    template_for,
)
from ..functions.tokenizers import CallableTokenizer, CodepointTokenizer, SpecialTokens
from ..operators import encode, metrics, mixing, normalize, ordering, packing, split, turns, vocab
from ..operators.batching import assign_batches, pad_batches
from ..operators.lookup import with_template_name
from ..sources import cache, files, integrity, manifest, sinks
from ..storage import date_files, list_files, new_folder
from ..streaming import jobs

# Ids of the demonstration vocabulary; texts are code points + 100.
SPECIAL_IDS = {
    "<pad>": 0,
    "<bos>": 1,
    "<eos>": 2,
    "[gMASK]": 3,
    "sop": 4,
    "<|user|>": 5,
    "<|assistant|>": 6,
    "<reserved_106>": 7,
    "<reserved_107>": 8,
    "<reserved_102>": 9,
    "<reserved_103>": 10,
    "<|observation|>": 11,
}
TOKENIZER = CodepointTokenizer(SpecialTokens(SPECIAL_IDS, "<bos>", "<eos>", "<pad>"))
LANGUAGES = ("en", "de", "fr", "es")  # the datasets of the mixing queries
SHARES = (0.4, 0.3, 0.2, 0.1)
SEED = 42
ID_BITS = 32  # of most ids; more take more room in one task of the numbering, with the same result
MAX_SAMPLES = 300
PREVIEWED = 3
VAL_FRACTION, VAL_COUNT = 0.1, 50
BLOCK, PACK_ROWS = 256, 20
BATCH = 16
BUFFER = 128
PIECE_BYTES = 1 << 16  # of files that are read in pieces
WRITTEN_ROWS = 256  # of an array that is written, at a time
STREAM_BATCHES = 6  # micro-batches, at least, of queries that carry state from one to the next
STREAM_SHARES = (0.5, 0.3, 0.2)
MODELS = tuple(MODEL_FAMILY)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ids(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


def _parts_of_chats(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame | None]:
    table = _table(spark, sf, "conversations")
    return turns.conversation_parts(table, on_bad_order="drop", longest=turns.longest_turn(table))


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    table = _table(spark, sf, "conversations")
    return turns.conversation_chunks(table, on_bad_order="drop", longest=turns.longest_turn(table))


def _encoded(spark: SparkSession, sf: str, name: str = "chatglm3", cutoff: int = 1024, **options) -> DataFrame:
    template, tokenizer = template_for(name, TOKENIZER)
    return encode.supervised_conversations(_parts_of_chats(spark, sf), template, tokenizer, cutoff, **options)


def _predict_encoded(spark: SparkSession, sf: str, cutoff: int = 1024) -> DataFrame:
    template, tokenizer = template_for("chatglm3", TOKENIZER)
    return encode.predict_conversations(_parts_of_chats(spark, sf), template, tokenizer, cutoff)


def _as_text(encoded: DataFrame, key: str = "conv_id") -> DataFrame:
    return encoded.select(
        key,
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        F.size(F.filter("labels", lambda x: x != -100)).cast("bigint").alias("n_label_tokens"),
        _ids("input_ids"),
        _ids("labels"),
    )


# -- normalisation ----------------------------------------------------------------


@query
def sharegpt_pairs(spark, sf):
    return turns.pair_rows(_chunks(spark, sf))


@query
def role_order_report(spark, sf):
    return turns.role_order_report(_table(spark, sf, "conversations"))


@query
def alpaca_rename(spark, sf):
    documents = _table(spark, sf, "documents")
    return normalize.rename_columns(documents, {"prompt": "source", "response": "text"}, keep=("doc_id",))


@query
def query_assembly(spark, sf):
    extra = F.when(F.col("lang") == "en", F.col("text")).when(F.col("lang") == "de", F.lit(""))
    examples = _table(spark, sf, "documents").select("doc_id", F.col("source").alias("prompt"), extra.alias("query"))
    return examples.select("doc_id", normalize.full_query(examples).alias("full_query"))


@query
def system_prompt(spark, sf):
    template = TEMPLATES["default"]
    given = F.when(F.col("conv_id") % 3 == 1, F.lit("")).when(F.col("conv_id") % 3 == 2, F.lit("Be brief."))
    examples = turns.examples_from_turns(_chunks(spark, sf)).withColumn("system", given)
    pairs = conversation_turns(template, normalize.full_query(examples), F.col("response"), F.col("history"))
    return examples.select(
        "conv_id",
        system_or_default(template, F.col("system")).alias("system"),
        # with what a long history leaves out
        (F.size(pairs) + F.col("n_pairs") - F.size("history") - 1).cast("bigint").alias("n_turns"),
    )


@query
def max_samples(spark, sf):
    documents = _table(spark, sf, "documents").select("doc_id", "n_chars")
    return ordering.row_index(ordering.first_by_key(documents, "doc_id", MAX_SAMPLES), "doc_id")


def _marked_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as examples, some of them with an empty or missing side."""
    prompt = F.when(F.col("n_chars") % 5 == 0, F.lit("")).otherwise(F.col("text"))
    response = F.when(F.col("n_chars") % 3 == 0, F.lit("")).when(F.col("n_chars") % 3 == 1, F.col("text"))
    return _table(spark, sf, "documents").select("doc_id", prompt.alias("prompt"), response.alias("response"))


@query
def valid_sft(spark, sf):
    return encode.valid_for_sft(_marked_documents(spark, sf)).select("doc_id")


@query
def valid_predict(spark, sf):
    return encode.valid_for_predict(_marked_documents(spark, sf)).select("doc_id")


def _ranked_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Two neighbouring documents of one language as chosen and rejected answer; others have just one."""
    return _table(spark, sf, "documents").groupBy(F.expr("doc_id div 2").alias("pair_id"), "lang").agg(
        F.concat(F.lit("Write in "), F.min("lang")).alias("prompt"),
        F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "text"))), lambda x: x["text"]).alias("responses"),
    )


@query
def valid_pairwise(spark, sf):
    return encode.valid_for_pairwise(_ranked_documents(spark, sf)).select("pair_id", "prompt")


# -- mixing -----------------------------------------------------------------------


def _sources(spark: SparkSession, sf: str) -> tuple[DataFrame, list[int]]:
    """Documents as one dataset per language, stacked."""
    number = F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col("lang")) - 1
    stacked = ordering.row_index(
        _table(spark, sf, "documents").select(number.cast("int").alias("source_no"), "doc_id"), "doc_id", ["source_no"],
        key_bits=ID_BITS,
    )
    return stacked, mixing.source_sizes(stacked, len(LANGUAGES))


def _mixed(df: DataFrame) -> DataFrame:
    return df.select("mix_idx", "source_no", "doc_id")


@query
def mix_concat(spark, sf):
    return _mixed(mixing.concat(*_sources(spark, sf)))


@query
def interleave_under(spark, sf):
    return _mixed(mixing.interleave_under(*_sources(spark, sf)))


@query
def interleave_over(spark, sf):
    return _mixed(mixing.interleave_over(*_sources(spark, sf)))


@query
def interleave_weighted_under(spark, sf):
    return _mixed(mixing.interleave_weighted(*_sources(spark, sf), SHARES, SEED, draws="md5"))


@query
def interleave_weighted_over(spark, sf):
    return _mixed(mixing.interleave_weighted(*_sources(spark, sf), SHARES, SEED, over=True, draws="md5"))


@query
def interleave_weighted_pcg64(spark, sf):
    return _mixed(mixing.interleave_weighted(*_sources(spark, sf), SHARES, SEED))


# -- templates and tokens ---------------------------------------------------------


@query
def model_template_lookup(spark, sf):
    model = F.element_at(F.array(*[F.lit(m) for m in MODELS]), (F.col("p_partkey") % len(MODELS) + 1).cast("int"))
    return with_template_name(_table(spark, sf, "part").select("p_partkey", model.alias("model")))


def _render(name: str) -> Query:
    def run(spark, sf):
        template, tokenizer = template_for(name, TOKENIZER)
        spelled = render_turns(
            template, tokenizer.special, F.col("pairs"), system_or_default(template, None), F.col("first_idx")
        )
        rows = _chunks(spark, sf).select("conv_id", "first_idx", F.posexplode(spelled).alias("pos", "t"))
        return rows.select("conv_id", (F.col("first_idx") + F.col("pos")).alias("idx"), "t.source", "t.target")

    return run


for _name in ("default", "llama2", "llama2_zh", "baichuan", "baichuan2", "chatglm2", "chatglm3"):
    QUERIES[f"render_{_name}"] = _render(_name)


@query
def tokenize_codepoint(spark, sf):
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", TOKENIZER.encode(F.col("text")).alias("ids"))
    return rows.select("conv_id", "turn", F.size("ids").cast("bigint").alias("n_tokens"), _ids("ids"))


def utf8_encoder():
    """An encoder of the kind users plug in: one id per byte."""
    return lambda text: [b + TOKENIZER.offset for b in text.encode("utf-8")]


@query
def tokenize_callable(spark, sf):
    tokenizer = CallableTokenizer(utf8_encoder, TOKENIZER.special)
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", tokenizer.encode(F.col("text")).alias("ids"))
    return rows.select("conv_id", "turn", F.size("ids").cast("bigint").alias("n_tokens"), _ids("ids"))


@query
def vocab_build(spark, sf):
    return vocab.build_vocabulary(_table(spark, sf, "documents"))


@query
def vocab_encode(spark, sf):
    documents = _table(spark, sf, "documents")
    encoded = vocab.encode_with_vocabulary(documents, vocab.build_vocabulary(documents), "doc_id")
    return encoded.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"), _ids("input_ids"))


@query
def vocab_decode(spark, sf):
    documents = _table(spark, sf, "documents")
    vocabulary = vocab.build_vocabulary(documents)
    return vocab.decode_with_vocabulary(
        vocab.encode_with_vocabulary(documents, vocabulary, "doc_id"), vocabulary, "doc_id"
    )


@query
def decode_roundtrip(spark, sf):
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", TOKENIZER.encode(F.col("text")).alias("ids"))
    return rows.select("conv_id", "turn", TOKENIZER.decode(F.col("ids"), skip_special_tokens=True).alias("text"))


@query
def decode_special(spark, sf):
    rows = _encoded(spark, sf)
    return rows.select("conv_id", TOKENIZER.decode(F.col("input_ids")).alias("text"))


# -- encoding ---------------------------------------------------------------------


@query
def encode_sft(spark, sf):
    return _as_text(_encoded(spark, sf))


@query
def encode_train_on_prompt(spark, sf):
    return _as_text(_encoded(spark, sf, "default", train_on_prompt=True))


@query
def encode_llama2(spark, sf):
    return _as_text(_encoded(spark, sf, "llama2"))


@query
def truncate_proportional(spark, sf):
    return _as_text(_encoded(spark, sf, cutoff=64))


@query
def encode_predict(spark, sf):
    return _predict_encoded(spark, sf).select("conv_id", _ids("input_ids"), _ids("labels"))


@query
def encode_pairwise(spark, sf):
    template, tokenizer = template_for("chatglm3", TOKENIZER)
    encoded = encode.pairwise(_ranked_documents(spark, sf), template, tokenizer, 256, keep=("pair_id",))
    return encoded.select("pair_id", _ids("prompt_ids"), _ids("chosen_ids"), _ids("rejected_ids"))


@query
def pack_blocks(spark, sf):
    template, tokenizer = template_for("chatglm3", TOKENIZER)
    conversations = _table(spark, sf, "conversations")
    longest = turns.longest_turn(conversations)
    chunks = turns.index_conversations(
        turns.conversation_chunks(conversations, on_bad_order="drop", longest=longest), key_bits=ID_BITS
    )
    rows = chunks.filter((F.col("last.q") != "") & (F.col("last.r") != ""))
    pieces = encode.training_pieces(
        rows, template, tokenizer, F.col("pairs"), keep=("row_idx", "chunk"), first_idx=F.col("first_idx")
    )
    blocks = packing.pack_blocks(
        pieces,
        BLOCK,
        tokenizer.special.eos_id,
        PACK_ROWS,
        order=("row_idx", "chunk"),
        bounded=longest is not None and longest < 2 * turns.CHUNK_PAIRS - 1,
    )
    return blocks.select("pack_group", "block", _ids("input_ids"), _ids("labels"))


# -- split, shuffle, batch --------------------------------------------------------


def _parts(spark: SparkSession, sf: str, val_size: float) -> DataFrame:
    documents = _table(spark, sf, "documents").select("doc_id", "n_chars")
    parts = split.split_train_eval(documents, val_size, SEED, "doc_id")
    return parts["train"].withColumn("part", F.lit("train")).unionByName(
        parts["eval"].withColumn("part", F.lit("eval"))
    )


@query
def split_fraction(spark, sf):
    return _parts(spark, sf, VAL_FRACTION)


@query
def split_count(spark, sf):
    return _parts(spark, sf, VAL_COUNT)


@query
def buffer_shuffle(spark, sf):
    documents = ordering.row_index(_table(spark, sf, "documents").select("doc_id"), "doc_id")
    return split.buffer_shuffle(documents, 128, SEED)


@query
def buffer_shuffle_moving(spark, sf):
    documents = ordering.row_index(_table(spark, sf, "documents").select("doc_id"), "doc_id")
    return split.moving_shuffle(documents, BUFFER, SEED)


def _padded(encoded: DataFrame, side: str) -> DataFrame:
    indexed = ordering.row_index(encoded, "conv_id", key_bits=ID_BITS)
    rows = pad_batches(assign_batches(indexed, BATCH), TOKENIZER.special.pad_id, side)
    return rows.select("conv_id", "batch", _ids("input_ids"), _ids("attention_mask"), _ids("labels"))


@query
def pad_right(spark, sf):
    return _padded(_encoded(spark, sf, cutoff=255), "right")


@query
def pad_left(spark, sf):
    return _padded(_predict_encoded(spark, sf, 255), "left")


# -- metrics ----------------------------------------------------------------------


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with a guess at quality and toxicity from the document's length."""
    documents = _table(spark, sf, "documents").select("doc_id", "n_chars")
    return _table(spark, sf, "labels").join(documents, "doc_id").select(
        (F.col("n_chars") > 500).cast("int").alias("predictions"),
        F.col("quality").alias("references"),
        F.array((F.col("n_chars") > 500).cast("int"), (F.col("n_chars") > 2000).cast("int")).alias("many_predictions"),
        F.array("quality", "toxic").alias("many_references"),
        F.col("n_chars").alias("weight"),
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(F.round("accuracy", 12).alias("accuracy"))


@query
def accuracy(spark, sf):
    return _rounded(metrics.accuracy(_judged(spark, sf)))


@query
def accuracy_count(spark, sf):
    return _rounded(metrics.accuracy(_judged(spark, sf), normalize=False))


@query
def accuracy_weighted(spark, sf):
    return _rounded(metrics.accuracy(_judged(spark, sf), weight="weight"))


@query
def accuracy_weighted_sum(spark, sf):
    return _rounded(metrics.accuracy(_judged(spark, sf), normalize=False, weight="weight"))


@query
def accuracy_multilabel(spark, sf):
    return _rounded(metrics.accuracy(_judged(spark, sf), "many_predictions", "many_references"))


def _guessed_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded conversations with the next label as prediction, wrong at every seventh place."""
    guess = F.transform(
        "labels", lambda x, i: F.when(i % 7 == 0, F.lit(0)).otherwise(F.coalesce(F.get("labels", i + 1), F.lit(0)))
    )
    return _encoded(spark, sf).withColumn("preds", guess)


@query
def token_accuracy_shifted(spark, sf):
    return _rounded(metrics.shifted_token_accuracy(_guessed_tokens(spark, sf)))


@query
def token_accuracy_ignoring(spark, sf):
    return _rounded(metrics.shifted_token_accuracy(_guessed_tokens(spark, sf), ignore_index=-100))


@query
def argmax_scores(spark, sf):
    return _table(spark, sf, "embeddings").select("vec_id", metrics.argmax(F.col("embedding")).alias("best"))


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Generated ids: the prompt, then the answer without its last three tokens."""
    rows = _predict_encoded(spark, sf)
    answer = F.slice("labels", F.lit(1), F.greatest(F.size("labels") - 3, F.lit(0)))
    generated = rows.withColumn("generated", F.concat("input_ids", answer))
    blank = metrics.blank_prompt(F.col("generated"), F.size("input_ids"), TOKENIZER.special.pad_id)
    return generated.select("conv_id", "labels", blank.alias("preds"))


@query
def prediction_records(spark, sf):
    return metrics.prediction_records(_predictions(spark, sf), TOKENIZER, keep=("conv_id",))


# -- sources and sinks ------------------------------------------------------------


@query
def prediction_sink(spark, sf):
    path = new_folder(spark, "predictions")
    sinks.write_predictions(metrics.prediction_records(_predictions(spark, sf), TOKENIZER), path)
    return spark.read.schema("label string, predict string").json(path)


@query
def preview_examples(spark, sf):
    shown = sinks.preview_table(_encoded(spark, sf), TOKENIZER, PREVIEWED, "conv_id")
    return shown.select("conv_id", "input_text", "labels_text")


@query
def metrics_sink(spark, sf):
    path = new_folder(spark, "metrics")
    judged = _judged(spark, sf)
    for split_name, weight in (("train", None), ("eval", "weight")):
        value = metrics.accuracy(judged, weight=weight).first()["accuracy"]
        sinks.append_metrics(sinks.metrics_table(spark, split_name, {f"{split_name}_accuracy": value}), path)
    return spark.read.parquet(path).select("split", "metric", F.round("value", 12).alias("value"))


@query
def encoded_cache(spark, sf):
    path = new_folder(spark, "encoded")
    cache.encoded_cache(spark, path, lambda: _encoded(spark, sf))
    return _as_text(cache.encoded_cache(spark, path, lambda: _encoded(spark, sf)))


def _spec(name: str, address: str, **entry) -> manifest.DatasetSpec:
    return manifest.parse_entry(name, {"file_name": address, **entry})


def _as_alpaca(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in instruction/input/output columns, in doc_id order."""
    return (
        _table(spark, sf, "documents")
        .select(
            F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("instruction"),
            F.col("source").alias("input"),
            F.col("text").alias("output"),
            "doc_id",
        )
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .drop("doc_id")
    )


@query
def read_jsonl(spark, sf):
    base = new_folder(spark, "jsonl")
    _as_alpaca(spark, sf).write.json(f"{base}/docs")
    return files.read_dataset(spark, _spec("docs", "docs"), base).select("row_idx", "prompt", "query", "response")


@query
def read_csv(spark, sf):
    base = new_folder(spark, "csv")
    _as_alpaca(spark, sf).write.option("escape", '"').option("header", True).csv(f"{base}/docs")
    return files.read_dataset(spark, _spec("docs", "docs"), base).select("row_idx", "prompt", "query", "response")


@query
def read_csv_pieces(spark, sf):
    base = new_folder(spark, "csv")
    _as_alpaca(spark, sf).write.option("escape", '"').option("header", True).csv(f"{base}/docs")
    out = files.read_dataset(spark, _spec("docs", "docs"), base, chunk=PIECE_BYTES)
    return out.select("row_idx", "prompt", "query", "response")


def _as_array(batches):
    """The rows of a partition as lines of one JSON array."""
    mark = "["
    for batch in batches:
        for i in range(0, len(batch), WRITTEN_ROWS):
            some = batch.iloc[i : i + WRITTEN_ROWS]
            yield some.assign(value=[(mark if n == 0 else ",") + value for n, value in enumerate(some["value"])])
            mark = ","
    yield pd.DataFrame({"value": ["]" if mark == "," else "[]"]})


def _write_array(rows: DataFrame, path: str) -> None:
    rows.select(F.to_json(F.struct("*")).alias("value")).mapInPandas(_as_array, "value string").write.mode("append").text(path)


@query
def read_json_pieces(spark, sf):
    base = new_folder(spark, "json-array")
    _write_array(_as_alpaca(spark, sf), base)
    spec = manifest.parse_entry("docs", {"hf_hub_url": "a/b"})
    out = files.read_dataset(spark, spec, ".", bindings={"a/b": f"json:{base}"}, chunk=PIECE_BYTES)
    return out.select("row_idx", "prompt", "query", "response")


@query
def read_text(spark, sf):
    base = new_folder(spark, "text")
    lines = _as_alpaca(spark, sf).select(F.explode(F.split("output", "\n")).alias("value"))
    lines.write.text(f"{base}/docs")
    spec = _spec("docs", "docs", columns={"prompt": "text"})
    return files.read_dataset(spark, spec, base).groupBy("prompt").agg(F.count("*").alias("n"))


@query
def read_parquet_split(spark, sf):
    base = new_folder(spark, "hub")
    documents = _table(spark, sf, "documents").select(
        F.col("source").alias("content"), F.col("text").alias("summary"),
        F.when(F.col("n_chars") % 4 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"),
    )
    documents.write.partitionBy("split").parquet(base)
    spec = manifest.parse_entry("docs", {"hf_hub_url": "a/b", "columns": {"prompt": "content", "response": "summary"}})
    return files.read_dataset(spark, spec, ".", "test", bindings={"a/b": f"parquet:{base}"}).select("prompt", "response")


@query
def read_sharegpt(spark, sf):
    base = new_folder(spark, "sharegpt")
    messages = _messages(spark, sf).select("conversations")
    messages.write.json(f"{base}/chats")
    spec = _spec("chats", "chats", formatting="sharegpt")
    out = files.read_dataset(spark, spec, base, on_bad_order="drop")
    return out.select("prompt", "response", F.size("history").cast("bigint").alias("n_history"))


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """Message arrays, one row per conversation: the form in which such data sets come."""
    message = F.struct("turn", F.col("role").alias("from"), F.col("text").alias("value"))
    chats = _table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("chat_id"))
    gathered = chats.agg(F.sort_array(F.collect_list(message)).alias("m"))
    plain = F.transform("m", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))
    return gathered.select("chat_id", plain.alias("conversations"))


@query
def sharegpt_arrays(spark, sf):
    out = normalize.examples_from_messages(_messages(spark, sf), on_bad_order="drop", keep=("chat_id",))
    return out.select("chat_id", "prompt", "response", F.size("history").cast("bigint").alias("n_history"))


@query
def file_integrity(spark, sf):
    paths = list_files(spark, sf)
    digests = {r["path"].rsplit("/", 1)[-1]: r["sha1"] for r in integrity.file_digests(spark, paths).collect()}
    names = [p.rsplit("/", 1)[-1] for p in paths]
    expected = {}
    for i, (name, path) in enumerate(zip(names, paths)):
        sha1 = (digests[name], "0" * 40, None)[i % 3]
        expected[name] = ([path], sha1)
    expected["everything"] = (paths, digests[names[0]])
    return integrity.integrity_report(spark, expected).select("dataset", "files", "status")


# -- streams ----------------------------------------------------------------------


def _chat_stream(spark: SparkSession, sf: str, in_turn: bool = False) -> DataFrame:
    """The conversations as a stream of JSON lines; ``in_turn``: in some micro-batches, in order of ``chat_id``."""
    base, reader = new_folder(spark, "chat-stream"), spark.readStream
    messages = _messages(spark, sf)
    if in_turn:
        n_files = max(STREAM_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
        messages.repartitionByRange(n_files, "chat_id").sortWithinPartitions("chat_id").write.json(base)
        date_files(spark, base, 1_000_000_000_000)
        reader = reader.option("maxFilesPerTrigger", n_files // STREAM_BATCHES)
    else:
        messages.write.json(base)
    schema = "chat_id bigint, conversations array<struct<`from`:string,value:string>>"
    raw = reader.schema(schema).json(base)
    return normalize.examples_from_messages(raw, on_bad_order="drop", keep=("chat_id",))


def _finished(q) -> None:
    q.awaitTermination()


@query
def stream_read(spark, sf):
    """Arrays and JSON lines in one folder, some files per micro-batch."""
    base = new_folder(spark, "stream-files")
    documents = _as_alpaca(spark, sf).withColumn("_array", F.crc32(F.col("instruction").cast("binary")) % 2 == 0)
    _write_array(documents.filter("_array").drop("_array"), f"{base}/docs")
    documents.filter("not _array").drop("_array").write.mode("append").json(f"{base}/docs")
    n_files = -(-len(list_files(spark, f"{base}/docs")) // STREAM_BATCHES)
    stream = files.read_stream(
        spark, _spec("docs", "docs"), base, files_per_trigger=n_files, kind="json", chunk=PIECE_BYTES
    ).select("prompt", "query", "response")
    out = new_folder(spark, "stream-out")
    _finished(jobs.write_rows(stream, out, new_folder(spark, "stream-marks")))
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_encode(spark, sf):
    template, tokenizer = template_for("chatglm3", TOKENIZER)
    encoded = encode.supervised(_chat_stream(spark, sf), template, tokenizer, keep=("chat_id",))
    out, marks = new_folder(spark, "stream-out"), new_folder(spark, "stream-marks")
    _finished(jobs.write_rows(encoded, out, marks))
    return _as_text(spark.read.schema(encoded.schema).parquet(out), "chat_id")


@query
def stream_take_skip(spark, sf):
    stream = _chat_stream(spark, sf).select("chat_id", "prompt")
    head, rest = new_folder(spark, "stream-eval"), new_folder(spark, "stream-train")
    _finished(jobs.split_stream(stream, 15, "chat_id", rest, head, new_folder(spark, "stream-marks")))
    parts = [
        spark.read.parquet(p).select("chat_id", "prompt", F.lit(name).alias("part"))
        for p, name in ((head, "eval"), (rest, "train"))
    ]
    return parts[0].unionByName(parts[1])


@query
def stream_pack(spark, sf):
    template, tokenizer = template_for("chatglm3", TOKENIZER)
    rows = encode.valid_for_sft(_chat_stream(spark, sf, in_turn=True))
    pieces = encode.training_pieces(
        rows, template, tokenizer, encode.example_turns(rows, template, F.col("response")), keep=("chat_id",)
    )
    out = new_folder(spark, "stream-blocks")
    marks = new_folder(spark, "stream-marks")
    _finished(jobs.pack_stream(pieces, "chat_id", BLOCK, out, marks, tokenizer.special.eos_id, PACK_ROWS))
    return spark.read.parquet(out).select("pack_group", "block", _ids("input_ids"), _ids("labels"))


@query
def stream_shuffle(spark, sf):
    stream = _chat_stream(spark, sf).select("chat_id")
    out = new_folder(spark, "stream-shuffled")
    _finished(jobs.shuffle_stream(stream, "chat_id", out, new_folder(spark, "stream-marks"), 16, SEED))
    return spark.read.parquet(out).select("chat_id", "shuffled_idx")


@query
def stream_shuffle_moving(spark, sf):
    stream = _chat_stream(spark, sf, in_turn=True).select("chat_id")
    out = new_folder(spark, "stream-shuffled")
    _finished(jobs.moving_shuffle_stream(stream, "chat_id", out, new_folder(spark, "stream-marks"), BATCH, SEED))
    return spark.read.parquet(out).select("chat_id", "shuffled_idx")


def _mixed_streams(spark: SparkSession, sf: str, *how, **options) -> DataFrame:
    """Three streams of chats, each in several micro-batches, interleaved."""
    streams = [_chat_stream(spark, sf, in_turn=True).filter(F.col("chat_id") % 3 == i).select("chat_id") for i in range(3)]
    out = new_folder(spark, "stream-mixed")
    _finished(jobs.interleave_streams(streams, "chat_id", out, new_folder(spark, "stream-marks"), *how, **options))
    return spark.read.parquet(out).select("row_idx", "chat_id")


@query
def stream_interleave(spark, sf):
    return _mixed_streams(spark, sf)


@query
def stream_interleave_over(spark, sf):
    return _mixed_streams(spark, sf, "interleave_over")


@query
def stream_interleave_weighted(spark, sf):
    return _mixed_streams(spark, sf, "interleave_under", STREAM_SHARES, SEED, draws="md5")


@query
def stream_interleave_weighted_over(spark, sf):
    return _mixed_streams(spark, sf, "interleave_over", STREAM_SHARES, SEED, draws="md5")


@query
def stream_concat(spark, sf):
    streams = [_chat_stream(spark, sf).select("chat_id", "prompt").withColumn("dataset", F.lit(n)) for n in ("a", "b")]
    out = new_folder(spark, "stream-concat")
    both = jobs.concat_streams(streams)
    _finished(jobs.write_rows(both, out, new_folder(spark, "stream-marks")))
    return spark.read.schema(both.schema).parquet(out)
