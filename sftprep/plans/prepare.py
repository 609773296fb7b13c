"""A whole preparation job: manifest to padded batches."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import asdict

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.templates import ChatTemplate, template_for, template_name_for_model
from ..functions.tokenizers import Tokenizer
from ..operators import encode, mixing
from ..operators.batching import assign_batches, pad_batches
from ..operators.ordering import row_index
from ..operators.packing import pack_blocks
from ..operators.split import split_train_eval
from ..sources.cache import encoded_cache, reused
from ..sources.files import input_states, read_dataset, read_stream
from ..sources.manifest import JobOptions, load_manifest, resolve_datasets
from ..streaming import jobs


def chosen_template(options: JobOptions, tokenizer: Tokenizer) -> tuple[ChatTemplate, Tokenizer]:
    """By template name, or by model name."""
    name = options.template or template_name_for_model(options.model_name)
    template, tokenizer = template_for(name, tokenizer)
    encode.check_request(template, options.train_on_prompt)
    return template, tokenizer


def read_mixture(spark: SparkSession, options: JobOptions, bindings: Mapping[str, str] | None = None) -> DataFrame:
    """All datasets of the job as one table of examples with a dense ``row_idx``."""
    specs = resolve_datasets(options.dataset, load_manifest(spark, options.dataset_dir), options.system_prompt)
    parts = [
        read_dataset(
            spark, s, options.dataset_dir, options.split, options.max_samples, bindings, options.on_bad_order
        )
        for s in specs
    ]
    return mixing.mix(
        mixing.stack(parts), len(parts), options.mix_strategy, options.probabilities(), options.seed
    )


def encode_examples(
    df: DataFrame, options: JobOptions, template: ChatTemplate, tokenizer: Tokenizer
) -> DataFrame:
    """Examples to model inputs in the job's mode, keeping a dense-enough ``row_idx``."""
    mode = options.mode()
    if mode == "predict":
        return encode.predict(df, template, tokenizer, options.cutoff_len)
    if mode == "pairwise":
        return encode.pairwise(df, template, tokenizer, options.cutoff_len)
    if mode == "sft":
        return encode.supervised(df, template, tokenizer, options.cutoff_len, options.train_on_prompt)
    rows = encode.valid_for_sft(df)
    turns: Column = encode.example_turns(rows, template, F.col("response"))
    pieces = encode.training_pieces(rows, template, tokenizer, turns, options.train_on_prompt)
    eos = tokenizer.special.eos_id if template.efficient_eos else None
    blocks = pack_blocks(pieces, options.cutoff_len, eos)
    # a block's place: a group holds at most as many blocks as fit 32 bits
    return blocks.withColumn("row_idx", F.shiftleft("pack_group", 32) + F.col("block")).drop("pack_group", "block")


# Options that change nothing in the encoded examples.
WITHOUT_EFFECT = ("overwrite_cache", "cache_path", "val_size", "do_train", "do_predict", "batch_size", "max_steps",
                  "ignore_pad_token_for_loss", "buffer_size", "files_per_trigger", "reuse_results")


def recipe(
    spark: SparkSession,
    options: JobOptions,
    template: ChatTemplate,
    tokenizer: Tokenizer,
    bindings: Mapping[str, str] | None = None,
) -> str:
    """All that encoded examples depend on: options, manifest entries, template, tokenizer, and of each input file
    its path, length and time. Code that a tokenizer imports counts by its name alone: if it changes, set
    ``overwrite_cache``."""
    chosen = {k: v for k, v in asdict(options).items() if k not in WITHOUT_EFFECT}
    specs = resolve_datasets(options.dataset, load_manifest(spark, options.dataset_dir), options.system_prompt)
    inputs = [(asdict(s), input_states(spark, s, options.dataset_dir, bindings)) for s in specs]
    code = hashlib.sha1(cloudpickle.dumps((template, tokenizer))).hexdigest()
    return json.dumps([chosen, inputs, sorted((bindings or {}).items()), code], sort_keys=True)


def prepare(
    spark: SparkSession,
    options: JobOptions,
    tokenizer: Tokenizer,
    bindings: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Read, mix, encode (or load ``cache_path``, or with ``reuse_results`` what an earlier job stored) and split:
    ``{"train": …, "eval": …}``."""
    template, tokenizer = chosen_template(options, tokenizer)

    def build() -> DataFrame:
        return encode_examples(read_mixture(spark, options, bindings), options, template, tokenizer)

    if options.reuse_results and options.cache_path is None:
        made_from = recipe(spark, options, template, tokenizer, bindings)
        encoded = reused(spark, "encoded", made_from, build, options.overwrite_cache)
    else:
        encoded = encoded_cache(spark, options.cache_path, build)
    return split_train_eval(encoded, options.val_size, options.seed, "row_idx", options.do_train)


def prepare_stream(
    spark: SparkSession, options: JobOptions, tokenizer: Tokenizer, train_path: str, eval_path: str, work_dir: str
) -> None:
    """The job over folders of files as streams, until the input is used up.

    The first ``val_size`` rows go to ``eval_path``, the next ``max_steps`` batches of rows
    to ``train_path``. Without a validation set, rows are shuffled through a buffer of ``buffer_size`` rows
    and ``shuffled_idx`` is their order. Interleaved, packed and shuffled rows are staged below ``work_dir``, which also
    keeps the streams' checkpoints: run again with new files, the job goes on.
    """
    if not options.streaming:
        raise ValueError("the options are not for streaming")
    template, tokenizer = chosen_template(options, tokenizer)
    specs = resolve_datasets(options.dataset, load_manifest(spark, options.dataset_dir), options.system_prompt)
    streams = [
        read_stream(spark, s, options.dataset_dir, options.on_bad_order, options.files_per_trigger) for s in specs
    ]

    def staged(name: str, run: Callable[[str, str], StreamingQuery]) -> DataFrame:
        """Run one stage and go on with what it stored, batch by batch."""
        path = f"{work_dir}/{name}"
        run(path, f"{work_dir}/marks-{name}").awaitTermination()
        schema = spark.read.parquet(path).schema
        return spark.readStream.schema(schema).parquet(path).drop("batch")

    order = None  # unique integers by which rows of a micro-batch are ordered
    if len(streams) > 1 and options.mix_strategy.startswith("interleave"):
        rows, order = staged(
            "mixture",
            lambda path, marks: jobs.interleave_streams(
                streams, None, path, marks, options.mix_strategy, options.probabilities(), options.seed
            ),
        ), "row_idx"
    elif len(streams) == 1 or options.mix_strategy == "concat":
        rows = jobs.concat_streams(streams)
    else:
        mixing.check_strategy(options.mix_strategy)

    mode, cutoff, keep = options.mode(), options.cutoff_len, ("dataset", *([order] if order else []))
    if mode == "predict":
        encoded = encode.predict(rows, template, tokenizer, cutoff, keep=keep)
    elif mode == "pairwise":
        encoded = encode.pairwise(rows, template, tokenizer, cutoff, keep=keep)
    elif mode == "sft":
        encoded = encode.supervised(rows, template, tokenizer, cutoff, options.train_on_prompt, keep=keep)
    else:
        valid = encode.valid_for_sft(rows)
        turns = encode.example_turns(valid, template, F.col("response"))
        pieces = encode.training_pieces(valid, template, tokenizer, turns, options.train_on_prompt, keep=keep[1:])
        eos = tokenizer.special.eos_id if template.efficient_eos else None
        blocks = staged("blocks", lambda path, marks: jobs.pack_stream(pieces, order, cutoff, path, marks, eos))
        place = F.shiftleft("pack_group", 32) + F.col("block")
        encoded, order = blocks.withColumn("row_idx", place).drop("pack_group", "block"), "row_idx"
    if options.val_size <= 0:  # with a validation set, training rows keep their order
        encoded, order = staged(
            "shuffled",
            lambda path, marks: jobs.moving_shuffle_stream(encoded, order, path, marks, options.buffer_size, options.seed),
        ), "shuffled_idx"
    shares = [(int(options.val_size), eval_path)] if options.val_size > 0 else []
    shares.append((options.max_steps * options.batch_size, train_path))
    jobs.deal_rows(encoded, shares, None, order, f"{work_dir}/marks-out").awaitTermination()


def batches(encoded: DataFrame, options: JobOptions, tokenizer: Tokenizer) -> DataFrame:
    """Rows dealt into batches in row order and padded: left for generation, else right."""
    dense = row_index(encoded.withColumnRenamed("row_idx", "_key"), "_key").drop("_key")
    side = "left" if options.predict_with_generate else "right"
    return pad_batches(
        assign_batches(dense, options.batch_size), tokenizer.special.pad_id, side, options.ignore_pad_token_for_loss
    )
