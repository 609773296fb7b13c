"""The dataset manifest and the options of a job, checked before anything is planned."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators.normalize import spread_system_prompts
from ..storage import path_exists, whole_file

MANIFEST_FILE = "dataset_info.json"  # fixed value
# The manifest's column keys and what they default to.
DEFAULT_COLUMNS = {
    "prompt": "instruction",
    "query": "input",
    "response": "output",
    "history": None,
    "messages": "conversations",
    "role": "from",
    "content": "value",
}
# Where a dataset lies, by manifest key, first match wins.
LOCATION_KEYS = (("hf_hub_url", "hf_hub"), ("script_url", "script"), ("file_name", "file"))


@dataclass(frozen=True)
class DatasetSpec:
    """One manifest entry."""

    name: str
    location: str  # file, hf_hub or script
    address: str
    sha1: str | None = None
    subset: str | None = None
    ranking: bool = False
    formatting: str = "alpaca"
    columns: Mapping[str, str | None] = None
    system_prompt: str | None = None

    def message_columns(self) -> tuple[str, str, str]:
        """Names of the messages, role and content fields.

        Entries that fill in prompt, query and response for a conversation dataset mean
        messages, role and content by them.
        """
        c = self.columns
        found = (c.get("messages") or c.get("prompt"), c.get("role") or c.get("query"), c.get("content") or c.get("response"))
        if None in found:
            raise ValueError(f"dataset {self.name}: messages, role and content columns are needed")
        return found

    def example_columns(self) -> dict[str, str | None]:
        """Canonical name -> source column; ranked answers go to ``responses``."""
        c = self.columns
        answers = "responses" if self.ranking else "response"
        return {"prompt": c["prompt"], "query": c["query"], answers: c["response"], "history": c["history"]}


def parse_entry(name: str, entry: Mapping[str, Any]) -> DatasetSpec:
    for key, location in LOCATION_KEYS:
        if key in entry:
            break
    else:
        raise KeyError(f"dataset {name}: no {', '.join(k for k, _ in LOCATION_KEYS)}")
    columns = dict(DEFAULT_COLUMNS)
    if "columns" in entry:  # a columns block stands for all seven names
        columns = {k: entry["columns"].get(k) for k in DEFAULT_COLUMNS}
    formatting = entry.get("formatting", "alpaca")
    if formatting not in ("alpaca", "sharegpt"):
        raise ValueError(f"dataset {name}: formatting {formatting!r} is neither alpaca nor sharegpt")
    return DatasetSpec(
        name=name,
        location=location,
        address=entry[key],
        sha1=entry.get("file_sha1") if location == "file" else None,
        subset=entry.get("subset"),
        ranking=bool(entry.get("ranking", False)),
        formatting=formatting,
        columns=columns,
    )


def load_manifest(spark: SparkSession, dataset_dir: str) -> dict[str, Any]:
    """The manifest of a folder, read the way its data files are, so any Hadoop path will do."""
    path = f"{dataset_dir.rstrip('/')}/{MANIFEST_FILE}"
    if not path_exists(spark, path):
        raise ValueError(f"there is no manifest {path}")
    try:
        return json.loads(whole_file(spark, path))
    except ValueError as e:
        raise ValueError(f"{path} is not valid JSON: {e}") from e


def comma_list(text: str | None) -> list[str]:
    """Parts between commas without the blanks around them; None has none."""
    return [] if text is None else re.split(r"\s*,\s*", text.strip())


def resolve_datasets(
    datasets: str | None, manifest: Mapping[str, Any], system_prompt: str | None = None
) -> list[DatasetSpec]:
    """Comma list of names to specs, each with its share of the system prompts."""
    names = comma_list(datasets)
    prompts = spread_system_prompts(system_prompt, len(names))
    specs = []
    for name, text in zip(names, prompts):
        if name not in manifest:
            raise ValueError(f"the manifest has no dataset {name!r}")
        specs.append(replace(parse_entry(name, manifest[name]), system_prompt=text))
    return specs


def manifest_table(spark: SparkSession, manifest: Mapping[str, Any]) -> DataFrame:
    """The manifest as a table, one row per dataset."""
    rows = []
    for name, entry in manifest.items():
        s = parse_entry(name, entry)
        rows.append((s.name, s.location, s.address, s.sha1, s.subset, s.ranking, s.formatting, *s.columns.values()))
    columns = ", ".join(f"{c} string" for c in DEFAULT_COLUMNS)
    return spark.createDataFrame(
        rows,
        "name string, location string, address string, sha1 string, subset string, ranking boolean, "
        f"formatting string, {columns}",
    )


# Options that exclude each other: when a rule breaks, and what to do about it.
OPTION_RULES: list[tuple[Callable[[JobOptions], bool], str]] = [
    (lambda o: o.predict_with_generate and o.do_train, "predict_with_generate needs do_train=False"),
    (lambda o: o.do_predict and not o.predict_with_generate, "do_predict needs predict_with_generate"),
    (lambda o: o.streaming and o.max_steps == -1, "a stream has no end of its own: set max_steps"),
    (lambda o: o.streaming and bool(o.cache_path), "a stream cannot be kept under cache_path"),
    (lambda o: o.streaming and o.max_samples is not None, "max_samples does not apply to a stream"),
    (lambda o: o.streaming and 1e-6 < o.val_size < 1, "a stream has no total: give val_size as a number of rows"),
]


@dataclass(frozen=True)
class JobOptions:
    """Settings of a preparation job; impossible combinations raise on construction."""

    dataset: str | None = None
    dataset_dir: str = "data"
    split: str = "train"
    cutoff_len: int = 1024
    train_on_prompt: bool = False
    streaming: bool = False
    buffer_size: int = 16384
    mix_strategy: str = "concat"
    interleave_probs: str | None = None
    overwrite_cache: bool = False
    max_samples: int | None = None
    ignore_pad_token_for_loss: bool = True
    system_prompt: str | None = None
    val_size: float = 0
    sft_packing: bool = False
    cache_path: str | None = None
    predict_with_generate: bool = False
    do_train: bool = True
    do_predict: bool = False
    max_steps: int = -1
    batch_size: int = 8
    seed: int = 42
    model_name: str | None = None
    template: str | None = None
    pairwise: bool = False
    on_bad_order: str = "raise"
    files_per_trigger: int | None = None  # of a stream; all at once if not given
    reuse_results: bool = False  # take an earlier job's examples if options and files are the same

    def __post_init__(self):
        broken = [advice for breaks, advice in OPTION_RULES if breaks(self)]
        if broken:
            raise ValueError("; ".join(broken))

    def probabilities(self) -> list[float] | None:
        return None if self.interleave_probs is None else list(map(float, comma_list(self.interleave_probs)))

    def mode(self) -> str:
        if self.predict_with_generate:
            return "predict"
        if self.pairwise:
            return "pairwise"
        return "packed" if self.sft_packing else "sft"
