import csv
import hashlib
import io
import json
import random
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession, functions as F

from sftprep import storage
from sftprep.sources import cache, chunks, files, integrity, manifest, sinks

MANIFEST = {
    "plain": {"file_name": "plain.json", "file_sha1": "0" * 40},
    "ranked": {"file_name": "ranked.jsonl", "ranking": True},
    "short": {"file_name": "short.csv", "columns": {"prompt": "content", "response": "summary"}},
    "lines": {"file_name": "lines.txt", "columns": {"prompt": "text"}},
    "chat": {"file_name": "chat.json", "formatting": "sharegpt"},
    "odd_chat": {
        "file_name": "odd_chat.jsonl",
        "columns": {"prompt": "messages", "query": "role", "response": "content"},
        "formatting": "sharegpt",
    },
    "folder": {"file_name": "folder"},
    "mixed": {"file_name": "mixed"},
    "layouts": {"file_name": "layouts"},
    "headers": {"file_name": "headers"},
    "hub": {"hf_hub_url": "a/b", "script_url": "c", "file_name": "d", "subset": "s1"},
    "script": {"script_url": "c", "columns": {"prompt": "instruction", "history": "history", "response": "output"}},
}


@pytest.fixture
def data(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text, encoding="utf-8")

    put("dataset_info.json", json.dumps(MANIFEST))
    alpaca = [
        {"instruction": f"i{n}", "input": "x" if n % 2 else "", "output": f"问{n}\nline", "history": [["h", "g"]], "other": 1}
        for n in range(5)
    ]
    put("plain.json", json.dumps(alpaca, indent=2, ensure_ascii=False))
    ranked = [{"instruction": "i", "input": "", "output": ["good", "bad"]}, {"instruction": "j", "input": "", "output": ["one"]}]
    put("ranked.jsonl", "\n".join(map(json.dumps, ranked)))
    put("short.csv", 'content,summary\n"a, ""b""\nc",d\ne,\n')
    put("lines.txt", "one\n\nthree\n")
    chats = [[("human", "a"), ("gpt", "b"), ("human", "c"), ("gpt", "d"), ("human", "e")], [("human", "z")], [("human", "f"), ("gpt", "g")]]
    put("chat.json", json.dumps([{"id": 1, "conversations": [{"from": r, "value": v} for r, v in c]} for c in chats]))
    put("odd_chat.jsonl", json.dumps({"messages": [{"role": "u", "content": "a"}, {"role": "s", "content": "b"}]}))
    for n in range(3):
        put(f"folder/part{n}.jsonl", "\n".join(json.dumps({"instruction": f"{n}{k}", "input": "", "output": "o"}) for k in range(2)))
    row = {"instruction": "x", "input": "", "output": "o"}
    put("layouts/a b.json", "\n".join(json.dumps(row) for _ in range(3)))
    put("layouts/a.json", json.dumps([row, row]))
    put("layouts/c.jsonl", "\n".join(json.dumps(row) for _ in range(4)))
    put("headers/a.csv", "instruction,input,output\ni,,o\n")
    put("headers/b.csv", "output,input,instruction\no,,i\n")
    put("mixed/a.json", "[]")
    put("mixed/b.csv", "x\n")
    return str(tmp_path)


def specs(data, names, **options):
    spark = SparkSession.getActiveSession()
    return manifest.resolve_datasets(names, manifest.load_manifest(spark, data), **options)


def read(spark, data, name, **options):
    return files.read_dataset(spark, specs(data, name)[0], data, **options).orderBy("row_idx")


def test_manifest(spark, data):
    one, two = specs(data, " plain , short")
    assert one.columns == manifest.DEFAULT_COLUMNS and one.sha1 == "0" * 40
    assert two.columns["query"] is None and two.columns["messages"] is None
    hub = specs(data, "hub")[0]
    assert (hub.location, hub.address, hub.subset, hub.sha1) == ("hf_hub", "a/b", "s1", None)
    assert specs(data, "script")[0].location == "script"
    with pytest.raises(ValueError, match="no dataset"):
        specs(data, "nobody")
    with pytest.raises(ValueError, match="no manifest"):
        manifest.load_manifest(spark, data + "/nowhere")
    assert [s.system_prompt for s in specs(data, "plain,short,lines,chat", system_prompt="a|")] == ["a", "", "a", ""]
    table = manifest.manifest_table(spark, MANIFEST)
    assert table.count() == len(MANIFEST) and table.filter("ranking").count() == 1


def test_job_options():
    for bad in (
        dict(streaming=True, val_size=0.5, max_steps=1),
        dict(streaming=True, max_samples=3, max_steps=1),
        dict(streaming=True, cache_path="x", max_steps=1),
        dict(streaming=True),
        dict(predict_with_generate=True),
        dict(do_predict=True),
    ):
        with pytest.raises(ValueError):
            manifest.JobOptions(**bad)
    assert manifest.JobOptions(interleave_probs="0.5, 0.5").probabilities() == [0.5, 0.5]
    assert manifest.JobOptions(sft_packing=True).mode() == "packed"


def test_json_array(spark, data):
    rows = read(spark, data, "plain").collect()
    assert [(r.row_idx, r.prompt, r.response) for r in rows] == [(n, f"i{n}", f"问{n}\nline") for n in range(5)]
    assert rows[0].history[0].q == "h"  # a file's own history column is taken over unmapped
    assert read(spark, data, "plain", max_samples=2).count() == 2


def test_ranked_lines(spark, data):
    assert [r.responses for r in read(spark, data, "ranked").collect()] == [["good", "bad"], ["one"]]


def test_csv_with_line_breaks(spark, data):
    assert [(r.prompt, r.response) for r in read(spark, data, "short").collect()] == [('a, "b"\nc', "d"), ("e", None)]


def test_text_lines(spark, data):
    assert [r.prompt for r in read(spark, data, "lines").collect()] == ["one", "", "three"]


def test_conversations(spark, data):
    rows = read(spark, data, "chat").collect()
    assert [(r.row_idx, r.prompt, r.response, len(r.history)) for r in rows] == [(0, "c", "d", 1), (1, "f", "g", 0)]
    # max_samples counts rows before empty conversations are dropped
    assert read(spark, data, "chat", max_samples=2).count() == 1
    assert read(spark, data, "odd_chat").first().response == "b"


def test_folder(spark, data):
    assert [r.prompt for r in read(spark, data, "folder").collect()] == ["00", "01", "10", "11", "20", "21"]
    with pytest.raises(AssertionError, match="share one type"):
        read(spark, data, "mixed")
    with pytest.raises(AssertionError, match="extension"):
        files.format_of(["x.bin"])
    with pytest.raises(ValueError, match="not found"):
        storage.list_files(spark, data + "/nowhere")


@pytest.mark.parametrize("by_driver", [100, 0])
def test_json_layouts_side_by_side(spark, data, monkeypatch, by_driver):
    monkeypatch.setattr(files, "LOOKED_AT_BY_DRIVER", by_driver)
    assert [r.row_idx for r in read(spark, data, "layouts").collect()] == list(range(9))
    for n in (1, 3, 4, 8, 9, 20):
        assert read(spark, data, "layouts", max_samples=n).count() == min(n, 9)


def test_csv_headers_must_agree(spark, data):
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, data, "headers").collect()


def test_missing_columns(spark, data):
    spec = manifest.parse_entry("p", {"file_name": "plain.json", "columns": {"prompt": "question", "response": "output"}})
    with pytest.raises(ValueError, match="question"):
        files.read_dataset(spark, spec, data)


def test_tables(spark, tmp_path):
    df = spark.range(20).select(
        F.concat(F.lit("p"), "id").alias("instruction"), F.lit("").alias("input"), F.lit("o").alias("output"),
        F.when(F.col("id") < 15, F.lit("train")).otherwise(F.lit("test")).alias("split"),
    )
    df.write.partitionBy("split").parquet(str(tmp_path / "by_column"))
    df.filter("split='test'").drop("split").write.parquet(str(tmp_path / "by_folder/s1/test"))
    df.write.orc(str(tmp_path / "o"))
    df.createOrReplaceTempView("bound_table")
    spec = manifest.parse_entry("hub", MANIFEST["hub"])
    for bound, split, n in (
        (f"parquet:{tmp_path}/by_column", "train", 15),
        (f"parquet:{tmp_path}/by_folder", "test", 5),
        (f"orc:{tmp_path}/o", "test", 5),
        ("bound_table", "train", 15),
    ):
        chosen = spec if "by_folder" in bound else replace(spec, subset=None)
        got = files.read_dataset(spark, chosen, ".", split, bindings={"hub": bound})
        assert sorted(r.row_idx for r in got.collect()) == list(range(n))
    with pytest.raises(ValueError, match="bind"):
        files.read_dataset(spark, spec, ".")
    with pytest.raises(ValueError, match="no split"):
        files.select_split(df.drop("split"), "test", None)


def test_integrity(spark, data, monkeypatch):
    path = data + "/plain.json"
    with open(path, "rb") as f:
        good = hashlib.sha1(f.read()).hexdigest()
    for limit in (integrity.SMALL_FILE, 10):  # in SQL, and read in pieces
        monkeypatch.setattr(integrity, "SMALL_FILE", limit)
        report = integrity.integrity_report(
            spark,
            {
                "a": ([path], good),
                "b": ([data + "/lines.txt"], good),
                "c": ([path], None),
                "d": ([path, data + "/lines.txt"], good),
            },
        )
        got = {r.dataset: r.status for r in report.collect()}
        assert got == {"a": "ok", "b": "mismatch", "c": "missing_hash", "d": "too_many_files"}


def test_caches(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert cache.encoded_cache(spark, str(tmp_path / "c"), build).count() == 3
    assert len(calls) == 1
    cache.encoded_cache(spark, None, build)
    assert len(calls) == 2
    for overwrite in (False, False, True):
        assert cache.reused(spark, "r", f"recipe {tmp_path}", build, overwrite).count() == 3
    assert len(calls) == 4


def test_sinks(spark, tmp_path, tokenizer):
    records = spark.createDataFrame([("问", None), ("b", "c")], "label string, predict string")
    sinks.write_predictions(records, str(tmp_path / "p"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "p")).collect())
    assert lines == ['{"label":"b","predict":"c"}', '{"label":"问","predict":null}']
    table = sinks.metrics_table(spark, "eval", {"eval_loss": 1.0, "eval_accuracy": 0.5}, predict_with_generate=True)
    for _ in range(2):
        sinks.append_metrics(table, str(tmp_path / "m"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "m")).collect()] == [("eval", "eval_accuracy", 0.5)] * 2
    encoded = spark.createDataFrame([(1, [1, 197], [-100, 197])], "row_idx bigint, input_ids array<int>, labels array<int>")
    row = sinks.preview(encoded, tokenizer, order="row_idx")[0]
    assert (row.input_text, row.labels_text, row.labels) == ("<bos>a", "a", [-100, 197])
    with pytest.raises(RuntimeError, match="no example"):
        sinks.preview(encoded.filter("false"), tokenizer)


def test_shared_folder(spark, monkeypatch):
    named = spark.conf.get(storage.CHECKPOINT_SETTING, None)
    if named:
        assert storage.new_folder(spark, "x").startswith(named.rstrip("/"))
    monkeypatch.setattr(storage, "CHECKPOINT_SETTING", "spark.sftprep.unset")
    assert "sftprep-" in storage.shared_dir(spark)
    assert storage.new_folder(spark, "x") != storage.new_folder(spark, "x")
    assert storage.write_through(spark.range(5), "t").count() == 5


def test_shared_folder():
    def session(**settings):
        class Session:
            class conf:
                @staticmethod
                def get(name, default=None):
                    return settings.get(name.replace(".", "_"), default)

        return Session()

    assert storage.shared_dir(session(spark_checkpoint_dir="hdfs://n/c/")) == "hdfs://n/c"
    assert storage.shared_dir(session(spark_sql_warehouse_dir="hdfs://n/w")) == "hdfs://n/w/intermediate"


def test_columns_that_come_late(spark, tmp_path):
    line = {"instruction": "a", "input": "", "output": "b"}
    late = {**line, "system": "s", "history": [["q", "r"]]}
    (tmp_path / "lines.jsonl").write_text("\n".join(map(json.dumps, [line] * 1001 + [late])))
    (tmp_path / "array.json").write_text(json.dumps([{"instruction": "a", "output": "b"}, late]))
    (tmp_path / "parts").mkdir()
    (tmp_path / "parts/1.json").write_text(json.dumps([line]))
    (tmp_path / "parts/2.jsonl").write_text(json.dumps(late))
    names = ("lines.jsonl", "array.json", "parts")
    (tmp_path / "dataset_info.json").write_text(json.dumps({n: {"file_name": n} for n in names}))
    for name, n in zip(names, (1002, 2, 2), strict=True):
        rows = read(spark, str(tmp_path), name).collect()
        assert len(rows) == n and rows[0].system is None
        assert rows[-1].system == "s" and [tuple(h) for h in rows[-1].history] == [("q", "r")]
    spec = specs(f"file:{tmp_path}", "parts")[0]
    got = str(tmp_path / "out")
    stream = files.read_stream(spark, spec, str(tmp_path), files_per_trigger=1)

    def run():
        query = stream.writeStream.format("parquet").option("path", got).option("checkpointLocation", str(tmp_path / "marks"))
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted((r.prompt, r.system or "") for r in spark.read.parquet(got).collect())

    assert run() == [("a", ""), ("a", "s")]  # an array and lines in one folder
    (tmp_path / "parts/0 0.json").write_text("\n".join(json.dumps({**line, "instruction": f"l{n}"}) for n in range(7)))
    (tmp_path / "parts/3.json").write_text(json.dumps([{**late, "instruction": "z"}], indent=1))
    assert run() == [("a", ""), ("a", "s")] + [(f"l{n}", "") for n in range(7)] + [("z", "s")]
    hub = manifest.parse_entry("hub", MANIFEST["hub"])
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1/1.json").write_text(json.dumps([line, late]))
    got = files.read_dataset(spark, hub, ".", bindings={"hub": f"json:{tmp_path}"}).orderBy("row_idx").collect()
    assert [r.system for r in got] == [None, "s"]
    with pytest.raises(ValueError, match="no subset"):
        files.select_split(spark.range(3).withColumn("subset", F.lit("x")), "train", "y")


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def test_scanners_cut_pieces_exactly(monkeypatch):
    def in_pieces(scanner, data, size):
        out, state, depth = [], 0, 0
        for start in range(0, len(data), size):
            end = min(start + size, len(data))
            out += chunks.records(Bytes(data), scanner, start, end, len(data), state, depth)
            states, depths = chunks.effect(scanner, np.frombuffer(data[start:end], np.uint8))
            state, depth = states[state], depth + depths[state]
        return [r.decode() for r in out if r.strip()]

    draw = random.Random(7)
    for _ in range(400):
        monkeypatch.setattr(chunks, "READ_ON", draw.choice([1, 3, 7, 1000]))
        rows = [["".join(draw.choices('a",\n\\[]{} é', k=draw.randint(0, 6))) for _ in range(3)] for _ in range(draw.randint(0, 6))]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(rows)
        cut = in_pieces(chunks.CSV, out.getvalue().encode(), draw.randint(1, 20))
        assert [next(csv.reader(io.StringIO(r, newline=""))) for r in cut] == rows
        objects = [{"k" + a: b, "n": [1, {"z": [c]}]} for a, b, c in rows]
        data = json.dumps(objects, indent=draw.choice([None, 1]), ensure_ascii=draw.choice([True, False])).encode()
        assert [json.loads(r) for r in in_pieces(chunks.JSON, data, draw.randint(1, 20))] == objects
        text, size = "\n".join(a.replace("\n", "") for a, _, _ in rows).encode(), draw.randint(1, 9)
        got = [x for s in range(0, len(text), size) for x in chunks.lines(Bytes(text), s, min(s + size, len(text)), len(text))]
        assert b"\n".join(got).rstrip(b"\n") == text.rstrip(b"\n")
    # quotes inside a bare field are text; behind a closing quote a bare field goes on
    assert in_pieces(chunks.CSV, b'5" x,b\n"a\n""b"c,d\n\n"e', 4) == ['5" x,b', '"a\n""b"c,d', '"e']
    with pytest.raises(ValueError, match="no end"):
        in_pieces(chunks.JSON, b'[{"a": 1}, {"b": ', 5)


def test_files_in_pieces(spark, data, tmp_path):
    """The same rows in the same order as by Spark's own readers, whatever the size of pieces."""
    folder = tmp_path / "large dir"
    folder.mkdir()
    text = ['plain', 'say "x"', 'a,b', 'two\nlines', '', 'back\\slash "', 'é [ { ]']
    rows = [(text[n % 7], text[n // 7 % 7], f"{n}") for n in range(120)]
    for name, part in (("a b.csv", rows[:70]), ("c.csv", rows[70:])):
        with open(folder / name, "w", newline="", encoding="utf-8") as f:
            csv.writer(f, lineterminator="\n" if "c" in name else "\r\n").writerows([("instruction", "input", "output"), *part])
    spec = manifest.parse_entry("d", {"file_name": "large dir"})
    want = [tuple(r) for r in files.read_dataset(spark, spec, str(tmp_path)).orderBy("row_idx").collect()]
    assert [w[1] for w in want if w[1]] == [a for a, _, _ in rows if a] and len(want) == 120
    for size in (50, 1000):
        got = files.read_dataset(spark, spec, str(tmp_path), chunk=size)
        assert sorted(tuple(r) for r in got.collect()) == want
    (folder / "d.csv").write_text("instruction,output,input\n")
    with pytest.raises(Exception, match="the header of"):
        files.read_dataset(spark, spec, str(tmp_path), chunk=50).collect()
    for n in (None, 3):
        want = read(spark, data, "plain", max_samples=n).collect()
        assert read(spark, data, "plain", max_samples=n, chunk=40).collect() == want
    # arrays in pieces, lines by Spark, in the order of the files
    assert [r.row_idx for r in read(spark, data, "layouts", chunk=20).collect()] == list(range(9))
    assert [r.prompt for r in read(spark, data, "chat", chunk=30).collect()] == ["c", "f"]


def test_small_pieces_cost_no_more_than_their_bytes(spark, tmp_path):
    """A piece does not read far beyond its end, and pieces side by side share a task."""

    class Counted(Bytes):
        read = 0

        def read_at(self, n, at):
            self.read += n
            return super().read_at(n, at)

    text = b'"' + b"x" * 99 + b'"\n'
    stream = Counted(text * 20_000)
    found = list(chunks.records(stream, chunks.CSV, 1020, 2040, len(stream.data), 0, 0))
    assert [len(r) for r in found] == [101] * 10 and stream.read <= 1020 + chunks.READ_FIRST
    objects = [{"instruction": "i" * (n % 7), "n": [n]} for n in range(500)]
    (tmp_path / "a.json").write_text(json.dumps(objects))
    (tmp_path / "b.json").write_text(json.dumps(objects[:9]))
    paths = [str(tmp_path / name) for name in ("a.json", "b.json")]
    texts = chunks.record_texts(spark, paths, None, 40)
    assert texts.rdd.getNumPartitions() == 2
    got = sorted((r["_file"], r["_start"], r["_place"], json.loads(r["value"])["n"][0]) for r in texts.collect())
    assert [g[3] for g in got] == [*range(500), *range(9)]


def test_runs_of_pieces(spark, tmp_path, monkeypatch):
    """Files of many runs, which begin in strings and at any depth."""
    monkeypatch.setattr(chunks, "TASK_BYTES", 100)
    objects = [{"instruction": '[,"{' * (n % 9), "n": [n, {"z": []}]} for n in range(200)]
    (tmp_path / "a.json").write_text(json.dumps(objects))
    (tmp_path / "none.json").write_text("")
    texts = chunks.record_texts(spark, [str(tmp_path / "a.json"), str(tmp_path / "none.json")], None, 30)
    assert texts.rdd.getNumPartitions() > 50
    rows = sorted((r["_file"], r["_start"], r["_place"], r["value"]) for r in texts.collect())
    assert [json.loads(r[3]) for r in rows] == objects


def test_array_of_rows():
    """The rows of each partition as one array, many at a time, whatever comes in a batch."""
    from sftprep.plans.catalog import _as_array

    batches = [pd.DataFrame({"value": [f"{n}" for n in v]}) for v in (range(600), [], [600])]
    out = list(_as_array(batches))
    assert len(out) < 10 and json.loads("".join(v for batch in out for v in batch["value"])) == list(range(601))
    assert [v for batch in _as_array([]) for v in batch["value"]] == ["[]"]


def test_csv_pieces_share_tasks(spark, tmp_path, monkeypatch):
    """Tasks of a CSV grow with its bytes, not with its pieces; runs begin inside quotes too."""
    rows = [(f"{n}", 'a,"\n' * (n % 5)) for n in range(300)]
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows([("instruction", "output"), *rows])
    for run, tasks in ((chunks.TASK_BYTES, range(1, 2)), (200, range(10, 60))):
        monkeypatch.setattr(chunks, "TASK_BYTES", run)
        texts = chunks.record_texts(spark, [str(tmp_path / "a.csv")], ["instruction", "output"], 20)
        assert texts.rdd.getNumPartitions() in tasks
        found = sorted((r["_start"], r["_place"], r["value"]) for r in texts.collect())
        assert [tuple(next(csv.reader(io.StringIO(r[2], newline="")))) for r in found] == rows
