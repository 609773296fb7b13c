import hashlib
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from sftprep.functions.templates import TEMPLATES
from sftprep.operators import encode, mixing, split
from sftprep.operators.ordering import row_index
from sftprep.operators.packing import pack_blocks
from sftprep.plans import prepare
from sftprep.plans.catalog import QUERIES
from sftprep.plans.oracle import ORACLES
from sftprep.sources import files, manifest
from sftprep.storage import list_files, whole_file
from sftprep.streaming import jobs, state
from sftprep.streaming.state import Carried

from . import plain

SCHEMA = "row_idx bigint, prompt string, query string, response string, history array<struct<q:string,r:string>>"


@pytest.fixture
def data(tmp_path):
    info = {
        "a": {"file_name": "a"},
        "b": {"file_name": "b.json", "formatting": "sharegpt"},
    }
    (tmp_path / "dataset_info.json").write_text(json.dumps(info))
    (tmp_path / "a").mkdir()
    for n in range(4):
        rows = [{"instruction": f"i{n}{k}", "input": "q" * k, "output": "" if k == 2 else f"o{k}"} for k in range(4)]
        (tmp_path / "a" / f"{n}.jsonl").write_text("\n".join(map(json.dumps, rows)))
    talks = [[{"from": "u", "value": f"{c}{i}"} if i % 2 == 0 else {"from": "g", "value": "r"} for i in range(c % 5 + 1)] for c in range(9)]
    (tmp_path / "b.json").write_text(json.dumps([{"conversations": t} for t in talks]))
    return str(tmp_path)


def options(data, **more):
    return manifest.JobOptions(dataset="a,b", dataset_dir=data, model_name="ChatGLM3-6B-Chat", **more)


def mixture():
    """The two datasets as plain turn lists, in order."""
    a = [[(f"i{n}{k}" + ("\n" + "q" * k if k else ""), "" if k == 2 else f"o{k}")] for n in range(4) for k in range(4)]
    b = [[(f"{c}{2 * j}", "r") for j in range((c % 5 + 1) // 2)] for c in range(9)]
    return a + [t for t in b if t]


def test_whole_job(spark, data, tokenizer):
    parts = prepare.prepare(spark, options(data, val_size=3), tokenizer)
    template = TEMPLATES["chatglm3"]
    want = {
        i: plain.supervised(template, tokenizer.special, tokenizer.encode_literal, t, None, 1024)
        for i, t in enumerate(mixture())
        if t[-1][1]
    }
    rows = parts["train"].unionByName(parts["eval"]).collect()
    assert {r.row_idx: (r.input_ids, r.labels) for r in rows} == want
    assert parts["eval"].count() == 3
    padded = prepare.batches(parts["train"], options(data, batch_size=4), tokenizer)
    assert all(len({len(r.input_ids) for r in g}) == 1 for g in by_batch(padded).values())


def by_batch(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.batch, []).append(r)
    return groups


def test_packed_job(spark, data, tokenizer):
    parts = prepare.prepare(spark, options(data, sft_packing=True, cutoff_len=16), tokenizer)
    want = plain.packed(
        [(i, t) for i, t in enumerate(mixture()) if t[-1][1]],
        TEMPLATES["chatglm3"], tokenizer.special, tokenizer.encode_literal, 16, 1000,
    )
    got = [(r.input_ids, r.labels) for r in parts["train"].orderBy("row_idx").collect()]
    assert got == [(ids, labels) for _, _, ids, labels in want]


def test_other_jobs(spark, data, tokenizer, tmp_path):
    cached = options(data, cache_path=str(tmp_path / "cache"))
    first = prepare.prepare(spark, cached, tokenizer)["train"].count()
    assert prepare.prepare(spark, manifest.JobOptions(model_name="ChatGLM3-6B-Chat", cache_path=cached.cache_path), tokenizer)["train"].count() == first
    mixed = options(data, mix_strategy="interleave_under", max_samples=5)
    assert prepare.read_mixture(spark, mixed).count() == 2 * 4  # five raw chats, one of them empty
    weighted = options(data, mix_strategy="interleave_over", interleave_probs="0.5,0.5")
    assert prepare.read_mixture(spark, weighted).count() >= 24
    predicted = prepare.prepare(
        spark, options(data, do_train=False, predict_with_generate=True, template="default", system_prompt="Be brief."), tokenizer
    )["eval"]
    assert predicted.count() == len(mixture())
    assert by_batch(prepare.batches(predicted, options(data, do_train=False, predict_with_generate=True), tokenizer))
    with pytest.raises(ValueError, match="train_on_prompt"):
        prepare.prepare(spark, options(data, train_on_prompt=True), tokenizer)


# -- streams ----------------------------------------------------------------------


@pytest.fixture
def stream(spark, tmp_path):
    """Five files of ten rows; one file per micro-batch."""
    base = tmp_path / "in"
    for n in range(5):
        rows = spark.range(n * 10, n * 10 + 10).select(
            F.col("id").alias("row_idx"), F.concat(F.lit("p"), "id").alias("prompt"), F.lit("").alias("query"),
            F.concat(F.lit("r"), "id").alias("response"),
            F.array(F.struct(F.lit("h").alias("q"), F.lit("g").alias("r"))).alias("history"),
        )
        rows.coalesce(1).write.mode("append").json(str(base))

    def make():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(base))

    make.batch = lambda: spark.read.schema(SCHEMA).json(str(base))
    return make


def run(query):
    query.awaitTermination()


def test_stream_equals_batch(spark, stream, tokenizer, tmp_path):
    def encoded(df):
        return encode.supervised(df, TEMPLATES["chatglm2"], tokenizer, 20)

    run(jobs.write_rows(encoded(stream()), str(tmp_path / "o"), str(tmp_path / "c")))
    got = spark.read.parquet(str(tmp_path / "o"))
    assert sorted(map(str, got.collect())) == sorted(map(str, encoded(stream.batch()).collect()))


def test_take_and_skip(spark, stream, tmp_path):
    head, rest = str(tmp_path / "h"), str(tmp_path / "r")
    run(jobs.split_stream(stream(), 23, "row_idx", rest, head, str(tmp_path / "c")))
    taken, left = spark.read.parquet(head).collect(), spark.read.parquet(rest).collect()
    assert len(taken) == 23 and len(left) == 27
    assert not {r.row_idx for r in taken} & {r.row_idx for r in left}
    # three whole micro-batches' worth of rows, the last one cut
    assert {r.batch for r in taken} == {0, 1, 2} and {r.batch for r in left} == {2, 3, 4}
    # nothing new: a second run changes nothing
    run(jobs.split_stream(stream(), 23, "row_idx", rest, head, str(tmp_path / "c")))
    assert spark.read.parquet(head).count() == 23
    # only the head, as for a limited number of steps
    run(jobs.take_and_skip(stream(), 7, "row_idx", str(tmp_path / "h2"), None, str(tmp_path / "c2")))
    assert spark.read.parquet(str(tmp_path / "h2")).count() == 7
    with pytest.raises(ValueError):
        jobs.split_stream(stream(), 0.5, "row_idx", rest, head, str(tmp_path / "c3"))


def test_shuffle_and_pack(spark, stream, tokenizer, tmp_path):
    run(jobs.split_stream(stream(), 0, "row_idx", str(tmp_path / "t"), str(tmp_path / "e"), str(tmp_path / "c"), 4, 1))
    rows = spark.read.parquet(str(tmp_path / "t")).collect()
    assert sorted((r.batch, r.shuffled_idx) for r in rows) == [(b, i) for b in range(5) for i in range(10)]
    template = TEMPLATES["chatglm3"]
    pieces = encode.training_pieces(
        stream(), template, tokenizer, encode.example_turns(stream(), template, F.col("response"))
    )
    pieces = pieces.withColumnRenamed("row_idx", "key")
    run(jobs.pack_stream(pieces, "key", 8, str(tmp_path / "p"), str(tmp_path / "c2"), tokenizer.special.eos_id, 5))
    blocks = spark.read.parquet(str(tmp_path / "p"))
    assert blocks.filter(F.size("input_ids") != 8).count() == 0 and blocks.select("batch").distinct().count() == 5


def test_mixing_streams(spark, stream, tmp_path):
    both = [stream().select("row_idx").withColumn("s", F.lit(i)) for i in (0, 1)]
    both = [s.withColumnRenamed("row_idx", "key") for s in both]
    run(jobs.interleave_streams(both, "key", str(tmp_path / "o"), str(tmp_path / "c")))
    rows = spark.read.parquet(str(tmp_path / "o")).orderBy("batch", "row_idx").collect()
    assert len(rows) == 100 and [r.s for r in rows[:6]] == [0, 1, 0, 1, 0, 1]
    run(jobs.interleave_streams(both, "key", str(tmp_path / "w"), str(tmp_path / "c2"), "interleave_over", [0.5, 0.5]))
    assert spark.read.parquet(str(tmp_path / "w")).select("key").distinct().count() == 50
    run(jobs.write_rows(jobs.concat_streams(both), str(tmp_path / "u"), str(tmp_path / "c3")))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 100


def keyed(stream, n_sources):
    return [stream().select(F.col("row_idx").alias("key")).filter(F.col("row_idx") % n_sources == i) for i in range(n_sources)]


def lagging(stream):
    """Two sources of which one comes much later than the other."""
    rows = stream().select(F.col("row_idx").alias("key"))
    return [rows.filter("key < 20 OR key >= 45"), rows.filter("key BETWEEN 15 AND 44")]


@pytest.mark.parametrize("strategy", ["interleave_under", "interleave_over"])
@pytest.mark.parametrize("shares", [None, [0.7, 0.3]])
@pytest.mark.parametrize("sources", [lambda s: keyed(s, 2), lagging])
def test_streams_interleave_like_tables(spark, stream, tmp_path, strategy, shares, sources):
    out = str(tmp_path / "o")
    run(jobs.interleave_streams(sources(stream), "key", out, str(tmp_path / "c"), strategy, shares, 5, "md5"))
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() > 1
    parts = sources(lambda: stream.batch())
    stacked = mixing.stack([row_index(p, "key") for p in parts])
    want = mixing.mix(stacked, 2, strategy, shares, 5, "md5")
    assert sorted((r.row_idx, r.key) for r in got.collect()) == sorted((r.row_idx, r.key) for r in want.collect())


def test_an_interleaved_stream_goes_on(spark, stream, tmp_path):
    """Two runs, the second with new files, give what one run over all of them gives."""
    base = tmp_path / "some"
    files_ = sorted((tmp_path / "in").glob("*.json"), key=lambda f: f.stat().st_mtime)

    def streams():
        rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(base))
        rows = rows.select(F.col("row_idx").alias("key"))
        return [rows.filter("key < 25"), rows.filter("key >= 25")]

    base.mkdir()
    for part in (range(3), range(3, 5)):
        for i in part:
            copy = base / files_[i].name
            copy.write_text(files_[i].read_text())
            os.utime(copy, (10**9 + i, 10**9 + i))
        run(jobs.interleave_streams(streams(), "key", str(tmp_path / "o"), str(tmp_path / "c")))
    got = sorted((r.row_idx, r.key) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    assert got == sorted([(2 * i, i) for i in range(25)] + [(2 * i + 1, 25 + i) for i in range(25)])
    # a mixture that starts sources again is closed by the end of its input
    over = (str(tmp_path / "o2"), str(tmp_path / "c2"), "interleave_over")
    run(jobs.interleave_streams(streams(), "key", *over))
    extra = spark.createDataFrame([(99, "p", "", "r", [])], SCHEMA)
    extra.coalesce(1).write.mode("append").json(str(base))
    with pytest.raises(Exception, match="closed"):
        run(jobs.interleave_streams(streams(), "key", *over))
    with pytest.raises(ValueError, match="way of mixing"):
        jobs.interleave_streams(streams(), "key", "p", "c", "stirred")


@pytest.mark.parametrize("pack_rows", [1, 7, 10, 23, 100])
def test_streams_pack_like_tables(spark, stream, tokenizer, tmp_path, pack_rows):
    def pieces(df):
        df = df.withColumnRenamed("row_idx", "key")
        turns = encode.example_turns(df, TEMPLATES["chatglm3"], F.col("response"))
        return encode.training_pieces(df, TEMPLATES["chatglm3"], tokenizer, turns, keep=("key",))

    out, eos = str(tmp_path / "o"), tokenizer.special.eos_id
    run(jobs.pack_stream(pieces(stream()), "key", 8, out, str(tmp_path / "c"), eos, pack_rows))
    got = spark.read.parquet(out).drop("batch")
    want = pack_blocks(row_index(pieces(stream.batch()), "key"), 8, eos, pack_rows)
    assert want.count() > 0
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    before = sorted(map(str, got.collect()))
    run(jobs.pack_stream(pieces(stream()), "key", 8, out, str(tmp_path / "c"), eos, pack_rows))  # nothing new
    assert sorted(map(str, spark.read.parquet(out).drop("batch").collect())) == before


def plain_buffer(n, size, seed):
    """Rows 0 to n-1 one by one through a buffer of ``size``: their order."""
    draw = lambda x: hashlib.md5(f"{seed}:{x}".encode()).hexdigest()
    buffer, out = list(range(min(n, size))), []
    for row in range(size, n):
        at = int(draw(row - size)[:8], 16) % size
        out.append(buffer[at])
        buffer[at] = row
    return out + sorted(buffer, key=draw)


@pytest.mark.parametrize("size", [1, 4, 13, 49, 50, 1000])
def test_moving_buffer(spark, stream, tmp_path, size):
    rows = spark.range(50).withColumnRenamed("id", "row_idx")
    got = split.moving_shuffle(rows, size, 3).orderBy("shuffled_idx").collect()
    assert [r.shuffled_idx for r in got] == list(range(50)) and [r.row_idx for r in got] == plain_buffer(50, size, 3)
    run(jobs.moving_shuffle_stream(stream().select(F.col("row_idx").alias("key")), "key", str(tmp_path / "o"), str(tmp_path / "c"), size, 3))
    got = spark.read.parquet(str(tmp_path / "o")).orderBy("shuffled_idx").collect()
    assert [r.shuffled_idx for r in got] == list(range(50)) and [r.key for r in got] == plain_buffer(50, size, 3)


def test_moving_buffer_of_few_rows(spark):
    assert split.moving_shuffle(spark.range(0).withColumnRenamed("id", "row_idx"), 4).collect() == []
    with pytest.raises(ValueError):
        split.moving_shuffle(spark.range(3).withColumnRenamed("id", "row_idx"), 0)


def test_a_batch_that_runs_again_replaces_its_rows(spark, stream, tmp_path, monkeypatch):
    """The last batch fails after it has written its rows and counters; a restart runs it again."""
    out, marks = str(tmp_path / "o"), str(tmp_path / "c")
    put, broken = Carried.put, [True]

    def failing(self, batch_id, counters):
        put(self, batch_id, counters)
        if batch_id == 3 and broken:
            broken.clear()
            raise RuntimeError("lost")

    monkeypatch.setattr(Carried, "put", failing)
    def start(kind):
        if kind == "deal":
            return jobs.deal_rows(stream(), [(37, out)], str(tmp_path / "r"), "row_idx", marks)
        if kind == "mix":
            return jobs.interleave_streams(keyed(stream, 2), "key", out, marks)
        return jobs.moving_shuffle_stream(stream().select(F.col("row_idx").alias("key")), "key", out, marks, 13, 3)

    for kind in ("deal", "mix", "shuffle"):
        out, marks = str(tmp_path / f"o-{kind}"), str(tmp_path / f"c-{kind}")
        broken[:] = [True]
        with pytest.raises(Exception, match="lost"):
            run(start(kind))
        run(start(kind))
        rows = spark.read.parquet(out).collect()
        if kind == "deal":
            assert sorted(r.row_idx for r in rows) == list(range(37))
            assert sorted(r.row_idx for r in spark.read.parquet(str(tmp_path / "r")).collect()) == list(range(37, 50))
        elif kind == "mix":
            assert sorted((r.row_idx, r.key) for r in rows) == [(i, i) for i in range(50)]
        else:
            assert [r.key for r in sorted(rows, key=lambda r: r.shuffled_idx)] == plain_buffer(50, 13, 3)


def test_ledger_reads_stay_constant(spark, tmp_path, monkeypatch):
    """Each batch asks for one earlier entry, however many there are."""
    carried, read = Carried(spark, str(tmp_path / "x")), []
    monkeypatch.setattr(state, "whole_file", lambda s, p: read.append(p) or whole_file(s, p))
    monkeypatch.setattr(state, "list_files", lambda s, p: read.append(p) or list_files(s, p))
    for batch_id in range(100):
        if batch_id:
            assert carried.last(batch_id) == (batch_id - 1, {"left": [batch_id - 1]})
        carried.put(batch_id, {"left": [batch_id]})
    assert len(read) == 99 and carried.last() == (99, {"left": [99]})


def test_rows_dealt_without_a_key(spark, stream, tmp_path):
    shares = [(13, str(tmp_path / "a")), (20, str(tmp_path / "b"))]
    run(jobs.deal_rows(stream(), shares, str(tmp_path / "r"), None, str(tmp_path / "c")))
    parts = [{r.row_idx for r in spark.read.parquet(str(tmp_path / p)).collect()} for p in "abr"]
    assert [len(p) for p in parts] == [13, 20, 17] and set.union(*parts) == set(range(50))


def test_job_takes_an_earlier_result(spark, data, tokenizer, monkeypatch):
    made = []
    encoded = prepare.encode_examples
    monkeypatch.setattr(prepare, "encode_examples", lambda *a: made.append(1) or encoded(*a))

    def job(**more):
        rows = prepare.prepare(spark, options(data, reuse_results=True, **more), tokenizer)["train"].collect()
        return len(made), sorted(tuple(r.input_ids) for r in rows)

    first = job()
    assert first == job() == job(batch_size=3) and first[0] == 1
    assert job(cutoff_len=8)[0] == 2 and job(on_bad_order="drop")[0] == 3
    n, rows = job(overwrite_cache=True)
    assert n == 4 and rows == first[1]
    with open(os.path.join(data, "a", "0.jsonl"), "a") as f:
        f.write("\n" + json.dumps({"instruction": "new", "input": "", "output": "row"}))
    n, rows = job()
    assert n == 5 and len(rows) == len(first[1]) + 1
    assert job()[0] == 5


@pytest.fixture
def folders(tmp_path):
    info = {"a": {"file_name": "a"}, "b": {"file_name": "b"}}
    (tmp_path / "dataset_info.json").write_text(json.dumps(info))
    for name, n in (("a", 12), ("b", 7)):
        (tmp_path / name).mkdir()
        rows = [{"instruction": f"{name}{k}", "input": "", "output": "o" * k} for k in range(n)]
        (tmp_path / name / "x.jsonl").write_text("\n".join(map(json.dumps, rows)))
    return str(tmp_path)


@pytest.mark.parametrize("more,n_train,n_eval", [
    (dict(max_steps=100), 17, 0),  # two empty answers are dropped
    (dict(max_steps=2, batch_size=3, val_size=4), 6, 4),
    (dict(max_steps=100, mix_strategy="interleave_under", val_size=2), 10, 2),  # seven pairs, two rows empty
    (dict(max_steps=100, sft_packing=True, cutoff_len=8), None, 0),
])
def test_streaming_job(spark, folders, tokenizer, tmp_path, more, n_train, n_eval):
    opts = manifest.JobOptions(
        dataset="a,b", dataset_dir=folders, model_name="ChatGLM3-6B-Chat", streaming=True, **more
    )
    train, ev = str(tmp_path / "train"), str(tmp_path / "eval")
    prepare.prepare_stream(spark, opts, tokenizer, train, ev, str(tmp_path / "work"))
    rows = spark.read.parquet(train).collect()
    assert rows and n_train in (None, len(rows))
    if n_eval:
        assert spark.read.parquet(ev).count() == n_eval
    if opts.sft_packing:
        assert all(len(r.input_ids) == 8 for r in rows)
    with pytest.raises(ValueError, match="not for streaming"):
        prepare.prepare_stream(spark, manifest.JobOptions(), tokenizer, train, ev, "w")


def test_reading_a_folder_as_a_stream(spark, data, tmp_path):
    spec = manifest.resolve_datasets("a", manifest.load_manifest(spark, data))[0]
    run(jobs.write_rows(files.read_stream(spark, spec, data), str(tmp_path / "o"), str(tmp_path / "c")))
    want = files.read_dataset(spark, spec, data).drop("row_idx").collect()
    got = spark.read.parquet(str(tmp_path / "o")).select(*files.read_stream(spark, spec, data).columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    with pytest.raises(ValueError, match="folder"):
        files.read_stream(spark, manifest.resolve_datasets("b", manifest.load_manifest(spark, data))[0], data)


# -- registered queries -----------------------------------------------------------


def test_registered_queries_match_their_sql(spark):
    import glob

    import duckdb

    import __spark_entry__ as entry
    from check import table

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    duck = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        duck.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert entry.entry(spark).count() > 0
    for name in ("encode_sft", "pack_blocks", "interleave_weighted_over", "split_fraction", "pad_right", "read_csv"):
        df = queries[name](spark, folder)
        want = duck.sql(oracles[name])
        assert table(df.collect(), df.columns) == table(want.fetchall(), want.columns), name


def test_one_conversation_of_ten_thousand_messages(spark, tmp_path):
    duck = duckdb.connect()
    talk = [(7, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(10_000)]
    few = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t}") for c in range(6) for t in range(c + 1)]
    table = spark.createDataFrame(talk + few, "conv_id bigint, turn bigint, role string, text string")
    table.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    duck.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    for name in ("system_prompt", "sharegpt_arrays", "encode_sft", "encode_predict", "truncate_proportional"):
        got = QUERIES[name](spark, str(tmp_path))
        want = duck.execute(ORACLES[name])
        columns = sorted(c[0] for c in want.description)
        place = [[c[0] for c in want.description].index(c) for c in columns]
        expected = sorted(tuple(r[i] for i in place) for r in want.fetchall())
        assert sorted(map(tuple, got.select(*columns).collect())) == expected and len(expected) > 3, name
