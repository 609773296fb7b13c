import random

import pytest
from pyspark.sql import functions as F

from sftprep.functions.templates import TEMPLATES
from sftprep.operators import encode, metrics, turns
from sftprep.operators.batching import assign_batches, pad_batches
from sftprep.operators.lookup import with_template_name
from sftprep.operators.packing import pack_blocks

from . import plain

TALKS = {
    c: [("user", f"q{c}." * (c % 4 + 1)) if i % 2 == 0 else ("assistant", f"r{i}") for i in range(2 * (c % 6 + 1))]
    for c in range(30)
}


@pytest.mark.parametrize("name", ["chatglm3", "default"])
@pytest.mark.parametrize("width,bounded", [(4096, True), (2, False), (1, False)])
@pytest.mark.parametrize("block", [7, 32])
def test_packing(turn_table, tokenizer, name, width, bounded, block):
    template = TEMPLATES[name]
    chunks = turns.index_conversations(
        turns.conversation_chunks(turn_table(TALKS).repartition(5), width=width), width=width
    )
    pieces = encode.training_pieces(
        chunks, template, tokenizer, F.col("pairs"), keep=("row_idx", "chunk"), first_idx=F.col("first_idx")
    )
    eos = tokenizer.special.eos_id if template.efficient_eos else None
    blocks = pack_blocks(pieces, block, eos, 8, ("row_idx", "chunk"), bounded)
    got = sorted((r.pack_group, r.block, r.input_ids, r.labels) for r in blocks.collect())
    rows = [(c, [(ms[i][1], ms[i + 1][1]) for i in range(0, len(ms), 2)]) for c, ms in TALKS.items()]
    assert got == plain.packed(rows, template, tokenizer.special, tokenizer.encode_literal, block, 8)


def test_final_eos_completes_a_block(spark):
    df = spark.createDataFrame([(0, [5, 6], [5, 6]), (1, [7], [7]), (2, [], [])], "row_idx bigint, ids array<int>, labels array<int>")
    rows = pack_blocks(df, 4, eos_id=2).collect()
    assert [(r.input_ids, r.labels, r.attention_mask) for r in rows] == [([5, 6, 7, 2], [5, 6, 7, 2], [1] * 4)]
    assert pack_blocks(df, 4).count() == 0
    with pytest.raises(ValueError):
        pack_blocks(df, 1)


def batch(spark, *rows):
    data = [(i, r, [1] * len(r), [-100] + r[1:]) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, "row_idx bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    )


def test_right_padding(spark):
    rows = pad_batches(assign_batches(batch(spark, [1, 2, 3], [1], [1, 2, 3, 4, 5]), 2), 0).orderBy("row_idx").collect()
    assert [r.input_ids for r in rows] == [[1, 2, 3, 0], [1, 0, 0, 0], [1, 2, 3, 4, 5, 0, 0, 0]]
    assert [r.attention_mask for r in rows][1] == [1, 0, 0, 0]
    assert [r.labels for r in rows][:2] == [[-100, 2, 3, -100], [-100] * 4]
    seen = pad_batches(assign_batches(batch(spark, [1, 2, 3]), 2), 9, ignore_pad_token_for_loss=False).first()
    assert seen.labels == [-100, 2, 3, 9]


def test_left_padding(spark):
    rows = pad_batches(assign_batches(batch(spark, [1, 2, 3], [4]), 2), 0, "left").orderBy("row_idx").collect()
    assert [r.input_ids for r in rows] == [[1, 2, 3], [0, 0, 4]]
    with pytest.raises(ValueError):
        pad_batches(batch(spark, [1]), 0, "middle")


REFERENCES, PREDICTIONS = [0, 1, 2, 0, 1, 2], [0, 1, 1, 2, 1, 0]
WEIGHTS = [0.5, 2, 0.7, 0.5, 9, 0.4]


def test_accuracy(spark):
    df = spark.createDataFrame(
        list(zip(PREDICTIONS, REFERENCES, map(float, WEIGHTS))), "predictions int, references int, w double"
    )
    assert metrics.accuracy(df).first()[0] == 0.5
    assert metrics.accuracy(df, normalize=False).first()[0] == 3.0
    assert round(metrics.accuracy(df, weight="w").first()[0], 12) == round(0.8778625954198473, 12)
    assert metrics.accuracy(df, normalize=False, weight="w").first()[0] == 11.5
    many = spark.createDataFrame([([1, 0], [1, 0]), ([1, 1], [1, 0])], "predictions array<int>, references array<int>")
    assert metrics.accuracy(many).first()[0] == 0.5
    assert metrics.accuracy(df.filter("false")).first()[0] is None


def test_token_accuracy(spark):
    rng = random.Random(3)
    rows = []
    for n in (0, 1, 2, 5, 9):
        labels = [rng.choice([-100, 1, 2]) for _ in range(n)]
        rows.append(([rng.choice([-100, 1, 2]) for _ in range(n)], labels))
    df = spark.createDataFrame(rows, "preds array<int>, labels array<int>")
    for ignored in (None, -100):
        pairs = [(y, p) for ps, ys in rows for y, p in zip(ys[1:], ps[:-1]) if y != ignored]
        want = sum(y == p for y, p in pairs) / len(pairs)
        assert metrics.shifted_token_accuracy(df, ignore_index=ignored).first()[0] == want


def test_argmax_blanking_and_records(spark, tokenizer):
    df = spark.createDataFrame([([0.5, 2.0, 2.0, -1.0],)], "x array<double>")
    assert df.select(metrics.argmax(F.col("x"))).first()[0] == 1
    rows = [([197, 198, 199, 2], [-100, 197, 132, 146, 2])]  # "a", " ", "."
    df = spark.createDataFrame(rows, "preds array<int>, labels array<int>")
    df = df.withColumn("preds", metrics.blank_prompt(F.col("preds"), F.lit(1), 0))
    row = metrics.prediction_records(df, tokenizer).first()
    assert (row.label, row.predict) == ("a.", "bc")
    assert metrics.prediction_records(df, tokenizer, tidy=False).first().label == "a ."


def test_model_lookup(spark):
    df = spark.createDataFrame([("ChatGLM3-6B-Chat",), ("LLaMA2-7B-Base",)], "model string")
    assert {r.template for r in with_template_name(df).collect()} == {"chatglm3", "llama2"}
    with pytest.raises(Exception, match="unknown model"):
        with_template_name(spark.createDataFrame([("x",)], "model string")).collect()
