"""Worked examples, quirks and properties of templates and encoders."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sftprep.functions.templates import (
    FAMILY_TEMPLATE,
    MODEL_FAMILY,
    TEMPLATES,
    ChatTemplate,
    Special,
    get_template,
    register_template,
    render_turns,
    template_for,
    template_name_for_model,
)
from sftprep.operators import encode

from . import plain

X = -100
TOY = ChatTemplate("toy", ("{{system}}",), ("H: {{query}}\nA:",), "S", ("\n",))

GOLDEN = [
    ("chatglm3", [("a", "b"), ("c", "d")], None, 1024,
     [1, 3, 4, 5, 110, 197, 6, 198, 1, 5, 110, 199, 6, 200, 2], [X] * 7 + [198, 2] + [X] * 4 + [200, 2]),
    ("baichuan2", [("a", "b"), ("c", "d")], None, 1024,
     [1, 7, 197, 8, 198, 1, 7, 199, 8, 200, 2], [X] * 4 + [198, 2] + [X] * 3 + [200, 2]),
    ("baichuan2", [("a", "b")], "x", 1024, [1, 220, 7, 197, 8, 198, 2], [X] * 5 + [198, 2]),
    ("baichuan2", [("abcdef", "ghij")], None, 6, [1, 7, 197, 198, 203, 2], [X] * 4 + [203, 2]),
    ("baichuan2", [("ab", "cd"), ("ef", "gh")], None, 9,
     [1, 7, 197, 198, 8, 199, 200, 1, 7], [X] * 5 + [199, 200, 2, X]),
    ("toy", [("a", "b"), ("c", "d")], None, 1024,
     [1, 183, 110, 172, 158, 132, 197, 110, 165, 158, 198, 2, 110, 1, 172, 158, 132, 199, 110, 165, 158, 200, 2],
     [X] * 10 + [198, 2] + [X] * 9 + [200, 2]),
]


def codes(tokenizer):
    return tokenizer.encode_literal


@pytest.mark.parametrize("name,turns,system,cutoff,ids,labels", GOLDEN)
def test_worked_examples(example, tokenizer, name, turns, system, cutoff, ids, labels):
    template = TOY if name == "toy" else TEMPLATES[name]
    row = encode.supervised(example((turns, system)), template, tokenizer, cutoff).first()
    assert (row.input_ids, row.labels) == (ids, labels)
    assert row.attention_mask == [1] * len(ids)


def test_truncation_keeps_the_order_of_float_steps(example, tokenizer):
    # source 15, target 7, cutoff 22: floating point loses one source token
    turns = [("q" * 12, "r" * 7)]  # bos, two reserved tokens and 12 codes make 15
    row = encode.supervised(example((turns, None)), TEMPLATES["baichuan2"], tokenizer, 22).first()
    assert row.labels.count(X) == 14


texts = st.text(alphabet="ab {}idxqueryé问😀\n", min_size=1, max_size=12)
slots = st.sampled_from(["{{idx}}", "x{{idx}}{{idx}}", "{{query}}", "{{system}}"])
conversation = st.lists(st.tuples(texts | slots, texts | slots), min_size=1, max_size=4)


@pytest.mark.parametrize("name", list(TEMPLATES))
def test_every_template_against_plain_python(example, tokenizer, name):
    template = TEMPLATES[name]

    @settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(conversation, st.sampled_from([None, "", "sys {{query}}"])), min_size=15, max_size=15),
           st.sampled_from([8, 25, 1024]))
    def run(conversations, cutoff):
        rows = encode.supervised(example(*conversations), template, tokenizer, cutoff).orderBy("row_idx").collect()
        assert len(rows) == len(conversations)
        for row, (turns, system) in zip(rows, conversations):
            want = plain.supervised(template, tokenizer.special, codes(tokenizer), turns, system, cutoff)
            assert (row.input_ids, row.labels) == want
            assert len(row.input_ids) <= cutoff and len(row.attention_mask) == len(row.input_ids)

    run()


def test_train_on_prompt(example, tokenizer):
    turns = [("a", "b"), ("c", "d")]
    row = encode.supervised(example((turns, None)), TEMPLATES["default"], tokenizer, train_on_prompt=True).first()
    assert row.labels == row.input_ids
    with pytest.raises(ValueError, match="train_on_prompt"):
        encode.supervised(example((turns, None)), TEMPLATES["chatglm3"], tokenizer, train_on_prompt=True)


def test_query_may_hold_the_turn_slot(spark, example, tokenizer):
    # the template has no turn slot of its own: the first one in the query is filled
    ours = register_template("t_idx", [], ["<{{query}}>"], "", [], efficient_eos=True)
    df = example(([("x", "y"), ("n {{idx}} {{idx}}", "z")], None))
    turns = F.concat("history", F.array(F.struct(F.col("prompt").alias("q"), F.col("response").alias("r"))))
    out = df.select(render_turns(ours, tokenizer.special, turns, F.lit("")).alias("t")).first().t
    assert out[1].source == "<bos><n 1 {{idx}}>"
    # chatglm2 has one before the query: the query stays as it is
    out = df.select(render_turns(TEMPLATES["chatglm2"], tokenizer.special, turns, F.lit("")).alias("t")).first().t
    assert "[Round 1]" in out[1].source and "n {{idx}} {{idx}}" in out[1].source
    del TEMPLATES["t_idx"]


def test_history_can_be_switched_off(example, tokenizer):
    t = TEMPLATES["baichuan2"]
    alone = ChatTemplate(t.name, t.prefix, t.prompt, t.system, t.sep, t.stop_words, False, t.efficient_eos)
    row = encode.supervised(example(([("a", "b"), ("c", "d")], None)), alone, tokenizer).first()
    assert row.input_ids == [1, 7, 199, 8, 200, 2]


def test_source_cut_to_nothing(example, tokenizer):
    turns = [("a", "b"), ("c", "d" * 400)]
    out = encode.supervised(example((turns, None)), TEMPLATES["baichuan2"], tokenizer, 60).first()
    want = plain.supervised(TEMPLATES["baichuan2"], tokenizer.special, codes(tokenizer), turns, None, 60)
    assert (out.input_ids, out.labels) == want
    strict = encode.supervised(example((turns, None)), TEMPLATES["baichuan2"], tokenizer, 60, strict_align=True).first()
    assert len(strict.labels) == len(strict.input_ids)


def test_validity(spark, tokenizer):
    rows = [(0, "p", "", "r"), (1, "", "", "r"), (2, "", "q", "r"), (3, "p", None, None), (4, "p", "q", ""), (5, None, None, "r")]
    df = spark.createDataFrame(rows, "row_idx bigint, prompt string, query string, response string")
    assert sorted(r.row_idx for r in encode.valid_for_sft(df).collect()) == [0, 2]
    assert sorted(r.row_idx for r in encode.valid_for_predict(df).collect()) == [0, 2, 3, 4]
    with pytest.raises(ValueError, match="no response"):
        encode.valid_for_sft(df.drop("response"))


def test_predict_form(example, tokenizer):
    df = example(([("a", "b"), ("c", "de")], None))
    row = encode.predict(df, TEMPLATES["chatglm3"], tokenizer).first()
    assert row.input_ids == [1, 3, 4, 5, 110, 197, 6, 198, 1, 5, 110, 199, 6]
    assert row.labels == [200, 201, 2]
    row = encode.predict(df, TEMPLATES["chatglm3"], tokenizer, 2).first()
    assert (row.input_ids, row.labels) == ([1, 3], [200, 201])


def test_null_response_in_predict_form(spark, example, tokenizer):
    df = example(([("a", None)], None))
    with pytest.raises(Exception, match="null text"):
        encode.predict(df, TEMPLATES["chatglm3"], tokenizer).collect()
    row = encode.predict(df, TEMPLATES["chatglm3"], tokenizer, null_response="empty").first()
    assert row.labels == [2]


def test_pairwise_form(spark, tokenizer):
    rows = [(0, "ab", ["c", "defg"]), (1, "ab", ["c"]), (2, "", ["c", "d"]), (3, "ab", None)]
    df = spark.createDataFrame(rows, "row_idx bigint, prompt string, responses array<string>")
    out = encode.pairwise(df, TEMPLATES["baichuan2"], tokenizer, 1024).collect()
    assert [r.row_idx for r in out] == [0]
    assert out[0].prompt_ids == [1, 7, 197, 198, 8]
    assert (out[0].chosen_ids, out[0].rejected_ids) == ([199, 2], [200, 201, 202, 203, 2])
    cut = encode.pairwise(df, TEMPLATES["baichuan2"], tokenizer, 4).first()
    assert (len(cut.prompt_ids), len(cut.chosen_ids), len(cut.rejected_ids)) == (2, 2, 2)
    default = encode.pairwise(df, TEMPLATES["default"], tokenizer, 1024).first()
    assert default.chosen_ids == [199, 2] and default.rejected_ids[-1] == 2
    # ranked rows never reach supervised training, and cannot be predicted
    assert encode.valid_for_sft(df).count() == 0
    with pytest.raises(ValueError, match="one text per row"):
        encode.predict(df, TEMPLATES["baichuan2"], tokenizer)


def test_registry(tokenizer):
    assert list(TEMPLATES) == ["default", "llama2", "llama2_zh", "baichuan", "baichuan2", "chatglm2", "chatglm3"]
    assert len(MODEL_FAMILY) == 21 and set(MODEL_FAMILY.values()) == set(FAMILY_TEMPLATE)
    assert template_name_for_model("ChatGLM3-6B-Base") == "chatglm2"
    with pytest.raises(KeyError):
        template_name_for_model("nobody")
    with pytest.raises(AssertionError, match="does not exist"):
        get_template("nobody")
    assert template_for(None, tokenizer)[0] is None
    made = register_template("my_llama2", ["{{system}}|"], [{"token": "sop"}, "{{query}}"], "s", [])
    assert made.system_in_query and made.prompt[0] == Special("sop")
    del TEMPLATES["my_llama2"]
    with pytest.raises(ValueError, match="strings or token names"):
        register_template("bad", [3], [], "", [])


def test_template_needs_eos(tokenizer):
    from dataclasses import replace

    bare = replace(tokenizer, special=replace(tokenizer.special, eos_token=None))
    with pytest.raises(ValueError, match="EOS"):
        encode.assemble_turns(TEMPLATES["default"], bare, F.col("x"), F.col("y"))
