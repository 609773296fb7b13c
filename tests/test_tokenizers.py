import base64

import pytest
from pyspark.sql import functions as F

from sftprep.functions.slots import fill, replace_first
from sftprep.functions.templates import TEMPLATES, template_for
from sftprep.functions.tokenizers import CallableTokenizer, CodepointTokenizer, SpecialTokens, tidy_spacing
from sftprep.operators import encode, vocab

from . import plain

TEXTS = ["", "abc", "é问题", "😀 a\n\tb", "  ", "x" * 3000]


def test_codepoints_both_ways(spark, tokenizer):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    out = df.select("t", tokenizer.encode(F.col("t")).alias("ids")).withColumn("back", tokenizer.decode(F.col("ids")))
    for row in out.collect():
        assert row.ids == [ord(c) + 100 for c in row.t]
        assert row.back == row.t


def test_special_tokens_in_decoding(spark, tokenizer):
    df = spark.createDataFrame([([1, 197, 2, 0, 5],)], "ids array<int>")
    row = df.select(
        tokenizer.decode(F.col("ids")).alias("full"), tokenizer.decode(F.col("ids"), True).alias("plain")
    ).first()
    assert (row.full, row["plain"]) == ("<bos>a<eos><pad><|user|>", "a")


def test_completion():
    bare = CodepointTokenizer(SpecialTokens({"a": 0}))
    done = bare.completed(["<stop>", "a"])
    assert done.special.eos_token == done.special.pad_token == "<|endoftext|>"
    assert done.special.ids == {"a": 0, "<|endoftext|>": 1, "<stop>": 2}
    with pytest.raises(KeyError):
        done.special.special_id("none")
    template, used = template_for("chatglm3", bare)
    assert {"<|user|>", "<|observation|>"} <= set(used.special.ids)


def test_slots(spark):
    df = spark.createDataFrame([("a{{idx}}b{{idx}}", "7")], "q string, i string")
    got = df.select(
        replace_first(F.col("q"), "{{idx}}", F.col("i")).alias("a"),
        fill("<{{query}}|{{idx}}>", query=F.col("q"), idx=F.col("i")).alias("b"),
        fill("{{idx}}:{{query}}", query=F.col("q"), idx=F.col("i")).alias("c"),
        fill("{{query}}{{query}}", query=F.lit("z")).alias("d"),
        fill("plain", system=F.lit("s"), query=F.lit("q")).alias("e"),
    ).first()
    assert tuple(got) == ("a7b{{idx}}", "<a7b{{idx}}|{{idx}}>", "7:a{{idx}}b{{idx}}", "z{{query}}", "plain")


def test_tidy_spacing(spark):
    df = spark.createDataFrame([("I do n't know , it 's fine . Is it ?",)], "t string")
    assert df.select(tidy_spacing(F.col("t")).alias("t")).first().t == "I don't know, it's fine. Is it?"


def bpe():
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def make_encoder():
    return bpe().encode_ordinary


def make_decoder():
    return bpe().decode


def test_subword_tokenizer_plugs_in(spark, example):
    pytest.importorskip("tiktoken")
    pytest.importorskip("public_tokenizers")
    special = SpecialTokens({"<eos>": 50256, "<bos>": 50257}, "<bos>", "<eos>")
    tokenizer = CallableTokenizer(make_encoder, special, make_decoder, first_free_id=50258)
    template, tokenizer = template_for("default", tokenizer)
    turns = [("hello there", "general remarks"), ("and 问?", "fine, thanks")]
    row = encode.supervised(example((turns, None)), template, tokenizer, 50).first()
    assert (row.input_ids, row.labels) == plain.supervised(template, special, make_encoder(), turns, None, 50)
    out = example((turns, None)).select(tokenizer.encode(F.col("response")).alias("ids"))
    back = out.select(tokenizer.decode(F.concat(F.array(F.lit(50257)), "ids")).alias("t")).first().t
    assert back == "<bos>fine, thanks"
    template, extended = template_for("chatglm3", tokenizer)
    assert extended.special.ids["<|user|>"] == 50258


def test_vocabulary(spark, monkeypatch):
    docs = spark.createDataFrame([(0, "b a  b c"), (1, "b a"), (2, ""), (3, "  ")], "id bigint, text string")
    table = vocab.build_vocabulary(docs)
    assert sorted((r.token_id, r.token, r.n) for r in table.collect()) == [(0, "b", 3), (1, "a", 2), (2, "c", 1)]
    for hot in (10_000, 1):
        monkeypatch.setattr(vocab, "HOT_TOKENS", hot)
        other = docs.unionByName(spark.createDataFrame([(4, "zz b")], "id bigint, text string"))
        ids = vocab.encode_with_vocabulary(other, table, "id")
        got = {r.id: r.input_ids for r in ids.collect()}
        assert got == {0: [0, 1, 0, 2], 1: [0, 1], 2: [], 3: [], 4: [-1, 0]}
        back = vocab.decode_with_vocabulary(ids.filter("id < 4"), table, "id")
        assert {r.id: r.text for r in back.collect()} == {0: "b a b c", 1: "b a", 2: "", 3: ""}
    with pytest.raises(Exception, match="not in the vocabulary"):
        vocab.decode_with_vocabulary(ids, table, "id").collect()


def test_a_batch_holds_ids_in_four_bytes(spark):
    """Ids of the texts before are not Python objects any more when a text is encoded; nulls, empty texts and ids stay."""

    def make_encoder():
        import gc

        class Id(int):
            pass

        def encode(text):
            alive = sum(isinstance(x, Id) for kept in gc.get_objects() if type(kept) is list for x in kept)
            return [Id(alive), *(Id(ord(c)) for c in text)]

        return encode

    units = [["ab", "", None], None, [], ["é"], [None], ["x", "yz"]]
    rows = spark.createDataFrame([(n, u) for n, u in enumerate(units)], "n int, u array<string>").coalesce(1)
    got = [r[1] for r in rows.select("n", CallableTokenizer(make_encoder, SpecialTokens()).encode_units(F.col("u"))).orderBy("n").collect()]
    assert got == [[[0, 97, 98], [], None], None, [], [[0, 233]], [None], [[0, 120], [0, 121, 122]]]
    none = rows.filter("n = 1").select(CallableTokenizer(make_encoder, SpecialTokens()).encode_units(F.col("u")))
    assert none.first()[0] is None


def test_settled_tokens_of_dealt_rows_are_not_shuffled(spark, monkeypatch):
    """Decoding a table that is dealt out by its key shuffles rare ids alone, and encoding gathers plain numbers."""
    monkeypatch.setattr(vocab, "HOT_TOKENS", 2)
    text = [(1, "a b a c"), (2, ""), (3, None), (None, "b zz a"), (4, "c c d"), (1, "d a")]
    docs = spark.createDataFrame(text, "id long, text string")
    table = vocab.build_vocabulary(docs)
    ids = vocab.encode_with_vocabulary(docs, table, "id", unknown_id=-7)
    names = {r["token_id"]: r["token"] for r in table.collect()}
    number = {t: i for i, t in names.items()}
    got = {r["id"]: r["input_ids"] for r in ids.collect()}
    twice = sorted((p, number[t]) for s in ("a b a c", "d a") for p, t in enumerate(s.split()))
    assert got == {1: [i for _, i in twice], 2: [], 3: [], 4: [number[t] for t in "ccd"], None: [number[t] for t in ("b", "zz", "a")]}
    few = vocab.encode_with_vocabulary(docs, table.filter("token != 'zz'"), "id", unknown_id=-7)
    assert {r["id"]: r["input_ids"] for r in few.collect()}[None] == [number["b"], -7, number["a"]]
    back = vocab.decode_with_vocabulary(ids, table, "id")
    assert {r["id"]: r["text"] for r in back.collect()}[None] == "b zz a"

    def plan(df):  # of a frame that has not run
        return df.select("*")._jdf.queryExecution().executedPlan().toString()

    assert "collect_list(struct" not in plan(ids) and "collect_list(CASE" not in plan(ids)
    assert "Exchange" not in plan(ids).split("Union")[0] and "Exchange" not in plan(back).split("Union")[0]
    # by the key: the two parts of the encoded rows, read by the near and the far branch; settled ids are not dealt again
    dealt = [plan(df).count("Exchange hashpartitioning(id#") for df in (ids, back)]
    assert dealt == [2, 4]  # the few rare words come by broadcast here
