import pytest
from pyspark.sql import functions as F

from sftprep.functions.templates import TEMPLATES, ChatTemplate
from sftprep.operators import encode, normalize, turns

TALKS = {
    0: [("user", "a"), ("assistant", "b")],
    1: [("user", "a"), ("assistant", "b"), ("user", "c")],
    2: [("user", "a")],
    3: [("human", f"q{i}") if i % 2 == 0 else ("gpt", f"r{i}") for i in range(14)],
    4: [("system", "s"), ("user", "u")],
    5: [("system", "s"), ("user", "u"), ("assistant", "a"), ("user", "u")],
    6: [("user", f"q{i}") if i % 2 == 0 else ("assistant" if i < 9 else "tool", f"r{i}") for i in range(12)],
    7: [("user", f"q{i}") if i % 2 == 0 else ("assistant", f"r{i}") for i in range(9)],
}


def expected_pairs():
    good = {}
    for c, ms in TALKS.items():
        ms = ms[: len(ms) // 2 * 2]
        pairs = list(zip(ms[::2], ms[1::2]))
        if pairs and all((u[0], a[0]) == (pairs[0][0][0], pairs[0][1][0]) for u, a in pairs):
            good[c] = [(u[1], a[1]) for u, a in pairs]
    return good


@pytest.mark.parametrize("width", [1, 2, 3, 7, 4096])
def test_pairs_do_not_depend_on_the_chunk_width(turn_table, width):
    chunks = turns.conversation_chunks(turn_table(TALKS).repartition(3), width=width, on_bad_order="drop")
    got = {}
    for r in turns.pair_rows(chunks).orderBy("conv_id", "idx").collect():
        got.setdefault(r.conv_id, []).append((r.query, r.response))
        assert r.n_pairs == len(expected_pairs()[r.conv_id]) and r.idx == len(got[r.conv_id]) - 1
    assert got == expected_pairs()


def test_known_length_keeps_the_plan_small(spark, turn_table):
    table = turn_table(TALKS)
    longest = turns.longest_turn(table)
    assert longest == 13
    plain = {width: turns.conversation_parts(table, width=width, on_bad_order="drop", longest=longest) for width in (7, 8)}
    assert plain[7][1] is not None and plain[8][1] is None
    every = turns.conversation_chunks(table, on_bad_order="drop")
    assert sorted(plain[8][0].collect()) == sorted(every.collect())
    gaps = spark.createDataFrame([(0, 0, "u", "x"), (0, None, "u", "x")], "conv_id int, turn int, role string, text string")
    assert turns.longest_turn(gaps) is None and turns.longest_turn(gaps.limit(0)) is None
    with pytest.raises(Exception, match="gaps or repeats"):
        turns.conversation_chunks(gaps.na.fill({"turn": 0}), longest=0).collect()


@pytest.mark.parametrize("width", [1, 3, 4096])
def test_order_policies(turn_table, width):
    table = turn_table(TALKS)
    with pytest.raises(Exception, match="u/a/u/a"):
        turns.conversation_chunks(table, width=width).collect()
    good, bad = normalize.quarantined(turns.conversation_chunks(table, width=width, on_bad_order="quarantine"))
    assert {r.conv_id for r in bad.collect()} == {5, 6}
    assert {r.conv_id for r in good.collect()} == set(expected_pairs())
    # the check holds even if nobody reads a single column
    with pytest.raises(Exception, match="u/a/u/a"):
        turns.conversation_chunks(table, width=width).count()
    with pytest.raises(ValueError, match="on_bad_order"):
        turns.conversation_chunks(table, on_bad_order="ignore")


def test_role_report(turn_table):
    got = {r.conv_id: (r.n_pairs, r.order_ok) for r in turns.role_order_report(turn_table(TALKS)).collect()}
    assert got == {0: (1, True), 1: (1, True), 3: (7, True), 4: (1, True), 5: (2, False), 6: (6, False), 7: (4, True)}


@pytest.mark.parametrize("rows", [[0, 2], [1, 2], [0, 1, 1, 2], [0, 1, 2, 3, 5, 6], [4, 5], [1], [2], [0, 2, 3], [0, 1, 4, 5]])
def test_gaps_and_repeats_raise(spark, rows):
    df = spark.createDataFrame([(0, t, "user", "x") for t in rows], "conv_id bigint, turn bigint, role string, text string")
    for width in (1, 2, 4096):
        with pytest.raises(Exception, match="gaps or repeats"):
            turns.pair_rows(turns.conversation_chunks(df, width=width, on_bad_order="quarantine")).collect()


@pytest.mark.parametrize("name", ["chatglm3", "default", "chatglm2", "llama2", "baichuan"])
def test_shortened_history_encodes_alike(turn_table, tokenizer, name):
    talks = {c: TALKS[c] for c in (0, 1, 3, 7)}
    template, cutoff = TEMPLATES[name], 4
    encode.check_shortened(template, tokenizer, cutoff, width=4)
    views = []
    for width in (4, 4096):
        examples = turns.examples_from_turns(turns.conversation_chunks(turn_table(talks), width=width))
        views.append(
            [
                sorted(map(tuple, f(examples, template, tokenizer, cutoff, keep=("conv_id",)).collect()))
                for f in (encode.supervised, encode.predict)
            ]
        )
    assert views[0] == views[1]


def test_shortened_history_has_limits(tokenizer):
    with pytest.raises(ValueError, match="cutoff_len"):
        encode.check_shortened(TEMPLATES["chatglm3"], tokenizer, 5000)
    from dataclasses import replace

    silent = ChatTemplate("s", (), ("{{query}}",), "", efficient_eos=True)
    unopened = replace(tokenizer, special=replace(tokenizer.special, bos_token=None))
    with pytest.raises(ValueError, match="emit nothing"):
        encode.check_shortened(silent, unopened, 100)


@pytest.mark.parametrize("name", ["chatglm3", "default"])
@pytest.mark.parametrize("cutoff", [9, 5000])
def test_long_conversations_encode_like_short_ones(turn_table, tokenizer, name, cutoff):
    """Chunks of two pairs give what one chunk gives, whatever the cutoff."""
    talks = {c: TALKS[c] for c in (0, 1, 3, 7)}
    talks[11] = TALKS[3][:12] + [("human", "last"), ("gpt", "")]  # no answer to train on
    views = []
    for width in (2, 4096):
        parts = turns.conversation_parts(turn_table(talks), width=width)
        views.append(
            [
                sorted(map(tuple, rows.collect()))
                for rows in (
                    encode.supervised_conversations(parts, TEMPLATES[name], tokenizer, cutoff),
                    encode.predict_conversations(parts, TEMPLATES[name], tokenizer, cutoff),
                )
            ]
        )
    assert views[0] == views[1] and [len(v) for v in views[0]] == [4, 5]


def test_templates_that_emit_nothing(turn_table, tokenizer):
    from dataclasses import replace

    silent = ChatTemplate("s", (), ("{{query}}",), "", efficient_eos=True)
    unopened = replace(tokenizer, special=replace(tokenizer.special, bos_token=None))
    for f, until in ((encode.supervised_conversations, 0), (encode.predict_conversations, 9)):
        talk = [("u" if i % 2 == 0 else "a", "" if i < until else f"t{i}") for i in range(14)]
        for cutoff in (3, 8):
            got = [
                sorted(map(tuple, f(turns.conversation_parts(turn_table({1: talk}), width=w), silent, unopened, cutoff).collect()))
                for w in (2, 4096)
            ]
            assert got[0] == got[1] and len(got[0]) == 1


def test_message_arrays(spark):
    rows = [(c, [{"from": r, "value": t} for r, t in ms]) for c, ms in TALKS.items()] + [(9, []), (10, None)]
    df = spark.createDataFrame(rows, "id bigint, conversations array<struct<`from`:string,value:string>>")
    out = normalize.examples_from_messages(df, on_bad_order="drop", keep=("id",))
    got = {r.id: [(h.q, h.r) for h in r.history] + [(r.prompt, r.response)] for r in out.collect()}
    assert got == expected_pairs()
    assert {r["query"] for r in out.collect()} == {""}
    with pytest.raises(Exception, match="u/a/u/a"):
        normalize.examples_from_messages(df).count()
    _, bad = normalize.quarantined(normalize.examples_from_messages(df, on_bad_order="quarantine", keep=("id",)))
    assert {r.id for r in bad.collect()} == {5, 6}


def test_rename(spark):
    df = spark.createDataFrame([("i", "o", "h", 1)], "instruction string, output string, system string, extra int")
    out = normalize.rename_columns(df, {"prompt": "instruction", "response": "output", "query": None})
    assert out.columns == ["prompt", "response", "system"]
    with pytest.raises(ValueError, match="not among"):
        normalize.rename_columns(df, {"prompt": "instruction", "query": "input"})


def test_full_query_and_system(spark):
    df = spark.createDataFrame([("p", "q"), ("p", ""), ("p", None)], "prompt string, query string")
    assert [r[0] for r in df.select(normalize.full_query(df)).collect()] == ["p\nq", "p", "p"]
    assert normalize.spread_system_prompts("a|b", 4) == ["a", "b", "a", "b"]
    assert normalize.spread_system_prompts(None, 2) == [None, None]
    with pytest.raises(AssertionError):
        normalize.spread_system_prompts("a|b", 3)
    assert normalize.with_system(df, "").columns == df.columns
    assert normalize.with_system(df, "x").select(F.first("system")).first()[0] == "x"
