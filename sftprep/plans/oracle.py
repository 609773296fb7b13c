"""The same results in plain SQL over the same tables, for checking with DuckDB."""

from __future__ import annotations

from ..functions.templates import (
    DEFAULT_SYSTEM,
    FAMILY_TEMPLATE,
    LLAMA2_SYSTEM,
    LLAMA2_ZH_SYSTEM,
    MODEL_FAMILY,
)
from ..functions.tokenizers import SPACING_FIXES
from . import catalog as C

ORACLES: dict[str, str] = {}


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


# -- conversations ----------------------------------------------------------------

# every whole pair of the conversations whose roles alternate
PAIRS = """
whole as (
  select u.conv_id, u.turn // 2 as idx, u.role as ur, a.role as ar, u.text as q, a.text as r
  from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1
  where u.turn % 2 = 0),
good as (
  select conv_id, count(*) as n_pairs from whole group by conv_id
  having min(ur) = max(ur) and min(ar) = max(ar)),
pairs as (select w.conv_id, w.idx, w.q, w.r, g.n_pairs from whole w join good g on g.conv_id = w.conv_id)
"""

ORACLES["sharegpt_pairs"] = f"with {PAIRS} select conv_id, idx, n_pairs, q as query, r as response from pairs"

ORACLES["role_order_report"] = f"""
with {PAIRS}
select conv_id, count(*) as n_pairs, min(ur) = max(ur) and min(ar) = max(ar) as order_ok
from whole group by conv_id"""

ORACLES["sharegpt_arrays"] = f"""
with {PAIRS}
select conv_id as chat_id, q as prompt, r as response, n_pairs - 1 as n_history from pairs where idx = n_pairs - 1"""

ORACLES["read_sharegpt"] = f"""
with {PAIRS} select q as prompt, r as response, n_pairs - 1 as n_history from pairs where idx = n_pairs - 1"""

ORACLES["system_prompt"] = f"""
with {PAIRS}
select conv_id, case when conv_id % 3 = 2 then 'Be brief.' else {text(DEFAULT_SYSTEM)} end as system,
       n_pairs as n_turns
from good"""

# -- documents as examples --------------------------------------------------------

ORACLES["alpaca_rename"] = "select doc_id, source as prompt, text as response from documents"

ORACLES["query_assembly"] = """
select doc_id, case when lang = 'en' and text <> '' then source || chr(10) || text else source end as full_query
from documents"""

ORACLES["max_samples"] = f"""
select doc_id, n_chars, row_number() over (order by doc_id) - 1 as row_idx
from documents qualify row_number() over (order by doc_id) <= {C.MAX_SAMPLES}"""

MARKED = """
marked as (
  select doc_id, case when n_chars % 5 = 0 then '' else text end as prompt,
         case when n_chars % 3 = 0 then '' when n_chars % 3 = 1 then text end as response
  from documents)
"""
ORACLES["valid_sft"] = f"with {MARKED} select doc_id from marked where prompt <> '' and response <> ''"
ORACLES["valid_predict"] = f"with {MARKED} select doc_id from marked where prompt <> ''"

RANKED = """
ranked as (
  select doc_id // 2 as pair_id, 'Write in ' || min(lang) as prompt, list(text order by doc_id) as answers
  from documents group by doc_id // 2, lang)
"""
ORACLES["valid_pairwise"] = f"with {RANKED} select pair_id, prompt from ranked where len(answers) > 1"

# -- mixing -----------------------------------------------------------------------

SOURCES = f"""
src as (
  select list_position([{", ".join(text(x) for x in C.LANGUAGES)}], lang) - 1 as source_no, doc_id,
         row_number() over (partition by lang order by doc_id) - 1 as row_idx
  from documents),
size as (select source_no, count(*) as n from src group by source_no)
"""
K = len(C.LANGUAGES)

ORACLES["mix_concat"] = f"""
with {SOURCES}
select row_number() over (order by source_no, row_idx) - 1 as mix_idx, source_no::int as source_no, doc_id from src"""

ORACLES["interleave_under"] = f"""
with {SOURCES}
select row_idx * {K} + source_no as mix_idx, source_no::int as source_no, doc_id from src
where row_idx < (select min(n) from size)"""

ORACLES["interleave_over"] = f"""
with {SOURCES},
slots as (select s.source_no, s.n, t.slot from size s, (select unnest(range((select max(n) from size))) as slot) t)
select slot * {K} + slots.source_no as mix_idx, slots.source_no::int as source_no, src.doc_id
from slots join src on src.source_no = slots.source_no and src.row_idx = slots.slot % slots.n"""


def _weighted(over: bool) -> str:
    bounds, total = [], 0.0
    for share in C.SHARES[:-1]:
        total += share
        bounds.append(total)
    source = " ".join(f"when u < {b!r} then {i}" for i, b in enumerate(bounds))
    end, pick = ("max", "draw % n") if over else ("min", "draw")
    return f"""
with {SOURCES},
draws as (
  select slot, ('0x' || substr(md5('{C.SEED}:' || slot), 1, 8))::bigint / 4294967296 as u
  from (select unnest(range((select count(*) * 20 from documents))) as slot)),
chosen as (select slot, case {source} else {K - 1} end as source_no from draws),
numbered as (
  select slot, c.source_no, row_number() over (partition by c.source_no order by slot) - 1 as draw, n
  from chosen c join size on size.source_no = c.source_no),
halt as (select {end}(slot) as last_slot from numbered where draw = n - 1)
select slot as mix_idx, numbered.source_no::int as source_no, src.doc_id
from numbered join src on src.source_no = numbered.source_no and src.row_idx = {pick}
where slot <= (select last_slot from halt)"""


ORACLES["interleave_weighted_under"] = _weighted(False)
ORACLES["interleave_weighted_over"] = _weighted(True)

# -- templates --------------------------------------------------------------------

_models = ", ".join(f"({i}, {text(m)}, {text(FAMILY_TEMPLATE[f])})" for i, (m, f) in enumerate(MODEL_FAMILY.items()))
ORACLES["model_template_lookup"] = f"""
select p_partkey, m.model, m.template
from part join (values {_models}) as m(no, model, template) on m.no = p_partkey % {len(MODEL_FAMILY)}"""

NL = "chr(10)"
# name -> (text before turn 0, text before later turns, text before the query, after it, end of a response)
_block = "'<<SYS>>' || {nl} || {sys} || {nl} || '<</SYS>>' || {nl} || {nl}"
SPELLED = {
    "default": (f"'<bos>' || {text(DEFAULT_SYSTEM)} || {NL}", f"{NL} || '<bos>'", "'Human: '", f"{NL} || 'Assistant:'", "'<eos>'"),
    "llama2": (
        "'<bos>[INST] ' || " + _block.format(nl=NL, sys=text(LLAMA2_SYSTEM)), "'<bos>[INST] '", "''", "' [/INST]'", "'<eos>'",
    ),
    "llama2_zh": (
        "'<bos>[INST] ' || " + _block.format(nl=NL, sys=text(LLAMA2_ZH_SYSTEM)), "'<bos>[INST] '", "''", "' [/INST]'", "'<eos>'",
    ),
    "baichuan": ("'<bos>'", "'<bos>'", "'<reserved_102>'", "'<reserved_103>'", "''"),
    "baichuan2": ("'<bos>'", "'<bos>'", "'<reserved_106>'", "'<reserved_107>'", "''"),
    "chatglm2": (
        f"'<bos>[gMASK]sop' || {NL} || {NL}", f"{NL} || {NL} || '<bos>'",
        f"'[Round ' || idx || ']' || {NL} || {NL} || '问：'", f"{NL} || {NL} || '答：'", "''",
    ),
    "chatglm3": ("'<bos>[gMASK]sop'", "'<bos>'", f"'<|user|>' || {NL}", "'<|assistant|>'", "''"),
}
for _name, (_open, _next, _before, _after, _end) in SPELLED.items():
    ORACLES[f"render_{_name}"] = f"""
with {PAIRS}
select conv_id, idx, case when idx = 0 then {_open} else {_next} end || {_before} || q || {_after} as source,
       r || {_end} as target
from pairs"""

# -- tokens -----------------------------------------------------------------------


def codes(expression: str) -> str:
    return (
        f"list_transform(list_filter(string_split({expression}, ''), lambda c: c <> ''), "
        f"lambda c: unicode(c)::int + {C.TOKENIZER.offset})"
    )


def joined(ids: str, name: str) -> str:
    return f"coalesce(array_to_string({ids}, ','), '') as {name}"


def ids(*numbers: int) -> str:
    return f"[{', '.join(map(str, numbers))}]::int[]"


def minus_100(n: str) -> str:
    return f"list_transform(range({n}), lambda z: -100)"


ORACLES["tokenize_codepoint"] = f"""
select conv_id, turn, length(text) as n_tokens, {joined(codes('text'), 'ids')} from conversations"""

_byte = f"('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::int + {C.TOKENIZER.offset}"
ORACLES["tokenize_callable"] = f"""
select conv_id, turn, octet_length(encode(text)) as n_tokens,
       {joined(f'list_transform(range(octet_length(encode(text))), lambda i: {_byte})', 'ids')}
from conversations"""

ORACLES["decode_roundtrip"] = "select conv_id, turn, text from conversations"

VOCABULARY = """
words as (
  select doc_id, pos, token
  from (select doc_id, unnest(string_split(text, ' ')) as token, generate_subscripts(string_split(text, ' '), 1) as pos
        from documents)
  where token <> ''),
vocabulary as (
  select token, count(*) as n, row_number() over (order by count(*) desc, token) - 1 as token_id
  from words group by token)
"""
ORACLES["vocab_build"] = f"with {VOCABULARY} select token, n, token_id from vocabulary"
ORACLES["vocab_encode"] = f"""
with {VOCABULARY},
coded as (
  select doc_id, count(*) as n, string_agg(token_id::varchar, ',' order by pos) as input_ids
  from words join vocabulary using (token) group by doc_id)
select doc_id, coalesce(n, 0) as n_tokens, coalesce(input_ids, '') as input_ids
from documents left join coded using (doc_id)"""
ORACLES["vocab_decode"] = f"""
with {VOCABULARY}
select doc_id, coalesce(t.text, '') as text
from documents left join (select doc_id, string_agg(token, ' ' order by pos) as text from words group by doc_id) t
  using (doc_id)"""

S = C.SPECIAL_IDS
EOS = S["<eos>"]
_default_prompt = f"'Human: ' || q || {NL} || 'Assistant:'"
_llama_block = _block.format(nl=NL, sys=text(LLAMA2_SYSTEM))
# name -> (source ids, target ids, one eos at the end only)
TOKENS = {
    "chatglm3": (
        f"case when idx = 0 then {ids(S['<bos>'], S['[gMASK]'], S['sop'])} else {ids(S['<bos>'])} end "
        f"|| {ids(S['<|user|>'])} || {codes(NL)} || {codes('q')} || {ids(S['<|assistant|>'])}",
        codes("r"),
        True,
    ),
    "default": (
        f"case when idx = 0 then {ids(S['<bos>'])} || {codes(text(DEFAULT_SYSTEM))} || {codes(NL)} "
        f"else {codes(NL)} || {ids(S['<bos>'])} end "
        f"|| {codes(_default_prompt)}",
        f"{codes('r')} || {ids(EOS)}",
        False,
    ),
    "llama2": (
        f"{ids(S['<bos>'])} || "
        + codes(f"'[INST] ' || case when idx = 0 then {_llama_block} else '' end || q || ' [/INST]'"),
        f"{codes('r')} || {ids(EOS)}",
        False,
    ),
}


def turn_tokens(name: str) -> str:
    source, target, _ = TOKENS[name]
    return f"""{PAIRS},
tokens as (select conv_id, idx, n_pairs, r, {source} as src, {target} as tgt from pairs)"""


def supervised(name: str, cutoff: int, train_on_prompt: bool = False) -> str:
    """CTEs up to ``encoded(conv_id, input_ids, labels)``."""
    at_end = TOKENS[name][2]
    if train_on_prompt:
        mask = "src"
    elif at_end:
        mask = f"case when idx > 0 then {ids(EOS)} || {minus_100('len(src) - 1')} else {minus_100('len(src)')} end"
    else:
        mask = minus_100("len(src)")
    tail = f" || {ids(EOS)}" if at_end else ""
    share = "trunc({c} * (len({x}) / (len(src) + len(tgt))))::int"
    return f"""{turn_tokens(name)},
cut as (
  select conv_id, idx, src[1:{share.format(c=cutoff, x='src')}] as src, tgt[1:{share.format(c=cutoff, x='tgt')}] as tgt
  from tokens),
joined as (
  select conv_id, flatten(list(src || tgt order by idx)){tail} as ids, flatten(list({mask} || tgt order by idx)){tail} as labels
  from cut group by conv_id),
encoded as (
  select conv_id, ids[1:{cutoff}] as input_ids, case when len(ids) > {cutoff} then labels[1:{cutoff}] else labels end as labels
  from joined)"""


def counted(ctes: str, key: str = "conv_id") -> str:
    return f"""
with {ctes}
select conv_id as {key}, len(input_ids) as n_tokens, len(list_filter(labels, lambda x: x <> -100)) as n_label_tokens,
       {joined('input_ids', 'input_ids')}, {joined('labels', 'labels')}
from encoded"""


ORACLES["encode_sft"] = counted(supervised("chatglm3", 1024))
ORACLES["encoded_cache"] = ORACLES["encode_sft"]
ORACLES["stream_encode"] = counted(supervised("chatglm3", 1024), "chat_id")
ORACLES["encode_train_on_prompt"] = counted(supervised("default", 1024, train_on_prompt=True))
ORACLES["encode_llama2"] = counted(supervised("llama2", 1024))
ORACLES["truncate_proportional"] = counted(supervised("chatglm3", 64))

_names = " ".join(f"when i = {n} then {text(name)}" for name, n in S.items())

def _decoded(ids_: str) -> str:
    return (
        f"array_to_string(list_transform({ids_}, lambda i: case {_names} else chr(i - {C.TOKENIZER.offset}) end), '')"
    )


ORACLES["decode_special"] = f"""
with {supervised('chatglm3', 1024)} select conv_id, {_decoded('input_ids')} as text from encoded"""

ORACLES["preview_examples"] = f"""
with {supervised('chatglm3', 1024)}
select conv_id, {_decoded('input_ids')} as input_text,
       {_decoded('list_filter(labels, lambda x: x <> -100)')} as labels_text
from encoded order by conv_id limit {C.PREVIEWED}"""


def predicted(cutoff: int) -> str:
    """CTEs up to ``encoded(conv_id, input_ids, labels)`` in prediction form."""
    return f"""{turn_tokens('chatglm3')},
encoded as (
  select conv_id,
         flatten(list(case when idx = n_pairs - 1 then src else src || tgt end order by idx))[1:{cutoff}] as input_ids,
         (max_by(tgt, idx) || {ids(EOS)})[1:{cutoff}] as labels
  from tokens group by conv_id)"""


ORACLES["encode_predict"] = f"""
with {predicted(1024)}
select conv_id, {joined('input_ids', 'input_ids')}, {joined('labels', 'labels')} from encoded"""

ORACLES["encode_pairwise"] = f"""
with {RANKED},
sides as (
  select pair_id,
         {ids(S['<bos>'], S['[gMASK]'], S['sop'], S['<|user|>'])} || {codes(NL)} || {codes('prompt')} || {ids(S['<|assistant|>'])} as p,
         {codes('answers[1]')} || {ids(EOS)} as c, {codes('answers[2]')} || {ids(EOS)} as r
  from ranked where len(answers) > 1),
shares as (
  select *, trunc(256 * (len(p) / (len(p) + greatest(len(c), len(r)))))::int as ps,
         trunc(256 * (greatest(len(c), len(r)) / (len(p) + greatest(len(c), len(r)))))::int as rs
  from sides)
select pair_id, {joined('p[1:ps]', 'prompt_ids')}, {joined('c[1:rs]', 'chosen_ids')}, {joined('r[1:rs]', 'rejected_ids')}
from shares"""


def packed() -> str:
    mask = f"case when idx > 0 then {ids(EOS)} || {minus_100('len(src) - 1')} else {minus_100('len(src)')} end"
    return f"""
with {turn_tokens('chatglm3')},
numbered as (select conv_id, row_number() over (order by conv_id) - 1 as row_idx from good),
grouped as (
  select row_idx // {C.PACK_ROWS} as pack_group,
         flatten(list(src || tgt order by row_idx, idx)) || {ids(EOS)} as ids,
         flatten(list({mask} || tgt order by row_idx, idx)) || {ids(EOS)} as labels
  from tokens join numbered using (conv_id) group by pack_group),
blocks as (select *, unnest(range(len(ids) // {C.BLOCK})) as block from grouped)
select pack_group, block, {joined(f'ids[block * {C.BLOCK} + 1 : (block + 1) * {C.BLOCK}]', 'input_ids')},
       {joined(f'labels[block * {C.BLOCK} + 1 : (block + 1) * {C.BLOCK}]', 'labels')}
from blocks"""


ORACLES["pack_blocks"] = packed()
ORACLES["stream_pack"] = ORACLES["pack_blocks"]

# -- split, shuffle, batch --------------------------------------------------------


def _parts(k: str) -> str:
    return f"""
with drawn as (
  select doc_id, n_chars, row_number() over (order by md5('{C.SEED}:' || doc_id), doc_id) as place from documents)
select doc_id, n_chars, case when place <= {k} then 'eval' else 'train' end as part from drawn"""


ORACLES["split_fraction"] = _parts(f"ceil({C.VAL_FRACTION} * (select count(*) from documents))")
ORACLES["split_count"] = _parts(str(C.VAL_COUNT))

ORACLES["buffer_shuffle"] = f"""
with numbered as (select doc_id, row_number() over (order by doc_id) - 1 as row_idx from documents)
select doc_id, row_idx, (row_idx // 128) * 128
       + row_number() over (partition by row_idx // 128 order by md5('{C.SEED}:' || row_idx), row_idx) - 1 as shuffled_idx
from numbered"""

def _moving(numbered: str, size: int) -> str:
    """Places of rows in the order in which they leave a buffer of ``size``, from ``numbered(key, row_idx)``."""
    return f"""{numbered},
put as (
  select *, case when row_idx < {size} then row_idx
            else ('0x' || substr(md5('{C.SEED}:' || (row_idx - {size})), 1, 8))::bigint % {size} end as slot
  from numbered),
left_by as (select *, lead(row_idx) over (partition by slot order by row_idx) as driver from put),
stays as (
  select key, row_idx, row_number() over (order by md5('{C.SEED}:' || row_idx), row_idx) - 1 as place
  from left_by where driver is null),
shuffled as (
  select key, row_idx, driver - {size} as shuffled_idx from left_by where driver is not null
  union all
  select key, row_idx, place + greatest((select count(*) from numbered) - {size}, 0) from stays)"""


_numbered_docs = "numbered as (select doc_id as key, row_number() over (order by doc_id) - 1 as row_idx from documents)"
_numbered_chats = "numbered as (select conv_id as key, row_number() over (order by conv_id) - 1 as row_idx from good)"

ORACLES["buffer_shuffle_moving"] = f"""
with {_moving(_numbered_docs, C.BUFFER)} select key as doc_id, row_idx, shuffled_idx from shuffled"""

ORACLES["stream_shuffle_moving"] = f"""
with {PAIRS}, {_moving(_numbered_chats, C.BATCH)} select key as chat_id, shuffled_idx from shuffled"""

ORACLES["stream_shuffle"] = f"""
with {PAIRS},
numbered as (select conv_id, row_number() over (order by conv_id) - 1 as row_idx from good)
select conv_id as chat_id, (row_idx // 16) * 16
       + row_number() over (partition by row_idx // 16 order by md5('{C.SEED}:' || row_idx), row_idx) - 1 as shuffled_idx
from numbered"""

ORACLES["stream_take_skip"] = f"""
with {PAIRS}
select conv_id as chat_id, q as prompt,
       case when row_number() over (order by conv_id) <= 15 then 'eval' else 'train' end as part
from pairs where idx = n_pairs - 1"""

ORACLES["stream_concat"] = f"""
with {PAIRS}
select conv_id as chat_id, q as prompt, d.dataset
from pairs, (values ('a'), ('b')) as d(dataset) where idx = n_pairs - 1"""

_CHAT_SOURCES = f"""{PAIRS},
src as (
  select conv_id, conv_id % 3 as source_no, row_number() over (partition by conv_id % 3 order by conv_id) - 1 as n
  from good),
size as (select source_no, count(*) as c from src group by source_no)"""

ORACLES["stream_interleave"] = f"""
with {_CHAT_SOURCES}
select n * 3 + source_no as row_idx, conv_id as chat_id from src where n < (select min(c) from size)"""

ORACLES["stream_interleave_over"] = f"""
with {_CHAT_SOURCES},
slots as (select source_no, c, unnest(range((select max(c) from size))) as slot from size)
select slot * 3 + slots.source_no as row_idx, conv_id as chat_id
from slots join src on src.source_no = slots.source_no and src.n = slots.slot % slots.c"""


def _weighted_chats(over: bool) -> str:
    first, second = C.STREAM_SHARES[0], C.STREAM_SHARES[0] + C.STREAM_SHARES[1]
    end, pick = ("max", "draw % c") if over else ("min", "draw")
    return f"""
with {_CHAT_SOURCES},
draws as (
  select slot, ('0x' || substr(md5('{C.SEED}:' || slot), 1, 8))::bigint / 4294967296 as u
  from (select unnest(range((select count(*) * 20 from good))) as slot)),
chosen as (select slot, case when u < {first!r} then 0 when u < {second!r} then 1 else 2 end as source_no from draws),
numbered as (
  select slot, chosen.source_no, row_number() over (partition by chosen.source_no order by slot) - 1 as draw, c
  from chosen join size using (source_no)),
halt as (select {end}(slot) as last_slot from numbered where draw = c - 1)
select slot as row_idx, conv_id as chat_id
from numbered join src on src.source_no = numbered.source_no and src.n = {pick}
where slot <= (select last_slot from halt)"""


ORACLES["stream_interleave_weighted"] = _weighted_chats(False)
ORACLES["stream_interleave_weighted_over"] = _weighted_chats(True)


def _padded(ctes: str, left: bool) -> str:
    def fill(column: str, width: str, filler: int) -> str:
        extra = f"list_transform(range({width} - len({column})), lambda z: {filler})"
        return f"{extra} || {column}" if left else f"{column} || {extra}"

    step = 1 if left else 4
    wide = "((max(len({c})) over (partition by batch) + {m}) // {s}) * {s}"
    return f"""
with {ctes},
indexed as (
  select conv_id, (row_number() over (order by conv_id) - 1) // {C.BATCH} as batch, input_ids, labels,
         list_transform(input_ids, lambda z: 1) as mask
  from encoded),
sized as (
  select *, {wide.format(c='input_ids', m=step - 1, s=step)} as w, {wide.format(c='labels', m=step - 1, s=step)} as lw
  from indexed)
select conv_id, batch, {joined(fill('input_ids', 'w', 0), 'input_ids')},
       {joined(fill('mask', 'w', 0), 'attention_mask')}, {joined(fill('labels', 'lw', -100), 'labels')}
from sized"""


ORACLES["pad_right"] = _padded(supervised("chatglm3", 255), left=False)
ORACLES["pad_left"] = _padded(predicted(255), left=True)

# -- metrics ----------------------------------------------------------------------

JUDGED = """
judged as (
  select (n_chars > 500)::int as p, quality as y, (n_chars > 2000)::int as p2, toxic as y2, n_chars as w
  from labels join documents using (doc_id))
"""


def _metric(expression: str) -> str:
    return f"with {JUDGED} select round(({expression})::double, 12) as accuracy from judged"


ORACLES["accuracy"] = _metric("avg((p = y)::int)")
ORACLES["accuracy_count"] = _metric("sum((p = y)::int)")
ORACLES["accuracy_weighted"] = _metric("sum(w * (p = y)::int) / sum(w)")
ORACLES["accuracy_weighted_sum"] = _metric("sum(w * (p = y)::int)")
ORACLES["accuracy_multilabel"] = _metric("avg((p = y and p2 = y2)::int)")

ORACLES["metrics_sink"] = f"""
with {JUDGED}
select 'train' as split, 'train_accuracy' as metric, round(avg((p = y)::int), 12) as value from judged
union all
select 'eval', 'eval_accuracy', round(sum(w * (p = y)::int) / sum(w), 12) from judged"""


def _shifted(condition: str) -> str:
    return f"""
with {supervised('chatglm3', 1024)},
places as (select labels, unnest(range(1, len(labels))) as i from encoded),
looked as (
  select labels[i + 1] as y, case when (i - 1) % 7 = 0 then 0 else labels[i + 1] end as p from places)
select round(avg((y = p)::int), 12) as accuracy from looked where {condition}"""


ORACLES["token_accuracy_shifted"] = _shifted("true")
ORACLES["token_accuracy_ignoring"] = _shifted("y <> -100")

ORACLES["argmax_scores"] = """
select vec_id, (list_position(embedding, list_max(embedding)) - 1)::int as best from embeddings"""


def _tidy(expression: str) -> str:
    for loose, tight in SPACING_FIXES:
        expression = f"replace({expression}, {text(loose)}, {text(tight)})"
    return expression


RECORDS = f"""
with {PAIRS}
select conv_id, {_tidy('left(r, 1024)')} as label,
       {_tidy('left(r, greatest(least(length(r) + 1, 1024) - 3, 0))')} as predict
from pairs where idx = n_pairs - 1"""
ORACLES["prediction_records"] = RECORDS
ORACLES["prediction_sink"] = f"select label, predict from ({RECORDS})"

# -- readers ----------------------------------------------------------------------

ORACLES["read_jsonl"] = """
select row_number() over (order by doc_id) - 1 as row_idx, 'Document ' || doc_id as prompt, source as query,
       text as response
from documents"""
ORACLES["read_csv"] = ORACLES["read_csv_pieces"] = ORACLES["read_json_pieces"] = ORACLES["read_jsonl"]
ORACLES["stream_read"] = "select 'Document ' || doc_id as prompt, source as query, text as response from documents"
ORACLES["read_text"] = """
select prompt, count(*) as n from (select unnest(string_split(text, chr(10))) as prompt from documents) group by prompt"""
ORACLES["read_parquet_split"] = "select source as prompt, text as response from documents where n_chars % 4 = 0"
