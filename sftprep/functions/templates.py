"""Chat templates compiled to column expressions over the turns of a conversation."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .slots import QUERY, SYSTEM, fill, fill_all
from .tokenizers import SpecialTokens, Tokenizer

TURNS_TYPE = "array<struct<q:string,r:string>>"


@dataclass(frozen=True)
class Special:
    """A template element that stands for exactly one special token."""

    name: str


Element = str | Special


@dataclass(frozen=True)
class ChatTemplate:
    """How system text, queries and responses are laid out.

    ``system_in_query`` is the Llama-2 layout: the system block is text put before the
    first query, and neither separator nor turn number is used.
    """

    name: str
    prefix: tuple[Element, ...]
    prompt: tuple[Element, ...]
    system: str
    sep: tuple[Element, ...] = ()
    stop_words: tuple[str, ...] = ()
    use_history: bool = True
    efficient_eos: bool = False
    system_in_query: bool = False

    # -- layout ---------------------------------------------------------------

    def prompt_segments(self, query: Column, idx: Column) -> list[Column | Special]:
        number = None if self.system_in_query else idx.cast("string")
        return [e if isinstance(e, Special) else fill(e, query=query, idx=number) for e in self.prompt]

    def prefix_segments(self, system: Column) -> list[Column | Special]:
        if self.system_in_query:
            return []
        return [e if isinstance(e, Special) else fill(e, system=system) for e in self.prefix]

    def first_query(self, query: Column, system: Column, idx: Column) -> Column:
        """The query as the prompt sees it: Llama-2 puts the system block before turn 0."""
        if not self.system_in_query:
            return query
        block = fill_all(str(self.prefix[0]), SYSTEM, system)
        return F.when(idx == 0, F.concat(block, query)).otherwise(query)

    def always_emits(self, special: SpecialTokens) -> bool:
        """True if every turn yields at least one token whatever its texts are."""
        fixed = [e for e in self.prompt if isinstance(e, Special) or e.replace(QUERY, "") != ""]
        has_bos = special.bos_token is not None and special.add_bos_token
        return bool(fixed) or has_bos or not self.efficient_eos


def _elements(raw: Iterable[str | dict | Special]) -> tuple[Element, ...]:
    out: list[Element] = []
    for element in raw:
        if isinstance(element, dict):
            element = Special(element["token"])
        if not isinstance(element, (str, Special)):
            raise ValueError(f"template elements are strings or token names, not {type(element).__name__}")
        out.append(element)
    return tuple(out)


TEMPLATES: dict[str, ChatTemplate] = {}


def register_template(
    name: str,
    prefix: Iterable[str | dict | Special],
    prompt: Iterable[str | dict | Special],
    system: str,
    sep: Iterable[str | dict | Special],
    stop_words: Iterable[str] = (),
    use_history: bool = True,
    efficient_eos: bool = False,
) -> ChatTemplate:
    """Add a template; a name holding ``llama2`` gets the Llama-2 layout."""
    made = ChatTemplate(
        name=name,
        prefix=_elements(prefix),
        prompt=_elements(prompt),
        system=system,
        sep=_elements(sep),
        stop_words=tuple(stop_words),
        use_history=use_history,
        efficient_eos=efficient_eos,
        system_in_query="llama2" in name,
    )
    TEMPLATES[name] = made
    return made


def get_template(name: str | None) -> ChatTemplate | None:
    if name is None:
        return None
    if name not in TEMPLATES:
        raise AssertionError(f"a template called {name!r} does not exist; known: {', '.join(TEMPLATES)}")
    return TEMPLATES[name]


def template_for(name: str | None, tokenizer: Tokenizer) -> tuple[ChatTemplate | None, Tokenizer]:
    """A template with the tokenizer completed for it (eos, pad, stop words)."""
    template = get_template(name)
    return template, tokenizer.completed(template.stop_words if template else ())


# -- fixed values: the template texts ---------------------------------------------

DEFAULT_SYSTEM = (
    "A chat between a curious user and an artificial intelligence assistant. "
    "The assistant gives helpful, detailed, and polite answers to the user's questions."
)
LLAMA2_SYSTEM = (
    "You are a helpful, respectful and honest assistant. "
    "Always answer as helpfully as possible, while being safe.  "
    "Your answers should not include any harmful, unethical, "
    "racist, sexist, toxic, dangerous, or illegal content. "
    "Please ensure that your responses are socially unbiased and positive in nature.\n\n"
    "If a question does not make any sense, or is not factually coherent, "
    "explain why instead of answering something not correct. "
    "If you don't know the answer to a question, please don't share false information."
)
LLAMA2_ZH_SYSTEM = "You are a helpful assistant. 你是一个乐于助人的助手。"
LLAMA2_PREFIX = "<<SYS>>\n{{system}}\n<</SYS>>\n\n"
LLAMA2_PROMPT = "[INST] {{query}} [/INST]"

register_template("default", ["{{system}}"], ["Human: {{query}}\nAssistant:"], DEFAULT_SYSTEM, ["\n"])
register_template("llama2", [LLAMA2_PREFIX], [LLAMA2_PROMPT], LLAMA2_SYSTEM, [])
register_template("llama2_zh", [LLAMA2_PREFIX], [LLAMA2_PROMPT], LLAMA2_ZH_SYSTEM, [])
register_template(
    "baichuan",
    ["{{system}}"],
    [Special("<reserved_102>"), "{{query}}", Special("<reserved_103>")],
    "",
    [],
    efficient_eos=True,
)
register_template(
    "baichuan2",
    ["{{system}}"],
    [Special("<reserved_106>"), "{{query}}", Special("<reserved_107>")],
    "",
    [],
    efficient_eos=True,
)
register_template(
    "chatglm2",
    [Special("[gMASK]"), Special("sop"), "{{system}}"],
    ["[Round {{idx}}]\n\n问：{{query}}\n\n答："],
    "",
    ["\n\n"],
    efficient_eos=True,
)
register_template(
    "chatglm3",
    [Special("[gMASK]"), Special("sop"), "{{system}}"],
    [Special("<|user|>"), "\n", "{{query}}", Special("<|assistant|>")],
    "",
    [],
    stop_words=["<|user|>", "<|observation|>"],
    efficient_eos=True,
)

# -- fixed values: model name -> family -> template -------------------------------

MODEL_FAMILY = {
    "LLaMA2-7B-Base": "LLaMA2",
    "LLaMA2-13B-Base": "LLaMA2",
    "LLaMA2-70B-Base": "LLaMA2",
    "LLaMA2-7B-Chat": "LLaMA2",
    "LLaMA2-13B-Chat": "LLaMA2",
    "LLaMA2-70B-Chat": "LLaMA2",
    "ChineseLLaMA2-7B-Base": "ChineseLLaMA2",
    "ChineseLLaMA2-13B-Base": "ChineseLLaMA2",
    "ChineseLLaMA2-7B-Chat": "ChineseLLaMA2",
    "ChineseLLaMA2-13B-Chat": "ChineseLLaMA2",
    "Baichuan-7B-Base": "Baichuan",
    "Baichuan-7B-Chat": "Baichuan",
    "Baichuan-13B-Base": "Baichuan",
    "Baichuan-13B-Chat": "Baichuan",
    "Baichuan2-7B-Base": "Baichuan2",
    "Baichuan2-7B-Chat": "Baichuan2",
    "Baichuan2-13B-Base": "Baichuan2",
    "Baichuan2-13B-Chat": "Baichuan2",
    "ChatGLM2-6B-Chat": "ChatGLM2",
    "ChatGLM3-6B-Base": "ChatGLM2",
    "ChatGLM3-6B-Chat": "ChatGLM3",
}
FAMILY_TEMPLATE = {
    "LLaMA2": "llama2",
    "ChineseLLaMA2": "llama2_zh",
    "Baichuan": "baichuan",
    "Baichuan2": "baichuan2",
    "ChatGLM2": "chatglm2",
    "ChatGLM3": "chatglm3",
}


def template_name_for_model(model: str) -> str:
    return FAMILY_TEMPLATE[MODEL_FAMILY[model]]


# -- turns ------------------------------------------------------------------------


def system_or_default(template: ChatTemplate, system: Column | None) -> Column:
    default = F.lit(template.system)
    return default if system is None else F.coalesce(F.nullif(system, F.lit("")), default)


def conversation_turns(template: ChatTemplate, query: Column, response: Column, history: Column | None) -> Column:
    """History (if the template keeps it) followed by the current pair."""
    current = F.array(F.struct(query.alias("q"), response.alias("r")))
    if history is None or not template.use_history:
        return current
    return F.concat(F.coalesce(history, F.lit([]).cast(TURNS_TYPE)), current)


def _bos_name(special: SpecialTokens) -> str | None:
    return special.bos_token if special.add_bos_token else None


def _eos_name(template: ChatTemplate, special: SpecialTokens) -> str | None:
    if special.eos_token is None:
        raise ValueError("the tokenizer names no EOS token, and a template ends its turns with it")
    return None if template.efficient_eos else special.eos_token


def render_turns(
    template: ChatTemplate, special: SpecialTokens, turns: Column, system: Column, first_idx: Column | int = 0
) -> Column:
    """The text form: ``array<struct<source,target>>`` with special tokens spelled by name."""
    bos = _bos_name(special) or ""
    eos = _eos_name(template, special) or ""
    sep = "".join(e.name if isinstance(e, Special) else e for e in template.sep)

    def spell(segments: list[Column | Special]) -> list[Column]:
        return [F.lit(s.name) if isinstance(s, Special) else s for s in segments]

    prefix = F.concat(F.lit(""), *spell(template.prefix_segments(system)))
    if template.system_in_query:
        opening = following = F.lit(bos)
    else:
        opening = F.when(prefix != "", F.concat(F.lit(bos), prefix, F.lit(sep))).otherwise(F.lit(bos))
        following = F.lit(sep + bos)

    def turn(t: Column, i: Column) -> Column:
        at = i + first_idx
        query = template.first_query(t["q"], system, at)
        return F.struct(
            F.concat(
                F.when(at == 0, opening).otherwise(following), *spell(template.prompt_segments(query, at))
            ).alias("source"),
            F.concat(t["r"], F.lit(eos)).alias("target"),
        )

    return F.transform(turns, turn)


def text_units(template: ChatTemplate, turns: Column, system: Column, first_idx: Column | int = 0) -> Column:
    """Every text that goes to the tokenizer, as one array: prefix texts, then per turn
    its prompt texts and its response."""
    prefix = [s for s in template.prefix_segments(system) if not isinstance(s, Special)]

    def of_turn(t: Column, i: Column) -> Column:
        at = i + first_idx
        query = template.first_query(t["q"], system, at)
        texts = [s for s in template.prompt_segments(query, at) if not isinstance(s, Special)]
        return F.array(*texts, t["r"])

    body = F.flatten(F.transform(turns, of_turn))
    return F.concat(F.array(*prefix), body) if prefix else body


def id_array(ids: list[int]) -> Column:
    return F.array(*[F.lit(i) for i in ids]) if ids else F.lit([]).cast("array<int>")


def assemble_turns(
    template: ChatTemplate, tokenizer: Tokenizer, turns: Column, units: Column, first_idx: Column | int = 0
) -> Column:
    """``array<struct<src,tgt>>`` from the encoded units of :func:`text_units`.

    Each side is a list of id arrays still to be joined (``array<array<int>>``): lists
    of arrays are cheap to put together, while joining ids copies each of them, so that
    is left to one ``flatten`` at the end. ``units`` must be a stored column, not the
    expression that encodes: it is read several times per turn.
    """
    special = tokenizer.special
    bos_name, eos_name = _bos_name(special), _eos_name(template, special)
    bos = [special.special_id(bos_name)] if bos_name else []
    eos = [special.special_id(eos_name)] if eos_name else []
    sep = [
        i
        for e in template.sep
        for i in ([special.special_id(e.name)] if isinstance(e, Special) else tokenizer.encode_literal(e))
    ]

    prefix = () if template.system_in_query else template.prefix
    n_prefix = sum(isinstance(e, str) for e in prefix)
    n_prompt = sum(isinstance(e, str) for e in template.prompt)

    def parts_of(elements: Iterable[Element], first_unit: Column | int) -> list[Column]:
        out, taken = [], 0
        for e in elements:
            if isinstance(e, Special):
                out.append(F.array(F.lit(special.special_id(e.name))))
            else:
                out.append(F.get(units, F.lit(first_unit) + taken))
                taken += 1
        return out

    if template.system_in_query:
        opening = following = F.array(id_array(bos))
    else:
        head = parts_of(prefix, 0)
        opening = F.array(id_array(bos), *head, id_array(sep))
        if not any(isinstance(e, Special) for e in prefix):
            # a prefix that encodes to nothing takes its separator with it
            length = sum((F.size(h) for h in head), F.lit(0))
            opening = F.when(length > 0, opening).otherwise(F.array(id_array(bos)))
        following = F.array(id_array(sep + bos))

    def turn(_t: Column, i: Column) -> Column:
        first = i * (n_prompt + 1) + n_prefix
        response = F.get(units, first + n_prompt)
        return F.struct(
            F.concat(
                F.when(i + first_idx == 0, opening).otherwise(following), F.array(*parts_of(template.prompt, first))
            ).alias("src"),
            F.array(response, *([id_array(eos)] if eos else [])).alias("tgt"),
        )

    return F.transform(turns, turn)
