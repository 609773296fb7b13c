"""Tokenizers as column expressions.

A tokenizer turns an ``array<string>`` of text units into an ``array<array<int>>``.
Each unit is encoded as a whole, because a subword vocabulary gives other ids when a
text is cut in pieces first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F

IGNORE_INDEX = -100
FALLBACK_EOS = "<|endoftext|>"


@dataclass(frozen=True)
class SpecialTokens:
    """Names and ids of the special tokens, and which of them play a role."""

    ids: dict[str, int] = field(default_factory=dict)
    bos_token: str | None = None
    eos_token: str | None = None
    pad_token: str | None = None
    add_bos_token: bool = True

    def special_id(self, name: str) -> int:
        if name not in self.ids:
            raise KeyError(f"special token {name!r} is not in the vocabulary")
        return self.ids[name]

    @property
    def bos_id(self) -> int | None:
        return None if self.bos_token is None else self.special_id(self.bos_token)

    @property
    def eos_id(self) -> int | None:
        return None if self.eos_token is None else self.special_id(self.eos_token)

    @property
    def pad_id(self) -> int | None:
        return None if self.pad_token is None else self.special_id(self.pad_token)


class Tokenizer:
    """Base: special tokens, and what the two concrete tokenizers share."""

    special: SpecialTokens

    def encode_units(self, units: Column) -> Column:
        raise NotImplementedError

    def encode_literal(self, text: str) -> list[int]:
        """Encode a template constant on the driver."""
        raise NotImplementedError

    def decode(self, ids: Column, skip_special_tokens: bool = False) -> Column:
        raise NotImplementedError

    def free_ids(self) -> Iterable[int]:
        """Ids that may be given to tokens added later."""
        raise NotImplementedError

    def _with(self, special: SpecialTokens) -> "Tokenizer":
        raise NotImplementedError

    def encode(self, text: Column) -> Column:
        return F.element_at(self.encode_units(F.array(text)), 1)

    def add_special_tokens(self, names: Iterable[str]) -> "Tokenizer":
        ids = dict(self.special.ids)
        free = iter(self.free_ids())
        for name in names:
            if name not in ids:
                ids[name] = next(free)
        return self._with(replace(self.special, ids=ids))

    def completed(self, stop_words: Iterable[str] = ()) -> "Tokenizer":
        """Make sure eos and pad exist and the stop words are special tokens."""
        tokenizer = self
        if tokenizer.special.eos_token is None:
            tokenizer = tokenizer.add_special_tokens([FALLBACK_EOS])
            tokenizer = tokenizer._with(replace(tokenizer.special, eos_token=FALLBACK_EOS))
        if tokenizer.special.pad_token is None:
            tokenizer = tokenizer._with(replace(tokenizer.special, pad_token=tokenizer.special.eos_token))
        return tokenizer.add_special_tokens(stop_words)

    def drop_special(self, ids: Column) -> Column:
        known = sorted(set(self.special.ids.values()))
        return F.filter(ids, lambda x: ~x.isin(known)) if known else ids


@dataclass(frozen=True)
class CodepointTokenizer(Tokenizer):
    """One id per Unicode code point, ``offset`` above the special ids. All on the JVM."""

    special: SpecialTokens
    offset: int = 100

    def _with(self, special: SpecialTokens) -> "CodepointTokenizer":
        return replace(self, special=special)

    def free_ids(self) -> Iterable[int]:
        used = set(self.special.ids.values())
        return (i for i in range(self.offset) if i not in used)

    def _ids(self, text: Column) -> Column:
        # splitting '' gives one empty string, not none
        codes = F.transform(F.split(text, ""), lambda c: F.ascii(c) + self.offset)
        return F.when(text == "", F.lit([]).cast("array<int>")).otherwise(codes)

    def encode_units(self, units: Column) -> Column:
        return F.transform(units, self._ids)

    def encode(self, text: Column) -> Column:
        return self._ids(text)

    def encode_literal(self, text: str) -> list[int]:
        return [ord(c) + self.offset for c in text]

    def decode(self, ids: Column, skip_special_tokens: bool = False) -> Column:
        names = {i: n for n, i in self.special.ids.items()}

        def spelled(i: Column) -> Column:
            # UTF-32 code units, the one charset in which every id has the same width
            plain = F.lpad(F.hex(i - self.offset), 8, "0")
            if skip_special_tokens:
                return plain
            out = plain
            for number, name in sorted(names.items()):
                units = "".join(f"{ord(c):08X}" for c in name)
                out = F.when(i == number, F.lit(units)).otherwise(out)
            return out

        kept = self.drop_special(ids) if skip_special_tokens else ids
        return F.decode(F.unhex(F.array_join(F.transform(kept, spelled), "")), "UTF-32")


def _lists(sizes: list[int | None], values: pa.Array) -> pa.ListArray:
    """Consecutive values as lists of these sizes; None is a null."""
    offsets = np.cumsum([0, *(n or 0 for n in sizes)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([n is None for n in sizes], pa.bool_()))


class CallableTokenizer(Tokenizer):
    """Any ``str -> list[int]`` encoder, run on Arrow batches.

    ``make_encoder`` is called once per Python worker, so a heavy vocabulary is not
    shipped with each task. One call carries all the text units of a row. Of a batch, ids are held in
    four bytes each.
    """

    def __init__(
        self,
        make_encoder: Callable[[], Callable[[str], list[int]]],
        special: SpecialTokens,
        make_decoder: Callable[[], Callable[[list[int]], str]] | None = None,
        first_free_id: int | None = None,
    ):
        self.make_encoder = make_encoder
        self.make_decoder = make_decoder
        self.special = special
        self.first_free_id = first_free_id
        self._driver_encoder = None

    def _with(self, special: SpecialTokens) -> "CallableTokenizer":
        return CallableTokenizer(self.make_encoder, special, self.make_decoder, self.first_free_id)

    def free_ids(self) -> Iterable[int]:
        if self.first_free_id is None:
            raise ValueError("first_free_id is needed to add special tokens to this tokenizer")
        used = set(self.special.ids.values())
        start = max([self.first_free_id, *(i + 1 for i in used)])
        return iter(range(start, start + 1_000_000))

    def encode_literal(self, text: str) -> list[int]:
        if self._driver_encoder is None:
            self._driver_encoder = self.make_encoder()
        return [int(i) for i in self._driver_encoder(text)] if text else []

    def encode_units(self, units: Column) -> Column:
        make_encoder, held = self.make_encoder, []

        @F.arrow_udf("array<array<int>>")
        def encode_batch(rows: pa.Array) -> pa.Array:
            if not held:
                held.append(make_encoder())
            encode = held[0]
            ids, sizes, counts = [pa.array([], pa.int32())], [], []
            for row in rows:  # Python objects of one text at a time
                texts = row.as_py()
                counts.append(None if texts is None else len(texts))
                for text in texts or ():
                    sizes.append(None if text is None else 0)
                    if text:
                        ids.append(pa.array(list(encode(text)), pa.int32()))
                        sizes[-1] = len(ids[-1])
            return _lists(counts, _lists(sizes, pa.concat_arrays(ids)))

        return encode_batch(units)

    def decode(self, ids: Column, skip_special_tokens: bool = False) -> Column:
        if self.make_decoder is None:
            raise ValueError("this tokenizer was given no decoder")
        make_decoder, held = self.make_decoder, []
        names = {i: n for n, i in self.special.ids.items()}

        @F.pandas_udf("string")
        def decode_batch(rows: pd.Series) -> pd.Series:
            if not held:
                held.append(make_decoder())
            decode_plain = held[0]

            def one(row):
                if row is None:
                    return None
                text, run = [], []
                for i in row:
                    if i in names:
                        text += [decode_plain(run), names[i]] if run else [names[i]]
                        run = []
                    else:
                        run.append(int(i))
                return "".join(text + ([decode_plain(run)] if run else []))

            return rows.map(one)

        return decode_batch(self.drop_special(ids) if skip_special_tokens else ids)


# The spacing fixes applied after decoding predictions, in this order.
SPACING_FIXES = (
    (" .", "."),
    (" ?", "?"),
    (" !", "!"),
    (" ,", ","),
    (" ' ", "'"),
    (" n't", "n't"),
    (" 'm", "'m"),
    (" 's", "'s"),
    (" 've", "'ve"),
    (" 're", "'re"),
)


def tidy_spacing(text: Column) -> Column:
    for loose, tight in SPACING_FIXES:
        text = F.replace(text, F.lit(loose), F.lit(tight))
    return text
