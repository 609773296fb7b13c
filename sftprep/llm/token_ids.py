"""Token ids of whole texts with a public tokenizer, in bounded stretches.

A byte-level tokenizer never merges across a single space between two other characters, so
a long text may be cut there. If the vocabulary also exists as a rank file, ids come from it,
several times sooner and the same; a stretch that may hold a special token always goes to
the tokenizer file.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

WIDTH = 4  # bytes of an id
STRETCH = 1 << 18  # characters of a text handled at a time
SPECIAL = "<|"  # special tokens of the supported vocabularies begin with it

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file, and the same vocabulary as ranks with its splitting pattern if there is one."""

    file: str
    ranks: str | None = None
    pattern: str | None = None


_loaded: dict[Vocabulary, Callable[[str], list[int]]] = {}


def ids_of(vocabulary: Vocabulary) -> Callable[[str], list[int]]:
    """The encoding function of a vocabulary, loaded once per process."""
    if vocabulary not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary.file)

        def exact(text: str) -> list[int]:
            return tokenizer.encode(text, add_special_tokens=False).ids

        if vocabulary.ranks:
            import tiktoken

            with open(vocabulary.ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            by_rank = tiktoken.Encoding(
                "ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary
            _loaded[vocabulary] = lambda text: exact(text) if SPECIAL in text else by_rank(text)
        else:
            _loaded[vocabulary] = exact
    return _loaded[vocabulary]


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """Cut a long text before single spaces, about every ``size`` characters."""
    start = 0
    while len(text) - start > size:
        cut = _BETWEEN.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encoder(vocabulary: Vocabulary, end_id: int | None = None) -> Callable[[str], bytes]:
    """A function from a text to its ids (little-endian, 32 bit), closed by ``end_id``."""
    ids = ids_of(vocabulary)
    end = b"" if end_id is None else array("I", [end_id]).tobytes()
    return lambda text: b"".join(array("I", ids(part)).tobytes() for part in stretches(text)) + end
