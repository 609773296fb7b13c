"""Licence notices in whole texts, by patience alignment with templates.

Words that occur once in a stretch of text and once in the template are anchors; the longest
chain of anchors that rises in both is kept, and the gaps between are aligned the same way.
The share of template words that are matched is the coverage.

Where to align: of a template with n words, coverage c leaves at most (1 - c) n words
unmatched, so one more than that many words (the longest, for they are rarest) must include
a matched one. Only stretches around such words are looked at, and all of them are. A stretch
takes in as many foreign words as ``room`` allows; more of them make it two pieces of a notice.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .decontamination import word_bytes, word_places

COVERAGE = 0.8
ROOM = 2.0  # foreign words on either side of a matched word, for each word of the template ...
LEAST_ROOM = 10  # ... and for the shortest templates


def rising(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    heads: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before[i] = heads[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            heads.append(i)
        else:
            tops[pile], heads[pile] = v, i
    chain, i = [], heads[-1] if heads else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return chain[::-1]


def align(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Matched (text word, template word) pairs, rising in both."""
    matched, open_ = [], [(0, len(text), 0, len(template))]
    while open_:
        a, b, c, d = open_.pop()
        while a < b and c < d and text[a] == template[c]:
            matched.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            matched.append((b, d))
        if a >= b or c >= d:
            continue
        once = {w for w, n in Counter(template[c:d]).items() if n == 1}
        here = Counter(w for w in text[a:b] if w in once)
        place = {w: j for j, w in enumerate(template[c:d], c) if w in once}
        anchors = [(i, place[w]) for i, w in enumerate(text[a:b], a) if w in once and here[w] == 1]
        chain = [anchors[i] for i in rising([j for _, j in anchors])]
        matched += chain
        for (i, j), (k, m) in zip([(a - 1, c - 1), *chain], [*chain, (b, d)], strict=True):
            if chain and k - i > 1 and m - j > 1:
                open_.append((i + 1, k, j + 1, m))
    return sorted(matched)


@dataclass
class Template:
    name: str
    words: list[bytes]
    places: dict[bytes, list[int]]  # where the words stand of which one must be matched

    @classmethod
    def of(cls, name: str, text: str, coverage: float) -> Template:
        words = word_bytes(text).split()
        unmatched = int((1 - coverage) * len(words) + 1e-9)
        needed = sorted(range(len(words)), key=lambda i: (-len(words[i]), i))[: unmatched + 1]
        places: dict[bytes, list[int]] = {}
        for i in sorted(needed):
            places.setdefault(words[i], []).append(i)
        return cls(name, words, places)


def _notices(words: list[bytes], template: Template, coverage: float, room: float = ROOM) -> Iterator[tuple[int, int, int]]:
    """(first word, word after the last, matched words) around every word that may be matched.

    A stretch is tried as long as the template would make it, so that a second notice nearby
    leaves its words unique, and with room for added words.
    """
    n, done = len(template.words), 0
    foreign = max(LEAST_ROOM, int(room * n))
    known = set(template.words)
    for at, word in enumerate(words):
        if word not in template.places or at < done:
            continue
        best = None
        for place, wide in product(template.places[word], (False, True)):
            left, right = place, n - place - 1
            begin = max(done, at - left - wide * foreign)
            end = min(len(words), at + 1 + right + wide * foreign)
            if len(known.intersection(words[begin:end])) < coverage * len(known) - (1 - coverage) * n:
                continue
            # this word is one of the matched ones; what stands before and after is aligned
            before = align(words[begin:at], template.words[:place])
            after = align(words[at + 1 : end], template.words[place + 1 :])
            matched = len(before) + 1 + len(after)
            if matched >= coverage * n and (best is None or matched > best[2]):
                first = begin + before[0][0] if before else at
                best = (first, at + 2 + after[-1][0] if after else at + 1, matched)
        if best:
            if best[2] == n == best[1] - best[0]:
                done = best[1]  # word for word: nothing better can begin inside
            yield best


def notices(text: str, templates: list[Template], coverage: float = COVERAGE, room: float = ROOM) -> list[dict]:
    """Notices of all templates, by place; where some overlap, the one with most matched words
    (then the tightest, then the first template) stays."""
    words = word_bytes(text).split()
    present = set(words)
    found = []
    for order, t in enumerate(templates):
        if not present.isdisjoint(t.places):
            found += [(-m, b - a - m, order, a, b) for a, b, m in _notices(words, t, coverage, room)]
    if not found:
        return []
    starts, kept = [], []  # by place
    for f in sorted(found):
        at = bisect_left(starts, f[3])
        if (at == 0 or kept[at - 1][4] <= f[3]) and (at == len(kept) or f[4] <= kept[at][3]):
            starts.insert(at, f[3])
            kept.insert(at, f)
    places = word_places(text)
    return [
        {
            "license": templates[order].name,
            "coverage": -matched / len(templates[order].words),
            "start": int(places[0][a]),
            "end": int(places[1][b - 1]),
        }
        for matched, _, order, a, b in kept
    ]


def scan_licenses(
    docs: DataFrame,
    licenses: dict[str, str],
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    room: float = ROOM,
) -> DataFrame:
    """One row per notice: ``id``, ``license``, ``coverage``, ``start`` and ``end`` (characters of the text).

    Whole texts are searched; notices of one text never overlap. On either side of a matched
    word a notice may hold ``room`` foreign words for each word of its template, or ten if that is more. Null and empty texts have
    none. Rows that repeat an id are searched each. An empty table gives no rows; other
    columns are not read.
    """
    if not 0.5 < coverage <= 1:
        raise ValueError("coverage must be over 0.5 and at most 1")
    templates = [Template.of(name, text, coverage) for name, text in licenses.items()]
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([notices(t.as_py(), templates, coverage, room) for t in batch.column(1)], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["id", "found"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {id_type}, found array<struct<license:string,coverage:double,start:bigint,end:bigint>>"
    return rows.mapInArrow(scan, schema).select("id", F.inline("found"))
