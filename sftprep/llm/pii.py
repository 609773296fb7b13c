"""Personal data in whole texts: fixed patterns, and a semi-Markov CRF for what they miss.

The patterns find e-mail addresses, IP addresses, payment cards and phone numbers. The field
is trained on what they find in a bounded sample of texts. It reads stretches with digits or
an at sign, scores whole candidate spans (shape, digit groups, check digit, what stands
beside them) and chooses boundaries and types together. Its spans are added where no pattern
has matched and it is sure; spans of the patterns always stay.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import semi_crf
from .common import write_through

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 2_000  # texts with digits or an at sign that the field is trained on, at most
SAMPLE_BYTES = 32_768  # longer texts are searched like all others, but not learned from
STRETCHES = 1_500  # stretches used in training, at most
REACH = 48  # characters to each side of a digit or at sign that a stretch may take in
LONGEST_CHARS = 64
WINDOW = 2_048  # characters of a stretch that are cut into spans at a time
ROWS = 1 << 14  # hashed features
SURE = 1.0  # log-odds against leaving the span outside

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never begins inside a run of digits, so the look-behind changes nothing but the cost
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from the at signs: linear even in very long words."""
    free, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def pattern_spans(text: str) -> list[Span]:
    """What the fixed patterns find, by start, then kind."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _SIGNAL.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 37:  # 19 digits and 18 separators
                digits = _digits(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold digits or an at sign, taken to the next blanks; neighbours are one."""
    begin = end = -1
    for m in _SIGNAL.finditer(text):
        if m.start() < end:
            continue
        a, b = m.start(), m.end()
        while a > 0 and m.start() - a < REACH and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and b - m.end() < REACH and not text[b].isspace():
            b += 1
        if end >= 0 and a <= end + 1:
            end = b
            continue
        if end >= 0:
            yield begin, end
        begin, end = a, b
    if end >= 0:
        yield begin, end


def windows(begin: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """A stretch in windows of bounded length: (from, to, first start, start after the last).

    A window answers for the spans that begin in the last two places. These end inside it,
    and neighbours overlap by the longest span on both sides of where the answers change.
    """
    first = begin
    while end - begin > WINDOW:
        change = begin + WINDOW - LONGEST_CHARS
        yield begin, begin + WINDOW, first, change
        first, begin = change, change - LONGEST_CHARS
    yield begin, end, first, end


def _kind_of(c: str) -> str:
    return "" if not c else "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c if c in ".-+@()/:=" else "."


def _features(text: str, a: int, b: int) -> list[str]:
    span = text[a:b]
    shape = re.sub(r"[0-9]", "9", re.sub(r"[A-Za-z]+", "a", span))
    digits = _digits(span)
    only = set(span) - set("0123456789")
    parts = span.split(".")
    octets = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts)
    card = only <= set(" -") and 14 <= len(digits) <= 19
    name, at, domain = span.partition("@")
    mail = bool(at and name and "@" not in domain and re.fullmatch(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", domain))
    left, right = _kind_of(text[a - 1 : a]), _kind_of(text[b : b + 1])
    before = text[max(0, a - 24) : a].split()
    return [
        "bias",
        f"shape {shape[:40]}",
        f"groups {re.sub('[^9]+', '-', shape)[:40]}",
        f"digits {len(digits)} {span[:1] == '+'} {sorted(only)[:6] if len(only) < 6 else 'many'}",
        f"digits {min(len(digits), 20)} {span[:1] == '+'}",
        f"other {'letters' if any(c.isalpha() for c in only) else ''.join(sorted(only))[:8]}",
        f"octets {octets} {len(parts)} {right == '.'} {left == '.'}",
        f"card {card} {card and luhn(digits)} {left} {right}",
        f"mail {mail} {left in ('a', '9', '.', '-', '+')} {right in ('a', '9', '-')}",
        f"sides {left} {right}",
        f"left {left} {_kind_of(span[:1])}",
        f"right {_kind_of(span[-1:])} {right}",
        f"length {min((b - a) // 4, 12)}",
        f"before {before[-1].lower() if before else ''}",
    ]


def sequence(text: str, begin: int, end: int, truth: list[Span] | None = None) -> tuple[semi_crf.Sequence_, list[int]]:
    """Candidates of a stretch, and where its tokens begin (and the last ends)."""
    places = [m.start() for m in _TOKEN.finditer(text, begin, end)] + [end]
    known = {(a, b): KINDS.index(kind) for kind, a, b in truth or ()}
    spans, rows, true = [], [], {}
    n = len(places) - 1
    signal = np.cumsum([0] + [len(_digits(text[a:b])) + 7 * ("@" in text[a:b]) for a, b in zip(places, places[1:], strict=False)])
    for last in range(1, n + 1):
        if text[places[last] - 1].isspace():
            continue
        for first in range(max(0, last - semi_crf.LONGEST), last):
            a, b = places[first], places[last]
            # enough digits for an address, no blank at the start, bounded length
            if signal[last] - signal[first] < 4 or text[a].isspace() or b - a > LONGEST_CHARS or b - a < 7:
                continue
            if (a, b) in known:
                true[len(spans)] = known[a, b]
            spans.append((first, last))
            rows.append([zlib.crc32(f.encode()) % ROWS for f in _features(text, a, b)])
    return semi_crf.Sequence_(n, spans, np.array(rows, dtype=np.int64).reshape(len(spans), -1 if rows else 0), true), places


def _apart(spans: list[Span]) -> list[Span]:
    """Without overlaps: earlier ones first, longer ones before shorter."""
    taken, end = [], -1
    for s in sorted(spans, key=lambda s: (s[1], -s[2])):
        if s[1] >= end:
            taken.append(s)
            end = s[2]
    return taken


def train(texts: list[str]) -> np.ndarray:
    """Weights from what the patterns find in some texts; zeros (nothing is added) without examples."""
    rng = np.random.default_rng(11)
    made, held = [], 0
    for text in texts:
        spans = _apart(pattern_spans(text))
        for begin, end in (w[:2] for s in stretches(text) for w in windows(*s)):
            inside = [s for s in spans if s[1] < end and begin < s[2]]
            seq, _ = sequence(text, begin, end, inside)
            if seq.spans and len(seq.truth) == len(inside):  # not where a border cuts a span
                made.append(seq)
                held += len(inside)
    if not held:
        return np.zeros((ROWS, len(KINDS)))
    order = rng.permutation(len(made))[:STRETCHES]
    return semi_crf.fit([made[i] for i in order], ROWS, len(KINDS))


def _covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans cover, overlapping ones as one."""
    starts, ends = [], []
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def all_spans(text: str, weights: np.ndarray | None) -> tuple[list[Span], list[Span]]:
    """(spans of the patterns, these and the ones that the field adds)."""
    base = pattern_spans(text)
    if weights is None or not weights.any():
        return base, base
    more = []
    starts, ends = _covered(base)
    for begin, end in stretches(text):
        at = bisect_right(ends, begin)
        if end - begin < 7 or (at < len(ends) and starts[at] <= begin and end <= ends[at]):
            continue  # too short, or patterns hold the whole stretch
        free = begin  # where the span before has ended
        for low, high, first, change in windows(begin, end):
            seq, places = sequence(text, low, high)
            for c, kind, odds in semi_crf.best_cut(weights, seq) if seq.spans else ():
                a, b = (places[t] for t in seq.spans[c])
                if odds < SURE or not max(first, free) <= a < change:
                    continue
                free = b
                at = bisect_right(ends, a)
                if at == len(ends) or b <= starts[at]:
                    more.append((KINDS[kind], a, b))
    return base, in_order(base + more) if more else base


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def sample_texts(docs: DataFrame, text_col: str = "text", limit: int = SAMPLE_DOCS) -> list[str]:
    """At most ``limit`` different texts with digits or an at sign, of at most SAMPLE_BYTES, by hash.

    Hashes are stored and counted, a cut is put where about twice as many as wanted lie below
    it, and the last one wanted is found among these. Only then are texts fetched, so what
    the driver gets does not grow with the table, nor with the number of tasks.
    """
    text = F.col(text_col)
    some = docs.select(text.alias("text")).filter((F.octet_length(text) <= SAMPLE_BYTES) & text.rlike("[0-9@]"))
    hashed = some.select(F.xxhash64("text").alias("hash"), "text")
    stored = write_through(hashed.select("hash"), "pii-hashes")
    share = 2 * limit / max(1, stored.agg(F.approx_count_distinct("hash", 0.02)).first()[0])
    few = stored if share >= 1 else stored.filter(F.col("hash") < int(2**64 * share) - 2**63)
    last = few.distinct().orderBy("hash").limit(limit).agg(F.max("hash")).first()[0]
    if last is None:
        return []
    chosen = hashed.filter(F.col("hash") <= last).groupBy("hash").agg(F.min("text").alias("text")).collect()
    return [r["text"] for r in sorted(chosen)]


def find_personal_data(
    docs: DataFrame, weights: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``base`` (spans of the patterns) and ``spans`` (all spans).

    Offsets are code points, the end exclusive; spans are in order of start, then kind as
    listed in KINDS. A null text counts as empty and has no spans. Texts may have any length:
    the search is linear. Other columns are not read; an empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(text.as_py(), shared.value) for text in batch.column(1)]
            lists = [
                pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in f[side]] for f in found], _ARROW_SPANS)
                for side in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["id", "base", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(search, f"id {id_type}, base {_SPANS}, spans {_SPANS}")
