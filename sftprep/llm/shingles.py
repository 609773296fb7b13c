"""Hashes of word shingles, computed for a whole text at once with numpy."""

from __future__ import annotations

import numpy as np

# A-Z in lower case, every ASCII blank as a space; other bytes, UTF-8 included, as they are
_LOWER = bytes(32 if i in b" \t\n\x0b\x0c\r" else i + 32 if 65 <= i <= 90 else i for i in range(256))
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_STRETCH = 1 << 20  # bytes hashed at a time


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of the root and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_ROOT), -1, 1 << 64))
            for name, base in (("up", _ROOT), ("down", inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every run of bytes between spaces."""
    chars = np.frombuffer(data, dtype=np.uint8)
    inside = np.empty(len(chars) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.not_equal(chars, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers.of(len(chars) + 1)
    sums = np.zeros(len(chars) + 1, dtype=np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word of the text (A-Z in lower case, words between ASCII blanks)."""
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER)
    if len(data) <= _STRETCH:
        return hashed_words(data)[0]
    parts, start = [], 0
    while start < len(data):
        end = start + _STRETCH
        if end < len(data):
            blank = data.rfind(b" ", start, end)
            end = blank if blank > start else data.find(b" ", end)
            end = len(data) if end < 0 else end
        parts.append(hashed_words(data[start:end])[0])
        start = end
    return np.concatenate(parts)


def shingle_set(text: str, size: int) -> np.ndarray:
    """The distinct hashes of runs of ``size`` words, sorted; a shorter text is one run."""
    words = word_hashes(text)
    if not len(words):
        return words
    run = min(size, len(words))
    n = len(words) - run + 1
    total = np.full(n, np.uint64(run), dtype=np.uint64)
    for i in range(run):
        total = mix(total * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n])
    return np.unique(total)
