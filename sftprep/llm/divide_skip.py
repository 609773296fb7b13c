"""T-occurrence search over inverted lists: merge the short ones with a heap, probe the long ones."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np

PROBE_COST = 0.05  # of one step of a binary search, against a step of the merge


class InvertedLists:
    """For each value of some sets, the places of the sets that hold it, rising."""

    def __init__(self, sets: Sequence[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        values = np.concatenate([*sets, np.empty(0, np.uint64)])
        order = np.argsort(values, kind="stable")
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.values, self.starts = np.unique(values[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(values))

    def of(self, query: np.ndarray, wanted: np.ndarray | None = None) -> list[list[int]]:
        """The lists of the values of ``query`` (sorted), as far as they name ``wanted`` sets; no empty ones."""
        at = np.searchsorted(self.values, query)
        at = at[: np.searchsorted(at, len(self.values))]
        at = at[self.values[at] == query[: len(at)]]
        sizes = self.ends[at] - self.starts[at]
        upto = np.cumsum(sizes)
        members = self.owners[np.arange(upto[-1] if len(at) else 0) + np.repeat(self.starts[at] - (upto - sizes), sizes)]
        if wanted is not None:
            kept = wanted[members]
            members, sizes = members[kept], np.bincount(np.repeat(np.arange(len(at)), sizes)[kept], minlength=len(at))
            sizes = sizes[sizes > 0]
        flat, ends = members.tolist(), np.cumsum(sizes).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def divide_skip(lists: list[list[int]], least: int, needed: Sequence[int]) -> Iterator[int]:
    """Members that stand on ``needed[member]`` lists or more; that is never below ``least``.

    The longest lists, fewer than ``least`` of them, are set aside. A member that counts stands on at
    least ``merge`` of the short ones, so the merge may jump over all that do not; those it
    finds are looked up in the long lists, until they have enough or cannot get there.
    """
    if not 0 < least <= len(lists):
        return
    lists = sorted(lists, key=len)
    aside = min(least - 1, int(least / (PROBE_COST * math.log2(len(lists[-1])) + 1)))
    short, long_lists = lists[: len(lists) - aside], lists[len(lists) - aside :]
    merge, at = least - aside, [0] * (len(lists) - aside)
    heap = [(members[0], i) for i, members in enumerate(short)]
    heapify(heap)
    while len(heap) >= merge:
        member, popped = heap[0][0], []
        while heap and heap[0][0] == member:
            popped.append(heappop(heap)[1])
        if len(popped) >= merge:
            found, want, left = len(popped), needed[member], len(long_lists)
            for members in long_lists:
                if found >= want or found + left < want:
                    break
                left -= 1
                i = bisect_left(members, member)
                found += i < len(members) and members[i] == member
            if found >= want:
                yield member
            following = member + 1
        else:
            popped += [heappop(heap)[1] for _ in range(merge - 1 - len(popped))]
            if not heap:
                return
            following = heap[0][0]
        for i in popped:
            at[i] = bisect_left(short[i], following, at[i])
            if at[i] < len(short[i]):
                heappush(heap, (short[i][at[i]], i))
