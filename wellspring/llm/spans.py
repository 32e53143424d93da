"""Span lists of a text: order, digest and text form shared by the detectors."""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from itertools import accumulate

Span = tuple[int, int, int]  # start, kind (place in the list of kinds), end


def listed(spans: Sequence[Span], kinds: Sequence[str]) -> str:
    """kind:start:end by start, then kind, comma-joined."""
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Covered:
    """Spans sorted by start, to look up by place without going through all of them."""

    def __init__(self, spans: Sequence[Span]):
        self.spans = spans
        self.starts = [a for a, _, _ in spans]
        self.ends = [0, *accumulate((b for _, _, b in spans), max)]  # the greatest end of the first i spans

    def clear(self, start: int, end: int) -> bool:
        return self.ends[bisect_left(self.starts, end)] <= start

    def overlapping(self, start: int, end: int) -> list[Span]:
        near = self.spans[max(0, bisect_right(self.ends, start) - 1) : bisect_left(self.starts, end)]
        return [s for s in near if s[2] > start]

    def starting(self, at: int) -> Sequence[Span]:
        return self.spans[bisect_left(self.starts, at) : bisect_right(self.starts, at)]
