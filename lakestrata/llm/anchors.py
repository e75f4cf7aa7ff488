"""Windows of a sequence in groups: all windows that share their least k-gram hash at the same place form a run.

Equal windows have their least k-gram at the same offset, so windows of different runs can only be equal if the
runs have equal anchors (the k-gram), and equal runs have equal windows throughout. A run of ``n`` windows covers
``n + width - 1`` elements, its fragment.
"""

from dataclasses import dataclass

import numpy as np

from lakestrata.llm.tokens import mix

#: Low bits of a hash that hold a place while the least is looked for.
_PLACE = np.uint64((1 << 28) - 1)
_FACTOR = 0x9E3779B97F4A7C15


class Spans:
    """64-bit hashes of any stretches of a sequence of 64-bit values, by a polynomial modulo 2**64."""

    def __init__(self, values: np.ndarray):
        power = np.full(len(values) + 1, _FACTOR, np.uint64)
        power[0] = 1
        np.cumprod(power, dtype=np.uint64, out=power)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[:-1], dtype=np.uint64, out=self.sums[1:])
        power[:] = pow(_FACTOR, -1, 1 << 64)
        power[0] = 1
        self.inverse = np.cumprod(power, dtype=np.uint64, out=power)

    def windows(self, width: int) -> np.ndarray:
        """The hash of every stretch of ``width`` values."""
        n = max(len(self.sums) - width, 0)
        return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n] + np.uint64(width))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


@dataclass
class Runs:
    """What is known of each run."""

    anchor: np.ndarray  # hash of the anchor
    fragment: np.ndarray  # hash of all elements
    text: np.ndarray
    first: np.ndarray  # place of the first window in the text
    number: np.ndarray  # of windows
    lead: np.ndarray  # elements from the first window's start to the anchor


def runs(spans: Spans, offsets: np.ndarray, width: int, k: int) -> Runs:
    """The runs of all windows of ``width`` elements that lie inside a text (``offsets`` begin the texts)."""
    sizes = np.diff(offsets)
    total = int(offsets[-1])
    if total < width or not (sizes >= width).any():
        empty = np.zeros(0, np.int64)
        return Runs(empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty, empty)
    grams = spans.windows(k)
    tagged = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    anchors = (sliding_least(tagged, width - k + 1) & _PLACE).astype(np.int64)
    change = np.zeros(total + 1, np.int8)
    long = sizes >= width
    change[offsets[:-1][long]] = 1
    change[offsets[1:][long] - width + 1] = -1  # a text of exactly this end may begin the next one's windows
    inside = np.flatnonzero(np.cumsum(change, dtype=np.int8)[:len(anchors)])
    at = anchors[inside]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(inside) != 1)]))
    first = inside[new]
    number = np.diff(np.concatenate([new, [len(inside)]]))
    text = np.searchsorted(offsets, first, "right") - 1
    return Runs(
        grams[at[new]], spans.hashes(first, first + number + width - 1), text, first - offsets[text], number, at[new] - first)
