"""Words of many texts at once: numpy views over the bytes of an Arrow text column.

A word is a maximal run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return. All of these are ASCII, so words of UTF-8 text are never cut inside a character.
"""

import hashlib

import numpy as np
import pyarrow as pa

SPACES = " \t\n\x0b\x0c\r"
#: The same words for Java and DuckDB patterns.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES.encode())] = True
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Words longer than this are hashed one by one.
_LONG = 256


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins (one more entry ends the last); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column) or starts[-1] == starts[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0]:starts[-1]], starts - starts[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """``A`` to ``Z`` in lower case; every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each text (one more entry)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters all bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    lengths = ends - starts
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    lanes = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))
    out = mix(lengths.astype(np.uint64) + _STEP)
    left, at, rows = lengths, starts, None
    short = np.flatnonzero(lengths <= _LONG)
    if len(short) < len(lengths):
        for i in np.flatnonzero(lengths > _LONG):
            digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
            out[i] = np.frombuffer(digest, np.uint64)[0]
        left, at, rows = lengths[short], starts[short], short
    while len(left):
        lane = lanes[at]
        cut = (8 - np.minimum(left, 8)).astype(np.uint64) * np.uint64(8)
        lane = (lane << cut) >> cut
        if rows is None:
            out = mix(out * _STEP + lane)
        else:
            out[rows] = mix(out[rows] * _STEP + lane)
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        left, at = left[more] - 8, at[more] + 8
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive hashes, by the place of the first; too few give none.

    A polynomial in an odd number modulo 2**64, taken from running sums; the factor of the place is divided out.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = np.full(len(hashes), _STEP, np.uint64)
    power[0] = 1
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(power, dtype=np.uint64), dtype=np.uint64, out=sums[1:])
    power[1:] = pow(int(_STEP), -1, 1 << 64)
    return mix((sums[width:] - sums[:-width]) * np.cumprod(power, dtype=np.uint64)[:n] + np.uint64(width))


def pieces(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of whole texts with about ``limit`` bytes each (a longer text has its own)."""
    out, first, n = [], 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        out.append((first, min(last, n)))
        first = out[-1][1]
    return out
