"""Rolling hashes of words, windows and byte strings over flat arrays of many documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_MULTIPLIERS = (_U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95))
#: Text of so many bytes is worked on at a time; a longer document is worked on alone.
SLICE_BYTES = 2_000_000
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(size: int, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier modulo 2^64, and of its inverse."""
    if lane not in _TABLES or len(_TABLES[lane][0]) < size:
        m = int(_MULTIPLIERS[lane])
        up, down = (np.full(max(size, 1 << 16), _U(x), _U) for x in (m, pow(m, -1, 1 << 64)))
        up[0] = down[0] = 1
        _TABLES[lane] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _TABLES[lane]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; different values stay different."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Rolling:
    """Hash of any range of a sequence of non-zero values, equal for equal ranges wherever they stand."""

    def __init__(self, values: np.ndarray, lane: int = 0):
        up, self.down = _powers(len(values) + 1, lane)
        self.sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values.astype(_U) * up[: len(values)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all windows of one length, in order; at least one must fit."""
        number = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:number]) * self.down[:number])


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` values in a row."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def text_slices(texts, limit: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of a column of texts of about `limit` characters, and their texts; only these are encoded at a time."""
    for a, b in slices(texts.fillna("").tolist(), limit):
        yield a, b, [b"" if t is None else t.encode() for t in texts.iloc[a:b]]


class Words:
    """Words of several documents: `doc` is the place of the document of each word, `value` the word's hash."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        inside = np.zeros(len(data) + 1, bool)
        np.logical_not(_SEPARATOR[data], out=inside[1:])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[0::2], edges[1::2]
        if len(end) < len(start):
            end = np.r_[end, len(data)]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.doc = np.searchsorted(begins, start, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(texts))
        self.value = Rolling(data.astype(_U) + _U(1)).ranges(start, end) if len(start) else np.zeros(0, _U)

    def windows(self, length: int, lane: int = 0) -> np.ndarray:
        """Hash of the window at each word but the last ones; some reach into the next document."""
        if len(self.value) < length:
            return np.zeros(0, _U)
        return Rolling(self.value | _U(1) if lane else self.value, lane).windows(length)

    def whole(self, length: int) -> np.ndarray:
        """Which windows lie in one document."""
        if len(self.doc) < length:
            return np.zeros(0, bool)
        return self.doc[length - 1 :] == self.doc[: len(self.doc) - length + 1]
