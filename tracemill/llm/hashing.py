"""Hashes of words and word sequences over whole batches of text, in numpy.

Words are cut at the six ASCII white-space bytes and nowhere else. A sequence's hash is a
polynomial over its words' hashes modulo 2**64, taken from prefix sums, so that all windows
of a batch cost a few array operations whatever their length.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, extended on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 1 << 16)
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(n - 1, x, U)]))
                for x in (self.base, self.inverse)
            )

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, U)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def between(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.down[start])


BYTES = Powers(0x9DDFEA08EB382D69)
WORDS = Powers(0xC2B2AE3D27D4EB4F)


class Words:
    """The words of a list of texts: `hash` per word, `first[d]:first[d + 1]` of text d,
    byte positions `start` and `end` in `data`, where text d begins at `origin[d]`."""

    def __init__(self, texts: list[bytes]) -> None:
        joined = b"\n".join(texts)
        self.data = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.origin = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.concatenate([[False], ~SEPARATORS[self.data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        prefix = BYTES.prefix(BYTE_VALUES[self.data])
        length = (self.end - self.start).astype(U)
        self.hash = mix(BYTES.between(prefix, self.start, self.end) + length * U(0x9E3779B97F4A7C15))
        self.first = np.searchsorted(self.start, self.origin)
        self.count = np.diff(self.first)
        self.prefix = WORDS.prefix(self.hash)

    def sequences(self, size: int) -> np.ndarray:
        """Hash of the `size` words from each word on, across texts; see `within`."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, U)
        at = np.arange(n)
        return WORDS.between(self.prefix, at, at + size)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(WORDS.between(self.prefix, start, end) + (end - start).astype(U))

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def within(self, size: int) -> np.ndarray:
        """Whether the `size` words from each of `sequences` on lie in one text."""
        n = max(0, len(self.hash) - size + 1)
        text = self.text_of()
        return text[:n] == text[size - 1 : size - 1 + n]


def running_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours, by doubling."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    if have < width:
        step = width - have
        out = np.minimum(out[: len(out) - step], out[step:])
    return out


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
