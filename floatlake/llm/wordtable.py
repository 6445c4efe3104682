"""Words of many texts as numpy arrays, and their hashes."""

from __future__ import annotations

import numpy as np

#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_ODD = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)
_powers = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        if n <= 1 << 23:
            _powers[base] = table
    return table[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    x = x + np.uint64((seed * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, by prefix sums."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power_table(base, n), out=sums[1:])
    return (sums[ends] - sums[starts]) * _power_table(pow(base, -1, 2**64), n + 1)[starts]


class WordTable:
    """Maximal runs of other bytes than white space, over UTF-8 texts laid end to end.

    `start` and `end` are byte positions of words, `first` and `count` the words of each text.
    """

    def __init__(self, texts: list[bytes]) -> None:
        self.bytes = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_end = np.cumsum(lengths + 1)
        self.text_start = self.text_end - lengths - 1
        gap = SPACE[self.bytes]
        edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edges = np.concatenate(([0], edges))
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.text_start)
        self.count = np.searchsorted(self.start, self.text_end) - self.first
        self.text_of = np.repeat(np.arange(len(texts)), self.count)

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        return mix(_stretches(_BYTES[self.bytes], self.start, self.end, _ODD))

    def fits(self, length: int) -> np.ndarray:
        """Whether the window of `length` words that starts at a word ends in the same text."""
        last = (self.first + self.count)[self.text_of]
        return np.arange(len(self.start)) + length <= last


def windows(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of every `length` consecutive word hashes; entry i starts at word i."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    starts = np.arange(len(hashes) - length + 1)
    base = (_ODD * (2 * seed + 3)) % 2**64
    return mix(_stretches(hashes, starts, starts + length, base), seed + length)


def window_minimum(values: np.ndarray, length: int) -> np.ndarray:
    """Smallest of every `length` consecutive values, by doubling."""
    if len(values) < length:
        return values[:0]
    span = 1
    while 2 * span <= length:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = length - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values
