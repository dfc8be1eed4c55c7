"""Words and hashes of many texts at once, as numpy arrays.

Words are runs of bytes other than space and 9 to 13 of the UTF-8 text, A-Z lowered. A word's hash is a
polynomial over random byte values (modulo 2^64, taken from running sums), mixed afterwards; any part
of a word is hashed in the same way, so prefixes cost no second pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_RNG = np.random.default_rng(20240131)
#: One odd 64-bit value per byte, A-Z as a-z.
BYTE_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE[65:91] = BYTE_VALUE[97:123]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes that end a word where punctuation counts as space: all of ASCII but letters and digits.
IS_BREAK = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_BASE = int(_RNG.integers(1, 1 << 62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16) + 1
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of several texts in order: byte bounds, the text of each, bounds of each text's words."""

    sums: np.ndarray
    inverse: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # first[d] to first[d + 1] are the words of text d

    def hashes(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + np.uint64(salt))

    def words(self, salt: int = 0) -> np.ndarray:
        return self.hashes(self.starts, self.ends, salt)

    def prefixes(self, length: int) -> np.ndarray:
        """Hashes of the first ``length`` bytes of each word, or of all of a shorter one."""
        return self.hashes(self.starts, np.minimum(self.starts + length, self.ends), length)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(texts: list[bytes], breaks: np.ndarray = IS_SPACE) -> Words:
    """The words of the texts, ended by the bytes that ``breaks`` marks (which hold the line feed)."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, dtype=np.uint8)
    power, inverse = _power_tables(len(data) + 1)
    space = breaks[data]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * power[: len(data)], out=sums[1:])
    before = np.concatenate(([True], space[:-1]))
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    return Words(sums, inverse, starts, ends, np.searchsorted(starts, offsets))


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct ``size``-word shingles of each text as 64-bit hashes.

    A text of fewer words has its whole sequence as one shingle; a text without words has none.
    """
    found = words_of(texts)
    word = found.words()
    n = len(word)
    rolled = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        rolled += word[k:n - size + 1 + k] * np.uint64(2 * pow(7919, k + 1, 1 << 62) + 1)
    rolled = mix(rolled)
    sets = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            value = np.full(1, b - a, dtype=np.uint64)
            for k in range(a, b):
                value = mix(value * np.uint64(3) + word[k:k + 1])
            sets.append(value)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


class Lookup:
    """Places of 64-bit hashes in a sorted array of keys; most unknown hashes end at one look."""

    BITS = 20

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        slots = (keys >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.begin = np.searchsorted(slots, np.arange((1 << self.BITS) + 1)).astype(np.int32)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, ``len(keys)`` for an unknown one."""
        places = np.full(hashes.size, len(self.keys), dtype=np.int32)
        wanted = hashes.reshape(-1)
        slot = (wanted >> np.uint64(64 - self.BITS)).astype(np.int32)
        low, high = self.begin[slot], self.begin[slot + 1]
        left = np.flatnonzero(low < high)
        while len(left):
            at = low[left]
            hit = self.keys[at] == wanted[left]
            places[left[hit]] = at[hit]
            low[left] += 1
            left = left[~hit & (at + 1 < high[left])]
        return places.reshape(hashes.shape)
