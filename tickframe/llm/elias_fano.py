"""Elias-Fano sequences and a two-level n-gram trie on them, laid out flat so that a file or buffer can be mapped."""

from __future__ import annotations

import numpy as np

_HEAD = 4  # words: number of values, low bits, words of low bits, bytes of high bits


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit values in about ``2 + log2(universe / n)`` bits each.

    The low bits are packed; the high bits are unary, so the values with one high part are found by selecting
    two zeros, and a search only compares low bits among them."""

    def __init__(self, buffer, at: int = 0):
        n, self.low_bits, low_words, high_bytes = np.frombuffer(buffer, np.int64, _HEAD, at).tolist()
        self.n = n
        at += 8 * _HEAD
        self.low = np.frombuffer(buffer, np.uint64, low_words, at)
        at += 8 * low_words
        high = np.frombuffer(buffer, np.uint8, high_bytes, at)
        self.end = at + -(-high_bytes // 8) * 8
        zeros = np.flatnonzero(np.unpackbits(high) == 0)
        # first[h]: number of values whose high part is below h
        self.first = np.r_[0, zeros - np.arange(len(zeros))]

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> bytes:
        n = len(values)
        bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        bits = min(bits, 63)
        low = values & np.uint64((1 << bits) - 1)
        words = np.zeros(n * bits // 64 + 2, np.uint64)
        if n and bits:
            place = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            words[word[start]] |= np.bitwise_or.reduceat(low << shift, start)
            over = np.flatnonzero(shift + np.uint64(bits) > np.uint64(64))  # at most one value crosses each word's end
            words[word[over] + 1] |= low[over] >> (np.uint64(64) - shift[over])
        part = (values >> np.uint64(bits)).astype(np.int64)
        unary = np.zeros(n + (int(part[-1]) if n else 0) + 1, np.uint8)
        unary[part + np.arange(n)] = 1
        high = np.packbits(unary)  # padding bits read as further zeros
        head = np.array([n, bits, len(words), len(high)], np.int64)
        return b"".join([head.tobytes(), words.tobytes(), high.tobytes(), bytes(-len(high) % 8)])

    def low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        place = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        value = self.low[word] >> shift
        value |= np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return value & np.uint64((1 << self.low_bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        high = np.searchsorted(self.first, i, side="right") - 1
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self.low_at(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The index of each value, -1 where it is not in the sequence: the successor, if it is equal."""
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        inside = high < len(self.first) - 1
        high = np.where(inside, high, 0)
        lo, end = self.first[high], np.where(inside, self.first[np.minimum(high + 1, len(self.first) - 1)], 0)
        lo = np.where(inside, lo, 0)
        hi = end.copy()
        low = values & np.uint64((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):  # first index whose low bits reach the wanted ones
            middle = (lo[open_] + hi[open_]) >> 1
            less = self.low_at(middle) < low[open_]
            lo[open_] = np.where(less, middle + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], middle)
            open_ = open_[lo[open_] < hi[open_]]
        out = np.full(len(values), -1, np.int64)
        there = np.flatnonzero(lo < end)
        there = there[self.low_at(lo[there]) == low[there]]
        out[there] = lo[there]
        return out


class Trie:
    """Level 1: words, with a pointer to their range in level 2 and a value; level 2: (word, neighbour), a value.

    A neighbour is stored relative to its word: the sequence holds ``word's index * 2^bits + neighbour``, which
    grows, and a search looks for its successor within the word's range.  Values are quantised to 16 bits."""

    def __init__(self, buffer):
        self.bits, v1, v2 = np.frombuffer(buffer, np.int64, 3).tolist()
        self.scale = np.frombuffer(buffer, np.float64, 2, 24)
        self.words = EliasFano(buffer, 40)
        self.pointers = EliasFano(buffer, self.words.end)
        self.pairs = EliasFano(buffer, self.pointers.end)
        at = self.pairs.end
        self.value1 = np.frombuffer(buffer, np.uint16, v1, at)
        self.value2 = np.frombuffer(buffer, np.uint16, v2, at + -(-2 * v1 // 8) * 8)

    @staticmethod
    def pack(words: np.ndarray, pair_word: np.ndarray, neighbour: np.ndarray, value1: np.ndarray, value2: np.ndarray, bits: int) -> bytes:
        """``words``: sorted; ``pair_word``: indices into them, sorted together with ``neighbour`` (< 2^bits)."""
        both = np.concatenate([value1, value2])
        lo = float(both.min()) if len(both) else 0.0
        step = (float(both.max()) - lo) / 65535 if len(both) else 0.0
        quantised = lambda v: np.round((v - lo) / (step or 1.0)).astype(np.uint16).tobytes()
        ends = np.searchsorted(pair_word, np.arange(len(words) + 1))
        pairs = (pair_word.astype(np.uint64) << np.uint64(bits)) | neighbour
        q1, q2 = quantised(value1), quantised(value2)
        return b"".join([
            np.array([bits, len(value1), len(value2)], np.int64).tobytes(), np.array([lo, step]).tobytes(),
            EliasFano.pack(words, 1 << 64), EliasFano.pack(ends.astype(np.uint64), len(pairs) + 1),
            EliasFano.pack(pairs, max(1, len(words)) << bits), q1, bytes(-len(q1) % 8), q2])

    def word(self, words: np.ndarray) -> np.ndarray:
        return self.words.find(words)

    def word_value(self, index: np.ndarray) -> np.ndarray:
        return self.scale[0] + self.scale[1] * self.value1[index]

    def pair(self, index: np.ndarray, neighbour: np.ndarray) -> np.ndarray:
        """Index of (word, neighbour) in level 2, or -1."""
        found = np.full(len(index), -1, np.int64)
        known = np.flatnonzero(index >= 0)
        found[known] = self.pairs.find((index[known].astype(np.uint64) << np.uint64(self.bits)) | neighbour[known])
        return found

    def pair_value(self, index: np.ndarray) -> np.ndarray:
        return self.scale[0] + self.scale[1] * self.value2[index]

    def children(self, index: np.ndarray) -> np.ndarray:
        return (self.pointers[index + 1] - self.pointers[index]).astype(np.int64)
