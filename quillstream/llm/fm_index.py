"""A compressed FM-index over word symbols, in numpy.

The index holds the Burrows-Wheeler transform of a symbol sequence as a wavelet
matrix (bit vectors with counted blocks). Suffixes are ordered by their first 64
symbols, which is all that patterns up to that length need. Matching statistics
are capped at a depth: for every position of a streamed sequence, the interval
of suffixes that agree with it for ``depth`` symbols. Backward search extends the
interval of the next position by one symbol; the last symbol is then dropped by
widening to the block of suffixes that agree for ``depth`` symbols. Many
sequences advance together, one numpy step for all.
"""

from __future__ import annotations

import numpy as np

#: Symbols by which suffixes are ordered.
CONTEXT = 64


class BitVector:
    """Bits in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(len(bits) // 64 * 64 + 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of symbols over a sequence of numbers below ``symbols``."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits = []
        now = sequence
        for level in range(self.levels - 1, -1, -1):
            one = (now >> level & 1).astype(bool)
            self.bits.append(BitVector(one))
            now = np.concatenate([now[~one], now[one]])
        # where each symbol's run begins in the bottom order, also of symbols that do not occur
        self.first = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._descend(symbol, at) - self.first[symbol]

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place in the bottom order of a place in the sequence, following a symbol's bits."""
        for level, bits in zip(range(self.levels - 1, -1, -1), self.bits):
            ones = bits.ones(at)
            at = np.where(symbol >> level & 1, bits.zeros + ones, at - ones)
        return at


def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, dense rank) of keys."""
    order = np.argsort(key)
    ranked = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))
    return order, rank


def _ahead(rank: np.ndarray, by: int) -> np.ndarray:
    """Rank of the suffix ``by`` symbols later; 0 past the end."""
    out = np.zeros(len(rank), np.int64)
    if by < len(rank):
        out[:-by] = rank[by:] + 1
    return out


class FMIndex:
    """Index of a sequence of symbols; symbol 0 separates its parts and is in no pattern."""

    def __init__(self, sequence: np.ndarray, depth: int):
        if not 1 <= depth < CONTEXT:
            raise ValueError(f"depth must be below {CONTEXT}")
        n, self.depth = len(sequence), depth
        _, rank = _ranks(sequence)
        size, deep = 1, None
        while True:
            if size <= depth < 2 * size:  # suffixes agree for depth symbols where both parts do
                deep = rank * (n + 1) + (_ahead(rank, depth - size) if depth > size else 0)
            order, rank = _ranks(rank * (n + 1) + _ahead(rank, size))
            size *= 2
            if size >= CONTEXT:
                break
        last = sequence[order - 1]  # the symbol before each suffix
        symbols = int(sequence.max()) + 1 if n else 1
        self.wavelet = WaveletMatrix(last, symbols)
        count = np.bincount(sequence, minlength=symbols)
        self.below = np.cumsum(count) - count
        starts = np.append(True, deep[order][1:] != deep[order][:-1]) if n else np.zeros(0, bool)
        block = np.cumsum(starts) - 1
        bound = np.append(np.flatnonzero(starts), n)
        self.low, self.high = bound[block], bound[block + 1]
        self.size = n

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with a symbol put in front: one backward step."""
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.below[symbol]
        return base + both[:len(low)], base + both[len(low):]

    def occurrences(self, sequence: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each position of parts ``sequence[start:end]`` of indexed sequences, how
        many suffixes agree with it for ``depth`` symbols; 0 where the part is shorter."""
        out = np.zeros(len(sequence), np.int64)
        order = np.argsort(start - end, kind="stable")  # longest first: those still running are a prefix
        start, at = start[order], end[order] - 1
        low, high = np.zeros(len(at), np.int64), np.full(len(at), self.size)
        steps = 0
        while len(at):
            low, high = self.extend(sequence[at], low, high)
            steps += 1
            if steps >= self.depth:
                low, high = self.low[low], self.high[low]  # drop the symbol beyond the depth
                out[at] = high - low
            at = at - 1
            running = int((at >= start).sum())
            at, start, low, high = at[:running], start[:running], low[:running], high[:running]
        return out
