"""Words of a whole Arrow batch of texts as flat numpy arrays.

Every operator that works on words shares this: a batch's UTF-8 bytes are cut
into words with one table lookup per byte, and each word gets a 64-bit hash
from prefix sums, with no Python loop over words. Bytes are hashed by a sum in
which every place of a word has a random factor of its own: whatever the texts,
two different words agree with a probability below 2**-57. (A sum of powers of
one base would make some pairs agree for certain.) ``byte_numbers`` tells words
of one batch apart by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
ASCII_SPACE = b" \t\n\x0b\x0c\r"
_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_FACTORS: dict[int, np.ndarray] = {}

#: byte tables: True where a byte belongs to a word
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(ASCII_SPACE)] = False
#: digits, ASCII letters (after folding) and every non-ASCII byte
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Flat(NamedTuple):
    """Words of consecutive rows. ``data``: the rows' bytes; ``start``/``end``:
    byte bounds of each word; ``first``: number of words before each row, one
    entry more than rows; ``offset``: byte bounds of rows; ``hash``: of words."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    hash: np.ndarray

    def row(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _factors(n: int) -> np.ndarray:
    """Random odd factors of the places in a span, at least n."""
    have = _FACTORS.get(0)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = _FACTORS[0] = mix(np.arange(size, dtype=U) * U(0xD1342543DE82EF95) + U(0x2545F4914F6CDD1D)) | U(1)
    return have


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        size = max(1 << 20, 1 << (n - 1).bit_length())
        up, down = np.full(size, _BASE, U), np.full(size, pow(_BASE, -1, 2**64), U)
        up[0] = down[0] = 1
        have = _POWERS[0] = (np.cumprod(up, dtype=U), np.cumprod(down, dtype=U))
    return have


def span_hashes(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free polynomial hash of ``symbols[start:end]`` for many short spans at
    once; symbols are hashes themselves, never raw bytes."""
    n = len(symbols)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, U)
    np.cumsum(symbols * up[:n], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offset = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offset[0]:offset[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offset - offset[0]


def slices(offset: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row stands alone."""
    low, rows = 0, len(offset) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offset, offset[low] + limit, "right")) - 1)
        yield low, high
        low = high


def cut(data: np.ndarray, offset: np.ndarray, table: np.ndarray = NOT_SPACE, fold: bool = False,
        hashed: bool = True) -> Flat:
    """Words of rows ``data[offset[i]:offset[i+1]]``: longest runs of bytes in
    ``table``; ``fold`` lower-cases A-Z first."""
    data = LOWER[data] if fold else data
    n = len(data)
    word = table[data]
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], after[-1] = False, False
        before[1:], after[:-1] = word[:-1], word[1:]
        edge = offset[(offset > 0) & (offset < n)]
        before[edge], after[edge - 1] = False, False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return Flat(data, start, end, np.searchsorted(start, offset), offset,
                byte_hashes(data, start, end) if hashed else np.zeros(0, U))


def texts(column: pa.Array, table: np.ndarray = NOT_SPACE, fold: bool = False,
          limit: int = 1 << 20, hashed: bool = True) -> Iterator[tuple[int, int, Flat]]:
    """(low row, high row, words) over a column in pieces of about ``limit`` bytes."""
    data, offset = buffers(column)
    for low, high in slices(offset, limit):
        part = offset[low:high + 1]
        yield low, high, cut(data[part[0]:part[-1]], part - part[0], table, fold, hashed)


def windows(flat: Flat, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``k`` consecutive words of one row."""
    n = len(flat.hash)
    last = np.repeat(flat.first[1:], np.diff(flat.first)) - k
    at = np.flatnonzero(np.arange(n) <= last)
    return at, span_hashes(flat.hash, at, at + k)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True for each of n positions inside any span [start, end)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:-1]) > 0


def per_row(flat: Flat, values: np.ndarray) -> np.ndarray:
    """Sum of a value per word over each row."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[flat.first])


def lines(data: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte bounds of the lines of each row, without their
    newline, and the number of lines before each row; an empty row is one line."""
    newline = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offset[:-1], newline + 1]))
    end = np.sort(np.concatenate([newline, offset[1:]]))
    first = np.searchsorted(newline, offset) + np.arange(len(offset))
    return start, end, first


def _gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all spans one after the other, place of each byte in its span, bounds of spans)."""
    bound = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=bound[1:])
    place = np.arange(bound[-1]) - np.repeat(bound[:-1], end - start)
    return data[place + np.repeat(start, end - start)], place, bound


def _other_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes' and places' values of the second hash: both differ from those of the first."""
    have = _FACTORS.get(1)
    if have is None or len(have) < n:
        have = _FACTORS[1] = mix(_factors(n)) | U(1)
    return mix(_BYTE), have


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: bool = False) -> np.ndarray:
    """Hash of bytes of spans; ``other`` gives an independent second one."""
    raw, place, bound = _gathered(data, start, end)
    longest = int((end - start).max(initial=0))
    of_byte, of_place = _other_tables(longest) if other else (_BYTE, _factors(longest))
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum(of_byte[raw] * of_place[place], out=sums[1:])
    return mix(sums[bound[1:]] - sums[bound[:-1]] + (end - start).astype(U) * U(0x9E3779B97F4A7C15))


def prefix_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, sizes: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(span numbers, hash) of all spans, and of the first ``size`` bytes of the
    longer ones for each size, from one pass over the bytes. A prefix never has
    the hash of an equal whole span."""
    raw, place, bound = _gathered(data, start, end)
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum(_BYTE[raw] * _factors(int((end - start).max(initial=0)))[place], out=sums[1:])
    out = [(np.arange(len(start)), mix(sums[bound[1:]] - sums[bound[:-1]] + (end - start).astype(U) * U(0x9E3779B97F4A7C15)))]
    for size in sizes:
        longer = np.flatnonzero(end - start > size)
        first = bound[longer]
        out.append((longer, mix(sums[first + size] - sums[first] + U(0xC2B2AE3D27D4EB4F * size & 2**64 - 1))))
    return out


def byte_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal numbers from 0 for equal spans of bytes, by the bytes themselves."""
    raw, _, bound = _gathered(data, start, end)
    spans = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bound), pa.py_buffer(np.ascontiguousarray(raw))])
    return spans.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
