"""Vectorised handling of whole texts inside tasks: bytes, words and shingles in numpy.

Texts come as Arrow columns and are taken in slices of about a megabyte, so a task
needs memory for a slice (or for one very long text), not for a batch. NULL is an
empty text here.
"""

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE_BYTES = 1_000_000
_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BASE = 0x9E3779B97F4A7C13


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, one after another, and where each row starts; NULL is empty."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes; a longer text is a run of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + (np.uint64(seed) << np.uint64(32))
    return mix(steps * np.uint64(0x9E3779B97F4A7C15))


def release_memory() -> None:
    """Give memory that is free in this process back: workers live on for tasks of other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + size - 1`` of each pair, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct byte strings of the spans, and for each span the number of its own. Bytes are
    compared, not hashes of them."""
    sizes = ends - starts
    places = np.append(0, np.cumsum(sizes)).astype(np.int64)
    buffers = [None, pa.py_buffer(places), pa.py_buffer(data[ragged(starts, sizes)])]
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), buffers)
    coded = strings.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


class RollingHash:
    """64-bit polynomial hashes of any substrings of a byte array, by differences of prefix sums.

    For strings of some hundred bytes only: modulo a power of two there are pairs of strings of 1,024
    bytes that every base and table takes for equal.
    """

    def __init__(self, seed: int = 1):
        self.table = random_words(256, seed)
        inverse = pow(_BASE, -1, 1 << 64)
        self.base, self.inverse = np.uint64(_BASE), np.uint64(inverse)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def prepare(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of the bytes."""
        n = len(data) + 1
        if len(self.powers) < n:
            steps = np.full(max(n, 2 * len(self.powers)), self.base)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
            steps[1:] = self.inverse
            self.inverses = np.multiply.accumulate(steps)
        sums = np.zeros(n, np.uint64)
        np.cumsum(self.table[data] * self.inverses[: n - 1], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.powers[start])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+`` of the rows."""
    table = np.ones(256, bool)
    table[list(_SPACE)] = False
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = table[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    before[offsets] = False  # a row's first byte begins a word
    after = inside.copy()
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside[:-1] & ~after[1:]) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_hashes(words: pa.Array, seed: int) -> np.ndarray:
    """64 bits of the BLAKE2b of each word."""
    salt = seed.to_bytes(8, "little")
    digests = [hashlib.blake2b(word, digest_size=8, salt=salt).digest() for word in words.to_pylist()]
    return np.frombuffer(b"".join(digests), np.uint64)


def shingles(
    data: np.ndarray, offsets: np.ndarray, words: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``words`` words, in lower case (A-Z), repeats included.

    A row with fewer words has one shingle, its whole sequence; without words, none.
    Rows come in order. Each distinct word is hashed once, with ``seed``.
    """
    lower = lower_ascii(data)
    starts, ends, rows = word_spans(lower, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    names, numbers = distinct_spans(lower, starts, ends)
    word = word_hashes(names, seed)[numbers]
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    firsts = np.cumsum(counts) - counts
    sizes = np.minimum(counts, words)  # words of a shingle
    heads = np.maximum(counts - words + 1, np.minimum(counts, 1))  # shingles of a row
    row = np.repeat(np.arange(len(counts)), heads)
    at = firsts[row] + np.arange(len(row)) - np.repeat(np.cumsum(heads) - heads, heads)
    factors = random_words(words, 77) | np.uint64(1)
    out = sizes[row].astype(np.uint64)
    for i in range(words):
        there = np.minimum(at + i, len(word) - 1)
        out = out + np.where(i < sizes[row], word[there] * factors[i], np.uint64(0))
        out = mix(out)
    return out, row


def distinct_by_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, sorted by row and value."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], rows[new]
