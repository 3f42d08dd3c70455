"""Words and word hashes of whole Arrow text columns, as numpy arrays.

A batch of texts is one byte array with row offsets. Word borders are found
with a 256-entry table (0: separator, else the folded byte), so nothing runs
per row or per word in Python. Separators are ASCII bytes, and bytes of a
multi-byte UTF-8 character are all >= 0x80, so working on bytes is exact.

Word hash: sum of random 64-bit byte values times odd powers (mod 2**64),
from running sums, shifted to the word's start and mixed. Hashes select
candidates; callers that need exact answers compare the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Texts are worked on in slices of about this many bytes (one longer text makes a slice of its own).
SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, SLICE_BYTES + 1), dtype=np.uint64)
        have[1:] = U(base)
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def whitespace_words() -> np.ndarray:
    """Fold table for words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. NUL is a word byte and gets a value of its own below."""
    table = np.arange(256, dtype=np.uint16)
    table[65:91] += 32
    table[0] = 256
    table[[32, 9, 10, 11, 12, 13]] = 0
    return table


def alphanumeric_words() -> np.ndarray:
    """Fold table for words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    table = np.arange(256, dtype=np.uint16)
    table[65:91] += 32
    for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        table[low : high + 1] = 0
    return table


class Texts(NamedTuple):
    """Rows ``first`` .. of a batch: bytes and row offsets (row i: data[offsets[i]:offsets[i+1]])."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Words of ``Texts``: byte borders, row, hash; ``bounds[i]:bounds[i+1]`` are the words of row i."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The column's texts (null: empty) in slices of about ``limit`` bytes."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield Texts(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def borders(texts: Texts, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each word, the byte behind it, and the words of each row, as in ``Words``."""
    data, offsets = texts.data, texts.offsets
    inside = (fold != 0)[data]
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    before[filled] = False
    after[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def words(texts: Texts, fold: np.ndarray) -> Words:
    start, end, bounds = borders(texts, fold)
    data, n = texts.data, len(texts.data)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    value = _BYTE[fold & 255][data]
    value *= powers(_BASE, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    h = (total[end] - total[start]) * powers(_INVERSE, n + 1)[start]
    return Words(start, end, row, mix(h + (end - start).astype(np.uint64)), bounds)


def grams(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-grams that start at each word, and whether the k words are of one row."""
    n = len(hashes)
    if n < k:
        return np.zeros(n, np.uint64), np.zeros(n, bool)
    out = np.zeros(n, np.uint64)
    top = n - k + 1
    acc = np.zeros(top, np.uint64)
    for j in range(k):
        acc = acc * U(0x2545F4914F6CDD1D) + hashes[j : top + j]
    out[:top] = mix(acc)
    counts = np.diff(bounds)
    left = np.repeat(bounds[1:], counts) - np.arange(n)  # words from here to the row's end
    return out, left >= k
