"""Periodic runs of words by an enhanced suffix array (operator 11).

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that no neighbouring word extends keeping period q, at least
``max(LEAST, TIMES * q)`` words long.

1. Suffix array of each text's words by prefix doubling. The names of every
   doubling step are kept: two places have the same name in step j if and only
   if the 2**j words from there are equal, so they answer every later question
   about common words exactly.
2. LCP array from the names, and for each LCP value the interval around it
   (nearest smaller values over a table of range minima). No tree is built.
3. Branching-tandem test: two parts of an LCP interval of depth d meet at each
   of its LCP values. For the suffixes i of the smaller part, i + d and i - d are
   looked up in the inverse suffix array: if one stands in the other part, a
   square of period d begins at the lower place and can't be rotated right.
   Only smaller parts are gone through, so a text takes n log n lookups.
4. Squares are rotated left as far as the words agree, which gives whole runs.
   A square whose period is a multiple of the smallest one gives the same
   stretch; the smallest period stays.

A run of q * TIMES words holds TIMES suffixes that share q words, so intervals
with fewer suffixes, and depths over 1/TIMES of the text, are left out.

Texts are worked on in slices of some 2 MB (a longer text by itself), many short
texts at once; nothing is shuffled. Memory grows with the longest text, by some
250 bytes a word.

Defined cases: null, empty and blank texts have no word and no run. Words are
compared byte by byte, letter case included. Every row is worked on by itself,
so repeated rows and null ids do no harm. An empty table gives an empty result.
Other columns are carried in ``doc``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold.llm import arrays as A
from tripfold.llm.shared import named, prepare

#: A run has at least so many words, and so many times its period.
LEAST = 6
TIMES = 4
#: Suffixes looked up at a time.
CHUNK = 1 << 20
_FOLD = A.whitespace_words()
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
#: From the ids of a batch's rows and the word bounds of these rows: which word stands at each place.
Places = Callable[[pa.Array, np.ndarray], np.ndarray]


class Runs(NamedTuple):
    """Runs in order of start and period; starts count over all rows."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _names(symbol: np.ndarray, row: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array (rows one after the other), and the names of the 2**j words from each place, with a last one that nothing equals."""
    n = len(symbol)
    slots, order = np.arange(n), np.arange(n)
    rank, names, ahead = np.zeros(n + 1, np.int32), [], 0
    key = row * (int(symbol.max(initial=0)) + 1) + symbol
    while True:
        by = np.argsort(key, kind="stable")
        at, key = order[slots][by], key[by]
        order[slots] = at
        new = np.append(True, key[1:] != key[:-1])
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        rank[n] = -1
        names.append(rank)
        slots = slots[~(new & np.append(new[1:], True))]
        if not len(slots):
            return order, names
        ahead = max(1, 2 * ahead)
        at = order[slots]
        follow = at + ahead
        key = rank[at].astype(np.int64) * (n + 1) + np.where(follow < end[at], rank[np.minimum(follow, n)] + 1, 0)


def _common(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal words from the places a and b on, within the row."""
    at, to = a.copy(), b.copy()
    for j in reversed(range(len(names))):
        step = (names[j][at] == names[j][to]).astype(np.int64) << j
        at += step
        to += step
    return at - a


def _common_before(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of equal words before the places a < b, down to the row's first place."""
    at, to = a.copy(), b.copy()
    for j in reversed(range(len(names))):
        low = at - (1 << j)
        step = ((low >= first) & (names[j][low] == names[j][to - (1 << j)])).astype(np.int64) << j
        at -= step
        to -= step
    return a - at


def _intervals(height: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node p: the suffixes [left, right) around it whose neighbours have at least its height; of equal heights the first has the others in its right part."""
    least, mine = [height], height[nodes]
    while 2 << len(least) <= len(height) and least[-1].any():
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    left, right = nodes.copy(), nodes + 1
    for j in reversed(range(len(least))):
        low = left - (1 << j)
        left = np.where((low >= 0) & (least[j][np.maximum(low, 0)] > mine), low, left)
        fits = right < len(least[j])
        right = np.where(fits & (least[j][np.where(fits, right, 0)] >= mine), right + (1 << j), right)
    return left - 1, right


def _squares(order: np.ndarray, rank: np.ndarray, height: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of branching squares."""
    at = order[np.minimum(np.arange(len(height)), len(order) - 1)]
    nodes = np.flatnonzero((height > 0) & (TIMES * height <= (end - first)[at]))
    left, right = _intervals(height, nodes)
    use = right - left >= TIMES
    nodes, left, right = nodes[use], left[use], right[use]
    lower = nodes - left <= right - nodes  # the left part is the smaller one
    begin, size = np.where(lower, left, nodes), np.where(lower, nodes - left, right - nodes)
    other, beyond = np.where(lower, nodes, left), np.where(lower, right, nodes)
    found, total = [(np.zeros(0, np.int64),) * 2], np.cumsum(size)
    a = 0
    while a < len(nodes):
        b = max(a + 1, int(np.searchsorted(total, total[a] - size[a] + CHUNK, side="right")))
        of = np.repeat(np.arange(a, b), size[a:b])
        i = order[begin[of] + np.arange(len(of)) - (total[of] - size[of] - (total[a] - size[a]))]
        depth = height[nodes[of]]
        for j, start in ((i + depth, i), (i - depth, i - depth)):
            inside = (j >= first[i]) & (j < end[i])
            y = rank[np.where(inside, j, 0)]
            hit = inside & (y >= other[of]) & (y < beyond[of])
            found.append((start[hit], depth[hit]))
        a = b
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def runs(symbol: np.ndarray, bounds: np.ndarray) -> Runs:
    """All runs of rows of symbols: row r has the places ``bounds[r]:bounds[r + 1]``."""
    n, counts = len(symbol), np.diff(bounds)
    if not n:
        return Runs(*(np.zeros(0, np.int64),) * 3)
    row = np.repeat(np.arange(len(counts)), counts)
    first, end = bounds[row], bounds[row + 1]
    order, names = _names(symbol, row, end)
    height = np.zeros(n + 1, np.int64)
    near = np.flatnonzero(names[0][order[1:]] == names[0][order[:-1]])
    height[near + 1] = _common(names, order[near], order[near + 1])
    start, period = _squares(order, names[-1], height, first, end)
    back = _common_before(names, start, start + period, first[start])
    length = back + 2 * period
    use = length >= np.maximum(LEAST, TIMES * period)
    start, length, period = (start - back)[use], length[use], period[use]
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    by = np.lexsort((period, start))
    return Runs(start[by], length[by], period[by])


def kept_words(found: Runs, n: int) -> np.ndarray:
    """False for a word that some run holds after its first period."""
    change = np.bincount(found.start + found.period, minlength=n + 1) - np.bincount(found.start + found.length, minlength=n + 1)
    return np.cumsum(change)[:n] == 0


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """The words of each row joined by one space."""
    size = end - start
    size[:-1] += row[1:] == row[:-1]
    to = np.cumsum(size)
    out = np.append(data, np.uint8(32))[np.minimum(np.arange(int(size.sum())) + np.repeat(start - (to - size), size), len(data))]
    out[to[:-1][row[1:] == row[:-1]] - 1] = 32
    offsets = np.zeros(rows + 1, np.int64)
    np.cumsum(np.bincount(row, weights=size, minlength=rows), out=offsets[1:])
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def _detect(places: Places | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch.column("text")):
                rows = len(part.offsets) - 1
                start, end, row, _, bounds = A.words(part, _FOLD)
                inside = (_FOLD != 0)[part.data]
                to = np.zeros(len(start) + 1, np.int64)
                np.cumsum(end - start, out=to[1:])
                each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(to), pa.py_buffer(part.data[inside])])
                symbol = each.dictionary_encode().indices.to_numpy().astype(np.int64)
                if places is not None:
                    at = places(batch.column("id").slice(part.first, rows), bounds)
                    start, end, symbol = start[at], end[at], symbol[at]
                found = runs(symbol, bounds)
                keep = kept_words(found, len(symbol))
                of = row[found.start]
                lists = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (found.start - bounds[of], found.length, found.period)], names=["start", "length", "period"])
                offsets = pa.array(np.searchsorted(of, np.arange(rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(part.first, rows), pa.array(np.diff(bounds), pa.int64()), pa.ListArray.from_arrays(offsets, lists),
                                                  joined(part.data, start[keep], end[keep], row[keep], rows)], names=["doc", "n_words", "runs", "collapsed"])
    return run


def looped_places(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Places for a test corpus with planted loops: with h = crc32 of the decimal id, every document with h % 10 = 0 repeats
    its words from word g % n on with a period of 1 + (n - g % n) // (3 + g % 8), g = h // 10. A null id has no loop."""
    at = np.arange(bounds[-1])
    for r, value in enumerate(ids.to_pylist()):
        h, n = zlib.crc32(str(value).encode()), int(bounds[r + 1] - bounds[r])
        if value is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            own = at[bounds[r] + a : bounds[r + 1]]
            own[:] = bounds[r] + a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return at


def detected(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", places: Places | None = None) -> DataFrame:
    """doc (struct of the columns ``keep``), n_words, runs (start word, length and period, by start, then period), collapsed (the
    words that no run repeats, joined by one space). ``places`` puts other words of the document in its places first."""
    prepare(docs.sparkSession)
    rows = docs.select(F.struct(*[named(c) for c in keep]).alias("doc"), F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").alias("id"))
    fields = T.StructType([rows.schema["doc"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_detect(places), fields)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the longest run (ties: smallest start, then period), and hashes of all runs and of the collapsed text."""
    best = found.select("doc.doc_id", "n_words", "runs", "collapsed", F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS back, -r.period AS short)))").alias("best"))
    return best.select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        F.expr("-best.back").alias("start"), F.col("best.length").alias("length"), F.expr("-best.short").alias("period"),
        F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
        F.expr("sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), ''), 256)").alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
