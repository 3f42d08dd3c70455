"""Repeated passages by winnowing over word-gram hashes (operator 6).

A window is ``REACH`` words of a text, wherever it starts. It is repeated if the
same words (A-Z lower-cased, white space ignored) stand at an earlier place
(smaller id, then position). Repeated windows that touch make a stretch. A
stretch of ``PASSAGE`` words or more is deleted to the word; of a shorter one
only the whole units go (units are lines, cut further at sentence ends and
before capitals), if they have ``GRAM`` words.

To find repeated windows without a row for each: the window's ``CORE``-word gram
with the smallest hash is its fingerprint, which depends on its words only, so
equal windows have equal fingerprints. The windows of one gram follow each
other, and the words that they span are the gram's variant.

1. Only fingerprints that occur twice go on (a partial aggregate and a join).
2. All places of a variant but its first are repeated as a whole.
3. Where a fingerprint has several variants (where a passage begins or ends, or
   its neighbourhood differs), the windows of each variant's first place are
   hashed one by one, and the first place of each window is found. So there is
   a first place for each neighbourhood, not one for a fingerprint.

A window that overlaps its own first place (a text that repeats a word) is only
deleted behind it, so one copy always stays.

Defined cases: null or empty text stays as it is. Rows with the same id and
text are the same document and are treated alike; rows with the same id and
other texts are ordered by a hash of the text. A null id comes first. Runs that
repeat inside a text are deleted, too. A line that loses all its words goes
with its line break; otherwise line breaks stay. An empty table gives an empty
result. Other columns are carried in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold.llm import arrays as A
from tripfold.llm.shared import named, prepare, stored

GRAM = 20
REACH = 30
#: Words of a fingerprint, and words of a stretch that is deleted to the word.
CORE = 12
PASSAGE = 50
#: Bytes of the slices here: their arrays stay in the processor's cache.
SLICE_BYTES = 512 << 10
_FOLD = A.whitespace_words()
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
U = A.U


class Runs:
    """Words of a slice of texts: first byte of each word, words of each row, hashes of runs of words."""

    def __init__(self, part: A.Texts) -> None:
        w = A.words(part, _FOLD)
        self.start, self.word_bounds = w.start, w.bounds
        # running sums of word hashes times odd powers: any run of words has its hash by a difference, shifted to its first word
        self._run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(w.hash * A.powers(_BASE, len(w.start)))))

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the words [a, b)."""
        return A.mix((self._run[b] - self._run[a]) * A.powers(_INVERSE, len(self._run))[a] + (b - a).astype(np.uint64))


class Units:
    """Words and units of a slice of texts: first byte of each word, words of each row, first word of each unit (and the number of words), units of each row."""

    def __init__(self, part: A.Texts) -> None:
        data, (start, end, bounds) = part.data, A.borders(part, _FOLD)
        n = len(start)
        self.start, self.word_bounds = start, bounds
        #: Words that begin or end a row.
        self.heads, self.tails = np.zeros(n, bool), np.zeros(n, bool)
        filled = bounds[:-1] < bounds[1:]
        self.heads[bounds[:-1][filled]] = self.tails[bounds[1:][filled] - 1] = True
        self.bounds = np.zeros(len(part.offsets), np.int64)
        self.first = np.zeros(1, np.int64)
        self.opens = self.closes = np.zeros(0, bool)
        if not n:
            return
        new = self.heads.copy()
        after = np.searchsorted(start, np.flatnonzero(data == 10))  # the first word after each line break
        new[after[after < n]] = True
        last = data[end - 1]
        ends = (last == 46) | (last == 33) | (last == 63)
        new[1:] |= ends[:-1]
        first = data[start]
        second = data[np.minimum(start + 1, len(data) - 1)]
        capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        new |= capital
        at = np.flatnonzero(new)
        #: Units that begin or end by their own words, whatever stands beside them.
        self.opens, self.closes = capital[at], ends[np.append(at[1:], n) - 1]
        self.first = np.append(at, n)
        self.bounds = np.searchsorted(at, bounds)


def _least(value: np.ndarray, n: int) -> np.ndarray:
    """Place of the smallest (the first of equal ones) of each ``n`` values in a row."""
    at, span = np.arange(len(value)), 1
    while span < n:
        step = min(span, n - span)
        lower = value[step:] < value[:-step]
        value, at = np.where(lower, value[step:], value[:-step]), np.where(lower, at[step:], at[:-step])
        span += step
    return at


def fingerprints(runs: Runs, reach: int = REACH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first window (counted in the row), windows, hash of the fingerprint and of the variant, for each chosen gram."""
    n, core = len(runs.start), min(CORE, reach)
    row = np.repeat(np.arange(len(runs.word_bounds) - 1), np.diff(runs.word_bounds))
    window = np.flatnonzero(np.arange(n) + reach <= runs.word_bounds[row + 1])
    if not len(window):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    every = np.arange(n - core + 1)
    value = runs.hash(every, every + core)
    at = _least(value, reach - core + 1)[window]
    new = np.flatnonzero(np.diff(at, prepend=-1))  # a gram's windows follow each other
    size = np.diff(np.append(new, len(at)))
    start = window[new]
    return row[start], start - runs.word_bounds[row[start]], size, value[at[new]], runs.hash(start, start + size - 1 + reach)


def _fingerprint_rows(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch.column("text"), SLICE_BYTES):
                row, start, size, core, variant = fingerprints(Runs(part), reach)
                at = pa.array(part.first + row, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64), pa.int64()), pa.array(variant.view(np.int64), pa.int64()), batch.column("id").take(at), batch.column("code").take(at),
                                                  pa.array(start, pa.int32()), pa.array(size, pa.int32())], names=["hash", "variant", "id", "code", "pos", "size"])
    return run


def _window_rows(reach: int):
    """Hashes of the windows of ``spots`` (first window, windows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = batch.column("spots")
            owner = np.repeat(np.arange(batch.num_rows), spots.value_lengths().to_numpy())
            flat = spots.flatten()
            pos, size = (flat.field(k).to_numpy().astype(np.int64) for k in ("pos", "size"))
            for part in A.slices(batch.column("text"), SLICE_BYTES):
                runs = Runs(part)
                use = slice(*np.searchsorted(owner, [part.first, part.first + len(part.offsets) - 1]))
                each = np.repeat(np.arange(use.start, use.stop), size[use])
                nth = np.arange(len(each)) - np.repeat(np.cumsum(size[use]) - size[use], size[use])
                at = pos[each] + nth
                start = runs.word_bounds[owner[each] - part.first] + at
                rows = pa.array(owner[each], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(runs.hash(start, start + reach).view(np.int64), pa.int64()), batch.column("id").take(rows), batch.column("code").take(rows), pa.array(at, pa.int32())],
                                                 names=["hash", "id", "code", "pos"])
    return run


def _cut(data: bytes, edge: list[int], drop: bool) -> str:
    """``data`` from its first edge to the last: up to the second it stays, then deleted and kept stretches alternate (``drop``: the first is deleted)."""
    out = bytearray(data[edge[0] : edge[1]])
    pending = False
    for a, b in zip(edge[1:-1], edge[2:], strict=True):
        piece = data[a:b]
        if drop:
            pending = b"\n" in piece
        else:
            if pending and out and not out.endswith(b"\n"):
                out = bytearray(out.rstrip(b" \t\x0b\x0c\r") + b"\n")
            out += piece
        drop = not drop
    if not drop:  # the last stretch was deleted
        out = bytearray(out.rstrip(b" \t\x0b\x0c\r\n"))
    return out.decode()


def _left(part: A.Texts, units: Units, gone: np.ndarray) -> Iterator[tuple[int, str]]:
    """Rows that lose words, and their texts without the words marked in ``gone``."""
    turn = np.flatnonzero(units.heads | np.diff(gone, prepend=False))  # kept and deleted stretches of a row alternate
    edge, drop = units.start[turn].tolist(), gone[turn].tolist()
    bounds, offsets = np.searchsorted(turn, units.word_bounds).tolist(), part.offsets.tolist()
    data = part.data.tobytes()
    for row in np.flatnonzero(_by_row(gone, units.word_bounds)).tolist():
        a, b = bounds[row], bounds[row + 1]
        yield row, _cut(data, [offsets[row], *edge[a:b], offsets[row + 1]], drop[a])


def _marked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in one of the ranges [a, b)."""
    return np.cumsum(np.bincount(a, minlength=n + 1) - np.bincount(b, minlength=n + 1))[:n] > 0


def _by_row(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Marks in each row."""
    return np.diff(np.append(0, np.cumsum(marks))[bounds])


def without(text: str, ranges: list[tuple[int, int]]) -> tuple[str, int, int]:
    """``text`` without the unit ranges; units and words deleted."""
    part = next(A.slices(pa.array([text])))
    units = Units(part)
    a, b = (np.array([r[k] for r in ranges], np.int64) for k in (0, 1))
    gone = _marked(len(units.start), units.first[a], units.first[b])
    return dict(_left(part, units, gone)).get(0, text), int(_marked(len(units.first) - 1, a, b).sum()), int(gone.sum())


def deleted(units: Units, a: np.ndarray, b: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Words that go and units that go whole, for the repeated words [a, b) (counted in the slice). A unit counts if it stands as
    one at the earlier place, too: its borders lie in what is repeated."""
    n = len(units.start)
    gone = _marked(n, a, b)
    low, high = units.first[:-1], units.first[1:]
    before, after = np.append(False, gone[:-1]) & ~units.heads, np.append(gone[1:], False) & ~units.tails
    alike = (before[low] | units.opens) & (after[high - 1] | units.closes)
    start, stop = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
    short = stop - start < PASSAGE
    low_unit, high_unit = units.first[np.searchsorted(units.first, start)], units.first[np.searchsorted(units.first, stop, side="right") - 1]
    start, stop = np.where(short, low_unit, start), np.where(short, high_unit, stop)
    stay = ~short | (stop - start >= gram)
    gone = _marked(n, start[stay], stop[stay])
    whole = np.minimum.reduceat(gone, low) if len(low) else gone
    return gone, whole & alike


def _apply(gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, ranges = batch.column("text").cast(pa.string()), batch.column("ranges")
            lost, left = np.zeros((2, batch.num_rows), np.int64), {}
            some = np.flatnonzero(ranges.is_valid().to_numpy(zero_copy_only=False))
            taken = ranges.take(pa.array(some))
            owner = np.repeat(np.arange(len(some)), taken.value_lengths().to_numpy())
            start, stop = (taken.flatten().field(k).to_numpy().astype(np.int64) for k in ("start", "stop"))
            for part in A.slices(text.take(pa.array(some)), SLICE_BYTES) if len(some) else ():
                units = Units(part)
                use = slice(*np.searchsorted(owner, [part.first, part.first + len(part.offsets) - 1]))
                base = units.word_bounds[owner[use] - part.first]
                gone, whole = deleted(units, base + start[use], base + stop[use], gram)
                rows = some[part.first : part.first + len(part.offsets) - 1]
                lost[:, rows] = _by_row(whole, units.bounds), _by_row(gone, units.word_bounds)
                left |= {rows[i]: new for i, new in _left(part, units, gone)}
            if left:
                mask = np.zeros(batch.num_rows, bool)
                mask[list(left)] = True
                text = pc.replace_with_mask(text, pa.array(mask), pa.array(left.values(), pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), text, pa.array(lost[0]), pa.array(lost[1])], names=["doc", "text", "units_deleted", "words_deleted"])
    return run


def _firsts(rows: DataFrame, *key: str) -> DataFrame:
    """The first place ``f`` of each key and the places ``n``."""
    return rows.groupBy(*key).agg(F.min(F.struct("id", "code", "pos", "size")).alias("f"), F.count(F.lit(1)).alias("n"))


def _repeats(rows: DataFrame, firsts: DataFrame, *key: str, reach: int) -> DataFrame:
    """id, code, start, stop: all places of ``rows`` but the first of each key, without the words of a first place that they overlap.
    ``firsts`` is a stored table: read anew, the join has shuffles of its own, so Spark can split a hot key."""
    same = "id <=> f.id AND code <=> f.code"
    found = rows.join(firsts.where("n > 1").select(*key, "f"), [*key]).where(f"NOT ({same} AND pos <=> f.pos)")
    return found.select("id", "code", F.expr(f"CASE WHEN {same} THEN greatest(pos, f.pos + {reach}) ELSE pos END").alias("start"), F.expr(f"pos + size - 1 + {reach}").alias("stop"))


def repeated_ranges(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """id, code, ranges (word ranges of repeated windows) for documents that have any. ``docs``: id, code, text."""
    prepare(docs.sparkSession)
    kind = docs.schema["id"].dataType.simpleString()
    prints = stored(docs.mapInArrow(_fingerprint_rows(reach), f"hash long, variant long, id {kind}, code long, pos int, size int"), "fingerprints")
    twice = stored(prints.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "shared-hashes")
    shared = stored(prints.join(twice, "hash"), "shared")
    variants = stored(_firsts(shared, "hash", "variant"), "variants")
    whole = _repeats(shared, variants, "hash", "variant", reach=reach)

    several = stored(variants.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "several")
    spots = variants.join(several, "hash").select("f.*").groupBy(F.col("id").alias("_id"), F.col("code").alias("_code")).agg(F.collect_list(F.struct("pos", "size")).alias("spots"))
    asked = docs.join(spots, F.col("id").eqNullSafe(F.col("_id")) & (F.col("code") == F.col("_code"))).select("id", "code", "text", "spots")
    windows = stored(asked.mapInArrow(_window_rows(reach), f"hash long, id {kind}, code long, pos int"), "windows").withColumn("size", F.lit(1))
    spans = whole.unionAll(_repeats(windows, stored(_firsts(windows, "hash").where("n > 1"), "first-places"), "hash", reach=reach))
    return spans.groupBy("id", "code").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))  # at most a text's windows


def deduplicated(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, reach: int = REACH) -> DataFrame:
    """doc (struct of the columns ``keep``), text without later repeated runs, units_deleted, words_deleted."""
    key = [F.col(doc_id).alias("id"), F.xxhash64(text).alias("code")]
    ranges = stored(repeated_ranges(docs.select(*key, F.col(text).alias("text")), reach), "ranges")
    side = ranges.select(F.col("id").alias("_id"), F.col("code").alias("_code"), "ranges")
    rows = docs.select(F.struct(*[named(c) for c in keep]).alias("doc"), F.col(text).alias("text"), *key)
    joined = rows.join(side, F.col("id").eqNullSafe(F.col("_id")) & (F.col("code") == F.col("_code")), "left").select("doc", "text", "ranges")
    fields = T.StructType([joined.schema["doc"], T.StructField("text", T.StringType()), T.StructField("units_deleted", T.LongType()), T.StructField("words_deleted", T.LongType())])
    return joined.mapInArrow(_apply(gram), fields)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc.doc_id", "text", "units_deleted", "words_deleted")
