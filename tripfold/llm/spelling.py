"""Spelling variants of words by asymmetric q-chunks (operator 13).

Words are runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased, of at least
``LEAST`` code points, that stand ``OFTEN`` times or more in all texts together.
Two words are near if one code point inserted, deleted or replaced makes one of
the other. A word's form is its near word with the most occurrences (ties: the
smallest in code-point order), if these are ``TIMES`` its own or more; its root is
the last word that the forms lead to.

Near words, with u the shorter or equal one, k code points long, and q = k // 2:

1. u contributes two disjoint chunks, its first and its last q code points. The
   other word contributes positional q-grams for words of its length and of one
   less. One edit leaves a chunk whole, the first one at its place, the last one
   at its place or one further; grams at other places can't join within that
   shift and are not made.
2. Chunks and grams are joined by a hash of k, the chunk and its words' rest so
   far; pairs are verified by a bounded edit distance.
3. A chunk that more than ``HOT`` words on both sides share isn't joined: its
   words take two chunks and their grams from what they have left of u, so the
   next key is longer. At last one code point is left, and a key has no more words
   than the alphabet allows. So no key gives the square of its words, and no pair
   is lost.

Counts are added up inside each task, then by Spark. Roots are found by pointer
doubling over the words that have a form; n at least doubles with each form, so
some six rounds do. Intermediate tables are written to the shared folder.

Defined cases: null and empty texts have no words; a null id reads as empty text
where slips are planted. Repeated rows count as often as they stand. An empty table
gives an empty result. Only the id and the text are read, so other columns may have
any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm import arrays as A
from tripfold.llm.shared import prepare, stored

LEAST = 5
OFTEN = 3
TIMES = 2
#: Words on both sides from which a chunk is joined by longer keys.
HOT = 64
#: Different words (and bytes of them) that a task adds up before it sends them on.
MOST_WORDS = 200_000
MOST_BYTES = 16 << 20
#: A longer word is hashed by itself.
LONG = 64


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _crc_table()
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, row and code points of the runs of letters in rows of UTF-8 text."""
    n = len(data)
    lead = data == 0xC3  # U+00C0 to U+00FF are C3 and one more byte
    follow = np.zeros(n, bool)
    follow[1:] = lead[:-1]
    inside = np.zeros(n + 1, bool)
    inside[:n] = _ASCII[data] | lead | follow
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.append(False, inside[:-1])
    start = np.flatnonzero(inside & (~before | cut))
    end = np.flatnonzero(before & (~inside | cut))
    points = np.append(0, np.cumsum(~follow))
    return start, end, np.searchsorted(offsets, start, side="right") - 1, points[end] - points[start]


def crc32_of(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of the byte ranges, each going on from its ``seed`` crc."""
    state, size = ~seed.astype(np.uint32), end - start
    by = np.argsort(-size, kind="stable")
    longest = np.searchsorted(-size[by], np.arange(0, -LONG - 1, -1))  # longest[t]: ranges with more than t bytes
    for t in range(LONG):
        at = by[: longest[t]]
        if not len(at):
            break
        state[at] = _CRC[(state[at] ^ data[start[at] + t]) & 0xFF] ^ (state[at] >> 8)
    out = ~state
    for i in by[: longest[LONG]]:
        out[i] = zlib.crc32(data[start[i] + LONG : end[i]].tobytes(), int(out[i]))
    return out


def _ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    to = np.append(0, np.cumsum(size))
    flat = data[np.arange(to[-1]) + np.repeat(start - to[:-1], size)]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(flat))


def _words_of(part: A.Texts, ids: pa.Array, least: int, slips: int | None) -> pa.Array:
    start, end, row, points = letter_runs(part.data, part.offsets)
    long = points >= least  # a slip only makes a word shorter
    start, end, row, points = start[long], end[long], row[long], points[long]
    data = _LOWER[part.data]
    if slips is None or not len(start):
        return _ranges(data, start, end)
    seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids.to_pylist()], np.uint32)
    h = crc32_of(data, start, end, seeds[row])
    hit = h % slips == 0
    changed = []
    for a, b, at in zip(start[hit].tolist(), end[hit].tolist(), (h[hit] % points[hit]).tolist(), strict=True):
        word = data[a:b].tobytes().decode()
        if len(word) > least:
            changed.append(word[:at] + word[at + 1 :])
    return pa.chunked_array([_ranges(data, start[~hit], end[~hit]), pa.array(changed, pa.large_string())]).combine_chunks()


def _sums(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _count(least: int, slips: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []

        def full() -> bool:
            return sum(p.num_rows for p in parts) > MOST_WORDS or sum(p.nbytes for p in parts) > MOST_BYTES

        def out() -> Iterator[pa.RecordBatch]:
            for table in parts:
                yield from table.set_column(0, "word", table["word"].cast(pa.string())).combine_chunks().to_batches(max_chunksize=10_000)
            parts.clear()

        for batch in batches:
            for part in A.slices(batch.column("text")):
                found = _words_of(part, batch.column("id").slice(part.first, len(part.offsets) - 1), least, slips).value_counts()
                parts.append(pa.table([found.field(0), found.field(1)], names=["word", "n"]))
                if full():
                    parts[:] = [_sums(parts)]
                    if full():
                        yield from out()
        if parts:
            parts[:] = [_sums(parts)]
        yield from out()
    return run


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, often: int = OFTEN, slips: int | None = None) -> DataFrame:
    """word, n: the words of all texts with at least ``least`` code points and ``often`` occurrences.

    With ``slips``, misspellings are planted first: with h the crc32 of ``<id>:<word>``, a word with h % slips = 0 loses its
    code point h % length, everywhere in that document.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    return rows.mapInArrow(_count(least, slips), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {often}")


#: A row of the join: whether it is a chunk (else grams), word, n, key, code points used at the left and the right, code points of the chunk's word left.
_PARTS = """inline(array(
    struct(chunk, word, n, xxhash64(key, 0, substring(word, used + 1, k div 2)) AS key, used + k div 2 AS used, behind, k - k div 2 AS k),
    struct(chunk, word, n, xxhash64(key, 1, substring(word, char_length(word) - behind - k div 2 + 1, k div 2)) AS key, used, behind + k div 2 AS behind, k - k div 2 AS k)))"""


def _sides(words: DataFrame, least: int) -> DataFrame:
    """Each word as a chunk word, and as a gram word for chunk words of its length and of one less."""
    sides = F.expr(f"""inline(filter(array(
        struct(true AS chunk, char_length(word) AS k), struct(false AS chunk, char_length(word) AS k), struct(false AS chunk, char_length(word) - 1 AS k)), s -> s.k >= {least}))""")
    return words.select("word", "n", sides).select("chunk", "word", "n", F.xxhash64("k").alias("key"), F.lit(0).alias("used"), F.lit(0).alias("behind"), "k")


def near_pairs(words: DataFrame, least: int = LEAST, hot: int = HOT) -> DataFrame:
    """a, b, n_a, n_b: every pair of near words once. ``words``: word (distinct, at least ``least`` >= 2 code points), n."""
    rows, found = _sides(words, least), None
    while True:
        rows = stored(rows.selectExpr(_PARTS), "word-parts")
        sizes = rows.groupBy("key").agg(F.count_if(F.col("chunk")).alias("a"), F.count_if(~F.col("chunk")).alias("b"), F.min("k").alias("k"))
        shared = stored(sizes.where(f"least(a, b) > {hot} AND k > 1").select("key"), "hot-parts")
        last = shared.isEmpty()
        cold = rows if last else rows.join(shared, "key", "left_anti")
        u = cold.where("chunk").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
        v = cold.where("NOT chunk").select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
        ordered = "(char_length(a) < char_length(b) OR a < b) AND levenshtein(a, b, 1) = 1"
        pairs = stored(u.join(v, "key").where(ordered).select("a", "b", "n_a", "n_b"), "near-words")
        found = pairs if found is None else found.unionAll(pairs)
        if last:
            return found.distinct()  # a pair may share both chunks
        rows = rows.join(shared, "key", "left_semi")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root for words that have a form. ``forms``: word, form."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, often: int = OFTEN, times: int = TIMES, slips: int | None = None, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near, form_n for all words of the texts."""
    words = stored(word_counts(docs, doc_id, text, least, often, slips), "words")
    pairs = near_pairs(words, least, hot)
    both = pairs.selectExpr("inline(array(struct(a AS word, b AS other, n_b AS m), struct(b AS word, a AS other, n_a AS m)))")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    forms = stored(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.expr(f"CASE WHEN -best.m >= {times} * n THEN best.other END").alias("form"),
                                                          F.expr(f"CASE WHEN -best.m >= {times} * n THEN -best.m END").alias("form_n")), "forms")
    roots = _roots(forms.where("form IS NOT NULL"))
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
