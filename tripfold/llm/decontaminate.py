"""Benchmark decontamination by winnowing (operator 9).

k-gram hashes of every document and benchmark item are winnowed: of every
``w`` consecutive k-grams the smallest is kept. Two texts that share
``k + w - 1`` words share a kept k-gram, so joining the kept ones finds every
shared span of that length; each hit is then extended word by word in both
directions, comparing the words themselves.

The benchmark side of the join is broadcast in blocks of at most
``BLOCK_BYTES`` of item text (measured first); every block is one pass over the
documents, without a shuffle. Items shorter than a window are matched by the
hash of their whole word sequence, then compared word by word.

Defined cases: null or empty text has no words and no hits. Repeated rows are
judged one by one. Items with the same id count once; an item with a null id
marks words but is not listed. An empty benchmark hits nothing. Documents with
no words stay. Other columns of a document are carried in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold.llm import arrays as A
from tripfold.llm.shared import named, prepare

WINDOW = 10
KGRAM = 5
BLOCK_BYTES = 32 << 20
_FOLD = A.alphanumeric_words()
_HITS = "n_words long, spans array<struct<start:int,stop:int>>, items array<string>"


def winnowed(grams: np.ndarray, ok: np.ndarray, w: int) -> np.ndarray:
    """Positions of the k-grams that are smallest in some run of ``w`` k-grams of one row."""
    n = len(grams)
    if n < w:
        return np.zeros(0, np.int64)
    top = n - w + 1
    least, at = grams[:top].copy(), np.zeros(top, np.int64)
    for j in range(1, w):
        lower = grams[j : j + top] < least
        least[lower] = grams[j : j + top][lower]
        at[lower] = j
    # a run lies in one row if its last k-gram does: k-grams that leave the row are those before the next row's first word
    inside = np.cumsum(np.concatenate(([0], ~ok)))
    whole = inside[w:] == inside[:top]
    return np.unique((np.arange(top) + at)[whole])


class Index:
    """Fingerprints of a block of items: (hash, item, word) sorted by hash, and short items by length."""

    def __init__(self, items: list[tuple[str | None, str]], window: int, k: int) -> None:
        self.window, self.k, self.ids = window, k, [i for i, _ in items]
        self.words: list[list[bytes]] = []
        found: dict[int, list[tuple[int, int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for part in A.slices(pa.array([text or ""])):
                w = A.words(part, _FOLD)
                low = _FOLD[part.data].astype(np.uint8).tobytes()
                own = [low[a:b] for a, b in zip(w.start, w.end, strict=True)]
                self.words.append(own)
                n = len(own)
                size = k if n >= window else n  # a short item is one gram of its own length
                if n:
                    g, ok = A.grams(w.hash, w.bounds, size)
                    kept = winnowed(g, ok, window - k + 1) if n >= window else np.zeros(1, np.int64)
                    found.setdefault(size if n >= window else -n, []).extend((int(g[p]), i, int(p)) for p in kept)
        self.grams = {}
        for size, rows in found.items():
            rows.sort()
            hashes = np.array([r[0] for r in rows], np.uint64)
            seen = np.zeros(1 << 16, bool)
            seen[(hashes >> A.U(48)).astype(np.int64)] = True
            self.grams[size] = (hashes, [r[1:] for r in rows], seen)

    def hits(self, part: A.Texts) -> tuple[np.ndarray, dict[int, tuple[set[tuple[int, int]], set[int]]]]:
        """Word counts of the rows, and by row with hits: its spans and the items."""
        w = A.words(part, _FOLD)
        out: dict[int, tuple[set[tuple[int, int]], set[int]]] = {}
        low = None
        for size, (hashes, places, seen) in self.grams.items():
            k = abs(size)
            g, ok = A.grams(w.hash, w.bounds, k)
            at = winnowed(g, ok, self.window - k + 1) if size > 0 else np.flatnonzero(ok)
            at = at[seen[(g[at] >> A.U(48)).astype(np.int64)]]
            first = np.searchsorted(hashes, g[at])
            at, first = at[first < len(hashes)], first[first < len(hashes)]
            same = hashes[first] == g[at]
            done: dict[tuple[int, int, int], int] = {}
            for p, f in zip(at[same].tolist(), first[same].tolist(), strict=True):
                if low is None:
                    low = _FOLD[part.data].astype(np.uint8).tobytes()
                row = int(w.row[p])
                lo, hi = int(w.bounds[row]), int(w.bounds[row + 1])
                while f < len(hashes) and hashes[f] == g[p]:
                    item, q = places[f]
                    f += 1
                    if done.get((row, item, p - q), -1) > p:
                        continue  # inside a span that is already extended
                    a, b = self._extend(w, low, lo, hi, p, self.words[item], q)
                    done[row, item, p - q] = b
                    if b - a >= (self.window if size > 0 else k):
                        spans, items = out.setdefault(row, (set(), set()))
                        spans.add((a - lo, b - lo))
                        items.add(item)
        return np.diff(w.bounds), out

    @staticmethod
    def _extend(w: A.Words, low: bytes, lo: int, hi: int, p: int, item: list[bytes], q: int) -> tuple[int, int]:
        """The longest run of equal words through document word p and item word q."""
        a, b = p, p
        i = q
        while b < hi and i < len(item) and low[w.start[b] : w.end[b]] == item[i]:
            b, i = b + 1, i + 1
        i = q - 1
        while a > lo and i >= 0 and low[w.start[a - 1] : w.end[a - 1]] == item[i]:
            a, i = a - 1, i - 1
        return a, b if b > p else a


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same words."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = KGRAM,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc`` (struct of the columns ``keep``), ``n_words``, ``n_hit``, ``spans`` of hit words
    (disjoint, in word positions) and ``items`` (ids as strings, distinct, sorted)."""
    spark = docs.sparkSession
    prepare(spark)
    if not 1 <= k <= window:
        raise ValueError("k must lie between 1 and the window")
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    doc = F.struct(*[named(c) for c in keep]).alias("doc")
    out = docs.select(doc, F.col(text).alias("text"))
    schema_doc = out.schema["doc"].dataType
    for number in range(blocks):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number).collect()
        index = spark.sparkContext.broadcast(Index([(r.id, r.text) for r in block], window, k))
        last = number == blocks - 1
        fields = T.StructType([T.StructField("doc", schema_doc)] + ([] if last else [T.StructField("text", T.StringType())]))
        fields = T.StructType(fields.fields + T.StructType.fromDDL(_HITS).fields)
        out = out.mapInArrow(_scan(index, last, number > 0), fields)
    return out.select("doc", "n_words", F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)").alias("n_hit"), "spans", "items")


def _scan(shared, last: bool, again: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            counts, spans, items = [], [], []
            if again:
                spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                spans = [[(s["start"], s["stop"]) for s in x] for x in spans]
            else:
                spans, items = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for part in A.slices(batch.column("text")):
                n, hits = index.hits(part)
                counts.append(n)
                for row, (found, which) in hits.items():
                    at = part.first + row
                    spans[at] = merged([*spans[at], *found])
                    items[at] = sorted({*items[at], *(index.ids[i] for i in which if index.ids[i] is not None)})
            cols = [batch.column("doc")] + ([] if last else [batch.column("text")])
            cols += [pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64()),
                     pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                     pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc"] + ([] if last else ["text"]) + ["n_words", "spans", "items"])
    return run


def digest(found: DataFrame) -> DataFrame:
    """The query's columns of ``contamination``."""
    return found.select("doc.doc_id", F.col("n_words"), F.col("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS gram
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, k, p, array_to_string(w[p : p + k - 1], ' ') AS gram
       FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT r, dw.k, p, item_id FROM dw JOIN bw ON dw.gram = bw.gram AND dw.k = bw.k),
hw AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + k - 1)) AS q FROM (SELECT DISTINCT r, k, p FROM hit)) GROUP BY r),
hi AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""
