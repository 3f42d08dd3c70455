"""Language identification by rank-order profiles of character n-grams (operator 12).

A profile lists the ``SIZE`` most frequent n-grams of 1 to 3 letters, most
frequent first. Letters are lower-cased; everything between words counts as one
edge, which belongs to the n-grams of two and three at both ends of a word. Equal
counts are ordered by length, then code points.

1. One profile for each language, from labelled documents: n-grams are counted
   per language inside each batch, summed by Spark, and cut to the first ranks.
2. Each document's own profile, over its whole text, is compared with each
   language's by the out-of-place distance: the sum of the differences of the two
   ranks, and ``SIZE`` for an n-gram that the language's profile lacks.
3. The nearest language is the prediction (ties: the smallest name).

The score compares the nearest language (distance a) with the second (b; with one
language: the distance of a text that shares nothing): b / (a + b). It is 0.5
where two languages fit equally and 1 where one fits perfectly.

Profiles are learned from some ``SAMPLE`` documents of each language (all, if it
has fewer), chosen by a hash of the id; their number doesn't grow with the table.
The profiles of all languages go to the executors: languages * SIZE numbers,
and more than ``MOST_LANGUAGES`` languages are refused.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as
is everything if no document has a language. Rows without a language are not
learned from. Null ids are in the held-out fold. Repeated rows are counted as often
as they stand. An empty table gives an empty result. Other columns are carried in
``doc``. Memory grows with the longest text, by some 100 bytes a letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold.llm import arrays as A
from tripfold.llm.classifier import held_out
from tripfold.llm.shared import named, prepare

#: N-grams of a profile, and documents of a language that are learned from.
SIZE = 300
SAMPLE = 20_000
MOST_LANGUAGES = 10_000
#: Texts are counted in slices of about this many bytes.
SLICE_BYTES = 1 << 19
#: Bits of a code point in a packed n-gram; a missing place is 0, the edge of a word 1.
BITS = 21
EDGE = 1
NO_LANGUAGE = "und"


class Profiles(NamedTuple):
    """Names in order; n-grams of any profile in order; their ranks by language (``SIZE`` where missing)."""

    names: list[str]
    grams: np.ndarray
    ranks: np.ndarray


class Counts(NamedTuple):
    """N-grams by group, then length and code points, with their counts."""

    group: np.ndarray
    gram: np.ndarray
    count: np.ndarray


@cache
def letters() -> np.ndarray:
    """For each code point: the lower-cased letter, or 0."""
    out = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            out[code] = ord(c.lower()[0])
    return out


def _alphabet(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of a slice of texts (0: none) and the text of each code point."""
    lead = (data & 0xC0) != 0x80
    at = np.append(0, np.cumsum(lead))[offsets]
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    return letters()[code], np.repeat(np.arange(len(offsets) - 1), np.diff(at))


def _edged(letter: np.ndarray, row: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with one ``EDGE`` before, between and behind them; the groups of the letters."""
    at = np.flatnonzero(letter)
    new = np.append(True, (np.diff(at) > 1) | (np.diff(row[at]) != 0))
    place = np.arange(len(at)) + np.cumsum(new)
    symbol = np.full(place[-1] + 2, EDGE, np.uint32)
    groups = np.zeros(len(symbol), np.int64)
    symbol[place], groups[place] = letter[at], group[at]
    return symbol, groups


def count(letter: np.ndarray, row: np.ndarray, group: np.ndarray) -> Counts:
    """N-grams of letters (0: none) by group. No word goes on from one row to the next; a group may have many rows."""
    if not letter.any():
        return Counts(*(np.zeros(0, np.int64),) * 3)
    symbol, of = _edged(letter, row, group)
    alphabet, small = np.unique(symbol, return_inverse=True)  # EDGE is the smallest
    width = int(len(alphabet)).bit_length()
    if int(group.max()).bit_length() + 2 + 3 * width > 63:  # so many letters: halve the groups
        half = int(group.max()) // 2
        low = group <= half
        parts = [count(np.where(keep, letter, 0), row, np.where(keep, group - base, 0)) for keep, base in ((low, 0), (~low, half + 1))]
        return Counts(np.concatenate((parts[0].group, parts[1].group + half + 1)), *(np.concatenate(x) for x in list(zip(*parts, strict=True))[1:]))
    small = small.astype(np.int64) + 1
    inner = np.flatnonzero(symbol != EDGE)
    head = of[inner] << 2
    pair = (small[inner - 1] << width) | small[inner]
    ends = inner[symbol[inner + 1] == EDGE]
    pack = lambda base, size, code: ((base | size) << (3 * width)) | code
    key = np.concatenate((pack(head, 1, small[inner]), pack(head, 2, pair), pack(of[ends] << 2, 2, (small[ends] << width) | small[ends + 1]), pack(head, 3, (pair << width) | small[inner + 1])))
    key.sort()
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    key, counts = key[new], np.diff(np.append(new, len(key)))
    value = np.append(0, alphabet.astype(np.int64))
    mask = (1 << width) - 1
    gram = (value[(key >> 2 * width) & mask] << 2 * BITS) | (value[(key >> width) & mask] << BITS) | value[key & mask]
    return Counts(key >> (3 * width + 2), gram, counts)


def most_frequent(found: Counts, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, n-gram and rank (from 0) of the ``size`` most frequent n-grams of each group."""
    by = np.lexsort((-found.count, found.group))  # stable: ties stay in order
    group = found.group[by]
    rank = np.arange(len(by)) - np.searchsorted(group, group)
    keep = rank < size
    return group[keep], found.gram[by][keep], rank[keep]


def distances(batch: Counts, rows: int, profiles: Profiles, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each row to each language, and the number of n-grams in the row's profile."""
    group, gram, rank = most_frequent(batch, size)
    at = np.minimum(np.searchsorted(profiles.grams, gram), len(profiles.grams) - 1)
    known = profiles.grams[at] == gram
    sizes = np.bincount(group, minlength=rows)
    out = np.zeros((rows, len(profiles.names)))
    for k, ranks in enumerate(profiles.ranks):
        other = np.where(known, ranks[at], size)
        out[:, k] = np.bincount(group, weights=np.where(other < size, np.abs(rank - other), size), minlength=rows)
    return out, sizes


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[A.Texts, np.ndarray, np.ndarray]]:
    for part in A.slices(batch.column("text"), SLICE_BYTES):
        yield part, *_alphabet(part.data, part.offsets)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        code = batch.column("lang").dictionary_encode()
        of = code.indices.to_numpy().astype(np.int64)
        for part, letter, row in _parts(batch):
            found = count(letter, row, of[part.first + row])
            yield pa.RecordBatch.from_arrays([code.dictionary.take(pa.array(found.group)), pa.array(found.gram), pa.array(found.count, pa.int64())], names=["lang", "gram", "n"])


def learned(labelled: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE, size: int = SIZE) -> Profiles:
    """Profiles of all languages in ``labelled``, without its held-out fold."""
    prepare(labelled.sparkSession)
    rows = labelled.where(~held_out(F.col(f"`{doc_id}`"))).select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("string").alias("id"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    large = {k: sample / n for k, n in sizes.items() if n > sample}
    if large:
        share = F.create_map(*[x for k, v in large.items() for x in (F.lit(k), F.lit(v))])
        spread = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.where(spread < F.coalesce(F.element_at(share, F.col("lang")), F.lit(2.0)))
    counts = rows.select("lang", "text").mapInArrow(_learn, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the packed n-gram is in order of length, then code points
    top = counts.select("lang", "gram", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")).alias("rank")).where(f"rank <= {size}")
    found = top.toArrow()  # languages * size rows
    names = sorted(sizes)
    grams, at = np.unique(found["gram"].to_numpy(), return_inverse=True)
    ranks = np.full((len(names), len(grams)), size, np.int64)
    of = {name: k for k, name in enumerate(names)}
    ranks[[of[x] for x in found["lang"].to_pylist()], at] = found["rank"].to_numpy() - 1
    return Profiles(names, grams, ranks)


def _predict(profiles: Profiles, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, letter, row in _parts(batch):
                rows = len(part.offsets) - 1
                name, score = np.full(rows, -1), np.zeros(rows)
                if len(profiles.grams):
                    far, sizes = distances(count(letter, row, row), rows, profiles, size)
                    far = np.column_stack((far, sizes * float(size))) if len(profiles.names) == 1 else far
                    two = np.sort(far, axis=1)[:, :2]
                    with_letter = sizes > 0
                    name[with_letter] = np.argmin(far[:, : len(profiles.names)], axis=1)[with_letter]
                    total = two.sum(axis=1)
                    score[with_letter] = np.where(total > 0, two[:, 1] / np.maximum(total, 1), 0.5)[with_letter]
                names = pa.array([*profiles.names, NO_LANGUAGE]).take(pa.array(np.where(name < 0, len(profiles.names), name)))
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(part.first, rows), names.cast(pa.string()), pa.array(score)], names=["doc", "lang_pred", "score"])
    return run


def predicted(docs: DataFrame, profiles: Profiles, keep: list[str], text: str = "text", size: int = SIZE) -> DataFrame:
    """doc (struct of the columns ``keep``), lang_pred, score. The prediction reads the text only."""
    prepare(docs.sparkSession)
    rows = docs.select(F.struct(*[named(c) for c in keep]).alias("doc"), F.col(f"`{text}`").alias("text"))
    fields = T.StructType([rows.schema["doc"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_predict(profiles, size), fields)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score")
