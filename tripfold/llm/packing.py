"""Best-fit packing by a configuration linear program (operator 10).

1. Documents are tokenized in place; a document longer than a sequence is cut
   into full pieces, the first one taking the remainder. Pieces (no ids, only
   lengths and checksums) are stored in the shared folder.
2. Only the length histogram (one number a length, at most ``capacity``)
   reaches the driver. The covering program ``min sum x_c, every length
   covered`` is solved by multiplicative weights: lengths have weights, a
   knapsack dynamic program prices configurations, and the weight of a length
   falls exponentially with its coverage. One pricing gives the best
   configuration through each of the least covered lengths; known
   configurations near the best price share the steps. Every pricing gives a
   dual bound; the program ends when its value is within ``ACCURACY`` of the
   bound, or after ``ROUNDS`` pricings. The configurations of a best fit are
   known from the start, without amounts.
   The solution is rounded (fullest configurations first, parts of amounts
   carried to the next one) and the pieces that remain are packed best fit. That
   is done for several ``SHARES`` of the amounts, since best fit does better with
   more pieces; the shortest plan holds.
3. The plan is a list of (configuration, copies). Pieces get their rank among
   those of their length from per-task counts (a running sum over tasks, no
   global sort); rank and length give sequence and offset by a range join
   against the plan's runs.

The plan's size depends on ``capacity`` and the rounds, not on the number of
documents: a pricing adds at most ``EACH`` configurations, and a best-fit step
uses up a length. It is broadcast if it has at most ``MOST_SLOTS`` rows (some
50 bytes each); beyond that Spark joins by the length.

Defined cases: null text is empty; an empty text is one token (the
separator). Repeated rows are packed one by one. An empty table gives an empty
result. Other columns are carried in ``doc``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold.llm.shared import named, prepare, stored

CAPACITY = 2048
SEPARATOR = 0
#: Of the multiplicative weights: pricings, configurations of a pricing, steps after it, and how far a step falls.
ROUNDS = 40
EACH = 60
STEPS = 60
STEP = 0.2
#: How near the best price a configuration must be to share a step: in the first pricing and in the last.
NEAR = (0.05, 0.002)
#: The program is solved if it is this near its dual bound.
ACCURACY = 0.003
#: Parts of the amounts that are rounded; best fit packs the rest.
SHARES = (1.0, 0.95, 0.9, 0.75, 0.5)
#: Rows of a plan that are broadcast.
MOST_SLOTS = 200_000
VOCABULARY = "byte_bpe_50k"
END = "<|endoftext|>"


@cache
def encoders(vocabulary: str):
    """(plain, exact): plain encodes texts of Latin letters from the vocabulary's rank file, five times as fast as the
    tokenizers library and to the same ids; exact is the tokenizers library, for every other text."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return plain, exact


#: Characters beyond these, and the end marker, go to the tokenizers library.
PLAIN_TOP = 0x24F


def encode(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    plain, exact = encoders(vocabulary)
    if (text.isascii() or ord(max(text)) <= PLAIN_TOP) and END not in text:
        return plain.encode_ordinary(text)
    return exact.encode(text, add_special_tokens=False).ids


def pieces(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than ``capacity`` if there are several."""
    first = length - (-(-length // capacity) - 1) * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def tokenized(docs: DataFrame, keep: list[str], text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc, piece, start, length, ids_crc32, and ``task``, ``nth``: the task that cut it and its
    number there among the pieces of its length."""
    prepare(docs.sparkSession)
    source = docs.select(F.struct(*[named(c) for c in keep]).alias("doc"), F.col(f"`{text}`").alias("text"))
    fields = T.StructType([T.StructField("doc", source.schema["doc"].dataType)] + T.StructType.fromDDL(
        "piece int, start long, length long, ids_crc32 long, task int, nth long").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, out = [], []
            for i, value in enumerate(batch.column("text")):
                ids = np.array([*encode(value.as_py() or "", vocabulary), SEPARATOR], dtype="<u4")
                for n, (start, length) in enumerate(pieces(len(ids), capacity)):
                    rows.append(i)
                    out.append((n, start, length, zlib.crc32(ids[start : start + length].tobytes()), task, int(seen[length])))
                    seen[length] += 1
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                                             names=["doc", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return source.mapInArrow(run, fields)


class Program:
    """The covering program over a histogram: lengths, needs, and the configurations known so far as (configuration, length, times) entries."""

    def __init__(self, counts: np.ndarray, capacity: int) -> None:
        self.counts, self.capacity = counts, capacity
        self.lengths = np.flatnonzero(counts)
        self.need = counts[self.lengths].astype(float)
        self.known: dict[tuple[int, ...], int] = {}
        self._entries: list[tuple[int, int, int]] = []

    def add(self, config: tuple[int, ...]) -> None:
        if config not in self.known:
            sizes, times = np.unique(np.array(config), return_counts=True)
            k = self.known[config] = len(self.known)
            self._entries += [(k, *x) for x in zip(np.searchsorted(self.lengths, sizes).tolist(), times.tolist(), strict=True)]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        config, length, times = np.array(self._entries).T
        return config, length, times.astype(float)

    def priced(self, price: np.ndarray) -> np.ndarray:
        """The worth of the best configuration within every capacity (unbounded knapsack); ``price`` is by length."""
        worth, least = self._worth(price), int(self.lengths[0])
        best = np.zeros(self.capacity + 1)
        for c in range(least, self.capacity + 1):
            best[c] = max(best[c - 1], (worth[least : c + 1] + best[c - least :: -1]).max())
        return best

    def through(self, size: int, price: np.ndarray, best: np.ndarray) -> tuple[int, ...]:
        """The best configuration that has a piece of this length and no more of any length than there are."""
        worth, least, room, used, out = self._worth(price), int(self.lengths[0]), self.capacity, {}, []
        while True:
            out.append(size)
            room -= size
            used[size] = used.get(size, 0) + 1
            if used[size] == self.counts[size]:
                worth[size] = -np.inf
            if room < least:
                break
            gain = worth[least : room + 1] + best[room - least :: -1]
            size = least + int(gain.argmax())
            if worth[size] == -np.inf:
                break
        return tuple(sorted(out, reverse=True))

    def _worth(self, price: np.ndarray) -> np.ndarray:
        worth = np.full(self.capacity + 1, -np.inf)
        worth[self.lengths] = price
        return worth


def fractional(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[dict[tuple[int, ...], float], float, float]:
    """Configurations and amounts that cover ``counts`` (pieces of each length), their sum, and a lower bound of it.

    A step adds to every configuration near the best price what covers its scarcest length, divided by how much the others
    crowd its lengths, and scaled so that no coverage grows by more than ``STEP``. Weights over the priced worth are a dual
    solution. Amounts over the least coverage are a primal one; twice on the way the coarse beginnings are scaled down.
    """
    program = Program(counts, capacity)
    lengths, need, m = program.lengths, program.need, len(program.lengths)
    if not m:
        return {}, 0.0, 0.0
    for config, _ in best_fit(counts, capacity):
        program.add(config)
    first = np.log(lengths * need / capacity)  # the first dual bound is that by volume
    covered, amount = np.zeros(m), np.zeros(0)
    found, total, bound = {}, math.inf, 0.0

    def weights() -> np.ndarray:
        w = first - covered
        return np.exp(w - w.max())

    for asked in range(rounds):
        near = 1 - NEAR[0] * (NEAR[1] / NEAR[0]) ** (asked / max(1, rounds - 1))
        weight = weights()
        price = weight / need
        best = program.priced(price)
        bound = max(bound, float(weight.sum()) / best[capacity])
        worth = price + best[capacity - lengths]
        order = np.argsort(covered, kind="stable")
        for size in lengths[order[worth[order] >= near * best[capacity]][:EACH]].tolist():
            program.add(program.through(size, price, best))
        config, length, times = program.entries()
        n = len(program.known)
        amount = np.append(amount, np.zeros(n - len(amount)))
        scarcest, crowd = np.zeros(n), np.zeros(n)
        np.maximum.at(scarcest, config, times / need[length])
        cover = lambda x: np.bincount(length, weights=x[config] * times, minlength=m) / need  # noqa: E731, B023
        for _ in range(STEPS):
            value = np.bincount(config, weights=(weights() / need)[length] * times, minlength=n)
            more = np.where(value >= near * value.max(), 1 / scarcest, 0.0)
            crowd[:] = 0
            np.maximum.at(crowd, config, cover(more)[length])
            more = np.divide(more, crowd, out=np.zeros(n), where=more > 0)
            more *= STEP / cover(more).max()
            amount += more
            covered += cover(more)
        if covered.min() > 0 and amount.sum() / covered.min() < total:
            total = float(amount.sum() / covered.min())
            found = {c: float(amount[k] / covered.min()) for c, k in program.known.items() if amount[k]}
            if total <= bound * (1 + ACCURACY):
                break
        if asked in (rounds // 3, 2 * rounds // 3):
            first, amount, covered = first - 0.9 * covered, 0.1 * amount, 0.1 * covered
    return found, total, bound


def rounded(found: dict[tuple[int, ...], float], counts: np.ndarray, capacity: int, share: float = 1.0) -> list[tuple[tuple[int, ...], int]]:
    """(configuration, copies): ``share`` of the amounts in whole copies, the fullest configurations first, and best fit for the rest."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    carry = 0.0
    for config, amount in sorted(found.items(), key=lambda x: (-sum(x[0]), -x[1], x[0])):
        size, copies = np.unique(np.array(config), return_counts=True)
        carry += amount * share
        n = int(min(math.floor(carry + 1e-9), (left[size] // copies).min()))
        if n > 0:
            left[size] -= n * copies
            out.append((config, n))
        carry = min(carry - n, 1.0)
    return out + best_fit(left, capacity)


def plan(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """(configuration, copies): exactly ``counts[l]`` pieces of every length l are placed."""
    return bounded_plan(counts, capacity, rounds)[0]


def bounded_plan(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """The plan, and a lower bound of the sequences that any plan needs."""
    amounts, _, bound = fractional(counts, capacity, rounds)
    plans = [rounded(amounts, counts, capacity, share) for share in SHARES]
    return min(plans, key=lambda found: sum(n for _, n in found)), math.ceil(bound * (1 - 1e-9))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit on a histogram: each configuration takes the longest piece left, then the longest that fits, and is
    repeated as often as the pieces allow, so the work is bounded by lengths and not by pieces."""
    left, out = counts.astype(np.int64).copy(), []
    while True:
        present = np.flatnonzero(left)
        if not len(present):
            return out
        used: dict[int, int] = {}
        room = capacity
        for size in present[::-1]:
            size = int(size)
            if size <= room:
                n = min(int(left[size]), room // size)
                used[size] = n
                room -= n * size
                if not room:
                    break
        copies = min(int(left[s]) // n for s, n in used.items())
        for s, n in used.items():
            left[s] -= copies * n
        out.append((tuple(s for s in sorted(used, reverse=True) for _ in range(used[s])), copies))


def packed(cut: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``tokenized`` pieces with ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    cut = stored(cut, "pieces")
    by_task = stored(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    slots, first = [], 0
    reached: dict[int, int] = {}
    for config, copies in plan(counts, capacity, rounds):
        offset = 0
        sizes, repeats = np.unique(np.array(config), return_counts=True)
        for size, n in zip(sizes[::-1].tolist(), repeats[::-1].tolist(), strict=True):
            start = reached.get(size, 0)
            slots.append((size, start, start + n * copies, n, first, offset))
            reached[size] = start + n * copies
            offset += n * size
        first += copies
    # runs of a length are numbered by blocks of its ranks, so the range join is an equality join
    runs = spark.createDataFrame(slots or [(0, 0, 0, 1, 0, 0)], "length long, low long, high long, each long, first long, base long")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = by_task.withColumn("before", F.coalesce(before, F.lit(0))).select("length", "task", "before")
    ranked = cut.join(starts, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    runs = F.broadcast(runs) if len(slots) <= MOST_SLOTS else runs
    placed = ranked.alias("p").join(runs.alias("r"), (F.col("p.length") == F.col("r.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    k = F.col("rank") - F.col("low")
    return placed.select("p.doc", "piece", "start", F.col("p.length").alias("length"), "ids_crc32",
                         (F.col("first") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"),
                         (F.col("base") + k % F.col("each") * F.col("p.length")).cast("long").alias("offset"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
