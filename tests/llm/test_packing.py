import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from helpers import corpus
from tripfold.llm import packing

EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*EXACT.encode(text or "", add_special_tokens=False).ids, 0]


def test_pieces_are_those_of_the_tokenizer_and_tile_the_sequences(docs):
    capacity = 256
    got = packing.digest(packing.packed(packing.tokenized(docs, ["doc_id"], capacity=capacity), capacity)).collect()
    want = []
    for i, text in corpus():
        ids = ids_of(text)
        parts = packing.pieces(len(ids), capacity)
        assert sum(n for _, n in parts) == len(ids) and all(n == capacity for _, n in parts[1:])
        want += [(i, p, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for p, (s, n) in enumerate(parts)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    bound = -(-sum(r.length for r in got) // capacity)
    assert len(sequences) <= bound * 1.05 + 2


def test_fast_encoder_gives_the_tokenizers_ids():
    rng = random.Random(5)
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1 '{chr(c)}s" for c in [*range(0x260), 0x2028, 0x4E2D, 0x1F600, 0xFFFD]]
    texts += ["".join(rng.choice("ab éß\n\t 1'sA\xa0|*") for _ in range(60)) for _ in range(300)] + ["x <|endoftext|> y", "", " "]
    for t in texts:
        assert packing.encode(t) == EXACT.encode(t, add_special_tokens=False).ids, repr(t)


def test_plan_places_every_piece_once_and_is_tight():
    rng = np.random.default_rng(2)
    for total in (0, 1, 50, 5000):
        counts = np.bincount(rng.integers(1, 513, total), minlength=513)
        plan = packing.plan(counts, 512, 60)
        placed = np.zeros(513, np.int64)
        for config, copies in plan:
            assert sum(config) <= 512
            for n in config:
                placed[n] += copies
        assert (placed == counts).all()
        volume = int((counts * np.arange(513)).sum())
        assert sum(c for _, c in plan) <= volume / 512 * 1.05 + 2
    # no better fill exists: pieces over half a sequence never share one
    counts = np.zeros(11, np.int64)
    counts[6], counts[4], counts[3] = 10, 5, 5
    assert sum(c for _, c in packing.plan(counts, 10, 20)) == 10


def test_a_histogram_of_few_lengths_is_packed_near_the_dual_bound():
    for n in (100, 1000):
        counts = np.zeros(2049, np.int64)
        for size, times in ((800, 1), (750, 2), (700, 2), (648, 1), (624, 2), (548, 1)):
            counts[size] = n * times
        plan, bound = packing.bounded_plan(counts, 2048)
        placed = sum(np.bincount(config, minlength=2049) * copies for config, copies in plan)
        assert (placed == counts).all() and all(sum(config) <= 2048 for config, _ in plan)
        assert bound == 3 * n  # three full configurations: 750+750+548, 800+624+624, 700+700+648
        assert sum(copies for _, copies in plan) <= 1.01 * bound + 1


def checked(counts, capacity=2048):
    plan, bound = packing.bounded_plan(counts, capacity)
    assert all(sum(config) <= capacity and copies > 0 for config, copies in plan)
    placed_by = np.zeros(capacity + 1, np.int64)
    for config, copies in plan:
        for n in config:
            placed_by[n] += copies
    assert (placed_by == counts).all()
    return sum(copies for _, copies in plan), bound


def test_gap_to_the_dual_bound():
    rng = np.random.default_rng(1)
    forty, many = np.zeros(2049, np.int64), np.zeros(2049, np.int64)
    forty[rng.integers(200, 1200, 40)] = rng.integers(100, 3000, 40)
    many[rng.choice(np.arange(20, 1500), 700, replace=False)] = rng.integers(1, 300, 700)
    for counts, gap in ((forty, 0.015), (many, 0.005)):
        used, bound = checked(counts)
        assert bound <= used <= bound * (1 + gap) + 1, (used, bound)


def test_the_program_gives_the_plan():
    counts = np.zeros(2049, np.int64)
    for size, times in ((800, 1), (750, 2), (700, 2), (648, 1), (624, 2), (548, 1)):
        counts[size] = 1000 * times
    amounts, total, bound = packing.fractional(counts, 2048)
    for size in np.flatnonzero(counts):  # every length is covered, and no cover can be smaller than the bound
        assert sum(a * config.count(size) for config, a in amounts.items()) >= counts[size] * (1 - 1e-9)
    assert bound <= 3000 * (1 + 1e-9) and total <= bound * (1 + packing.ACCURACY)
    plan = packing.plan(counts, 2048)
    assert sum(n for config, n in plan if config in amounts) >= 0.99 * sum(n for _, n in plan)
    assert sum(n for _, n in packing.best_fit(counts, 2048)) > 3100  # best fit alone


def test_a_length_that_is_there_once_is_used_once():
    counts = np.zeros(101, np.int64)
    counts[[50, 30, 20, 25]] = 1, 1, 1, 3
    used, bound = checked(counts, 100)
    assert used == bound == 2
    assert all(config.count(50) <= 1 for config in packing.fractional(counts, 100)[0])


def test_columns_with_dots(spark):
    docs = spark.createDataFrame([(1, "a b", 2)], "doc_id long, text string, `meta.url` int")
    (row,) = packing.packed(packing.tokenized(docs, docs.columns)).collect()
    assert (row.doc["meta.url"], row.sequence_id, row.offset) == (2, 0, 0)


def test_empty_table(no_docs):
    assert packing.packed(packing.tokenized(no_docs, ["doc_id"])).count() == 0
