import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripfold.llm import spelling
from tripfold.llm.catalog import op13_spelling_variant_grouping

SF = "/root/testdata/sf0.001"


def count(rows, slips):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if slips and h % slips == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def edits(w):
    """All texts that one deletion makes, with the place, and the text itself without a place."""
    return [(w[:i] + w[i + 1 :], i) for i in range(len(w))]


def near(words):
    """Near words by deletions: replaced (same deletion at the same place) or deleted."""
    out, same = defaultdict(set), defaultdict(list)
    for w in words:
        for x, i in edits(w):
            if x in words:
                out[w].add(x)
                out[x].add(w)
            same[x, i].append(w)
    for group in same.values():
        for w in group:
            out[w] |= set(group) - {w}
    return out


def brute(n):
    close = near(n)
    form = {}
    for w in n:
        best = min(close[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None)
    return out


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def odd_words(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(250):
        w = "".join(rng.choice("abçé") for _ in range(rng.randrange(4, 9)))
        for _ in range(4):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abçéZ") + w[i:], w[:i] + "x" + w[i + 1 :], w])
            out += [w or "a"] * rng.randrange(1, 12)
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("hot", [64, 2, 0])
def test_against_brute_force(spark, hot):
    rng, words = random.Random(9), odd_words(9)
    rows = [(i, rng.choice(" ,-\n7÷ ").join(words[i::23])) for i in range(23)] + [(50, None), (None, "aaaaa bbbbb aaaaa aaaab aaaaa"), (51, ""), (51, ""), (52, "aaaaaa " * 40 + "a" * 90 + " " + "a" * 91), (53, ("b" * 300 + " ") * 3), (54, ("b" * 301 + " ") * 9)]
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, word string, `a.b` int").repartition(4)
    want = brute(count(rows, 5))
    assert sum(v[0] is not None for v in want.values()) > 20 and any(want[v[0]][0] for v in want.values() if v[0])
    assert result(spelling.variants(docs, slips=5, hot=hot)) == want
    if hot == 64:
        assert result(spelling.variants(docs)) == brute(count(rows, None))


def test_a_hot_chunk_gives_no_square_of_pairs(spark):
    rng = random.Random(4)
    words = {"common" + "".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(3000)}
    words |= {w[:8] + "z" + w[9:] for w in sorted(words)[:50]} | {w + "q" for w in sorted(words)[50:90]} | {"q" + w for w in sorted(words)[90:99]}
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = [(r.a, r.b) for r in spelling.near_pairs(table).collect()]
    want = {frozenset((a, b)) for a, others in near(words).items() for b in others}
    assert len(got) == len(want) >= 99 and {frozenset(p) for p in got} == want


def test_crc_of_ranges():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    start = rng.integers(0, 4000, 300)
    end = start + rng.integers(0, 200, 300)
    seed = rng.integers(0, 1 << 32, 300).astype(np.uint32)
    got = spelling.crc32_of(data, start, end, seed)
    assert [int(x) for x in got] == [zlib.crc32(data[a:b].tobytes(), int(s)) for a, b, s in zip(start, end, seed, strict=True)]


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(count(rows, 97))
    assert len(want) > 500
    assert result(op13_spelling_variant_grouping(spark, SF)) == want


def test_counts_leave_a_task_in_parts(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["alpha beta gamma delta " * 4, "alpha gamma epsilon " * 3, "Ünder über ÜBER"] * 9)]
    want = Counter(w for i, t in rows for w in re.findall("[a-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if len(w) >= 5)
    monkeypatch.setattr(spelling, "MOST_WORDS", 2)
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"id": [i], "text": [t]}) for i, t in rows]
    got = Counter()
    for out in spelling._count(5, None)(iter(batches)):
        for w, n in zip(out.column("word").to_pylist(), out.column("n").to_pylist(), strict=True):
            got[w] += n
    assert got == want


def test_empty_table(spark, no_docs):
    out = spelling.variants(no_docs)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
