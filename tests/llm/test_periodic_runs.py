import hashlib
import random
import re
import zlib

import numpy as np

from tripfold.llm import periodic_runs
from tripfold.llm.catalog import op11_periodic_run_detection

SF = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w):
    """Runs by comparing the words with themselves at every distance."""
    out, code = [], np.unique(np.array(w, dtype=object).astype(str), return_inverse=True)[1] if w else np.zeros(0)
    for q in range(1, len(w) // 4 + 1):
        same = np.concatenate(([False], code[q:] == code[:-q], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1]).tolist()
        for a, b in zip(edge[::2], edge[1::2], strict=True):
            size = b - a + q
            stretch = code[a : a + size]
            if size >= max(6, 4 * q) and not any((stretch[d:] == stretch[:-d]).all() for d in range(1, q)):
                out.append((a, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def looped(i, w):
    h, n = zlib.crc32(str(i).encode()), len(w)
    if i is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def odd_texts():
    rng = random.Random(3)
    texts = ["", " \n", "a", "a " * 5, "a " * 6, "a " * 400, "ab ba " * 30, "A a " * 4 + "A", "x " + "a b c " * 4, "a b c d " * 3 + "a b c", "ß ñ\x0b" * 9 + "ß", "a a a a a a b b b b b b " * 5]
    for k in (1, 2, 3, 5):
        for n in (7, 30, 120):
            texts += [" ".join(rng.choice("abcde"[:k]) for _ in range(n)) for _ in range(8)]
    for _ in range(40):  # loops within loops, with changed words
        w = [rng.choice("abc") for _ in range(rng.randrange(1, 7))]
        for _ in range(rng.randrange(1, 4)):
            w = w * rng.randrange(1, 6) + [rng.choice("abcd") for _ in range(rng.randrange(3))]
        texts.append(" ".join(w[:600]))
    return texts


def test_against_brute_force(spark):
    rows = [*enumerate(odd_texts()), (10**6, None), (None, "z " * 8), (3, "z " * 8), (3, "z " * 8)]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, runs int, doc int, `a.b` int").repartition(3)
    got = periodic_runs.detected(docs, docs.columns).collect()
    assert len(got) == len(rows) and sum(len(r.runs) for r in got) > 100
    for r in got:
        w = split(r.doc.text)
        want = brute(w)
        assert [tuple(x) for x in r.runs] == want, r.doc.text
        assert (r.n_words, r.collapsed, r.doc.runs, r.doc["a.b"]) == (len(w), collapse(w, want), 1, 3)


def test_slices_of_many_texts_and_one_long_text(spark):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(10**5)}" for _ in range(60_000)) + " tail" * 9 + " x" + " p q r" * 5_000
    docs = spark.createDataFrame([(1, long), (2, "short text"), (3, "word " * 150_000)], "doc_id long, text string").coalesce(1)
    got = {r.doc.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.detected(docs, ["doc_id"]).collect()}
    assert got == {1: [(60_000, 9, 1), (60_010, 15_000, 3)], 2: [], 3: [(0, 150_000, 1)]}


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in op11_periodic_run_detection(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(got) == set(texts) and sum(r.n_runs > 0 for r in got.values()) > 10
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, text in texts.items():
        w = looped(i, split(text))
        want, r = brute(w), got[i]
        best = min(want, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (None if not want else 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{a},{b},{c}\n" for a, b, c in want))
        assert r.collapsed_sha256 == sha(collapse(w, want))


def test_empty_table(spark, no_docs):
    out = periodic_runs.digest(periodic_runs.detected(no_docs, no_docs.columns))
    assert out.count() == 0 and dict(out.dtypes)["exponent_milli"] == "bigint"
