import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tripfold.llm import rank_profiles
from tripfold.llm.catalog import op12_language_id

SIZE = rank_profiles.SIZE


def grams(text):
    """N-grams by the definition: words of letters, one edge at both ends."""
    words, own = [], ""
    for c in (text or "") + " ":
        if c.isalpha():
            own += c.lower()[0]
        elif own:
            words.append(own)
            own = ""
    out = Counter()
    for w in words:
        full = "\x01" + w + "\x01"
        for n in (1, 2, 3):
            for k in range(len(full) - n + 1):
                g = full[k : k + n]
                if g != "\x01":
                    out[g] += 1
    return out


def ranked(counts):
    return {g: r for r, g in enumerate(sorted(counts, key=lambda g: (-counts[g], len(g), g))[:SIZE])}


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


def profiles_of(rows):
    total = {}
    for i, text, lang in rows:
        if lang is not None and text is not None and not held(i):
            total.setdefault(lang, Counter()).update(grams(text))
    return {k: ranked(v) for k, v in total.items()}


def predict(profiles, text):
    own = ranked(grams(text))
    if not own or not any(profiles.values()):
        return "und", 0.0
    far = sorted((sum(abs(r - p[g]) if g in p else SIZE for g, r in own.items()), k) for k, p in profiles.items())
    a, b = far[0][0], far[1][0] if len(far) > 1 else SIZE * len(own)
    return far[0][1], b / (a + b) if a + b else 0.5


TEXTS = {"aa": "the old cat and the dog sat in the sun", "bb": "der alte Hund und die Katze üben größer", "cc": "el niño y la señora están aquí ÉL", "dd": "старый пёс и кошка"}


def rows():
    rng = random.Random(2)
    out = []
    for i in range(80):
        lang = rng.choice(list(TEXTS))
        text = " ".join(rng.choice(TEXTS[lang].split()) + rng.choice(["", "", ".", "-x", "7"]) for _ in range(rng.choice([1, 3, 30, 300])))
        out.append((i, text, lang if rng.random() < 0.9 else None))
    out += [(200, None, "aa"), (201, "", "bb"), (202, " 12 -- \n", "cc"), (203, "İstanbul ŒUVRE ﬁ \U00010400\U00010428", None), (204, "漢字 かな", None), (205, "the " * 4000, None), (None, "the cat", "bb"), (5, out[5][1], out[5][2])]
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, "x", 7) for r in rows()], "doc_id long, text string, lang string, lang_pred string, `a.b` int").repartition(3)


def test_counts_of_a_slice():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aBÉß -7\n漢\U00010400") for _ in range(rng.randrange(60))) for _ in range(50)]
    data = "".join(texts).encode()
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    letter, row = rank_profiles._alphabet(np.frombuffer(data, np.uint8), offsets)
    for group in (row, row.astype(np.int64) << 45):  # the second is too wide for one key and is halved
        found = rank_profiles.count(letter, row, group)
        got = {}
        for g, x, n in zip(*found, strict=True):
            text = "".join(chr((int(x) >> s) & 0x1FFFFF) for s in (42, 21, 0)).lstrip("\0")
            got.setdefault(int(g) >> (45 if group is not row else 0), Counter())[text] += int(n)
        assert got == {r: c for r, t in enumerate(texts) if (c := grams(t))}


def test_against_brute_force(table):
    model = rank_profiles.learned(table)
    want = profiles_of(rows())
    assert model.names == sorted(want)
    got = rank_profiles.predicted(table, model, table.columns).collect()
    assert len(got) == len(rows())
    for r in got:
        name, score = predict(want, r.doc.text)
        assert (r.lang_pred, r.doc.lang_pred, r.doc["a.b"]) == (name, "x", 7), r.doc.text
        assert abs(r.score - score) < 1e-12


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op12_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    fold = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in fold) >= 0.99 * len(fold) > 100
    want = profiles_of((i, t, k) for i, (k, t) in truth.items())
    for r in got[::7]:
        assert r.lang_pred == predict(want, truth[r.doc_id][1])[0]


def test_only_a_bounded_sample_is_learned_from(spark):
    rows = [(i, "abc", "en") for i in range(4000)] + [(i, "xyz", "de") for i in range(4000, 4040)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    fold = table.where(~rank_profiles.held_out(table.doc_id))
    for sample in (10**6, 400):
        model = rank_profiles.learned(table, sample=sample)
        seen.append(model)
    assert fold.count() > 3000 and all(m.names == ["de", "en"] and (m.ranks < SIZE).sum() == 20 for m in seen)


def test_no_labels_one_language_and_empty_tables(spark, table, no_docs):
    none = table.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {(r.lang_pred, r.score) for r in rank_profiles.predicted(table, rank_profiles.learned(none), ["doc_id"]).collect()} == {("und", 0.0)}
    one = rank_profiles.learned(table.where("lang = 'aa'"))
    got = {r.doc.doc_id: (r.lang_pred, r.score) for r in rank_profiles.predicted(table, one, ["doc_id"]).collect()}
    want = profiles_of(r for r in rows() if r[2] == "aa")
    assert all(got[i][0] == predict(want, t)[0] and abs(got[i][1] - predict(want, t)[1]) < 1e-12 for i, t, _ in rows())
    assert got[202] == ("und", 0.0) and got[204] == ("aa", 0.5)
    out = rank_profiles.digest(rank_profiles.predicted(no_docs, rank_profiles.learned(no_docs), no_docs.columns))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == 0
