import hashlib
import random
import re

import pytest

from helpers import corpus, lower, prose
from tripfold.llm import decontaminate


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute(text, items):
    w, hit, found = split(text), set(), set()
    for item_id, item in items:
        v = split(item)
        k = min(len(v), 10)
        for q in range(len(v) - k + 1 if v else 0):
            for p in range(len(w) - k + 1):
                if w[p : p + k] == v[q : q + k]:
                    hit |= set(range(p, p + k))
                    if item_id is not None:
                        found.add(str(item_id))
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


ITEMS = [(1, " ".join(prose(random.Random(9), 30).split())), (2, "one two"), (3, None), (4, ""), (5, "a b c d e"), (10, corpus()[9][1][:200]), (5, "seven old men sing about rivers and stones in early"), (None, corpus()[20][1][:150]), (11, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")]


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_matches_brute_force(spark, docs, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.digest(decontaminate.contamination(docs, bench, ["doc_id"], block_bytes=block)).collect()
    want = [(i, *brute(t, ITEMS)) for i, t in corpus()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r[-1] for r in want) > 3


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, 40)) for i in range(20)]
    rows = []
    for i in range(100):
        v = split(items[i % 20][1])
        a = rng.randrange(len(v) - 10)
        cut = v[a : a + (9 if i % 2 else 10)]
        rows.append((i, " ".join([*split(prose(rng, rng.randrange(30), 10**6)), *cut, *split(prose(rng, 5, 10**6))])))
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])
    got = {r[0]: r for r in decontaminate.digest(got).collect()}
    for i, text in rows:
        assert tuple(got[i])[1:] == brute(text, items)


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(no_docs, none, ["doc_id"]).count() == 0
    assert decontaminate.contamination(docs, none, docs.columns).where("n_hit > 0").count() == 0
