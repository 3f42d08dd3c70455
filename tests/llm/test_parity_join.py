import numpy as np
import pytest

from helpers import corpus, words
from tripfold.llm import parity_join
from tripfold.llm.components import components


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root(i)] = min(doc_id, ids.get(root(i), doc_id))
    return [(rows[i][0], len(sets[i]), ids.get(root(i))) for i in range(len(rows))]


@pytest.mark.parametrize("hot", [32, 1])
def test_matches_brute_force(docs, hot):
    found = parity_join.digest(parity_join.Join(docs, hot=hot).classes())
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute(corpus()), key=repr)


def test_large_groups_of_near_copies_and_a_common_passage(spark):
    rows = []
    base = [f"b{i}" for i in range(150)]
    passage = [f"p{i}" for i in range(60)]
    for i in range(120):
        near = list(base)
        near[i % 150] = f"x{i}"
        rows.append((i, " ".join(near)))
        rows.append((1000 + i, " ".join([f"u{i}_{k}" for k in range(100)] + passage)))
    got = parity_join.digest(parity_join.Join(spark.createDataFrame(rows, "doc_id long, text string"), hot=8).classes())
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))


def test_pigeonhole_bounds():
    rng = np.random.default_rng(1)
    for n in [1, 2, 3, 7, 15, 16, 40, 63, 64, 100, 255, 256, 700, 1500]:
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for other in range(-(-3 * n // 4), n * 4 // 3 + 1, max(1, n // 5)):
            # the farthest set of that size that is still near
            apart = (n + other) // 7
            inter = -(-(n + other - apart) // 2)
            if inter > min(n, other) or 4 * inter < 3 * (n + other - inter):
                continue
            b = np.unique(np.concatenate((a[:inter], rng.integers(0, 1 << 63, other - inter, dtype=np.uint64))))
            bands = set(parity_join.bands(n)) & set(parity_join.bands(other))
            assert any(set(parity_join.keys(a, j).tolist()) & set(parity_join.keys(b, j).tolist()) for j in bands), (n, other)


def test_representatives_keep_one_row_of_each_group(docs):
    kept = parity_join.representatives(docs)
    assert kept.columns == docs.columns
    want = brute(corpus())
    filled = {c for _, n, c in want if n}
    rows = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in rows if i in filled) == sorted(filled)
    assert len(rows) == len(filled) + sum(n == 0 for _, n, _ in want)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (300, 300), (None, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}


def test_empty_table(no_docs):
    assert parity_join.Join(no_docs).classes().count() == 0
    assert parity_join.representatives(no_docs).count() == 0
