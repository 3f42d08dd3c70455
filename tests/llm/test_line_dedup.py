import random
import re
from collections import defaultdict

import pyarrow as pa
from helpers import corpus, lower, prose
from tripfold.llm import line_dedup


def units(text):
    """Word numbers [a, b) of the units of a text: lines, cut at sentence ends and before capitals."""
    out, n = [], 0
    for line in (text or "").split("\n"):
        last = None
        for w in re.findall(r"[^\x20\x09-\x0D]+", line):
            if last is None or last[-1] in ".!?" or re.match("[A-ZÀ-Þ]", w):
                out.append([n, n])
            last, n = w, n + 1
            out[-1][1] = n
    return out


def kept(texts):
    """The words that stay of every text, by the operator's contract, one window after the other."""
    reach, first, out = line_dedup.REACH, {}, []
    for d, text in enumerate(texts):
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        w, gone = [lower(x) for x in own], set()
        for i in range(len(w) - reach + 1):
            e, j = first.setdefault(tuple(w[i : i + reach]), (d, i))
            if (e, j) != (d, i):  # of a window that overlaps its own first place, only what is behind that goes
                gone |= set(range(i if e < d else max(i, j + reach), i + reach))
        final, at = set(), 0
        while at < len(w):
            stop = at
            while stop in gone:
                stop += 1
            if stop - at >= line_dedup.PASSAGE:
                final |= set(range(at, stop))
            elif stop > at:
                whole = [x for a, b in units(text) if at <= a and b <= stop for x in range(a, b)]
                final |= set(whole if len(whole) >= line_dedup.GRAM else [])
            at = max(stop, at + 1)
        out.append([x for k, x in enumerate(own) if k not in final])
    return out


def check(spark, rows):
    """Every text has exactly the words that stay; number of texts that lost any."""
    got = {r.doc_id: r for r in line_dedup.digest(line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), ["doc_id"])).collect()}
    hit = 0
    for (i, text), words in zip(rows, kept([t for _, t in rows]), strict=True):
        assert re.findall(r"[^\x20\x09-\x0D]+", got[i].text or "") == words, i
        before = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        assert got[i].words_deleted == before - len(words)
        if len(words) == before:
            assert got[i].text == text
        hit += len(words) < before
    return hit


def test_against_brute_force(spark):
    rows = [(i, t) for i, t in corpus(4, 80) if i is not None and i < 1000 and t]
    rows = sorted({i: t for i, t in rows}.items())
    assert check(spark, rows) > 10


def test_passages_of_over_fifty_words_inside_lines(spark):
    rng = random.Random(7)
    passages = [". ".join(prose(rng, 9, 10**6).replace("\n", " ").capitalize() for _ in range(8)) + "." for _ in range(5)]
    rows = [(i, f"{prose(rng, 30, 10**6)} {passages[i % 5]} {prose(rng, 30, 10**6)}") for i in range(60)]
    assert check(spark, rows) == 55
    got = line_dedup.digest(line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"])).collect()
    assert all(r.words_deleted == 0 for r in got if r.doc_id < 5) and all(r.words_deleted >= 40 for r in got if r.doc_id >= 5)


def test_clean_texts_and_edges_stay(spark, docs, no_docs):
    short = "Licensed under the Apache License, Version 2.0."
    rows = [(i, f"unique w{i} text here\n{short}") for i in range(30)] + [(50, None), (51, ""), (None, f"unique null id\n{short}")]
    got = line_dedup.digest(line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"])).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=repr) == sorted(rows, key=repr)
    out = line_dedup.deduplicated(docs, docs.columns).collect()
    assert len(out) == docs.count() and out[0].doc["set"] == "x"
    assert line_dedup.deduplicated(no_docs, ["doc_id"]).count() == 0


def test_line_breaks():
    run = "A b c d e f g h i j k l m n o p q r s t u v w x."
    assert line_dedup.without(f"First line\n{run}\nLast line", [(1, 2)])[0] == "First line\nLast line"
    assert line_dedup.without(f"{run}\nNext.", [(0, 1)])[0] == "Next."
    assert line_dedup.without(f"Start. {run}", [(1, 2)])[0] == "Start."


def test_fifty_words_anywhere_go_to_the_word(spark):
    rng = random.Random(11)
    make = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))  # noqa: E731  no unit ends: one unit a text
    passages = [make(n) for n in (49, 50, 51, 70, 120)]
    texts = [f"{make(rng.randrange(40))} {rng.choice(passages)} {make(rng.randrange(40))}" for _ in range(60)]
    # a passage whose edges first stand in different texts, parts of one, edited copies, a text of one word, a short text
    long = make(200)
    texts += [" ".join(long.split()[a:b]) for a, b in ((60, 140), (0, 90), (100, 200), (0, 200), (20, 75))]
    texts += [" ".join(x if rng.random() < 0.985 else make(1) for x in long.split()) for _ in range(10)] + ["word " * 300, make(5)]
    assert check(spark, list(enumerate(texts))) > 50


def test_texts_that_repeat_a_word_or_a_line(spark):
    rng = random.Random(3)
    line = "Nd, " * 46 + "end."
    texts = ["Nd, " * 376, "Nd, " * 47 + "x " + "Nd, " * 47, f"{line}\n" * 8, "a b " * 200, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) + " Nd, " * 60]
    short = ["Terms apply to all of this.", "One two three four five six seven eight."]
    texts += [f"{short[i % 2]}\n{short[(i + 1) % 2]}\n{' '.join(f'v{rng.randrange(10**6)}' for _ in range(12))}" for i in range(40)]
    block = "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(6)) for _ in range(6))  # short lines that are repeated together
    texts += [f"Start {i} here.\n{block}\nStop {i}." for i in range(6)]
    assert check(spark, list(enumerate(texts))) >= 7


def test_texts_are_cut_by_the_slice_and_not_into_each_other(monkeypatch):
    """A batch is a few slices, not a pass for each text (that took half of the operator's Python time); a stretch ends with its text."""
    made = []
    kind = line_dedup.Units
    monkeypatch.setattr(line_dedup, "Units", lambda part: made.append(1) or kind(part))
    line = " ".join(f"w{i}" for i in range(40))  # one unit without an end: deleted as a whole only
    rows = [(f"{line}\n{line}", [(10, 40), (40, 70)]), (line, [(0, 30)]), (line, [(10, 40)]), (line, [(0, 40)]), (None, None), ("", None), (f" {line} ", None), (f"Ü. A {line}.\n\nEnd é.", [(1, 42)])]
    left = [(" ".join(line.split()[:10]) + "\n" + " ".join(line.split()[30:]), 0, 60), (line, 0, 0), (line, 0, 0), ("", 0, 40), (None, 0, 0), ("", 0, 0), (f" {line} ", 0, 0), ("Ü.\nEnd é.", 1, 41)]
    n = 50
    ranges = pa.array([[{"start": a, "stop": b} for a, b in r] if r else None for _, r in rows] * n, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows) * n)), pa.array([t for t, _ in rows] * n, pa.string()), ranges], names=["doc", "text", "ranges"])
    for some in (batch, batch.slice(len(rows), 2 * len(rows)), batch.slice(4, 3), batch.slice(0, 0)):
        made.clear()
        out = next(line_dedup._apply(line_dedup.GRAM)(iter([some])))
        assert list(zip(*(c.to_pylist() for c in out.columns[1:]), strict=True)) == [left[i % len(rows)] for i in some.column("doc").to_pylist()]
        assert len(made) <= 1
