import re

import pytest

import corpus_pipeline
from helpers import words
from test_decontaminate import split
from test_line_dedup import kept
from test_parity_join import brute as groups
from tripfold.llm import packing

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ranges string, row int, `meta.url` string"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents, and what each stage returned, written and read again."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"file://{tmp_path_factory.mktemp('stage')}/{k}"
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_classifier_stage_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    before = [r.doc_id for r in stages[0].collect()]
    right = [(i in kept) == (labels[i] == 1) for i in before if i in labels]
    assert sum(right) / len(right) > 0.95


def test_line_stage_matches_brute_force(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    got = {r.doc_id: r for r in stages[2].collect()}
    for (i, text), left in zip(rows, kept([t for _, t in rows]), strict=True):
        before = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        if before and not left:
            assert i not in got  # nothing stays of it
        else:
            assert re.findall(r"[^\x20\x09-\x0D]+", got[i].text) == left
            assert got[i].n_chars == len(got[i].text) and (got[i].text == text or len(left) < len(before))
    assert set(got) <= {i for i, _ in rows}


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    want = sorted({c for _, n, c in groups(rows) if n} | {i for i, n, _ in groups(rows) if not n})
    assert sorted(r.doc_id for r in stages[3].collect()) == want


def test_decontamination_stage_drops_what_holds_a_window(spark, stages):
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        v = split(r.text)
        windows |= {tuple(v[i : i + min(10, len(v))]) for i in range(max(1, len(v) - 9)) if v}
    sizes = {len(x) for x in windows}
    hit = lambda t: any(tuple(split(t)[i : i + k]) in windows for k in sizes for i in range(len(split(t)) - k + 1))
    assert sorted(r.doc_id for r in stages[4].collect()) == sorted(r.doc_id for r in stages[3].collect() if not hit(r.text))


def test_packing_stage_holds_every_document_whole(stages):
    pieces = {}
    for r in stages[5].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        assert sum(n for _, n in pieces[i]) == len(packing.encode(text or "")) + 1


def test_odd_rows_and_empty_table(spark):
    rows = [(*r, 0.5, "r", 1, "u") for r in [(1, "x y z", "en", "s", 5), (1, "x y z", "en", "s", 5), (2, None, None, None, None), (None, "", "en", "s", 0), (None, "w " * 40, "en", "s", 80)]]
    for docs in (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], SCHEMA)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_words_of_the_helpers():
    assert words("A\tb\x0bC") == ["a", "b", "c"]
