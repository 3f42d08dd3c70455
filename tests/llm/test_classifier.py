import random
import zlib

import numpy as np
import pytest

from helpers import prose
from tripfold.llm import classifier


def junk(rng):
    return rng.choice([lambda: " ".join(w + "***" for w in prose(rng, 60).split()), lambda: prose(rng, 60).upper().replace(" ", "!! "), lambda: " | ".join(prose(rng, 60).split()), lambda: "Same " * 60])()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    rows = [(i, junk(rng) if i % 4 == 0 else prose(rng, rng.choice([5, 60, 200])), int(i % 4 > 0)) for i in range(1200)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "x y"), (5000, None), (5001, ""), (3, rows[3][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 2 == 0 or i % 3 == 0] + [(None, 1), (5000, None), (99999, 0), (8, 0)], "doc_id long, quality int")
    return docs, labels, rows


def test_held_out_accuracy_and_folds(labelled):
    docs, labels, rows = labelled
    model = classifier.trained(docs, labels)
    got = classifier.digest(classifier.scored(docs, model, ["doc_id"])).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    quality = {i: q for i, _, q in rows}
    held = [r for r in got if r.held_out and r.doc_id in quality]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert len(held) > 150 and np.mean([r.predicted == quality[r.doc_id] for r in held]) > 0.97
    assert model.rules and all(r.predicted == (r.score >= 0.3) for r in got)


def test_compiled_column_equals_the_rules(labelled):
    docs, labels, _ = labelled
    x, y = classifier.sample(docs, labels)
    assert len(y) == len(x) < classifier.MAX_TRAIN and 0 < y.mean() < 1
    model = classifier.fit(x, y)
    stats = classifier.statistics(docs, ["doc_id"]).withColumn("score", classifier.score_column(model)).collect()
    rows = np.array([[r[f] for f in classifier.FEATURES] for r in stats])
    z = model.bias + sum(w * classifier.holds(p, rows) for p, w in model.rules)
    assert np.allclose([r.score for r in stats], 1 / (1 + np.exp(-z)))


def test_accepted_documents_are_those_that_score_enough(labelled):
    docs, labels, _ = labelled
    model = classifier.trained(docs, labels)
    scores = classifier.digest(classifier.scored(docs, model, ["doc_id"])).collect()
    kept = classifier.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r.doc_id for r in scores if r.predicted), key=repr)


def test_held_out_labels_and_other_columns_do_not_matter(labelled, spark):
    docs, labels, _ = labelled
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    assert classifier.trained(docs, labels) == classifier.trained(docs.selectExpr("*", "'z' AS lang", "1 AS quality", "2 AS words"), flipped)


def test_one_class_and_empty_tables(labelled, spark):
    docs, labels, _ = labelled
    ones = classifier.trained(docs, labels.where("quality = 1"))
    assert not ones.rules and classifier.scored(docs, ones, ["doc_id"]).first().score > 0.9
    none = classifier.trained(docs.where("false"), labels.where("false"))
    assert classifier.scored(docs, none, ["doc_id"]).first().score == 0.5
    assert classifier.scored(docs.where("false"), none, ["doc_id"]).count() == 0
