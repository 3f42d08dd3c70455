"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, decontamination, packing.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.

A stage needs the columns doc_id and text; other columns, whatever their
names, are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.llm import classifier, decontaminate, line_dedup, packing, parity_join
from tripfold.llm.shared import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the classifier rejects go. It is fitted on ``docs`` itself and the labels."""
    model = classifier.trained(docs, table(spark, sf_dir, "labels"))
    return classifier.accepted(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: later repeats of a run are cut out of the texts; a document that loses all its words goes."""
    found = line_dedup.deduplicated(docs, docs.columns)
    emptied = (F.col("words_deleted") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    out = [F.col("text") if c.lower() == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns]
    out = [F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else x for c, x in zip(docs.columns, out, strict=True)]
    return found.where(~emptied | F.col("text").isNull()).select(*out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each group of near duplicates the document with the smallest id stays."""
    return parity_join.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark passage go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    return found.where("n_hit = 0").select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the kept documents as pieces of training sequences."""
    return packing.digest(packing.packed(packing.tokenized(docs, ["doc_id"])))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: The tokenizer and the fitted classifier have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
