"""Registered queries of the training-data operators: ``(spark, sf_dir) → DataFrame`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripfold.llm import classifier, decontaminate, extract, licences, line_dedup, packing, parity_join, periodic_runs, quality_rules, rank_profiles, spelling, url_filter, warc
from tripfold.llm.shared import table


def op1_host_word_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op2_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.digest(parity_join.Join(table(spark, sf_dir, "documents")).classes())


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # the table has no paths: a document is taken as a file below its source and language
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licences.digest(licences.scanned(docs, ["doc_id"], path))


def op4_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(quality_rules.judged(table(spark, sf_dir, "documents")))


def op5_content_addressed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_line_winnowing_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.deduplicated(table(spark, sf_dir, "documents"), ["doc_id"]))


def op7_line_block_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.digest(extract.extracted(table(spark, sf_dir, "pages"), ["page_id", "url"]))


def op8_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = classifier.trained(docs, table(spark, sf_dir, "labels"))
    return classifier.digest(classifier.scored(docs, model, ["doc_id"]))


def op9_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs, bench, ["doc_id"]))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.packed(packing.tokenized(table(spark, sf_dir, "documents"), ["doc_id"])))


def op11_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.digest(periodic_runs.detected(docs, ["doc_id"], places=periodic_runs.looped_places))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rank_profiles.digest(rank_profiles.predicted(docs, rank_profiles.learned(docs), ["doc_id"]))


def op13_spelling_variant_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), slips=97)


LLM_QUERIES = {
    "op1_host_word_url_filter": op1_host_word_url_filter,
    "op2_parity_sketch_join": op2_parity_sketch_join,
    "op3_licence_scan": op3_licence_scan,
    "op4_host_quality_rules": op4_host_quality_rules,
    "op5_content_addressed_warc": op5_content_addressed_warc,
    "op6_line_winnowing_dedup": op6_line_winnowing_dedup,
    "op7_line_block_extraction": op7_line_block_extraction,
    "op8_rule_ensemble_quality": op8_rule_ensemble_quality,
    "op9_winnowing_decontamination": op9_winnowing_decontamination,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_periodic_run_detection": op11_periodic_run_detection,
    "op12_language_id": op12_language_id,
    "op13_spelling_variant_grouping": op13_spelling_variant_grouping,
    "pipeline": corpus_pipeline.run,
}

LLM_SQL = {
    "op2_parity_sketch_join": parity_join.SQL,
    "op5_content_addressed_warc": warc.SQL,
    "op4_host_quality_rules": quality_rules.SQL,
    "op9_winnowing_decontamination": decontaminate.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
