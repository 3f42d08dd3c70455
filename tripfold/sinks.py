"""Sinks: report CSVs, run metrics; the partials store is ``tripfold.store``."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from tripfold import hadoop as H
from tripfold.store import BATCH, PARTIALS_SCHEMA, STORE_SCHEMA, PartialsStore

__all__ = ["BATCH", "PARTIALS_SCHEMA", "STORE_SCHEMA", "PartialsStore", "write_metrics", "write_report_csv"]

def write_report_csv(report: DataFrame, path: str) -> None:
    """A finished report → the CSV file ``path``, with header, by its name.

    Spark writes one part file to a folder beside it, which is then renamed over
    an older result; a write that fails leaves the older one.  Reports are
    bounded by their key domain, so one file is right: ``coalesce(1)`` keeps a
    sorted report's single partition as it is, and the stages below the last
    exchange still run in parallel.  ``N/A`` values are written as text and
    NULL as an empty field.
    """
    spark = report.sparkSession
    folder, _, name = path.rpartition("/")
    beside = f"{folder}/.{name}-{uuid.uuid4().hex}" if folder else f".{name}-{uuid.uuid4().hex}"
    try:
        report.coalesce(1).write.option("header", True).csv(beside)
        parts = [n for n in H.names(spark, beside) if n.startswith("part-")]
        if parts:
            H.replace(spark, f"{beside}/{parts[0]}", path)
    finally:
        H.delete(spark, beside)


def write_metrics(spark: SparkSession, path: str, **fields) -> DataFrame:
    """Append one run-metrics row (e.g. raw, clean, seconds) as JSON."""
    row = {"run_at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), **fields}
    df = spark.createDataFrame([row])
    df.coalesce(1).write.mode("append").json(path)
    return df
