"""Incremental partials: new trip files → partial aggregates, exactly once.

The single-machine baseline walks the monthly files one by one, keeps a
small partial aggregate per file and merges them at the end.  Here that is
a Structured Streaming query over the folder the trip files land in:

* the file source picks up only files it has not seen (tracked in the
  query checkpoint), optionally a bounded number per micro-batch;
* each micro-batch is cleaned, counted and reduced to partials in one scan
  (``foreachBatch``) and committed as the batch ``ingest-<n>`` of the
  ``PartialsStore``, so a retried batch replaces its own output; the commit
  names its files and its trips by broken rules;
* a file that another batch of the store holds (an ``analyze`` run, say) stops
  the ingest, or takes that batch's place (``on_overlap="replace"``);
* the checkpoint belongs to the store (``<store>/_checkpoint`` unless one is
  named), so every run that writes to a store goes on where the last one
  ended, and batch numbers are never given twice;
* readers sum over batches, with pruning on ``period``.

``trigger(availableNow=True)`` processes the backlog and stops, which is
how a nightly/monthly catch-up runs; a processing-time trigger keeps it
running for continuous arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripfold import schema as S
from tripfold.functions import derive as D
from tripfold.functions.rules import Rule
from tripfold.store import BATCH, INPUT, PartialsStore

# The file of each row, for the commit.
_FILE = ("struct(_metadata.file_path AS path, _metadata.file_size AS bytes, "
         f"unix_millis(_metadata.file_modification_time) AS modified) AS {INPUT}")


def _writer(store_path: str, rules: list[Rule], period: str, on_overlap: str):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        store = PartialsStore(batch.sparkSession, store_path)
        store.load(batch, rules, f"ingest-{batch_id}", period=period, on_overlap=on_overlap)

    return write_batch


def start(spark: SparkSession, source_dir: str, store_path: str, rules: list[Rule],
          checkpoint: str | None = None, period: str = D.PERIOD_MONTH_SQL,
          max_files_per_trigger: int | None = None,
          available_now: bool = True, processing_time: str | None = None,
          on_overlap: str = "refuse") -> StreamingQuery:
    """Start the ingest query; returns the running ``StreamingQuery``.

    ``rules`` decide what is kept (``strict_rules(None)`` keeps every year).
    ``checkpoint`` defaults to a folder inside the store.
    """
    reader = spark.readStream.schema(S.TRIPS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.parquet(source_dir).selectExpr(*S.TRIPS.fieldNames(), _FILE)
    writer = (stream.writeStream.foreachBatch(_writer(store_path, rules, period, on_overlap))
              .option("checkpointLocation", checkpoint or f"{store_path.rstrip('/')}/_checkpoint"))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def batches(spark: SparkSession, store_path: str) -> DataFrame:
    """Which batches wrote how many partial rows and trips."""
    return PartialsStore(spark, store_path).read().groupBy(BATCH).agg(
        F.count(F.lit(1)).alias("partial_rows"), F.sum("trips").alias("trips"))
