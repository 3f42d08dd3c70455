"""The trip fact as one folder per month: ``<path>/period=<first day>/``.

A job over some months lists and reads their folders only (partition pruning);
a pickup-time range says which, so a caller can't miss rows by it.  Months are
written by a rebalance on the month, whose large partitions AQE splits into files
of its advisory size: a hot month isn't one task's work, a small one is one file.
Trips without a pickup time have a folder of their own (NULL period).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold import hadoop as H
from tripfold import schema as S
from tripfold.functions import derive as D


def write_curated(trips: DataFrame, path: str) -> None:
    """Trips → month folders (replaces what is there); columns beyond the trip schema are kept."""
    (trips.withColumn(S.PERIOD, F.expr(D.PERIOD_MONTH_SQL)).hint("rebalance", S.PERIOD)
     .write.mode("overwrite").partitionBy(S.PERIOD).parquet(path))


def read_curated(spark: SparkSession, path: str, schema: T.StructType = S.TRIPS, start: dt.date | None = None,
                 end: dt.date | None = None) -> DataFrame:
    """Trips of the months ``start <= period < end`` (all months, and trips without a time, if neither is named)."""
    trips = spark.read.schema(T.StructType([*schema.fields, T.StructField(S.PERIOD, T.DateType(), True)])).parquet(path)
    if start is not None:
        trips = trips.where(F.col(S.PERIOD) >= F.lit(start))
    if end is not None:
        trips = trips.where(F.col(S.PERIOD) < F.lit(end))
    return trips


def months(spark: SparkSession, path: str) -> list[dt.date]:
    """The months that a curated fact has, in order (a listing, no scan)."""
    found = [re.fullmatch(rf"{S.PERIOD}=(\d{{4}}-\d\d-\d\d)", n) for n in H.names(spark, path)]
    return sorted(dt.date.fromisoformat(m[1]) for m in found if m)


def first_months(spark: SparkSession, path: str, k: int, schema: T.StructType = S.TRIPS) -> DataFrame:
    """Trips of the first ``k`` months, from ``k`` folders."""
    have = months(spark, path)
    kept = have[: max(0, k)]
    if not kept:
        return read_curated(spark, path, schema).where("false")
    return read_curated(spark, path, schema, kept[0], kept[-1] + dt.timedelta(days=1))


def of_year(spark: SparkSession, path: str, year: int, schema: T.StructType = S.TRIPS) -> DataFrame:
    """Trips of a calendar year, from its folders."""
    return read_curated(spark, path, schema, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))
