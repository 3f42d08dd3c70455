"""File sources: the trip fact (Parquet) and the zone dimension (CSV/Parquet)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold import schema as S


def read_trips(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Scan one or many trip Parquet files (globs allowed) as one table.

    The explicit schema reads only the columns the analysis needs; Catalyst
    prunes further per query, and comparisons on these columns reach the
    Parquet reader as pushed filters.  Spark
    reads a compatible narrower type (int for bigint) as the schema's type; a
    type that cannot be read as it (a string for a number) fails the scan.
    """
    if isinstance(paths, str):
        paths = [paths]
    return spark.read.schema(S.TRIPS).parquet(*list(paths))


def list_files(spark: SparkSession, patterns: str | Iterable[str]) -> list[str]:
    """Files that match the patterns, sorted, on any filesystem Spark can read.

    A pattern that names a folder stands for the Parquet files in it.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = set()
    for pattern in [patterns] if isinstance(patterns, str) else patterns:
        fs = hadoop(pattern).getFileSystem(conf)
        for status in fs.globStatus(hadoop(pattern)) or []:
            if status.isDirectory():
                inner = fs.globStatus(hadoop(status.getPath(), "*.parquet")) or []
                found.update(s.getPath().toString() for s in inner)
            else:
                found.add(status.getPath().toString())
    if not found:
        raise FileNotFoundError(f"no file matches {patterns}")
    return sorted(found)


def read_trip_slices(spark: SparkSession, paths: list[str], k: int) -> DataFrame:
    """The first ``k`` files in sorted order (one file per period)."""
    return read_trips(spark, sorted(paths)[:k])


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with header → (PULocationID, Borough, Zone).

    Columns are taken by the names in the header, in whatever order they
    stand.  ``N/A`` is a real borough/zone value and stays a string (no
    ``nullValue`` option).  A malformed id fails the read rather than
    turning into a NULL key.
    """
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    number = F.col("LocationID").try_cast("int")
    bad = F.raise_error(F.concat(F.lit("malformed LocationID: "), F.col("LocationID")))
    key = F.when(F.col("LocationID").isNull() | number.isNotNull(), number).otherwise(bad.cast("int"))
    return raw.select(key.alias(S.LOCATION), S.BOROUGH, S.ZONE)


def read_zones_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        F.col(S.LOCATION).cast("int").alias(S.LOCATION), S.BOROUGH, S.ZONE)
