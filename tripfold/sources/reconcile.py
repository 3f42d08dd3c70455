"""What the trip files hold, before they are scanned: types by file, and a read that brings them together.

Monthly files drift in type from release to release.  Spark takes a scan's
declared schema at its word: a narrower type is widened in silence, a missing
column reads as NULL, a timestamp reads as a bigint, and a type that can't be
read fails the scan in the middle.  Here the footers are read first, on the
executors (a few kilobytes a file, no data), and every column of every file is
compared with the schema:

=========  ==============================================================
same       the declared type
widened    read as the declared type without loss (int as bigint)
missing    not in the file; NULL
conflict   a scan would fail, or give other values (string, bigint for int)
=========  ==============================================================

``read_reconciled`` refuses conflicts (``on_conflict="fail"``) or casts them:
files are grouped by the types they have, each group is read under its own types
and cast to the schema, and the groups are put together by UNION ALL.  A value
that can't be cast fails the read (ANSI).  There are as many groups as there are
combinations of types, not files.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold import schema as S
from tripfold.plans.unions import union_all
from tripfold.sources.files import list_files

# For a declared type, the types that Spark reads as it without loss.
WIDENED = {
    "int": {"tinyint", "smallint"},
    "bigint": {"tinyint", "smallint", "int"},
    "double": {"tinyint", "smallint", "int", "float"},
    "timestamp_ntz": {"timestamp_ntz_ms"},
}
REPORT = "file string, column string, declared string, type string, verdict string"
#: Footers read by a task.
FILES_PER_TASK = 200


class SchemaConflictError(ValueError):
    """Some files hold a column in a type that can't be read as the declared one."""


def _spark_type(kind: pa.DataType) -> str:
    """Spark's name of an Arrow type; a type that a scan treats otherwise has a name of its own."""
    if pa.types.is_timestamp(kind):
        zone = "timestamp" if kind.tz else "timestamp_ntz"
        return zone if kind.unit == "us" else f"{zone}_{kind.unit}"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    names = {pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint", pa.float32(): "float",
             pa.float64(): "double", pa.bool_(): "boolean", pa.date32(): "date", pa.null(): "void"}
    return names.get(kind, str(kind))


def _open(uri: str):
    """An input file for a Hadoop path (``file:/x`` too)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + uri.removeprefix("file:").lstrip("/"))
    where, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
    return where.open_input_file(path)


def verdict(declared: str, found: str | None) -> str:
    if found is None:
        return "missing"
    if found in (declared, "void") or (declared, found) == ("timestamp_ntz", "timestamp"):
        return "same"  # a time zone mark only says how the clock was set; the stored clock is read
    return "widened" if found in WIDENED.get(declared, ()) else "conflict"


def _footers(schema: T.StructType):
    wanted = [(f.name, f.dataType.simpleString()) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for uri in batch.column("file").to_pylist():
                with _open(uri) as source:
                    # Spark's reader matches names without regard to case
                    has = {f.name.lower(): _spark_type(f.type) for f in pq.ParquetFile(source).schema_arrow}
                for column, declared in wanted:
                    found = has.get(column.lower())
                    out.append((uri, column, declared, found, verdict(declared, found)))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["file", "column", "declared", "type", "verdict"])

    return run


def type_report(spark: SparkSession, files: Iterable[str], schema: T.StructType = S.TRIPS) -> DataFrame:
    """(file, column, declared, type, verdict) for every declared column of every file, from the footers."""
    listed = sorted(set(files))
    tasks = max(1, -(-len(listed) // FILES_PER_TASK))
    rows = spark.createDataFrame([(f,) for f in listed], "file string").repartition(tasks)
    return rows.mapInArrow(_footers(schema), REPORT)


def summary(report: DataFrame) -> DataFrame:
    """Files by column, type and verdict, with one of them as an example."""
    return report.groupBy("column", "declared", "type", "verdict").agg(
        F.count(F.lit(1)).alias("files"), F.min("file").alias("example"))


def _own_type(declared: T.DataType, found: str | None) -> T.DataType:
    """The type to read a column under: the declared one where a scan may, else the file's own."""
    if verdict(declared.simpleString(), found) != "conflict":
        return declared
    if found.startswith("timestamp"):
        return T.TimestampNTZType()
    return T.StructType.fromDDL(f"x {found}")["x"].dataType


def _cast(column: str, declared: T.DataType, found: str | None):
    return F.col(column) if verdict(declared.simpleString(), found) != "conflict" else F.col(column).cast(declared)


def read_reconciled(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = S.TRIPS,
                    on_conflict: str = "fail") -> DataFrame:
    """Trip files as one table of the declared schema, after a look at their footers."""
    if on_conflict not in ("fail", "cast"):
        raise ValueError(f"on_conflict is 'fail' or 'cast', not {on_conflict!r}")
    files = list_files(spark, paths)
    report = type_report(spark, files, schema)
    # one row for each combination of types; the files of a group are names, as in a listing
    types = F.sort_array(F.collect_list(F.struct("column", "type", "verdict")))
    groups = report.groupBy("file").agg(types.alias("types")).groupBy("types").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    bad = [(t["column"], t["type"], g["files"][0]) for g in groups for t in g["types"] if t["verdict"] == "conflict"]
    if bad and on_conflict == "fail":
        shown = "; ".join(f"{c} is {t} in {f}" for c, t, f in sorted(bad)[:5])
        raise SchemaConflictError(f"{len(bad)} column types can't be read as declared: {shown}")
    frames = []
    for group in sorted(groups, key=lambda g: g["files"][0]):
        found = {t["column"]: t["type"] for t in group["types"]}
        own = T.StructType([T.StructField(f.name, _own_type(f.dataType, found[f.name]), True) for f in schema.fields])
        frames.append(spark.read.schema(own).parquet(*group["files"]).select(
            *[_cast(f.name, f.dataType, found[f.name]).alias(f.name) for f in schema.fields]))
    return union_all(frames)
