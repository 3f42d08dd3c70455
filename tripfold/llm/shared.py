"""Helpers that the operators share: reading tables, the shared scratch folder, salted joins."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in an Arrow batch handed to a Python task, at most. Texts are long, so far fewer than Spark's default.
ARROW_ROWS = 512
ARROW_BYTES = 16 << 20
_shipped: dict[str, str] = {}
_local: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Before Python tasks: batches of at most ``ARROW_ROWS`` rows and ``ARROW_BYTES``, and this package on the executors' path.

    The batch settings are read when a query runs, so they stay in the session; smaller ones are left alone.
    """
    for key, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(spark.conf.get(key).rstrip("bB"))
        if now > most or now <= 0:
            spark.conf.set(key, str(most))
    sc = spark.sparkContext
    if _shipped.get("to") != sc.applicationId:
        root = Path(__file__).resolve().parents[1]
        name = Path(tempfile.mkdtemp(prefix="tripfold-code-")) / "tripfold_code.zip"
        with zipfile.ZipFile(name, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        sc.addPyFile(str(name))  # the code only, as spark-submit --py-files sends it
        _shipped["to"] = sc.applicationId


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; on a local master a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.applicationId not in _local:
        _local[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="tripfold-")
    return _local[spark.sparkContext.applicationId]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def salted_join(left: DataFrame, right: DataFrame, key: str, salts: int, how: str = "left") -> DataFrame:
    """Join many rows of ``left`` to one row a key of ``right``; the rows of a hot key go to ``salts`` tasks.

    ``right`` is repeated ``salts`` times, so it should be much smaller than ``left``. The salt is a hash of the row, so a
    task that runs again gives its rows the same salts; rows that are equal in every column stay together.
    """
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*[named(c) for c in left.columns]), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [key, "_salt"], how).drop("_salt")


def named(column: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """Only A-Z are lower-cased."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that ``df`` does not use."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out
