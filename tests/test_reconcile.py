"""Column types of trip files against the declared schema, and the reconciled read."""

import pytest
from pyspark.sql import functions as F

from tripfold import schema as S
from tripfold.functions.rules import strict_rules
from tripfold.plans import reports as Q
from tripfold.sources import adapters as A
from tripfold.sources import reconcile as C
from tripfold.sources.files import list_files, read_trips

from fixtures import SF_SMALL

RULES = strict_rules(2024)


@pytest.fixture(scope="module")
def mixed(spark, tmp_path_factory):
    """The trips in five files: as declared, narrow, long ids, text amounts, without a column."""
    at = tmp_path_factory.mktemp("mixed")
    trips = A.trips_from_events(spark, SF_SMALL).select(*S.TRIPS.fieldNames()).withColumn("n", F.xxhash64(*S.TRIPS.fieldNames()) % 5)
    kinds = {"plain": {}, "narrow": {S.PASSENGERS: "int", S.PAYMENT: "smallint", S.DISTANCE: "float"}, "long": {S.LOCATION: "bigint", S.PAYMENT: "int"},
             "text": {S.FARE: "string", S.TOTAL: "string"}, "less": {}}
    for k, (name, casts) in enumerate(kinds.items()):
        part = trips.where(f"abs(n) = {k}").drop("n", *([S.TIP] if name == "less" else []))
        part.withColumns({c: F.col(c).cast(t) for c, t in casts.items()}).coalesce(1).write.parquet(f"{at}/{name}")
    return str(at), trips


def rows(df):
    return sorted((tuple(r) for r in df.select(*S.TRIPS.fieldNames()).collect()), key=repr)


def test_report_names_every_type(spark, mixed):
    at, _ = mixed
    report = C.type_report(spark, list_files(spark, f"{at}/*/*.parquet"))
    assert report.count() == 5 * len(S.TRIPS.fields)
    got = {(r.column, r.type): (r.verdict, r.files) for r in C.summary(report).collect()}
    assert got[S.LOCATION, "bigint"] == ("conflict", 1) and got[S.LOCATION, "int"] == ("same", 4)
    assert got[S.FARE, "string"] == ("conflict", 1) and got[S.FARE, "double"] == ("same", 4)
    assert got[S.PASSENGERS, "int"] == ("widened", 1) and got[S.PAYMENT, "smallint"] == ("widened", 1) and got[S.PAYMENT, "int"] == ("widened", 1)
    assert got[S.DISTANCE, "float"] == ("widened", 1) and got[S.TIP, None] == ("missing", 1) and got[S.PICKUP, "timestamp_ntz"] == ("same", 5)


def test_a_conflict_fails_before_the_scan(spark, mixed):
    at, _ = mixed
    with pytest.raises(C.SchemaConflictError, match=f"3 column types.*{S.LOCATION} is bigint in file:"):
        C.read_reconciled(spark, f"{at}/*/*.parquet")
    with pytest.raises(ValueError, match="on_conflict"):
        C.read_reconciled(spark, f"{at}/plain", on_conflict="skip")


def test_cast_gives_the_trips_as_they_were(spark, mixed):
    at, trips = mixed
    got = C.read_reconciled(spark, f"{at}/*/*.parquet", on_conflict="cast")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in S.TRIPS]
    want = trips.withColumn(S.TIP, F.when(F.abs(F.col("n")) == 4, None).otherwise(F.col(S.TIP)))
    assert rows(got) == rows(want)
    report = lambda df: [tuple(r) for r in Q.hour_report(Q.clean_trips(df, RULES, None)).collect()]
    assert report(got) == report(want)
    plan = got.where(f"{S.FARE} > 0").select(S.FARE)._jdf.queryExecution().executedPlan().toString()
    assert S.PICKUP not in plan and plan.count("FileScan") == 5  # pruned, one scan for each combination of types


def test_files_without_a_conflict_are_read_as_before(spark, mixed):
    at, _ = mixed
    paths = [f"{at}/plain", f"{at}/narrow", f"{at}/less"]
    assert rows(C.read_reconciled(spark, paths)) == rows(read_trips(spark, paths))


def test_a_text_that_is_no_number_fails_the_cast(spark, tmp_path):
    path = str(tmp_path / "bad")
    trips = A.trips_from_events(spark, SF_SMALL).select(*S.TRIPS.fieldNames()).limit(3)
    trips.withColumn(S.FARE, F.lit("ten")).coalesce(1).write.parquet(path)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        C.read_reconciled(spark, path, on_conflict="cast").select(S.FARE).collect()


def test_verdicts_are_what_a_scan_does(spark, tmp_path):
    """Every type against every declared type: a scan gives the value, or the verdict is a conflict."""
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    now = dt.datetime(2024, 1, 1, 10)
    kinds = {"i8": pa.array([1], pa.int8()), "i16": pa.array([1], pa.int16()), "i32": pa.array([1], pa.int32()), "i64": pa.array([1], pa.int64()), "f32": pa.array([1.5], pa.float32()),
             "f64": pa.array([1.5]), "text": pa.array(["1"]), "yes": pa.array([True]), "us": pa.array([now], pa.timestamp("us")), "ms": pa.array([now], pa.timestamp("ms")),
             "ns": pa.array([now], pa.timestamp("ns")), "utc": pa.array([now], pa.timestamp("us", "UTC")), "day": pa.array([now.date()]), "dec": pa.array([1], pa.decimal128(9, 2))}
    for name, values in kinds.items():
        path = f"{tmp_path}/{name}.parquet"
        pq.write_table(pa.table({"x": values}), path)
        for declared in ("int", "bigint", "double", "timestamp_ntz"):
            kind = C._spark_type(values.type)
            try:
                got = spark.read.schema(f"x {declared}").parquet(path).first().x
            except Exception:
                got = None
            said = C.verdict(declared, kind)
            if said != "conflict":
                assert got == values[0].as_py().replace(tzinfo=None) if hasattr(got, "year") else got == values[0].as_py(), (name, declared)
            elif got is not None:  # a scan would go through, with values of another meaning
                assert name in ("us", "ms", "ns", "utc", "day") and declared != kind, (name, declared)
