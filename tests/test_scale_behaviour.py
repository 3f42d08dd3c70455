"""Behaviour that matters at scale: hot keys, type drift, bounded state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripfold import schema as S
from tripfold.operators.partials import partial_aggregate
from tripfold.functions import rules as R
from tripfold.plans import reports as Q
from tripfold.sources.files import read_trips

from fixtures import BASE, zones


def _skewed_trips(spark, n=30000):
    # a third of all trips at one place (id 1), the rest spread over 2..6
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 5 + 2).cast("int"))
        .alias(S.LOCATION),
        (F.col("id") % 24).cast("int").alias("h"))
    return base.select(
        (F.lit(dt.datetime(2024, 5, 1)).cast("timestamp_ntz")
         + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.col("h"))).alias(S.PICKUP),
        (F.lit(dt.datetime(2024, 5, 1, 0, 30)).cast("timestamp_ntz")
         + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.col("h"))).alias(S.DROPOFF),
        F.lit(BASE[S.PASSENGERS]).cast("bigint").alias(S.PASSENGERS),
        F.lit(BASE[S.DISTANCE]).alias(S.DISTANCE), S.LOCATION,
        F.lit(1).cast("bigint").alias(S.PAYMENT), F.lit(10.0).alias(S.FARE),
        F.lit(2.0).alias(S.TIP), F.lit(12.0).alias(S.TOTAL))


def test_hot_key_is_collapsed_map_side(spark):
    trips = _skewed_trips(spark).repartition(12)
    parts = partial_aggregate(Q.clean_trips(trips, R.strict_rules(2024)), [S.LOCATION])
    plan = spark._jvm.PythonSQLUtils.explainString(parts._jdf.queryExecution(), "formatted")
    assert "partial_count" in plan  # map-side combine before the exchange
    got = {r[S.LOCATION]: r.trips for r in parts.collect()}
    assert got[1] == 10000 and sum(got.values()) == 30000
    top = Q.top_zones(Q.clean_trips(trips, R.strict_rules(2024)), zones(spark), k=2).collect()
    midtown = trips.filter(F.col(S.LOCATION).isin(1, 2)).count()  # ids 1, 2 share the name
    assert (top[0].Zone, top[0].trips) == ("Midtown", midtown)


def test_physical_type_drift_fails_the_scan(spark, tmp_path):
    bad = str(tmp_path / "bad")
    # fare written as a string: the declared schema must not silently accept it
    spark.createDataFrame([("x",)], f"{S.FARE} string").write.parquet(bad)
    with pytest.raises(Exception):
        read_trips(spark, bad).select(S.FARE).collect()
