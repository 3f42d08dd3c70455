import math

from pyspark.sql import functions as F

from tripfold import schema as S
from tripfold.plans import reports as Q
from tripfold.plans import scaling as SC
from tripfold.sources import adapters as A

from fixtures import SF_SMALL


def test_scaled_slices_equal_brute_force(spark):
    trips = A.trips_from_events(spark, SF_SMALL)
    got = {(r.k, r.PULocationID): (r.trips, r.avg_tip) for r in SC.scaled_slices(trips).collect()}
    rules = SC.bench_rules()
    days = sorted(r[0] for r in SC.apply_rules(trips, rules).select(F.to_date(S.PICKUP)).distinct().collect())
    for k in SC.SLICE_STEPS:
        last = days[math.ceil(len(days) * k / 12) - 1]
        for r in Q.location_report(trips.filter(F.to_date(S.PICKUP) <= F.lit(last)), digits=6).collect():
            assert got.pop((k, r.PULocationID)) == (r.trips, r.avg_tip)
    assert not got


def test_slices_follow_the_data_and_keep_rows_without_a_time(spark):
    trips = A.trips_from_events(spark, SF_SMALL)
    later = trips.withColumn(S.PICKUP, F.when(F.col("event_id") % 9 > 0, F.col(S.PICKUP) + F.expr("INTERVAL 3 YEARS")))
    rows = SC.scaled_slices(later).where("k = 12").agg(F.sum("trips")).first()[0]
    assert rows == SC.apply_rules(trips, SC.bench_rules()).count()


def test_day_slices_union_is_the_whole_input(spark):
    trips = A.trips_from_events(spark, SF_SMALL)
    parts = SC.day_slices(trips, ("2024-01-11", "2024-01-21"))
    assert sum(p.count() for p in parts) == trips.count()
    assert SC.union_all(parts).count() == trips.count()


def test_slices_read_the_trips_once(spark):
    plan = SC.scaled_slices(A.trips_from_events(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    # the plan reads the stored per-period rows only; the trips were read when those were written
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert scans and all("period" in x and "event_id" not in x for x in scans)
