import datetime as dt

from tripfold import schema as S
from tripfold.functions import derive as D
from tripfold.functions.rules import strict_rules
from tripfold.operators.partials import REPORT_KEYS, partial_aggregate
from tripfold.plans import reports as Q
from tripfold.plans import scaling as SC
from tripfold.plans.pipeline import run_pipeline, store_reports
from tripfold.store import PartialsStore
from tripfold.sources import adapters as A

from fixtures import SF_SMALL

RULES = strict_rules(2024)


def _rows(df, digits=6):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, digits) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def test_reports_from_partials_equal_direct(spark):
    trips = A.trips_from_events(spark, SF_SMALL)
    zones = A.zones_from_nation_region(spark, SF_SMALL)
    clean = Q.clean_trips(trips, RULES)
    parts = partial_aggregate(clean)
    assert _rows(Q.hour_report(clean)) == _rows(Q.hour_report(parts, True))
    assert _rows(Q.payment_report(clean)) == _rows(Q.payment_report(parts, True))
    assert _rows(Q.borough_report(clean, zones)) == _rows(Q.borough_report(parts, zones, True))
    assert _rows(Q.zone_report(clean, zones)) == _rows(Q.zone_report(parts, zones, True))


def test_every_report_adds_up_to_the_clean_count(spark):
    trips = A.trips_from_events(spark, SF_SMALL)
    zones = A.zones_from_nation_region(spark, SF_SMALL)
    clean = Q.clean_trips(trips, RULES)
    n = clean.count()
    assert n == 713
    for rep in (Q.hour_report(clean), Q.payment_report(clean),
                Q.borough_report(clean, zones), Q.zone_report(clean, zones)):
        assert sum(r.trips for r in rep.collect()) == n


def test_result_independent_of_partition_count(spark):
    trips = A.trips_from_events(spark, SF_SMALL)
    base = _rows(Q.hour_report(Q.clean_trips(trips, RULES)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert _rows(Q.hour_report(Q.clean_trips(trips.repartition(int(n)), RULES))) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_store_replaces_a_batch_and_keeps_the_others(spark, scratch):
    trips = A.trips_from_events(spark, SF_SMALL)
    parts = partial_aggregate(Q.clean_trips(trips, RULES))
    early = parts.filter(parts[S.PERIOD] < dt.date(2024, 1, 15))
    late = parts.filter(parts[S.PERIOD] >= dt.date(2024, 1, 15))
    store = PartialsStore(spark, scratch + "/partials")
    store.write(early, "a")
    store.write(late, "b")
    store.write(early, "a")  # a repeated run
    assert _rows(store.merged().select(*parts.columns)) == _rows(parts)
    # stricter rules leave nothing of the batch's old periods behind
    store.write(early.filter(parts[S.PERIOD] == dt.date(2024, 1, 2)), "a")
    left = {r[0] for r in store.read("a").select(S.PERIOD).distinct().collect()}
    assert left == {dt.date(2024, 1, 2)}
    pruned = store.periods("2024-01-02", "2024-01-03")
    assert "PartitionFilters: [isnotnull(period" in pruned._jdf.queryExecution().executedPlan().toString()


def test_pipeline_matches_direct_reports(spark, scratch):
    trips = A.trips_from_events(spark, SF_SMALL)
    zones = A.zones_from_nation_region(spark, SF_SMALL)
    for store in (None, PartialsStore(spark, scratch + "/p2")):
        res = run_pipeline(trips, zones, RULES, store=store)
        assert (res.raw_trips, res.clean_trips) == (1000, 713)
        assert [tuple(r) for r in res.by_hour] == [tuple(r) for r in Q.hour_report(Q.clean_trips(trips, RULES)).collect()]
        assert len(res.top_zones) == 15
        assert sum(r.trips for r in res.by_borough) == 713


def test_two_halves_into_one_store_report_themselves(spark, scratch):
    trips = A.trips_from_events(spark, SF_SMALL)
    zones = A.zones_from_nation_region(spark, SF_SMALL)
    store = PartialsStore(spark, scratch + "/halves")
    clean = 0
    for i, half in enumerate(SC.day_slices(trips, ("2024-01-16",))):
        res = run_pipeline(half, zones, RULES, store=store, batch=f"half{i}", inputs=[f"half{i}"])
        assert res.raw_trips == half.count() and res.clean_trips <= res.raw_trips
        assert res.pct_kept <= 100
        clean += res.clean_trips
    assert clean == 713
    whole = store_reports(store, zones)["by_hour"].collect()
    assert [tuple(r) for r in whole] == [tuple(r) for r in Q.hour_report(Q.clean_trips(trips, RULES)).collect()]


def test_partials_are_a_small_share_of_the_trips(spark):
    clean = Q.clean_trips(A.trips_from_events(spark, "/root/testdata/sf0.1"), RULES, D.PERIOD_MONTH_SQL)
    kept = clean.count()
    assert partial_aggregate(clean).count() <= 0.1 * kept
    assert partial_aggregate(clean, REPORT_KEYS).count() <= 0.1 * kept
