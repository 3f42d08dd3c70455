"""Exact sums: the same bits for any order, merge and inverse; lattice; counted trips."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tripfold import schema as S
from tripfold.functions import exact as E
from tripfold.functions import rules as R
from tripfold.operators.partials import (BROKEN, MEASURES, REPORT_KEYS, at_level, counted, kept_partials, lattice, merge,
                                         partial_aggregate, rejected_by_rule)
from tripfold.plans import reports as Q
from tripfold.plans.pipeline import run_pipeline
from tripfold.sources import adapters as A

from fixtures import SF_MID, SF_SMALL, trap_trips, zones

RULES = R.strict_rules(2024)


def values():
    rng = random.Random(1)
    out = [rng.uniform(-1e6, 1e6) * 10 ** rng.randrange(-8, 6) for _ in range(2000)]
    return out + [0.1, 0.2, -0.3, 0.0, -0.0, 1e15, -1e15, 2**53 - 1.0, 1e-13, -1e-13, 5e-324]


def exact_of(xs):
    """The sum of the values cut off below 2**-40."""
    return sum((Fraction(math.floor(Fraction(x) * 2**40), 2**40) for x in xs), Fraction(0))


def test_sums_are_exact_in_any_order(spark):
    xs = values()
    want, seen = float(exact_of(xs)), set()
    for seed, parts in ((1, 1), (2, 7), (3, 40)):
        random.Random(seed).shuffle(xs)
        df = spark.createDataFrame([(i % 5, x) for i, x in enumerate(xs)], "g int, v double").repartition(parts)
        whole = df.selectExpr(f"{E.exact_sum('v')} AS s")
        groups = df.groupBy("g").agg(F.expr(f"{E.exact_sum('v')} AS s")).selectExpr(f"{E.merged_sum('s')} AS s")
        for got in (whole, groups):
            seen.add(got.selectExpr(f"{E.total('s')} AS t").first().t)
    assert len(seen) == 1 and math.isclose(seen.pop(), want, rel_tol=1e-15)
    assert abs(want - math.fsum(xs)) < 1e-6


@pytest.mark.parametrize("xs, want", [([], None), ([None], None), ([1.5, None], 1.5), ([math.nan, 1.0], math.nan),
                                      ([math.inf, 1.0], math.inf), ([math.inf, -math.inf], math.nan), ([2.0**60, 1.0], 2.0**60 + 1)])
def test_null_and_odd_values(spark, xs, want):
    df = spark.createDataFrame([(x,) for x in xs], "v double").selectExpr(f"{E.exact_sum('v')} AS s")
    got = df.selectExpr(f"{E.total('s')} AS t").first().t
    assert got == want or (want is not None and math.isnan(want) and math.isnan(got))


def test_a_sum_and_its_inverse_give_nothing(spark):
    df = spark.createDataFrame([(x,) for x in values()], "v double").selectExpr(f"{E.exact_sum('v')} AS s")
    both = df.unionAll(df.selectExpr(f"{E.negated('s')} AS s")).selectExpr(f"{E.merged_sum('s')} AS s")
    assert tuple(both.first().s) == (0, 0, 0, None)
    assert both.selectExpr(f"{E.total('s')} AS t").first().t == 0.0
    # a part that is taken back may leave negative parts; the total is the same double
    some = spark.createDataFrame([(0.7,), (1e6 + 0.3,)], "v double").selectExpr(f"{E.exact_sum('v')} AS s")
    back = spark.createDataFrame([(0.7,)], "v double").selectExpr(f"{E.exact_sum('v')} AS s").selectExpr(f"{E.negated('s')} AS s")
    left = some.unionAll(back).selectExpr(f"{E.merged_sum('s')} AS s").selectExpr(f"{E.total('s')} AS t").first().t
    alone = spark.createDataFrame([(1e6 + 0.3,)], "v double").selectExpr(f"{E.exact_sum('v')} AS s").selectExpr(f"{E.total('s')} AS t").first().t
    assert left == alone == float(exact_of([1e6 + 0.3]))


def test_a_sum_that_overflows_fails(spark):
    df = spark.range(3000).selectExpr("9.0E15D AS v").selectExpr(f"{E.exact_sum('v')} AS s")
    with pytest.raises(Exception, match="overflow|OVERFLOW"):
        df.collect()


def test_reports_have_the_same_bits_for_any_partitioning(spark):
    trips = A.trips_from_lineitem(spark, SF_SMALL)
    rules = R.strict_rules(1998, 45.0)
    seen = set()
    for n in (1, 5, 32):
        clean = Q.clean_trips(trips.repartition(n), rules)
        parts = partial_aggregate(clean, REPORT_KEYS)
        report = merge(parts, []).select(*[F.expr(E.total(m)).alias(m) for m in MEASURES if m.startswith("sum")])
        direct = partial_aggregate(clean, []).select(*report.columns[:0], *[F.expr(E.total(m)).alias(m) for m in report.columns])
        seen |= {tuple(report.first()), tuple(direct.first())}
    assert len(seen) == 1


def test_lattice_equals_single_roll_ups(spark):
    parts = partial_aggregate(Q.clean_trips(A.trips_from_events(spark, SF_SMALL), RULES, None), REPORT_KEYS)
    levels = [[S.HOUR], [S.LOCATION], [S.PAYMENT], [S.HOUR, S.PAYMENT], REPORT_KEYS]
    rows = lattice(parts, levels)
    for keys in levels:
        want = sorted(map(tuple, merge(parts, keys).select(*keys, *MEASURES).collect()), key=repr)
        assert sorted(map(tuple, at_level(rows, keys).collect()), key=repr) == want


def test_a_null_key_is_not_taken_for_a_level_that_sums_over_it(spark):
    parts = partial_aggregate(Q.clean_trips(trap_trips(spark), RULES, None), REPORT_KEYS)
    rows = lattice(parts, [[S.LOCATION], [S.HOUR]])
    places = {r[S.LOCATION]: r.trips for r in at_level(rows, [S.LOCATION]).collect()}
    assert places[None] == 1 and sum(places.values()) == Q.clean_trips(trap_trips(spark), RULES, None).count()


def test_counted_trips_equal_rules_and_partials(spark):
    for trips in (trap_trips(spark), A.trips_from_lineitem_margin(spark, SF_SMALL)):
        rows = counted(trips, RULES, REPORT_KEYS, period=None).cache()
        want = partial_aggregate(Q.clean_trips(trips, RULES, None), REPORT_KEYS)
        assert sorted(map(tuple, kept_partials(rows).select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        counts = {r[BROKEN]: r.n for r in rows.groupBy(BROKEN).agg(F.sum("trips").alias("n")).collect()}
        assert sum(counts.values()) == trips.count()
        got = [(i, name, n) for i, name, n in rejected_by_rule(counts, [r.name for r in RULES])]
        assert got == [tuple(r) for r in R.reject_counts(trips, RULES).orderBy("rule_order").collect()]
        rows.unpersist()


def test_the_pipeline_reads_the_trips_once(spark, scratch):
    from tripfold.store import PartialsStore
    read = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    base = A.trips_from_events(spark, SF_SMALL)
    n = base.count()
    for store in (None, PartialsStore(spark, scratch + "/once")):
        before = read.value
        res = run_pipeline(base.mapInArrow(watch, base.schema), zones(spark), RULES, store=store, inputs=["watched"])
        assert read.value - before == n == res.raw_trips
        assert res.rejected == {r.rule: r.rejected for r in R.reject_counts(base, RULES).collect()}


def test_the_scan_of_the_pipeline_is_pruned(spark):
    plan = counted(A.trips_from_events(spark, SF_MID), RULES, REPORT_KEYS, period=None)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and plan.count("FileScan") == 1
