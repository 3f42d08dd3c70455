"""Registered queries: ``name → (spark, sf_dir) → DataFrame``.

All run over whole tables.  The trip fact is the events adapter and the
zone dimension is nation ⋈ region (see ``tripfold.sources.adapters``); the
``lineitem_*`` queries use the lineitem adapter, whose place dimension
(supplier) grows with the data and whose names repeat across ids.

Queries over derived tables (a store of partials, the curated fact) share one
table for each state of the input files (path, length, time of change): the
first of them writes it to the shared folder, the others read it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold import hadoop as H

from tripfold import schema as S
from tripfold.functions import rules as R
from tripfold.functions import derive as D
from tripfold.operators.partials import LEVEL, at_level, lattice, mean, merge, money, partial_aggregate
from tripfold.operators.topk import top_k
from tripfold.plans import presentation as P
from tripfold.plans import reports as Q
from tripfold.plans import scaling as SC
from tripfold.plans.pipeline import REPORT_LEVELS
from tripfold.session import shared_path
from tripfold.sources import adapters as A
from tripfold.sources import curated as C
from tripfold.store import PartialsStore

# Year of the events table (its rows of other years are rejected).
YEAR = 2024

# Multiples of the mean group's trips that the borough views ask for: the mean
# itself keeps some and drops some at every size.
CHART_OF_MEAN = 1.0
TABLE_OF_MEAN = 0.5

# Boundaries of the three disjoint period ranges of the merged partials.
PERIOD_BOUNDS = ("2024-01-11", "2024-01-21")

# lineitem adapter parameters: ship year kept, quantity bound.
LINEITEM_YEAR = 1998
LINEITEM_MAX_DISTANCE = 45.0


def _rules():
    return R.strict_rules(YEAR)


def _clean(spark: SparkSession, d: str, period: str | None = None) -> DataFrame:
    return Q.clean_trips(A.trips_from_events(spark, d), _rules(), period)


def _derived_path(spark: SparkSession, name: str, trips: DataFrame, *facts: str) -> str:
    """Where the table that is derived from these files by these rules stands."""
    files = [H.info(spark, H.from_uri(spark, f)) for f in sorted(trips.inputFiles())]
    key = hashlib.sha1(json.dumps([files, facts, spark.sparkContext.applicationId]).encode()).hexdigest()[:16]
    return shared_path(spark, "tables", f"{name}-{key}")


def _store(spark: SparkSession, d: str, period: str = D.PERIOD_MONTH_SQL) -> PartialsStore:
    """A store with the partials of all events as the batch ``all``."""
    trips, rules = A.trips_from_events(spark, d), _rules()
    store = PartialsStore(spark, _derived_path(spark, "partials", trips, R.all_of_sql(rules), period))
    if not store.entries("all"):
        store.load(trips, rules, "all", period=period)
    return store


def _lattice(spark: SparkSession, d: str) -> DataFrame:
    """The stored partials at the key sets of all reports, in one pass."""
    return lattice(_store(spark, d).read("all"), REPORT_LEVELS)


def demand_by_hour(spark, d, ordered=True):
    return Q.hour_report(_clean(spark, d), ordered=ordered)


def top_zones(spark, d):
    return Q.top_zones(_clean(spark, d), A.zones_from_nation_region(spark, d), k=15)


def revenue_by_borough(spark, d, ordered=True):
    zones = A.zones_from_nation_region(spark, d)
    return Q.borough_report(_clean(spark, d), zones, ordered=ordered)


def tips_by_payment(spark, d, ordered=True):
    return Q.payment_report(_clean(spark, d), ordered=ordered)


def trips_by_location(spark, d):
    return Q.location_report(A.trips_from_events(spark, d), digits=6)


def retention(spark, d):
    return R.retention(A.trips_from_events(spark, d), _rules())


def clean_trips(spark, d):
    c = _clean(spark, d, D.PERIOD_DAY_SQL)
    return c.select(A.EVENTS_TRIP_ID, S.PERIOD, S.HOUR,
                    F.round(S.MINUTES, 6).alias(S.MINUTES),
                    F.round(S.TIP_PCT, 6).alias(S.TIP_PCT))


def trip_minutes_by_hour(spark, d):
    return Q.trip_minutes_by_hour(_clean(spark, d))


def enriched_trips(spark, d):
    e = Q.enriched_trips(_clean(spark, d), A.zones_from_nation_region(spark, d))
    return e.select(A.EVENTS_TRIP_ID, S.LOCATION, S.BOROUGH, S.ZONE)


def partials(spark, d):
    p = partial_aggregate(_clean(spark, d, D.PERIOD_MONTH_SQL))
    return p.select(S.PERIOD, S.HOUR, S.LOCATION, S.PAYMENT, "trips",
                    money("sum_distance").alias("sum_distance"),
                    money("sum_fare").alias("sum_fare"),
                    money("sum_tip_pct", 4).alias("sum_tip_pct"),
                    "n_tip_pct",
                    money("sum_total").alias("sum_total"))


def hour_from_partials(spark, d):
    return Q.finalise_hours(at_level(_lattice(spark, d), [S.HOUR]))


def zones_from_partials(spark, d):
    zones = A.zones_from_nation_region(spark, d)
    named = Q.named_measures(at_level(_lattice(spark, d), [S.LOCATION]), zones, [S.BOROUGH, S.ZONE])
    return top_k(Q.finalise_zones(named), 15, desc=["trips"], asc=[S.BOROUGH, S.ZONE])


def borough_from_partials(spark, d):
    zones = A.zones_from_nation_region(spark, d)
    return Q.finalise_boroughs(Q.named_measures(at_level(_lattice(spark, d), [S.LOCATION]), zones, [S.BOROUGH]))


def payment_from_partials(spark, d):
    return Q.finalise_payments(at_level(_lattice(spark, d), [S.PAYMENT]))


def report_lattice(spark, d):
    """All roll-ups of the stored partials in one pass, the whole and each month by payment type among them."""
    levels = [*REPORT_LEVELS, [S.PERIOD, S.PAYMENT], []]
    return lattice(_store(spark, d).read("all"), levels).select(
        F.when(F.col(LEVEL) == "", "all").otherwise(F.col(LEVEL)).alias(LEVEL), S.PERIOD, S.HOUR, S.LOCATION, S.PAYMENT, "trips",
        mean("sum_distance").alias("avg_distance_mi"), mean("sum_fare").alias("avg_fare"),
        mean("sum_tip_pct", "n_tip_pct").alias("avg_tip_pct"), money("sum_total").alias("total_revenue"))


def stored_reject_counts(spark, d):
    """Rejected trips by rule, as the commits of a store have them."""
    return _store(spark, d).rejects().groupBy("rule_order", "rule").agg(F.sum("rejected").alias("rejected"))


def zone_labels_top10(spark, d):
    return P.zone_labels(Q.zone_report(_clean(spark, d), A.zones_from_nation_region(spark, d)), k=10)


def zone_labels_rising(spark, d):
    zones = A.zones_from_nation_region(spark, d)
    return P.zone_labels(Q.zone_report(_clean(spark, d), zones), k=10, rising=True)


def borough_min_trips(spark, d):
    return P.borough_min_trips(revenue_by_borough(spark, d, ordered=False), of_mean=CHART_OF_MEAN)


def payment_labels(spark, d):
    return P.payment_labels(tips_by_payment(spark, d, ordered=False))


def tip_labels_by_payment(spark, d):
    return P.tip_labels(tips_by_payment(spark, d, ordered=False))


def scaled_slice(spark, d):
    return SC.scaled_slices(A.trips_from_events(spark, d))


def scaling_feed(spark, d):
    return P.scaling_feed(scaled_slice(spark, d))


def sliced_union(spark, d):
    """UNION ALL of two separate inputs, each scanned once."""
    both = SC.union_all([A.trips_from_events(spark, d).drop(A.EVENTS_TRIP_ID),
                         A.trips_from_lineitem(spark, d).drop(A.LINEITEM_TRIP_ID)])
    return Q.payment_report(Q.clean_trips(both, R.strict_rules(None), None))


def periods_merged(spark, d):
    """Partials of disjoint periods, one stored batch each, concatenated and merged by hour and payment type.

    The store is partitioned by period (day), so each range reads its own folders
    and the trips are scanned once, when the store is written.
    """
    store = _store(spark, d, D.PERIOD_DAY_SQL)
    edges = ["0001-01-01", *PERIOD_BOUNDS, "9999-12-31"]
    whole = SC.union_all([store.periods(a, b) for a, b in zip(edges[:-1], edges[1:])])
    merged = merge(whole, [S.HOUR, S.PAYMENT])
    return merged.select(
        S.HOUR, S.PAYMENT, "trips", mean("sum_distance", digits=10).alias("avg_distance_mi"),
        mean("sum_fare", digits=10).alias("avg_fare"),
        mean("sum_tip_pct", "n_tip_pct", digits=10).alias("avg_tip_pct"),
        money("sum_total").alias("total_revenue"))


def share_of_total(spark, d):
    return P.share_of_total(_clean(spark, d), A.zones_from_nation_region(spark, d))


def peak_trough(spark, d):
    return P.peak_trough(demand_by_hour(spark, d, ordered=False))


def blended_vs_card_tip(spark, d):
    return P.blended_vs_card_tip(_clean(spark, d))


def reject_counts(spark, d):
    return R.reject_counts(A.trips_from_events(spark, d), _rules())


def demand_chart_feed(spark, d):
    return P.demand_chart_feed(demand_by_hour(spark, d, ordered=False))


def formatted_borough_table(spark, d):
    return P.formatted_borough_table(revenue_by_borough(spark, d, ordered=False), of_mean=TABLE_OF_MEAN)


# ------------------------------------------------------------ lineitem
def _lineitem_rules():
    return R.strict_rules(year=LINEITEM_YEAR, max_distance=LINEITEM_MAX_DISTANCE)


def lineitem_reject_counts(spark, d):
    return R.reject_counts(A.trips_from_lineitem(spark, d), _lineitem_rules())


def lineitem_margin_reject_counts(spark, d):
    return R.reject_counts(A.trips_from_lineitem_margin(spark, d), _lineitem_rules())


def lineitem_margin_retention(spark, d):
    return R.retention(A.trips_from_lineitem_margin(spark, d), _lineitem_rules())


def lineitem_retention(spark, d):
    return R.retention(A.trips_from_lineitem(spark, d), _lineitem_rules())


def lineitem_top_places(spark, d):
    clean = Q.clean_trips(A.trips_from_lineitem(spark, d), _lineitem_rules(), None)
    return Q.top_zones(clean, A.zones_from_supplier(spark, d), k=15)


def lineitem_revenue_by_region(spark, d):
    clean = Q.clean_trips(A.trips_from_lineitem(spark, d), _lineitem_rules(), None)
    return Q.borough_report(clean, A.zones_from_supplier(spark, d))


def _curated(spark: SparkSession, d: str) -> str:
    trips = A.trips_from_lineitem(spark, d).drop(A.LINEITEM_TRIP_ID)
    path = _derived_path(spark, "curated", trips)
    if not H.exists(spark, f"{path}/_SUCCESS"):
        C.write_curated(trips, path)
    return path


def curated_year_by_payment(spark, d):
    """The year's report from the year's folders of the curated fact."""
    trips = C.of_year(spark, _curated(spark, d), LINEITEM_YEAR)
    return Q.payment_report(Q.clean_trips(trips.drop(S.PERIOD), _lineitem_rules(), None))


def curated_first_months(spark, d):
    """The scaling query over the first twelve months, from twelve folders."""
    return Q.location_report(C.first_months(spark, _curated(spark, d), 12), digits=6)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "demand_by_hour": demand_by_hour,
    "top_zones": top_zones,
    "revenue_by_borough": revenue_by_borough,
    "tips_by_payment": tips_by_payment,
    "trips_by_location": trips_by_location,
    "retention": retention,
    "clean_trips": clean_trips,
    "trip_minutes_by_hour": trip_minutes_by_hour,
    "enriched_trips": enriched_trips,
    "partials": partials,
    "hour_from_partials": hour_from_partials,
    "zones_from_partials": zones_from_partials,
    "borough_from_partials": borough_from_partials,
    "payment_from_partials": payment_from_partials,
    "report_lattice": report_lattice,
    "stored_reject_counts": stored_reject_counts,
    "curated_year_by_payment": curated_year_by_payment,
    "curated_first_months": curated_first_months,
    "zone_labels_top10": zone_labels_top10,
    "borough_min_trips": borough_min_trips,
    "payment_labels": payment_labels,
    "zone_labels_rising": zone_labels_rising,
    "tip_labels_by_payment": tip_labels_by_payment,
    "scaling_feed": scaling_feed,
    "periods_merged": periods_merged,
    "lineitem_margin_reject_counts": lineitem_margin_reject_counts,
    "lineitem_margin_retention": lineitem_margin_retention,
    "scaled_slice": scaled_slice,
    "sliced_union": sliced_union,
    "share_of_total": share_of_total,
    "peak_trough": peak_trough,
    "blended_vs_card_tip": blended_vs_card_tip,
    "reject_counts": reject_counts,
    "demand_chart_feed": demand_chart_feed,
    "formatted_borough_table": formatted_borough_table,
    "lineitem_reject_counts": lineitem_reject_counts,
    "lineitem_retention": lineitem_retention,
    "lineitem_top_places": lineitem_top_places,
    "lineitem_revenue_by_region": lineitem_revenue_by_region,
}
