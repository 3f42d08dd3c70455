"""The analysis reports as DataFrame plans.

Every report is ``measures(keys)`` → optional dimension join → finalise →
order.  ``measures`` comes either straight from cleaned rows (one
aggregation) or from stored partials (a roll-up of a key-bounded table);
both give the same numbers.  Reports that need place names aggregate by
place id *first* and join the dimension to that key-bounded result, so the
join never touches trip rows; they then re-group by name, because one
(Borough, Zone) pair may belong to several ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold import schema as S
from tripfold.functions import derive as D
from tripfold.functions.rules import Rule, apply_rules, bench_rules
from tripfold.operators.join import left_join_dimension
from tripfold.operators.partials import measures, mean, merge, money
from tripfold.operators.topk import sort_bounded, top_k


def clean_trips(trips: DataFrame, rules: list[Rule],
                period: str | Column | None = D.PERIOD_DAY_SQL) -> DataFrame:
    """Rule filter + hour, trip_minutes, tip_pct and (unless ``None``) the period."""
    return D.derive(apply_rules(trips, rules), period)


# ---------------------------------------------------------------- by hour
def hour_report(src: DataFrame, from_partials: bool = False, ordered: bool = True) -> DataFrame:
    """``ordered=False`` leaves the order to a view that sorts (or aggregates) again."""
    return finalise_hours(measures(src, [S.HOUR], from_partials), ordered)


def finalise_hours(m: DataFrame, ordered: bool = True) -> DataFrame:
    """Measures by hour → the hour report columns."""
    report = m.select(
        S.HOUR, "trips",
        mean("sum_distance").alias("avg_distance_mi"),
        mean("sum_fare").alias("avg_fare"),
        mean("sum_tip_pct", "n_tip_pct").alias("avg_tip_pct"))
    return sort_bounded(report, asc=[S.HOUR]) if ordered else report


# ------------------------------------------------------------ by place
def place_measures(src: DataFrame, zones: DataFrame, name_keys: list[str],
                   from_partials: bool = False) -> DataFrame:
    """Measures by place id → join names → merge by ``name_keys``."""
    return named_measures(measures(src, [S.LOCATION], from_partials), zones, name_keys)


def named_measures(by_id: DataFrame, zones: DataFrame, name_keys: list[str]) -> DataFrame:
    """Measures that are by place id already → join names → merge by ``name_keys``."""
    return merge(left_join_dimension(by_id, zones, S.LOCATION), name_keys)


def zone_report(src: DataFrame, zones: DataFrame, from_partials: bool = False) -> DataFrame:
    """All (Borough, Zone) groups, incl. the NULL group of unknown ids."""
    return finalise_zones(place_measures(src, zones, [S.BOROUGH, S.ZONE], from_partials))


def finalise_zones(m: DataFrame) -> DataFrame:
    """(Borough, Zone) measures → the zone report columns."""
    return m.select(
        S.BOROUGH, S.ZONE, "trips",
        mean("sum_fare").alias("avg_fare"),
        mean("sum_tip_pct", "n_tip_pct").alias("avg_tip_pct"),
        money("sum_total").alias("total_revenue"))


def top_zones(src: DataFrame, zones: DataFrame, k: int = 15,
              from_partials: bool = False) -> DataFrame:
    """Busiest k (Borough, Zone) groups; ties broken by name, NULLs last."""
    return top_k(zone_report(src, zones, from_partials), k,
                 desc=["trips"], asc=[S.BOROUGH, S.ZONE])


def borough_report(src: DataFrame, zones: DataFrame, from_partials: bool = False,
                   ordered: bool = True) -> DataFrame:
    return finalise_boroughs(place_measures(src, zones, [S.BOROUGH], from_partials), ordered)


def finalise_boroughs(m: DataFrame, ordered: bool = True) -> DataFrame:
    """Measures with a Borough key (or finer, then merged) → the borough report."""
    if set(m.columns) & {S.ZONE}:
        m = merge(m, [S.BOROUGH])
    report = m.select(
        S.BOROUGH, "trips",
        money("sum_total").alias("total_revenue"),
        mean("sum_tip_pct", "n_tip_pct").alias("avg_tip_pct"))
    return sort_bounded(report, desc=["total_revenue"], asc=[S.BOROUGH]) if ordered else report


# ---------------------------------------------------------- by payment
def payment_report(src: DataFrame, from_partials: bool = False, ordered: bool = True) -> DataFrame:
    return finalise_payments(measures(src, [S.PAYMENT], from_partials), ordered)


def finalise_payments(m: DataFrame, ordered: bool = True) -> DataFrame:
    """Measures by payment type → the payment report columns."""
    report = m.select(S.PAYMENT, "trips", mean("sum_tip_pct", "n_tip_pct").alias("avg_tip_pct"))
    return sort_bounded(report, asc=[S.PAYMENT]) if ordered else report


# --------------------------------------------------- benchmark report
def location_report(trips: DataFrame, rules: list[Rule] | None = None,
                    digits: int | None = None) -> DataFrame:
    """Trips and mean unguarded tip % per place id (the scaling query)."""
    kept = apply_rules(trips, bench_rules() if rules is None else rules)
    kept = kept.withColumn(S.TIP_PCT, D.tip_pct_unguarded())
    avg = F.avg(S.TIP_PCT)
    return kept.groupBy(S.LOCATION).agg(
        F.count(F.lit(1)).alias("trips"),
        (F.round(avg, digits) if digits is not None else avg).alias("avg_tip"))


# ----------------------------------------------------- row-level views
def enriched_trips(clean: DataFrame, zones: DataFrame) -> DataFrame:
    """Cleaned trips with Borough/Zone; trips without a zone keep NULLs."""
    return left_join_dimension(clean, zones, S.LOCATION)


def trip_minutes_by_hour(clean: DataFrame, digits: int = 6) -> DataFrame:
    """Duration statistics per pickup hour (durations may be negative)."""
    return sort_bounded(clean.groupBy(S.HOUR).agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(F.avg(S.MINUTES), digits).alias("avg_minutes"),
        F.round(F.min(S.MINUTES), digits).alias("min_minutes"),
        F.round(F.max(S.MINUTES), digits).alias("max_minutes")), asc=[S.HOUR])
