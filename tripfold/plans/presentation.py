"""Report-derived views: chart feeds, labels, shares, formatted tables.

All of these start from a finished (key-bounded) report or from partial
measures; none goes back to trip rows.  Results are passed as DataFrames,
never round-tripped through CSV (where ``N/A`` would turn into a missing
value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripfold import schema as S
from tripfold.functions import exact as E
from tripfold.functions import labels as L
from tripfold.operators.partials import measures, mean
from tripfold.operators.topk import sort_bounded, top_k
from tripfold.plans.reports import place_measures

def _above(borough_report: DataFrame, min_trips: int | None, of_mean: float | None) -> DataFrame:
    """Groups with more trips than a number, or than a multiple of the mean group (HAVING).

    The multiple means the same at every size of the table.  The mean is a
    window over the report, which has one row per borough.
    """
    if min_trips is not None:
        return borough_report.filter(F.col("trips") > F.lit(min_trips))
    mean_trips = F.avg("trips").over(Window.partitionBy())
    marked = borough_report.withColumn("_mean", mean_trips)
    return marked.filter(F.col("trips") > F.lit(float(of_mean)) * F.col("_mean")).drop("_mean")


def zone_labels(zone_report: DataFrame, k: int = 10, rising: bool = False) -> DataFrame:
    """Top-k named zones as ``Zone (Borough)`` with trips in millions.

    The group of trips without a zone has no name to show and is left out.
    ``rising`` gives the same k rows from the least to the busiest, the order
    in which a horizontal bar chart is drawn.
    """
    named = zone_report.filter(F.col(S.ZONE).isNotNull() & F.col(S.BOROUGH).isNotNull())
    top = top_k(named, k, desc=["trips"], asc=[S.BOROUGH, S.ZONE])
    if rising:
        top = top.repartition(1).sortWithinPartitions(
            F.col("trips").asc(), F.col(S.BOROUGH).desc(), F.col(S.ZONE).desc())
    return top.select(L.zone_label().alias("label"), "trips",
                      L.millions("trips").alias("trips_millions"))


def borough_min_trips(borough_report: DataFrame, min_trips: int | None = None,
                      of_mean: float | None = None) -> DataFrame:
    """Boroughs above a trip threshold (HAVING), ascending by revenue."""
    kept = _above(borough_report, min_trips, of_mean)
    return sort_bounded(kept.select(S.BOROUGH, "trips", "total_revenue",
                                    L.millions("total_revenue").alias("revenue_millions")),
                        asc=["total_revenue", S.BOROUGH])


def payment_labels(payment_report: DataFrame) -> DataFrame:
    """Known payment codes only, with a name and a ``name (x.yM trips)`` label."""
    codes = list(L.PAYMENT_NAMES)
    kept = payment_report.filter(F.col(S.PAYMENT).isin(codes))
    name = L.payment_name()
    return sort_bounded(kept.select(S.PAYMENT, name.alias("payment_method"), "trips",
                                    "avg_tip_pct", L.millions_label(name).alias("label")),
                        asc=[S.PAYMENT])


def share_of_total(src: DataFrame, zones: DataFrame, from_partials: bool = False) -> DataFrame:
    """Each borough's share (%) of all trips and of all revenue.

    The grand totals come from a window over the borough result, which is
    bounded by the number of boroughs (one small partition), so no join
    or driver round trip is needed.
    """
    m = place_measures(src, zones, [S.BOROUGH], from_partials)
    m = m.select(S.BOROUGH, "trips", F.expr(f"{E.total('sum_total')} AS total"))
    whole = Window.partitionBy()
    return sort_bounded(m.select(
        S.BOROUGH, "trips",
        F.round("total", 2).alias("total_revenue"),
        F.round(F.col("trips") * F.lit(100.0) / F.sum("trips").over(whole), 2)
        .alias("trip_share_pct"),
        F.round(F.col("total") * F.lit(100.0) / F.sum("total").over(whole), 2)
        .alias("revenue_share_pct")), desc=["total_revenue"], asc=[S.BOROUGH])


def peak_trough(hour_report: DataFrame) -> DataFrame:
    """Busiest and quietest hour, and the hour with the highest mean tip.

    Ties go to the earliest hour.
    """
    h = F.col(S.HOUR)
    return hour_report.agg(
        F.max_by(h, F.struct(F.col("trips"), -h)).alias("peak_hour"),
        F.max("trips").alias("peak_trips"),
        F.min_by(h, F.struct(F.col("trips"), h)).alias("trough_hour"),
        F.min("trips").alias("trough_trips"),
        F.max_by(h, F.struct(F.col("avg_tip_pct"), -h)).alias("top_tip_hour"),
        F.max("avg_tip_pct").alias("top_tip_pct"))


def blended_vs_card_tip(src: DataFrame, from_partials: bool = False,
                        card_code: int = 1) -> DataFrame:
    """Mean tip % over all trips vs over card trips only (one row)."""
    m = measures(src, [S.PAYMENT], from_partials)
    card = f"{S.PAYMENT} = {int(card_code)}"
    totals = m.selectExpr(
        "sum(trips) AS trips", f"coalesce(sum(trips) FILTER (WHERE {card}), 0L) AS card_trips",
        f"{E.merged_sum('sum_tip_pct')} AS sum_tip_pct", "sum(n_tip_pct) AS n_tip_pct",
        f"{E.merged_sum('sum_tip_pct', card)} AS card_sum_tip_pct",
        f"sum(n_tip_pct) FILTER (WHERE {card}) AS card_n_tip_pct")
    return totals.select(
        "trips", "card_trips",
        mean("sum_tip_pct", "n_tip_pct").alias("blended_tip_pct"),
        mean("card_sum_tip_pct", "card_n_tip_pct").alias("card_tip_pct"))


def demand_chart_feed(hour_report: DataFrame) -> DataFrame:
    """Hourly trips in millions with the mean tip %, ordered by hour."""
    feed = hour_report.select(S.HOUR, "trips", L.millions("trips").alias("trips_millions"),
                              "avg_tip_pct")
    return sort_bounded(feed, asc=[S.HOUR])


def tip_labels(payment_report: DataFrame) -> DataFrame:
    """Known payment methods with their mean tip as ``x.y%``, ordered by code."""
    kept = payment_report.filter(F.col(S.PAYMENT).isin(list(L.PAYMENT_NAMES)))
    return sort_bounded(kept.select(S.PAYMENT, L.payment_name().alias("payment_method"),
                                    L.percent_label("avg_tip_pct").alias("tip_label")),
                        asc=[S.PAYMENT])


def scaling_feed(slices: DataFrame) -> DataFrame:
    """Rows per step of the scaling study: for the chart in millions, for the table as text."""
    per_step = slices.groupBy("k").agg(F.sum("trips").alias("rows"), F.count(F.lit(1)).alias("places"))
    return sort_bounded(per_step.select(
        F.col("k").alias("Step"), F.col("rows").alias("Rows"),
        L.millions("rows").alias("Rows (millions)"), L.report_count("rows").alias("Rows text"),
        F.col("places").alias("Places")), asc=["Step"])


def formatted_borough_table(borough_report: DataFrame, min_trips: int | None = None,
                            of_mean: float | None = None) -> DataFrame:
    """Borough table as text: counts with separators, money 2 dp or 0 dp ≥ 1M."""
    kept = _above(borough_report, min_trips, of_mean)
    return sort_bounded(kept.select(
        S.BOROUGH,
        L.report_count("trips").alias("trips_text"),
        L.report_number("total_revenue").alias("total_revenue_text"),
        L.report_number("avg_tip_pct").alias("avg_tip_pct_text"),
        "total_revenue"), desc=["total_revenue"], asc=[S.BOROUGH]).drop("total_revenue")
