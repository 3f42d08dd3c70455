"""Independent DuckDB SQL for every registered query.

Written directly against the driver's tables (views ``events``, ``nation``,
``region``, ``lineitem``, ``supplier``), row-level and join-first – the
textbook form of each report – so it checks the Spark plans (aggregate
first, join after, partial roll-ups) rather than restating them.

Dialect notes: ``date_diff('second', a, b)`` = Spark's difference of
``unix_timestamp`` (whole seconds); literals are cast to DOUBLE where
Spark's Column API would use a double; NULLS LAST is written out.
"""

from __future__ import annotations

# ------------------------------------------------------------------ CTEs
EVENTS_TRIPS = """
trips AS (
  SELECT event_id,
         ts AS tpep_pickup_datetime,
         ts + to_minutes(CAST(event_id % 90 AS BIGINT)) AS tpep_dropoff_datetime,
         CAST(event_id % 7 AS BIGINT) AS passenger_count,
         CAST(event_id % 120 AS DOUBLE) AS trip_distance,
         CAST(user_id % 30 AS INTEGER) AS PULocationID,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3
                              WHEN 'error' THEN 4 WHEN 'purchase' THEN 5 END AS BIGINT) AS payment_type,
         value AS fare_amount,
         CAST(event_id * 7 % 31 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS tip_amount,
         value + CAST(event_id * 7 % 31 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS total_amount
  FROM events)"""

EVENTS_ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS PULocationID, r_name AS Borough, n_name AS Zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

LINEITEM_TRIPS = """
trips AS (
  SELECT CAST(l_shipdate AS TIMESTAMP) AS tpep_pickup_datetime,
         CAST(l_shipdate AS TIMESTAMP) AS tpep_dropoff_datetime,
         CAST(l_linenumber AS BIGINT) AS passenger_count,
         l_quantity AS trip_distance,
         CAST(l_suppkey AS INTEGER) AS PULocationID,
         CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS BIGINT)
           AS payment_type,
         l_extendedprice AS fare_amount,
         l_extendedprice * l_tax AS tip_amount,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount
  FROM lineitem)"""

MARGIN_TRIPS = """
trips AS (
  SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) END
           AS tpep_pickup_datetime,
         CAST(l_shipdate AS TIMESTAMP) AS tpep_dropoff_datetime,
         CAST(l_linenumber - 1 AS BIGINT) AS passenger_count,
         l_quantity - 1 AS trip_distance,
         l_extendedprice - CAST(1000 AS DOUBLE) * l_quantity AS fare_amount,
         l_extendedprice * l_tax AS tip_amount,
         (l_extendedprice - CAST(1000 AS DOUBLE) * l_quantity)
           - CAST(5000 AS DOUBLE) * l_discount * l_quantity AS total_amount
  FROM lineitem)"""

SUPPLIER_ZONES = """
zones AS (
  SELECT CAST(s_suppkey AS INTEGER) AS PULocationID, r_name AS Borough, n_name AS Zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""


def strict_rules(year: int = 2024, max_distance: float = 100.0) -> list[tuple[str, str]]:
    return [
        ("fare_positive", "fare_amount > 0 AND NOT isnan(fare_amount)"),
        ("distance_positive", "trip_distance > 0 AND NOT isnan(trip_distance)"),
        ("distance_below_max",
         f"trip_distance < CAST({max_distance!r} AS DOUBLE) AND NOT isnan(trip_distance)"),
        ("total_positive", "total_amount > 0 AND NOT isnan(total_amount)"),
        ("passengers_positive", "passenger_count > 0"),
        ("pickup_present", "tpep_pickup_datetime IS NOT NULL"),
        ("pickup_in_year",
         f"tpep_pickup_datetime >= TIMESTAMP '{year}-01-01' "
         f"AND tpep_pickup_datetime < TIMESTAMP '{year + 1}-01-01'"),
    ]


BENCH_RULES = [
    ("fare_positive", "fare_amount > 0 AND NOT isnan(fare_amount)"),
    ("distance_positive", "trip_distance > 0 AND NOT isnan(trip_distance)"),
    ("passengers_positive", "passenger_count > 0"),
]


def where(rules: list[tuple[str, str]]) -> str:
    return " AND ".join(f"({p})" for _, p in rules)


def clean_cte(rules: list[tuple[str, str]]) -> str:
    return f"""
clean AS (
  SELECT *,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour,
         CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE)
           / CAST(60 AS DOUBLE) AS trip_minutes,
         CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100
              ELSE CAST(0 AS DOUBLE) END AS tip_pct,
         CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS month,
         CAST(tpep_pickup_datetime AS DATE) AS period
  FROM trips
  WHERE {where(rules)})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


EV = with_(EVENTS_TRIPS, EVENTS_ZONES, clean_cte(strict_rules()))

# ------------------------------------------------------ report bodies
HOUR = """
SELECT hour, count(*) AS trips,
       round(avg(trip_distance), 2) AS avg_distance_mi,
       round(avg(fare_amount), 2) AS avg_fare,
       round(avg(tip_pct), 2) AS avg_tip_pct
FROM clean GROUP BY hour"""

ZONE_REPORT = """
SELECT Borough, Zone, count(*) AS trips,
       round(avg(fare_amount), 2) AS avg_fare,
       round(avg(tip_pct), 2) AS avg_tip_pct,
       round(sum(total_amount), 2) AS total_revenue
FROM clean LEFT JOIN zones USING (PULocationID)
GROUP BY Borough, Zone"""

TOP_ZONES = ZONE_REPORT + """
ORDER BY trips DESC, Borough ASC NULLS LAST, Zone ASC NULLS LAST
LIMIT 15"""

BOROUGH = """
SELECT Borough, count(*) AS trips,
       round(sum(total_amount), 2) AS total_revenue,
       round(avg(tip_pct), 2) AS avg_tip_pct
FROM clean LEFT JOIN zones USING (PULocationID)
GROUP BY Borough"""

PAYMENT = """
SELECT payment_type, count(*) AS trips, round(avg(tip_pct), 2) AS avg_tip_pct
FROM clean GROUP BY payment_type"""

MILLION = "CAST(1000000 AS DOUBLE)"


def reject_counts_sql(rules: list[tuple[str, str]]) -> str:
    counts = ",\n  ".join(
        f"count(*) FILTER (WHERE NOT coalesce(({p}), false)) AS r{i}"
        for i, (_, p) in enumerate(rules))
    rows = "\nUNION ALL ".join(
        f"SELECT {i} AS rule_order, '{name}' AS rule, r{i} AS rejected FROM c"
        for i, (name, _) in enumerate(rules))
    return f"c AS (SELECT\n  {counts}\nFROM trips)\n{rows}"


def retention_sql(rules: list[tuple[str, str]]) -> str:
    return f"""
SELECT count(*) AS raw_trips,
       count(*) FILTER (WHERE coalesce({where(rules)}, false)) AS clean_trips,
       round(CAST(count(*) FILTER (WHERE coalesce({where(rules)}, false)) AS DOUBLE)
             * CAST(100 AS DOUBLE) / count(*), 1) AS pct_kept
FROM trips"""


def _li_rules():
    return strict_rules(year=1998, max_distance=45.0)


# Days that the kept trips have, numbered, and the steps of twelfths that hold them.
STEPS = f"""
kept AS (
  SELECT PULocationID, tip_amount / fare_amount * 100 AS tip_pct,
         CAST(tpep_pickup_datetime AS DATE) AS day
  FROM trips WHERE {where(BENCH_RULES)}),
days AS (SELECT day, row_number() OVER (ORDER BY day) AS nth, count(*) OVER () AS n
         FROM (SELECT DISTINCT day FROM kept WHERE day IS NOT NULL)),
ks AS (SELECT * FROM (VALUES (1), (3), (6), (12)) t(k))"""

SLICES = """
SELECT k, PULocationID, count(*) AS trips, round(avg(tip_pct), 6) AS avg_tip
FROM kept LEFT JOIN days USING (day) JOIN ks ON coalesce(nth <= ceil(n * k / CAST(12 AS DOUBLE)), k = 12)
GROUP BY k, PULocationID"""

SQL: dict[str, str] = {
    "demand_by_hour": EV + HOUR,
    "top_zones": EV + TOP_ZONES,
    "revenue_by_borough": EV + BOROUGH,
    "tips_by_payment": EV + PAYMENT,
    "trips_by_location": with_(EVENTS_TRIPS) + f"""
SELECT PULocationID, count(*) AS trips,
       round(avg(tip_amount / fare_amount * 100), 6) AS avg_tip
FROM trips WHERE {where(BENCH_RULES)}
GROUP BY PULocationID""",
    "retention": with_(EVENTS_TRIPS) + retention_sql(strict_rules()),
    "clean_trips": EV + """
SELECT event_id, period, hour, round(trip_minutes, 6) AS trip_minutes,
       round(tip_pct, 6) AS tip_pct
FROM clean""",
    "trip_minutes_by_hour": EV + """
SELECT hour, count(*) AS trips,
       round(avg(trip_minutes), 6) AS avg_minutes,
       round(min(trip_minutes), 6) AS min_minutes,
       round(max(trip_minutes), 6) AS max_minutes
FROM clean GROUP BY hour""",
    "enriched_trips": EV + """
SELECT event_id, PULocationID, Borough, Zone
FROM clean LEFT JOIN zones USING (PULocationID)""",
    "partials": EV + """
SELECT month AS period, hour, PULocationID, payment_type, count(*) AS trips,
       round(sum(trip_distance), 2) AS sum_distance,
       round(sum(fare_amount), 2) AS sum_fare,
       round(sum(tip_pct), 4) AS sum_tip_pct,
       count(tip_pct) AS n_tip_pct,
       round(sum(total_amount), 2) AS sum_total
FROM clean GROUP BY month, hour, PULocationID, payment_type""",
    "hour_from_partials": EV + HOUR,
    "zones_from_partials": EV + TOP_ZONES,
    "borough_from_partials": EV + BOROUGH,
    "payment_from_partials": EV + PAYMENT,
    "report_lattice": EV + """
SELECT CASE WHEN grouping(hour) = 0 THEN 'hour' WHEN grouping(PULocationID) = 0 THEN 'PULocationID'
            WHEN grouping(month) = 0 THEN 'period,payment_type' WHEN grouping(payment_type) = 0 THEN 'payment_type'
            ELSE 'all' END AS level,
       month AS period, hour, PULocationID, payment_type, count(*) AS trips,
       round(avg(trip_distance), 2) AS avg_distance_mi, round(avg(fare_amount), 2) AS avg_fare,
       round(avg(tip_pct), 2) AS avg_tip_pct, round(sum(total_amount), 2) AS total_revenue
FROM clean
GROUP BY GROUPING SETS ((hour), (PULocationID), (payment_type), (month, payment_type), ())""",
    "stored_reject_counts": with_(EVENTS_TRIPS) + ", " + reject_counts_sql(strict_rules()),
    "curated_year_by_payment": with_(LINEITEM_TRIPS, clean_cte(_li_rules())) + PAYMENT,
    "curated_first_months": with_(LINEITEM_TRIPS) + f"""
SELECT PULocationID, count(*) AS trips,
       round(avg(tip_amount / fare_amount * 100), 6) AS avg_tip
FROM trips
WHERE {where(BENCH_RULES)} AND date_trunc('month', tpep_pickup_datetime) IN (
  SELECT DISTINCT date_trunc('month', tpep_pickup_datetime) AS m FROM trips
  WHERE tpep_pickup_datetime IS NOT NULL ORDER BY m LIMIT 12)
GROUP BY PULocationID""",
    "zone_labels_top10": EV + f"""
SELECT Zone || ' (' || Borough || ')' AS label, trips, trips / {MILLION} AS trips_millions
FROM ({ZONE_REPORT}) z
WHERE Zone IS NOT NULL AND Borough IS NOT NULL
ORDER BY trips DESC, Borough ASC NULLS LAST, Zone ASC NULLS LAST
LIMIT 10""",
    "borough_min_trips": EV + f"""
SELECT Borough, trips, total_revenue, total_revenue / {MILLION} AS revenue_millions
FROM ({BOROUGH}) b
WHERE trips > (SELECT avg(trips) FROM ({BOROUGH}) m)
ORDER BY total_revenue, Borough NULLS LAST""",
    "payment_labels": EV + f"""
SELECT payment_type, payment_method, trips, avg_tip_pct,
       payment_method || chr(10) || '(' || CAST(round(trips / {MILLION}, 1) AS VARCHAR)
         || 'M trips)' AS label
FROM (SELECT *, CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
                     WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' END AS payment_method
      FROM ({PAYMENT}) p) q
WHERE payment_type IN (1, 2, 3, 4)""",
    "scaled_slice": with_(EVENTS_TRIPS, STEPS) + SLICES,
    "scaling_feed": with_(EVENTS_TRIPS, STEPS) + f"""
SELECT k AS "Step", CAST(sum(trips) AS BIGINT) AS "Rows", sum(trips) / {MILLION} AS "Rows (millions)",
       format('{{:,}}', CAST(sum(trips) AS BIGINT)) AS "Rows text", count(*) AS "Places"
FROM ({SLICES}) s GROUP BY k ORDER BY k""",
    "zone_labels_rising": EV + f"""
SELECT label, trips, trips_millions FROM (
  SELECT Zone || ' (' || Borough || ')' AS label, trips, trips / {MILLION} AS trips_millions, Borough, Zone
  FROM ({ZONE_REPORT}) z
  WHERE Zone IS NOT NULL AND Borough IS NOT NULL
  ORDER BY trips DESC, Borough ASC, Zone ASC LIMIT 10) t
ORDER BY trips ASC, Borough DESC, Zone DESC""",
    "tip_labels_by_payment": EV + f"""
SELECT payment_type,
       CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
                         WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' END AS payment_method,
       CAST(round(CAST(avg_tip_pct AS DECIMAL(18, 2)), 1) AS VARCHAR) || '%' AS tip_label
FROM ({PAYMENT}) p WHERE payment_type IN (1, 2, 3, 4) ORDER BY payment_type""",
    "periods_merged": EV + """
SELECT hour, payment_type, count(*) AS trips, round(avg(trip_distance), 10) AS avg_distance_mi,
       round(avg(fare_amount), 10) AS avg_fare, round(avg(tip_pct), 10) AS avg_tip_pct,
       round(sum(total_amount), 2) AS total_revenue
FROM clean GROUP BY hour, payment_type""",
    "lineitem_margin_reject_counts": with_(MARGIN_TRIPS) + ", " + reject_counts_sql(_li_rules()),
    "lineitem_margin_retention": with_(MARGIN_TRIPS) + retention_sql(_li_rules()),
    "sliced_union": with_(EVENTS_TRIPS, LINEITEM_TRIPS.replace("trips AS", "lines AS"), f"""
clean AS (
  SELECT payment_type, CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100
                            ELSE CAST(0 AS DOUBLE) END AS tip_pct
  FROM (SELECT tpep_pickup_datetime, passenger_count, trip_distance, payment_type, fare_amount,
               tip_amount, total_amount FROM trips
        UNION ALL
        SELECT tpep_pickup_datetime, passenger_count, trip_distance, payment_type, fare_amount,
               tip_amount, total_amount FROM lines) u
  WHERE {where(strict_rules()[:-1])})""") + PAYMENT,
    "share_of_total": EV + """
SELECT Borough, count(*) AS trips,
       round(sum(total_amount), 2) AS total_revenue,
       round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 2) AS trip_share_pct,
       round(sum(total_amount) * CAST(100 AS DOUBLE) / sum(sum(total_amount)) OVER (), 2)
         AS revenue_share_pct
FROM clean LEFT JOIN zones USING (PULocationID)
GROUP BY Borough""",
    "peak_trough": EV + f"""
SELECT first(hour ORDER BY trips DESC, hour ASC) AS peak_hour,
       max(trips) AS peak_trips,
       first(hour ORDER BY trips ASC, hour ASC) AS trough_hour,
       min(trips) AS trough_trips,
       first(hour ORDER BY avg_tip_pct DESC, hour ASC) AS top_tip_hour,
       max(avg_tip_pct) AS top_tip_pct
FROM ({HOUR}) h""",
    "blended_vs_card_tip": EV + """
SELECT count(*) AS trips,
       count(*) FILTER (WHERE payment_type = 1) AS card_trips,
       round(avg(tip_pct), 2) AS blended_tip_pct,
       round(avg(tip_pct) FILTER (WHERE payment_type = 1), 2) AS card_tip_pct
FROM clean""",
    "reject_counts": with_(EVENTS_TRIPS) + ", " + reject_counts_sql(strict_rules()),
    "demand_chart_feed": EV + f"""
SELECT hour, trips, trips / {MILLION} AS trips_millions, avg_tip_pct
FROM ({HOUR}) h""",
    "formatted_borough_table": EV + f"""
SELECT Borough,
       format('{{:,}}', trips) AS trips_text,
       CASE WHEN abs(total_revenue) < {MILLION} THEN format('{{:,.2f}}', total_revenue)
            ELSE format('{{:,.0f}}', total_revenue) END AS total_revenue_text,
       CASE WHEN abs(avg_tip_pct) < {MILLION} THEN format('{{:,.2f}}', avg_tip_pct)
            ELSE format('{{:,.0f}}', avg_tip_pct) END AS avg_tip_pct_text
FROM ({BOROUGH}) b
WHERE trips > CAST(0.5 AS DOUBLE) * (SELECT avg(trips) FROM ({BOROUGH}) m)
ORDER BY total_revenue DESC, Borough NULLS LAST""",
    "lineitem_reject_counts": with_(LINEITEM_TRIPS) + ", " + reject_counts_sql(_li_rules()),
    "lineitem_retention": with_(LINEITEM_TRIPS) + retention_sql(_li_rules()),
    "lineitem_top_places": with_(LINEITEM_TRIPS, SUPPLIER_ZONES, clean_cte(_li_rules()))
    + TOP_ZONES,
    "lineitem_revenue_by_region": with_(LINEITEM_TRIPS, SUPPLIER_ZONES, clean_cte(_li_rules()))
    + BOROUGH,
}
