"""Hand-made trap fixture: one trip per rule violation or edge case; table folders."""

from __future__ import annotations

import datetime as dt

from tripfold import schema as S

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

NAN = float("nan")
T = dt.datetime

BASE = {
    S.PICKUP: T(2024, 6, 1, 10, 15, 0),
    S.DROPOFF: T(2024, 6, 1, 10, 35, 0),
    S.PASSENGERS: 1,
    S.DISTANCE: 3.0,
    S.LOCATION: 1,
    S.PAYMENT: 1,
    S.FARE: 10.0,
    S.TIP: 2.0,
    S.TOTAL: 12.0,
}

# (case name, overrides, kept by the strict rules)
CASES = [
    ("valid", {}, True),
    ("fare_zero", {S.FARE: 0.0}, False),
    ("fare_negative", {S.FARE: -5.0}, False),
    ("fare_nan", {S.FARE: NAN}, False),
    ("fare_null", {S.FARE: None}, False),
    ("distance_zero", {S.DISTANCE: 0.0}, False),
    ("distance_100", {S.DISTANCE: 100.0}, False),
    ("distance_99_99", {S.DISTANCE: 99.99}, True),
    ("distance_nan", {S.DISTANCE: NAN}, False),
    ("total_zero", {S.TOTAL: 0.0}, False),
    ("total_nan", {S.TOTAL: NAN}, False),
    ("passengers_zero", {S.PASSENGERS: 0}, False),
    ("passengers_null", {S.PASSENGERS: None}, False),
    ("pickup_null", {S.PICKUP: None}, False),
    ("pickup_2023_last_second", {S.PICKUP: T(2023, 12, 31, 23, 59, 59)}, False),
    ("pickup_2024_last_micro", {S.PICKUP: T(2024, 12, 31, 23, 59, 59, 999999),
                                S.DROPOFF: T(2025, 1, 1, 0, 9, 59, 999999)}, True),
    ("pickup_2025_first", {S.PICKUP: T(2025, 1, 1, 0, 0, 0)}, False),
    ("dropoff_before_pickup", {S.DROPOFF: T(2024, 6, 1, 10, 5, 0)}, True),
    ("across_dst", {S.PICKUP: T(2024, 3, 10, 1, 50, 0),
                    S.DROPOFF: T(2024, 3, 10, 3, 10, 0)}, True),
    ("location_without_zone", {S.LOCATION: 999}, True),
    ("location_null", {S.LOCATION: None}, True),
]

EXPECTED_REJECTS = {
    "fare_positive": 4,        # zero, negative, NaN, NULL
    "distance_positive": 2,    # zero, NaN
    "distance_below_max": 2,   # exactly 100, NaN
    "total_positive": 2,       # zero, NaN
    "passengers_positive": 2,  # zero, NULL
    "pickup_present": 1,
    "pickup_in_year": 3,       # NULL, 2023, 2025
}

# Zones: two ids share one (Borough, Zone); "N/A" is a real value.
ZONES = [
    (1, "Manhattan", "Midtown"),
    (2, "Manhattan", "Midtown"),
    (3, "Unknown", "N/A"),
    (4, "N/A", "Outside"),
    (5, "Queens", "Alpha"),
    (6, "Queens", "Beta"),
]


def trap_trips(spark):
    rows = []
    for i, (name, over, _) in enumerate(CASES):
        row = {**BASE, **over}
        rows.append((i, name, *[row[f.name] for f in S.TRIPS.fields]))
    schema = "case_id int, case_name string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in S.TRIPS.fields)
    return spark.createDataFrame(rows, schema)


def zones(spark):
    return spark.createDataFrame(ZONES, S.ZONES)


def kept_names():
    return {name for name, _, kept in CASES if kept}
