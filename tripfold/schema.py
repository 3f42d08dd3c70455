"""Explicit schemas for the trip fact and the place dimension.

Monthly trip files drift in type from release to release (int vs bigint,
timestamp with or without zone).  Reading under one explicit schema gives every
file the same columns: narrower numbers are read as the schema's type, and a
type that cannot be (a string for a number) fails the scan.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical column names used throughout the library.
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PASSENGERS = "passenger_count"
DISTANCE = "trip_distance"
LOCATION = "PULocationID"
PAYMENT = "payment_type"
FARE = "fare_amount"
TIP = "tip_amount"
TOTAL = "total_amount"

BOROUGH = "Borough"
ZONE = "Zone"

# Derived columns.
HOUR = "hour"
MINUTES = "trip_minutes"
TIP_PCT = "tip_pct"
PERIOD = "period"

# The fact columns the analysis reads (the source has 19; the rest are
# never referenced, so they are not part of the read schema and never
# leave the Parquet files).
TRIPS = T.StructType(
    [
        T.StructField(PICKUP, T.TimestampNTZType(), True),
        T.StructField(DROPOFF, T.TimestampNTZType(), True),
        T.StructField(PASSENGERS, T.LongType(), True),
        T.StructField(DISTANCE, T.DoubleType(), True),
        T.StructField(LOCATION, T.IntegerType(), True),
        T.StructField(PAYMENT, T.LongType(), True),
        T.StructField(FARE, T.DoubleType(), True),
        T.StructField(TIP, T.DoubleType(), True),
        T.StructField(TOTAL, T.DoubleType(), True),
    ]
)

# The dimension as the library uses it: keyed by the fact's column name.
ZONES = T.StructType(
    [
        T.StructField(LOCATION, T.IntegerType(), True),
        T.StructField(BOROUGH, T.StringType(), True),
        T.StructField(ZONE, T.StringType(), True),
    ]
)
