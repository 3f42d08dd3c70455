"""Trip-shaped views over the driver's generated tables.

The trip files themselves are not shipped with the test data, so the
queries run on deterministic mappings of the generated tables into the trip
schema.  The mappings are plain projections (no shuffle): the scan below
them is still column-pruned and filter-pushed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripfold import schema as S

# event_type → payment code used by the events adapter.
EVENT_PAYMENT_CODES = {"click": 1, "view": 2, "signup": 3, "error": 4, "purchase": 5}

# Lineitem return flag → payment code.
RETURNFLAG_PAYMENT_CODES = {"A": 1, "N": 2, "R": 3}

EVENTS_TRIP_ID = "event_id"
LINEITEM_TRIP_ID = "trip_id"

# Read schemas of the generated tables (the columns the adapters use).  A
# declared schema skips footer-based inference on every read and makes a
# type change in the files fail the scan.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def _code_map_sql(column: str, codes: dict[str, int]) -> str:
    whens = " ".join(f"WHEN '{key}' THEN {code}" for key, code in codes.items())
    return f"CAST(CASE {column} {whens} END AS BIGINT)"


def trips_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as trips; keeps ``event_id`` as the trip id.

    pickup = ts; dropoff = ts + (event_id % 90) minutes; distance =
    event_id % 120; passengers = event_id % 7; place = user_id % 30;
    fare = value; tip = (event_id * 7 % 31) quarter-dollars; total = fare + tip.
    """
    tip = "CAST(event_id * 7 % 31 AS DOUBLE) * 0.25D"
    return table(spark, sf_dir, "events").selectExpr(
        f"event_id AS {EVENTS_TRIP_ID}",
        f"ts AS {S.PICKUP}",
        f"ts + make_interval(0, 0, 0, 0, 0, CAST(event_id % 90 AS INT), 0) AS {S.DROPOFF}",
        f"CAST(event_id % 7 AS BIGINT) AS {S.PASSENGERS}",
        f"CAST(event_id % 120 AS DOUBLE) AS {S.DISTANCE}",
        f"CAST(user_id % 30 AS INT) AS {S.LOCATION}",
        f"{_code_map_sql('event_type', EVENT_PAYMENT_CODES)} AS {S.PAYMENT}",
        f"value AS {S.FARE}",
        f"{tip} AS {S.TIP}",
        f"value + {tip} AS {S.TOTAL}",
    )


def zones_from_nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region as the zone dimension (id = nation key).

    No join hint: Spark broadcasts a side only when its measured size is
    under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "inner")
            .selectExpr(f"n_nationkey AS {S.LOCATION}", f"r_name AS {S.BOROUGH}",
                        f"n_name AS {S.ZONE}"))


def trips_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as trips (larger volume, and a year rule that bites).

    pickup = l_shipdate (midnight only); dropoff = pickup; distance =
    l_quantity; passengers = l_linenumber; place = l_suppkey; payment from
    the return flag; fare = l_extendedprice; tip = fare * l_tax; total =
    fare * (1 - l_discount) * (1 + l_tax).
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"l_orderkey * 8 + l_linenumber AS {LINEITEM_TRIP_ID}",
        f"l_shipdate AS {S.PICKUP}",
        f"l_shipdate AS {S.DROPOFF}",
        f"CAST(l_linenumber AS BIGINT) AS {S.PASSENGERS}",
        f"l_quantity AS {S.DISTANCE}",
        f"CAST(l_suppkey AS INT) AS {S.LOCATION}",
        f"{_code_map_sql('l_returnflag', RETURNFLAG_PAYMENT_CODES)} AS {S.PAYMENT}",
        f"l_extendedprice AS {S.FARE}",
        f"l_extendedprice * l_tax AS {S.TIP}",
        f"l_extendedprice * (1 - l_discount) * (1 + l_tax) AS {S.TOTAL}",
    )


def trips_from_lineitem_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as trips that break every cleaning rule somewhere.

    As ``trips_from_lineitem``, but fare = l_extendedprice less 1000 per unit
    (often negative); total = fare less 5000 × l_discount × l_quantity (so some
    have a positive fare and no positive total); no pickup time where the
    return flag is R and the line number 7.
    """
    fare = "(l_extendedprice - 1000.0D * l_quantity)"
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"l_orderkey * 8 + l_linenumber AS {LINEITEM_TRIP_ID}",
        f"CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL ELSE l_shipdate END AS {S.PICKUP}",
        f"l_shipdate AS {S.DROPOFF}",
        f"CAST(l_linenumber - 1 AS BIGINT) AS {S.PASSENGERS}",
        f"l_quantity - 1 AS {S.DISTANCE}",
        f"CAST(l_suppkey AS INT) AS {S.LOCATION}",
        f"{_code_map_sql('l_returnflag', RETURNFLAG_PAYMENT_CODES)} AS {S.PAYMENT}",
        f"{fare} AS {S.FARE}",
        f"l_extendedprice * l_tax AS {S.TIP}",
        f"{fare} - 5000.0D * l_discount * l_quantity AS {S.TOTAL}",
    )


def zones_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier ⋈ nation ⋈ region as a place dimension keyed by supplier.

    Many suppliers share one (region, nation) pair, so names are not unique
    per id – the same property the real zone file has.  The supplier table
    grows with the scale factor, so no side is forced to broadcast: Spark
    broadcasts only what its size threshold admits and shuffles the rest.
    """
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "inner")
    return (s.join(nr, s.s_nationkey == nr.n_nationkey, "inner")
            .selectExpr(f"CAST(s_suppkey AS INT) AS {S.LOCATION}", f"r_name AS {S.BOROUGH}",
                        f"n_name AS {S.ZONE}"))
