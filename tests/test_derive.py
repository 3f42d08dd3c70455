from fixtures import trap_trips

from tripfold import schema as S
from tripfold.functions import rules as R
from tripfold.plans import reports as Q


def _by_case(df):
    return {r.case_name: r for r in df.collect()}


def test_hour_minutes_tip(spark):
    rows = _by_case(Q.clean_trips(trap_trips(spark), R.strict_rules(2024)))
    v = rows["valid"]
    assert (v.hour, v.trip_minutes, v.tip_pct) == (10, 20.0, 20.0)
    assert str(v.period) == "2024-06-01"


def test_negative_duration_is_kept(spark):
    rows = _by_case(Q.clean_trips(trap_trips(spark), R.strict_rules(2024)))
    assert rows["dropoff_before_pickup"].trip_minutes == -10.0


def test_duration_and_hour_ignore_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = _by_case(Q.clean_trips(trap_trips(spark), R.strict_rules(2024)))["across_dst"]
            assert (r.hour, r.trip_minutes) == (1, 80.0), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tip_pct_guard_and_unguarded_form(spark):
    from pyspark.sql import functions as F
    from tripfold.functions import derive as D
    df = spark.createDataFrame([(0.0, 1.0), (4.0, 1.0)], f"{S.FARE} double, {S.TIP} double")
    out = df.select(F.expr(D.TIP_PCT_SQL).alias("g"), D.tip_pct_unguarded().alias("u")).collect()
    assert (out[0].g, out[0].u) == (0.0, None)  # no ANSI divide-by-zero error
    assert (out[1].g, out[1].u) == (25.0, 25.0)


def test_period_can_be_switched_off(spark):
    assert S.PERIOD not in Q.clean_trips(trap_trips(spark), R.strict_rules(2024), None).columns
    assert S.PERIOD in Q.clean_trips(trap_trips(spark), R.strict_rules(2024)).columns
