"""Derived trip columns: hour of day, duration, tip percentage, period.

All are built-in expressions, so they stay inside whole-stage codegen.
Timestamps are ``timestamp_ntz``: hour and duration do not depend on the
session time zone, including across a daylight-saving change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold import schema as S


# Expression text for each derived column.  ``60.0D`` / ``0.0D`` are
# double literals (a bare ``60.0`` is DECIMAL in Spark SQL).
HOUR_SQL = f"hour({S.PICKUP})"
MINUTES_SQL = f"(unix_timestamp({S.DROPOFF}) - unix_timestamp({S.PICKUP})) / 60.0D"
TIP_PCT_SQL = f"CASE WHEN {S.FARE} > 0 THEN {S.TIP} / {S.FARE} * 100 ELSE 0.0D END"
TIP_PCT_UNGUARDED_SQL = f"try_divide({S.TIP}, {S.FARE}) * 100"
PERIOD_DAY_SQL = f"to_date({S.PICKUP})"
PERIOD_MONTH_SQL = f"trunc(to_date({S.PICKUP}), 'month')"


def tip_pct_unguarded() -> Column:
    """The benchmark's form: no guard; ANSI-safe (NULL instead of an error)."""
    return F.expr(TIP_PCT_UNGUARDED_SQL)


def period_day() -> Column:
    return F.expr(PERIOD_DAY_SQL)


def derive(df: DataFrame, period: str | Column | None = PERIOD_DAY_SQL) -> DataFrame:
    """Add hour, trip_minutes, tip_pct and the period column.

    ``period`` is expression text (``PERIOD_DAY_SQL`` by default), a Column,
    or ``None`` for no period column.
    """
    exprs = ["*", f"{HOUR_SQL} AS {S.HOUR}", f"{MINUTES_SQL} AS {S.MINUTES}",
             f"{TIP_PCT_SQL} AS {S.TIP_PCT}"]
    if isinstance(period, str):
        return df.selectExpr(*exprs, f"{period} AS {S.PERIOD}")
    out = df.selectExpr(*exprs)
    return out if period is None else out.withColumn(S.PERIOD, period)
