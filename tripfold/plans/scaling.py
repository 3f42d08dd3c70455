"""Scaling slices and UNION ALL of separate inputs.

The reference's scaling study re-runs the location query on the first
1, 3, 6 and 12 of twelve monthly files.  Here that is one plan over the
data's own periods: step t of 12 holds the first t/12 of the periods that the
table has, so the last step is the whole table, whatever its dates.  Kept rows
are pre-aggregated once per (period, place); each pre-aggregated row goes to the
one step that first contains it, and the steps of a place are then summed up from
the first to the last (a running merge).  So the cost of the steps is that of
their results, however many there are.  The pre-aggregated rows are written to
the shared folder, since the list of periods (a scalar subquery) needs them as
well, so the table is scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripfold import schema as S
from tripfold.functions import derive as D
from tripfold.functions import exact as E
from tripfold.functions.rules import Rule, apply_rules, bench_rules
from tripfold.operators.partials import mean
from tripfold.plans.unions import union_all
from tripfold.session import scratch_table_path

__all__ = ["SLICE_STEPS", "day_slices", "scaled_slices", "union_all"]

# Twelfths of the table's periods.
SLICE_STEPS = (1, 3, 6, 12)
WHOLE = 12


def scaled_slices(trips: DataFrame, steps: Sequence[int] = SLICE_STEPS,
                  rules: list[Rule] | None = None, digits: int | None = 6) -> DataFrame:
    """(k, place) → trips and mean tip % over the first k/12 of the periods (days).

    Trips without a pickup time belong to the last period.
    """
    ks = sorted({int(k) for k in steps})
    kept = apply_rules(trips, bench_rules() if rules is None else rules).select(
        D.period_day().alias(S.PERIOD), S.LOCATION, D.tip_pct_unguarded().alias(S.TIP_PCT))
    per_period = kept.groupBy(S.PERIOD, S.LOCATION).agg(
        F.count(F.lit(1)).alias("trips"), F.expr(f"{E.exact_sum(S.TIP_PCT)} AS sum_tip_pct"),
        F.count(S.TIP_PCT).alias("n_tip_pct"))
    path = scratch_table_path(trips.sparkSession, "per-period")
    per_period.write.parquet(path)
    per_period = trips.sparkSession.read.schema(per_period.schema).parquet(path)
    # the distinct periods, in order (a few thousand days at most), as a scalar subquery
    periods = per_period.agg(F.sort_array(F.collect_set(S.PERIOD)).alias("periods")).scalar()
    placed = per_period.withColumn("periods", periods).select(
        S.LOCATION, "trips", "sum_tip_pct", "n_tip_pct",
        F.coalesce(F.array_position("periods", F.col(S.PERIOD)), F.size("periods")).alias("nth"),
        F.size("periods").alias("n"))
    arr = F.array(*[F.lit(k) for k in ks])
    # period nth of n lies in step k of 12 if nth <= ceil(n * k / 12)
    inside = F.filter(arr, lambda k: (F.col("nth") - 1) * WHOLE < F.col("n") * k)
    steps_of = placed.withColumn("step", F.array_min(inside)).where("step IS NOT NULL")
    own = steps_of.groupBy(S.LOCATION, "step").agg(
        F.sum("trips").alias("trips"), F.expr(f"{E.merged_sum('sum_tip_pct')} AS sum_tip_pct"),
        F.sum("n_tip_pct").alias("n_tip_pct"))
    # at most one row a step in each window
    ahead = Window.partitionBy(S.LOCATION).orderBy("step")
    so_far = ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = own.select(
        S.LOCATION, "step", F.lead("step").over(ahead).alias("next"), F.sum("trips").over(so_far).alias("trips"),
        F.sum("n_tip_pct").over(so_far).alias("n_tip_pct"),
        F.struct(*[F.sum(f"sum_tip_pct.{f}").over(so_far).alias(f) for f in E.EXACT_SUM.fieldNames()]).alias("sum_tip_pct"))
    # a place without trips of its own in a step has the sums of the one before
    until = F.filter(arr, lambda k: (k >= F.col("step")) & (F.col("next").isNull() | (k < F.col("next"))))
    return running.withColumn("k", F.explode(until)).select(
        "k", S.LOCATION, "trips", mean("sum_tip_pct", "n_tip_pct", digits).alias("avg_tip"))


def day_slices(trips: DataFrame, bounds: Sequence[str]) -> list[DataFrame]:
    """Split by pickup date at ``bounds`` into disjoint half-open slices.

    Each slice carries its own range predicate on the pickup column, which
    reaches the Parquet scan: files stored by period are read by one slice
    each.  (Over one unpartitioned file every slice scans it, so union
    separate files or partials instead.)  Rows without a pickup time go to the
    first slice, so the slices' union is the whole input.
    """
    edges = [None, *bounds, None]
    out = []
    col = F.col(S.PICKUP)
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = col.isNotNull() if lo is not None else F.lit(True)
        if lo is not None:
            cond = cond & (col >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            below = col < F.lit(hi).cast("timestamp_ntz")
            cond = cond & (below if lo is not None else (below | col.isNull()))
        out.append(trips.filter(cond))
    return out
