"""Mergeable partial aggregates: build → merge (roll up) → finalise.

Every report in the library is an algebraic aggregate: counts and sums
whose means are formed only at the end.  A partial row holds, for one key
combination, the trip count and the sums each report needs.  Partials over
disjoint row sets merge by summing, so a partial table can be built once
(in one scan), stored partitioned by period, extended period by period, and
rolled up to any coarser key set.

``avg_tip_pct`` is a mean of per-trip ratios, so the partial carries
``sum_tip_pct`` (and its own non-null count), not Σtip and Σfare.

Sums are exact (``functions.exact``): reports have the same bits for any
partitioning and order, and a partial row can be taken back by one with its sign
turned.  ``counted`` makes the partials and the counts of rejected rows in one
scan; ``lattice`` rolls a partial table up to several key sets in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold import schema as S
from tripfold.functions import derive as D
from tripfold.functions import exact as E
from tripfold.functions.rules import Rule


# Partial measures over cleaned, derived rows (name → aggregate text).
ROW_MEASURES = {
    "trips": "count(1)",
    "sum_distance": E.exact_sum(S.DISTANCE),
    "sum_fare": E.exact_sum(S.FARE),
    "sum_tip_pct": E.exact_sum(S.TIP_PCT),
    "n_tip_pct": f"count({S.TIP_PCT})",
    "sum_total": E.exact_sum(S.TOTAL),
}
EXACT = {"sum_distance", "sum_fare", "sum_tip_pct", "sum_total"}


def _row_measures() -> list[Column]:
    return [F.expr(f"{agg} AS {name}") for name, agg in ROW_MEASURES.items()]


MEASURES = ["trips", "sum_distance", "sum_fare", "sum_tip_pct", "n_tip_pct", "sum_total"]

# The finest key set the library stores.
PARTIAL_KEYS = [S.PERIOD, S.HOUR, S.LOCATION, S.PAYMENT]
# All that a report over one set of trips needs.
REPORT_KEYS = [S.HOUR, S.LOCATION, S.PAYMENT]


def partial_aggregate(clean: DataFrame, keys: Sequence[str] = PARTIAL_KEYS) -> DataFrame:
    """Cleaned, derived rows → one partial row per key combination.

    Planned as partial HashAggregate → hash exchange → final HashAggregate:
    each task emits at most one row per key it saw, so a hot key (one
    location holding a third of all trips) is collapsed map-side and never
    reaches a single reducer as raw rows.  Output size is bounded by the
    key domain (periods × 24 × places × payment codes), not by trips.
    """
    return clean.groupBy(*keys).agg(*_row_measures())


# Bit i is set in a row that breaks rule i; 0 for kept trips.
BROKEN = "broken"


def counted(trips: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = PARTIAL_KEYS,
            period: str | None = D.PERIOD_MONTH_SQL) -> DataFrame:
    """Raw trips → partials (``broken = 0``) and counts of rejected trips, in one scan.

    Rejected trips are grouped by the combination of rules that they break,
    with no other key and no sums, so they add at most 2**rules small rows.
    Being rows of the aggregate, the counts hold when tasks are retried, which
    observed metrics or accumulators don't promise.
    """
    broken = " + ".join(f"CASE WHEN {r.rejects_sql()} THEN {1 << i}L ELSE 0L END" for i, r in enumerate(rules))
    marked = trips.selectExpr("*", f"{broken or '0L'} AS {BROKEN}")
    derived = {S.HOUR: D.HOUR_SQL, S.TIP_PCT: D.TIP_PCT_SQL, **({S.PERIOD: period} if period else {})}
    own = [c for c in (S.LOCATION, S.PAYMENT, S.DISTANCE, S.FARE, S.TOTAL) if c not in derived]
    kept = [f"CASE WHEN {BROKEN} = 0 THEN {derived.get(c, c)} END AS {c}" for c in [*derived, *own]]
    return marked.selectExpr(BROKEN, *kept).groupBy(BROKEN, *keys).agg(*_row_measures())


def kept_partials(rows: DataFrame) -> DataFrame:
    """The partials among ``counted`` rows."""
    return rows.where(f"{BROKEN} = 0").drop(BROKEN)


def rejected_by_rule(counts: dict[int, int], rules: Sequence[str]) -> list[tuple[int, str, int]]:
    """(order, rule, rejected) from trips by combination of broken rules; a trip may break several."""
    return [(i, name, sum(n for broken, n in counts.items() if broken >> i & 1)) for i, name in enumerate(rules)]


def _merged_measures() -> list[Column]:
    return [F.expr(f"{E.merged_sum(m) if m in EXACT else f'sum({m})'} AS {m}") for m in MEASURES]


def merge(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Roll partials up to ``keys`` (a subset of their keys) by summing."""
    return partials.groupBy(*keys).agg(*_merged_measures())


def negated(rows: DataFrame) -> DataFrame:
    """Partials that take ``rows`` back when they are merged."""
    signs = {m: E.negated(m) if m in EXACT else f"-{m}" for m in MEASURES}
    return rows.selectExpr(*[f"{signs[c]} AS {c}" if c in signs else c for c in rows.columns])


# Which key set a row of a lattice belongs to: its keys joined by commas.
LEVEL = "level"


def lattice(partials: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Partials rolled up to several key sets in one pass (GROUPING SETS).

    A row has its level, the keys of it (others NULL) and the measures.
    """
    keys = list(dict.fromkeys(k for level in levels for k in level))
    bit = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    # grouping_id has a bit for each key that a row is summed over
    names = {sum(b for k, b in bit.items() if k not in level): ",".join(level) for level in levels}
    level = "CASE grouping_id() " + " ".join(f"WHEN {i} THEN '{name}'" for i, name in names.items()) + " END"
    rows = partials.groupingSets([list(x) for x in levels], *keys)
    return rows.agg(F.expr(f"{level} AS {LEVEL}"), *_merged_measures())


def at_level(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The partials by ``keys`` among the rows of a lattice."""
    return rows.where(F.col(LEVEL) == ",".join(keys)).select(*keys, *MEASURES)


def measures(source: DataFrame, keys: Sequence[str], from_partials: bool) -> DataFrame:
    """Partial measures at ``keys`` from either cleaned rows or partials."""
    return merge(source, keys) if from_partials else partial_aggregate(source, keys)


def mean_sql(sum_col: str, n_col: str = "trips", digits: int | None = 2) -> str:
    value = f"try_divide({E.total(sum_col)}, {n_col})"
    return f"round({value}, {digits})" if digits is not None else value


def mean(sum_col: str, n_col: str = "trips", digits: int | None = 2) -> Column:
    return F.expr(mean_sql(sum_col, n_col, digits))


def money(sum_col: str, digits: int = 2) -> Column:
    return F.expr(f"round({E.total(sum_col)}, {digits})")
