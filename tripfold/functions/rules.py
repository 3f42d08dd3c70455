"""Named data-quality rules, rule sets, and per-rule reject counts.

Each rule is a boolean Column that is TRUE for a row to keep.  A NULL
operand makes the comparison NULL, and ``filter`` drops NULL like FALSE
(three-valued logic).  Spark orders NaN above every number, so ``NaN > 0``
is TRUE; the positivity rules therefore also test ``isnan`` so that a NaN
amount is rejected, as a single-machine engine would.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold import schema as S


@dataclass(frozen=True)
class Rule:
    """A named keep-condition, held as Spark SQL expression text.

    Text keeps plan construction to one JVM call per rule set (the Column
    API costs one call per operator), and the same text is what shows up
    in ``explain`` output.
    """
    name: str
    sql: str

    def rejects_sql(self) -> str:
        """TRUE where the row breaks the rule (NULL counts as broken)."""
        return f"NOT coalesce(({self.sql}), false)"

    def rejects(self) -> Column:
        return F.expr(self.rejects_sql())


def positive(column: str) -> str:
    return f"({column} > 0 AND NOT isnan({column}))"


def below(column: str, bound: float) -> str:
    return f"({column} < CAST({float(bound)!r} AS DOUBLE) AND NOT isnan({column}))"


def in_year(column: str, year: int) -> str:
    """Calendar-year test written as a half-open range.

    ``year(ts) = y`` is not pushed to Parquet; the range is, with both
    bounds, so row groups outside the year are skipped.
    """
    lo = dt.datetime(year, 1, 1).isoformat(sep=" ")
    hi = dt.datetime(year + 1, 1, 1).isoformat(sep=" ")
    return (f"({column} >= TIMESTAMP_NTZ '{lo}' AND {column} < TIMESTAMP_NTZ '{hi}')")


def strict_rules(year: int | None, max_distance: float = 100.0) -> list[Rule]:
    """The cleaning rules of the full analysis: six, and a seventh for one calendar year.

    The year has no default: a job must say which year it keeps, or ``None``
    to keep every year.
    """
    rules = [
        Rule("fare_positive", positive(S.FARE)),
        Rule("distance_positive", positive(S.DISTANCE)),
        Rule("distance_below_max", below(S.DISTANCE, max_distance)),
        Rule("total_positive", positive(S.TOTAL)),
        Rule("passengers_positive", f"({S.PASSENGERS} > 0)"),
        Rule("pickup_present", f"({S.PICKUP} IS NOT NULL)"),
    ]
    return rules if year is None else [*rules, Rule("pickup_in_year", in_year(S.PICKUP, year))]


def bench_rules() -> list[Rule]:
    """The three-rule set of the scaling benchmark (no year/total/bound)."""
    return [
        Rule("fare_positive", positive(S.FARE)),
        Rule("distance_positive", positive(S.DISTANCE)),
        Rule("passengers_positive", f"({S.PASSENGERS} > 0)"),
    ]


def all_of_sql(rules: list[Rule]) -> str:
    return " AND ".join(r.sql for r in rules)


def all_of(rules: list[Rule]) -> Column:
    return F.expr(all_of_sql(rules))


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Keep rows that pass every rule (one Filter; pushed to the scan)."""
    return df.filter(all_of(rules))


def retention(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """raw, clean and % kept (1 dp) in a single scan."""
    agg = df.selectExpr("count(1) AS raw_trips",
                        f"count_if(coalesce({all_of_sql(rules)}, false)) AS clean_trips")
    return agg.selectExpr(
        "raw_trips", "clean_trips",
        "round(try_divide(clean_trips * 100.0D, raw_trips), 1) AS pct_kept")


def reject_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule_order, rule, rejected) in one scan; a row may break several rules.

    One global aggregate with one conditional count per rule (partial
    counts per task, one row shuffled per task), then a tiny unpivot.
    """
    counts = df.selectExpr(*[f"count_if({r.rejects_sql()}) AS r{i}"
                             for i, r in enumerate(rules)])
    stack = ", ".join(f"{i}, '{r.name}', r{i}" for i, r in enumerate(rules))
    return counts.selectExpr(f"stack({len(rules)}, {stack}) AS (rule_order, rule, rejected)")
