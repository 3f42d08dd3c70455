"""Sums of doubles that don't depend on the order of the rows.

A value is taken apart into whole units and two 20-bit parts of its fraction
(steps of 2**-20 and of 2**-40; smaller bits are cut off).  Each part is summed
as a bigint, so a sum has the same bits for any partitioning, merges by adding,
and has an exact inverse.  The parts leave room for 2**43 rows a group; beyond a
bigint the sum fails rather than wraps (ANSI).  Decimal sums would do the same
at some ten times the CPU.

Values that are no finite number, or 2**53 and more, are summed as doubles in
``odd``: NaN and infinities give what a sum of doubles gives.
"""

from __future__ import annotations

from pyspark.sql import types as T

EXACT_SUM = T.StructType([T.StructField("whole", T.LongType(), True), T.StructField("mid", T.LongType(), True),
                          T.StructField("low", T.LongType(), True), T.StructField("odd", T.DoubleType(), True)])

_LIMIT = "9007199254740992D"  # 2**53
_STEP = "1048576D"  # 2**20


def exact_sum(value: str) -> str:
    """Aggregate text: the exact sum of a column; every part is NULL where no row has a value."""
    x = f"CASE WHEN abs({value}) < {_LIMIT} THEN {value} END"
    mid = f"(({x}) - floor({x})) * {_STEP}"
    return (f"struct(sum(floor({x})) AS whole, sum(floor({mid})) AS mid, "
            f"sum(floor(({mid} - floor({mid})) * {_STEP})) AS low, "
            f"sum(CASE WHEN NOT abs({value}) < {_LIMIT} THEN {value} END) AS odd)")


def merged_sum(column: str, where: str | None = None) -> str:
    """Aggregate text: the sum of exact sums (of the rows ``where``)."""
    only = f" FILTER (WHERE {where})" if where else ""
    return "struct(" + ", ".join(f"sum({column}.{f.name}){only} AS {f.name}" for f in EXACT_SUM.fields) + ")"


def negated(column: str) -> str:
    """The exact sum with its sign turned; fails on values without an inverse."""
    odd = f"CASE WHEN {column}.odd IS NOT NULL THEN CAST(raise_error('{column} holds values that cannot be taken back') AS DOUBLE) END"
    return f"struct(-{column}.whole AS whole, -{column}.mid AS mid, -{column}.low AS low, {odd} AS odd)"


def total(column: str) -> str:
    """The sum as a double; the same for any order, since its parts are."""
    value = (f"(CAST({column}.whole AS DOUBLE) + (CAST({column}.mid AS DOUBLE) + CAST({column}.low AS DOUBLE) / {_STEP}) / {_STEP})")
    return f"CASE WHEN {column}.odd IS NULL THEN {value} ELSE coalesce({value}, 0D) + {column}.odd END"
