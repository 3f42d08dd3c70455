"""Deterministic ordering and top-k.

A measure alone does not order ties; every ordering here appends the group
keys as tie-breakers with an explicit NULL position, so the top-k cut is
the same in every run, partitioning and engine.  ``orderBy().limit(k)`` is
planned as ``TakeOrderedAndProject``: each task keeps only its k best rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordering(desc: Sequence[str] = (), asc: Sequence[str] = ()) -> list[Column]:
    return ([F.col(c).desc_nulls_last() for c in desc]
            + [F.col(c).asc_nulls_last() for c in asc])


def top_k(df: DataFrame, k: int, desc: Sequence[str] = (), asc: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*ordering(desc, asc)).limit(k)


def sort(df: DataFrame, desc: Sequence[str] = (), asc: Sequence[str] = ()) -> DataFrame:
    """Global sort (range-partitioned; for results of any size)."""
    return df.orderBy(*ordering(desc, asc))


def sort_bounded(df: DataFrame, desc: Sequence[str] = (), asc: Sequence[str] = ()) -> DataFrame:
    """Sort a result whose size is bounded by its key domain.

    Use only on finished reports (one row per hour, borough, payment code…):
    the rows are gathered into one partition and sorted there, which skips
    the sampling job a range-partitioned sort needs.
    """
    return df.repartition(1).sortWithinPartitions(*ordering(desc, asc))
