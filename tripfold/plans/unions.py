"""UNION ALL of several frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name (per-file frames, per-period partials)."""
    return reduce(lambda a, b: a.unionByName(b), frames)
