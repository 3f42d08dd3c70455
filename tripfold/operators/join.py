"""Fact → dimension left join that cannot multiply fact rows.

The dimension is grouped by its key inside the join's own plan, and a key with
two rows raises an error while the join runs.  So nothing runs when a join is
planned, a rewritten file is always seen, and even without the error a fact row
could not meet two dimension rows.

There is no broadcast hint: Spark broadcasts the dimension when its measured
size in bytes is under ``spark.sql.autoBroadcastJoinThreshold``, and otherwise
shuffles, where AQE's skew-join handling splits a hot fact key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_UNIQUE = "dimension key is not unique"


def unique(dim: DataFrame, key: str) -> DataFrame:
    """The dimension by its key; a key with two rows fails the query (NULL keys never match and are left out).

    The check is in the key column, which every join needs, so it can't be
    pruned away with columns that nobody reads.
    """
    rest = [c for c in dim.columns if c != key]
    one = dim.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in rest])
    error = F.raise_error(F.concat(F.lit(f"{NOT_UNIQUE}: {key} = "), F.col(key).cast("string"), F.lit(" has "), F.col("_n").cast("string"), F.lit(" rows")))
    checked = F.when(F.col("_n") == 1, F.col(key)).otherwise(error.cast(dim.schema[key].dataType))
    return one.select(checked.alias(key), *rest)


def left_join_dimension(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)``; unmatched fact rows keep NULLs."""
    return fact.join(unique(dim, key), on=key, how="left")
