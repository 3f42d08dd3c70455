"""The full analysis job: counts + the four reports from one scan of the trips.

Job layout (what runs, in order):

1. the only scan: ``counted`` groups kept trips by the report keys and rejected
   trips by the rules they break, so raw, clean and rejected counts come with
   the partials (a filter for the rules would hide the rows that are counted,
   so none is pushed to the reader; columns are pruned);
2. its lattice (one pass, GROUPING SETS): trips by broken rules, partials by
   hour, by place and by payment type – a few hundred rows, persisted;
3. the reports, small jobs over the lattice; places are named by a join after
   the aggregation.

With a store the counted rows also have the month and become one batch of it;
the lattice is then made from that batch alone, so raw and clean counts are of
the same trips.  The wide cleaned fact is never cached.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripfold import schema as S
from tripfold.functions.rules import Rule
from tripfold.operators.partials import BROKEN, LEVEL, REPORT_KEYS, at_level, counted, kept_partials, lattice, rejected_by_rule
from tripfold.operators.topk import top_k
from tripfold.plans import reports as Q
from tripfold.store import PartialsStore


@dataclass
class PipelineResult:
    raw_trips: int
    clean_trips: int
    rejected: dict[str, int] = field(default_factory=dict)
    by_hour: list[Row] = field(default_factory=list)
    top_zones: list[Row] = field(default_factory=list)
    by_borough: list[Row] = field(default_factory=list)
    by_payment: list[Row] = field(default_factory=list)
    schemas: dict[str, StructType] = field(default_factory=dict)

    @property
    def pct_kept(self) -> float | None:
        return round(100.0 * self.clean_trips / self.raw_trips, 1) if self.raw_trips else None


# The key sets that the four reports start from.
REPORT_LEVELS = [[S.HOUR], [S.LOCATION], [S.PAYMENT]]


def build_reports(rolled: DataFrame, zones: DataFrame, k: int = 15,
                  named: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four reports as plans over a lattice with ``REPORT_LEVELS``.

    ``named`` – measures by (Borough, Zone) – may be passed in persisted, so
    the zone and borough reports share one join.
    """
    if named is None:
        named = _named(rolled, zones)
    return {
        "by_hour": Q.finalise_hours(at_level(rolled, [S.HOUR])),
        "top_zones": top_k(Q.finalise_zones(named), k, desc=["trips"], asc=[S.BOROUGH, S.ZONE]),
        "by_borough": Q.finalise_boroughs(named),
        "by_payment": Q.finalise_payments(at_level(rolled, [S.PAYMENT])),
    }


def _named(rolled: DataFrame, zones: DataFrame) -> DataFrame:
    """(Borough, Zone) measures: bounded by the number of named places."""
    return Q.named_measures(at_level(rolled, [S.LOCATION]), zones, [S.BOROUGH, S.ZONE])


def run_pipeline(trips: DataFrame, zones: DataFrame, rules: list[Rule], k: int = 15,
                 store: PartialsStore | None = None, batch: str = "all",
                 inputs: list[str] | None = None, on_overlap: str = "refuse") -> PipelineResult:
    """Run the whole analysis; report results are bounded and collected.

    With a store, ``inputs`` and ``on_overlap`` are those of ``PartialsStore.load``.
    """
    if store is not None:
        entry = store.load(trips, rules, batch, inputs, on_overlap=on_overlap)
        counts = {int(x): n for x, n in entry.counts.items()}
        rolled = lattice(store.read(batch), REPORT_LEVELS).persist(StorageLevel.MEMORY_AND_DISK)
    else:
        rows = counted(trips, rules, REPORT_KEYS, period=None)
        whole = lattice(rows, [[BROKEN], *[[BROKEN, *level] for level in REPORT_LEVELS]]).persist(StorageLevel.MEMORY_AND_DISK)
        # one row for each combination of broken rules; runs the scan
        counts = {r[BROKEN]: r["trips"] for r in at_level(whole, [BROKEN]).collect()}
        rolled = kept_partials(whole).withColumn(LEVEL, F.expr(f"substring({LEVEL}, {len(BROKEN) + 2})"))
    named = _named(rolled, zones).persist()
    try:
        plans = build_reports(rolled, zones, k, named=named)
        reports = {name: df.collect() for name, df in plans.items()}
    finally:
        named.unpersist()
        (rolled if store is not None else whole).unpersist()
    return PipelineResult(
        raw_trips=sum(counts.values()), clean_trips=counts.get(0, 0),
        rejected={name: n for _, name, n in rejected_by_rule(counts, [r.name for r in rules])},
        schemas={n: df.schema for n, df in plans.items()}, **reports)


def store_reports(store: PartialsStore, zones: DataFrame, k: int = 15, start: str | None = None,
                  end: str | None = None) -> dict[str, DataFrame]:
    """The four reports of everything in a store, or of the months ``start <= period < end``."""
    rows = store.read() if start is None else store.periods(start, end or "9999-12-31")
    return build_reports(lattice(rows, REPORT_LEVELS), zones, k)


def report_frames(spark, result: PipelineResult) -> dict[str, DataFrame]:
    """The collected (bounded) reports back as DataFrames, e.g. for sinks."""
    return {name: spark.createDataFrame(getattr(result, name), schema)
            for name, schema in result.schemas.items()}
