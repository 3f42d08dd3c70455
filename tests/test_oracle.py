"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from fixtures import SF_MID
from tripfold.plans.catalog import QUERIES

TABLES = ["region", "nation", "supplier", "lineitem", "events"]

# Reports with a promised order (a top-k, a chart's or a table's order).
ORDERED = {"top_zones": ["trips"], "zone_labels_rising": ["trips"], "borough_min_trips": ["total_revenue"],
           "tip_labels_by_payment": ["payment_type"], "scaling_feed": ["Step"],
           "formatted_borough_table": ["Borough"], "demand_by_hour": ["hour"],
           "revenue_by_borough": ["total_revenue"], "zone_labels_top10": ["trips"],
           "payment_labels": ["payment_type"], "lineitem_top_places": ["trips"]}
# Where the oracle's text leaves the order to the reader.
ORDER_BY = {"demand_by_hour": " ORDER BY hour", "payment_labels": " ORDER BY payment_type",
            "revenue_by_borough": " ORDER BY total_revenue DESC, Borough NULLS LAST"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["hour", "trips", "avg_distance_mi", "avg_fare", "avg_tip_pct"]
    assert df.count() == 24


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_MID)
    res = duck.execute(oracle_sql()[name] + ORDER_BY.get(name, ""))
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    got, want = _rows([tuple(r) for r in df.collect()], df.columns), _rows(res.fetchall(), ocols)
    assert got, "an empty result proves nothing"
    if name in ORDERED:
        assert got == want
    else:
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_every_rule_rejects_rows_somewhere(spark):
    counts = {r.rule: r.rejected for r in QUERIES["lineitem_margin_reject_counts"](spark, SF_MID).collect()}
    assert len(counts) == 7 and all(counts.values()), counts


def test_borough_threshold_keeps_some_and_drops_some_at_every_size(spark):
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        d = f"/root/testdata/{sf}"
        kept, every = (QUERIES[n](spark, d).count() for n in ("borough_min_trips", "revenue_by_borough"))
        assert 0 < kept < every, sf


def test_largest_slice_is_the_whole_table(spark):
    whole = sum(r.trips for r in QUERIES["trips_by_location"](spark, SF_MID).collect())
    steps = {}
    for r in QUERIES["scaled_slice"](spark, SF_MID).collect():
        steps[r.k] = steps.get(r.k, 0) + r.trips
    assert steps[12] == whole and steps[1] < steps[3] < steps[6] < steps[12]
