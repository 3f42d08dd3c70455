from fixtures import EXPECTED_REJECTS, kept_names, trap_trips

from tripfold.functions import rules as R
from tripfold.plans import reports as Q


def test_strict_rules_keep_exactly_the_valid_cases(spark):
    kept = R.apply_rules(trap_trips(spark), R.strict_rules(2024))
    assert {r.case_name for r in kept.select("case_name").collect()} == kept_names()


def test_reject_counts_one_per_rule(spark):
    rows = R.reject_counts(trap_trips(spark), R.strict_rules(2024)).collect()
    assert [r.rule for r in sorted(rows, key=lambda r: r.rule_order)] == list(EXPECTED_REJECTS)
    assert {r.rule: r.rejected for r in rows} == EXPECTED_REJECTS


def test_retention_counts_raw_and_clean_in_one_pass(spark):
    row = R.retention(trap_trips(spark), R.strict_rules(2024)).first()
    assert row.raw_trips == 21
    assert row.clean_trips == len(kept_names())
    assert row.pct_kept == round(100.0 * len(kept_names()) / 21, 1)


def test_nan_amounts_are_rejected(spark):
    # Spark orders NaN above every number, so a bare `> 0` would keep it.
    kept = R.apply_rules(trap_trips(spark), R.strict_rules(2024))
    names = {r.case_name for r in kept.collect()}
    assert not names & {"fare_nan", "total_nan", "distance_nan"}


def test_bench_rules_are_a_superset_of_strict(spark):
    trips = trap_trips(spark)
    strict = {r.case_id for r in R.apply_rules(trips, R.strict_rules(2024)).collect()}
    bench = {r.case_id for r in R.apply_rules(trips, R.bench_rules()).collect()}
    assert strict <= bench
    # bench has no total/bound/year rule
    names = {r.case_name for r in R.apply_rules(trips, R.bench_rules()).collect()}
    assert {"total_zero", "distance_100", "pickup_2025_first"} <= names


def test_year_rule_is_a_pushed_range(spark, tmp_path):
    path = str(tmp_path / "trips")
    trap_trips(spark).write.parquet(path)
    from tripfold.sources.files import read_trips
    df = Q.clean_trips(read_trips(spark, path), R.strict_rules(2024))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)" in plan
    assert "LessThan(tpep_pickup_datetime,2025-01-01T00:00)" in plan


def test_parameterised_year_and_bound(spark):
    rules = R.strict_rules(year=2025, max_distance=50.0)
    kept = {r.case_name for r in R.apply_rules(trap_trips(spark), rules).collect()}
    assert kept == {"pickup_2025_first"}
