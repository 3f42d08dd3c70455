"""End to end: the command line on written trip files and a zone CSV."""

import csv
import glob
import json
import os
import subprocess
import sys

from tripfold import schema as S
from tripfold.functions import rules as R
from tripfold.plans import reports as Q
from tripfold.plans import scaling as SC
from tripfold.sources import adapters as A

from fixtures import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_analyze_writes_reports_and_metrics(spark, tmp_path):
    trips = A.trips_from_events(spark, SF_SMALL).select(*[f.name for f in S.TRIPS.fields])
    for i, part in enumerate(SC.day_slices(trips, ("2024-01-11", "2024-01-21"))):
        part.coalesce(1).write.parquet(str(tmp_path / "trips" / f"2024-{i + 1:02d}"))
    zones_csv = tmp_path / "zones.csv"
    rows = [r for r in A.zones_from_nation_region(spark, SF_SMALL).collect()]
    with open(zones_csv, "w", newline="") as fh:
        fh.write('"LocationID","Borough","Zone","service_zone"\r\n')
        for r in rows:
            borough = "N/A" if r.PULocationID == 0 else r.Borough
            fh.write(f'{r.PULocationID},"{borough}","{r.Zone}","x"\r\n')
    out = tmp_path / "out"
    proc = subprocess.run(
        [sys.executable, "-m", "tripfold", "--master", "local[2]", "analyze",
         "--trips", str(tmp_path / "trips" / "*" / "*.parquet"), "--zones", str(zones_csv),
         "--out", str(out), "--year", "2024"],
        cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    clean = Q.clean_trips(trips, R.strict_rules(2024)).count()
    lines = [json.loads(x) for x in proc.stdout.splitlines() if x.startswith("{")]
    assert (lines[0]["raw_trips"], lines[0]["clean_trips"]) == (1000, clean)

    def read(name):
        with open(out / f"{name}.csv", newline="") as fh:
            return list(csv.DictReader(fh))
    by_hour = read("by_hour")
    assert [int(r["hour"]) for r in by_hour] == sorted(int(r["hour"]) for r in by_hour)
    assert sum(int(r["trips"]) for r in by_hour) == clean
    boroughs = {r["Borough"] for r in read("by_borough")}
    assert "N/A" in boroughs  # a value, not a missing marker
    assert len(read("top_zones")) == 15
    (metrics,) = glob.glob(str(out / "metrics" / "part-*.json"))
    m = json.loads(open(metrics).readline())
    assert (m["raw_trips"], m["clean_trips"]) == (1000, clean)


def run_cli(*args):
    proc = subprocess.run([sys.executable, "-m", "tripfold", "--master", "local[2]", *map(str, args)],
                          cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    return [json.loads(x) for x in proc.stdout.splitlines() if x.startswith("{")]


def test_scaling_gives_the_same_counts_for_a_path_and_its_uri(spark, tmp_path):
    trips = A.trips_from_events(spark, SF_SMALL).select(*[f.name for f in S.TRIPS.fields])
    for i, part in enumerate(SC.day_slices(trips, ("2024-01-11", "2024-01-21"))):
        part.coalesce(1).write.parquet(str(tmp_path / f"2024-{i + 1:02d}"))
    pattern = f"{tmp_path}/*/*.parquet"
    got = [run_cli("scaling", "--trips", x, "--steps", 1, 2, 3, "--repeats", 1) for x in (pattern, f"file://{pattern}")]
    counts = [[(r["files"], r["rows"]) for r in rows] for rows in got]
    assert counts[0] == counts[1] and counts[0][0][1] < counts[0][1][1] < counts[0][2][1]
    assert counts[0][2] == (3, R.apply_rules(trips, R.bench_rules()).count())


def test_ingest_twice_and_report(spark, tmp_path):
    trips = A.trips_from_events(spark, SF_SMALL).select(*[f.name for f in S.TRIPS.fields])
    trips.coalesce(1).write.parquet(str(tmp_path / "in"))
    A.zones_from_nation_region(spark, SF_SMALL).coalesce(1).write.parquet(str(tmp_path / "zones.parquet"))
    for _ in range(2):
        rejects = run_cli("ingest", "--source", tmp_path / "in", "--store", tmp_path / "store", "--year", 2024)
    assert {r["rule"] for r in rejects} == {r.name for r in R.strict_rules(2024)}
    rows = run_cli("report", "--store", tmp_path / "store", "--zones", tmp_path / "zones.parquet")
    assert sum(r["trips"] for r in rows if r["report"] == "by_hour") == Q.clean_trips(trips, R.strict_rules(2024)).count()
