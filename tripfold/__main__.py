"""Command line: ``python -m tripfold <command> ...`` (under spark-submit on a cluster).

analyze  – raw/clean counts and the four reports → one CSV each + metrics
scaling  – the location query on the first 1/3/6/12 files, with timings
ingest   – incremental partials from a landing folder (Structured Streaming)
report   – the four reports from a store of partials
schema   – column types of the trip files against the declared schema
correct  – exchange one input file in a store for its corrected form
batches  – what a store holds
vacuum   – delete a store's folders that no batch needs any more

Every command prints JSON lines.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import statistics
import time

from pyspark.sql import functions as F

from tripfold.functions.rules import strict_rules
from tripfold.plans import reports as Q
from tripfold.plans.pipeline import report_frames, run_pipeline, store_reports
from tripfold.session import build_session
from tripfold.sinks import write_metrics, write_report_csv
from tripfold.sources.files import list_files, read_trip_slices, read_zones_csv, read_zones_parquet
from tripfold.sources.reconcile import read_reconciled, summary, type_report
from tripfold.store import PartialsStore


def _zones(spark, path):
    return read_zones_parquet(spark, path) if path.endswith(".parquet") else read_zones_csv(spark, path)


def _emit(**fields) -> None:
    print(json.dumps(fields, default=str), flush=True)


def _emit_report(name: str, rows) -> None:
    for row in rows:
        _emit(report=name, **row.asDict())


def analyze(args) -> None:
    t0 = time.time()
    spark = build_session("tripfold-analyze", master=args.master)
    files = list_files(spark, args.trips)
    trips = read_reconciled(spark, files, on_conflict=args.on_conflict)
    store = PartialsStore(spark, args.partials) if args.partials else None
    # the same files make the same batch, so a repeated run replaces its own rows
    batch = args.batch or hashlib.sha1("\n".join(files).encode()).hexdigest()[:16]
    res = run_pipeline(trips, _zones(spark, args.zones), strict_rules(args.year, args.max_distance),
                       k=args.top, store=store, batch=batch, inputs=files, on_overlap=args.on_overlap)
    elapsed = time.time() - t0
    _emit(raw_trips=res.raw_trips, clean_trips=res.clean_trips, pct_kept=res.pct_kept,
          rejected=res.rejected, seconds=round(elapsed, 3))
    if args.out:
        # the reports are already collected (bounded); write them as they are
        for name, df in report_frames(spark, res).items():
            write_report_csv(df, f"{args.out.rstrip('/')}/{name}.csv")
        write_metrics(spark, f"{args.out.rstrip('/')}/metrics", engine="spark",
                      raw_trips=res.raw_trips, clean_trips=res.clean_trips,
                      runtime_sec=round(elapsed, 3))
    for name in ("by_hour", "top_zones", "by_borough", "by_payment"):
        _emit_report(name, getattr(res, name))
    spark.stop()


def scaling(args) -> None:
    spark = build_session("tripfold-scaling", master=args.master)
    files = list_files(spark, args.trips)
    rows = []
    for k in args.steps:
        # the total is a sum over the per-place result; no row is gathered
        plan = Q.location_report(read_trip_slices(spark, files, k)).agg(F.sum("trips").alias("rows"))
        plan.collect()  # warm-up
        times = []
        for _ in range(args.repeats):
            t0 = time.time()
            (got,) = plan.collect()
            times.append(time.time() - t0)
        rows.append((k, int(got["rows"] or 0), round(statistics.median(times), 3)))
        _emit(files=min(k, len(files)), rows=rows[-1][1], spark_sec=rows[-1][2])
    if args.out:
        df = spark.createDataFrame(rows, "months int, rows bigint, spark_sec double")
        write_report_csv(df, args.out)
    spark.stop()


def ingest(args) -> None:
    from tripfold.streaming import incremental
    spark = build_session("tripfold-ingest", master=args.master)
    q = incremental.start(spark, args.source, args.store,
                          strict_rules(args.year, args.max_distance), args.checkpoint,
                          max_files_per_trigger=args.max_files,
                          available_now=not args.continuous,
                          processing_time="1 minute" if args.continuous else None,
                          on_overlap=args.on_overlap)
    q.awaitTermination()
    for row in PartialsStore(spark, args.store).rejects().groupBy("rule_order", "rule").agg(
            F.sum("rejected").alias("rejected")).orderBy("rule_order").collect():
        _emit(rule=row["rule"], rejected=row["rejected"])
    spark.stop()


def report(args) -> None:
    spark = build_session("tripfold-report", master=args.master)
    frames = store_reports(PartialsStore(spark, args.store), _zones(spark, args.zones), args.top,
                           args.start, args.end)
    for name, df in frames.items():
        rows = df.collect()  # bounded; computed once
        if args.out:
            write_report_csv(spark.createDataFrame(rows, df.schema), f"{args.out.rstrip('/')}/{name}.csv")
        _emit_report(name, rows)
    spark.stop()


def schema(args) -> None:
    spark = build_session("tripfold-schema", master=args.master)
    rows = summary(type_report(spark, list_files(spark, args.trips)))
    for row in rows.orderBy("column", "verdict", "type").collect():  # columns × types that occur
        _emit(**row.asDict())
    spark.stop()


def correct(args) -> None:
    spark = build_session("tripfold-correct", master=args.master)
    entry = PartialsStore(spark, args.store).correct(args.old, args.new)
    _emit(batch=entry.batch, raw_trips=entry.raw_trips, clean_trips=entry.clean_trips)
    spark.stop()


def batches(args) -> None:
    spark = build_session("tripfold-batches", master=args.master)
    for e in PartialsStore(spark, args.store).entries():
        _emit(batch=e.batch, commit=e.id, raw_trips=e.raw_trips, clean_trips=e.clean_trips,
              files=[i[0] for i in e.inputs], taken_back=e.taken_back)
    spark.stop()


def vacuum(args) -> None:
    spark = build_session("tripfold-vacuum", master=args.master)
    for path in PartialsStore(spark, args.store).vacuum(args.days):
        _emit(deleted=path)
    spark.stop()


def _overlap_option(parser) -> None:
    parser.add_argument("--on-overlap", choices=["refuse", "replace"], default="refuse",
                        help="what to do about files that another batch of the store holds")


def _rule_options(parser, year_required: bool) -> None:
    parser.add_argument("--year", type=int, required=year_required, default=None,
                        help="keep pickups of this year" + ("" if year_required else " (default: every year)"))
    parser.add_argument("--max-distance", type=float, default=100.0)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tripfold")
    p.add_argument("--master", default=None, help="only for local runs")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("analyze")
    a.add_argument("--trips", nargs="+", required=True, help="Parquet files/globs")
    a.add_argument("--zones", required=True, help="zone CSV (header) or Parquet")
    a.add_argument("--out", default=None, help="folder for report CSVs and metrics")
    a.add_argument("--partials", default=None, help="store of partials to write this run to")
    a.add_argument("--batch", default=None, help="name of this run in the store (default: from its files)")
    a.add_argument("--top", type=int, default=15)
    _rule_options(a, year_required=True)
    _overlap_option(a)
    a.add_argument("--on-conflict", choices=["fail", "cast"], default="fail",
                   help="what to do about files whose column types can't be read as declared")
    a.set_defaults(fn=analyze)
    s = sub.add_parser("scaling")
    s.add_argument("--trips", nargs="+", required=True)
    s.add_argument("--steps", type=int, nargs="+", default=[1, 3, 6, 12])
    s.add_argument("--repeats", type=int, default=3)
    s.add_argument("--out", default=None)
    s.set_defaults(fn=scaling)
    i = sub.add_parser("ingest")
    i.add_argument("--source", required=True)
    i.add_argument("--store", required=True)
    i.add_argument("--checkpoint", default=None, help="default: inside the store")
    i.add_argument("--max-files", type=int, default=None)
    i.add_argument("--continuous", action="store_true")
    _rule_options(i, year_required=False)
    _overlap_option(i)
    i.set_defaults(fn=ingest)
    r = sub.add_parser("report")
    r.add_argument("--store", required=True)
    r.add_argument("--zones", required=True)
    r.add_argument("--from", dest="start", default=None, help="first month, e.g. 2024-01-01")
    r.add_argument("--to", dest="end", default=None, help="month after the last")
    r.add_argument("--out", default=None)
    r.add_argument("--top", type=int, default=15)
    r.set_defaults(fn=report)
    t = sub.add_parser("schema")
    t.add_argument("--trips", nargs="+", required=True)
    t.set_defaults(fn=schema)
    c = sub.add_parser("correct")
    c.add_argument("--store", required=True)
    c.add_argument("--old", required=True, help="the file as it was read (must be unchanged)")
    c.add_argument("--new", required=True, help="its corrected form, under another name")
    c.set_defaults(fn=correct)
    b = sub.add_parser("batches")
    b.add_argument("--store", required=True)
    b.set_defaults(fn=batches)
    v = sub.add_parser("vacuum")
    v.add_argument("--store", required=True)
    v.add_argument("--days", type=float, default=7.0)
    v.set_defaults(fn=vacuum)
    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
