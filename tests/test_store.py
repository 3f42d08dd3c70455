"""The partials store: commits, overlap, corrected files, upkeep."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tripfold import hadoop as H
from tripfold import schema as S
from tripfold.functions import derive as D
from tripfold.functions.rules import Rule, reject_counts, strict_rules
from tripfold.operators.partials import MEASURES, PARTIAL_KEYS, partial_aggregate
from tripfold.plans import reports as Q
from tripfold.plans import scaling as SC
from tripfold.plans.pipeline import run_pipeline, store_reports
from tripfold.sources import adapters as A
from tripfold.sources.files import list_files, read_trips
from tripfold.store import FULL, ChangedInputError, Entry, Log, OverlapError, PartialsStore, State, plan_change
from tripfold.streaming import incremental as INC

from fixtures import NAN, SF_SMALL, trap_trips

RULES = strict_rules(2024)
ALL = 713


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    """Three trip files, and a corrected form of the second."""
    at = tmp_path_factory.mktemp("months")
    trips = A.trips_from_events(spark, SF_SMALL).select(*S.TRIPS.fieldNames())
    for i, part in enumerate(SC.day_slices(trips, ("2024-01-11", "2024-01-21"))):
        part.coalesce(1).write.parquet(f"{at}/m{i + 1}")
    second = spark.read.parquet(f"{at}/m2")
    second.where(f"{S.PAYMENT} <> 2").withColumn(S.FARE, F.col(S.FARE) + 0.1).coalesce(1).write.parquet(f"{at}/m2-corrected")
    return {name: list_files(spark, f"{at}/{name}")[0] for name in ("m1", "m2", "m3", "m2-corrected")}


def rows(df, cols=(*PARTIAL_KEYS, *MEASURES)):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def fresh(spark, files, rules=RULES):
    """Partials of files without a store."""
    return partial_aggregate(Q.clean_trips(read_trips(spark, files), rules, D.PERIOD_MONTH_SQL))


def held(store):
    return sum(r.trips for r in store.read().collect())


def load(store, files, batch, **how):
    return store.load(read_trips(store.spark, files), RULES, batch, **how)


def test_a_batch_over_all_files_after_one_of_a_month(spark, months, scratch):
    store = PartialsStore(spark, scratch + "/s")
    all_files = [months[m] for m in ("m1", "m2", "m3")]
    jan = load(store, [months["m1"]], "jan")
    assert held(store) == jan.clean_trips < ALL
    with pytest.raises(OverlapError, match="'jan'"):
        load(store, all_files, "year")
    assert [e.batch for e in store.entries()] == ["jan"] and held(store) == jan.clean_trips
    load(store, all_files, "year", on_overlap="replace")
    assert [e.batch for e in store.entries()] == ["year"]
    assert held(store) == ALL and rows(store.merged()) == rows(fresh(spark, all_files))
    # and the other way round: a month of what is already there
    with pytest.raises(OverlapError, match="'year'"):
        load(store, [months["m1"]], "jan")
    load(store, all_files, "year")  # the same batch again replaces itself
    assert held(store) == ALL


def test_a_part_of_another_batch_is_taken_back(spark, months, scratch):
    store = PartialsStore(spark, scratch + "/s")
    load(store, [months["m1"], months["m2"]], "early")
    with pytest.raises(OverlapError):
        load(store, [months["m2"], months["m3"]], "late")
    load(store, [months["m2"], months["m3"]], "late", on_overlap="replace")
    want = fresh(spark, [months[m] for m in ("m1", "m2", "m3")])
    assert rows(store.merged()) == rows(want) and held(store) == ALL
    assert rows(store.read("early")) == rows(fresh(spark, [months["m1"]]))
    assert store.counts() == (1000, ALL)
    # the file belongs to the later batch now; the first batch's part is free of it
    load(store, [months["m2"]], "february", on_overlap="replace")
    assert rows(store.merged()) == rows(want)
    for batch in ("early", "late", "february"):
        store.compact(batch)
    assert rows(store.merged()) == rows(want) and not any(e.of for e in store.entries())


def test_a_corrected_file_gives_what_a_fresh_run_gives(spark, months, scratch):
    store = PartialsStore(spark, scratch + "/s")
    load(store, [months[m] for m in ("m1", "m2", "m3")], "year")
    before = store.counts()
    entry = store.correct(months["m2"], months["m2-corrected"])
    now = [months[m] for m in ("m1", "m2-corrected", "m3")]
    assert entry.batch == "year" and rows(store.merged()) == rows(fresh(spark, now))
    assert store.counts() != before
    raw = read_trips(spark, now)
    assert store.counts() == (raw.count(), Q.clean_trips(raw, RULES).count())
    zones = A.zones_from_nation_region(spark, SF_SMALL)
    once = run_pipeline(raw, zones, RULES)
    for name, df in store_reports(store, zones).items():  # equal bits, not near values
        assert [tuple(r) for r in df.collect()] == [tuple(r) for r in getattr(once, name)], name
    rejects = {r.rule: r.n for r in store.rejects().groupBy("rule").agg(F.sum("rejected").alias("n")).collect()}
    assert rejects == {r.rule: r.rejected for r in reject_counts(raw, RULES).collect()} == once.rejected
    # back again, and once more in a compacted store
    store.correct(months["m2-corrected"], months["m2"])
    assert rows(store.merged()) == rows(fresh(spark, [months[m] for m in ("m1", "m2", "m3")]))
    store.compact("year")
    assert store.counts() == before and len(store.entries()) == 1
    store.correct(months["m2"], months["m2-corrected"])
    assert rows(store.merged()) == rows(fresh(spark, now))
    with pytest.raises(KeyError):
        store.correct(months["m2"], months["m1"])
    with pytest.raises(OverlapError):
        store.correct(months["m1"], months["m3"])


def test_a_file_that_has_changed_is_not_taken_back(spark, months, scratch):
    path = scratch + "/in"
    read_trips(spark, months["m1"]).coalesce(1).write.parquet(path)
    (file,) = list_files(spark, path)
    store = PartialsStore(spark, scratch + "/s")
    load(store, [file, months["m2"]], "two")
    local = file.removeprefix("file:")
    os.utime(local, (1, 1))
    with pytest.raises(ChangedInputError, match="write the whole batch again"):
        store.correct(file, months["m3"])
    assert len(store.entries()) == 1
    load(store, [file, months["m2"]], "two")
    assert rows(store.merged()) == rows(fresh(spark, [file, months["m2"]]))


def test_values_without_an_inverse_are_refused(spark, scratch):
    path = scratch + "/in"
    trips = trap_trips(spark).where("case_name = 'valid'").select(*S.TRIPS.fieldNames())
    trips.withColumn(S.TIP, F.lit(NAN)).coalesce(1).write.parquet(path)
    (file,) = list_files(spark, path)
    trips.coalesce(1).write.parquet(path + "2")
    store = PartialsStore(spark, scratch + "/s")
    load(store, [file], "nan")
    with pytest.raises(Exception, match="cannot be taken back"):
        store.correct(file, list_files(spark, path + "2")[0])
    assert len(store.entries()) == 1


def test_analyze_and_ingest_share_a_store(spark, months, scratch):
    src, path = os.path.dirname(months["m1"].removeprefix("file:")), scratch + "/s"
    store = PartialsStore(spark, path)
    INC.start(spark, src, path, RULES).awaitTermination()
    ((entry),) = store.entries()
    assert [i[0] for i in entry.inputs] == [months["m1"]] and entry.inputs[0][1] > 0
    with pytest.raises(OverlapError, match="ingest-0"):
        load(store, [months["m1"], months["m2"]], "both")
    load(store, [months["m1"], months["m2"]], "both", on_overlap="replace")
    assert [e.batch for e in store.entries()] == ["both"]
    other = scratch + "/s2"
    load(PartialsStore(spark, other), [months["m1"]], "jan")
    with pytest.raises(Exception, match="already holds"):
        INC.start(spark, src, other, RULES).awaitTermination()
    assert held(PartialsStore(spark, other)) == fresh(spark, [months["m1"]]).agg(F.sum("trips")).first()[0]


def test_the_second_of_two_writers_looks_again(spark, months, scratch, monkeypatch):
    store = PartialsStore(spark, scratch + "/s")
    late, put = PartialsStore(spark, scratch + "/s"), PartialsStore._put
    entered = []

    def meanwhile(self, rows_, batch):
        out = put(self, rows_, batch)
        if self is late and not entered:
            entered.append(load(store, [months["m1"]], "first"))
        return out

    monkeypatch.setattr(PartialsStore, "_put", meanwhile)
    with pytest.raises(OverlapError, match="'first'"):  # the files were free when it began
        load(late, [months["m1"], months["m2"]], "second")
    assert [e.batch for e in store.entries()] == ["first"]
    # without a conflict both get in, whoever is first
    entered.clear()
    load(late, [months["m3"]], "third")
    assert sorted(e.batch for e in store.entries()) == ["first", "third"]


def test_a_commit_number_is_given_once(spark, scratch):
    log = Log(spark, scratch + "/_log")
    first = log.commit(State(), [Entry("a", "x")], [])
    assert first.version == 1 and log.commit(State(), [Entry("b", "y")], []) is None
    assert [e.id for e in log.state().entries] == ["a"]
    assert H.names(spark, scratch + "/_log") == ["00000000000000000001.json"]  # nothing half written


def test_a_long_log_is_read_from_its_last_full_state(spark, scratch, monkeypatch):
    log, state = Log(spark, scratch + "/_log"), State()
    for i in range(2 * FULL + 3):
        state = log.commit(state, [Entry(str(i), f"b{i}", [[f"f{i}", None, None]], counts={"0": i})], [str(i - 2)])
    reads = []
    read = H.read_text
    monkeypatch.setattr(H, "read_text", lambda spark, path: reads.append(path) or read(spark, path))
    assert log.state() == state and len(reads) == 4
    assert [e.id for e in state.entries] == [str(2 * FULL + 1), str(2 * FULL + 2)]


def test_how_a_batch_fits_in():
    a = Entry("1", "a", [["f1", 1, 1], ["f2", 1, 1]])
    b = Entry("2", "b", [["f3", 1, 1]])
    gone = Entry("3", "a", of="1", taken_back=["f2"])
    state = State(3, (a, b, gone))
    assert set(state.inputs(a)) == {"f1"}
    assert plan_change(state, "c", ["f2", "f9"]).removes == frozenset()
    assert plan_change(state, "a", []).removes == {"1", "3"}
    change = plan_change(state, "c", ["f1", "f3"], "replace")
    assert change.removes == {"1", "2", "3"} and not change.takes_back
    part = plan_change(State(1, (a,)), "c", ["f1"], "replace")
    assert not part.removes and part.takes_back == ((a, ("f1",)),)
    with pytest.raises(OverlapError):
        plan_change(state, "c", ["f1"])
    with pytest.raises(ValueError):
        plan_change(state, "c", [], "perhaps")


def test_a_write_that_fails_leaves_the_store_as_it_was(spark, months, scratch):
    store = PartialsStore(spark, scratch + "/s")
    load(store, [months["m1"]], "jan")
    bad = read_trips(spark, months["m1"]).withColumn(S.FARE, F.expr("CAST(raise_error('lost') AS double)"))
    with pytest.raises(Exception, match="lost"):
        store.load(bad, RULES, "jan")
    assert rows(store.merged()) == rows(fresh(spark, [months["m1"]]))
    load(store, [months["m1"]], "jan")  # again: the first rows are needed no more
    assert store.vacuum(days=1) == []  # but a reader or writer may still be at work
    gone = store.vacuum(days=-1)
    assert gone and all("batch=jan" in path for path in gone) and rows(store.merged()) == rows(fresh(spark, [months["m1"]]))
    assert store.vacuum(days=-1) == []


def test_edges(spark, months, scratch):
    store = PartialsStore(spark, scratch + "/s")
    assert store.read().count() == 0 and store.merged().count() == 0 and store.counts() == (0, 0) and store.rejects().count() == 0
    nothing = Rule("nothing", "(false)")
    entry = store.load(read_trips(spark, months["m1"]), [nothing], "none")  # every trip rejected
    assert entry.clean_trips == 0 < entry.raw_trips and store.read().count() == 0
    assert store.rejects().first()["rejected"] == entry.raw_trips
    empty = read_trips(spark, months["m1"]).where("false")
    assert store.load(empty, RULES, "empty", inputs=["nothing"]).raw_trips == 0
    with pytest.raises(ValueError, match="batch name"):
        load(store, [months["m2"]], "a/b")
    store.remove("none")
    store.remove("never there")
    assert [e.batch for e in store.entries()] == ["empty"]
    early = partial_aggregate(Q.clean_trips(read_trips(spark, months["m1"]), RULES))
    store.write(early, "plain", inputs=[months["m1"]])
    with pytest.raises(OverlapError):
        load(store, [months["m1"]], "jan")
    with pytest.raises(ChangedInputError, match="without its rules"):
        store.correct(months["m1"], months["m2"])
    assert {r[S.PERIOD] for r in store.periods("2024-01-02", "2024-01-04").collect()} <= {dt.date(2024, 1, 2), dt.date(2024, 1, 3)}
