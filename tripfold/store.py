"""The partials store: batches of trips as partial aggregates, with a commit log.

Layout::

    <store>/_log/00000000000000000003.json            one commit
    <store>/batch=<name>/commit=<id>/period=<date>/   rows that a commit added

A batch is a set of trips: one run of the analysis, one period, or one
micro-batch of the ingest.  A commit names the batch, its input files (path,
length, time of change), the rules it was cleaned by, and its trips by
combination of broken rules.  Rows are written first, to a folder of their own;
the commit is one small file whose number must be free, so a batch is in the
store whole or not at all, readers see one state of it, and of two writers that
start from the same state the second one looks at the conflict again.

**The same trips don't get in twice.**  A new batch replaces the batch of its
name.  If it shares input files with another batch, it is refused
(``OverlapError``), or with ``on_overlap="replace"`` takes their place: a batch
whose files are all among the new ones goes; of another batch the shared files
are taken back, by partials of these files with the sign turned.

**A corrected file** is exchanged by ``correct``: the old file is taken back and
the new one added in one commit; the other files of its batch aren't read again.
Files that are taken back must still be what was read (length and time of
change); otherwise write the batch again.

Every ``FULL``-th commit holds the whole state, so a reader takes at most
``FULL`` files.  Folders that no state needs stay until ``vacuum``.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold import hadoop as H
from tripfold import schema as S
from tripfold.functions import derive as D
from tripfold.functions.exact import EXACT_SUM
from tripfold.functions.rules import Rule
from tripfold.operators.partials import BROKEN, MEASURES, PARTIAL_KEYS, counted, merge, negated, rejected_by_rule
from tripfold.sources.files import read_trips

BATCH, COMMIT = "batch", "commit"
PARTIALS_SCHEMA = T.StructType([
    T.StructField(S.HOUR, T.IntegerType(), True),
    T.StructField(S.LOCATION, T.IntegerType(), True),
    T.StructField(S.PAYMENT, T.LongType(), True),
    T.StructField("trips", T.LongType(), False),
    T.StructField("sum_distance", EXACT_SUM, True),
    T.StructField("sum_fare", EXACT_SUM, True),
    T.StructField("sum_tip_pct", EXACT_SUM, True),
    T.StructField("n_tip_pct", T.LongType(), False),
    T.StructField("sum_total", EXACT_SUM, True),
    T.StructField(S.PERIOD, T.DateType(), True),
])
STORE_SCHEMA = T.StructType([*PARTIALS_SCHEMA.fields, T.StructField(BATCH, T.StringType(), True)])
_ROWS = T.StructType([T.StructField(BROKEN, T.LongType(), True), *PARTIALS_SCHEMA.fields,
                      T.StructField(BATCH, T.StringType(), True), T.StructField(COMMIT, T.StringType(), True)])

#: A stream's column with the file of each row: struct(path, bytes, modified).
INPUT = "_input"
#: Every so many commits hold the whole state.
FULL = 32

Reader = Callable[[SparkSession, list[str]], DataFrame]


class OverlapError(ValueError):
    """The new batch has input files that the store already holds."""


class ChangedInputError(ValueError):
    """A file that should be taken back is gone, or no longer what was read."""


@dataclass(frozen=True)
class Entry:
    """Rows in the store: a batch, or (``of``) files of a batch taken back."""

    id: str
    batch: str
    inputs: list[list] = field(default_factory=list)  # path, bytes, modified
    rules: list[list[str]] = field(default_factory=list)  # name, SQL
    period: str | None = None
    counts: dict[str, int] = field(default_factory=dict)  # combination of broken rules → trips
    of: str | None = None
    taken_back: list[str] = field(default_factory=list)

    @property
    def raw_trips(self) -> int:
        return sum(self.counts.values())

    @property
    def clean_trips(self) -> int:
        return self.counts.get("0", 0)


@dataclass(frozen=True)
class State:
    version: int = 0
    entries: tuple[Entry, ...] = ()

    def parts(self, batch: str) -> list[Entry]:
        """A batch's rows and what was taken back of them."""
        return [e for e in self.entries if e.batch == batch]

    def inputs(self, entry: Entry) -> dict[str, H.FileInfo]:
        """The files of a batch that still count."""
        gone = {p for e in self.entries if e.of == entry.id for p in e.taken_back}
        return {i[0]: H.FileInfo(*i) for i in entry.inputs if i[0] not in gone}


@dataclass(frozen=True)
class Change:
    """What a commit does besides adding its rows."""

    removes: frozenset[str]
    takes_back: tuple[tuple[Entry, tuple[str, ...]], ...]


def plan_change(state: State, batch: str, inputs: Iterable[str], on_overlap: str = "refuse") -> Change:
    """How a batch with these input files fits into the store."""
    if on_overlap not in ("refuse", "replace"):
        raise ValueError(f"on_overlap is 'refuse' or 'replace', not {on_overlap!r}")
    new = set(inputs)
    removes = {e.id for e in state.parts(batch)}
    back = []
    for entry in state.entries:
        if entry.of is not None or entry.batch == batch:
            continue
        held = set(state.inputs(entry))
        shared = held & new
        if not shared:
            continue
        if on_overlap == "refuse":
            raise OverlapError(f"batch {entry.batch!r} already holds {len(shared)} of the input files of {batch!r}, "
                               f"e.g. {min(shared)}")
        if shared == held:
            removes |= {entry.id} | {e.id for e in state.entries if e.of == entry.id}
        else:
            back.append((entry, tuple(sorted(shared))))
    return Change(frozenset(removes), tuple(back))


class Log:
    """Numbered commits; the state is what they add up to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:020d}.json"

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in H.names(self.spark, self.path) if re.fullmatch(r"\d{20}\.json", n)]

    def state(self) -> State:
        found = self.versions()
        if not found:
            return State()
        first = max([v for v in found if v % FULL == 0], default=0)
        entries: dict[str, Entry] = {}
        for version in [v for v in found if v >= first]:
            commit = json.loads(H.read_text(self.spark, self._file(version)))
            if "state" in commit:
                entries = {e["id"]: Entry(**e) for e in commit["state"]}
                continue
            for gone in commit["removes"]:
                entries.pop(gone, None)
            entries.update((e["id"], Entry(**e)) for e in commit["adds"])
        return State(found[-1], tuple(entries.values()))

    def commit(self, state: State, adds: Sequence[Entry], removes: Iterable[str]) -> State | None:
        """The state after a commit on ``state``; ``None`` if another commit came first."""
        gone = set(removes)
        entries = (*[e for e in state.entries if e.id not in gone], *adds)
        version = state.version + 1
        body = {"version": version, "at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"),
                "adds": [asdict(e) for e in adds], "removes": sorted(gone)}
        if version % FULL == 0:
            body["state"] = [asdict(e) for e in entries]
        H.make_folder(self.spark, self.path)
        return State(version, entries) if H.create_text(self.spark, self._file(version), json.dumps(body)) else None


def input_files(spark: SparkSession, inputs: Iterable[str | H.FileInfo]) -> list[H.FileInfo]:
    """Names of inputs with what they are now.  A name that is no file stands for itself."""
    out = []
    for i in inputs:
        if isinstance(i, str):
            found = H.info(spark, i) if "/" in i else None
            i = found or H.FileInfo(i)
        out.append(i)
    return out


class PartialsStore:
    """Partial aggregates by batch and period, with a commit log (see the module)."""

    def __init__(self, spark: SparkSession, path: str, read: Reader = read_trips):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = Log(spark, f"{self.path}/_log")
        self._read_trips = read

    # ------------------------------------------------------------ writing
    def _put(self, rows: DataFrame, batch: str) -> tuple[str, dict[str, int]]:
        """Write rows to a folder of their own; its id, and trips by combination of broken rules."""
        commit = uuid.uuid4().hex
        cols = [BROKEN, *PARTIALS_SCHEMA.fieldNames()]
        # One task – and so one file – per period: partials per period are
        # key-bounded (hours × places × payment codes).
        (rows.select(*cols).repartition(S.PERIOD).write.partitionBy(S.PERIOD)
         .parquet(self._folder(batch, commit)))
        counts = self._rows([(batch, commit)]).groupBy(BROKEN).agg(F.sum("trips").alias("trips")).collect()
        return commit, {str(r[BROKEN]): r["trips"] for r in counts}

    def _take_back(self, entry: Entry, paths: Sequence[str], state: State) -> Entry:
        """Rows that take files of a batch back, written but not committed."""
        for path, then in ((p, state.inputs(entry)[p]) for p in paths):
            now = H.info(self.spark, path) if then.bytes is not None else None
            if now is None or (now.bytes, now.modified) != (then.bytes, then.modified):
                raise ChangedInputError(f"{path} of batch {entry.batch!r} is not the file that was read; "
                                        "write the whole batch again")
        if entry.period is None or not entry.rules:
            raise ChangedInputError(f"batch {entry.batch!r} was stored without its rules; write it again")
        rules = [Rule(*r) for r in entry.rules]
        rows = negated(counted(self._read_trips(self.spark, list(paths)), rules, period=entry.period))
        commit, counts = self._put(rows, entry.batch)
        return Entry(commit, entry.batch, rules=entry.rules, period=entry.period, counts=counts, of=entry.id,
                     taken_back=list(paths))

    def _commit(self, entry: Entry, on_overlap: str) -> Entry:
        taken: dict[tuple[str, tuple[str, ...]], Entry] = {}
        while True:
            state = self.log.state()
            change = plan_change(state, entry.batch, [i[0] for i in entry.inputs], on_overlap)
            for old, paths in change.takes_back:
                if (old.id, paths) not in taken:
                    taken[old.id, paths] = self._take_back(old, paths, state)
            adds = [entry, *[taken[old.id, paths] for old, paths in change.takes_back]]
            if self.log.commit(state, adds, change.removes):
                return entry

    @staticmethod
    def _checked(batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"a batch name has letters, digits, '.', '_' and '-' only: {batch!r}")
        return batch

    def write(self, partials: DataFrame, batch: str, inputs: Iterable[str | H.FileInfo] = (),
              on_overlap: str = "refuse") -> Entry:
        """Store finished partials as a batch.  Its files can't be taken back singly (no rules are known)."""
        named = input_files(self.spark, inputs)
        plan_change(self.log.state(), self._checked(batch), [i.path for i in named], on_overlap)
        commit, counts = self._put(partials.withColumn(BROKEN, F.lit(0).cast("bigint")), batch)
        return self._commit(Entry(commit, batch, [list(i) for i in named], counts=counts), on_overlap)

    def load(self, trips: DataFrame, rules: Sequence[Rule], batch: str, inputs: Iterable[str | H.FileInfo] | None = None,
             period: str = D.PERIOD_MONTH_SQL, on_overlap: str = "refuse") -> Entry:
        """Clean, count and store trips as a batch, in one scan of them.

        ``inputs`` are the files (or other names) of the trips; by default the
        files that the DataFrame reads, or those in its ``_input`` column.
        Pass names of your own where batches are different rows of one file.
        """
        self._checked(batch)
        seen = None
        if inputs is None and INPUT in trips.columns:
            # a set holds no more when a task is retried
            seen = Observation()
            trips = trips.observe(seen, F.collect_set(INPUT).alias("files")).drop(INPUT)
        if inputs is None:
            inputs = [] if seen else [H.from_uri(self.spark, f) for f in trips.inputFiles()]
        named = input_files(self.spark, inputs)
        # refused before the scan, if it can be known; looked at again by the commit
        plan_change(self.log.state(), batch, [i.path for i in named], on_overlap)
        commit, counts = self._put(counted(trips, rules, period=period), batch)
        if seen:
            named = [H.FileInfo(H.from_uri(self.spark, f["path"]), f["bytes"], f["modified"]) for f in seen.get["files"]]
        entry = Entry(commit, batch, [list(i) for i in sorted(named)], [[r.name, r.sql] for r in rules], period, counts)
        return self._commit(entry, on_overlap)

    def correct(self, old: str, new: str) -> Entry:
        """Exchange one input file for its corrected form, by the rules of its batch; other files aren't read."""
        was, now = H.qualified(self.spark, old), H.info(self.spark, new)
        if now is None:
            raise FileNotFoundError(new)
        added = None
        while True:
            state = self.log.state()
            holder = next((e for e in state.entries if e.of is None and was in state.inputs(e)), None)
            if holder is None:
                raise KeyError(f"no batch holds {was}")
            for e in state.entries:
                if e.of is None and now.path in state.inputs(e):
                    raise OverlapError(f"batch {e.batch!r} already holds {now.path}")
            back = self._take_back(holder, [was], state)
            if added is None or added.batch != holder.batch or added.rules != holder.rules:
                rules = [Rule(*r) for r in holder.rules]
                commit, counts = self._put(counted(self._read_trips(self.spark, [now.path]), rules, period=holder.period), holder.batch)
                added = Entry(commit, holder.batch, [list(now)], holder.rules, holder.period, counts)
            if self.log.commit(state, [added, back], ()):
                return added

    def remove(self, batch: str) -> None:
        """Take a whole batch out of the store."""
        while True:
            state = self.log.state()
            gone = [e.id for e in state.parts(batch)]
            if not gone or self.log.commit(state, [], gone):
                return

    # ------------------------------------------------------------ reading
    def _folder(self, batch: str, commit: str) -> str:
        return f"{self.path}/{BATCH}={batch}/{COMMIT}={commit}"

    def _rows(self, parts: Sequence[tuple[str, str]]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], _ROWS)
        reader = self.spark.read.schema(_ROWS).option("basePath", self.path)
        return reader.parquet(*[self._folder(*p) for p in parts])

    def entries(self, batch: str | None = None) -> list[Entry]:
        state = self.log.state()
        return list(state.entries if batch is None else state.parts(batch))

    def read(self, batch: str | None = None) -> DataFrame:
        """Partials of all batches (or one); where files were taken back, already set off against each other."""
        entries = self.entries(batch)
        rows = self._rows([(e.batch, e.id) for e in entries]).where(f"{BROKEN} = 0").select(*STORE_SCHEMA.fieldNames())
        if any(e.of for e in entries):
            rows = merge(rows, [*PARTIAL_KEYS, BATCH]).where("trips <> 0").select(*STORE_SCHEMA.fieldNames())
        return rows

    def periods(self, start: str, end: str) -> DataFrame:
        """Partials for ``start <= period < end`` (partition-pruned)."""
        p = F.col(S.PERIOD)
        return self.read().filter((p >= F.lit(start).cast("date")) & (p < F.lit(end).cast("date")))

    def merged(self) -> DataFrame:
        """One row per full key, summed over all batches."""
        return merge(self.read(), PARTIAL_KEYS)

    def counts(self, batch: str | None = None) -> tuple[int, int]:
        """Raw and clean trips."""
        entries = self.entries(batch)
        return sum(e.raw_trips for e in entries), sum(e.clean_trips for e in entries)

    def rejects(self) -> DataFrame:
        """Rejected trips by rule and batch."""
        rows = []
        for e in self.entries():
            found = rejected_by_rule({int(k): n for k, n in e.counts.items()}, [name for name, _ in e.rules])
            rows += [(*r, e.batch) for r in found]
        return self.spark.createDataFrame(rows, f"rule_order int, rule string, rejected bigint, {BATCH} string")

    # ------------------------------------------------------------ upkeep
    def compact(self, batch: str) -> None:
        """Write a batch's rows anew as one folder, with what was taken back set off."""
        while True:
            state = self.log.state()
            parts = state.parts(batch)
            own = [e for e in parts if e.of is None]
            if len(parts) < 2 or len({(json.dumps(e.rules), e.period) for e in own}) > 1:
                return  # one folder already, or rows by different rules
            rows = merge(self._rows([(e.batch, e.id) for e in parts]), [BROKEN, *PARTIAL_KEYS]).where("trips <> 0")
            commit, counts = self._put(rows, batch)
            inputs = sorted(list(i) for e in own for i in state.inputs(e).values())
            if self.log.commit(state, [Entry(commit, batch, inputs, own[0].rules, own[0].period, counts)], [e.id for e in parts]):
                return

    def vacuum(self, days: float = 7.0) -> list[str]:
        """Delete folders that the store no longer needs and that are older than ``days`` (a writer may be about to commit)."""
        live = {(e.batch, e.id) for e in self.entries()}
        before = dt.datetime.now(dt.timezone.utc).timestamp() * 1000 - days * 86_400_000
        gone = []
        for folder in H.names(self.spark, self.path):
            batch = folder.removeprefix(f"{BATCH}=")
            if batch == folder:
                continue
            for name in H.names(self.spark, f"{self.path}/{folder}"):
                path = f"{self.path}/{folder}/{name}"
                if (batch, name.removeprefix(f"{COMMIT}=")) not in live and H.info(self.spark, path).modified <= before:
                    H.delete(self.spark, path)
                    gone.append(path)
        return gone
