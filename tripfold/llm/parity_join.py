"""N-gram Jaccard join by parity sketches (operator 2).

A document is its set of distinct 5-word shingles. Its parity sketch has
``parts(band)`` parts; every shingle flips one bit of one part. A shingle that
only one of two sets has changes one part, so the number of parts that differ
bounds the symmetric difference from below, and two sets that differ by ``d``
shingles agree on all but ``d`` parts. Sets with a Jaccard similarity of 3/4
differ by at most (|A| + |B|) / 7 shingles: whoever has more non-empty parts
than that shares a non-empty part (pigeonhole). A part is stored as the XOR of
random words of its set bits, and documents are joined on (band, part, XOR).

Bands of sizes [L, 4L) fix the number of parts; a document also takes part in
the next band if a larger partner may lie there. A key that more than ``HOT``
documents have (a passage, a licence line) is left out by documents that have
enough other keys: with all hot keys ordered last, the first common key of a
pair still lies among the other keys of both (prefix argument), so nothing is
lost. A document whose parts are too few by chance is compared with its whole
band (``weak``; the number of parts makes this practically absent).

Pairs that share keys are counted; a pair that agrees on too few parts is out.
Of the rest, one pair a document is verified on the shingles themselves, then
those that are still in different components: a pair inside a component needs
no check, so a group of any number of near copies costs its size, not its
square. Documents that share hot keys and little else are checked against their
key's hub (the one with the most common keys, so the source of a group of
copies), and against each other only across components, and only if enough of
their shingles occur elsewhere at all.

Equal sets are collapsed first by a 64-bit hash of the set; keys carry that
hash, so a text that a third of all documents repeat gives each batch one row
a key.

Defined cases: null or empty text, or text without words, has no shingles and
is a component of its own. Repeated rows and equal texts are linked. A null id
is never a component's id unless all its ids are null. Empty tables give empty
results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripfold.llm import arrays as A
from tripfold.llm.components import components
from tripfold.llm.shared import fresh, named, prepare, salted_join, stored

WORDS = 5
HOT = 32
#: Bits of the folded parity sketch that pairs of a hot key are held against.
BITS = 1024
#: Jaccard similarity as a fraction; 3/4.
NEAR = (3, 4)
#: Ids broadcast at most when texts of candidates are read again (16 MB).
MOST_IDS = 1_000_000
SALTS = 16
_FOLD = A.whitespace_words()
U = A.U


def shingles(part: A.Texts, k: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row; a row of fewer words has its whole sequence, a row without none."""
    w = A.words(part, _FOLD)
    by_size = {k: A.grams(w.hash, w.bounds, k)[0]}
    counts = np.diff(w.bounds)
    for n in range(1, k):
        if (counts == n).any():
            by_size[n] = A.grams(w.hash, w.bounds, n)[0]
    out = []
    for start, n in zip(w.bounds[:-1].tolist(), counts.tolist(), strict=True):
        if n >= k:
            out.append(np.unique(by_size[k][start : start + n - k + 1]))
        elif n:
            out.append(by_size[n][start : start + 1])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def most_apart(size: int, largest: int) -> int:
    """Shingles by which a set of ``size`` may differ from a near one of at most ``largest``."""
    near, whole = NEAR
    other = min(size * whole // near, largest)
    return (whole - near) * (size + other) // (whole + near)


def bands(size: int) -> list[int]:
    """Bands j of sizes [4**j, 4**(j+1)) that the set takes part in: its own, and the next if a larger partner may be there."""
    own = (size.bit_length() - 1) // 2
    return [own] + [own + 1] * (size * NEAR[1] // NEAR[0] >= 4 ** (own + 1))


def parts(band: int) -> int:
    """Parts of a band's sketch: many for small sets, else 1.2 for each shingle of the smallest set."""
    low = 4**band
    return 1 << 31 if low < 16 else int(1.22 * low) + 28


def keys(hashes: np.ndarray, band: int) -> np.ndarray:
    """Keys (52 bits, band in the low 4) of a set's non-empty parts. ``hashes`` is sorted, so parts are runs.

    Equal keys only make candidates, and 52 bits keep chance ones below the true ones at any size."""
    place = ((hashes >> U(33)) * U(parts(band))) >> U(31)
    first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
    word = np.bitwise_xor.reduceat(A.mix(hashes), first)
    return (A.mix(word + place[first] * U(0x9E3779B97F4A7C15) + U(band)) >> U(12) & ~U(15)) | U(band)


def identity(hashes: np.ndarray) -> int:
    """64-bit hash of the set."""
    return int(A.mix(np.array([A.mix(hashes).sum(dtype=np.uint64) + U(len(hashes))], np.uint64))[0]) if len(hashes) else 0


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64), pa.int64())


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row by row: id, code, size, set; for each band: non-empty parts, and how many of them are more than needed."""
    for batch in batches:
        size, sets, near = [], [], []
        for part in A.slices(batch.column("text")):
            for h in shingles(part):
                size.append(len(h))
                sets.append(identity(h))
                filled = [(b, len(keys(h, b))) for b in bands(len(h))] if len(h) else []
                near.append([{"band": b, "filled": c, "slack": c - most_apart(len(h), 4 ** (b + 1) - 1) - 1} for b, c in filled])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("code"), pa.array(size, pa.int64()), _long(np.array(sets, np.uint64)),
             pa.array(near, pa.list_(pa.struct([("band", pa.int32()), ("filled", pa.int32()), ("slack", pa.int32())])))], names=["id", "code", "n", "set", "near"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, set) of all non-empty parts; equal sets of a batch once."""
    for batch in batches:
        seen: set[int] = set()
        for part in A.slices(batch.column("text")):
            out, owner, times = [], [], []
            for h in shingles(part):
                if not len(h) or (own := identity(h)) in seen:
                    continue
                seen.add(own)
                for b in bands(len(h)):
                    out.append(keys(h, b))
                    owner.append(own)
                    times.append(len(out[-1]))
            if out:
                yield pa.RecordBatch.from_arrays([_long(np.concatenate(out)), _long(np.repeat(np.array(owner, np.uint64), times))], names=["key", "set"])


def _shingle_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """set, shingles, and the parity sketch folded to ``BITS`` bits: bit h mod BITS flips for every shingle."""
    for batch in batches:
        for part in A.slices(batch.column("text")):
            found = [h for h in shingles(part) if len(h)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(h) for h in found]))), pa.int32()), _long(np.concatenate(found) if found else np.zeros(0, np.uint64)))
            bits = [np.packbits((np.bincount((h & U(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)) for h in found]
            sketches = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * (BITS // 64), pa.int32()), _long(np.concatenate(bits).view(np.uint64) if bits else np.zeros(0, np.uint64)))
            yield pa.RecordBatch.from_arrays([_long(np.array([identity(h) for h in found], np.uint64)), lists, sketches], names=["set", "shingles", "sketch"])


def _near(inter: Column, a: Column, b: Column) -> Column:
    return inter * NEAR[1] >= (a + b - inter) * NEAR[0]


class Join:
    """The join over one table; tables that later steps share are stored in the shared folder."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> None:
        self.spark, self.hot = docs.sparkSession, hot
        prepare(self.spark)
        self.docs = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("code"), F.col(text).alias("text"))
        kind = self.docs.schema["id"].dataType.simpleString()
        self.facts = stored(self.docs.mapInArrow(_facts, f"id {kind}, code long, n long, set long, near array<struct<band:int,filled:int,slack:int>>"), "facts")
        filled = self.facts.where("n > 0")
        self.sets = stored(filled.groupBy("set").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("near").alias("near")), "sets")
        self.banded = self.sets.select("set", "n", F.explode("near").alias("x")).select("set", "n", "x.*")

    def members(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """key, set of every key that several sets have and that is not hot; key, set, rows of hot keys, only for sets
        that need them; and set, band, used: how many hot keys a set has."""
        rows = self.docs.select("text").mapInArrow(_keys, "key long, set long")
        of_key = Window.partitionBy("key")
        shared = rows.withColumns({"low": F.min("set").over(of_key), "high": F.max("set").over(of_key), "rows": F.count(F.lit(1)).over(of_key)}).where("low < high")
        shared = stored(shared.select("key", "set", F.col("rows").cast("int").alias("rows")).distinct(), "keys")
        hot = shared.where(F.col("rows") > self.hot).withColumn("band", F.col("key").bitwiseAND(15).cast("int"))
        used = stored(hot.groupBy("set", "band").agg(F.count(F.lit(1)).alias("used")), "hot-sets")
        needy = used.join(self.banded, ["set", "band"]).where("used > slack").select("set", "band")
        needed = stored(hot.join(needy, ["set", "band"], "left_semi").select("key", "set", "rows"), "hot-keys")
        return shared.where(F.col("rows") <= self.hot).select("key", "set"), needed, used

    def counted(self, members: DataFrame, used: DataFrame) -> DataFrame:
        """Pairs (a < b) of a key whose sketches agree on enough parts: differing parts never outnumber differing shingles."""
        a, b = members.alias("a"), members.alias("b")
        pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.set") < F.col("b.set")))
        pairs = pairs.groupBy(F.col("a.set").alias("a"), F.col("b.set").alias("b"), F.col("a.key").bitwiseAND(15).cast("int").alias("band")).agg(F.count(F.lit(1)).alias("same"))
        info = self.banded.join(used, ["set", "band"], "left").select("set", "band", "n", (F.col("filled") - F.coalesce("used", F.lit(0))).alias("seen"))
        side = lambda c: info.select(F.col("set").alias(c), "band", F.col("n").alias(f"{c}_n"), F.col("seen").alias(f"{c}_seen"))
        both = pairs.join(side("a"), ["a", "band"]).join(side("b"), ["b", "band"])
        near, whole = NEAR
        apart = (F.greatest("a_seen", "b_seen") - F.col("same")) * (whole + near) <= (F.col("a_n") + F.col("b_n")) * (whole - near)
        return both.where(apart).select("a", "b").distinct()

    def weak_pairs(self) -> DataFrame | None:
        """Pairs of sets whose parts are too few by chance with the sets of their band."""
        weak = self.banded.where("slack < 0")
        if weak.isEmpty():
            return None
        a, b = weak.alias("a"), self.banded.alias("b")
        size = (F.col("a.n") * NEAR[0] <= F.col("b.n") * NEAR[1]) & (F.col("b.n") * NEAR[0] <= F.col("a.n") * NEAR[1])
        pairs = a.join(b, (F.col("a.band") == F.col("b.band")) & size & (F.col("a.set") != F.col("b.set")))
        return pairs.select(F.least("a.set", "b.set").alias("a"), F.greatest("a.set", "b.set").alias("b")).distinct()

    def lists(self, sets: DataFrame) -> DataFrame:
        """set, shingles, sketch of the sets (column ``set``), read again from the texts, stored."""
        ids = stored(sets.distinct().join(self.sets.select("set", "id"), "set").select(F.col("id").alias("want")).distinct(), "wanted")
        wanted = F.broadcast(ids) if ids.count() <= MOST_IDS else ids
        again = self.docs.join(wanted, F.col("id").eqNullSafe(F.col("want")), "left_semi").select("text")
        return stored(again.mapInArrow(_shingle_lists, "set long, shingles array<long>, sketch array<long>").dropDuplicates(["set"]), "shingles")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b: sets) that are near by their shingles, stored."""
        size = lambda c: self.sets.select(F.col("set").alias(c), F.col("n").alias(f"{c}_n"))
        near, whole = NEAR
        left = pairs.join(size("b"), "b").join(size("a"), "a").where((F.col("a_n") * near <= F.col("b_n") * whole) & (F.col("b_n") * near <= F.col("a_n") * whole))
        left = stored(left, "pairs")
        lists = self.lists(left.select(F.col("a").alias("set")).unionAll(left.select("b")))
        both = left.join(lists.select(F.col("set").alias("b"), F.col("shingles").alias("b_list")), "b").join(lists.select(F.col("set").alias("a"), F.col("shingles").alias("a_list")), "a")
        inter = F.size(F.array_intersect("a_list", "b_list")).cast("long")
        return stored(both.where(_near(inter, F.col("a_n"), F.col("b_n"))).select("a", "b"), "links")

    def hubs(self, hot: DataFrame) -> DataFrame:
        """set, hub: for every hot key of a set the set of that key that has the most, and most frequent, hot keys.

        Near copies have edits of their own and share what their source has, so the source has the highest score."""
        score = hot.groupBy("set").agg(F.sum("rows").alias("score"))
        hub = hot.join(score, "set").groupBy("key").agg(F.max(F.struct("score", "set")).alias("x")).select("key", F.col("x.set").alias("hub"))
        return stored(hot.join(hub, "key").select("set", "hub").distinct(), "hubs")

    def across(self, hubs: DataFrame, label: DataFrame) -> DataFrame:
        """Pairs (a < b) that share a hot key, are in different components, and may be near.

        A set can only share with another one those of its shingles that some other set has. If it has ``common`` of
        them, a near partner needs ``common >= 3/7 (n + n')``, for either side; sets that fail this even with their
        group's smallest set are out. Only pairs are made that keep it and whose folded sketches differ in no more
        bits than near sets differ in shingles."""
        near, whole = NEAR
        lists = self.lists(hubs.select("set"))
        exploded = lists.select("set", F.explode("shingles").alias("shingle"))
        twice = exploded.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("shingle")
        common = exploded.join(twice, "shingle").groupBy("set").agg(F.count(F.lit(1)).alias("common"))
        facts = common.join(self.sets.select("set", "n"), "set").join(lists.select("set", "sketch"), "set").join(label, "set", "left").withColumn("label", F.coalesce("label", "set"))
        grouped = hubs.join(facts, "set")
        smallest = grouped.groupBy("hub").agg(F.min("n").alias("smallest"))
        able = grouped.join(smallest, "hub").where(F.col("common") * (near + whole) >= (F.col("n") + F.greatest("smallest", F.col("n") * near / whole)) * near)
        split = able.groupBy("hub").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("hub")
        able = stored(able.join(split, "hub", "left_semi").select("hub", "set", "n", "common", "sketch", "label"), "able")
        a, b = able.alias("a"), able.alias("b")
        hamming = F.expr(" + ".join(f"bit_count(a.sketch[{i}] ^ b.sketch[{i}])" for i in range(BITS // 64)))
        keeps = (hamming * (near + whole) <= (F.col("a.n") + F.col("b.n")) * (whole - near)) & (F.least("a.common", "b.common") * (near + whole) >= (F.col("a.n") + F.col("b.n")) * near)
        pairs = a.join(b, (F.col("a.hub") == F.col("b.hub")) & (F.col("a.set") < F.col("b.set")) & (F.col("a.label") != F.col("b.label")) & keeps)
        return pairs.select(F.col("a.set").alias("a"), F.col("b.set").alias("b")).distinct()

    def links(self) -> DataFrame:
        """Links (a, b) between sets that give the components of all links."""
        members, hot, used = self.members()
        pairs = self.counted(members, used)
        weak = self.weak_pairs()
        if weak is not None:
            pairs = pairs.unionAll(weak).distinct()
        pairs = stored(pairs, "candidates")
        first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        hubs = None if hot.isEmpty() else self.hubs(hot)
        if hubs is not None:
            first = first.unionAll(hubs.where("set <> hub").select(F.least("set", "hub").alias("a"), F.greatest("set", "hub").alias("b"))).distinct()
        first = stored(first, "first")
        links = self.verified(first)
        label = stored(components(links).select(F.col("node").alias("set"), "label"), "labels")
        mark = lambda c: label.select(F.col("set").alias(c), F.col("label").alias(f"{c}_label"))
        marked = pairs.join(first, ["a", "b"], "left_anti").join(mark("a"), "a", "left").join(mark("b"), "b", "left")
        rest = marked.where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")
        if hubs is not None:
            rest = rest.unionAll(self.across(hubs, label).join(first, ["a", "b"], "left_anti")).distinct()
        rest = stored(rest, "rest")
        return links if rest.isEmpty() else links.unionAll(self.verified(rest))

    def classes(self) -> DataFrame:
        """id, code (hash of the text), n_shingles, component_id, label (of the component; null without shingles) of every document."""
        label = components(self.links()).select(F.col("node").alias("set"), "label")
        named = self.sets.join(label, "set", "left").select("set", "id", F.coalesce("label", "set").alias("label"))
        least = named.groupBy("label").agg(F.min("id").alias("component_id"))
        by_set = named.join(least, "label").select("set", "component_id", "label")
        out = salted_join(self.facts.where("n > 0").select("id", "code", "n", "set"), by_set, "set", SALTS)
        alone = self.facts.where("n = 0").select("id", "code", "n", F.col("id").alias("component_id"), F.lit(None).cast("long").alias("label"))
        return out.select("id", "code", F.col("n").alias("n_shingles"), "component_id", "label").unionAll(alone)


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id stays (null ids
    last, then the smallest hash of the text; one of repeated rows). Documents without shingles stay."""
    found = stored(Join(docs, doc_id, text).classes().where("n_shingles > 0"), "classes")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "code")
    lead = found.groupBy("label").agg(F.min(place).alias("lead"))
    beside = salted_join(found.withColumn("place", place), lead, "label", SALTS).where("NOT place <=> lead").select("id", "code").distinct()
    again = found.groupBy("id", "code").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("id", "code")
    row, code = fresh(docs, "row", "code")
    rows = docs.select(F.struct(*[named(c) for c in docs.columns]).alias(row), F.xxhash64(text).alias(code))

    def without(left: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        side = ids.select(F.col("id").alias("_id"), F.col("code").alias("_code"))
        side = stored(side, "ids")
        side = F.broadcast(side) if side.count() <= MOST_IDS else side
        return left.join(side, F.col(f"{row}.{doc_id}").eqNullSafe(F.col("_id")) & (F.col(code) == F.col("_code")), how)

    kept = without(rows, beside, "left_anti")
    if not again.isEmpty():
        once = without(kept, again, "left_semi").withColumn("_key", F.col(f"{row}.{doc_id}")).dropDuplicates(["_key", code]).drop("_key")
        kept = without(kept, again, "left_anti").unionAll(once)
    return kept.select(f"{row}.*")


def digest(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[p : p + 4], ' ') AS g FROM (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
i AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach(r, t) AS (SELECT r, r FROM d UNION SELECT reach.r, l.b FROM reach JOIN l ON l.a = reach.t)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (r) JOIN (SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.r = reach.t GROUP BY reach.r) m ON m.r = d.r
"""
