"""Quality classifier: a sparse rule ensemble (operator 8).

Statistics of the whole text are Spark columns. Boosted shallow trees are
grown on a bounded sample of labelled rows, every path from a root to a node
becomes a conjunctive rule over the statistics, and logistic weights with a
lasso penalty are fitted to all rules. Rules that keep a weight are compiled
into one Spark column expression, so scoring is a projection without Python.

Only rows with ``crc32(doc_id as text) mod 5 <> 0`` are learned from; the
sample is the ``MAX_TRAIN`` labelled documents with the smallest hash of their
id. Labels, language, source and id are never inputs of a score.

Defined cases: null and empty text have all statistics 0 and are scored like
any other. A null id counts as empty text for the fold. Rows with the same id
are scored one by one; of several labels for an id the lowest holds, null
labels are ignored. Without labelled rows, or with one class only, the score
is the smoothed rate of label 1 for all. An empty table gives an empty result.
Other columns are carried in ``doc``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm.shared import named

MAX_TRAIN = 20_000
TREES = 24
DEPTH = 3
BINS = 32
RATE = 0.3
#: Smallest share of the sample that a rule must hold for, and must not hold for.
MIN_SHARE = 0.004
LASSO = 3e-4
STEPS = 400
THRESHOLD = 0.3
FEATURES = ("words", "word_length", "symbols", "capitals", "shouts", "bars", "echoes", "sentences", "digits")
_SPACE = r"[\x20\x09-\x0D]+"

Condition = tuple[str, str, float]


class Model(NamedTuple):
    bias: float
    rules: list[tuple[tuple[Condition, ...], float]]


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """doc and the columns ``FEATURES``: rates by word, so that long and short texts compare."""
    base = docs.select(F.struct(*[named(c) for c in keep]).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    split = base.withColumn("w", F.array_remove(F.split("text", _SPACE), ""))
    n = F.greatest(F.size("w"), F.lit(1)).cast("double")
    runs = lambda pattern: F.regexp_count("text", F.lit(pattern)) / n
    single = lambda s: (F.length("text") - F.length(F.replace("text", F.lit(s), F.lit("")))) / n
    return split.select(
        "doc",
        F.size("w").cast("double").alias("words"),
        (F.length(F.array_join("w", "")) / n).alias("word_length"),
        runs(r"[#*$%&<>~^=+_\\]+").alias("symbols"),
        runs(r"\p{Lu}{3,}").alias("capitals"),
        single("!").alias("shouts"),
        single("|").alias("bars"),
        F.expr("size(filter(w, (x, i) -> i > 0 AND x = w[i - 1]))").cast("double").alias("same"),
        single(".").alias("sentences"),
        runs("[0-9]+").alias("digits"),
        n.alias("n"),
    ).withColumn("echoes", F.col("same") / F.col("n")).drop("same", "n")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", text: str = "text", most: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``most`` labelled rows outside the held-out fold."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id))).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).alias("y"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")  # bounded by ``most``
    rows = statistics(texts, ["id", "y"]).select("doc.id", "doc.y", *FEATURES).orderBy(F.xxhash64("id"), "id", *FEATURES).limit(most).collect()
    x = np.array([[r[f] for f in FEATURES] for r in rows], float).reshape(len(rows), len(FEATURES))
    return x, np.array([float(r["y"] > 0) for r in rows])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def grow(x: np.ndarray, binned: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray) -> tuple[list[tuple[Condition, ...]], np.ndarray]:
    """Paths to all nodes of a tree for one boosting step, and the step for every row."""
    paths: list[tuple[Condition, ...]] = []
    step = np.zeros(len(x))

    def split(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        g, h = grad[rows], hess[rows]
        best = (1e-9, -1, -1)
        if len(path) < DEPTH:
            whole = g.sum() ** 2 / (h.sum() + 1)
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                gs = np.cumsum(np.bincount(binned[rows, f], g, len(cuts) + 1))[:-1]
                hs = np.cumsum(np.bincount(binned[rows, f], h, len(cuts) + 1))[:-1]
                ns = np.cumsum(np.bincount(binned[rows, f], minlength=len(cuts) + 1))[:-1]
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
                gain[(ns < MIN_SHARE * len(x)) | (len(rows) - ns < MIN_SHARE * len(x))] = 0
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), f, at)
        if best[1] < 0:
            step[rows] = g.sum() / (h.sum() + 1)
            return
        _, f, at = best
        low = binned[rows, f] <= at
        for part, op in ((rows[low], "<="), (rows[~low], ">")):
            to = (*path, (FEATURES[f], op, float(edges[f][at])))
            paths.append(to)
            split(part, to)

    split(np.arange(len(x)), ())
    return paths, step


def holds(path: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, op, value in path:
        column = x[:, FEATURES.index(name)]
        out &= column <= value if op == "<=" else column > value
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Model(float(np.log(rate / (1 - rate))), [])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    z = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    found: dict[bytes, tuple[Condition, ...]] = {}
    for _ in range(TREES):
        p = sigmoid(z)
        paths, step = grow(x, binned, edges, y - p, p * (1 - p))
        z += RATE * step
        for path in paths:
            found.setdefault(np.packbits(holds(path, x)).tobytes(), path)
    paths = list(found.values())
    if not paths:
        return Model(float(z[0]), [])
    r = np.stack([holds(p, x) for p in paths], axis=1).astype(float)
    mean, scale = r.mean(0), r.std(0)
    r, mean, scale = r[:, scale > 0], mean[scale > 0], scale[scale > 0]
    paths = [p for p, s in zip(paths, np.stack([holds(p, x) for p in paths], axis=1).std(0), strict=True) if s > 0]
    r = (r - mean) / scale
    # accelerated proximal gradient; the Lipschitz constant of the logistic loss is a quarter of the largest eigenvalue
    length = 0.25 * np.linalg.eigvalsh(r.T @ r / len(y))[-1] + 0.25
    w, b = np.zeros(r.shape[1]), float(np.log(y.mean() / (1 - y.mean())))
    v, c, t = w.copy(), b, 1.0
    for _ in range(STEPS):
        error = sigmoid(r @ v + c) - y
        to = v - (r.T @ error / len(y)) / length
        to = np.sign(to) * np.maximum(np.abs(to) - LASSO / length, 0)
        to_b = c - error.mean() / length
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = to + (t - 1) / u * (to - w), to_b + (t - 1) / u * (to_b - b)
        w, b, t = to, to_b, u
    weights = w / scale
    return Model(float(b - (weights * mean).sum()), [(p, float(k)) for p, k in zip(paths, weights, strict=True) if k])


def score_column(model: Model) -> Column:
    """The model as one expression over the columns ``FEATURES``."""
    total = F.lit(model.bias)
    for path, weight in model.rules:
        holds_all = F.lit(True)
        for name, op, value in path:
            holds_all = holds_all & (F.col(name) <= value if op == "<=" else F.col(name) > value)
        total = total + F.when(holds_all, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def trained(docs: DataFrame, labels: DataFrame, **columns) -> Model:
    return fit(*sample(docs, labels, **columns))


def scored(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """doc and score of every document."""
    return statistics(docs, keep, text).select("doc", score_column(model).alias("score"))


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more.

    A plain filter on the score would be pushed below the projections, with every statistic written out wherever a
    rule names it, and each text would be searched hundreds of times. A filter is not pushed below a projection that
    numbers its rows, so the score is computed once.
    """
    rows = scored(docs, model, docs.columns, text).withColumn("number", F.monotonically_increasing_id())
    return rows.where((F.col("score") >= threshold) & (F.col("number") >= 0)).select("doc.*")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
