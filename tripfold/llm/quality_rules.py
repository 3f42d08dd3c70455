"""Host-level quality rules (operator 4), DataFrame functions only.

Each document gets its statistics and rule failures. Failures are summed by
host (``source``), the failure rate of each rule is shrunk with a beta prior
fitted to all hosts (method of moments), and a host whose shrunk rate of some
rule is above ``max_rate`` is rejected with all its documents.

The statistics are computed once and stored in the shared folder as narrow
rows; a hot host collapses in the map-side partial aggregate, and the host
verdicts go back to the documents by a salted join, so no host's rows meet in
one task. Windows that repeat inside a text are found by sorting (hash,
position) inside the row, and only in texts that have any.

Defined cases: null or empty text has no words and fails ``short``. A null
host is a host of its own. Repeated rows are judged, and counted for their
host, one by one. An empty table gives an empty result. Other columns of a
document are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm.shared import salted_join, stored

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Host rules besides the base rule: symbols per 100 word characters, repeated lines per 100 lines.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
#: A host is rejected if a rule's shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
RULES = ("short", "repeats", "symbols", "dup_lines")
SALTS = 16
_SPACE = r"[\x20\x09-\x0D]+"


def words(text: str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column; empty parts stand only before the first and after the last."""
    return F.array_remove(F.split(text, _SPACE), "")


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of whole texts."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    split = base.select("doc_id", "host", "text", words("text").alias("words"))
    hashed = split.select(
        "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.expr("filter(split(text, '\\n'), x -> x rlike '[^ \\\\t-\\\\r]')").alias("lines"),
        F.expr("transform(words, w -> xxhash64(w))").alias("h"),
    )
    near = ", ".join(f"h[i + {j}]" for j in range(WINDOW))
    grams = hashed.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"CASE WHEN n_words < {WINDOW} THEN array() ELSE transform(sequence(0, size(h) - {WINDOW}), i -> xxhash64({near})) END").alias("grams"),
    )
    # positions of windows found twice or more, ascending; each covers the words up to the next one, 5 at most
    ranked = grams.withColumn("s", F.expr("CASE WHEN size(array_distinct(grams)) = size(grams) THEN NULL ELSE array_sort(transform(grams, (g, i) -> struct(g AS g, i AS i))) END"))
    found = ranked.withColumn("p", F.expr("array_sort(transform(filter(transform(s, (x, r) -> struct(x.i AS i, (r > 0 AND s[r - 1].g = x.g) OR (r + 1 < size(s) AND s[r + 1].g = x.g) AS again)), y -> y.again), y -> y.i))"))
    return found.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.expr(f"coalesce(aggregate(transform(p, (x, r) -> CASE WHEN r + 1 < size(p) THEN least({WINDOW}, p[r + 1] - x) ELSE {WINDOW} END), 0L, (n, x) -> n + x), 0L)").alias("n_repeat_words"),
    )


def failures(stats: DataFrame) -> DataFrame:
    """``stats`` with a boolean for each rule of ``RULES``."""
    return stats.withColumns({
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
    })


def host_verdicts(failed: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, for each rule its shrunk failure rate, the highest of them, and ``host_ok``."""
    hosts = failed.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    # beta prior by moments: mean m and variance v of the hosts' rates (two numbers a rule); strength = m (1 - m) / v - 1, between 1 and 1e6
    moments = hosts.agg(*[f(F.col(r) / F.col("n_docs")).alias(f"{r}_{n}") for r in RULES for n, f in (("m", F.avg), ("v", F.var_pop))]).first()
    rates = {}
    for r in RULES:
        m, v = moments[f"{r}_m"] or 0.0, moments[f"{r}_v"] or 0.0
        strength = max(1.0, min(1e6, m * (1 - m) / v - 1)) if v > 0 else 1e6
        rates[f"{r}_rate"] = (F.col(r) + F.lit(strength * m)) / (F.col("n_docs") + F.lit(strength))
    out = hosts.select("host", "n_docs", *[c.alias(n) for n, c in rates.items()])
    out = out.withColumn("host_rate", F.greatest(*[F.col(n) for n in rates]))
    return out.withColumn("host_ok", F.col("host_rate") <= max_rate)


def judged(docs: DataFrame, max_rate: float = MAX_HOST_RATE, **columns: str) -> DataFrame:
    """Statistics, rules, base verdict, the host's highest rate, its verdict and ``kept`` of every document."""
    stats = failures(stored(statistics(docs, **columns), "quality-stats"))
    hosts = host_verdicts(stats, max_rate).select(F.coalesce(F.col("host"), F.lit("")).alias("key"), F.col("host").isNull().alias("none"), "host_rate", "host_ok")
    hosts = hosts.select(F.struct("none", "key").alias("key"), "host_rate", "host_ok")
    keyed = stats.withColumn("key", F.struct(F.col("host").isNull().alias("none"), F.coalesce(F.col("host"), F.lit("")).alias("key")))
    base = (F.col("n_words") < MIN_WORDS) | F.col("repeats")
    return salted_join(keyed, hosts, "key", SALTS).withColumn("base_failed", base).withColumn("kept", ~base & F.col("host_ok")).drop("key")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("host_rate", 6).alias("host_rate"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT r, p, array_to_string(w[p : p + {WINDOW - 1}], ' ') AS g FROM (SELECT r, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS p FROM d WHERE len(w) >= {WINDOW})),
rep AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(generate_series(p, p + {WINDOW - 1})) AS q FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1) GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
s AS (SELECT r, doc_id, host, len(w) AS n_words, length(array_to_string(w, '')) AS wc, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
      FROM d LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
f AS (SELECT *, coalesce(wc, 0) AS word_chars, n_words < {MIN_WORDS} AS f1, 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS f2,
      100 * n_symbols > {MAX_SYMBOL_PERCENT} * coalesce(wc, 0) AS f3, 100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines AS f4 FROM s),
rules AS (SELECT r, host, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS failed FROM f),
h AS (SELECT host, rule, count(*) AS n, count(*) FILTER (failed) AS x FROM rules GROUP BY ALL),
m AS (SELECT rule, avg(x / n) AS m, var_pop(x / n) AS v FROM h GROUP BY rule),
st AS (SELECT rule, m, CASE WHEN v > 0 THEN greatest(1.0, least(1e6, m * (1 - m) / v - 1)) ELSE 1e6 END AS st FROM m),
ok AS (SELECT host, max((x + st * m) / (n + st)) AS host_rate FROM h JOIN st USING (rule) GROUP BY host)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       f1 OR f2 AS base_failed, NOT (f1 OR f2) AND host_rate <= {MAX_HOST_RATE} AS kept, round(host_rate, 6) AS host_rate
FROM f JOIN ok ON f.host IS NOT DISTINCT FROM ok.host
"""
