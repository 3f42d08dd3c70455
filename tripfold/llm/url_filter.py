"""URL filter: host word segmentation and naive Bayes (operator 1).

Rules of an allow/block list decide first: a rule fits its host and all
subdomains if the path starts with the rule's path; the longest rule wins.
Every other url is judged by its words.

1. Unigram counts come from the visible words of all pages (pre-aggregated in
   each batch), plus the seed words.
2. Every distinct part of a host or path (runs of letters) is cut into words by
   Viterbi search over the unigram model. The model is not broadcast: the
   part's substrings are joined to the counts, so it may grow with the corpus.
3. Multinomial naive Bayes over the words of distinct hosts and of distinct paths
   (each a document of its own kind, so a path says nothing about its host's other
   paths). It starts from seed words, scores every host and path, and is fitted
   again with the words of all of them, weighted by the first score (one step of
   semi-supervised EM); one without a seed word counts for both classes in the
   proportion of those that have evidence, so its own words tell nothing. Both
   classes are smoothed with the pooled word shares. No word is left out for being
   frequent: one that stands in both classes alike has log odds near 0.
4. A url's score is the sum of its words' log odds; above ``THRESHOLD`` it is
   blocked.

Joins on words or parts, where a few keys have most rows, are salted.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule, and is allowed. Parts without letters have no words. Repeated rows are
judged alike. With an empty table the result is empty. Other columns are not
read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm.shared import ascii_lower, prepare, salted_join, stored

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

# Words that the two classes start from, by category.
BLOCK_SEEDS = (
    "spam", "junk", "scam", "clickbait", "ads", "adserver", "banner", "popup", "track", "tracker", "tracking", "click", "affiliate",
    "casino", "poker", "slots", "roulette", "jackpot", "lottery", "bet", "bets", "betting", "gambling",
    "adult", "xxx", "porn", "sex", "nude", "escort", "cams", "pills", "pharmacy", "viagra", "cialis", "payday", "loans", "giveaway",
    "replica", "fake", "hack", "crack", "keygen", "warez", "torrent", "malware", "phishing", "backlinks", "followers",
)
ALLOW_SEEDS = (
    "news", "blog", "wiki", "docs", "library", "university", "school", "science", "research", "journal", "health", "hospital", "city", "government", "museum", "history",
    "music", "art", "books", "travel", "recipes", "garden", "weather", "sports", "forum", "support", "developer", "open", "source", "data", "maps", "shop", "store", "jobs",
    "community", "family", "photo", "video", "the", "and", "about",
)

#: Longest word that is counted or cut out; a longer run of letters can only be cut into such words and unknown ones.
MAX_WORD = 24
#: Of the first fit: added to every seed word. Of the second: what a seed word counts beside the words of urls, and the
#: weight of the pooled word shares that both classes are smoothed with (so a word that tells nothing has log odds 0).
ALPHA = 1.0
SEED_COUNT = 0.1
PRIOR = 1.0
THRESHOLD = 0.5
#: Share of the unigram mass that a seed word has at least.
SEED_SHARE = 1e-5
SALTS = 8
_HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<[^>]*>|&#?\w+;", re.S | re.I)
#: Words of prose: parts of host names, addresses and numbers are not words.
_WORD = re.compile(rf"(?<![\w.@/:-])[a-z]{{1,{MAX_WORD}}}(?![\w@/:-]|\.\w)")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):  # the longest is asked last, so first
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def parts_of(host: Column, path: Column) -> Column:
    """Runs of ASCII letters of host and path, lower-cased, with repeats."""
    return F.array_remove(F.split(ascii_lower(F.concat_ws("/", host, path)), "[^a-z]+"), "")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter[str] = Counter()
        for value in batch.column("html"):
            if page := value.as_py():
                found.update(_WORD.findall(_HIDDEN.sub(" ", page).lower()))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])


def unigrams(pages: DataFrame, html: str) -> DataFrame:
    """word, n over the visible text of all pages."""
    counted = pages.select(F.col(html).alias("html")).mapInArrow(_count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(part: str, known: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """The most probable words of ``part``. known[(start, length)]: log probability; another word of n letters costs ``unknown`` and n more powers of ten."""
    best, cut = [0.0] + [-math.inf] * len(part), [0] * (len(part) + 1)
    ten = math.log(10)
    for stop in range(1, len(part) + 1):
        for start in range(max(0, stop - MAX_WORD), stop):
            score = best[start] + known.get((start, stop - start), unknown - ten * (stop - start))
            if score > best[stop]:
                best[stop], cut[stop] = score, start
    out = []
    stop = len(part)
    while stop:
        out.append(part[cut[stop] : stop])
        stop = cut[stop]
    return out[::-1]


def _segment(unknown: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for part, found in zip(batch.column("part").to_pylist(), batch.column("found").to_pylist(), strict=True):
                known = {(x["start"], x["size"]): x["logp"] for x in found}
                words.append(viterbi(part, known, unknown))
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(words, pa.list_(pa.string()))], names=["part", "words"])
    return run


def segmented(parts: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """part, words of every distinct part; ``counts``: word, n with the sum ``total``."""
    prepare(parts.sparkSession)
    starts = F.explode(F.sequence(F.lit(0), F.length("part") - 1)).alias("start")
    places = parts.select("part", starts).select("part", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("part") - F.col("start")))).alias("size"))
    pieces = places.withColumn("word", F.substring("part", F.col("start") + 1, F.col("size")))
    found = salted_join(pieces, counts, "word", SALTS, "inner").withColumn("logp", F.log(F.col("n") / F.lit(float(total))))
    by_part = found.groupBy("part").agg(F.collect_list(F.struct("start", "size", "logp")).alias("found"))  # at most MAX_WORD entries a letter
    full = parts.join(by_part, "part", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<start:int,size:int,logp:double>>")))
    return full.mapInArrow(_segment(-math.log(max(total, 1))), "part string, words array<string>")


def seed_counts() -> tuple[Counter, Counter]:
    return Counter(" ".join(BLOCK_SEEDS).split()), Counter(" ".join(ALLOW_SEEDS).split())


def word_log_odds(doc_words: DataFrame) -> DataFrame:
    """word, log_odds (block against allow) from the seeds and all documents. ``doc_words``: distinct (doc, word)."""
    spark = doc_words.sparkSession
    block, allow = seed_counts()
    vocabulary = len({*block, *allow})
    odds = lambda w: math.log((block[w] + ALPHA) / (block.total() + ALPHA * vocabulary)) - math.log((allow[w] + ALPHA) / (allow.total() + ALPHA * vocabulary))
    seeds = spark.createDataFrame([(w, float(block[w]), float(allow[w]), odds(w)) for w in sorted({*block, *allow})], "word string, b double, a double, first double")
    told = doc_words.join(F.broadcast(seeds.select("word", "first")), "word").groupBy("doc").agg(F.sum("first").alias("first"))
    weight = stored(told.select("doc", (1 / (1 + F.exp(-F.col("first")))).alias("p")), "url-evidence")
    share = weight.agg(F.avg("p")).first()[0]
    either = F.lit(0.5 if share is None else share)
    per_word = salted_join(doc_words, weight, "doc", SALTS).groupBy("word").agg(F.sum(F.coalesce("p", either)).alias("p"), F.sum(1 - F.coalesce("p", either)).alias("q"))
    counted = stored(per_word.join(F.broadcast(seeds), "word", "full").select(
        "word", (SEED_COUNT * F.coalesce("b", F.lit(0.0)) + F.coalesce("p", F.lit(0.0))).alias("b"), (SEED_COUNT * F.coalesce("a", F.lit(0.0)) + F.coalesce("q", F.lit(0.0))).alias("a")), "url-words")
    sums = counted.agg(F.sum("b").alias("b"), F.sum("a").alias("a")).first()
    pooled = PRIOR * (F.col("b") + F.col("a")) / F.lit(sums["b"] + sums["a"])
    top = lambda c: F.log((F.col(c) + pooled) / F.lit(sums[c] + PRIOR))
    return counted.select("word", (top("b") - top("a")).alias("log_odds"))


def judged(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page."""
    prepare(pages.sparkSession)
    block, allow = seed_counts()
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    urls = stored(rows.select("host", "path").distinct(), "urls")
    counts = stored(unigrams(pages, html), "unigrams")
    total = counts.agg(F.sum("n")).first()[0] or 0
    seeds = pages.sparkSession.createDataFrame([(w, max(1, int(total * SEED_SHARE))) for w in sorted({*block, *allow})], "word string, n long")
    counts = counts.unionAll(seeds).groupBy("word").agg(F.sum("n").alias("n"))
    total += len({*block, *allow}) * max(1, int(total * SEED_SHARE))

    none = F.lit("")
    url_parts = urls.select("host", "path", F.explode(parts_of(F.col("host"), F.col("path"))).alias("part"))
    words = stored(segmented(url_parts.select("part").distinct(), counts, total), "url-parts")
    # distinct hosts and distinct paths are the documents of the model
    docs = urls.select(F.struct(F.lit("host").alias("kind"), F.col("host").alias("name")).alias("doc"), parts_of(F.col("host"), none).alias("parts")).distinct()
    docs = docs.unionAll(urls.select(F.struct(F.lit("path").alias("kind"), F.col("path").alias("name")).alias("doc"), parts_of(none, F.col("path")).alias("parts")).distinct())
    doc_parts = docs.select("doc", F.explode(F.array_distinct("parts")).alias("part"))
    doc_words = stored(salted_join(doc_parts, words, "part", SALTS, "inner").select("doc", F.explode("words").alias("word")).distinct(), "doc-words")
    log_odds = word_log_odds(doc_words)

    part_words = words.select("part", F.explode("words").alias("word"))
    part_scores = salted_join(part_words, log_odds, "word", SALTS, "inner").groupBy("part").agg(F.sum("log_odds").alias("part_score"))
    url_scores = salted_join(url_parts, part_scores, "part", SALTS, "inner").groupBy("host", "path").agg(F.sum("part_score").alias("score"))
    key = F.struct("host", "path").alias("key")
    scored = salted_join(rows.withColumn("key", key), url_scores.select(key, "score"), "key", SALTS)
    rule = rule_for(F.col("host"), F.col("path"), rules)
    score = F.coalesce("score", F.lit(0.0))
    return scored.withColumn("found", rule).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(score > THRESHOLD, "block").otherwise("allow")).alias("verdict"), score.alias("score"))
