import itertools
import math
import random
import re

import pytest

from tripfold.llm import url_filter


def by_rules(host, path):
    best = None
    for rule, verdict in url_filter.RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith(f".{name}")) and path.startswith(f"/{rest}") and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if c.isascii() else c for c in host), tail[:stop]


PROSE = "<p>the weather in the garden is fine and people read books about history and travel while music plays in a museum</p>" * 3


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(1)
    urls = [None, "", "no scheme", "http://", "https://A.Example.NET/en/x?q", "http://net/", "http://a.net", "http://net.org/fr/x", "x://example.com/de/#/", "http://sub.example.com/de", "http://Ünïcode.org/FR/", "http://a.org/fr/", "ftp://a.net?x", "http://example.com/de/a://b"]
    urls += [f"http://www.{a}{b}.example.com/{rng.choice(['news', 'en'])}/{i}" for i, (a, b) in enumerate(itertools.product(["garden", "weather", "history", "music", "travel"], ["books", "museum", "people"]))]
    urls += ["http://cheappills.example.com/x", "http://spam-farm.example.com/y", "http://www.onlinecasino.example.com/"]
    rows = [(i, u, PROSE, "h", 1.0) for i, u in enumerate(urls)] + [(300, urls[4], None, "h", 1.0), (None, None, None, None, None), (77, "http://x.com/" + "a" * 3000, "", "", 0.0)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, score double").repartition(3)


def test_rules_hosts_and_words(pages):
    rows = pages.collect()
    got = url_filter.judged(pages).collect()
    assert len(got) == len(rows)
    urls = {r.page_id: r.url for r in rows}
    for r in got:
        host, path = split(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        rule = by_rules(host, path)
        assert r.rule == (rule and rule[0])
        if rule:
            assert r.verdict == rule[1]
        else:
            assert r.verdict == ("block" if any(w in host for w in ("pills", "spam", "casino")) else "allow"), r


def judge(spark, urls):
    rows = [(i, u, PROSE + "<p>casino win cheap pills spam farm free bets track blog news docs</p>" * 3) for i, u in enumerate(urls)]
    return [(r.verdict, r.score) for r in sorted(url_filter.judged(spark.createDataFrame(rows, "page_id long, url string, html string")).collect(), key=lambda r: r.page_id)]


def test_frequent_words_count(spark):
    farm = [f"http://a{i}.casinowin.example.com/p{i}" for i in range(30)]
    plain = [f"http://www.{w}{i}.example.com/x{i}" for i in range(15) for w in ("history", "garden", "q")]
    got = judge(spark, farm + plain)  # a third of all hosts is one farm
    assert [v for v, _ in got] == ["block"] * len(farm) + ["allow"] * len(plain)
    assert [v for v, _ in judge(spark, ["http://cheappills.example.com/", "http://blog.example.com/", "http://zq.example.com/"])] == ["block", "allow", "allow"]


def test_a_path_is_judged_by_its_own_words(spark):
    urls = [f"http://www.q{i}.example.com/{path}" for i in range(12) for path in ("casino/win", "x")] + ["http://m.ads-track.example.com/news", "http://m.ads-track.example.com/"]
    got = judge(spark, urls)
    assert [v for v, _ in got] == ["block", "allow"] * 12 + ["block", "block"]


def bayes(urls, segment):
    """Naive Bayes by its definition over distinct hosts and paths."""
    block, allow = url_filter.seed_counts()
    names = {*block, *allow}
    first = {w: math.log((block[w] + 1) / (block.total() + len(names))) - math.log((allow[w] + 1) / (allow.total() + len(names))) for w in names}
    docs = {("h", h) for h, _ in urls} | {("p", p) for _, p in urls}
    b, a = {w: 0.1 * block[w] for w in names}, {w: 0.1 * allow[w] for w in names}
    sure = {d: 1 / (1 + math.exp(-sum(first[w] for w in {*segment(d[1])} & names))) for d in docs if {*segment(d[1])} & names}
    either = sum(sure.values()) / len(sure)
    for d in docs:
        for w in set(segment(d[1])):
            p = sure.get(d, either)
            b[w], a[w] = b.get(w, 0.0) + p, a.get(w, 0.0) + 1 - p
    big_b, big_a = sum(b.values()), sum(a.values())
    share = {w: (b[w] + a[w]) / (big_b + big_a) for w in b}
    odds = {w: math.log((b[w] + share[w]) / (big_b + 1)) - math.log((a[w] + share[w]) / (big_a + 1)) for w in b}
    return [sum(odds.get(w, 0.0) for w in segment(f"{h}/{p}")) for h, p in urls]


def test_scores_match_brute_force(spark):
    urls = ["http://casino.garden.org.x/news/history", "http://a.b.x/win/casino", "http://garden.casino.x/", "http://z.x/news", "http://z.x/casino", "http://www.spam.x/travel/casino", "http://q.x/"]
    got = [s for _, s in judge(spark, urls)]
    segment = lambda name: re.findall("[a-z]+", name)  # noqa: E731  every part is one word here
    want = bayes([split(u) for u in urls], segment)
    assert all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(got, want, strict=True)), (got, want)


def test_viterbi_matches_brute_force():
    rng = random.Random(2)
    words = {"a": 5, "ab": 7, "b": 2, "ba": 9, "abc": 3, "c": 4, "cab": 6}
    total = sum(words.values())
    unknown = -math.log(total)
    for _ in range(100):
        part = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))
        known = {(s, n): math.log(words[part[s : s + n]] / total) for s in range(len(part)) for n in range(1, len(part) - s + 1) if part[s : s + n] in words}
        score = lambda cut: sum(math.log(words[w] / total) if w in words else unknown - math.log(10) * len(w) for w in cut)  # noqa: E731, B023
        cuts = [[part[a:b] for a, b in itertools.pairwise([0, *c, len(part)])] for k in range(len(part)) for c in itertools.combinations(range(1, len(part)), k)]
        assert math.isclose(score(url_filter.viterbi(part, known, unknown)), max(map(score, cuts)))


def test_segmentation_of_concatenated_names(spark, pages):
    counts = url_filter.unigrams(pages, "html")
    parts = spark.createDataFrame([("gardenbooks",), ("weathermuseum",), ("zzz",)], "part string")
    got = {r.part: r.words for r in url_filter.segmented(parts, counts, 1000).collect()}
    assert got == {"gardenbooks": ["garden", "books"], "weathermuseum": ["weather", "museum"], "zzz": ["zzz"]}


def test_empty_table(pages):
    assert url_filter.judged(pages.where("false")).count() == 0
