import re
from collections import Counter

from helpers import corpus
from tripfold.llm import quality_rules


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), base


def test_statistics_match_brute_force(spark, docs):
    got = quality_rules.digest(quality_rules.judged(docs)).drop("kept", "host_rate").collect()
    want = [(i, *brute(t)) for i, t in corpus()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    odd = [(0, "a\n\na \n a\r\nb"), (1, "\x0bx\x0c y z   *#<>|&%$"), (2, "aa bb cc dd ee aa bb cc dd ee ff" * 2), (3, "x y z v w " * 7), (4, "end f")]
    frame = spark.createDataFrame([(i, t, None) for i, t in odd], "doc_id long, text string, source string")
    got = quality_rules.digest(quality_rules.judged(frame)).drop("kept", "host_rate").collect()
    assert sorted(map(tuple, got)) == [(i, *brute(t)) for i, t in odd]


def test_host_verdicts(spark):
    good = "one two three four five six seven eight nine ten eleven %d"
    rows = [(i, good % i, "fine") for i in range(200)] + [(1000 + i, good % i if i % 10 == 0 else "short", "farm") for i in range(200)]
    rows += [(2000 + i, "short" if i else good % i, f"small{i}") for i in range(1)] + [(3000, good % 1, None)]
    got = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].kept for i in range(200)) and got[3000].kept
    assert not any(got[1000 + i].kept for i in range(200)) and not got[1000].base_failed


def test_rates_are_shrunk_towards_all_hosts(spark):
    good = "one two three four five six seven eight nine ten eleven %d"
    rows = [(100 * h + i, "short" if i < bad else good % i, f"h{h}") for h, (n, bad) in enumerate([(40, 4), (40, 8), (40, 20), (3, 3), (50, 0)]) for i in range(n)]
    got = {r.source: r for r in quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string").withColumnRenamed("host", "x"), host="source")
           .selectExpr("host AS source", "host_rate", "host_ok").distinct().collect()}
    rates = [4 / 40, 8 / 40, 20 / 40, 1.0, 0.0]
    m = sum(rates) / 5
    v = sum((x - m) ** 2 for x in rates) / 5
    strength = max(1.0, min(1e6, m * (1 - m) / v - 1))
    for h, (n, bad) in enumerate([(40, 4), (40, 8), (40, 20), (3, 3), (50, 0)]):
        want = (bad + strength * m) / (n + strength)
        assert abs(got[f"h{h}"].host_rate - want) < 1e-12 and got[f"h{h}"].host_ok == (want <= 0.5)
    assert sum(r.host_ok for r in got.values()) < 5


def test_plan_has_no_python_and_empty_table(docs, no_docs):
    assert quality_rules.judged(no_docs).count() == 0
    plan = quality_rules.statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
