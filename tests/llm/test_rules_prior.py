"""Host verdicts by a prior without binomial spread, against a plain-Python version."""

import math
import random
from collections import defaultdict

from skuflow.llm import rules

GOOD = " ".join(f"word{i}" for i in range(80))
SOFT = " ".join(f"wo##rd{i}" for i in range(80))


def run(spark, rows):
    df = spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(rows)], "doc_id long, text string, source string")
    return [r for r in sorted(rules.quality_rules(df).collect(), key=lambda r: r["doc_id"])]


def by_force(rows):
    """(kept, rate, bad) per row."""
    hosts = defaultdict(lambda: [0, 0])
    for t, h in rows:
        hosts[h][0] += 1
        hosts[h][1] += t is SOFT
    n, f, k = sum(x for x, _ in hosts.values()), sum(y for _, y in hosts.values()), len(hosts)
    m = f / n
    rho = 0.0
    if 0 < m < 1:
        between = sum(x * (y / x - m) ** 2 for x, y in hosts.values()) / (m * (1 - m)) - (k - 1)
        seen = n - sum(x * x for x, _ in hosts.values()) / n - (k - 1)
        rho = between / seen if seen > 1e-6 else 0.0
    a = min(1000.0, max(1.0, 1 / rho - 1)) if rho > 0 else 1000.0
    out = {}
    for h, (x, y) in hosts.items():
        rate = (y + m * a) / (x + a)
        low = rate - 2 * math.sqrt(rate * (1 - rate) / (x + a + 1))
        out[h] = rate, x < n and low >= 0.25 and low >= 2 * (f - y) / (n - x)
    return [(not (t is SOFT and out[h][1]), *out[h]) for t, h in rows]


def test_verdicts_against_brute_force(spark):
    r = random.Random(6)
    bad_seen = 0
    for _ in range(3):
        rows = []
        for h in range(r.randrange(3, 12)):
            rate = r.choice([0.05, 0.1, 0.2, 0.9])
            rows += [(SOFT if r.random() < rate else GOOD, f"h{h}" if h else None) for _ in range(r.choice([1, 5, 60]))]
        want = by_force(rows)
        got = run(spark, rows)
        assert [(g["kept"], g["bad_host"]) for g in got] == [(w[0], w[2]) for w in want]
        assert all(abs(g["host_rate"] - w[1]) < 1e-5 for g, w in zip(got, want))
        bad_seen += sum(w[2] for w in want)
    assert bad_seen


def test_one_page_hosts_are_not_bad(spark):
    rows = [(SOFT if i % 5 == 0 else GOOD, f"one{i}") for i in range(500)] + [(SOFT if i % 5 == 0 else GOOD, "large") for i in range(500)]
    got = run(spark, rows)
    assert all(g["kept"] and not g["bad_host"] for g in got)
    assert all(abs(g["host_rate"] - 0.2) < 0.01 for g in got)     # hosts of one rate: the prior holds them together
    got = run(spark, [*rows, *[(SOFT if i % 10 else GOOD, "bad") for i in range(200)]])
    assert all(g["kept"] == (not g["n_rules"]) and g["bad_host"] for g in got[1000:])
    assert all(g["kept"] for g in got[:1000])


def test_a_bad_host_of_most_documents(spark):
    rows = [(SOFT if i % 10 else GOOD, "hot") for i in range(300)] + [(SOFT if i % 20 == 0 else GOOD, f"h{i % 4}") for i in range(200)]
    got = run(spark, rows)
    assert all(g["bad_host"] == (i < 300) for i, g in enumerate(got))
    assert not any(g["bad_host"] for g in run(spark, rows[:300]))   # nothing to compare it with
