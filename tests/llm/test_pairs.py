"""Joins, mixing, archives and decontamination against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest

from helpers import SF, empty, odd
from skuflow.config import scratch_path
from skuflow.llm import decontamination, jaccard, mixing, warc
from skuflow.llm.queries import queries


def brute_links(sets, threshold=0.8):
    n = len(sets)
    return {(i, j) for i in range(n) for j in range(i + 1, n) if len(sets[i]) and len(sets[j]) and
            len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9}


def near_copies(n=400, seed=3):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    out = []
    base = [[r.choice(vocab) for _ in range(r.randrange(30, 200))] for _ in range(60)]
    shared = [r.choice(vocab) for _ in range(60)]
    for _ in range(n):
        w = list(r.choice(base))
        for _ in range(r.randrange(0, 1 + len(w) // 40)):
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.3:
            w = shared + w
        out.append(" ".join(w))
    return out + ["", None, "one two", "one two", "One, two!", "a b c d e f"]


def check_classes(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in jaccard.classes(df).collect()}
    sets = [set(jaccard.ngram_set(t).tolist()) for t in texts]
    links = brute_links(sets) | {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if not sets[i] and not sets[j]}
    n, parent = defaultdict(int), list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in sorted(links):
        n[i] += 1
        n[j] += 1
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    assert len(got) == len(texts)
    assert {i: r["n_links"] for i, r in got.items()} == {i: n[i] for i in range(len(texts))}
    assert {i: r["class_id"] for i, r in got.items()} == {i: find(i) for i in range(len(texts))}
    return df, got


def test_jaccard_join_against_brute_force(spark):
    df, got = check_classes(spark, near_copies())
    kept = sorted(r["doc_id"] for r in jaccard.deduplicated(df).collect())
    assert kept == sorted({r["class_id"] for r in got.values()})


def test_jaccard_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 50)
    check_classes(spark, near_copies(300, seed=8))


def test_jaccard_groups_with_empty_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 120)
    r = random.Random(6)
    texts = []
    for g in range(24):   # groups of two and three texts of about 100 n-grams: two or three blocks, some of them empty
        w = [f"g{g}w{r.randrange(5000)}" for _ in range(104)]
        texts += [" ".join([*w, *(f"end{g}x{k}" for _ in range(k))]) for k in range(2 + g % 2)]
    _, got = check_classes(spark, texts)
    assert {x["n_links"] for x in got.values()} == {1, 2}


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000) for i in range(1, 50)]
    got = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(50)}


def test_shingles():
    a = jaccard.ngram_set("The quick, brown fox jumps over")
    assert len(a) == 2 and set(a) == set(jaccard.ngram_set("the QUICK brown fox jumps over"))
    assert len(jaccard.ngram_set(None)) == 0 and len(jaccard.ngram_set("...")) == 0 and len(jaccard.ngram_set("a b")) == 1


def fill(sizes, weights, epochs):
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        free = total - sum(epochs * sizes[s] for s in full)
        w = sum(weights[s] for s in sizes if s not in full)
        target = {s: epochs * sizes[s] if s in full else free * weights[s] / w for s in sizes}
        over = {s for s in sizes if target[s] > epochs * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 300}, {"a": 0, "b": 7}, {"a": 1, "b": 1, "c": 1, "d": 1, "e": 10**6}])
def test_water_filling(spark, sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.water_fill(mixing.source_weights(df)).collect()}
    assert got == pytest.approx(fill(sizes, weights, 3))


def test_mix_meets_its_targets(spark):
    a, b = (sorted(map(tuple, queries()["op2_mix_sources"](spark, SF).collect())) for _ in range(2))
    assert a == b
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries()["op2_mix_sources"](spark, SF).collect()
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == len(docs[r["doc_id"]]["text"].split()) and 0 <= r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    assert len(rows) == len(docs)
    sizes = {s: sum(r["size"] for r in x) for s, x in by.items()}
    want = fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}, 3)
    for s, x in by.items():
        assert x[0]["target"] == pytest.approx(want[s]) and x[0]["source_size"] == sizes[s]
        assert abs(sum(r["taken"] for r in x) - want[s]) <= 1
        assert sum(r["repeats"] not in (x[0]["target"] // sizes[s], x[0]["target"] // sizes[s] + 1) for r in x) == 0


def test_mix_odd_and_empty_tables(spark):
    got = mixing.mix(odd(spark)).collect()
    assert len(got) == odd(spark).count()
    kept = mixing.mix(odd(spark), keep=True)
    assert {"text", "lang", "label", "taken", "size"} <= set(kept.columns) and kept.count() == len(got)
    for s in {r["source"] for r in got}:
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - next(r["target"] for r in got if r["source"] == s)) <= 1
    assert mixing.mix(empty(spark)).collect() == []


def edit(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_myers_distance():
    r = random.Random(5)
    for _ in range(200):
        p = "".join(r.choice("abc ") for _ in range(r.randrange(1, 70)))
        t = "".join(r.choice("abc ") for _ in range(r.randrange(0, 90)))
        if r.random() < 0.5:
            t += p[: r.randrange(len(p) + 1)]
        assert decontamination.myers(p, t) == edit(p, t)


def test_decontamination_against_brute_force(spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randrange(10, 60)))) for i in range(12)] + [(50, None), (51, ""), (0, None)]
    docs = []
    for i in range(120):
        t = " ".join(r.choice(words) for _ in range(80))
        if i % 3 == 0:
            x = list(r.choice(items[:12])[1])
            for _ in range(r.randrange(0, 14)):
                x[r.randrange(len(x))] = r.choice("xyz")
            t = t[:100] + " " + "".join(x).upper() + "\n  " + t[100:]
        docs.append((i, t))
    docs += [(900, None), (901, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in docs:
        for item, text in items:
            best = [x for p in decontamination.passages(decontamination.normal(text))
                    if (x := edit(p, decontamination.normal(t))) <= len(p) * 0.05]
            if best:
                want[i, item] = (min(best), len(best))
    got = {(x["doc_id"], x["item_id"]): (x["distance"], x["passages"]) for x in decontamination.contaminated(d, b).collect()}
    assert got == want and len(want) > 10
    split = {(x["doc_id"], x["item_id"]): (x["distance"], x["passages"])
             for x in decontamination.contaminated(d, b, group_chars=500).collect()}
    assert split == want


def test_whole_items_have_their_own_budget():
    r = random.Random(12)
    draw = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    items = [(i, draw(n)) for i, n in enumerate([233, 233, 300, 640, 150])]
    matcher, some = decontamination.Matcher(items, 0.05), 0
    for _ in range(40):
        for item, t in items:
            x = list(t)
            for at in r.sample(range(33, min(len(t), 200)), r.choice([10, 11, 11, 12])):
                x[at] = "z"
            text = draw(50) + "".join(x) + draw(50)
            got = {h["item_id"]: h for h in matcher.find(text)}
            best = edit(t, text)
            if best <= len(t) * 0.05:
                assert item in got
                some += got[item]["passages"] == 0 and got[item]["distance"] == best
    assert some > 5


def test_benchmark_groups_are_searched_one_by_one(spark, monkeypatch):
    d = spark.createDataFrame([(1, "a " * 60 + "b " * 60), (2, None), (3, "c " * 60), (3, "c " * 60), (4, "d")], "doc_id long, text string")
    b = spark.createDataFrame([(i, f"{x} " * 50) for i, x in enumerate("abcefgh")], "item_id long, text string")
    whole = decontamination.with_hits(d, b)
    parts = decontamination.with_hits(d, b, group_chars=100)
    assert "find(" in whole._jdf.queryExecution().toString() and "find(" not in parts._jdf.queryExecution().toString()
    rows = [sorted((r["doc_id"], sorted(map(tuple, r["hits"]))) for r in x.collect()) for x in (whole, parts)]
    assert rows[0] == rows[1] and [len(h) for _, h in rows[0]] == [2, 0, 1, 1, 0]


def test_decontamination_odd_and_empty_tables(spark):
    b = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontamination.contaminated(odd(spark), b).collect() == []
    assert decontamination.contaminated(empty(spark), b).collect() == []
    assert decontamination.contaminated(odd(spark), b.where("false")).collect() == []


def digest(html):
    return hashlib.sha1(html.encode()).hexdigest()


def pages(r):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    big = "<p>é" * 600
    rows = [(i, f"http://h/{i}", "".join(r.choice("abc<>\r\né") for _ in range(r.randrange(0, 3000)))) for i in range(40)]
    rows += [(100, "u", "x" + fake + "y"), (101, "u", fake), (102, "u", fake * 40), (103, "u", "WARC/1.1\r\n"), (104, "u", "\r\n\r\nWARC/1.1\r\n\r\n\r\n"),
             (105, None, None), (106, "a b\r\nX: y", ""), (107, "u", big), (108, "u", big), (109, "u", big), (None, "u", big), (110, "u", "s"), (111, "u", "s"),
             (112, "u", "z" * 1000), (112, "u", "z" * 1000), (113, "u", "WARC/1.1\r\nWARC/1.1\r\n" * 100), (114, "u", "WARC/1.1\r\nWARC/1.1\r\n" * 100)]
    return rows


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_round_trip(spark, compression):
    rows = pages(random.Random(2))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = warc.round_trip(df, per_archive=17, compression=compression).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    target = {}
    for p, _, h in rows:
        if len((h or "").encode()) >= 1000 and p is not None:
            target[h] = max(p, target.get(h, p))
    want = []
    for p, _, h in rows:
        t = target.get(h)
        revisit = t is not None and p != t
        want.append((p, len((h or "").encode()), digest(h or ""), "revisit" if revisit else "response", t if revisit else None, True))
    key = lambda x: tuple((v is None, str(v)) for v in x)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_archive_that_does_not_start_with_a_record_gives_none(spark):
    path = scratch_path(spark, "warc-bad")
    good = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 2\r\n\r\nhi"
    spark.createDataFrame([("junk" + good,)], "value string").coalesce(1).write.option("lineSep", warc.END).text(path)
    assert warc.read_archives(spark, path).collect() == []


def test_archives_of_pages(spark):
    rows = queries()["op8_warc_round_trip"](spark, SF).collect()
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(html) and all(r["payload_digest"] == digest(html[r["page_id"]]) and r["intact"] for r in rows)
    nothing = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(nothing).collect() == []


def test_jaccard_odd_and_empty_tables(spark):
    got = jaccard.classes(odd(spark)).collect()
    assert len(got) == odd(spark).count() and jaccard.classes(empty(spark)).collect() == []
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[7]["class_id"] == by[8]["class_id"] == 7 and by[8]["n_links"] == 2 and by[1]["class_id"] == by[2]["class_id"] == 1
    kept = jaccard.deduplicated(odd(spark)).collect()
    assert [r["doc_id"] for r in kept].count(7) == 1 and 8 not in [r["doc_id"] for r in kept]
