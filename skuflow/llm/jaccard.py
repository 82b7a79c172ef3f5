"""N-gram Jaccard join by chosen paths.

Texts become sets of hashed word n-grams; texts with equal sets form one node. A
run starts with all nodes in one bucket and splits buckets on sampled shared
tokens: at a bucket's path a few coordinates of the min-hash signature are chosen,
each with probability 1 / (threshold * coordinates), and nodes that agree in one
go on together. Small buckets are compared by brute force. In a large one every
node is compared with one pivot: near ones are linked to it and, if very near,
leave, on all paths; the rest is split again. Runs are repeated until the target recall.

The links found that way only propose groups. Each group is then verified exactly
on its n-gram sets, in blocks, which gives the true links and the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm.common import row_key, written

NGRAM, THRESHOLD = 5, 0.8
COORDINATES = 64
RECALL, DEPTH = 0.999, 4     # runs follow from this recall at this depth
SMALL = 512                  # nodes in a bucket compared by brute force
ROUGH = 0.65                 # estimated similarity that proposes a link (threshold less three deviations)
# To a pivot: near enough to be proposed; and so near that whatever it links to is proposed too (Jaccard
# distance is a metric: LOOSE + (1 - THRESHOLD), and 0.15 for the estimates' errors), so it may leave.
LOOSE, TIGHT = 0.35, 0.7
SLICE = 2048                 # rows of a large bucket that one task compares with its pivot
STAR_SLICES = 64             # parts in which a node's edges meet its least neighbour
LEVELS = 8                   # what is still together after so many splits is proposed as one group
BLOCK_SETS, BLOCK_TOKENS = 1024, 1 << 18

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += 32
_P = 0x9E3779B97F4A7C15 | 1
_INV = pow(_P, -1, 1 << 64)
_COEF = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                  0x1D8E4E27C47D124F, 0xEB44ACCAB455D165], np.uint64)  # odd multipliers by place in an n-gram
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, 1 << 17)
        with np.errstate(over="ignore"):
            for name, base in (("p", _P), ("i", _INV)):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                _powers[name] = np.multiply.accumulate(x)
    return _powers["p"][:n], _powers["i"][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def ngram_set(text: str | None, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams.

    Words are runs of ASCII letters and digits (A-Z lowered) and non-ASCII bytes. A text
    of fewer than n words has one n-gram of all its words; without a word, none.
    """
    b = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    w = _WORD[b]
    if not w.any():
        return np.zeros(0, np.uint64)
    edge = np.diff(np.concatenate([[0], w.view(np.int8), [0]]))
    start, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    power, inverse = _power(len(b) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_LOWER[b] + np.uint64(1)) * power[:len(b)])])
        words = _mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
        k = len(words) - n + 1
        if k < 1:
            x = np.array([len(words)], np.uint64)
            for i, h in enumerate(words):
                x = x + h * _COEF[i]
        else:
            x = np.full(k, n, np.uint64)
            for i in range(n):
                x = x + words[i:i + k] * _COEF[i]
        return np.unique(_mix(x))


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(41)
    return r.integers(0, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, COORDINATES, np.uint64)


def signature(tokens: np.ndarray) -> np.ndarray:
    """Min-hash per coordinate; texts agree in one with the probability of their similarity."""
    a, b = _seeds_once()
    low = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(tokens), 4096):
            low = np.minimum(low, ((tokens[i:i + 4096, None] * a + b) >> np.uint64(32)).min(0))
    return low.astype(np.uint32).view(np.int32)


_cache: list = []


def _seeds_once():
    if not _cache:
        _cache.append(_seeds())
    return _cache[0]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        node, n, sig = [], [], []
        for t in b.column("_text"):
            s = ngram_set(t.as_py())
            with np.errstate(over="ignore"):
                two = np.array([s.sum(dtype=np.uint64), _mix(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64)], np.uint64)
                node.append(_mix(two + np.uint64(len(s))).tobytes())
            n.append(len(s))
            sig.append(signature(s))
        flat = pa.array(np.concatenate(sig) if sig else np.zeros(0, np.int32), pa.int32())
        offsets = pa.array(np.arange(len(sig) + 1) * COORDINATES, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("_id", "_k1", "_k2")), pa.array(node, pa.binary()), pa.array(n, pa.int64()),
             pa.ListArray.from_arrays(offsets, flat)], ["_id", "_k1", "_k2", "node", "n", "sig"])


def runs(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs that find a pair at the threshold with the wanted recall, split ``depth`` times.

    Of a pair's shared coordinates, Poisson(1) are chosen at each place, so it stays together
    one level deeper with 1 - exp(-q).
    """
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def _alike(a: np.ndarray, least: float) -> np.ndarray:
    """Pairs of signatures (rows) that agree in at least ``least`` of the coordinates."""
    same = np.zeros((len(a), len(a)), np.uint8)
    for c in a.T:
        same += c[:, None] == c[None, :]
    return same >= least * COORDINATES


def _roots(linked: np.ndarray) -> np.ndarray:
    """Least member number of each member's component of a symmetric boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    linked = linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(linked, label[None, :], n).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proposed links of small buckets, as each member's link to its component's first member."""
    for b in batches:
        left, right = [], []
        for members in b.column("members"):
            nid = members.values.field("nid").to_numpy()
            sig = members.values.field("sig").flatten().to_numpy().reshape(-1, COORDINATES)
            root = _roots(_alike(sig, ROUGH))
            linked = root != np.arange(len(root))
            left.append(nid[linked])
            right.append(nid[root[linked]])
        none = [np.zeros(0, np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left or none)), pa.array(np.concatenate(right or none))], ["a", "b"])


def _with_least(edges: DataFrame) -> DataFrame:
    """Every edge (a, b) with ``m``, the least b of its a. A node's edges are dealt by their other end
    into slices, each summed before it moves, so that no task reads a whole star."""
    dealt = edges.withColumn("slice", F.pmod(F.xxhash64(F.lit("star"), "b"), F.lit(STAR_SLICES)))
    low = (dealt.groupBy("a", "slice").agg(F.min("b").alias("m"))
           .withColumn("m", F.min("m").over(Window.partitionBy("a"))))   # STAR_SLICES rows a node at most
    return dealt.join(low, ["a", "slice"]).drop("slice")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge list (a, b); the root is the component's least node.

    Alternates large and small stars until the edges stop changing; every step sums before
    it joins, and its edges are a written table.
    """
    kind = dict(edges.dtypes)["a"]
    e = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).withColumn("m", F.least("m", "a")).where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large, "stars")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _with_least(large).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    out = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return out.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()).select(
        F.col("node").cast(kind), F.col("root").cast(kind))


def _chosen(paths: DataFrame, threshold: float) -> DataFrame:
    """``paths`` (with a ``path`` column) once for every coordinate chosen there."""
    share = int(1_000_000 / (threshold * COORDINATES))
    every = F.sequence(F.lit(0), F.lit(COORDINATES - 1))
    picked = F.filter(every, lambda i: F.pmod(F.xxhash64(F.col("path"), i), F.lit(1_000_000)) < share)
    return paths.withColumn("i", F.explode(picked))


def _next(df: DataFrame) -> DataFrame:
    return df.select(F.xxhash64("path", "i", F.get("sig", F.col("i"))).alias("path"), "nid")


def proposals(nodes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Links (a, b) between nodes (nid, sig) proposed by the chosen-path runs."""
    spark = nodes.sparkSession
    sigs = nodes.select("nid", "sig")
    start = spark.range(runs(threshold, recall)).select(F.xxhash64(F.lit("run"), "id").alias("path"))
    first = _chosen(start, threshold).collect()   # runs / threshold rows: the same for every node
    where = F.array(*[F.struct(F.lit(r["path"]).alias("path"), F.lit(r["i"]).alias("i")) for r in first])
    rows = written(_next(nodes.select("nid", "sig", F.explode(where).alias("c")).select("nid", "sig", "c.path", "c.i")), "steps")
    found = []
    for level in range(LEVELS):
        # of buckets with the same members only one goes on
        sizes = (rows.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("nid")).alias("x"),
                                          F.min("nid").alias("lo"), F.max("nid").alias("hi")).where("size > 1")
                 .groupBy("size", "x", "lo", "hi").agg(F.min("path").alias("path")).select("path", "size"))
        rows = written(rows.join(sizes, "path").join(sigs, "nid"), "paths")
        small = rows.where(F.col("size") <= SMALL)
        buckets = small.groupBy("path").agg(F.collect_list(F.struct("nid", "sig")).alias("members"))
        found.append(written(buckets.mapInArrow(_brute, "a long, b long"), "links"))
        slices = F.ceil(F.col("size") / SLICE).cast("int")
        big = rows.where(F.col("size") > SMALL)
        if big.isEmpty():
            break
        pivots = written(big.groupBy("path").agg(F.min_by(F.struct("nid", "sig"), F.xxhash64("nid")).alias("p"),
                                                 F.any_value("size").alias("size")), "pivots")
        # a bucket meets its pivot in slices, so that a hot one is no single task
        to = pivots.select("path", F.col("p.nid").alias("pivot"), F.col("p.sig").alias("psig"),
                           F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
        near = big.withColumn("slice", F.pmod(F.xxhash64(F.lit("slice"), "nid"), slices).cast("int")).join(to, ["path", "slice"])
        same = F.size(F.filter(F.zip_with("sig", "psig", lambda x, y: x == y), lambda t: t))
        near = written(near.select("path", "nid", "pivot", "sig", (same / COORDINATES).alias("alike")), "near")
        last = level == LEVELS - 1
        found.append(near.where((F.col("alike") >= LOOSE) | F.lit(last)).where("nid != pivot")
                     .select(F.col("nid").alias("a"), F.col("pivot").alias("b")))
        # a node that is very near a pivot anywhere is represented by it on all paths; pivots stay
        gone = (near.where((F.col("alike") >= TIGHT) & (F.col("nid") != F.col("pivot"))).select("nid").distinct()
                .join(pivots.select(F.col("p.nid").alias("nid")), "nid", "left_anti"))
        rest = near.where(F.col("alike") < TIGHT).select("path", "nid", "sig").join(gone, "nid", "left_anti")
        if not last:   # written, as sizes and members both read it
            rows = written(_next(_chosen(rest, threshold)), "steps")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = pa.array([ngram_set(t.as_py()).tobytes() for t in b.column("_text")], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("_k1"), b.column("_k2"), sets], ["_k1", "_k2", "tokens"])


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; tokens of one set only are skipped."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    number = np.cumsum(common) - 1
    keep = common[token]
    token, owner = number[token[keep]], owner[keep]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    width = 4096
    for lo in range(0, int(common.sum()), width):
        i, j = np.searchsorted(token, [lo, lo + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[i:j], token[i:j] - lo] = 1
        out += m @ m.T
    return out


def _verify_group(rows: list[tuple], i: int, j: int, threshold: float) -> list[tuple]:
    """(node, links, its component's first node) of one pair of blocks; either may be empty."""
    node, side, copies, sets = zip(*rows)
    if i != j and len(set(side)) == 1:
        return []
    sets = [np.frombuffer(s, np.uint64) for s in sets]
    n = np.array([len(s) for s in sets], np.float64)
    both = shared(sets).astype(np.float64)
    linked = both * (1 + threshold) >= threshold * (n[:, None] + n[None, :]) - 1e-6
    np.fill_diagonal(linked, False)
    if i != j:   # pairs within a block are counted where the block meets itself
        side = np.array(side)
        linked &= side[:, None] != side[None, :]
    links = linked @ np.array(copies, np.int64)
    root = _roots(linked)
    return [(node[i], int(links[i]), node[root[i]]) for i in range(len(node))]


def _verifier(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, rows = None, []

        def out(found: list[tuple]) -> pa.RecordBatch:
            node, links, root = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(links, pa.int64()), pa.array(root, pa.binary())],
                                              ["node", "links", "root"])

        for b in batches:
            done = []
            d = [b.column(c).to_pylist() for c in ("root", "i", "j", "node", "side", "copies", "tokens")]
            for root, i, j, *row in zip(*d):
                if (root, i, j) != here:
                    if rows:
                        done += _verify_group(rows, *here[1:], threshold)
                    here, rows = (root, i, j), []
                rows.append(tuple(row))
            yield out(done)
        if rows:
            yield out(_verify_group(rows, *here[1:], threshold))

    return verify


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, row key, node (128-bit digest of its n-gram set), set size, signature."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).select("_id", *row_key("_id", "_text"), "_text")
    kind = dict(rows.dtypes)["_id"]
    return written(rows.mapInArrow(_sketch, f"_id {kind}, _k1 long, _k2 long, node binary, n long, sig array<int>"), "sketches")


def links(docs: DataFrame, sketch: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
          text_col: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(node, links to other nodes' documents) and (node, root) for nodes with a verified link."""
    nodes = written(
        sketch.where("n > 0").groupBy("node").agg(
            F.any_value("sig").alias("sig"), F.any_value("n").alias("n"), F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("_k1", "_k2")).alias("k"))
        .select("node", "sig", "n", "copies", "k.*", F.xxhash64("node").alias("nid")), "nodes")
    group = components(proposals(nodes, threshold, recall)).select(F.col("node").alias("nid"), F.col("root"))
    members = written(nodes.drop("sig").join(group, "nid"), "members")
    blocks = members.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS))
                                         .cast("int").alias("nb"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).select(*row_key("_id", "_text"), "_text")
    tokens = (rows.join(members.select("_k1", "_k2"), ["_k1", "_k2"], "left_semi")
              .mapInArrow(_tokens, "_k1 long, _k2 long, tokens binary").dropDuplicates(["_k1", "_k2"]))
    full = (members.join(blocks, "root").withColumn("side", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("nb")).cast("int"))
            .join(tokens, ["_k1", "_k2"]).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .select("root", F.least("side", "x").alias("i"), F.greatest("side", "x").alias("j"), "node", "side", "copies", "tokens"))
    grouped = full.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    checked = written(grouped.mapInArrow(_verifier(threshold), "node binary, links long, root binary"), "verified")
    counts = checked.groupBy("node").agg(F.sum("links").alias("links")).where("links > 0")
    roots = components(checked.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    return counts, roots


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
            recall: float = RECALL) -> DataFrame:
    """One row per document: id, class_id, n_links, class_size, n_ngrams, and its row key and class root.

    A class is a connected component of links; its id is the least document id in it
    (null if all are null). ``n_links`` counts other documents of Jaccard similarity
    ``threshold`` or more, copies included. Texts without a word have no n-gram: they
    are copies of one another and link to nothing else. Null texts are empty; repeated
    rows count as copies; an empty table gives no rows.
    """
    sketch = sketches(docs, id_col, text_col)
    counts, roots = links(docs, sketch, threshold, recall, text_col, id_col)
    per_node = sketch.groupBy("node").agg(F.min("_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    per_node = per_node.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = per_node.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    per_node = written(per_node.join(least, "root").select(
        "node", "root", "class_id", "class_size", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    return sketch.drop("sig").join(per_node, "node").select(
        F.col("_id").alias(id_col), "class_id", "n_links", "class_size", F.col("n").alias("n_ngrams"), "_k1", "_k2", "root")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of each class: the one of least id (null last), of equal rows just one."""
    c = classes(docs, id_col, text_col, threshold, recall)
    first = F.min(F.struct(F.col(id_col).isNull().alias("z"), F.col(id_col).alias("i"), "_k1", "_k2"))
    keep = c.groupBy("root").agg(first.alias("f")).select("f._k1", "f._k2")
    rows = c.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("_n"))
    keep = written(keep.join(rows, ["_k1", "_k2"]), "keep")
    text = F.col(f"`{text_col}`")
    keyed = docs.withColumns({"_k1": F.xxhash64(F.col(f"`{id_col}`"), text),
                              "_k2": F.xxhash64(F.lit("second"), F.col(f"`{id_col}`"), text)})
    kept = keyed.join(keep, ["_k1", "_k2"])
    many = kept.where("_n > 1").dropDuplicates(["_k1", "_k2"])
    return kept.where("_n = 1").unionByName(many).select(*[F.col(f"`{x}`") for x in docs.columns])
