"""Benchmark decontamination: pigeonhole edit matching.

Items are normalised (lower case, single blanks); a long one is searched for as a whole
and cut into overlapping passages. A passage or item of m characters may differ by k = floor(rate * m) edits. Cut
into k + 1 pieces, any text within k edits holds at least one piece unchanged; an
automaton over all pieces finds those places, and Myers' bit-parallel distance
verifies the text around each of them.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import written

PASSAGE, STRIDE = 200, 100
ERROR_RATE = 0.05
GROUP_CHARS = 1_000_000   # of benchmark text searched for in one pass: an automaton of about 140 MB in a worker


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def passages(text: str) -> list[str]:
    """The text in windows of PASSAGE characters, each STRIDE on; a short one as it is."""
    if len(text) <= PASSAGE:
        return [text] if text else []
    return [text[i:i + PASSAGE] for i in [*range(0, len(text) - PASSAGE, STRIDE), len(text) - PASSAGE]]


def pieces(passage: str, rate: float) -> tuple[int, list[tuple[int, str]]]:
    """The error budget k and k + 1 (offset, piece) that make up the passage."""
    k = math.floor(rate * len(passage))
    cuts = [i * len(passage) // (k + 1) for i in range(k + 2)]
    return k, [(a, passage[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> int:
    """Least edit distance of the pattern to any substring of the text."""
    m = len(pattern)
    eq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best = m
    for c in text:
        e = eq.get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best = score
                if not best:
                    return 0
        ph = ph << 1 & mask     # a match may start anywhere in the text
        mh = mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return best


class Matcher:
    """All passages of a group of items, and the automaton over their pieces."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        self.rate, self.items = rate, items
        self.machine = None

    def _build(self) -> None:
        import ahocorasick

        self.table: list[tuple[object, str, int]] = []
        self.wholes: set[int] = set()    # numbers of long items as they are
        places: dict[str, list[tuple[int, int]]] = {}
        for item, text in self.items:
            t = normal(text)
            for p in [*passages(t), *([t] if len(t) > PASSAGE else [])]:
                if len(p) > PASSAGE:
                    self.wholes.add(len(self.table))
                k, parts = pieces(p, self.rate)
                for offset, part in parts:
                    places.setdefault(part, []).append((len(self.table), offset))
                self.table.append((item, p, k))
        self.machine = ahocorasick.Automaton()
        for part, at in places.items():
            self.machine.add_word(part, (len(part), at))
        if places:
            self.machine.make_automaton()

    def __getstate__(self):
        return {"rate": self.rate, "items": self.items, "machine": None}

    def find(self, text: str | None) -> list[dict]:
        """Items that stand in the text, or a passage of them: least distance of their passages and how
        many were found; if none was, the whole item's distance and 0."""
        if self.machine is None:
            self._build()
        t = normal(text)
        if not t or not self.table:
            return []
        starts: dict[int, set[int]] = {}
        for end, (size, at) in self.machine.iter(t):
            for n, offset in at:
                starts.setdefault(n, set()).add(end - size + 1 - offset)
        found: dict[object, list[int]] = {}
        whole: dict[object, int] = {}
        for n, diagonals in sorted(starts.items(), key=lambda x: x[0] in self.wholes):
            item, p, k = self.table[n]
            if n in self.wholes and item in found:
                continue
            best = k + 1
            run: list[int] = []
            for d in [*sorted(diagonals), None]:
                if run and (d is None or d - run[-1] > 2 * k + len(p)):
                    best = min(best, myers(p, t[max(0, run[0] - k):run[-1] + len(p) + k]))
                    run = []
                    if best == 0:
                        break
                if d is not None:
                    run.append(d)
            if best <= k and n in self.wholes:
                whole[item] = min(best, whole.get(item, best))
            elif best <= k:
                found.setdefault(item, []).append(best)
        return [{"item_id": i, "distance": min(x), "passages": len(x)} for i, x in found.items()] + [
            {"item_id": i, "distance": x, "passages": 0} for i, x in whole.items()]


def _finder(matcher: Matcher, kind: str):
    @F.pandas_udf(f"array<struct<item_id: {kind}, distance: long, passages: long>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([matcher.find(x) for x in texts], dtype=object)

    return find.asNondeterministic()  # so that no inferred filter makes a second call


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
              item_text: str = "text", rate: float = ERROR_RATE, group_chars: int = GROUP_CHARS,
              name: str = "hits") -> DataFrame:
    """``docs`` with an array of (item_id, distance, passages): items found within the budget.

    Null and empty texts and items match nothing; repeated items are one item; an
    item of under 1 / rate characters must stand unchanged. The items go to the tasks in
    groups of at most ``group_chars`` characters (and one item); a larger benchmark
    takes more passes, all of which see every row, and one after the other.
    """
    items = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).alias("t")).where(F.col("t").isNotNull())
    kind = dict(items.dtypes)["i"]
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    groups = max(1, -(-total // group_chars))
    hit = f"array<struct<item_id: {kind}, distance: long, passages: long>>"

    def finder(g: int):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(groups)) == g).distinct().collect()
        return _finder(Matcher([(r["i"], r["t"]) for r in part], rate), kind)

    text = F.col(f"`{text_col}`")
    if groups == 1:
        return docs.withColumn(name, finder(0)(text))
    # hits depend on the text alone: each group leaves a table of the texts it hits, before the next is collected
    keys = {"_t1": F.xxhash64(text), "_t2": F.xxhash64(F.lit("second"), text)}
    found = None
    for g in range(groups):
        one = docs.withColumns(keys).select("_t1", "_t2", finder(g)(text).alias("_h")).where("size(_h) > 0")
        one = written(one.dropDuplicates(["_t1", "_t2"]), "hits")
        found = one if found is None else found.unionByName(one)
    found = found.groupBy("_t1", "_t2").agg(F.flatten(F.collect_list("_h")).alias(name))
    out = docs.withColumns(keys).join(found, ["_t1", "_t2"], "left")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.col(name), F.array().cast(hit)).alias(name))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """One row per document row and item found in it: the id, item_id, distance, passages."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    hits = with_hits(rows, benchmark, "_text", **options)
    return hits.select(F.col("_id").alias(id_col), F.explode("hits").alias("h")).select(id_col, "h.*")
