"""Quality rules with host-level verdicts.

Each document is measured against a few rules. Failures are summed by host, and
each host's failure rate is shrunk towards the corpus by a beta prior fitted to
the hosts' counts (method of moments, binomial spread taken off). The verdict
returns to the documents: a document with a soft failure goes if its host fails
surely and far more often than all others, or if it fails several rules; a
document that fails no rule always stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")


def _repeats(words: list[str]) -> int:
    """Words that stand in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[str, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    n = len(ids)
    if n < 2_000_000:  # three ids fit one integer
        key = (w[:-2] * n + w[1:-1]) * n + w[2:]
    else:
        pair = np.unique(w[:-1] * n + w[1:], return_inverse=True)[1]
        key = pair[:-1] * n + w[2:]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k:len(words) - 2 + k] |= twice
    return int(hit.sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = WORD.findall(text)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(SYMBOL.findall(text)), dup, _repeats(words)


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(*measure(t := x.as_py() or ""), t.count("\n") + 1) for x in b.column("_text")]
        cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_MEASURES))]
        yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_host"), *cols], ["_id", "_host", *_MEASURES])


def measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    cols = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.col(text_col).alias("_text"))
    kinds = dict(cols.dtypes)
    return cols.mapInArrow(_measure, f"_id {kinds['_id']}, _host {kinds['_host']}, " + ", ".join(f"{m} long" for m in _MEASURES))


# The soft rules, as SQL over the measures.
RULES = {
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "repeats": "5 * n_repeat_words > n_words",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 12 * n_words)",
}
MOST_STRENGTH = 1000.0   # of the prior, in documents
BASE_RULE = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def host_rates(flagged: DataFrame, times: float = 2.0, least: float = 0.25) -> DataFrame:
    """One row a host: documents, failing ones, the shrunk failure rate and whether the host is bad.

    The beta prior has the corpus rate m as its mean. Its strength 1 / rho - 1 (within 1 and
    MOST_STRENGTH) follows from what the hosts' rates vary beyond chance: of S = sum n (p - m)^2 over k
    hosts, m (1 - m) (k - 1) is expected from binomial draws alone and only the rest counts, so many
    one-page hosts of one rate do not look like hosts of rate 0 and 1. A host is bad if its rate
    less two posterior deviations is ``least`` or more and ``times`` the rate of all other hosts'
    documents; the only host of a table is not. Hosts are summed before the shuffle, so a host
    with a third of all documents costs one row a task.
    """
    hosts = written(flagged.groupBy("_host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("failed").alias("n_failed")), "host-sums")
    square = F.col("n_docs").cast("double")
    k, n, f, s, q = hosts.agg(F.count(F.lit(1)), F.sum("n_docs"), F.sum("n_failed"), F.sum(
        F.col("n_failed").cast("double") * F.col("n_failed") / F.col("n_docs")), F.sum(square * square)).first()
    n, f = n or 0, f or 0
    m = f / n if n else 0.0
    rho = 0.0
    if 0 < m < 1 and (seen := n - q / n - (k - 1)) > 1e-6:
        rho = ((s - f * m) / (m * (1 - m)) - (k - 1)) / seen
    strength = min(MOST_STRENGTH, max(1.0, 1 / rho - 1)) if rho > 0 else MOST_STRENGTH
    rate = (F.col("n_failed") + F.lit(m * strength)) / (F.col("n_docs") + F.lit(strength))
    low = F.col("host_rate") - 2 * F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("n_docs") + F.lit(strength + 1)))
    others = F.when(F.col("n_docs") < F.lit(n), (F.lit(f) - F.col("n_failed")) / (F.lit(n) - F.col("n_docs")))
    bad = F.coalesce((low >= F.lit(least)) & (low >= times * others), F.lit(False))
    return hosts.withColumn("host_rate", F.round(rate, 6)).select(
        F.col("_host").alias("h_host"), "n_docs", "n_failed", "host_rate", bad.alias("bad_host"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  times: float = 2.0, least: float = 0.25, several: int = 2) -> DataFrame:
    """One row per input row: measures, base verdict, rules failed, host rate and verdict.

    ``kept`` is false for a base failure, for ``several`` rule failures, or for one
    rule failure on a bad host (:func:`host_rates`: ``times``, ``least``). Null texts have
    no words, so they fail the base rule; a null host is a host; very long texts are measured whole,
    one at a time; repeated rows and ties are each returned and counted; extra columns
    are ignored; an empty table gives no rows.
    """
    m = written(measures(docs, id_col, text_col, host_col), "rules")
    soft = [F.expr(r).cast("int") for r in RULES.values()]
    flagged = m.withColumn("base_failed", F.expr(BASE_RULE)).withColumn("n_rules", sum(soft[1:], soft[0]))
    flagged = flagged.withColumn("failed", (F.col("base_failed") | (F.col("n_rules") > 0)).cast("long"))
    hosts = written(host_rates(flagged, times, least), "hosts")
    bad = (F.col("n_rules") >= several) | ((F.col("n_rules") > 0) & F.col("bad_host"))
    return flagged.join(hosts, F.col("_host").eqNullSafe(F.col("h_host")), "left").select(
        F.col("_id").alias(id_col), *_MEASURES[:5], "base_failed", (~F.col("base_failed") & ~bad).alias("kept"),
        F.col("n_rules").cast("long").alias("n_rules"), F.col("n_docs").alias("host_docs"), "host_rate", "bad_host")
