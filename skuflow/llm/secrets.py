"""Secret scans: candidates from the text, verdicts from corpus-wide ownership.

A regex scan of every whole text gives base spans (kept as they are) and wider
candidates: keys named by an assignment and long mixed strings. Each candidate's
hash is then counted over the corpus by distinct repositories and owners. A value
that few owners hold and that looks random is live; a value that many owners hold
is an example that has been copied around.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import row_key, written

# The base patterns, in the order of kinds in span lists.
_WORDS = "password|passwd|secret|token|api_?key"
_ANY_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _WORDS)
ASSIGN = re.compile(rf"""({_ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
BASE_KINDS = ("assign", "access", "hex")
LEAST_VALUE = 8

# The method's own candidates.
MORE = {
    # from the first mark of a run of its characters: where that one fails, the run's later ones do too
    "jwt": re.compile(r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)"),
    # up to its end marker; without one, the header lines and the base64 lines that follow
    "pem": re.compile(r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"
                      r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]{0,24}PRIVATE KEY-----"
                      r"|(?:(?:\s|\\[nr]){1,8}[A-Za-z-]{1,40}: [^\r\n\\]*){0,8}(?:(?:\s|\\[nr]){1,8}[A-Za-z0-9+/=]{16,})*"
                      r"(?:(?:\s|\\[nr]){1,8}[A-Za-z0-9+/=]{1,15}\s*\Z)?)"),
    "prefixed": re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
                           r"|AIza[A-Za-z0-9_-]{30,}|glpat-[A-Za-z0-9_-]{16,})"),
    "opaque": re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}(?![A-Za-z0-9+/_-])"),
}
KINDS = (*BASE_KINDS, *MORE)
# Kinds whose form proves them, also where an assignment holds such a value: they need no digit.
PROVEN = {"access": ACCESS, "jwt": MORE["jwt"], "prefixed": MORE["prefixed"]}
_PEM_BODY = re.compile(r"KEY-----[\s\S]*?[A-Za-z0-9+/=]{16}")
_DIGIT = re.compile(r"[0-9]")
_OPAQUE_HINT = re.compile(r"[0-9][A-Za-z+/_-]*[0-9]")


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: str, kind: str = "opaque") -> bool:
    """Varied, and with a digit unless its form proves it; a PEM marker without key lines is no secret."""
    if len(value) < LEAST_VALUE or entropy(value) < 3.0:
        return False
    if kind == "pem":
        return bool(_PEM_BODY.search(value))
    return bool(_DIGIT.search(value)) or any(p.search(value) for p in PROVEN.values())


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base kinds, leftmost non-overlapping within a kind."""
    out = []
    if "=" in text or ":" in text:
        out += [("assign", m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.group()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def more_spans(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Candidates of the method that overlap no base span (a PEM block may: it holds more than that span)."""
    out: list[tuple[str, int, int, str]] = []
    cover = None
    for kind, pattern in MORE.items():
        if kind == "pem" and "-----BEGIN" not in text or kind == "jwt" and "eyJ" not in text:
            continue
        for m in pattern.finditer(text):
            v, start = (m.group(1), m.start(1)) if kind == "jwt" else (m.group(), m.start())
            if kind == "opaque" and not (_OPAQUE_HINT.search(v) and looks_random(v) and re.search("[A-Za-z]", v)):
                continue
            if cover is None:
                cover = bytearray(len(text))
                for _, a, z, _ in taken:
                    cover[a:z] = b"\1" * (z - a)
            if kind == "pem" or not any(cover[start:m.end()]):
                cover[start:m.end()] = b"\1" * len(v)
                out.append((kind, start, m.end(), v))
    return out


def span_text(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(((x[0], x[1], x[2]) for x in spans), key=lambda x: (x[1], KINDS.index(x[0]))))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.binary()),
                   ("random", pa.bool_()), ("base", pa.bool_()), ("value_at", pa.int64())])
_SPAN_DDL = ("array<struct<kind string, start long, end long, hash binary, random boolean, base boolean, "
             "value_at long>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "found")}
        for text in b.column("_text"):
            t = text.as_py() or ""
            base = base_spans(t)
            more = more_spans(t, base)
            n = Counter(k for k, *_ in base)
            for k in BASE_KINDS:
                cols[f"n_{k}"].append(n[k])
            cols["base_sha256"].append(hashlib.sha256(span_text(base).encode()).hexdigest())
            cols["found"].append([
                {"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode()).digest()[:16],
                 "random": looks_random(v, k), "base": i < len(base), "value_at": e - len(v)} for i, (k, s, e, v) in enumerate([*base, *more])])
        ints = [pa.array(cols[f"n_{k}"], pa.int64()) for k in BASE_KINDS]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("_id", "_owner", "_repo", "_k1", "_k2")), *ints, pa.array(cols["base_sha256"]),
             pa.array(cols["found"], pa.list_(_SPAN))],
            ["_id", "_owner", "_repo", "_k1", "_k2", "n_assign", "n_access", "n_hex", "base_sha256", "found"])


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
               repo_col: str = "doc_id") -> DataFrame:
    """Per row: base counts, digest and all candidate spans with their value's hash (a written table)."""
    keyed = docs.select(F.col(id_col).alias("_id"), F.col(owner_col).cast("string").alias("_owner"),
                        F.col(repo_col).cast("string").alias("_repo"), F.col(text_col).alias("_text"))
    keyed = keyed.select("_id", "_owner", "_repo", *row_key("_id", "_owner", "_repo", "_text"), "_text")
    kind = dict(docs.select(F.col(id_col).alias("i")).dtypes)["i"]
    return written(keyed.mapInArrow(_scan, f"_id {kind}, _owner string, _repo string, _k1 long, _k2 long, n_assign long, "
                                    f"n_access long, n_hex long, base_sha256 string, found {_SPAN_DDL}"), "secrets")


def ownership(found: DataFrame, widely: int = 3) -> DataFrame:
    """One row per candidate hash: distinct repositories and owners, and whether it is widely copied.

    A repository belongs to an owner, so repositories are counted within owners and
    summed; each step sums before it shuffles, so a value that stands in a third of
    all documents reaches its last task as one row per earlier task.
    """
    c = found.select("_owner", "_repo", F.explode("found").alias("f")).select("_owner", "_repo", F.col("f.hash").alias("hash"))
    per_repo = c.groupBy("hash", "_owner", "_repo").agg(F.count(F.lit(1)).alias("n"))
    per_owner = per_repo.groupBy("hash", "_owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    return (per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"),
                                          F.sum("n").alias("n_places"))
            .withColumn("widely", F.col("n_owners") >= widely))


def spans_column(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(order, s["kind"]), s["end"], s["kind"]))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def judged(found: DataFrame, widely: int = 3) -> DataFrame:
    """One row per row key with candidates: all spans with ``live`` and ``widely``.

    Rows equal in all key columns hold the same spans, so one of them stands for all.
    """
    one = found.where(F.size("found") > 0).dropDuplicates(["_k1", "_k2"])
    spread = one.select("_k1", "_k2", F.explode("found").alias("f")).withColumn("hash", F.col("f.hash"))
    verdict = spread.join(ownership(found, widely), "hash").withColumn("live", F.col("f.random") & ~F.col("widely"))
    return verdict.groupBy("_k1", "_k2").agg(F.collect_list(F.struct(
        "f.kind", "f.start", "f.end", "f.base", "f.value_at", "live", "widely")).alias("all"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                repo_col: str = "doc_id", widely: int = 3) -> DataFrame:
    """One row per input row: base counts and digest, all spans, live and example counts.

    Spans are the base ones and those of the method's candidates that are live: they
    look random and fewer than ``widely`` owners hold the value. ``n_live`` and
    ``n_example`` count candidates by that verdict (base ones too). Null and empty
    texts have no span; a null owner or repository counts as one of its own;
    repeated rows are each returned; extra columns are ignored.
    """
    found = candidates(docs, id_col, text_col, owner_col, repo_col)
    out = found.join(judged(found, widely), ["_k1", "_k2"], "left")
    shown = F.filter("all", lambda s: s["base"] | s["live"])
    n = lambda what: F.coalesce(F.size(F.filter("all", lambda s: s[what])), F.lit(0)).cast("long")
    return out.select(
        F.col("_id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(spans_column(shown), F.lit("")).alias("spans"), n("live").alias("n_live"), n("widely").alias("n_example"))


def _mask(text: str, spans) -> str:
    out = list(text)
    for s in spans:
        out[s["value_at"]:s["end"]] = "*" * (s["end"] - s["value_at"])
    return "".join(out)


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
             repo_col: str = "doc_id", widely: int = 3) -> DataFrame:
    """``docs`` with every character of a live secret's value replaced by an asterisk; lengths and
    rows stay, widely copied examples and null texts too."""
    found = candidates(docs, id_col, text_col, owner_col, repo_col)
    live = judged(found, widely).select("_k1", "_k2", F.filter("all", lambda s: s["live"]).alias("_live")).where("size(_live) > 0")
    live = written(live.select("_k1", "_k2", F.transform("_live", lambda s: F.struct(
        s["value_at"].alias("value_at"), s["end"].alias("end"))).alias("_live")), "live")

    @F.pandas_udf("string")
    def mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_mask(t, s) if s is not None and len(s) else t for t, s in zip(texts, spans)], dtype=object)

    names = [F.col(f"`{c}`") for c in (id_col, owner_col, repo_col, text_col)]
    cast = [names[0], names[1].cast("string"), names[2].cast("string"), names[3]]
    keyed = docs.withColumns({"_k1": F.xxhash64(*cast), "_k2": F.xxhash64(F.lit("second"), *cast)})
    out = keyed.join(live, ["_k1", "_k2"], "left").withColumn(text_col, mask(names[3], F.col("_live")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
