"""Conversation structure repair: the cheapest edits by a run-length min-plus DP.

A conversation's rows become symbols (role initial, fault), and equal consecutive
symbols one run. A symbol's step is a 4 x 4 min-plus matrix over the states of
``(s?(ua)+)?``; a run advances the cost vector by cached binary powers of it. The
vectors at the run ends, computed backwards, tell the cheapest total, and the edits
are unrolled forwards, the ASCII-least one of those that stay on a cheapest way.

No conversation is gathered whole with its texts: identical rows are counted first,
the rows are range-partitioned in order, so a long conversation lies in several tasks,
and each task turns its part into fragments of bounded size. Per conversation only the
fragments' runs meet, a few bytes each (less than the audit, which is a cell of the
result); texts are repaired a fragment at a time and hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from skuflow.llm.common import row_key, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# white space of the contract: [\x20\x09-\x0D]
SPACE = " \t\n\x0b\x0c\r"
FRAGMENT_ROWS, FRAGMENT_CHARS = 4096, 1 << 22
FAR = 1 << 60
# states: nothing yet, after s, after u, after a; the state after each state's only legal u or a
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LETTER = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}
END = (0, FAR, FAR, 0)
Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


# --- damage -----------------------------------------------------------------


def damaged(chats: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by crc32(``conv_id:turn``) % 20: 0 drops the row,
    1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes it a user's. Null
    roles and texts, and null ids and turns in the hashed key, count as one space."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = chats.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fate.alias("_fate")).where("_fate != 0")
    text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fate") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


# --- the DP -------------------------------------------------------------------


def _then(m: Matrix, v: Vector) -> Vector:
    return tuple(min(a + b for a, b in zip(row, v, strict=True)) for row in m)


def _product(m: Matrix, n: Matrix) -> Matrix:
    return tuple(zip(*(_then(m, col) for col in zip(*n, strict=True)), strict=True))


def _inserted(v: Vector) -> Vector:
    """Cheapest cost from every state when rows may be inserted first (two at most pay)."""
    for _ in range(2):
        v = tuple(min(v[q], INSERT + v[NEXT[q]]) for q in range(4))
    return v


def moves(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of one row; ``symbol`` is its initial and ``t`` if it is truncated, or X."""
    out = [("D", DELETE, state)]
    if symbol != "X":
        more = TRUNCATED if symbol.endswith("t") else 0
        if symbol[0] == LETTER[state]:
            out.append(("K", KEEP + more, NEXT[state]))
        elif symbol[0] == "s" and state == START:
            out.append(("K", KEEP + more, SYSTEM))
        out.append(("R", REROLE + more, NEXT[state]))
    return out


@lru_cache(maxsize=4096)
def power(symbol: str, k: int) -> Matrix:
    """The min-plus matrix of 2**k rows of ``symbol``, inserts before each included."""
    if k:
        half = power(symbol, k - 1)
        return _product(half, half)
    step = []
    for q in range(4):
        row = [FAR] * 4
        at, paid = q, 0
        for _ in range(3):
            for _, cost, then in moves(symbol, at):
                row[then] = min(row[then], paid + cost)
            at, paid = NEXT[at], paid + INSERT
        step.append(tuple(row))
    return tuple(step)


def advanced(symbol: str, n: int, after: Vector) -> Vector:
    """Cost vector before ``n`` rows of ``symbol``, from the one after them."""
    k = 0
    while n:
        if n & 1:
            after = _then(power(symbol, k), after)
        n, k = n >> 1, k + 1
    return after


def collapsed(runs: list[tuple[str, int]]) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []
    for symbol, n in runs:
        if out and out[-1][0] == symbol:
            out[-1] = (symbol, out[-1][1] + n)
        elif n:
            out.append((symbol, n))
    return out


def audit(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair of the runs, ties ASCII-least."""
    runs = collapsed(runs)
    ends = [_inserted(END)]
    for symbol, n in reversed(runs):
        ends.append(advanced(symbol, n, ends[-1]))
    ends.reverse()
    state, out = START, []
    for (symbol, n), after in zip(runs, ends[1:], strict=True):
        if symbol == "X":
            out.append("D" * n)  # deleting first never costs more, and D is the least edit
            continue
        vectors = [after]  # cost after each row of the run, last first
        for _ in range(n - 1):
            vectors.append(_then(power(symbol, 0), vectors[-1]))
        left = _then(power(symbol, 0), vectors[-1])[state]
        for v in reversed(vectors):
            while True:
                by_row = {e: (c, q) for e, c, q in moves(symbol, state) if c + v[q] == left}
                if "D" in by_row or not _pays(symbol, v, state, left):
                    edit = min(by_row)
                    cost, state = by_row[edit]
                    out.append(edit)
                    left -= cost
                    break
                out.append("I")
                state, left = NEXT[state], left - INSERT
    while END[state]:
        out.append("I")
        state = NEXT[state]
    return ends[0][START], "".join(out)


def _pays(symbol: str, after: Vector, state: int, left: int) -> bool:
    """Whether inserting a row before this one stays on a cheapest way."""
    return _then(power(symbol, 0), after)[NEXT[state]] + INSERT == left


# --- fragments ------------------------------------------------------------------


def _position() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _marked(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number ``_m`` and ``_first``: whether no earlier row has that role and text."""
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("_m")).withColumns(
        dict(zip(("_k1", "_k2"), row_key("role", "text"), strict=True)))
    earliest = counted.groupBy("conv_id", "_k1", "_k2").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("_least"))
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a._k1") == F.col("b._k1")) & (F.col("a._k2") == F.col("b._k2"))
    out = counted.alias("a").join(earliest.alias("b"), same).select("a.*", F.col("a.turn").eqNullSafe(F.col("b._least.turn")).alias("_first"))
    bare = F.trim(F.col("text"), F.lit(SPACE))
    fault = (F.when(bare == "", "b").when(~F.col("_first"), "d")
             .when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "").otherwise("t"))
    return out.select("conv_id", "turn", "role", "text", "_m", fault.alias("_fault"))


FRAGMENT = ("_part int, _seq long, _syms string, _runs array<long>, _roles array<string>, _texts array<string>, _counts array<long>, "
            "_blank long, _dup long, _cut long, _illegal long, _head string, _tail string, _turn_from long, _turn_to long, _turns long")


class _Fragment:
    def __init__(self) -> None:
        self.runs: list[tuple[str, int]] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.copies: list[int] = []
        self.blank = self.dup = self.cut = self.illegal = self.turns = self.chars = 0
        self.head = self.tail = self.low = self.high = None

    def add(self, turn: int | None, role: str, text: str, m: int, fault: str) -> None:
        first = role[:1]
        if self.tail is None:
            self.head = first
        elif self.tail + first not in LEGAL:
            self.illegal += 1
        self.tail = first
        self.illegal += (m - 1) * (first + first not in LEGAL)
        if turn is not None and turn != self.high:
            self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn
        if fault == "b":
            self.blank += m
            self.runs.append(("X", m))
        elif fault == "d":
            self.dup += m
            self.runs.append(("X", m))
        else:
            self.cut += fault == "t"
            self.dup += m - 1
            self.runs += [((first if first in INITIALS else "o") + fault, 1), ("X", m - 1)]
        # only a row that may stay keeps its text; the others are deleted in any case
        stays = fault in ("", "t")
        self.roles.append(role if stays else "")
        self.texts.append(text if stays else "")
        self.copies.append(m)
        self.chars += len(text)

    def row(self, part: int, seq: int) -> tuple:
        runs = collapsed(self.runs)
        return (part, seq, ",".join(s for s, _ in runs), [n for _, n in runs], self.roles, self.texts, self.copies, self.blank, self.dup,
                self.cut, self.illegal, self.head, self.tail, self.low, self.high, self.turns)


LEGAL, INITIALS = ("su", "ua", "au"), ("s", "u", "a")


def _fragments(part: int, batches: Iterator[pa.RecordBatch], schema: pa.Schema, rows: int, chars: int) -> Iterator[pa.RecordBatch]:
    seq, conv, now = 0, None, None
    out: list[tuple] = []
    held = 0

    def batch() -> pa.RecordBatch:
        nonlocal held
        cols = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
        out.clear()
        held = 0
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    def close() -> None:
        nonlocal seq, held
        out.append((conv, *now.row(part, seq)))
        seq, held = seq + 1, held + now.chars + 256

    for b in batches:
        for c, turn, role, text, m, fault in zip(*(x.to_pylist() for x in b.columns), strict=True):
            if now is not None and (c != conv or len(now.roles) >= rows or now.chars >= chars):
                close()
                now = None
                if held >= chars:
                    yield batch()
            if now is None:
                now, conv = _Fragment(), c
            now.add(turn, role, text, m, fault)
    if now is not None:
        close()
    if out:
        yield batch()


# --- the repair -------------------------------------------------------------------


def _decide(parts: list) -> dict:
    """A conversation's digest and its fragments' edits, from their summaries in order."""
    runs: list[tuple[str, int]] = []
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    tail = low = high = None
    for p in parts:
        runs += zip(p["_syms"].split(","), p["_runs"], strict=True)
        total["blank"] += p["_blank"]
        total["duplicate"] += p["_dup"]
        total["truncated"] += p["_cut"]
        total["illegal"] += p["_illegal"] + (tail is not None and tail + p["_head"] not in LEGAL)
        tail = p["_tail"]
        if p["_turns"]:
            # a turn may go on in the next fragment
            total["turns"] += p["_turns"] - (p["_turn_from"] == high)
            low, high = p["_turn_from"] if low is None else low, p["_turn_to"]
    cost, edits = audit(runs)
    # inserts go with the row after them; those at the end with the last fragment
    segments, at = [], 0
    for i, p in enumerate(parts):
        rows, start = sum(p["_runs"]), at
        while rows:
            rows -= edits[at] != "I"
            at += 1
        segments.append({"part": p["_part"], "seq": p["_seq"], "edits": edits[start:] if i == len(parts) - 1 else edits[start:at]})
    state = START
    for p, s in zip(parts, segments, strict=True):
        s["state"] = state
        state = _after(state, s["edits"], _initials(p))
    gaps = high - low + 1 - total.pop("turns") if high is not None else 0
    return {"gaps": gaps, **total, "cost": cost, "audit": edits, "segments": segments}


def _initials(part: dict) -> Iterator[str]:
    for symbol, n in zip(part["_syms"].split(","), part["_runs"], strict=True):
        for _ in range(n):
            yield symbol[0]


def _after(state: int, edits: str, initials: Iterator[str]) -> int:
    for e in edits:
        first = next(initials) if e != "I" else ""
        if e == "K" and first == "s":
            state = SYSTEM
        elif e != "D":
            state = NEXT[state]
    return state


def _text_of(state: int, edits: str, roles: list[str], texts: list[str], copies: list[int]) -> str:
    """The repaired rows of a fragment, each with a newline behind it."""
    out = []
    rows = ((r, t) for r, t, m in zip(roles, texts, copies, strict=True) for r, t in [(r, t)] + [("", "")] * (m - 1))
    for e in edits:
        role, text = next(rows) if e != "I" else ("", "")
        if e == "D":
            continue
        if e == "K":
            out.append(f"{role}:{text}\n")
            state = SYSTEM if role[:1] == "s" else NEXT[state]
        else:
            out.append(f"{ROLE[LETTER[state]]}:{text}\n")
            state = NEXT[state]
    return "".join(out)


DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
SEGMENTS = "array<struct<part:int,seq:long,edits:string,state:int>>"


def repaired(rows: DataFrame, all_ids: DataFrame | None = None, fragment_rows: int = FRAGMENT_ROWS,
             fragment_chars: int = FRAGMENT_CHARS) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``rows`` has ``conv_id, turn, role, text``; null roles and texts count as one space,
    null turns come first, a null id is a conversation of its own. Rows of one turn are
    taken by role, then text; equal rows stand side by side, all but the first being
    duplicates. Ids of ``all_ids`` without rows get zeros, an empty audit and the empty
    string's hash. Other columns are not read, whatever their names; very long texts go
    one fragment at a time; an empty table gives none. The hash of a conversation is one
    chain over its repaired text, so its bytes stream through one task, a fragment in
    memory at a time.
    """
    spark = rows.sparkSession
    space = F.lit(" ")
    clean = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
                        F.coalesce("text", space).alias("text"))
    marked = written(_marked(clean), "marked-turns")
    id_type = marked.schema["conv_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = marked.repartitionByRange(parts, *_position()).sortWithinPartitions(*_position())

    shape = StructType.fromDDL(f"conv_id {id_type}, {FRAGMENT}")
    arrow = to_arrow_schema(shape)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _fragments(TaskContext.get().partitionId(), batches, arrow, fragment_rows, fragment_chars)

    pieces = written(ordered.mapInArrow(cut, shape), "turn-fragments")
    summary = ["_part", "_seq", "_syms", "_runs", "_blank", "_dup", "_cut", "_illegal", "_head", "_tail", "_turn_from", "_turn_to", "_turns"]
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*summary))).alias("_parts"))

    judged = StructType.fromDDL(f"conv_id {id_type}, {DIGEST}, segments {SEGMENTS}")
    judged_arrow = to_arrow_schema(judged)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pylist([{"conv_id": c, **_decide(p)} for c, p in zip(*(x.to_pylist() for x in b.columns), strict=True)],
                                             schema=judged_arrow)

    verdicts = written(whole.mapInArrow(decide, judged), "turn-verdicts")
    edits = verdicts.select(F.explode("segments").alias("_s")).select(
        F.col("_s.part").alias("_part"), F.col("_s.seq").alias("_seq"), F.col("_s.edits").alias("_edits"), F.col("_s.state").alias("_state"))

    @F.pandas_udf("string")
    def text_of(state: pd.Series, edits_: pd.Series, roles: pd.Series, texts: pd.Series, copies: pd.Series) -> pd.Series:
        return pd.Series([_text_of(*x) for x in zip(state, edits_, roles, texts, copies, strict=True)], dtype="object")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chain, kind, held = None, None, None, ""

        def done() -> pa.RecordBatch:
            # the last newline is no separator
            chain.update(held[:-1].encode("utf-8"))
            return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([chain.hexdigest()])], ["conv_id", "repaired_sha256"])

        for b in batches:
            kind = b.schema.field(0).type
            for c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if chain is not None and c != conv:
                    yield done()
                    chain = None
                if chain is None:
                    conv, chain, held = c, hashlib.sha256(), ""
                if t:
                    chain.update(held.encode("utf-8"))
                    held = t
        if chain is not None:
            yield done()

    out = pieces.join(edits, ["_part", "_seq"]).select(
        "conv_id", "_part", "_seq", text_of("_state", "_edits", "_roles", "_texts", "_counts").alias("_out"))
    hashes = (out.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "_part", "_seq").select("conv_id", "_out")
              .mapInArrow(hashed, f"conv_id {id_type}, repaired_sha256 string"))
    ids = (rows if all_ids is None else all_ids).select("conv_id").distinct()
    digests = verdicts.drop("segments").withColumnRenamed("conv_id", "_c")
    same, known = F.col("conv_id").eqNullSafe(F.col("_c")), F.col("conv_id").eqNullSafe(F.col("_h"))
    both = ids.join(digests, same, "left").join(hashes.withColumnRenamed("conv_id", "_h"), known, "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
