"""Operator 12 against brute force: every edit sequence of short rows, plain loops over whole tables."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from skuflow.llm import conversations as C
from skuflow.llm import queries

from helpers import SF

LEGAL, PREFIX = re.compile(r"(s?(ua)+)?\Z"), re.compile(r"s?(ua)*u?\Z")
SYMBOLS = ["s", "u", "a", "o", "st", "ut", "at", "ot", "X"]


def cheapest(symbols):
    """Least (cost, audit) over all edit sequences within the cost of deleting everything."""
    best = [(4 * len(symbols) + 1, "")]

    def go(i, made, cost, edits):
        if (cost, "") > best[0]:
            return
        if i == len(symbols) and LEGAL.match(made):
            best[0] = min(best[0], (cost, edits))
        for x in "ua":
            if PREFIX.match(made + x):
                go(i, made + x, cost + 3, edits + "I")
        if i < len(symbols):
            s = symbols[i]
            go(i + 1, made, cost + 4, edits + "D")
            if s != "X":
                more = 3 * s.endswith("t")
                if PREFIX.match(made + s[0]):
                    go(i + 1, made + s[0], cost + more, edits + "K")
                for x in "ua":
                    if PREFIX.match(made + x):
                        go(i + 1, made + x, cost + 3 + more, edits + "R")

    go(0, "", 0, "")
    return best[0]


@lru_cache(maxsize=None)
def stepwise(symbols):
    """Least (cost, audit, made) by a plain DP over rows, for rows too many to enumerate."""
    states = {"": (0, "", "")}

    def insert(states):
        for _ in range(2):
            for k, (c, e, made) in list(states.items()):
                for x in "ua":
                    if PREFIX.match(made + x):
                        key = (made + x)[-1]
                        cand = (c + 3, e + "I", made + x)
                        if key not in states or cand < states[key]:
                            states[key] = cand
        return states

    # backwards costs are not needed: ties are kept by comparing whole audits, all prefixes of equal rows
    states = insert(states)
    for s in symbols:
        after = {}
        for key, (c, e, made) in states.items():
            options = [(4, "D", made)]
            if s != "X":
                more = 3 * s.endswith("t")
                options += [(more, "K", made + s[0])] if PREFIX.match(made + s[0]) else []
                options += [(3 + more, "R", made + x) for x in "ua" if PREFIX.match(made + x)]
            for cost, edit, m in options:
                cand = (c + cost, e + edit, m)
                k = m[-1:] if m else ""
                if k not in after or cand < after[k]:
                    after[k] = cand
        states = insert(after)
    return min(v for v in states.values() if LEGAL.match(v[2]))


def test_all_short_conversations():
    for n in range(4):
        for symbols in itertools.product(SYMBOLS, repeat=n):
            assert C.audit([(s, 1) for s in symbols]) == cheapest(symbols), symbols
    r = random.Random(2)
    for _ in range(60):
        symbols = tuple(r.choice(SYMBOLS) for _ in range(6))
        assert C.audit([(s, 1) for s in symbols]) == cheapest(symbols), symbols


def test_runs_equal_single_rows():
    r = random.Random(3)
    for _ in range(200):
        runs = [(r.choice(SYMBOLS), r.randrange(1, 9)) for _ in range(r.randrange(6))]
        assert C.audit(runs) == C.audit([(s, 1) for s, n in runs for _ in range(n)]) == stepwise(tuple(s for s, n in runs for _ in range(n)))[:2]


def test_a_long_run_by_powers():
    # every second u becomes an a, the last one gets an a behind it
    cost, edits = C.audit([("u", 5001), ("X", 20000)])
    assert (cost, len(edits), edits.count("R"), edits.count("I")) == (2500 * 3 + 3 + 80000, 25002, 2500, 1)


def brute(rows):
    """The whole contract by plain loops."""
    convs = {}
    for c, t, role, text in rows:
        kept = convs.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        kept += [(t, role, text)] * (2 if fate == 3 else 1)
    out = {}
    for c, kept in convs.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, symbols, n = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in kept:
            solid = re.findall("[^\x20\x09-\x0d]", text)
            first = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not solid:
                n["blank"] += 1
                symbols.append("X")
            elif (role, text) in seen:
                n["duplicate"] += 1
                symbols.append("X")
            elif solid[-1] not in ".!?":
                n["truncated"] += 1
                symbols.append(first + "t")
            else:
                symbols.append(first)
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, made = stepwise(tuple(symbols))
        lines, source, roles = [], iter(kept), iter(made)
        for e in audit:
            _, role, text = next(source) if e != "I" else (None, "", "")
            if e != "D":
                letter = next(roles)
                lines.append(f"{role if e == 'K' else {'u': 'user', 'a': 'assistant'}[letter]}:{text}")
        out[c] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def result(df):
    rows = df.collect()
    got = {r["conv_id"]: tuple(r[c] for c in COLS) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_op12_over_its_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.op12_conversation_repair(spark, sf)) == brute(rows)


def odd_chats():
    r = random.Random(6)
    texts = ["Yes.", "No", "", " \n", None, "Yes.", "really? ", "a\x0bb!", "x　", "long " * 3000 + "end.", "line\nbreak."]
    roles = ["user", "assistant", "system", None, "", "tool", "User", "user", "assistant"]
    rows = [(r.choice([None, 1, 2, 3, 4, 5, 6]), r.choice([None, 0, 1, 2, 3, 5, 8, 9]), r.choice(roles), r.choice(texts)) for _ in range(300)]
    rows += [(77, i, "user" if i % 2 == 0 else "assistant", f"turn {i}." if i % 7 else "turn") for i in range(400)]
    return rows + [(78, 3, "user", "again.")] * 40 + [(79, None, "user", "Hm.")] * 3


@pytest.mark.parametrize("fragment_rows,fragment_chars", [(C.FRAGMENT_ROWS, C.FRAGMENT_CHARS), (3, 1 << 20), (50, 40)])
def test_odd_conversations_in_fragments(spark, fragment_rows, fragment_chars):
    rows = odd_chats()
    chats = spark.createDataFrame([(*x, "s", 1, 2) for x in rows], "conv_id long, turn long, role string, text string, _part string, cost int, _m int").repartition(5)
    got = result(C.repaired(C.damaged(chats), chats.select("conv_id"), fragment_rows, fragment_chars))
    assert got == brute(rows)


def test_empty_and_all_dropped(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repaired(C.damaged(none), none).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(dropped, 0, "user", "Hi.")], none.schema)
    assert result(C.repaired(C.damaged(one), one)) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
