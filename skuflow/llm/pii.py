"""PII by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Candidate spans come from regular expressions over the whole text. Regex, gazetteer
and context labelers vote on each candidate (for, against, abstain). Expectation-
maximisation over the counts of vote patterns estimates each labeler's reliability
and each pattern's probability of being personal data. Those probabilities train
the final classifier, a logistic model over span features, whose weights are
written into the plan as plain expressions. All of it is DataFrame functions.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import once, written

# Base patterns, in the order of kinds. Possessive forms of the stated ones: a run
# that fails from its first character fails from every later one, so starting inside it is skipped.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
BASE_KINDS = tuple(PATTERNS)
# The method's own candidate kinds.
MORE = {
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])",
    "local_phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20})?",
}
KINDS = (*BASE_KINDS, *MORE)
# A text without this cannot hold the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

# Gazetteers and context words of the labelers.
TLDS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info", "it", "nl", "ch", "at", "ca", "au", "us", "co")
FIRST_NAMES = (
    "Alexander", "Alice", "Amanda", "Andrea", "Andrew", "Anna", "Anne", "Anthony", "Antonio", "Barbara", "Brian", "Carlos", "Carmen", "Carol",
    "Charles", "Charlotte", "Christian", "Christine", "Christopher", "Claire", "Claudia", "Daniel", "David", "Deborah", "Dorothy", "Edward",
    "Elena", "Elizabeth", "Emily", "Emma", "Eric", "Eva", "Felix", "Frank", "Franz", "George", "Hannah", "Hans", "Helen", "Henry", "Isabel",
    "Jack", "Jacques", "James", "Jan", "Jane", "Jean", "Jennifer", "Jessica", "Joan", "John", "Jonas", "Jorge", "Jose", "Joseph", "Juan", "Julia",
    "Julie", "Karen", "Karl", "Katharina", "Kevin", "Klaus", "Laura", "Lena", "Linda", "Lisa", "Louis", "Lucas", "Lucia", "Luis", "Lukas",
    "Manuel", "Margaret", "Maria", "Marie", "Mark", "Martin", "Mary", "Matthew", "Max", "Michael", "Michel", "Miguel", "Monica", "Nancy",
    "Nicolas", "Olivia", "Pablo", "Patricia", "Patrick", "Paul", "Pedro", "Peter", "Philippe", "Pierre", "Rachel", "Richard", "Robert",
    "Sandra", "Sara", "Sarah", "Simon", "Sophie", "Stefan", "Stephen", "Steven", "Susan", "Thomas", "Ursula", "Victoria", "William", "Wolfgang")
# Lengths of account numbers by country.
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27,
                "HR": 21, "HU": 28, "IE": 22, "IT": 27, "LT": 20, "LU": 20, "LV": 21, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
                "SE": 24, "SI": 19, "SK": 24}
CUES = r"(?i)(?:mail|contact|write|phone|tel|call|mobile|fax|card|visa|iban|account|ssn|social security|name|dear|ip|address|host)\W{0,12}$"
ANTI_CUES = r"(?i)(?:version|isbn|issn|order|invoice|ticket|sku|part no|serial|rfc|section|figure|page|id|no)\W{0,6}$"
BEFORE = 24   # characters before a span that context labelers read
# Labelers, and how far each is trusted at the start: the share of its votes that are for a true span, for a
# false one, and the number of votes that this opinion counts as against the corpus.
LABELERS = {"checksum": (0.999, 0.02, 4000), "rule": (0.95, 0.8, 200), "gazetteer": (0.85, 0.4, 200), "cue": (0.9, 0.1, 400),
            "shape": (0.75, 0.5, 200)}
STEP = 256    # matches whose places are added up at a time


def _spans(text: Column, kind: str, pattern: str, least: int = 0) -> Column:
    """Matches of the pattern as (rank, start, end, value, before): leftmost, non-overlapping.

    The pieces between the matches and the matches themselves give the places in code
    points. Places are added up within steps of matches and over the steps, and the text
    before a match is put together from the pieces just before it, so the work stays in
    proportion to the text. Matches shorter than ``least`` are left out.
    """
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))

    def sums(lengths: Column, start: Column) -> Column:
        more = F.aggregate(lengths, F.array(start), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.slice(more, F.lit(2), F.size(lengths))

    # each let() evaluates a value once and hands it to the lambda, where it is used per element
    def let(value: Column, use) -> Column:  # noqa: ANN001
        return F.element_at(F.transform(F.array(value), use), 1)

    def placed(p: Column) -> Column:
        n = F.size(p["found"])
        lengths = F.zip_with(F.slice(p["gaps"], F.lit(1), n), p["found"], lambda g, v: F.length(g) + F.length(v))
        steps = let(lengths, lambda ls: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / STEP).cast("int")),
                                                    lambda i: F.slice(ls, i * STEP + 1, F.lit(STEP))))

        def ends(st: Column) -> Column:
            totals = F.transform(st, lambda x: F.aggregate(x, F.lit(0), lambda acc, n_: acc + n_))
            starts = F.concat(F.array(F.lit(0)), sums(F.slice(totals, F.lit(1), F.size(st) - 1), F.lit(0)))
            return F.flatten(F.zip_with(st, starts, sums))

        return let(steps, ends)

    def spans(p: Column) -> Column:
        n = F.size(p["found"])
        pairs = F.zip_with(F.sequence(F.lit(1), n), placed(p), lambda i, e: F.struct(i.alias("i"), e.alias("end")))
        # arrays are numbered from 1; a card's digit runs are many, so the short ones go first
        kept = F.filter(pairs, lambda x: F.length(F.get(p["found"], x["i"] - 1)) >= least) if least else pairs

        def full(x: Column) -> Column:
            value, first = F.get(p["found"], x["i"] - 1), F.greatest(F.lit(1), x["i"] - BEFORE // 2)
            earlier = F.zip_with(F.slice(p["gaps"], first, x["i"] - first), F.slice(p["found"], first, x["i"] - first),
                                 lambda g, v: F.concat(g, v))
            before = F.concat(F.array_join(earlier, ""), F.get(p["gaps"], x["i"] - 1))
            return F.struct(F.lit(KINDS.index(kind)).alias("rank"), (x["end"] - F.length(value)).alias("start"), x["end"].alias("end"),
                            value.alias("value"), F.right(before, F.lit(BEFORE)).alias("before"))

        return F.when(n > 0, F.transform(kept, full)).otherwise(none)

    none = F.array().cast("array<struct<rank:int,start:int,end:int,value:string,before:string>>")
    held = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike(pattern)
    return F.when(held, let(parts, spans)).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    d = F.reverse(digits(value))
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, i: acc + F.when(
        i % 2 == 1, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(d, i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number's check digits are right: letters count 10 to 35, the first four characters go last."""
    v = F.translate(value, " ", "")
    turned = F.concat(F.substring(v, 5, 40), F.substring(v, 1, 4))
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).when(
        c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def base_ok(rank: Column, value: Column) -> Column:
    """Whether a match of a base kind meets its condition."""
    n = F.length(digits(value))
    return (F.when(rank == 0, F.lit(True))
            .when(rank == 1, value.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$"))
            .when(rank == 2, (n >= 12) & (n <= 19) & F.when((n >= 12) & (n <= 19), luhn(value)).otherwise(F.lit(False)))
            .when(rank == 3, (n >= 9) & (n <= 15)).otherwise(F.lit(False)))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the candidate spans with base verdict, votes and features (a written table).

    A digit run too short for a card is no candidate; every other match is one.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    # a digit run too short for a card is no candidate; every other match is one
    spans = F.concat(*[_spans(F.col("_text"), k, p, 12 if k == "card" else 0) for k, p in {**PATTERNS, **MORE}.items()])
    rows = rows.select("_id", once(spans, "s"))
    value, rank, before = (lambda s: s["value"]), (lambda s: s["rank"]), (lambda s: s["before"])
    tld = rf"\.(?:{'|'.join(TLDS)})$"
    first_name = rf" (?:{'|'.join(FIRST_NAMES)})(?: |$)"
    lengths = F.create_map(*[F.lit(x) for kv in IBAN_LENGTHS.items() for x in kv])

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    def judged(s: Column) -> Column:
        v, r, b, n = value(s), rank(s), before(s), F.length(digits(value(s)))
        d = digits(v)
        ok = base_ok(r, v)
        same = v.rlike(r"^(.)\1{7,}$") | (r.isin(2, 4, 6) & d.rlike(r"^(.)\1{6,}$"))
        iban = F.when(r == 5, mod97(v))
        # fixed values: area, group and serial numbers that are never given out; number plan of ten-digit numbers
        ssn = (r == 4) & ~v.rlike(r"^(?:000|666|9)|-00-|-0000$")
        plan = (r == 6) & d.rlike(r"^[2-9][0-9]{2}[2-9]")
        country = F.when(r == 5, F.coalesce(F.get(F.map_values(F.map_filter(lengths, lambda k, _: k == F.substring(v, 1, 2))), 0), F.lit(0))
                         == F.length(F.translate(v, " ", "")))
        return F.struct(
            r.alias("rank"), s["start"].alias("start"), s["end"].alias("end"), ok.alias("base"),
            F.when(r == 5, vote(iban, ~iban)).when((r == 2) & (n >= 12) & (n <= 19), vote(ok, ~ok)).otherwise(0).alias("checksum"),
            F.when(r == 4, vote(ssn, ~ssn)).when(r == 6, vote(plan, ~plan)).when(r == 1, vote(ok, ~ok)).otherwise(0).alias("rule"),
            F.when(r == 0, vote(v.rlike(tld), ~v.rlike(tld))).when(r == 5, vote(country, ~country))
            .when(r == 7, vote(v.rlike(first_name), F.lit(False))).otherwise(0).alias("gazetteer"),
            vote(b.rlike(CUES), b.rlike(ANTI_CUES)).alias("cue"),
            F.when(same, -1).when(r == 1, vote(F.lit(False), v.rlike(r"^0\.|^[0-9]\.[0-9]\.[0-9]\.[0-9]$")))
            .when(r == 2, vote((n >= 13) & (n <= 16), n > 16)).when(r.isin(3, 6), vote(v.rlike("[ ()-]"), F.lit(False)))
            # a number that goes on from a word or another number, or a title in front of one word only, is rather something else
            .when(r.isin(4, 5), vote(b.rlike(r"(?:^|[\s:(#])$"), b.rlike(r"[0-9A-Za-z./_-]$")))
            .when(r == 7, vote(v.rlike(r" [A-Z][a-z]+ [A-Z]"), F.lit(False))).otherwise(0).alias("shape"),
            F.least(F.lit(5), F.floor(n / 4)).cast("int").alias("length"),
            F.when(b.rlike(r"[A-Za-z]\W*$"), 1).otherwise(0).alias("after_word"))

    return written(rows.select("_id", F.transform("s", judged).alias("spans")), "pii")


def fit_em(patterns: list[tuple[tuple[int, ...], int, int]], rounds: int = 50) -> tuple[dict, dict]:
    """Two-class EM over (votes, rank, count) rows: posterior by (votes, rank), reliabilities by labeler.

    Votes are independent given the class; a labeler that abstains says nothing. Each kind has
    its own prior, which counts as ten spans of either class. A labeler's reliability starts at,
    and is smoothed towards, the trust stated for it.
    """
    trust = list(LABELERS.values())
    ranks = {r for _, r, _ in patterns}
    prior = {r: 0.5 for r in ranks}
    like = [{1: t[0], 0: t[1]} for t in trust]  # the share of votes that are for, by class
    post: dict = {}
    for _ in range(rounds):
        table = [{c: [like0 * t[2], t[2]] for c, like0 in ((1, t[0]), (0, t[1]))} for t in trust]
        by_rank = {r: [10.0, 10.0] for r in ranks}
        for votes, r, n in patterns:
            w = [math.log(1 - prior[r]), math.log(prior[r])]
            for c in (0, 1):
                w[c] += sum(math.log(like[i][c] if v > 0 else 1 - like[i][c]) for i, v in enumerate(votes) if v)
            p = 1 / (1 + math.exp(max(-60.0, min(60.0, w[0] - w[1]))))
            post[votes, r] = p
            for c, q in ((0, 1 - p), (1, p)):
                by_rank[r][c] += n * q
                for i, v in enumerate(votes):
                    if v:
                        table[i][c][0] += n * q * (v > 0)
                        table[i][c][1] += n * q
        prior = {r: x[1] / sum(x) for r, x in by_rank.items()}
        like = [{c: min(0.999, max(0.001, x[0] / x[1])) for c, x in t.items()} for t in table]
    reliability = {name: {"finds": like[i][1], "false_alarm": like[i][0]} for i, name in enumerate(LABELERS)}
    return post, reliability


FEATURES = ("rank", "length", "after_word", *LABELERS)


RIDGE = 0.1


def fit_classifier(cells: list[tuple[tuple[int, ...], float, int]], rounds: int = 30) -> tuple[float, list[dict[int, float]]]:
    """Logistic regression on (features, probability, count) cells: bias and weight by feature value.

    The bias is the log odds of all spans; the weights are fitted to the probabilities by
    Newton's method, with a small ridge, so features that say the same share their weight.
    """
    yes = sum(n * p for _, p, n in cells) + 1
    no = sum(n * (1 - p) for _, p, n in cells) + 1
    bias = math.log(yes / no)
    places = {key: k for k, key in enumerate(sorted({(i, v) for f, _, _ in cells for i, v in enumerate(f)}))}
    x = np.zeros((len(cells), len(places)))
    for row, (f, _, _) in enumerate(cells):
        x[row, [places[i, v] for i, v in enumerate(f)]] = 1
    want, count = np.array([p for _, p, _ in cells]), np.array([float(n) for _, _, n in cells])
    w = np.zeros(len(places))
    for _ in range(rounds if cells else 0):
        p = 1 / (1 + np.exp(-np.clip(bias + x @ w, -30, 30)))
        slope = x.T @ (count * (want - p)) - RIDGE * w
        curve = (x * (count * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + RIDGE * np.eye(len(w))
        w += np.clip(np.linalg.solve(curve, slope), -2, 2)
    out: list[dict[int, float]] = [{} for _ in FEATURES]
    for (i, v), k in places.items():
        out[i][v] = float(w[k])
    return bias, out


def span_model(found: DataFrame) -> tuple[float, list[dict[int, float]], dict]:
    """Fit labeler reliabilities and the span classifier on all candidates.

    Only counts by feature value come to the driver: at most 8 kinds * 6 lengths * 2 * 3^5 cells.
    """
    s = found.select(F.explode("spans").alias("s")).select(*[F.col(f"s.{f}") for f in FEATURES])
    rows = [(tuple(r[f] for f in FEATURES), r["count"]) for r in s.groupBy(*FEATURES).count().collect()]
    votes: dict = {}
    for f, n in rows:
        key = (f[3:], f[0])
        votes[key] = votes.get(key, 0) + n
    post, reliability = fit_em(sorted((v, r, n) for (v, r), n in votes.items()))
    bias, odds = fit_classifier([(f, post[f[3:], f[0]], n) for f, n in sorted(rows)])
    return bias, odds, reliability


def probability(span: Column, bias: float, odds: list[dict[int, float]]) -> Column:
    z = F.lit(float(bias))
    for name, table in zip(FEATURES, odds):
        term = F.lit(0.0)
        for v, w in sorted(table.items()):
            term = F.when(span[name] == v, F.lit(float(w))).otherwise(term)
        z = z + term
    return 1 / (1 + F.exp(-z))


def spans_column(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: base counts and digest, and all spans (base ones and those the classifier accepts).

    A candidate that failed a base condition is never accepted under its base kind.
    Null and empty texts have no span; repeated rows are each returned; extra columns
    are ignored; without any candidate the model is empty and nothing is added.
    Very long texts take time in proportion to their length. Spans that start together are
    listed in the order of their kinds; an empty table gives no row.
    """
    found = candidates(docs, id_col, text_col)
    bias, odds, _ = span_model(found)
    base = F.filter("spans", lambda s: s["base"])
    more = F.filter("spans", lambda s: ~s["base"] & (s["rank"] >= len(BASE_KINDS)) & (probability(s, bias, odds) >= threshold))
    # an added span that lies within a base one says nothing new
    rows = found.select("_id", once(base, "b"), more.alias("m"))
    new = F.filter("m", lambda s: ~F.exists("b", lambda t: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    rows = rows.select("_id", "b", new.alias("m"))
    of_rank = lambda r: F.size(F.filter("b", lambda s: s["rank"] == r)).cast("long")
    count = [of_rank(r).alias(f"n_{k}") for r, k in enumerate(BASE_KINDS)]
    return rows.select(F.col("_id").alias(id_col), *count, F.sha2(spans_column(F.col("b")), 256).alias("base_sha256"),
                       spans_column(F.concat("b", "m")).alias("spans"), F.size("m").cast("long").alias("n_added"))
