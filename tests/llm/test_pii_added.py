"""Added kinds of personal data: planted spans are found, look-alikes are not; long number tables stay quick."""

import random
import time

from helpers import SF

from skuflow.llm import pii


def iban(r, good=True):
    body = "".join(str(r.randrange(10)) for _ in range(18))
    check = 98 - int(body + "131400") % 97  # D = 13, E = 14
    if not good:
        check = check % 97 + 2 if check % 97 + 2 != check else check - 1
    whole = f"DE{check:02d}{body}"
    return " ".join(whole[i:i + 4] for i in range(0, 22, 4))


def planted(r):
    """(kind, true, text before, span) for 30 of each."""
    out = []
    for i in range(30):
        out += [("ssn", True, "my ssn ", f"{100 + i}-45-67{i:02d}"), ("iban", True, "IBAN ", iban(r)),
                ("name", True, "Dear ", f"Dr. {pii.FIRST_NAMES[i]} Smith"), ("local_phone", True, "call me: ", f"(212) 555-01{i:02d}"),
                ("ssn", False, "part no ", f"{200 + i}-45-67{i:02d}"), ("iban", False, "IBAN ", iban(r, False))]
    return out


def test_planted_spans(spark):
    r = random.Random(9)
    docs = [(x["doc_id"], x["text"] or "") for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = []
    for i, (kind, true, before, span) in enumerate(planted(r)):
        doc, text = docs[i % len(docs)]
        text += f" \U0001F600 {before}"
        want.append((doc, kind, true, len(text), len(text) + len(span)))
        docs[i % len(docs)] = (doc, text + span + ".")
    got = {x["doc_id"]: set(x["spans"].split(",")) for x in pii.pii_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = {}
    for doc, kind, true, a, b in want:
        # a name may be found together with its title only
        found.setdefault((kind, true), []).append(f"{kind}:{a}:{b}" in got[doc])
    hits = {k: sum(v) for k, v in found.items()}
    assert all(n >= 27 for (_, true), n in hits.items() if true), hits
    assert all(n <= 3 for (_, true), n in hits.items() if not true), hits


def test_a_megabyte_of_numbers_ends_in_seconds(spark):
    table = "1,23, " * 170_000 + "card 4111 1111 1111 1111 end"
    df = spark.createDataFrame([(1, table), (2, "x")], "doc_id long, text string")
    start = time.time()
    rows = {x["doc_id"]: x for x in pii.pii_scan(df).collect()}
    assert time.time() - start < 60
    assert rows[1]["n_card"] == 1 and rows[1]["spans"] == f"card:{len(table) - 23}:{len(table) - 4}"


def test_check_digits(spark):
    r = random.Random(4)
    rows = [(iban(r), True) for _ in range(20)] + [(iban(r, False), False) for _ in range(20)] + [("GB82 WEST 1234 5698 7654 32", True)]
    df = spark.createDataFrame(rows, "v string, good boolean")
    assert df.where(pii.mod97(df["v"]) != df["good"]).count() == 0
