"""Property test: the Spark decoder against a small Python model of the
decode policy, on random JSON objects."""

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skuflow.schema import ENVELOPE, TRANSACTION_FIELDS
from skuflow.sources.codec import decode_transactions, quarantine_transactions

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1

NUMBERS = st.one_of(
    st.none(),
    st.integers(min_value=-(2**40), max_value=2**40),
    st.integers(min_value=-(2**70), max_value=2**70),
    st.floats(min_value=-1e12, max_value=1e12, allow_nan=False, allow_infinity=False),
    st.integers(min_value=-1000, max_value=1000).map(str),  # quoted number
    st.sampled_from(["x", True, False]),
)
TEXT = st.one_of(st.none(), st.text(alphabet="abcXYZ-_ 019", max_size=6))
FIELDS = {
    "id": NUMBERS,
    "storeName": TEXT,
    "sku": TEXT,
    "quantity": NUMBERS,
    "type": st.sampled_from([None, "SALE", "RESTOCK", "sale"]),
    "price": st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), st.just("cheap")),
    "timestamp": TEXT,
}
RECORD = st.fixed_dictionaries({}, optional={**FIELDS, "colour": TEXT})


def _integral(v, lo, hi):
    """(value, bad) like a lenient JSON mapper: numbers and numeric text, fractions truncated."""
    if v is None:
        return None, False
    if isinstance(v, bool):
        return None, True
    if isinstance(v, str):
        try:
            v = float(v) if any(c in v for c in ".eE") else int(v)
        except ValueError:
            return None, True
    if isinstance(v, float):
        v = int(math.trunc(v))
    return (v, False) if lo <= v <= hi else (None, True)


def model(rec: dict):
    if any(k not in TRANSACTION_FIELDS for k in rec):
        return None, "unknown field"
    q, bad_q = _integral(rec.get("quantity"), INT_MIN, INT_MAX)
    if bad_q:
        return None, "bad quantity"
    i, bad_i = _integral(rec.get("id"), LONG_MIN, LONG_MAX)
    if bad_i:
        return None, "bad id"
    p = rec.get("price")
    if isinstance(p, str):
        return None, "bad price"
    return (i, rec.get("sku"), q or 0, p), None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(recs=st.lists(RECORD, min_size=1, max_size=25))
def test_decoder_matches_model(spark, recs):
    env = spark.createDataFrame([("items", 0, n, None, json.dumps(r)) for n, r in enumerate(recs)], ENVELOPE)
    good = {r.offset: (r.id, r.sku, r.quantity, r.price) for r in decode_transactions(env).collect()}
    bad = {r.offset: r.reason for r in quarantine_transactions(env).collect()}
    for n, rec in enumerate(recs):
        want, reason = model(rec)
        if reason:
            assert bad.get(n) == reason and n not in good, (rec, good.get(n), bad.get(n))
        else:
            assert n not in bad, (rec, bad.get(n))
            gid, gsku, gq, gp = good[n]
            wid, wsku, wq, wp = want
            assert (gid, gsku, gq) == (wid, wsku, wq), (rec, good[n])
            assert (gp is None and wp is None) or math.isclose(gp, wp, rel_tol=1e-12, abs_tol=1e-12), (rec, gp)
