"""Tokens in very long runs: found in linear time and at the places a plain search gives."""

import random
import re
import time

from skuflow.llm import secrets

PLAIN = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")


def test_jwt_places_equal_a_plain_search():
    r = random.Random(3)
    bits = ["eyJ", "a", "eyJhbGciOi", "-", ".", "abcdefgh", " ", "é", "_x", "eyJhbGciOiJub.eyJzdWIiOiJq.QwErTyUiOp"]
    for _ in range(3000):
        text = "".join(r.choice(bits) for _ in range(r.randrange(1, 14)))
        assert [m.span(1) for m in secrets.MORE["jwt"].finditer(text)] == [m.span() for m in PLAIN.finditer(text)], text


def test_dense_marks_take_linear_time():
    start = time.monotonic()
    for text in ("eyJ" * 400_000, "eyJabcdefgh." * 100_000 + " ", "a" * 1_000_000 + "eyJ", "1," * 400_000):
        secrets.more_spans(text, secrets.base_spans(text))
    assert time.monotonic() - start < 30
