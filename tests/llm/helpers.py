"""Texts and tables shared by the tests of the text operators."""

import random

SF = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, lang string, source string, size long, n long, spans string, label string, node string, score double"


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing columns."""
    r = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    long = " ".join(r.choice(words) + str(r.randrange(900)) for _ in range(30000))
    same = (7, "password = 'hunter2hunter2' all rights reserved a@b.co " + " ".join(words * 9), "en", "s1")
    rows = [(1, None, "en", "s1"), (2, "", "en", "s2"), (3, "   \n\t ", None, "s2"), (4, long, "en", None), (None, "no id " * 30, "de", "s1"),
            (None, None, None, None), same, same, (8, same[1], "en", "s3"), (9, "1234 5678", None, "s3"), (10, "x", "fr", "s1"),
            (11, "\U0001F600 é mix of things 10.0.0.1 \U0001F600 +1 (555) 555-0100", "fr", "s2")]
    return [(*x, 1, 2, "s", "l", "n", 0.5) for x in rows]


def odd(spark):
    return spark.createDataFrame(odd_rows(), CLASH)


def empty(spark):
    return spark.createDataFrame([], CLASH)
