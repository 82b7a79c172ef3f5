"""Payload lengths are those of the payloads read, not of the headers."""

from skuflow.config import scratch_path
from skuflow.llm import warc


def test_payload_length_is_read_from_the_payload(spark):
    def record(i, html, length, stored=None):
        return (f"WARC/1.1\r\nWARC-Type: {'response' if stored is None else 'revisit'}\r\nWARC-Record-ID: <urn:page:{i}>\r\n"
                f"WARC-Payload-Length: {length}\r\nContent-Length: {len(html) if stored is None else stored}\r\n\r\n{html}")

    path = scratch_path(spark, "warc-lengths")
    inner = "a" + warc.MAGIC + "b"
    cut = record(5, "x" * 90, 90)[:-50]
    text = warc.END.join([record(1, "abc", 7), record(2, inner, 99), record(3, "", 1234, 0), record(4, "", 5), cut])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\r\n").text(path)
    got = {r["page"]: r["bytes"] for r in warc.read_archives(spark, path).collect()}
    assert got == {"1": 3, "2": len(inner), "3": 1234, "4": 0, "5": 42}
