"""WARC archives: write records, and read them back by verified boundary chains.

Archives are written by Spark's text writer: a record's value is its header and
payload, and the line separator is the blank line that ends a record. Reading
takes the archives as bytes (of any encoding, WARC/1.0 or 1.1) and splits them at the
record magic in any number of tasks; every place where the magic stands is only
a candidate, with the offset of its successor computed
from its own length. Pointer jumping from the start of each file keeps the
candidates that the chain reaches, so magic inside a payload never makes a record.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuflow.config import scratch_path
from skuflow.llm.common import written

MAGIC = "WARC/1.1\r\n"
SPLIT = "WARC/1."        # what all versions read begin with
END = "\r\n\r\n"
RECORDS_PER_ARCHIVE = 1000
LEAST_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 least: int = LEAST_REVISIT) -> DataFrame:
    """page, url, html, bytes, digest, kind, refers_to of every page.

    Of equal payloads of ``least`` bytes or more the largest page id is the response
    (rows equal in it too), the others revisit it. A null payload is empty; a page
    without id revisits if any equal one has an id, else it is a response. A binary
    payload keeps its bytes, also those that are no UTF-8.
    """
    p = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    # only digests that stand more than once go into the join; sums come before the shuffle
    first = written(p.where(F.col("bytes") >= least).groupBy("digest").agg(
        F.max("page").alias("target"), F.count(F.lit(1)).alias("n")).where("n > 1 and target is not null").drop("n"),
        "warc-repeats")
    revisit = F.col("target").isNotNull() & ~F.col("page").eqNullSafe(F.col("target")) & (F.col("bytes") >= least)
    return p.join(first, "digest", "left").withColumn("kind", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("target"))).drop("target")


def record_text() -> Column:
    """A record without its final blank line, as a column over plan_records()."""
    stored = F.when(F.col("kind") == "revisit", F.lit("")).otherwise(F.col("html"))
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page").cast("string"), F.lit("-")), F.lit(">"))

    def line(field: str, value: Column) -> Column:
        return F.concat(F.lit(f"{field}: "), value, F.lit("\r\n"))

    refers = line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))
    return F.concat(
        F.lit(MAGIC), line("WARC-Type", F.col("kind")), line("WARC-Record-ID", name), line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", clean), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(F.col("kind") == "revisit", refers).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        F.lit("Content-Length: "), F.octet_length(stored).cast("string"), F.lit(END), stored)


def write_archives(records: DataFrame, path: str, per_archive: int = RECORDS_PER_ARCHIVE, compression: str = "gzip") -> None:
    """Archives of at most ``per_archive`` records; ``compression`` none keeps one archive splittable."""
    (records.select(record_text().alias("value")).write.option("lineSep", END).option("compression", compression)
     .option("maxRecordsPerFile", per_archive).text(path))


_VERSION = re.compile(rb"[0-9]\r\n")
_FIELD = re.compile(rb"([A-Za-z0-9_-]+):[ \t]*([^\r\n]*)\r\n")


def parse_header(piece: bytes) -> tuple[dict[str, str], int] | None:
    """Fields and length of a header that starts a piece (from its minor version); None if it is none."""
    version, end = _VERSION.match(piece), piece.find(b"\r\n\r\n")
    if not version or end < 0:
        return None
    fields, at = {}, version.end()
    while at < end + 2:
        m = _FIELD.match(piece, at)
        if not m:
            return None
        fields[m[1].decode().lower()] = m[2].decode("utf-8", "replace")
        at = m.end()
    return (fields, end + 4) if fields.get("content-length", "").isdigit() else None


_PIECE = ["file", "block", "at", "next", "type", "record", "refers", "declared", "bytes", "size", "sha1", "read"]
_PIECE_DDL = ("file string, block long, at long, next long, type string, record string, refers string, declared string, "
              "bytes long, size long, sha1 string, read long")
_PIECE_ARROW = pa.schema([(n, pa.string() if n in ("file", "type", "record", "refers", "declared", "sha1") else pa.int64())
                          for n in _PIECE])


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a piece; its place and its successor's are relative to the start of the task's file block."""
    here, at = None, 0
    for b in batches:
        rows = []
        for value, file, block in zip(b.column("value"), b.column("file").to_pylist(), b.column("block").to_pylist()):
            if (file, block) != here:
                here, at = (file, block), 0
            raw = value.as_py()
            head = parse_header(raw)
            if head is None:
                rows.append((file, block, at, None, None, None, None, None, None, len(raw), None, None))
            else:
                f, size = head
                n = int(f["content-length"])
                whole = len(raw) == size + n + len(END)
                length = f.get("warc-payload-length", "")
                rows.append((file, block, at, at + size + n + len(END) + len(SPLIT), f.get("warc-type"), f.get("warc-record-id"),
                             f.get("warc-refers-to"), f.get("warc-payload-digest"), int(length) if length.isdigit() else None,
                             len(raw), hashlib.sha1(raw[size:size + n]).hexdigest() if whole else None, n if whole else None))
            at += len(raw) + len(SPLIT)
        yield pa.RecordBatch.from_pylist([dict(zip(_PIECE, r)) for r in rows], _PIECE_ARROW)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives' bytes between magics, in file order within a block."""
    return spark.read.option("lineSep", SPLIT).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    here, at = None, 0
    for b in batches:
        place = []
        for value, file, block in zip(b.column("value"), b.column("file").to_pylist(), b.column("block").to_pylist()):
            if (file, block) != here:
                here, at = (file, block), 0
            place.append(at)
            at += len(value.as_py()) + len(SPLIT)
        yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), pa.array(place, pa.int64()), b.column("value")],
                                         ["file", "block", "at", "value"])


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates that the chain from offset 0 of their file reaches.

    Each round doubles the jump, so the rounds are the logarithm of the candidates in a file.
    """
    nodes = candidates.where("next is not null").select("file", "at", "next")
    most = candidates.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    jump = written(nodes, "warc-jump")
    found = written(nodes.where("at = 0").select("file", "at"), "warc-found")
    for _ in range(max(0, int(most).bit_length())):
        ahead = found.join(jump, ["file", "at"]).select("file", F.col("next").alias("at"))
        found = written(found.unionByName(ahead), "warc-found")
        there = jump.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        jump = written(jump.join(there, ["file", "next"]).select("file", "at", F.col("after").alias("next")), "warc-jump")
        if jump.isEmpty():
            break
    return found.join(nodes.select("file", "at"), ["file", "at"], "left_semi")


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out, read = [], []
        for parts in b.column("parts").to_pylist():
            raw = SPLIT.encode().join(p["value"] for p in sorted(parts, key=lambda p: p["at"]))
            fields, size = parse_header(raw)
            n = int(fields["content-length"])
            out.append(hashlib.sha1(raw[size:size + n]).hexdigest() if len(raw) == size + n + len(END) else None)
            read.append(len(raw[size:size + n]))
        yield pa.RecordBatch.from_arrays([b.column("file"), b.column("own"), pa.array(out, pa.string()), pa.array(read, pa.int64())],
                                         ["file", "own", "joined", "joined_read"])


def read_archives(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Verified records: page (text), type, refers (text), declared and recomputed digest, bytes.

    ``sha1`` is the digest of the stored payload as read (null for a record that the file
    cuts off), ``bytes`` its length as read; for a revisit, the length its header gives. A file that does not begin with a record gives
    none; with ``strict`` it is an error.
    """
    rel = written(_pieces(spark, path).mapInArrow(_emit, _PIECE_DDL), "warc-pieces")
    # a block starts where all earlier blocks of its file end: every byte is in one piece or one magic
    blocks = rel.groupBy("file", "block").agg(F.sum(F.col("size") + len(SPLIT)).alias("span"))
    base = written(blocks.withColumn("base", F.coalesce(F.sum("span").over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("file", "block", "base"), "warc-blocks")
    shift = F.col("base") - len(SPLIT)
    cand = written(rel.join(base, ["file", "block"]).withColumn("at", F.col("at") + shift)
                   .withColumn("next", F.col("next") + shift).where("at >= 0").drop("base", "block"), "warc-candidates")
    if strict:
        begun = cand.where("at = 0 and next is not null").select("file").distinct()
        other = base.select("file").distinct().join(begun, "file", "left_anti").first()
        if other:
            raise ValueError(f"{other['file']} does not begin with a WARC/1.x record")
    real = written(reachable(cand).withColumn("real", F.lit(True)), "warc-real")
    records = cand.join(real.select("file", "at"), ["file", "at"], "left_semi")
    # payloads that hold the magic: their pieces up to the next real record, joined again
    torn = written(records.where("sha1 is null").select("file").distinct(), "warc-torn")
    marked = cand.join(torn, "file", "left_semi").join(real, ["file", "at"], "left")
    owned = written(marked.withColumn("own", F.max(F.when(F.col("real"), F.col("at"))).over(
        Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
        .where("own is not null").select("file", "at", "own"), "warc-owned")
    need = owned.join(records.where("sha1 is null").select("file", F.col("at").alias("own")), ["file", "own"], "left_semi")
    raw = _pieces(spark, path).mapInArrow(_raw, "file string, block long, at long, value binary").join(base, ["file", "block"])
    parts = (raw.withColumn("at", F.col("at") + shift).join(need, ["file", "at"])
             .groupBy("file", "own").agg(F.collect_list(F.struct("at", "value")).alias("parts")))
    joined = parts.mapInArrow(_assemble, "file string, own long, joined string, joined_read long").withColumnRenamed("own", "at")
    page = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1)
    return records.join(written(joined, "warc-joined"), ["file", "at"], "left").select(
        page("record").alias("page"), "type", page("refers").alias("refers"),
        F.regexp_replace("declared", "^sha1:", "").alias("declared"), F.when(F.col("type") == "revisit", F.col("bytes")).otherwise(F.coalesce("read", "joined_read")).alias("bytes"),
        F.coalesce("sha1", "joined").alias("sha1"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least: int = LEAST_REVISIT, per_archive: int = RECORDS_PER_ARCHIVE, compression: str = "gzip") -> DataFrame:
    """Write a record per page, read the archives back, one row a page.

    Columns: the id, payload_bytes, payload_digest, record_type, refers_to, intact. Length and
    digest are those of payloads read back: a revisit takes them from the response that it
    refers to, found by id and digest. ``intact`` tells that they equal what the record's
    own header says (false, with the header's values, where no such response was read). Null
    html is empty, null ids come back null, repeated rows and ties each have their record; a very long
    payload is one record; extra columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    kind = dict(pages.select(F.col(id_col).alias("i")).dtypes)["i"]
    path = scratch_path(spark, "llm-warc")
    write_archives(plan_records(pages, id_col, url_col, html_col, least), path, per_archive, compression)
    back = written(read_archives(spark, path, strict=True), "warc-back")
    # the responses that revisits refer to, one row each: few beside the revisits, which may all refer to one
    asked = back.where("type = 'revisit'").select(F.col("refers").alias("target"), F.col("declared").alias("sha")).distinct()
    full = written(back.where("type = 'response'").select(F.col("page").alias("target"), F.col("sha1").alias("sha"), F.col("bytes").alias("length"))
                   .join(asked, ["target", "sha"], "left_semi").dropDuplicates(["target", "sha"]), "warc-responses")
    revisit = F.col("type") == "revisit"
    both = back.join(full, (F.col("refers") == F.col("target")) & (F.col("declared") == F.col("sha")) & revisit, "left")
    return both.select(
        F.when(F.col("page") != "-", F.col("page")).cast(kind).alias(id_col),
        F.when(revisit, F.coalesce("length", "bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(revisit, F.coalesce("sha", "declared")).otherwise(F.col("sha1")).alias("payload_digest"), F.col("type").alias("record_type"),
        F.when(revisit, F.col("refers")).cast(kind).alias("refers_to"),
        F.coalesce(F.when(revisit, F.col("length") == F.col("bytes")).otherwise(F.col("sha1") == F.col("declared")), F.lit(False)).alias("intact"))
