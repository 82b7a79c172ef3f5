"""Registered streaming queries.

The item topic is materialised from ``events`` as parquet files in a
folder under the shared checkpoint root (the stand-in for Kafka, whose
connector is not on this classpath). Real Structured Streaming queries run
over that folder with ``availableNow`` triggers; their output tables and
state are read back as DataFrames. Multi-run queries deliver the topic in
consecutive offset ranges, appending each range to the source folder
before the next run, so state must carry across runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.config import scratch_path
from skuflow.operators.changelog import running_sum
from skuflow.operators.stock import item_stock
from skuflow.schema import ITEMS_TOPIC
from skuflow.sources import messages as ms
from skuflow.sources import tables as tb
from skuflow.sources.codec import decode_inventory, decode_transactions
from skuflow.streaming import changes as C
from skuflow.streaming import pipeline as P
from skuflow.streaming import state as S
from skuflow.streaming.sinks import StockTable


def deliveries(msgs: DataFrame, parts: int) -> list[DataFrame]:
    """Cut the topic into ``parts`` consecutive offset ranges; every message is
    in exactly one range (nulls go with the first)."""
    if parts <= 1:
        return [msgs]
    lo, hi = msgs.agg(F.min("offset"), F.max("offset")).first()
    if lo is None:
        return [msgs]
    width = (hi - lo) // parts + 1
    out = []
    for i in range(parts):
        cond = F.col("offset") < F.lit(lo + (i + 1) * width) if i < parts - 1 else F.lit(True)
        if i > 0:
            cond = cond & (F.col("offset") >= F.lit(lo + i * width))
        else:
            cond = cond | F.col("offset").isNull()
        out.append(msgs.where(cond))
    return out


def _source(spark: SparkSession, name: str) -> tuple[P.StreamPaths, str]:
    paths = P.StreamPaths(scratch_path(spark, name))
    return paths, f"{paths.root}/topic"


def _stream(spark: SparkSession, src: str) -> DataFrame:
    return ms.read_topic_files(spark, src, streaming=True)


# state partitions of the placement query, pinned so that its answer is the same on every cluster
METADATA_PARTITIONS = 8


def run_stock_stream(spark: SparkSession, sf_dir: str, name: str, parts: int = 1,
                     state_partitions: int | None = None) -> P.StreamPaths:
    paths, src = _source(spark, name)
    for seg in deliveries(ms.events_messages(spark, sf_dir, foreign=False), parts):
        ms.topic_to_files(seg, src, mode="append")
        P.run_to_end(P.item_stock_query(_stream(spark, src), paths, state_partitions=state_partitions))
    return paths


def q_item_stock_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.stock_snapshot(spark, run_stock_stream(spark, sf_dir, "item_stock_stream"))


def q_store_item_stock_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, src = _source(spark, "store_item_stock_stream")
    for seg in deliveries(ms.events_messages(spark, sf_dir, foreign=False), 2):
        ms.topic_to_files(seg, src, mode="append")
        P.run_to_end(P.store_item_stock_query(_stream(spark, src), paths))
    return P.store_stock_snapshot(spark, paths)


def q_seeded_stock_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # opening balance = stock booked from order lines; the stream adds the events
    opening = item_stock(tb.lineitem_transactions(spark, sf_dir))
    return P.seeded_stock_snapshot(spark, run_stock_stream(spark, sf_dir, "seeded_stock_stream"), opening)


def q_item_stock_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries on one checkpoint, then a rerun with nothing new: the
    restart resumes (no message counted twice) and the rerun adds nothing."""
    paths = run_stock_stream(spark, sf_dir, "item_stock_replay", parts=2)
    src = f"{paths.root}/topic"
    q = P.item_stock_query(_stream(spark, src), paths)
    P.run_to_end(q)
    if any(p.get("numInputRows", 0) for p in q.recentProgress):
        raise RuntimeError("replay: a rerun on the same checkpoint re-read old messages")
    return P.stock_snapshot(spark, paths)


def q_item_changelog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, src = _source(spark, "item_changelog_stream")
    for seg in deliveries(ms.events_messages(spark, sf_dir, foreign=False), 2):
        ms.topic_to_files(seg, src, mode="append")
        P.run_to_end(P.item_changelog_query(_stream(spark, src), paths))
    return P.read_changelog(spark, paths)


def q_store_item_changelog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, src = _source(spark, "store_item_changelog_stream")
    for seg in deliveries(ms.events_messages(spark, sf_dir, foreign=False), 2):
        ms.topic_to_files(seg, src, mode="append")
        P.run_to_end(P.item_changelog_query(_stream(spark, src), paths, keys=P.STORE_ITEM_KEYS))
    return P.read_changelog(spark, paths, keys=P.STORE_ITEM_KEYS)


def q_item_changelog_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change read back from the topic it was published on: the source record's id, the
    item's new stock, and which of the item's records on the topic it is. Two runs of the stateful
    query on one checkpoint."""
    paths, src = _source(spark, "item_changelog_published")
    topic = f"{paths.root}/inventory"
    for seg in deliveries(ms.events_messages(spark, sf_dir, foreign=False), 2):
        ms.topic_to_files(seg, src, mode="append")
        P.run_to_end(C.changes_query(_stream(spark, src), paths.changelog_checkpoint, publish=C.file_publisher(topic)))
    sent = C.published_changes(C.read_published(spark, topic)).withColumn("one", F.lit(1))
    # an item's records are in one topic partition, in the order of its offsets
    nth = running_sum(sent, ["key"], "offset", "one", "change_no")
    stock = decode_inventory(nth, "strict", keep=("source_offset", "change_no"))
    return stock.select(F.col("source_offset").alias("id"), "itemID", "currentStock", "change_no")


def q_seeded_changelog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change on top of an opening balance, taken in as the operator's initial state: a
    second run on the checkpoint is given the opening again and does not add it."""
    paths, src = _source(spark, "seeded_changelog_stream")
    opening = written_opening(spark, sf_dir, paths)
    for seg in deliveries(ms.events_messages(spark, sf_dir, foreign=False), 2):
        ms.topic_to_files(seg, src, mode="append")
        P.run_to_end(C.changes_query(_stream(spark, src), paths.changelog_checkpoint, table=paths.changelog, opening=opening))
    return C.read_changes(spark, paths.changelog)


# state partitions before and after the move of q_rescaled_changelog_stream
RESCALED = (4, 10)


def q_rescaled_changelog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change, the number of state partitions changed between two deliveries: the second query
    starts from the first one's state on a checkpoint of its own, behind the first one's offsets."""
    paths, src = _source(spark, "rescaled_changelog_stream")
    first, later = deliveries(ms.events_messages(spark, sf_dir, foreign=False), 2)
    ms.topic_to_files(first, src, mode="append")
    P.run_to_end(C.changes_query(_stream(spark, src), paths.changelog_checkpoint, table=paths.changelog, state_partitions=RESCALED[0]))
    moved = P.StreamPaths(f"{paths.root}/rescaled")
    opening, positions = C.move_state(spark, paths.changelog_checkpoint, paths.changelog, f"{moved.root}/from")
    ms.topic_to_files(later, src, mode="append")
    P.run_to_end(C.changes_query(C.after(_stream(spark, src), positions), moved.changelog_checkpoint, table=moved.changelog,
                                 opening=opening, state_partitions=RESCALED[1]))
    before = C.committed_changes(spark, paths.changelog_checkpoint, paths.changelog).select("id", "itemID", "currentStock")
    return before.unionByName(C.read_changes(spark, moved.changelog))


def written_opening(spark: SparkSession, sf_dir: str, paths: P.StreamPaths) -> DataFrame:
    """The stock booked from order lines, one row an item, as a table."""
    path = f"{paths.root}/opening"
    item_stock(tb.lineitem_transactions(spark, sf_dir)).write.parquet(path)
    return spark.read.schema("itemID string, currentStock long").parquet(path)


def q_stock_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = run_stock_stream(spark, sf_dir, "stock_point_lookup")
    return S.stock_point_lookup(spark, paths.stock_checkpoint, tb.item_requests(spark, sf_dir))


def q_item_stock_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current stock from the compacted table that the stock stream keeps up to date: four
    deliveries, a new base every two."""
    paths, src = _source(spark, "item_stock_table")
    table = StockTable(f"{paths.root}/tables/item_stock", P.ITEM_KEYS, compact_every=2)
    for seg in deliveries(ms.events_messages(spark, sf_dir, foreign=False), 4):
        ms.topic_to_files(seg, src, mode="append")
        P.run_to_end(P.stock_table_query(_stream(spark, src), paths.stock_checkpoint, table))
    return table.read(spark)


# deliveries, and so micro-batches, of the change feed query
FEED_DELIVERIES = 3


def q_stock_state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each micro-batch but the first changed in the stock state."""
    paths = run_stock_stream(spark, sf_dir, "stock_state_changes", parts=FEED_DELIVERIES)
    return S.stock_state_changes(spark, paths.stock_checkpoint, 1).select("batch_id", "itemID", "currentStock")


def q_partition_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic partitions whose records each state partition holds."""
    paths = run_stock_stream(spark, sf_dir, "partition_holders", state_partitions=METADATA_PARTITIONS)
    records = decode_transactions(ms.read_topic_files(spark, f"{paths.root}/topic"), "strict", keep=("partition",))
    held = S.partition_holders(spark, paths.stock_checkpoint, records.withColumnRenamed("sku", "itemID"), ITEMS_TOPIC)
    return held.select("holder", F.concat_ws(",", "partitions").alias("partitions"), "numKeys")


def q_store_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = run_stock_stream(spark, sf_dir, "store_metadata", state_partitions=METADATA_PARTITIONS)
    return S.store_metadata(spark, paths.stock_checkpoint).select("storeName", "numPartitions", "numKeys")


STREAMS = {
    "item_stock_stream": q_item_stock_stream,
    "item_changelog_stream": q_item_changelog_stream,
    "item_changelog_published": q_item_changelog_published,
    "seeded_changelog_stream": q_seeded_changelog_stream,
    "rescaled_changelog_stream": q_rescaled_changelog_stream,
    "store_item_stock_stream": q_store_item_stock_stream,
    "store_item_changelog_stream": q_store_item_changelog_stream,
    "seeded_stock_stream": q_seeded_stock_stream,
    "item_stock_replay": q_item_stock_replay,
    "stock_point_lookup": q_stock_point_lookup,
    "item_stock_table": q_item_stock_table,
    "stock_state_changes": q_stock_state_changes,
    "partition_holders": q_partition_holders,
    "store_metadata": q_store_metadata,
}
