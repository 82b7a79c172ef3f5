"""Trace projections: console lines of inventory changes, record traces,
and transaction stamping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.columns import iso_now, trace_line, utf8


def inventory_trace(changes: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """``keep`` + ``line`` = the reference's console text ``{ itemID: X -> n``."""
    keep = tuple(c for c in keep if c in changes.columns)
    return changes.select(*keep, "itemID", trace_line("itemID", "currentStock").alias("line"))


def record_trace(envelope: DataFrame, order: str = "within") -> DataFrame:
    """Topic, partition, offset, key and UTF-8 value of each record.

    ``order``: ``"within"`` sorts each Spark partition by (topic, partition,
    offset) — no shuffle; a Kafka scan reads each topic partition's offset
    range into one Spark partition, so this is the per-partition order a
    console consumer shows. ``"global"`` gives one total order (a
    range-partitioned sort: a full shuffle, only when a single ordered
    listing is needed). ``"none"`` leaves scan order.
    """
    out = envelope.select(
        "topic", "partition", "offset", utf8("key").alias("key"), utf8("value").alias("value")
    )
    if order == "within":
        return out.sortWithinPartitions("topic", "partition", "offset")
    if order == "global":
        return out.orderBy("topic", "partition", "offset")
    if order != "none":
        raise ValueError(f"unknown order {order!r}")
    return out


def stamp_transactions(tx: DataFrame, now: str | None = None) -> DataFrame:
    """Fill a missing ``timestamp`` with ``now`` (ISO text; default: the current local time)."""
    return tx.withColumn("timestamp", F.coalesce(F.col("timestamp"), iso_now() if now is None else F.lit(now)))
