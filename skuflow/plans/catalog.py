"""Registered queries: name → fn(spark, sf_dir) → DataFrame.

Each reads the given parquet tables (or data Spark derives from them) in
full; nothing is capped, sampled or filtered to a key subset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skuflow.operators import changelog as ch
from skuflow.operators import lookup as lk
from skuflow.operators import stock as st
from skuflow.operators import trace as tr
from skuflow.plans.streams import STREAMS
from skuflow.sources import codec as cd
from skuflow.sources import messages as ms
from skuflow.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]


def q_item_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.item_stock(tb.lineitem_transactions(spark, sf_dir))


def q_store_item_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.store_item_stock(tb.lineitem_transactions(spark, sf_dir))


def q_signed_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.signed_delta(tb.events_transactions(spark, sf_dir))


def q_seeded_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Opening balance = the stock booked from order lines; new period = events.
    opening = st.item_stock(tb.lineitem_transactions(spark, sf_dir))
    return st.seeded_stock(opening, tb.events_transactions(spark, sf_dir))


def q_item_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.item_changelog(tb.events_transactions(spark, sf_dir))


def q_store_item_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.store_item_changelog(tb.events_transactions(spark, sf_dir))


def q_item_changelog_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.item_changelog_compacted(tb.events_transactions(spark, sf_dir))


def q_stock_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lk.stock_lookup_tx(tb.events_transactions(spark, sf_dir), tb.item_requests(spark, sf_dir))


def q_store_stock_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lk.store_stock_lookup_tx(tb.events_transactions(spark, sf_dir), tb.store_requests(spark, sf_dir))


# --- codec, traces, finders ------------------------------------------------


def q_decode_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cd.decode_transactions(ms.events_messages(spark, sf_dir), "permissive")


def q_quarantine_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cd.quarantine_transactions(ms.events_messages(spark, sf_dir))


def q_encode_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cd.encode_transactions(tb.events_transactions(spark, sf_dir), key="storeName")


def q_encode_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cd.encode_inventory(st.item_stock(tb.lineitem_transactions(spark, sf_dir)))


def q_decode_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the output topic read back: encode every item's stock, then decode it
    return cd.decode_inventory(cd.encode_inventory(st.item_stock(tb.lineitem_transactions(spark, sf_dir))), "strict")


def q_inventory_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.inventory_trace(ch.item_changelog(tb.events_transactions(spark, sf_dir)))


def q_record_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.record_trace(ms.events_messages(spark, sf_dir))


def q_first_event_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lk.first_event_by_key(ms.events_messages(spark, sf_dir))


def q_first_event_by_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lk.first_event_by_payload(ms.events_messages(spark, sf_dir), "sku", path="$")


def q_topic_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a topic snapshot replayed in record-time order: (timestamp, partition, offset)
    msgs = ms.events_messages(spark, sf_dir, with_timestamp=True, foreign=False)
    tx = cd.decode_transactions(msgs, "permissive", keep=("partition", "offset", "ts_ms"))
    return ch.item_changelog(tx, order=["ts_ms", "partition", "offset"])


# --- fixed value: the stream client's default commit interval, after which its
# record cache emits the last value per key (the compacted update stream)
COMMIT_INTERVAL_MS = 30000


def q_topic_changelog_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    # last total per item per commit interval of record time, in topic order
    msgs = ms.events_messages(spark, sf_dir, with_timestamp=True, foreign=False)
    tx = cd.decode_transactions(msgs, "permissive", keep=("partition", "offset", "ts_ms"))
    return ch.item_changelog_compacted(
        tx, order=["ts_ms", "partition", "offset"], batch=ch.floor_div("ts_ms", COMMIT_INTERVAL_MS)
    )


# the clock of the stamped rows, given so that reruns agree
STAMP_CLOCK = "2024-01-01T00:00:00.000000"


def q_stamp_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # events carry their time and keep it; order lines have none and get the clock's
    both = tb.events_transactions(spark, sf_dir).unionByName(tb.lineitem_transactions(spark, sf_dir))
    return tr.stamp_transactions(both, STAMP_CLOCK)


_BATCH = {
    "decode_transactions": q_decode_transactions,
    "quarantine_transactions": q_quarantine_transactions,
    "encode_transactions": q_encode_transactions,
    "encode_inventory": q_encode_inventory,
    "decode_inventory": q_decode_inventory,
    "inventory_trace": q_inventory_trace,
    "record_trace": q_record_trace,
    "first_event_by_key": q_first_event_by_key,
    "first_event_by_payload": q_first_event_by_payload,
    "stamp_transactions": q_stamp_transactions,
    "topic_changelog": q_topic_changelog,
    "topic_changelog_compacted": q_topic_changelog_compacted,
}


def queries() -> dict[str, Query]:
    return {
        "item_stock": q_item_stock,
        "store_item_stock": q_store_item_stock,
        "signed_delta": q_signed_delta,
        "seeded_stock": q_seeded_stock,
        "item_changelog": q_item_changelog,
        "store_item_changelog": q_store_item_changelog,
        "item_changelog_compacted": q_item_changelog_compacted,
        "stock_lookup": q_stock_lookup,
        "store_stock_lookup": q_store_stock_lookup,
        **_BATCH,
        **STREAMS,
    }
