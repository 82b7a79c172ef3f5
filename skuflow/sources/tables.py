"""Table scans and adapters from the given parquet tables to item transactions.

The test data has no item-transaction table, so two fixed mappings derive
one (see FIXTURES.md §3):

* ``item_tx_events``   — from ``events``; ``event_id`` is unique, so it is
  the order column for everything order-dependent (changelogs, streams).
* ``item_tx_lineitem`` — from ``lineitem``; no unique key, so only for
  order-free sums (and scale).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.functions.columns import iso_text

# --- fixed values of the adapter mappings ---------------------------------
EVENT_TYPE_TO_TX_TYPE = {
    "purchase": "SALE",
    "click": "SALE",
    "signup": "RESTOCK",
    "error": "ADJUST",
}  # any other event type (e.g. "view") gives a null type
RETURNFLAG_TO_TX_TYPE = {"A": "SALE", "R": "RESTOCK"}  # others: null type
NULL_SKU_PROP = "0"  # props.k == "0" means "no SKU"
STORE_PREFIX = "Store-"
ITEM_PREFIX = "Item-"
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _case(col: str, mapping: dict[str, str]):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, F.lit(v))) if expr is None else expr.when(F.col(col) == k, F.lit(v))
    return expr.otherwise(F.lit(None).cast("string"))


def tx_events_columns() -> list:
    """Column expressions over ``events`` giving an item transaction."""
    k = F.get_json_object(F.col("props"), "$.k")
    return [
        F.col("event_id").alias("id"),
        F.concat(F.lit(STORE_PREFIX), F.col("user_id").cast("string")).alias("storeName"),
        # one JSON lookup per row: nullif(k, "0") is null for "no SKU"
        F.concat(F.lit(ITEM_PREFIX), F.nullif(k, F.lit(NULL_SKU_PROP))).alias("sku"),
        F.floor(F.col("value")).cast("int").alias("quantity"),
        _case("event_type", EVENT_TYPE_TO_TX_TYPE).alias("type"),
        F.col("value").alias("price"),
        iso_text("ts").alias("timestamp"),
    ]


def item_tx_events(events: DataFrame) -> DataFrame:
    """Item transactions from ``events`` (schema = ``schema.TRANSACTION``)."""
    return events.select(*tx_events_columns())


def item_tx_lineitem(lineitem: DataFrame) -> DataFrame:
    """Item transactions from ``lineitem`` (no id, no timestamp)."""
    return lineitem.select(
        F.lit(None).cast("long").alias("id"),
        F.concat(F.lit(STORE_PREFIX), F.col("l_suppkey").cast("string")).alias("storeName"),
        F.concat(F.lit(ITEM_PREFIX), F.col("l_partkey").cast("string")).alias("sku"),
        F.floor(F.col("l_quantity")).cast("int").alias("quantity"),
        _case("l_returnflag", RETURNFLAG_TO_TX_TYPE).alias("type"),
        F.col("l_extendedprice").alias("price"),
        F.lit(None).cast("string").alias("timestamp"),
    )


def events_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_tx_events(read_table(spark, sf_dir, "events"))


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_tx_lineitem(read_table(spark, sf_dir, "lineitem"))


def item_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk lookup keys: one item ID per catalogue part (some never traded)."""
    return read_table(spark, sf_dir, "part").select(
        F.concat(F.lit(ITEM_PREFIX), F.col("p_partkey").cast("string")).alias("itemID")
    )


def store_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk store lookup keys: one store name per customer (some never traded)."""
    return read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit(STORE_PREFIX), F.col("c_custkey").cast("string")).alias("storeName")
    )
