"""Signed deltas and stock aggregates (batch and streaming share these)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.functions.columns import signed_quantity


def signed_delta(tx: DataFrame, keep: Sequence[str] = ("id", "storeName")) -> DataFrame:
    """Re-key a transaction to its SKU with a signed quantity.

    Output: ``keep`` columns + ``itemID`` (= sku) + ``delta`` (LONG).
    Rows with a null SKU are kept here; the aggregates drop them.
    """
    return tx.select(
        *[F.col(c) for c in keep],
        F.col("sku").alias("itemID"),
        signed_quantity("type", "quantity").alias("delta"),
    )


def _sum_stock(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    # groupBy → HashAggregate(partial) → Exchange(keys) → HashAggregate(final):
    # a hot key is pre-summed inside every map task before the shuffle, so
    # it reaches its reducer as one row per map task, never as raw rows.
    return deltas.groupBy(*keys).agg(F.sum("delta").alias("currentStock"))


def item_stock(tx: DataFrame) -> DataFrame:
    """Current stock per item across all stores: ``itemID, currentStock``.

    Null SKUs are dropped (they never reach the reference's aggregate);
    the empty string is a valid SKU. Stock may be negative.
    """
    return _sum_stock(signed_delta(tx, keep=()).where(F.col("itemID").isNotNull()), ["itemID"])


def store_item_stock(tx: DataFrame) -> DataFrame:
    """Stock per store and item: ``storeName, itemID, currentStock``."""
    return _sum_stock(
        signed_delta(tx, keep=("storeName",)).where(F.col("itemID").isNotNull()),
        ["storeName", "itemID"],
    )


def seeded_stock(opening: DataFrame, tx: DataFrame) -> DataFrame:
    """Stock per item starting from an opening balance.

    ``opening`` has ``itemID, currentStock``. Items only in the opening
    table keep their balance; items only in ``tx`` start at 0. Written as a
    union + one aggregate instead of a full outer join, so both inputs are
    pre-summed map-side and only one shuffle happens.
    """
    seed = opening.where(F.col("itemID").isNotNull()).select(
        "itemID", F.coalesce(F.col("currentStock").cast("long"), F.lit(0).cast("long")).alias("delta")
    )
    moves = signed_delta(tx, keep=()).where(F.col("itemID").isNotNull())
    return _sum_stock(seed.unionByName(moves), ["itemID"])
