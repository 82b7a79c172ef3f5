"""skuflow — item inventory analytics on Spark DataFrames.

Item transactions (a store sold or restocked N units of a SKU) are turned
into signed quantities and summed per SKU (and per store and SKU), in batch
and in Structured Streaming with the same DataFrame functions.
"""

from skuflow.operators.changelog import (  # noqa: F401
    item_changelog,
    item_changelog_compacted,
    running_stock,
    running_sum,
    store_item_changelog,
)
from skuflow.operators.lookup import (  # noqa: F401
    first_event_by_key,
    first_event_by_payload,
    stock_lookup,
    stock_lookup_tx,
    store_stock_lookup,
    store_stock_lookup_tx,
)
from skuflow.operators.stock import (  # noqa: F401
    item_stock,
    seeded_stock,
    signed_delta,
    store_item_stock,
)
from skuflow.sources.codec import (  # noqa: F401
    decode_inventory,
    decode_transactions,
    encode_inventory,
    encode_transactions,
    quarantine_inventory,
    quarantine_transactions,
)

__all__ = [
    "signed_delta",
    "item_stock",
    "store_item_stock",
    "seeded_stock",
    "running_sum",
    "running_stock",
    "item_changelog",
    "item_changelog_compacted",
    "store_item_changelog",
    "stock_lookup",
    "stock_lookup_tx",
    "store_stock_lookup",
    "store_stock_lookup_tx",
    "first_event_by_key",
    "first_event_by_payload",
    "decode_transactions",
    "quarantine_transactions",
    "encode_transactions",
    "encode_inventory",
    "decode_inventory",
    "quarantine_inventory",
]
