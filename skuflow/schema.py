"""Record schemas and the fixed values the reference behaviour depends on."""

from pyspark.sql import types as T

# --- fixed values (must equal the reference's for right results) ---------
# Transaction type that subtracts; every other value (null, RESTOCK, lower
# case "sale", unknown codes) adds.
SALE = "SALE"
RESTOCK = "RESTOCK"
# Default topic names: transactions in, inventory changes out.
ITEMS_TOPIC = "items"
INVENTORY_TOPIC = "item.inventory"
# Name of the materialised per-item stock table.
STOCK_STORE_NAME = "ItemStock"
# Field names of a transaction record, in declaration order.
TRANSACTION_FIELDS = ("id", "storeName", "sku", "quantity", "type", "price", "timestamp")
# Field names of an inventory record, in declaration order.
INVENTORY_FIELDS = ("itemID", "currentStock")
# Text layout of the console trace line of an inventory change (no closing brace).
TRACE_FORMAT = "{ itemID: %s -> %d"
# ISO-8601 local date-time text used to stamp transactions.
ISO_LOCAL_DATETIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# ---------------------------------------------------------------------------

TRANSACTION = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("storeName", T.StringType(), True),
        T.StructField("sku", T.StringType(), True),
        T.StructField("quantity", T.IntegerType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("timestamp", T.StringType(), True),
    ]
)

INVENTORY = T.StructType(
    [
        T.StructField("itemID", T.StringType(), True),
        T.StructField("currentStock", T.LongType(), True),
    ]
)

# Kafka record envelope as produced by spark.read.format("kafka") after the
# key/value casts; the file stand-in for a topic uses the same columns.
ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
    ]
)
