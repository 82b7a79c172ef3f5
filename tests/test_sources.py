"""Adapters, message mapping and topic deliveries."""

from pyspark.sql import functions as F

from skuflow.plans.streams import deliveries
from skuflow.sources.messages import events_messages, item_messages
from skuflow.sources.tables import item_tx_events, item_tx_lineitem, read_table

SF = "/root/testdata/sf0.001"


def test_event_adapter_rules(spark):
    ev = spark.createDataFrame(
        [
            (1, None, 7, "purchase", 5.9, '{"k": 3}'),
            (2, None, 7, "click", 1.0, '{"k": 0}'),
            (3, None, 8, "signup", 2.5, '{"k": 12}'),
            (4, None, 8, "error", 0.2, '{"k": 12}'),
            (5, None, 9, "view", 3.0, '{"k": 5}'),
        ],
        "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    )
    got = [(r.id, r.storeName, r.sku, r.quantity, r.type) for r in item_tx_events(ev).orderBy("id").collect()]
    assert got == [
        (1, "Store-7", "Item-3", 5, "SALE"),
        (2, "Store-7", None, 1, "SALE"),  # k = 0 means no SKU
        (3, "Store-8", "Item-12", 2, "RESTOCK"),
        (4, "Store-8", "Item-12", 0, "ADJUST"),
        (5, "Store-9", "Item-5", 3, None),
    ]


def test_lineitem_adapter_rules(spark):
    li = spark.createDataFrame(
        [(1, 10, 3, 1, 4.0, 9.5, 0.0, 0.0, "A", "F", None), (1, 11, 3, 2, 2.0, 9.5, 0.0, 0.0, "N", "O", None)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp",
    )
    got = [(r.storeName, r.sku, r.quantity, r.type) for r in item_tx_lineitem(li).orderBy("sku").collect()]
    assert got == [("Store-3", "Item-10", 4, "SALE"), ("Store-3", "Item-11", 2, None)]


def test_messages_one_per_event_views_are_foreign(spark):
    ev = read_table(spark, SF, "events")
    msgs = item_messages(ev)
    assert msgs.count() == ev.count()
    views = msgs.join(ev.select(F.col("event_id").alias("offset"), "event_type", "props"), "offset")
    assert views.where("event_type = 'view' and value <> props").count() == 0
    assert views.where("event_type <> 'view' and value = props").count() == 0
    assert msgs.where("partition < 0 or partition > 2").count() == 0


def test_deliveries_cover_every_message_once(spark):
    msgs = events_messages(spark, SF)
    parts = deliveries(msgs, 3)
    counts = [p.count() for p in parts]
    assert sum(counts) == msgs.count() and all(c > 0 for c in counts)
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert union.select("offset").distinct().count() == msgs.count()
    # consecutive ranges: every offset of delivery i is below every offset of delivery i+1
    bounds = [p.agg(F.min("offset"), F.max("offset")).first() for p in parts]
    assert bounds[0][1] < bounds[1][0] and bounds[1][1] < bounds[2][0]
