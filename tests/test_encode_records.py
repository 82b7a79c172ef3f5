"""Publishing of records that are no item transactions."""

import json

from skuflow.sources.codec import decode_transactions, encode_records, encode_transactions


def test_every_column_is_sent(spark):
    rows = [(1, "a", ["x", "y"], {"k": 1}, None), (2, None, None, None, 2.5)]
    df = spark.createDataFrame(rows, "id long, `event.type` string, tags array<string>, props map<string,int>, price double")
    got = {r["key"]: json.loads(r["value"]) for r in encode_records(df, "id").collect()}
    assert got == {"1": {"id": 1, "event.type": "a", "tags": ["x", "y"], "props": {"k": 1}}, "2": {"id": 2, "price": 2.5}}
    some = {r["key"]: json.loads(r["value"]) for r in encode_records(df, "event.type", ("id",)).collect()}
    assert some == {"a": {"id": 1}, None: {"id": 2}}


def test_transactions_are_sent_alike(spark, tx):
    df = tx([("s1", "Item-1", "SALE", 3, 1.5), ("s2", None, "RESTOCK", 2, None)])
    assert encode_records(df, "storeName").collect() == encode_transactions(df).collect()
    assert decode_transactions(encode_records(df, "storeName"), keep=()).count() == 2
