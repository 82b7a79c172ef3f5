"""JSON decode policy, G10 and G12, encoders."""

import json

import pytest
from pyspark.errors import PySparkException

from skuflow.schema import ENVELOPE
from skuflow.sources.codec import (
    decode_inventory,
    decode_transactions,
    encode_inventory,
    encode_transactions,
    quarantine_inventory,
    quarantine_transactions,
)

G10 = [
    '{"id": 0, "storeName": "Store-3", "sku": "Item-1", "type": "RESTOCK", "quantity": 5}',
    '{"id": 1, "storeName": "Store-3", "sku": "Item-1", "type": "SALE", "quantity": 2, "price": 10.0}',
    '{"id": 2, "storeName": "Store-4", "sku": "Item-2", "type": "RESTOCK", "quantity": 20}',
    '{"id": 3, "storeName": "Store-4", "sku": "Item-3", "type": "RESTOCK", "quantity": 30}',
    '{"id": 4, "storeName": "Store-4", "sku": "Item-3", "type": "SALE", "quantity": 5, "price": 6.0}',
]


def envelope(spark, values, keys=None):
    rows = [("items", 0, i, (keys[i] if keys else None), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def decode_one(spark, value):
    env = envelope(spark, [value])
    good = decode_transactions(env, "permissive").collect()
    bad = quarantine_transactions(env).collect()
    return (good[0] if good else None), (bad[0].reason if bad else None)


def test_g10_decode_and_stock(spark):
    from skuflow import item_stock

    tx = decode_transactions(envelope(spark, G10), "strict")
    assert {r.itemID: r.currentStock for r in item_stock(tx).collect()} == {"Item-1": 3, "Item-2": 20, "Item-3": 25}
    first = tx.orderBy("offset").first()
    assert (first.id, first.storeName, first.quantity, first.price) == (0, "Store-3", 5, None)


@pytest.mark.parametrize(
    "value, quantity",
    [
        ('{"sku":"A"}', 0),  # missing quantity -> 0
        ('{"sku":"A","quantity":null}', 0),  # null quantity -> 0
        ('{"sku":"A","quantity":"5"}', 5),  # quoted number coerced
        ('{"sku":"A","quantity":5.7}', 5),  # fraction truncated
        ('{"sku":"A","quantity":-5.7}', -5),  # toward zero
        ('{"sku":5,"quantity":1}', 1),  # number for string is text
        ('{"sku":"A","quantity":1} junk', 1),  # trailing text ignored
    ],
)
def test_accepted(spark, value, quantity):
    good, reason = decode_one(spark, value)
    assert reason is None and good is not None
    assert good.quantity == quantity


@pytest.mark.parametrize(
    "value, reason",
    [
        ('{"sku":"A","quantity":3000000000}', "bad quantity"),
        ('{"sku":"A","quantity":"many"}', "bad quantity"),
        ('{"sku":"A","quantity":true}', "bad quantity"),
        ('{"sku":"A","colour":"red"}', "unknown field"),
        ('{"SKU":"A","quantity":1}', "unknown field"),  # names are case-sensitive
        ('{"StoreName":"store_1","quantity": 1}', "unknown field"),  # G12 value
        ("not json", "not a JSON object"),
        ("[]", "not a JSON object"),
        ('[{"sku":"A"}]', "not a JSON object"),
        ("null", "not a JSON object"),
        ("", "not a JSON object"),
        (None, "null value"),
        ('{"sku":"A","id":"x"}', "bad id"),
        ('{"sku":"A","price":"cheap"}', "bad price"),
    ],
)
def test_corrupt(spark, value, reason):
    good, got = decode_one(spark, value)
    assert good is None
    assert got == reason


def test_empty_object_decodes_to_null_sku(spark):
    good, reason = decode_one(spark, "{}")
    assert reason is None and good.sku is None and good.quantity == 0


def test_strict_raises(spark):
    env = envelope(spark, G10 + ['{"StoreName":"store_1","quantity": 1}'])
    with pytest.raises(PySparkException, match="corrupt item transaction"):
        decode_transactions(env, "strict").select("sku").collect()


def test_strict_check_survives_column_pruning(spark):
    env = envelope(spark, ["not json"])
    with pytest.raises(PySparkException):
        decode_transactions(env, "strict").select("offset").count()


def test_g12_keyed_round_trip(spark):
    env = envelope(spark, ['{"StoreName":"store_1","quantity": 1}'], keys=["Item_01"])
    r = env.first()
    assert (r.key, r.value) == ("Item_01", '{"StoreName":"store_1","quantity": 1}')
    assert quarantine_transactions(env).first().reason == "unknown field"


def test_encode_transactions_round_trip(spark, tx):
    src = tx([("Store-1", "Item-1", "SALE", 2, 10.5), ("Store-2", None, "RESTOCK", 3)])
    enc = encode_transactions(src)
    rows = enc.orderBy("key").collect()
    assert rows[0].key == "Store-1"
    assert json.loads(rows[1].value) == {"id": 1, "storeName": "Store-2", "quantity": 3, "type": "RESTOCK"}
    env = envelope(spark, [r.value for r in rows])
    back = decode_transactions(env, "strict").orderBy("id").collect()
    assert [(b.storeName, b.sku, b.quantity, b.type, b.price) for b in back] == [
        ("Store-1", "Item-1", 2, "SALE", 10.5),
        ("Store-2", None, 3, "RESTOCK", None),
    ]


def test_encode_inventory_writes_nulls(spark):
    df = spark.createDataFrame([("A", 3), ("B", None)], "itemID string, currentStock long")
    got = {r.key: r.value for r in encode_inventory(df).collect()}
    assert got == {"A": '{"itemID":"A","currentStock":3}', "B": '{"itemID":"B","currentStock":null}'}


def test_inventory_decode_round_trip_and_policy(spark):
    from skuflow.sources.codec import decode_inventory, quarantine_inventory

    stock = spark.createDataFrame([("Item-1", 5), ("Item-2", -3), ("Item-3", None)], "itemID string, currentStock long")
    back = {r.itemID: r.currentStock for r in decode_inventory(encode_inventory(stock), "strict").collect()}
    assert back == {"Item-1": 5, "Item-2": -3, "Item-3": None}
    env = envelope(spark, [
        '{"itemID":"A"}',  # absent stock: the record's default 0
        '{"itemID":"B","currentStock":null}',  # explicit null stays null
        '{"itemID":"C","currentStock":"7"}',  # quoted number
        '{"itemID":"D","currentStock":1,"extra":1}',
        '{"itemID":"E","currentStock":"lots"}',
        "[]",
    ])
    good = {r.itemID: r.currentStock for r in decode_inventory(env).collect()}
    assert good == {"A": 0, "B": None, "C": 7}
    bad = {r.offset: r.reason for r in quarantine_inventory(env).collect()}
    assert bad == {3: "unknown field", 4: "bad currentStock", 5: "not a JSON object"}
    with pytest.raises(PySparkException, match="corrupt inventory"):
        decode_inventory(env, "strict").collect()


def test_json_is_parsed_once_per_record(spark):
    from skuflow.sources.messages import events_messages

    plan = decode_transactions(events_messages(spark, "/root/testdata/sf0.001"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("from_json(") == 1


# Numbers that a strict reader refuses or must not alter.
@pytest.mark.parametrize("field, text", [
    ("id", "1e30"), ("id", "99999999999999999999999"), ("id", '"NaN"'), ("quantity", '"NaN"'), ("quantity", '"5d"'),
    ("quantity", '"5f"'), ("quantity", '"0x1p3"')])
def test_bad_numbers_are_corrupt(spark, field, text):
    df = spark.createDataFrame([("items", 0, 0, "s", f'{{"sku":"A","{field}":{text}}}')],
                               "topic string, partition int, offset long, key string, value string")
    assert decode_transactions(df, "permissive").count() == 0
    assert quarantine_transactions(df).collect()[0]["reason"] == f"bad {field}"


def test_large_fractional_id_and_single_quotes_are_corrupt(spark):
    rows = [("items", 0, 0, "s", '{"sku":"A","id":9007199254740993.0}'), ("items", 0, 1, "s", "{'sku':'A','quantity':3}")]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string")
    assert decode_transactions(df, "permissive").count() == 0
    assert quarantine_transactions(df).count() == 2


@pytest.mark.parametrize("value, reason", [
    ('{"sku":{"a":1},"quantity":1}', "bad sku"),
    ('{"sku":"A","storeName":["x"]}', "bad storeName"),
    ('{"sku":"A","type":{}}', "bad type"),
    ('{"sku":"A","quantity":"5.7"}', "bad quantity"),
    ('{"sku":"A","quantity":"5.0"}', "bad quantity"),
    ('{"sku":"A","quantity":"1e2"}', "bad quantity"),
    ('{"sku":"A","id":"3.5"}', "bad id"),
    # a text that looks like an object, bare fractions and quoted integers are as declared
    ('{"sku":"{\\"a\\":1}","quantity":5.7}', None),
    ('{"sku":"[x]","quantity":"5"}', None),
    ('{"sku":"A","quantity":" 5 ","price":"1.5"}', None),
    ('{"sku":5,"type":true,"quantity":1e2}', None),
])
def test_json_types_of_fields(spark, value, reason):
    msgs = spark.createDataFrame([("items", 0, 0, "k", value)], "topic string, partition int, offset long, key string, value string")
    assert [r["reason"] for r in quarantine_transactions(msgs).collect()] == ([reason] if reason else [])
    assert decode_transactions(msgs, "permissive").count() == (0 if reason else 1)


def test_inventory_types_of_fields(spark):
    rows = ['{"itemID":{"x":1},"currentStock":1}', '{"itemID":"a","currentStock":"2.5"}', '{"itemID":"{}","currentStock":3}']
    msgs = spark.createDataFrame([("t", 0, i, "k", v) for i, v in enumerate(rows)], "topic string, partition int, offset long, key string, value string")
    assert [r["reason"] for r in quarantine_inventory(msgs).orderBy("offset").collect()] == ["bad itemID", "bad currentStock"]
    assert [(r["itemID"], r["currentStock"]) for r in decode_inventory(msgs).collect()] == [("{}", 3)]
