"""Golden cases G1–G6 and the sign / null rules."""

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from conftest import stock_map
from skuflow import item_stock, seeded_stock, signed_delta, store_item_stock
from skuflow.functions import signed_quantity
from skuflow.schema import TRANSACTION


def test_g1_sale_subtracts(tx):
    assert stock_map(item_stock(tx([(None, "Item_1", "SALE", 10)]))) == {"Item_1": -10}


def test_g2_restock_adds(tx):
    assert stock_map(item_stock(tx([(None, "Item_1", "RESTOCK", 10)]))) == {"Item_1": 10}


def test_g3_restock_then_sale(tx):
    rows = [(None, "Item_1", "RESTOCK", 10), (None, "Item_1", "SALE", 10)]
    assert stock_map(item_stock(tx(rows))) == {"Item_1": 0}


def test_g4_two_items_one_store(tx):
    rows = [("Store-1", "Item-1", "RESTOCK", 5, 33.2), ("Store-1", "Item-2", "RESTOCK", 10, 33.2)]
    assert stock_map(item_stock(tx(rows))) == {"Item-1": 5, "Item-2": 10}


def test_g5_sum_across_stores(tx):
    rows = [("Store-1", "Item-1", "RESTOCK", 5, 33.2), ("Store-2", "Item-1", "RESTOCK", 10, 33.2)]
    assert stock_map(item_stock(tx(rows))) == {"Item-1": 15}


def test_g6_sold_out(tx):
    rows = [("Store-1", "Item-1", "RESTOCK", 5, 33.2), ("Store-1", "Item-1", "SALE", 5, 33.2)]
    assert stock_map(item_stock(tx(rows))) == {"Item-1": 0}


def test_everything_but_exact_sale_adds(tx):
    rows = [
        ("s", "A", None, 3),  # null type adds
        ("s", "A", "sale", 4),  # lower case adds
        ("s", "A", "ADJUST", 5),  # unknown adds
        ("s", "A", "SALE", 1),
    ]
    assert stock_map(item_stock(tx(rows))) == {"A": 11}


def test_null_sku_dropped_empty_sku_kept(tx):
    rows = [("s", None, "RESTOCK", 3), ("s", "", "RESTOCK", 4), ("s", "", "SALE", 1)]
    assert stock_map(item_stock(tx(rows))) == {"": 3}


def test_missing_quantity_is_zero_and_stock_goes_negative(tx):
    rows = [("s", "A", "RESTOCK", None), ("s", "A", "SALE", 7)]
    assert stock_map(item_stock(tx(rows))) == {"A": -7}


def test_quantity_widened_to_long(tx):
    big = 2**31 - 1
    rows = [("s", "A", "RESTOCK", big), ("s", "A", "RESTOCK", big), ("s", "B", "SALE", big)]
    got = stock_map(item_stock(tx(rows)))
    assert got == {"A": 2 * big, "B": -big}


def test_long_overflow_raises_under_ansi(spark):
    df = spark.createDataFrame([("A", 2**62), ("A", 2**62)], "itemID string, delta long")
    with pytest.raises(ArithmeticException):
        df.groupBy("itemID").agg(F.sum("delta")).collect()


def test_signed_delta_rekeys(tx):
    d = signed_delta(tx([("Store-1", "Item-1", "SALE", 2), ("Store-2", None, "RESTOCK", 3)]))
    assert [tuple(r) for r in d.orderBy("id").collect()] == [(0, "Store-1", "Item-1", -2), (1, "Store-2", None, 3)]


def test_signed_quantity_column(spark):
    df = spark.createDataFrame([("SALE", 2), ("RESTOCK", 2), (None, None)], "type string, quantity int")
    assert [r[0] for r in df.select(signed_quantity()).collect()] == [-2, 2, 0]


def test_store_item_stock_g9_and_g10(tx):
    g9 = [
        ("Store-1", "Item-1", "RESTOCK", 6, 33.2),
        ("Store-2", "Item-1", "RESTOCK", 5, 30.2),
        ("Store-1", "Item-1", "SALE", 2, 33.2),
        ("Store-2", "Item-1", "SALE", 3, 30.2),
    ]
    got = {(r.storeName, r.itemID): r.currentStock for r in store_item_stock(tx(g9)).collect()}
    assert got == {("Store-1", "Item-1"): 4, ("Store-2", "Item-1"): 2}
    g10 = [
        ("Store-3", "Item-1", "RESTOCK", 5),
        ("Store-3", "Item-1", "SALE", 2, 10.0),
        ("Store-4", "Item-2", "RESTOCK", 20),
        ("Store-4", "Item-3", "RESTOCK", 30),
        ("Store-4", "Item-3", "SALE", 5, 6.0),
    ]
    got = {(r.storeName, r.itemID): r.currentStock for r in store_item_stock(tx(g10)).collect()}
    assert got == {("Store-3", "Item-1"): 3, ("Store-4", "Item-2"): 20, ("Store-4", "Item-3"): 25}
    assert stock_map(item_stock(tx(g10))) == {"Item-1": 3, "Item-2": 20, "Item-3": 25}


def test_seeded_stock(spark, tx):
    opening = spark.createDataFrame([("A", 100), ("B", 5), (None, 9)], "itemID string, currentStock long")
    moves = tx([("s", "A", "SALE", 10), ("s", "C", "RESTOCK", 4)])
    assert stock_map(seeded_stock(opening, moves)) == {"A": 90, "B": 5, "C": 4}


def test_item_stock_plan_is_partial_then_final(spark, tx):
    plan = item_stock(tx([("s", "A", "SALE", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_schema_of_results(tx):
    df = item_stock(tx([("s", "A", "SALE", 1)]))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("itemID", "string"),
        ("currentStock", "bigint"),
    ]
    assert TRANSACTION["quantity"].dataType.simpleString() == "int"


def test_flagship_scan_is_column_pruned(spark):
    from skuflow.sources.tables import lineitem_transactions

    plan = item_stock(lineitem_transactions(spark, "/root/testdata/sf0.001"))._jdf.queryExecution() \
        .executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    cols = scan.split("FileScan parquet [")[1].split("]")[0].split(",")
    assert sorted(c.split("#")[0] for c in cols) == ["l_partkey", "l_quantity", "l_returnflag"]
