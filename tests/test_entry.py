"""Driver contract: entry(), queries(), oracle_sql() and adapter anchors."""

import duckdb
import pytest

import __spark_entry__ as E
from skuflow.sources.tables import events_transactions, lineitem_transactions
from skuflow import item_stock, store_item_stock
from tools.compare import same

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["itemID", "currentStock"]
    assert df.count() == 200


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert {"item_stock", "item_changelog", "item_stock_stream"} <= set(E.oracle_sql())


def test_anchor_values_sf0001(spark):
    # FIXTURES §3 anchors
    ev = events_transactions(spark, SF)
    assert ev.where("sku is not null").count() == 986
    s = {r.itemID: r.currentStock for r in item_stock(ev).collect()}
    assert (len(s), sum(s.values()), s["Item-1"], s["Item-2"], s["Item-3"]) == (99, 8851, 109, -97, -39)
    li = lineitem_transactions(spark, SF)
    s = {r.itemID: r.currentStock for r in item_stock(li).collect()}
    assert (len(s), sum(s.values()), s["Item-1"]) == (200, 53575, 449)
    assert store_item_stock(li).count() == 1905


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in ("events", "lineitem", "part", "customer", "pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name]).df()
    got = E.queries()[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert same(got, want)
