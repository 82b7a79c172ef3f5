"""Property tests: the Spark operators against a sequential fold of the
reference semantics, on random transaction sequences (nulls, odd types)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skuflow import item_changelog, item_changelog_compacted, item_stock, store_item_stock
from skuflow.schema import TRANSACTION

TYPES = st.sampled_from(["SALE", "RESTOCK", "sale", "ADJUST", None])
SKUS = st.sampled_from(["A", "B", "", None])
STORES = st.sampled_from(["s1", "s2", None])
QTY = st.one_of(st.none(), st.integers(min_value=-1000, max_value=1000))
TXS = st.lists(st.tuples(STORES, SKUS, TYPES, QTY), min_size=0, max_size=40)


def fold(rows):
    """The reference, one record at a time: (per-item stock, changelog, per store-item stock)."""
    stock, changes, store = {}, [], {}
    for i, (s, sku, t, q) in enumerate(rows):
        if sku is None:
            continue
        d = -(q or 0) if t == "SALE" else (q or 0)
        stock[sku] = stock.get(sku, 0) + d
        store[(s, sku)] = store.get((s, sku), 0) + d
        changes.append((i, sku, stock[sku]))
    return stock, changes, store


def frame(spark, rows):
    return spark.createDataFrame([(i, s, k, q, t, None, None) for i, (s, k, t, q) in enumerate(rows)], TRANSACTION)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=TXS, width=st.sampled_from([1, 3, 16]))
def test_batch_operators_equal_sequential_fold(spark, rows, width):
    stock, changes, store = fold(rows)
    df = frame(spark, rows)
    assert {r.itemID: r.currentStock for r in item_stock(df).collect()} == stock
    got = sorted(tuple(r) for r in item_changelog(df, block_width=width).collect())
    assert got == sorted(changes)
    assert {(r.storeName, r.itemID): r.currentStock for r in store_item_stock(df).collect()} == store
    # compacted = last change per (item, batch of 5 ids)
    last = {}
    for i, sku, v in changes:
        last[(i // 5, sku)] = (i, v)
    comp = {(r.batch, r.itemID): (r.id, r.currentStock)
            for r in item_changelog_compacted(df, batch_width=5, block_width=width).collect()}
    assert comp == last
