"""Changelogs G7–G9, and the skew-safe running sum against brute force."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skuflow import item_changelog, item_changelog_compacted, running_stock, store_item_changelog
from skuflow.operators.changelog import running_sum


def _seq(df, key="Item-1"):
    return [r.currentStock for r in df.where(F.col("itemID") == key).orderBy("id").collect()]


def test_g7_changelog(tx):
    rows = [("Store-1", "Item-1", "RESTOCK", 5, 33.2), ("Store-1", "Item-1", "SALE", 2, 33.2)]
    assert _seq(item_changelog(tx(rows))) == [5, 3]


def test_g8_changelog_null_price(tx):
    rows = [("Store-1", "Item-1", "RESTOCK", 5), ("Store-1", "Item-1", "RESTOCK", 2)]
    assert _seq(item_changelog(tx(rows))) == [5, 7]


G9 = [
    ("Store-1", "Item-1", "RESTOCK", 6, 33.2),
    ("Store-2", "Item-1", "RESTOCK", 5, 30.2),
    ("Store-1", "Item-1", "SALE", 2, 33.2),
    ("Store-2", "Item-1", "SALE", 3, 30.2),
]


def test_g9_changelog_every_change(tx):
    assert _seq(item_changelog(tx(G9))) == [6, 11, 9, 6]


def test_g9_with_tiny_blocks(tx):
    # block width 1 puts every row in its own block: offsets carry the sums.
    for w in (1, 2, 3):
        assert _seq(item_changelog(tx(G9), block_width=w)) == [6, 11, 9, 6]


def test_g9_store_item_changelog(tx):
    got = [(r.storeName, r.currentStock) for r in store_item_changelog(tx(G9)).orderBy("id").collect()]
    assert got == [("Store-1", 6), ("Store-2", 5), ("Store-1", 4), ("Store-2", 2)]


def test_compacted_changelog(tx):
    rows = G9 + [("Store-1", "Item-2", "RESTOCK", 1)]
    got = [tuple(r) for r in item_changelog_compacted(tx(rows), batch_width=2, block_width=1)
           .orderBy("itemID", "batch").collect()]
    # batches: ids {0,1} -> 11, {2,3} -> 6 ; Item-2 id 4 -> batch 2
    assert got == [(0, "Item-1", 1, 11), (1, "Item-1", 3, 6), (2, "Item-2", 4, 1)]


def test_running_sum_matches_window_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "HOT" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}"
        rows.append((key, i * 3 + rnd.randint(0, 2), rnd.randint(-50, 50)))
    df = spark.createDataFrame(rows, "k string, o long, v long")
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.k, r.o): r.s for r in df.select("k", "o", F.sum("v").over(w).alias("s")).collect()}
    for width in (1, 7, 64, 1 << 20):
        got = {(r.k, r.o): r.s for r in running_sum(df, ["k"], "o", "v", "s", width).collect()}
        assert got == want, width


def test_running_sum_negative_order_values(spark):
    df = spark.createDataFrame([("a", -5, 1), ("a", -1, 2), ("a", 0, 3), ("a", 4, 4)], "k string, o long, v long")
    got = [r.s for r in running_sum(df, ["k"], "o", "v", "s", 2).orderBy("o").collect()]
    assert got == [1, 3, 6, 10]


def test_hot_key_is_spread_over_blocks(spark):
    # One key, 4,000 rows, block width 500: the per-row window gets 8 partitions
    # (key, block), not one.
    df = spark.range(4000).select(F.lit("HOT").alias("k"), F.col("id").alias("o"), F.lit(1).cast("long").alias("v"))
    out = running_sum(df, ["k"], "o", "v", "s", 500)
    assert out.agg(F.max("s")).first()[0] == 4000
    blocks = df.select(F.expr("(o - pmod(o, 500)) div 500").alias("b")).distinct().count()
    assert blocks == 8


def test_null_store_and_null_order_rows_are_kept(spark):
    from skuflow.schema import TRANSACTION

    rows = [
        (0, None, "A", 5, "RESTOCK", None, None),
        (1, None, "A", 2, "SALE", None, None),
        (None, "s", "A", 1, "RESTOCK", None, None),
        (2, "s", "A", 4, "RESTOCK", None, None),
    ]
    df = spark.createDataFrame(rows, TRANSACTION)
    got = sorted((r.id if r.id is not None else -1, r.storeName, r.currentStock)
                 for r in store_item_changelog(df, block_width=1).collect())
    # null store is its own group; the null-order row comes first in its group
    assert got == [(-1, "s", 1), (0, None, 5), (1, None, 3), (2, "s", 5)]
    items = sorted((r.id if r.id is not None else -1, r.currentStock) for r in item_changelog(df).collect())
    assert items == [(-1, 1), (0, 6), (1, 4), (2, 8)]


def test_changelog_with_composite_kafka_order(spark):
    # (timestamp ms, partition, offset): equal timestamps are broken by partition, then offset
    from pyspark.sql import types as T

    from skuflow.schema import TRANSACTION

    rows = [  # id, store, sku, quantity, type, ts_ms, partition, offset
        (10, "s", "A", 5, "RESTOCK", 1000, 1, 7),
        (11, "s", "A", 2, "SALE", 1000, 0, 9),
        (12, "s", "A", 1, "SALE", 999, 2, 3),
        (13, "s", "A", 4, "RESTOCK", 1000, 1, 8),
    ]
    df = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], r[4], None, None, r[5], r[6], r[7]) for r in rows],
        T.StructType(TRANSACTION.fields + [T.StructField("ts_ms", T.LongType()),
                                           T.StructField("partition", T.IntegerType()),
                                           T.StructField("offset", T.LongType())]),
    )
    order = ["ts_ms", "partition", "offset"]
    # sequence: 12 (-1), 11 (-2), 10 (+5), 13 (+4)
    for w in (1, 1000, 1 << 20):
        got = {r.id: r.currentStock for r in running_stock(df, ["itemID"], order, w).collect()}
        assert got == {12: -1, 11: -3, 10: 2, 13: 6}
    cl = item_changelog(df, order=order)
    assert cl.columns == ["ts_ms", "partition", "offset", "itemID", "currentStock"]


def test_compacted_changelog_per_store_and_item(tx):
    got = sorted(tuple(r) for r in item_changelog_compacted(tx(G9), batch_width=2, keys=("storeName", "itemID"))
                 .collect())
    # batch 0: ids 0 (s1 +6), 1 (s2 +5); batch 1: ids 2 (s1 -2), 3 (s2 -3)
    assert got == [(0, "Store-1", "Item-1", 0, 6), (0, "Store-2", "Item-1", 1, 5),
                   (1, "Store-1", "Item-1", 2, 4), (1, "Store-2", "Item-1", 3, 2)]


def test_compacted_changelog_by_time_interval_and_composite_order(spark):
    from pyspark.sql import types as T

    from skuflow.operators.changelog import floor_div
    from skuflow.schema import TRANSACTION

    rows = [  # id, sku, quantity, type, ts_ms, partition, offset
        (0, "A", 5, "RESTOCK", 1_000, 0, 0),
        (1, "A", 2, "SALE", 29_999, 1, 0),  # same 30 s interval
        (2, "A", 1, "SALE", 29_999, 0, 1),  # tie on time: partition 0 before 1
        (3, "A", 4, "RESTOCK", 30_000, 0, 2),  # next interval
    ]
    schema = T.StructType(TRANSACTION.fields + [T.StructField("ts_ms", T.LongType()),
                                               T.StructField("partition", T.IntegerType()),
                                               T.StructField("offset", T.LongType())])
    df = spark.createDataFrame([(r[0], "s", r[1], r[2], r[3], None, None, r[4], r[5], r[6]) for r in rows], schema)
    out = item_changelog_compacted(df, order=["ts_ms", "partition", "offset"], batch=floor_div("ts_ms", 30_000),
                                   block_width=1)
    got = sorted(tuple(r) for r in out.collect())
    # interval 0: order 0 (+5), 2 (-1), 1 (-2) -> last row is (29999, p1, o0) with 2; interval 1: +4 -> 6
    assert got == [(0, "A", 29_999, 1, 0, 2), (1, "A", 30_000, 0, 2, 6)]


def _plain(rows):
    """Running sums by plain loops: (key, order...) sorted, nulls first."""
    seen, out = {}, []
    for k, *order, v, i in sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r[:-2])):
        seen[k] = seen.get(k, 0) + (v or 0)
        out.append((k, *order, v, i, seen[k]))
    return out


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ordered_running_sum_splits_a_hot_key_of_one_millisecond(spark, partitions):
    from skuflow.operators.changelog import ordered_running_sum

    rows = [("hot", 5, i, (i * 7) % 11 - 5, i) for i in range(400)] + [(k, i % 3, i, 1, i) for i in range(40) for k in ("a", "z", None)]
    rows += [("late", i, 0, None if i % 4 == 0 else i, i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, ts long, o long, v long, id long").repartition(5)
    got = ordered_running_sum(df, ["k"], ["ts", "o"], "v", "run", partitions)
    assert sorted(map(str, _plain(rows))) == sorted(str(tuple(r)) for r in got.collect())


def test_ordered_running_sum_of_an_all_null_order_is_split(spark):
    from skuflow.operators.changelog import ordered_running_sum

    df = spark.range(2000).selectExpr("'k' AS k", "CAST(NULL AS long) AS ts", "CAST(NULL AS long) AS o", "1L AS v", "id")
    out = ordered_running_sum(df, ["k"], ["ts", "o"], "v", "run", 8)
    assert sorted(r["run"] for r in out.collect()) == list(range(1, 2001))
    # the rows lie in files of like size, not in one
    counts = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows for f in out.inputFiles()]
    assert len(counts) == 8 and max(counts) < 600


def test_ordered_running_sum_overflow_fails(spark):
    from skuflow.operators.changelog import ordered_running_sum

    df = spark.createDataFrame([("k", 1, 1, 2**63 - 1), ("k", 1, 2, 1)], "k string, ts long, o long, v long")
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        ordered_running_sum(df, ["k"], ["ts", "o"], "v", "run", 1).collect()
    none = ordered_running_sum(df.where("false"), ["k"], ["ts", "o"], "v", "run")
    assert none.count() == 0
