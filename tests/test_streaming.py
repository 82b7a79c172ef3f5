"""Streams over the file stand-in for the topic: G9/G10/G11, restart, state reads."""

import json

import pytest
from pyspark.sql import functions as F

from skuflow.config import scratch_path
from skuflow.schema import ENVELOPE
from skuflow.sources.messages import read_topic_files, topic_to_files
from skuflow.streaming import pipeline as P
from skuflow.streaming import state as S


def _msg(i, store, sku, typ, qty, price=None):
    d = {"id": i, "storeName": store, "sku": sku, "type": typ, "quantity": qty}
    if price is not None:
        d["price"] = price
    return ("items", 0, i, store, json.dumps(d))


def _deliver(spark, src, rows):
    topic_to_files(spark.createDataFrame(rows, ENVELOPE).coalesce(1), src, mode="append")


G9 = [
    _msg(0, "Store-1", "Item-1", "RESTOCK", 6, 33.2),
    _msg(1, "Store-2", "Item-1", "RESTOCK", 5, 30.2),
    _msg(2, "Store-1", "Item-1", "SALE", 2, 33.2),
    _msg(3, "Store-2", "Item-1", "SALE", 3, 30.2),
]


def test_g9_changelog_stream_one_message_per_batch(spark):
    paths = P.StreamPaths(scratch_path(spark, "t-g9"))
    src = f"{paths.root}/topic"
    for m in G9:  # four deliveries -> four micro-batches, state carried across them
        _deliver(spark, src, [m])
        P.run_to_end(P.item_changelog_query(read_topic_files(spark, src, streaming=True), paths, block_width=1))
    got = [r.currentStock for r in P.read_changelog(spark, paths).orderBy("id").collect()]
    assert got == [6, 11, 9, 6]


def test_g9_changelog_stream_single_batch_orders_by_offset(spark):
    paths = P.StreamPaths(scratch_path(spark, "t-g9b"))
    src = f"{paths.root}/topic"
    _deliver(spark, src, list(reversed(G9)))
    P.run_to_end(P.item_changelog_query(read_topic_files(spark, src, streaming=True), paths))
    got = [r.currentStock for r in P.read_changelog(spark, paths).orderBy("id").collect()]
    assert got == [6, 11, 9, 6]


def test_g10_g11_stock_stream_and_replay(spark):
    paths = P.StreamPaths(scratch_path(spark, "t-g10"))
    src = f"{paths.root}/topic"
    g10 = [
        _msg(0, "Store-3", "Item-1", "RESTOCK", 5),
        _msg(1, "Store-3", "Item-1", "SALE", 2, 10.0),
        _msg(2, "Store-4", "Item-2", "RESTOCK", 20),
    ]
    _deliver(spark, src, g10)
    P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), paths, policy="permissive"))
    _deliver(spark, src, [_msg(3, "Store-4", "Item-3", "RESTOCK", 30), _msg(4, "Store-4", "Item-3", "SALE", 5, 6.0),
                          ("items", 0, 5, "x", "not json")])
    P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), paths, policy="permissive"))
    snap = {r.itemID: r.currentStock for r in P.stock_snapshot(spark, paths).collect()}
    assert snap == {"Item-1": 3, "Item-2": 20, "Item-3": 25}
    assert {r.itemID: r.currentStock for r in P.stock_snapshot(spark, paths, source="log").collect()} == snap
    # update mode: the second batch only re-emitted the item it changed
    log = P.read_snapshot_log(spark, paths.stock_log)
    assert {r.itemID for r in log.where(F.col("batch_id") == 1).collect()} == {"Item-3"}
    # restart on the same checkpoint with nothing new: nothing is re-read
    q = P.item_stock_query(read_topic_files(spark, src, streaming=True), paths, policy="permissive")
    P.run_to_end(q)
    assert not any(p.get("numInputRows", 0) for p in q.recentProgress)
    # state readers
    req = spark.createDataFrame([("Item-1",), ("Item-404",)], "itemID string")
    found = {tuple(r) for r in S.stock_point_lookup(spark, paths.stock_checkpoint, req).collect()}
    assert found == {("Item-1", True, 3), ("Item-404", False, None)}
    at0 = {r.itemID: r.currentStock for r in S.read_stock_state(spark, paths.stock_checkpoint, batch_id=0).collect()}
    assert at0 == {"Item-1": 3, "Item-2": 20}
    meta = S.store_metadata(spark, paths.stock_checkpoint).first()
    assert meta.storeName == "ItemStock" and meta.numKeys == 3 and len(meta.statePartitions) >= 1
    assert all(isinstance(p, int) for p in meta.statePartitions) and meta.statePartitions == sorted(meta.statePartitions)
    assert (meta.stateStoreName, meta.minBatchId, meta.maxBatchId) == ("default", 0, 1)
    # the corrupt message is quarantined by the side query
    P.run_to_end(P.quarantine_query(read_topic_files(spark, src, streaming=True), paths))
    bad = spark.read.parquet(paths.quarantine).collect()
    assert [(b.offset, b.reason) for b in bad] == [(5, "not a JSON object")]


def test_g11_new_checkpoint_replays_everything(spark):
    src_paths = P.StreamPaths(scratch_path(spark, "t-g11"))
    src = f"{src_paths.root}/topic"
    _deliver(spark, src, [_msg(0, "Store-1", "Item-1", "RESTOCK", 5), _msg(1, "Store-1", "Item-1", "SALE", 2, 30.0)])
    P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), src_paths))
    other = P.StreamPaths(scratch_path(spark, "t-g11-new"))
    P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), other))
    for p in (src_paths, other):
        assert {r.itemID: r.currentStock for r in P.stock_snapshot(spark, p).collect()} == {"Item-1": 3}


def test_stream_equals_batch_on_random_input(spark):
    import random

    from skuflow import item_changelog
    from skuflow.sources.codec import decode_transactions

    rnd = random.Random(11)
    rows = [_msg(i, f"Store-{rnd.randint(0, 3)}", f"Item-{rnd.choice([0, 1, 1, 1, 2])}",
                 rnd.choice(["SALE", "RESTOCK", "ADJUST"]), rnd.randint(0, 20)) for i in range(120)]
    paths = P.StreamPaths(scratch_path(spark, "t-eq"))
    src = f"{paths.root}/topic"
    for lo in range(0, 120, 40):  # three deliveries, three runs
        _deliver(spark, src, rows[lo:lo + 40])
        P.run_to_end(P.item_changelog_query(read_topic_files(spark, src, streaming=True), paths, block_width=8))
        P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), paths))
    batch_tx = decode_transactions(spark.createDataFrame(rows, ENVELOPE), "strict")
    want = sorted(tuple(r) for r in item_changelog(batch_tx).collect())
    got = sorted(tuple(r) for r in P.read_changelog(spark, paths).select("id", "itemID", "currentStock").collect())
    assert got == want
    final = {r.itemID: r.currentStock for r in P.stock_snapshot(spark, paths).collect()}
    last = {}
    for i, item, v in sorted(want):
        last[item] = v
    assert final == last


def test_console_trace_sink_runs(spark, capsys):
    from skuflow.operators.stock import item_stock
    from skuflow.sources.codec import decode_transactions
    from skuflow.streaming.sinks import console_trace_sink

    paths = P.StreamPaths(scratch_path(spark, "t-console"))
    src = f"{paths.root}/topic"
    _deliver(spark, src, G9)
    stock = item_stock(decode_transactions(read_topic_files(spark, src, streaming=True)))
    q = console_trace_sink(stock, f"{paths.root}/checkpoint/console").trigger(availableNow=True).start()
    P.run_to_end(q)
    assert q.lastProgress["numInputRows"] == 4


def test_inventory_app_on_files(spark):
    from skuflow.streaming.app import AppConfig, start

    root = scratch_path(spark, "t-app")
    src = f"{root}/topic"
    _deliver(spark, src, G9 + [("items", 0, 4, "x", '{"StoreName":"store_1","quantity": 1}')])
    qs = start(spark, AppConfig(input_path=src, output_path=f"{root}/out", available_now=True))
    for q in qs.values():
        P.run_to_end(q)
    paths = P.StreamPaths(f"{root}/out/skuflow-inventory")
    assert {r.itemID: r.currentStock for r in P.stock_snapshot(spark, paths).collect()} == {"Item-1": 6}
    assert [r.reason for r in spark.read.parquet(paths.quarantine).collect()] == ["unknown field"]


def test_inventory_app_strict_fails_on_corrupt(spark):
    import pytest

    from skuflow.streaming.app import AppConfig, start

    root = scratch_path(spark, "t-app-strict")
    src = f"{root}/topic"
    _deliver(spark, src, G9 + [("items", 0, 4, "x", "not json")])
    qs = start(spark, AppConfig(input_path=src, output_path=f"{root}/out", available_now=True, policy="strict"))
    with pytest.raises(Exception, match="corrupt item transaction"):
        P.run_to_end(qs["inventory"])


def test_store_item_changelog_stream_null_store_across_batches(spark):
    paths = P.StreamPaths(scratch_path(spark, "t-store-cl"))
    src = f"{paths.root}/topic"
    first = [("items", 0, 0, None, '{"sku":"A","quantity":5}'), _msg(1, "s1", "A", "RESTOCK", 2)]
    second = [("items", 0, 2, None, '{"sku":"A","type":"SALE","quantity":1}'), _msg(3, "s1", "A", "SALE", 2)]
    for rows in (first, second):
        _deliver(spark, src, rows)
        P.run_to_end(P.item_changelog_query(read_topic_files(spark, src, streaming=True), paths,
                                            keys=P.STORE_ITEM_KEYS))
    got = [(r.offset_id, r.storeName, r.currentStock) for r in P.read_changelog(spark, paths, keys=P.STORE_ITEM_KEYS)
           .withColumnRenamed("id", "offset_id").orderBy("offset_id").collect()]
    # messages without an id decode with a null id; order them by store total instead
    def key(t):
        return (t[0] is None, t[0] or "", t[1])

    assert sorted(((s, v) for _, s, v in got), key=key) == sorted(
        [(None, 5), ("s1", 2), (None, 4), ("s1", 0)], key=key
    )


def test_changelog_stream_recovers_from_a_failed_batch(spark, monkeypatch):
    import pytest

    import skuflow.streaming.pipeline as pl

    paths = P.StreamPaths(scratch_path(spark, "t-fail"))
    src = f"{paths.root}/topic"
    _deliver(spark, src, G9[:2])
    P.run_to_end(P.item_changelog_query(read_topic_files(spark, src, streaming=True), paths))
    _deliver(spark, src, G9[2:])

    real_batch_dir = pl.batch_dir

    def failing_batch_dir(path, batch_id):
        # batch 1 writes its changelog rows, then "loses" the task writing totals
        if path == paths.totals and batch_id == 1:
            raise RuntimeError("simulated loss in the middle of a micro-batch")
        return real_batch_dir(path, batch_id)

    monkeypatch.setattr(pl, "batch_dir", failing_batch_dir)
    with pytest.raises(Exception):
        P.run_to_end(P.item_changelog_query(read_topic_files(spark, src, streaming=True), paths))
    monkeypatch.undo()
    # restart on the same checkpoint: the uncommitted batch runs again and
    # overwrites its own folders — no duplicate, no lost change
    P.run_to_end(P.item_changelog_query(read_topic_files(spark, src, streaming=True), paths))
    got = [r.currentStock for r in P.read_changelog(spark, paths).orderBy("id").collect()]
    assert got == [6, 11, 9, 6]


def test_stock_stream_recovers_from_a_failed_sink_write(spark, monkeypatch):
    import pytest

    import skuflow.streaming.pipeline as pl
    import skuflow.streaming.sinks as sk

    paths = P.StreamPaths(scratch_path(spark, "t-fail-stock"))
    src = f"{paths.root}/topic"
    _deliver(spark, src, G9[:2])
    P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), paths))
    _deliver(spark, src, G9[2:])

    def failing_writer(path):
        def write(df, batch_id):
            raise RuntimeError("simulated loss while writing the snapshot")
        return write

    monkeypatch.setattr(pl, "snapshot_writer", failing_writer)
    with pytest.raises(Exception):
        P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), paths))
    monkeypatch.undo()
    assert sk.snapshot_writer is pl.snapshot_writer
    # restart: the batch re-runs from the last committed state version, so the
    # aggregate is not applied twice
    P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), paths))
    assert {r.itemID: r.currentStock for r in P.stock_snapshot(spark, paths).collect()} == {"Item-1": 6}
    state = {r.itemID: r.currentStock for r in
             __import__("skuflow.streaming.state", fromlist=["x"]).read_stock_state(spark, paths.stock_checkpoint).collect()}
    assert state == {"Item-1": 6}


def test_stream_plan_pre_aggregates_before_the_state_shuffle(spark):
    paths = P.StreamPaths(scratch_path(spark, "t-plan"))
    src = f"{paths.root}/topic"
    _deliver(spark, src, G9)
    q = P.item_stock_query(read_topic_files(spark, src, streaming=True), paths)
    P.run_to_end(q)
    plan = q._jsq.explainInternal(False)
    assert "partial_sum" in plan and "StateStoreSave" in plan
    assert plan.index("StateStoreSave") < plan.index("Exchange hashpartitioning(itemID") < plan.index("partial_sum")


def test_state_settings_pinned_into_checkpoint_and_session_restored(spark):
    import glob
    import json as _json

    hdfs = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    key = "spark.sql.streaming.stateStore.providerClass"
    before_provider, before_parts = spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, hdfs)
    try:
        paths = P.StreamPaths(scratch_path(spark, "t-pin"))
        src = f"{paths.root}/topic"
        _deliver(spark, src, G9)
        P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), paths, state_partitions=3))
        assert spark.conf.get(key) == hdfs  # the session keeps its own setting
        assert spark.conf.get("spark.sql.shuffle.partitions") == before_parts
        offsets = sorted(glob.glob(paths.stock_checkpoint.replace("file:", "") + "/offsets/[0-9]*"))
        conf = _json.loads(open(offsets[0]).read().splitlines()[1])["conf"]
        assert conf[key].endswith("RocksDBStateStoreProvider")
        assert conf["spark.sql.shuffle.partitions"] == "3"
        assert S.store_metadata(spark, paths.stock_checkpoint).first().numPartitions == 3
    finally:
        spark.conf.set(key, before_provider)


def test_every_change_stream_stops_on_a_corrupt_record(spark):
    paths = P.StreamPaths(scratch_path(spark, "t-strict-changes"))
    src = f"{paths.root}/topic"
    _deliver(spark, src, [*G9, ("items", 0, 4, "k", "{not json")])
    with pytest.raises(Exception, match="corrupt item transaction"):
        P.run_to_end(P.item_changelog_query(read_topic_files(spark, src, streaming=True), paths))
    P.run_to_end(P.item_changelog_query(read_topic_files(spark, src, streaming=True), paths, policy="permissive"))
    assert P.read_changelog(spark, paths).count() == len(G9)


def test_store_stock_from_state_and_log(spark):
    paths = P.StreamPaths(scratch_path(spark, "t-store-state"))
    src = f"{paths.root}/topic"
    for m in G9:
        _deliver(spark, src, [m])
        P.run_to_end(P.store_item_stock_query(read_topic_files(spark, src, streaming=True), paths))
    for source in ("state", "log"):
        got = {tuple(r) for r in P.store_stock_snapshot(spark, paths, source).collect()}
        assert got == {("Store-1", "Item-1", 4), ("Store-2", "Item-1", 2)}


def test_stock_table_is_compacted_and_survives_a_crash_before_the_switch(spark, monkeypatch):
    from skuflow.streaming.sinks import StockTable, path_exists

    paths = P.StreamPaths(scratch_path(spark, "t-table"))
    src, where = f"{paths.root}/topic", f"{paths.root}/table"
    table = StockTable(where, P.ITEM_KEYS, compact_every=2)

    def deliver(rows, t=table):
        _deliver(spark, src, rows)
        P.run_to_end(P.stock_table_query(read_topic_files(spark, src, streaming=True), paths.stock_checkpoint, t))

    def stock():
        return {r["itemID"]: r["currentStock"] for r in table.read(spark).collect()}

    deliver(G9[:1])
    assert stock() == {"Item-1": 6} and table.state(spark) == (None, [0])
    # the new base is written, but the job dies before readers are switched to it
    monkeypatch.setattr(StockTable, "switch", lambda self, spark, batch_id: (_ for _ in ()).throw(RuntimeError("lost before the switch")))
    with pytest.raises(Exception, match="lost before the switch"):
        deliver([*G9[1:2], _msg(9, "s", "Item-2", "RESTOCK", 4)])
    monkeypatch.undo()
    assert path_exists(spark, f"{where}/base=1") and table.state(spark) == (None, [0, 1])
    assert stock() == {"Item-1": 11, "Item-2": 4}
    deliver(G9[2:3])  # batch 1 runs again and makes its base; batch 2 follows
    assert stock() == {"Item-1": 9, "Item-2": 4} and table.state(spark) == (1, [2])
    deliver(G9[3:])
    assert stock() == {"Item-1": 6, "Item-2": 4} and table.state(spark) == (3, [])
    # only the last base is left
    assert not path_exists(spark, f"{where}/base=1") and not path_exists(spark, f"{where}/batches/batch_id=2")
    table.write(spark.createDataFrame([("Item-1", -1)], "itemID string, currentStock long"), 2)
    assert stock() == {"Item-1": 6, "Item-2": 4}


def test_state_change_feed_equals_the_compacted_stream(spark):
    paths = P.StreamPaths(scratch_path(spark, "t-feed"))
    src = f"{paths.root}/topic"
    for rows in (G9[:2], [*G9[2:], _msg(9, "s", "Item-2", "RESTOCK", 4)], [_msg(10, "s", "Item-2", "SALE", 1)]):
        _deliver(spark, src, rows)
        P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), paths))
    cols = ["batch_id", "itemID", "currentStock"]
    feed = sorted(tuple(r) for r in S.stock_state_changes(spark, paths.stock_checkpoint, 0).select(*cols).collect())
    assert feed == [(0, "Item-1", 11), (1, "Item-1", 6), (1, "Item-2", 4), (2, "Item-2", 3)]
    log = P.read_snapshot_log(spark, paths.stock_log).select(F.col("batch_id").cast("long"), "itemID", "currentStock")
    assert sorted(tuple(r) for r in log.collect()) == feed
    between = S.stock_state_changes(spark, paths.stock_checkpoint, 1, 1).select(*cols).collect()
    assert sorted(tuple(r) for r in between) == feed[1:3]


def test_partition_holders_follow_the_state(spark):
    paths = P.StreamPaths(scratch_path(spark, "t-holders"))
    src = f"{paths.root}/topic"
    rows = [("items", i % 3, i, "s", json.dumps({"id": i, "sku": f"Item-{i % 40}", "quantity": 1})) for i in range(200)]
    _deliver(spark, src, rows)
    P.run_to_end(P.item_stock_query(read_topic_files(spark, src, streaming=True), paths, state_partitions=5))
    state = S.read_stock_state(spark, paths.stock_checkpoint)
    assert state.where(S.state_partition(5, "itemID") != F.col("partition_id")).count() == 0
    records = spark.createDataFrame([(f"Item-{i % 40}", i % 3) for i in range(200)], "itemID string, partition int")
    got = {r["holder"]: (r["partitions"], r["numKeys"]) for r in S.partition_holders(spark, paths.stock_checkpoint, records, "items").collect()}
    assert sum(n for _, n in got.values()) == 40 and all(p == sorted(p) and set(p) <= {"items-0", "items-1", "items-2"} for p, _ in got.values())
    with pytest.raises(Exception, match="placement differs"):
        S.partition_holders(spark, paths.stock_checkpoint, records.where("itemID != 'Item-3'"), "items").collect()
