"""The every-change stream with state: published order, failed batches, opening balances."""

import pytest
from pyspark.sql import functions as F
from test_streaming import G9, _deliver, _msg

from skuflow.config import scratch_path
from skuflow.sources.codec import decode_inventory
from skuflow.sources.messages import read_topic_files
from skuflow.streaming import changes as C
from skuflow.streaming import pipeline as P


def _paths(spark, name):
    root = scratch_path(spark, name)
    return f"{root}/topic", f"{root}/checkpoint", f"{root}/inventory"


def _run(spark, src, checkpoint, **kw):
    P.run_to_end(C.changes_query(read_topic_files(spark, src, streaming=True), checkpoint, **kw))


def _published(spark, topic):
    sent = decode_inventory(C.published_changes(C.read_published(spark, topic)), "strict", keep=("partition", "offset", "source_offset"))
    return [(r["source_offset"], r["itemID"], r["currentStock"]) for r in sent.orderBy("partition", "offset").collect()]


def test_g9_is_published_in_order(spark):
    src, ck, topic = _paths(spark, "pub-g9")
    for m in G9:  # a micro-batch each
        _deliver(spark, src, [m])
        _run(spark, src, ck, publish=C.file_publisher(topic), block_offsets=1)
    assert [s for _, _, s in _published(spark, topic)] == [6, 11, 9, 6]


def test_g9_after_a_failed_batch(spark):
    src, ck, topic = _paths(spark, "pub-fail")
    send = C.file_publisher(topic)
    _deliver(spark, src, G9[:2])
    _run(spark, src, ck, publish=send)
    _deliver(spark, src, list(reversed(G9[2:])))
    raws = []

    def failing(records, batch_id):
        # the broker takes half of the batch before the producer is lost
        half = records.where(F.col("value").contains(":9}"))
        raws.append([r["headers"] for r in half.collect()])
        send(half, batch_id + 1000)
        raise RuntimeError("simulated loss after a partial publish")

    with pytest.raises(Exception, match="partial publish"):
        _run(spark, src, ck, publish=failing)
    assert [s for _, _, s in _published(spark, topic)] == [6, 11, 9]
    _run(spark, src, ck, publish=send)
    # the batch's first record is on the topic twice, with the same headers
    again = [r["headers"] for r in C.read_published(spark, topic).where(F.col("value").contains(":9}")).collect()]
    assert again == raws[0] * 2
    assert sorted(_published(spark, topic)) == [(0, "Item-1", 6), (1, "Item-1", 11), (2, "Item-1", 9), (3, "Item-1", 6)]


def test_blocks_partitions_and_restart_do_not_change_totals(spark):
    rows = [("items", p, i, "s", f'{{"id":{10 * i + p},"storeName":"s{i % 2}","sku":"{"hot" if i % 3 else "cold"}","quantity":{i % 5 - 2}}}')
            for i in range(40) for p in range(2)]
    totals, want = {}, []
    for _, p, i, _, _ in rows:
        sku = "hot" if i % 3 else "cold"
        totals[sku] = totals.get(sku, 0) + i % 5 - 2
        want.append((10 * i + p, sku, totals[sku]))
    for blocks in (1, 7, C.BLOCK_OFFSETS):
        src, ck, table = _paths(spark, "blocks")
        for part in (rows[:30], rows[30:]):
            _deliver(spark, src, part)
            _run(spark, src, ck, table=table, block_offsets=blocks)
        _run(spark, src, ck, table=table, block_offsets=blocks)  # nothing new
        assert sorted(tuple(r) for r in C.read_changes(spark, table).collect()) == sorted(want)


def test_only_changed_keys_are_written(spark):
    src, ck, table = _paths(spark, "changed")
    _deliver(spark, src, [_msg(i, "s", f"Item-{i}", "RESTOCK", 1) for i in range(50)])
    _run(spark, src, ck, table=table)
    _deliver(spark, src, [_msg(50, "s", "Item-7", "RESTOCK", 1)])
    q = C.changes_query(read_topic_files(spark, src, streaming=True), ck, table=table)
    P.run_to_end(q)
    op = q.recentProgress[-1]["stateOperators"][0]
    assert op["numRowsTotal"] == 50 and op["numRowsUpdated"] == 1


def test_opening_balance_is_the_start_and_is_taken_once(spark):
    src, ck, table = _paths(spark, "opening")
    opening = spark.createDataFrame([("Item-1", 100), ("Item-9", 5), ("Item-2", None)], "itemID string, currentStock long")
    for part in (G9[:2], [*G9[2:], _msg(4, "s", "Item-2", "SALE", 4)]):
        _deliver(spark, src, part)
        _run(spark, src, ck, table=table, opening=opening)
    got = sorted(tuple(r) for r in C.read_changes(spark, table).collect())
    assert got == [(0, "Item-1", 106), (1, "Item-1", 111), (2, "Item-1", 109), (3, "Item-1", 106), (4, "Item-2", -4)]


def test_store_keys_with_a_null_store(spark):
    src, ck, table = _paths(spark, "stores")
    first = [("items", 0, 0, None, '{"id":0,"sku":"A","quantity":5}'), _msg(1, "s1", "A", "RESTOCK", 2)]
    second = [("items", 0, 2, None, '{"id":2,"sku":"A","type":"SALE","quantity":1}'), _msg(3, "s1", "A", "SALE", 2)]
    for part in (first, second):
        _deliver(spark, src, part)
        _run(spark, src, ck, table=table, keys=P.STORE_ITEM_KEYS)
    rows = C.read_changes(spark, table, P.STORE_ITEM_KEYS).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(0, None, "A", 5), (1, "s1", "A", 2), (2, None, "A", 4), (3, "s1", "A", 0)]


def test_corrupt_record_stops_the_stream(spark):
    src, ck, table = _paths(spark, "strict")
    _deliver(spark, src, [*G9, ("items", 0, 4, "k", "{not json")])
    with pytest.raises(Exception, match="corrupt item transaction"):
        _run(spark, src, ck, table=table)
    with pytest.raises(ValueError):
        C.changes_query(read_topic_files(spark, src, streaming=True), ck)


def test_kafka_records_carry_key_order_and_headers(spark):
    rows = [(i, f"Item-{i % 3}", i * 10, i % 2, i) for i in range(30)]
    changes = spark.createDataFrame(rows, "id long, itemID string, currentStock long, partition int, offset long").repartition(7)
    sent = C.encode_changes(C.in_key_order(changes, 2), 5)
    assert sent.columns == ["key", "value", "headers"]
    parts = sent.withColumn("p", F.spark_partition_id()).collect()
    for key in {r["key"] for r in parts}:
        mine = [r for r in parts if r["key"] == key]
        assert len({r["p"] for r in mine}) == 1
        heads = [{h["key"]: bytes(h["value"]).decode() for h in r["headers"]} for r in mine]
        assert {h["batch"] for h in heads} == {"5"}
        offsets = [int(h["source"].split(":")[1]) for h in heads]
        assert offsets == sorted(offsets) and len(offsets) == 10


def test_app_publishes_every_change(spark):
    from skuflow.streaming.app import AppConfig, start

    root = scratch_path(spark, "app-changes")
    src = f"{root}/topic"
    _deliver(spark, src, G9)
    cfg = AppConfig(input_path=src, output_path=f"{root}/out", available_now=True, policy="strict", every_change=True)
    for q in start(spark, cfg).values():
        P.run_to_end(q)
    sent = _published(spark, f"{root}/out/{cfg.application_id}/topics/{cfg.output_topic}")
    assert [s for _, _, s in sent] == [6, 11, 9, 6]


def test_state_moves_to_another_number_of_partitions(spark):
    src, ck, table = _paths(spark, "move")
    msgs = [_msg(i, "s", f"Item-{i % 7}", "SALE" if i % 3 else "RESTOCK", 1 + i % 4) for i in range(60)]
    totals, want = {}, []
    for i in range(60):
        k = f"Item-{i % 7}"
        totals[k] = totals.get(k, 0) + (-1 if i % 3 else 1) * (1 + i % 4)
        want.append((i, k, totals[k]))
    _deliver(spark, src, msgs[:25])
    _run(spark, src, ck, table=table, state_partitions=3)
    _deliver(spark, src, msgs[25:40])

    def lost(records, batch_id):
        raise RuntimeError("lost after the table was written")

    with pytest.raises(Exception, match="lost after"):
        _run(spark, src, ck, table=table, publish=lost)
    # the failed batch left a folder, which counts neither as a change nor as a position
    assert C.read_changes(spark, table).count() == 40
    new_ck, new_table, place = f"{ck}-new", f"{table}-new", f"{ck}-from"
    for _ in range(2):  # a move that was cut off runs again
        opening, positions = C.move_state(spark, ck, table, place)
    assert {r["partition"]: r["offset"] for r in positions.collect()} == {0: 24}
    assert C.starting_offsets(positions, "items") == '{"items": {"0": 25}}'

    def run(**kw):
        stream = C.after(read_topic_files(spark, src, streaming=True), positions)
        P.run_to_end(C.changes_query(stream, new_ck, table=new_table, opening=opening, **kw))

    run(state_partitions=5)
    _deliver(spark, src, msgs[40:])
    run()   # a restart is given the same opening and positions
    meta = spark.read.format("state-metadata").load(new_ck).where("operatorId = 0").select("numPartitions").distinct().collect()
    assert [r[0] for r in meta] == [5]
    both = C.committed_changes(spark, ck, table).select("id", "itemID", "currentStock").unionByName(C.read_changes(spark, new_table))
    assert sorted(tuple(r) for r in both.collect()) == want
    assert {r["itemID"]: r["currentStock"] for r in C.state_totals(spark, new_ck).collect()} == totals
