"""Structured Streaming pipelines over an item-topic envelope stream.

* :func:`item_stock_query` — continuous per-item stock: the same
  ``item_stock`` function as batch, run as a streaming aggregate in
  ``update`` mode (one row per changed item per micro-batch: the compacted
  update stream). State lives in the state store under the checkpoint;
  the rows are also logged per batch id into a snapshot table.
* :func:`item_changelog_query` — every change: each micro-batch is a
  batch DataFrame; its rows get the skew-safe running sum (see
  ``operators.changelog``) plus the item's total before the batch, read
  from the previous batch's totals table. Order inside a batch = the
  source offset; across batches = arrival order.

Same checkpoint = resume (a rerun emits nothing new); a new checkpoint =
replay from the start of the source.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.config import default_parallelism
from skuflow.operators.changelog import DEFAULT_BLOCK_WIDTH, running_sum
from skuflow.operators.stock import item_stock, signed_delta, store_item_stock
from skuflow.sources.codec import decode_transactions, quarantine_transactions
from skuflow.streaming.sinks import (
    StockTable,
    batch_dir,
    compact_latest,
    delete_path,
    path_exists,
    read_snapshot_log,
    snapshot_writer,
)
from skuflow.streaming.state import read_stock_state


ITEM_KEYS = ("itemID",)
STORE_ITEM_KEYS = ("storeName", "itemID")
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_conf(spark: SparkSession, partitions: int | None, state_store: str = "rocksdb"):
    """Session settings a stateful query pins into its checkpoint on its first
    run (state partitions, state store provider). The query clones the
    session conf when it starts, so they are set only around ``start()``.

    ``state_store="rocksdb"`` keeps state off the JVM heap and spills to local
    disk, with changelog checkpointing (small uploads per batch);
    ``"session"`` keeps whatever the session is configured with.
    """
    conf: dict[str, str] = {}
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    if state_store == "rocksdb":
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
        conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@dataclass
class StreamPaths:
    root: str

    @property
    def stock_checkpoint(self) -> str:
        return f"{self.root}/checkpoint/item_stock"

    @property
    def stock_log(self) -> str:
        return f"{self.root}/tables/item_stock_log"

    @property
    def store_stock_checkpoint(self) -> str:
        return f"{self.root}/checkpoint/store_item_stock"

    @property
    def store_stock_log(self) -> str:
        return f"{self.root}/tables/store_item_stock_log"

    @property
    def changelog_checkpoint(self) -> str:
        return f"{self.root}/checkpoint/item_changelog"

    @property
    def changelog(self) -> str:
        return f"{self.root}/tables/item_changelog"

    @property
    def totals(self) -> str:
        return f"{self.root}/tables/item_totals"

    @property
    def store_changelog_checkpoint(self) -> str:
        return f"{self.root}/checkpoint/store_item_changelog"

    @property
    def store_changelog(self) -> str:
        return f"{self.root}/tables/store_item_changelog"

    @property
    def store_totals(self) -> str:
        return f"{self.root}/tables/store_item_totals"

    def changelog_paths(self, keys: tuple[str, ...]) -> tuple[str, str, str]:
        """(checkpoint, changelog table, totals table) of a changelog keyed by ``keys``."""
        if tuple(keys) == ITEM_KEYS:
            return self.changelog_checkpoint, self.changelog, self.totals
        if tuple(keys) == STORE_ITEM_KEYS:
            return self.store_changelog_checkpoint, self.store_changelog, self.store_totals
        raise ValueError(f"unsupported changelog keys {keys!r}")

    @property
    def quarantine_checkpoint(self) -> str:
        return f"{self.root}/checkpoint/quarantine"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/tables/quarantine"


def with_trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or "10 seconds")


def item_stock_query(
    envelope_stream: DataFrame,
    paths: StreamPaths,
    available_now: bool = True,
    interval: str | None = None,
    state_partitions: int | None = None,
    policy: str = "strict",
    state_store: str = "rocksdb",
):
    """Start the continuous per-item stock aggregate; returns the StreamingQuery.

    ``policy="strict"`` fails the query on the first corrupt record (the
    original behaviour); ``"permissive"`` skips it (see :func:`quarantine_query`).
    """
    spark = envelope_stream.sparkSession
    stock = item_stock(decode_transactions(envelope_stream, policy))
    writer = (
        stock.writeStream.outputMode("update")
        .option("checkpointLocation", paths.stock_checkpoint)
        .foreachBatch(snapshot_writer(paths.stock_log))
    )
    return start_stateful(spark, writer, available_now, interval, state_partitions, state_store)


def stock_table_query(envelope_stream: DataFrame, checkpoint: str, table: StockTable, available_now: bool = True,
                      interval: str | None = None, state_partitions: int | None = None, policy: str = "strict"):
    """The continuous stock per item, kept as a compacted table."""
    stock = item_stock(decode_transactions(envelope_stream, policy))
    writer = stock.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(table.write)
    return start_stateful(envelope_stream.sparkSession, writer, available_now, interval, state_partitions)


def start_stateful(spark: SparkSession, writer, available_now: bool = True, interval: str | None = None,
                   state_partitions: int | None = None, state_store: str = "rocksdb"):
    """Start a stateful query with the state settings pinned into its checkpoint."""
    with _state_conf(spark, state_partitions or default_parallelism(spark), state_store):
        return with_trigger(writer, available_now, interval).start()


def store_item_stock_query(
    envelope_stream: DataFrame,
    paths: StreamPaths,
    available_now: bool = True,
    interval: str | None = None,
    state_partitions: int | None = None,
    policy: str = "strict",
    state_store: str = "rocksdb",
):
    """Continuous stock per store and item: one event per changed (store, item)
    per micro-batch, logged per batch id like the per-item stock."""
    spark = envelope_stream.sparkSession
    stock = store_item_stock(decode_transactions(envelope_stream, policy))
    writer = (
        stock.writeStream.outputMode("update")
        .option("checkpointLocation", paths.store_stock_checkpoint)
        .foreachBatch(snapshot_writer(paths.store_stock_log))
    )
    return start_stateful(spark, writer, available_now, interval, state_partitions, state_store)


def quarantine_query(envelope_stream: DataFrame, paths: StreamPaths, available_now: bool = True,
                     interval: str | None = None):
    """Corrupt records of the stream, appended to a quarantine table."""
    writer = (
        quarantine_transactions(envelope_stream)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", paths.quarantine)
        .option("checkpointLocation", paths.quarantine_checkpoint)
    )
    return with_trigger(writer, available_now, interval).start()


def _snapshot(spark: SparkSession, checkpoint: str, log: str, keys: tuple[str, ...], source: str) -> DataFrame:
    if source == "state":
        return read_stock_state(spark, checkpoint, keys=keys).select(*keys, "currentStock")
    if source != "log":
        raise ValueError(f"unknown source {source!r}")
    return compact_latest(read_snapshot_log(spark, log), list(keys))


def stock_snapshot(spark: SparkSession, paths: StreamPaths, source: str = "state") -> DataFrame:
    """Current stock per item: ``itemID, currentStock``.

    ``source="state"`` reads the aggregate's state store as of the last
    committed batch: one row per item, whatever the history length.
    ``source="log"`` compacts the per-batch snapshot log (latest batch wins;
    the read grows with the number of batches).
    """
    return _snapshot(spark, paths.stock_checkpoint, paths.stock_log, ITEM_KEYS, source)


def seeded_stock_snapshot(spark: SparkSession, paths: StreamPaths, opening: DataFrame) -> DataFrame:
    """Stream stock on top of an opening balance: opening + streamed total per item.

    Both sides are one row per item, combined as union + one aggregate (the
    batch ``seeded_stock`` rule); the stream itself keeps plain sums.
    """
    streamed = stock_snapshot(spark, paths)
    both = opening.where(F.col("itemID").isNotNull()).select("itemID", F.col("currentStock").cast("long")).unionByName(
        streamed.select("itemID", F.col("currentStock").cast("long"))
    )
    return both.groupBy("itemID").agg(F.sum("currentStock").alias("currentStock"))


def store_stock_snapshot(spark: SparkSession, paths: StreamPaths, source: str = "state") -> DataFrame:
    """Current stock per store and item; ``source`` as for :func:`stock_snapshot`."""
    return _snapshot(spark, paths.store_stock_checkpoint, paths.store_stock_log, STORE_ITEM_KEYS, source)


def changelog_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    paths: StreamPaths,
    block_width: int | None = None,
    keys: tuple[str, ...] = ITEM_KEYS,
) -> None:
    """Process one micro-batch of decoded transactions (every-change contract).

    Rows are ordered by (topic offset, partition). Offsets repeat across topic
    partitions, so a block of ``W`` offsets can hold ``W × partitions``
    rows; with ``block_width=None`` the width is set per batch to
    ``DEFAULT_BLOCK_WIDTH // partitions`` to keep blocks at about
    ``DEFAULT_BLOCK_WIDTH`` rows (the width never changes results).
    """
    keys = tuple(keys)
    _, changelog_path, totals_path = paths.changelog_paths(keys)
    prev = batch_dir(totals_path, batch_id - 1)
    if batch_id > 0:
        if not path_exists(spark, prev):
            # Batches of a query run with consecutive ids and each writes its
            # totals, so a gap means lost state: fail rather than restart at 0.
            raise RuntimeError(f"changelog state missing: no totals for batch {batch_id - 1} at {prev}")
        prior = spark.read.parquet(prev).select(*keys, F.col("currentStock").alias("__prior"))
    else:
        prior = spark.createDataFrame([], ", ".join([f"{k} string" for k in keys] + ["__prior long"]))
    batch = batch.persist()
    try:
        if block_width is None:
            parts = batch.agg(F.countDistinct("partition")).first()[0] or 1
            block_width = max(1, DEFAULT_BLOCK_WIDTH // parts)
        d = signed_delta(batch, keep=("id", "offset", "partition", "storeName")).where(F.col("itemID").isNotNull())
        # (offset, partition): keeps each topic partition's order and breaks
        # ties between partitions the same way on every (re)run of the batch
        run = running_sum(d, keys, ["offset", "partition"], "delta", "__run", block_width)
        # prior has one row per key; AQE broadcasts it only under the size
        # threshold. Keys are compared as one struct so a null store matches.
        p = prior.select(F.struct(*keys).alias("__kk"), "__prior")
        rows = run.withColumn("__kk", F.struct(*keys)).join(p, "__kk", "left").select(
            "id", *keys, (F.coalesce(F.col("__prior"), F.lit(0)) + F.col("__run")).alias("currentStock")
        )
        rows.write.mode("overwrite").parquet(batch_dir(changelog_path, batch_id))
        moves = d.groupBy(*keys).agg(F.sum("delta").alias("__prior"))
        totals = prior.unionByName(moves).groupBy(*keys).agg(F.sum("__prior").cast("long").alias("currentStock"))
        totals.write.mode("overwrite").parquet(batch_dir(totals_path, batch_id))
    finally:
        batch.unpersist()
    if batch_id > 1:
        # Only the previous version is needed to (re)run the next batch.
        delete_path(spark, batch_dir(totals_path, batch_id - 2))


def item_changelog_query(
    envelope_stream: DataFrame,
    paths: StreamPaths,
    available_now: bool = True,
    interval: str | None = None,
    block_width: int | None = None,
    keys: tuple[str, ...] = ITEM_KEYS,
    policy: str = "strict",
):
    """Start the every-change changelog stream (per item, or per store and
    item with ``keys=STORE_ITEM_KEYS``); returns the StreamingQuery. ``policy``
    as for :func:`item_stock_query`."""
    tx = decode_transactions(envelope_stream, policy, keep=("partition", "offset"))
    checkpoint, _, _ = paths.changelog_paths(tuple(keys))

    def process(batch: DataFrame, batch_id: int) -> None:
        changelog_batch(batch.sparkSession, batch, batch_id, paths, block_width, tuple(keys))

    writer = tx.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    return with_trigger(writer, available_now, interval).start()


def read_changelog(spark: SparkSession, paths: StreamPaths, keys: tuple[str, ...] = ITEM_KEYS) -> DataFrame:
    _, changelog_path, _ = paths.changelog_paths(tuple(keys))
    return spark.read.option("basePath", changelog_path).parquet(changelog_path).drop("batch_id")


def run_to_end(query) -> None:
    """Wait for an availableNow query to drain its source; re-raise its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
