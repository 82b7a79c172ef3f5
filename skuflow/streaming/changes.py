"""Every stock change as a stream: totals in the state store, rows shuffled once.

Each record gives one change: its key's new total. Per micro-batch:

1. tasks sum their own records per key and block of offsets (no shuffle);
2. ``transformWithState`` keeps one long per key: it turns the blocks' sums into the
   total before each block, and its state grows and is rewritten by changed keys only.
   An opening balance is the operator's initial state, taken in once per checkpoint;
3. records and block starts meet in one shuffle by (key, block), where a window sums
   the records behind their block's start. A hot key spreads over its blocks.

Order inside a micro-batch is (offset, partition); across micro-batches, arrival.
A change is published as a keyed record in that order per key, with headers that name
the micro-batch and the source record, so what a failed batch sent already is
recognised (:func:`published_changes`).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skuflow.config import default_parallelism
from skuflow.operators.changelog import NULL_ORDER_BLOCK, floor_div
from skuflow.operators.stock import signed_delta
from skuflow.sources.codec import decode_transactions
from skuflow.streaming.pipeline import ITEM_KEYS, start_stateful
from skuflow.streaming.sinks import batch_dir

# offsets of a topic partition in one block, about: a key's rows in a block go to one task
BLOCK_OFFSETS = 1 << 18
BATCH_HEADER, SOURCE_HEADER = "batch", "source"
# rows a partition of the file stand-in may hold per micro-batch (the low bits of Spark's row ids)
_ROWS_PER_BATCH = 1 << 33
PUBLISHED = ("partition int, offset long, key string, value string, "
             "headers array<struct<key: string, value: binary>>")


class RunningTotals(StatefulProcessor):
    """One long per key: in, the sums of its blocks; out, its total before each block."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total long")

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        if initialState["opening"] is not None:
            self.total.update((initialState["opening"],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        found = self.total.get()
        total = found[0] if found else 0
        sums: dict[int, int] = {}
        for r in rows:
            sums[r["__block"]] = sums.get(r["__block"], 0) + r["delta"]
        for block in sorted(sums):
            yield Row(**dict(zip(self.keys, key, strict=True)), __block=block, __base=total)
            total += sums[block]
        self.total.update((total,))

    def close(self) -> None:
        pass


def _block_sums(keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                t = pa.Table.from_batches([b])
                # as decimals, so that a sum beyond a long fails instead of wrapping
                t = t.set_column(t.schema.get_field_index("delta"), "delta", t.column("delta").cast(pa.decimal128(19)))
                t = t.group_by([*keys, "__block"]).aggregate([("delta", "sum")])
                yield from t.select([*keys, "__block", "delta_sum"]).rename_columns([*keys, "__block", "delta"]).cast(
                    pa.schema([*(b.schema.field(k) for k in keys), pa.field("__block", pa.int64()), pa.field("delta", pa.int64())])
                ).to_batches()

    return summed


def block_starts(rows: DataFrame, keys: Sequence[str] = ITEM_KEYS, opening: DataFrame | None = None) -> DataFrame:
    """``<keys>, __block, __base``: per key and block of the batch its total before that block.

    ``rows`` is a stream of ``<keys>, __block, delta``. ``opening`` (``<keys>, currentStock``,
    one row a key) is where the totals begin on a new checkpoint.
    """
    keys = list(keys)
    ddl = ", ".join(f"{k} string" for k in keys)
    sums = rows.select(*keys, "__block", "delta").mapInArrow(_block_sums(keys), f"{ddl}, __block long, delta long")
    initial = None
    if opening is not None:
        initial = opening.select(*keys, F.col("currentStock").cast("long").alias("opening")).groupBy(*keys)
    return sums.groupBy(*keys).transformWithState(
        RunningTotals(keys), f"{ddl}, __block long, __base long", "append", "none", initial)


def batch_changes(batch: DataFrame, keys: Sequence[str] = ITEM_KEYS) -> DataFrame:
    """The changes of a micro-batch: ``id, <keys>, currentStock, partition, offset``."""
    upto = Window.partitionBy(*keys, "__block").orderBy(F.col("__base").isNull(), "offset", "partition").rowsBetween(
        Window.unboundedPreceding, 0)
    running = F.sum(F.coalesce("__base", "delta")).over(upto)
    return batch.withColumn("currentStock", running).where(F.col("__base").isNull()).select(
        "id", *keys, "currentStock", "partition", "offset")


def with_starts(envelope_stream: DataFrame, keys: Sequence[str] = ITEM_KEYS, policy: str = "strict",
                block_offsets: int = BLOCK_OFFSETS, opening: DataFrame | None = None) -> DataFrame:
    """Records of a topic stream and, in the same micro-batch, the starts of their blocks."""
    tx = decode_transactions(envelope_stream, policy, keep=("partition", "offset"))
    block = F.coalesce(floor_div("offset", block_offsets), F.lit(NULL_ORDER_BLOCK).cast("long"))
    rows = signed_delta(tx, keep=("id", "offset", "partition", "storeName")).where(F.col("itemID").isNotNull()).select(
        "id", *keys, "partition", "offset", "delta", block.alias("__block"))
    return rows.unionByName(block_starts(rows, keys, opening), allowMissingColumns=True)


# --- publishing ------------------------------------------------------------------


def encode_changes(changes: DataFrame, batch_id: int) -> DataFrame:
    """``key, value, headers`` of every change, keyed by item; the headers name the micro-batch
    and the source record (``partition:offset``)."""
    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))

    source = F.concat_ws(":", F.col("partition"), F.col("offset"))
    message = F.to_json(F.struct("itemID", "currentStock"), {"ignoreNullFields": "false"})
    return changes.select(F.col("itemID").alias("key"), message.alias("value"),
                          F.array(header(BATCH_HEADER, F.lit(batch_id)), header(SOURCE_HEADER, source)).alias("headers"))


def in_key_order(changes: DataFrame, partitions: int) -> DataFrame:
    """A key's changes behind one another in one task: the order a topic keeps per key."""
    return changes.repartition(partitions, "itemID").sortWithinPartitions("offset", "partition")


def kafka_publisher(topic: str, options: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """Publish to a topic; a re-run batch sends the same headers again."""
    def publish(records: DataFrame, batch_id: int) -> None:
        records.write.format("kafka").options(**dict(options)).option("topic", topic).option("includeHeaders", "true").save()

    return publish


def file_publisher(path: str) -> Callable[[DataFrame, int], None]:
    """Publish to the file stand-in of a topic: a folder per micro-batch, overwritten when it runs
    again; offsets rise per partition along the batches, as a broker gives them."""
    def publish(records: DataFrame, batch_id: int) -> None:
        place = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROWS_PER_BATCH - 1)) + F.lit(batch_id * _ROWS_PER_BATCH)
        records.select(F.spark_partition_id().alias("partition"), place.alias("offset"), "key", "value", "headers").write.mode(
            "overwrite").parquet(batch_dir(path, batch_id))

    return publish


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PUBLISHED).option("basePath", path).parquet(path).drop("batch_id")


def published_changes(records: DataFrame) -> DataFrame:
    """Published records, each source record once: ``partition, offset, key, value, source_partition, source_offset``.

    Of a change sent again by a re-run batch the first record counts, which keeps a key's order.
    """
    named = F.map_from_entries("headers")
    source = F.split(named[SOURCE_HEADER].cast("string"), ":")
    read = records.select("partition", "offset", "key", "value", source[0].cast("int").alias("source_partition"),
                          source[1].cast("long").alias("source_offset"))
    first = F.min(F.struct("partition", "offset", "value")).alias("_r")
    return read.groupBy("key", "source_partition", "source_offset").agg(first).select(
        "_r.partition", "_r.offset", "key", "_r.value", "source_partition", "source_offset")


def changes_query(envelope_stream: DataFrame, checkpoint: str, table: str | None = None,
                  publish: Callable[[DataFrame, int], None] | None = None, keys: Sequence[str] = ITEM_KEYS,
                  policy: str = "strict", opening: DataFrame | None = None, available_now: bool = True,
                  interval: str | None = None, block_offsets: int = BLOCK_OFFSETS, state_partitions: int | None = None,
                  topic_partitions: int = 8):
    """Start the every-change stream into a changelog ``table``, a topic (``publish``), or both.

    A micro-batch computes its changes once: a table gets a folder per batch, overwritten by
    a re-run, and the topic then reads that folder. ``topic_partitions`` is the number of tasks
    that publish; keep it over the life of a file stand-in, as keys are dealt by it.
    """
    if table is None and publish is None:
        raise ValueError("changes need a table or a topic")
    if publish is not None and tuple(keys) != ITEM_KEYS:
        raise ValueError("a published change is keyed by its item")
    spark = envelope_stream.sparkSession
    keys = list(keys)

    def process(batch: DataFrame, batch_id: int) -> None:
        changes = batch_changes(batch, keys)
        if table is not None:
            changes.write.mode("overwrite").parquet(batch_dir(table, batch_id))
            changes = batch.sparkSession.read.schema(changes.schema).parquet(batch_dir(table, batch_id))
        if publish is not None:
            publish(encode_changes(in_key_order(changes, topic_partitions), batch_id), batch_id)

    writer = (with_starts(envelope_stream, keys, policy, block_offsets, opening)
              .writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(process))
    return start_stateful(spark, writer, available_now, interval, state_partitions or default_parallelism(spark))


def read_changes(spark: SparkSession, table: str, keys: Sequence[str] = ITEM_KEYS) -> DataFrame:
    """``id, <keys>, currentStock`` of every change in a changelog table."""
    return spark.read.option("basePath", table).parquet(table).select("id", *keys, "currentStock")


# --- moving to another number of state partitions ----------------------------------


def state_totals(spark: SparkSession, checkpoint: str, keys: Sequence[str] = ITEM_KEYS, batch_id: int | None = None) -> DataFrame:
    """``<keys>, currentStock`` as the state of a (stopped) every-change query holds them."""
    reader = spark.read.format("statestore").option("stateVarName", "total")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    return reader.load(checkpoint).select(*[F.col(f"key.{k}").alias(k) for k in keys], F.col("value.total").alias("currentStock"))


def move_state(spark: SparkSession, checkpoint: str, table: str, path: str, keys: Sequence[str] = ITEM_KEYS) -> tuple[DataFrame, DataFrame]:
    """What a query on a new checkpoint, with another number of state partitions, goes on from.

    ``opening`` (``<keys>, currentStock``) is the state after the last committed micro-batch of a stopped
    query, ``positions`` (``partition, offset``) the last offset per topic partition that it counts: by
    the changelog ``table``, without a folder that a failed batch left. Both are written under ``path``,
    so the old checkpoint is needed once; while it stands, a move that was cut off can be run again.
    The table before the move keeps its changes: :func:`committed_changes`.
    """
    last = spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]
    state_totals(spark, checkpoint, keys, last).write.mode("overwrite").parquet(f"{path}/opening")
    (committed_changes(spark, checkpoint, table).where(F.col("partition").isNotNull())
     .groupBy("partition").agg(F.max("offset").alias("offset")).write.mode("overwrite").parquet(f"{path}/positions"))
    return moved_state(spark, path, keys)


def moved_state(spark: SparkSession, path: str, keys: Sequence[str] = ITEM_KEYS) -> tuple[DataFrame, DataFrame]:
    """``opening`` and ``positions`` as :func:`move_state` left them (a restart passes the same ones)."""
    ddl = ", ".join(f"{k} string" for k in keys)
    return (spark.read.schema(f"{ddl}, currentStock long").parquet(f"{path}/opening"),
            spark.read.schema("partition int, offset long").parquet(f"{path}/positions"))


def committed_changes(spark: SparkSession, checkpoint: str, table: str) -> DataFrame:
    """Rows of a changelog table up to the last micro-batch that its query committed."""
    last = spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]
    return spark.read.option("basePath", table).parquet(table).where(F.col("batch_id") <= last).drop("batch_id")


def after(envelope_stream: DataFrame, positions: DataFrame) -> DataFrame:
    """The records of a topic stream behind ``positions`` (one row a topic partition), and all of
    partitions that have none. For a source that can't start there itself; a record counted
    already is read again but dropped before it is decoded."""
    upto = positions.select(F.col("partition").alias("_partition"), F.col("offset").alias("_upto"))
    return envelope_stream.join(upto, F.col("partition") == F.col("_partition"), "left").where(
        "_upto is null or offset > _upto").drop("_partition", "_upto")


def starting_offsets(positions: DataFrame, topic: str) -> str:
    """``positions`` as the startingOffsets option of a Kafka stream (one entry a topic partition).
    A partition that is not named, as it had no counted record, must be added by the caller at -2 (earliest)."""
    return json.dumps({topic: {str(r["partition"]): r["offset"] + 1 for r in positions.orderBy("partition").collect()}})
