"""Reading streaming state back: point / bulk stock lookups and placement.

``format("statestore")`` reads the state of a stateful operator straight
from its checkpoint (all partitions, distributed), which replaces the
reference's host routing of key lookups; ``format("state-metadata")``
describes the stores (operator, name, partition count, batch range).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.operators.lookup import stock_lookup
from skuflow.schema import STOCK_STORE_NAME


def read_stock_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None,
                     keys: tuple[str, ...] = ("itemID",)) -> DataFrame:
    """Stock per key held in the aggregate's state: ``<keys>, currentStock, partition_id``."""
    r = spark.read.format("statestore")
    if batch_id is not None:
        r = r.option("batchId", str(batch_id))
    raw = r.load(checkpoint)
    return raw.select(
        *[F.col(f"key.{k}").alias(k) for k in keys],
        F.col("value").getField(raw.schema["value"].dataType.fieldNames()[0]).cast("long").alias("currentStock"),
        F.col("partition_id"),
    )


def stock_state_changes(spark: SparkSession, checkpoint: str, first: int, last: int | None = None,
                        keys: tuple[str, ...] = ("itemID",)) -> DataFrame:
    """Values that the batches ``first`` to ``last`` (the latest, if none) put into the state:
    ``batch_id, <keys>, currentStock, partition_id``, one row per changed key and batch. The
    state's own change log is read, not its snapshots (needs changelog checkpointing)."""
    r = spark.read.format("statestore").option("readChangeFeed", "true").option("changeStartBatchId", str(first))
    if last is not None:
        r = r.option("changeEndBatchId", str(last))
    raw = r.load(checkpoint)
    return raw.where(F.col("change_type") == "update").select(
        "batch_id", *[F.col(f"key.{k}").alias(k) for k in keys],
        F.col("value").getField(raw.schema["value"].dataType.fieldNames()[0]).cast("long").alias("currentStock"), "partition_id")


def state_partition(partitions: int, *keys: str) -> Column:
    """The state partition that holds a key: Spark deals state rows by the hash of their key."""
    return F.pmod(F.hash(*keys), F.lit(partitions))


def partition_holders(spark: SparkSession, checkpoint: str, records: DataFrame, topic: str) -> DataFrame:
    """``holder, partitions, numKeys``: per state partition the topic partitions whose records it
    holds (sorted names ``<topic>-<n>``) and its number of keys.

    ``records`` (``itemID, partition``) tell where records come from; who holds them follows from the
    key's hash, and the keys are counted in the state itself. Records are reduced to their distinct
    (holder, partition) pairs before the sets are built. A holder whose keys differ in number from
    those of its records is an error: the placement rule would not be the state's.
    """
    n = spark.read.format("state-metadata").load(checkpoint).where("operatorId = 0").select("numPartitions").first()[0]
    placed = records.where(F.col("itemID").isNotNull()).select(
        "itemID", state_partition(n, "itemID").alias("holder"), F.concat_ws("-", F.lit(topic), F.col("partition")).alias("_name"))
    sets = placed.select("holder", "_name").distinct().groupBy("holder").agg(F.sort_array(F.collect_set("_name")).alias("partitions"))
    expected = placed.select("itemID", "holder").distinct().groupBy("holder").agg(F.count(F.lit(1)).alias("_keys"))
    held = read_stock_state(spark, checkpoint).groupBy(F.col("partition_id").alias("holder")).agg(F.count(F.lit(1)).alias("numKeys"))
    both = held.join(sets, "holder", "full").join(expected, "holder", "left")
    right = F.when(F.col("_keys").eqNullSafe(F.col("numKeys")), True).otherwise(
        F.raise_error(F.concat(F.lit("state placement differs at partition "), F.col("holder"))).cast("boolean"))
    return both.where(right).select("holder", "partitions", "numKeys")


def stock_point_lookup(spark: SparkSession, checkpoint: str, requests: DataFrame) -> DataFrame:
    """Stock of each requested item as the state holds it: ``itemID, found, currentStock``;
    an item the state does not know has ``found = false`` and null stock."""
    return stock_lookup(read_stock_state(spark, checkpoint).select("itemID", "currentStock"), requests)


def store_metadata(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """Which state partitions hold keys, per stateful operator.

    ``storeName, operatorId, operatorName, stateStoreName, numPartitions,
    minBatchId, maxBatchId, numKeys, statePartitions`` —
    ``statePartitions`` lists in ascending order the state partitions with at
    least one key (they are no topic partitions, and no host owns one for good).
    Keys are counted per partition first, so the list is built from at most
    one row per state partition.
    """
    meta = spark.read.format("state-metadata").load(checkpoint)
    held = (
        spark.read.format("statestore").option("operatorId", str(operator_id)).load(checkpoint)
        .groupBy("partition_id").agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.sum("n").alias("numKeys"),
            F.sort_array(F.collect_list(F.col("partition_id").cast("int"))).alias("statePartitions"),
        )
        .withColumn("operatorId", F.lit(operator_id).cast(meta.schema["operatorId"].dataType))
    )
    return (
        meta.where(F.col("operatorId") == operator_id)
        .select(F.lit(STOCK_STORE_NAME).alias("storeName"), "operatorId", "operatorName", "stateStoreName",
                "numPartitions", "minBatchId", "maxBatchId")
        .join(held, "operatorId", "left")
        .select("storeName", "operatorId", "operatorName", "stateStoreName", "numPartitions",
                "minBatchId", "maxBatchId", "numKeys", "statePartitions")
    )
