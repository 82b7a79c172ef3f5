"""Sinks: per-batch snapshot log (idempotent foreachBatch), Kafka, console."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.functions.columns import trace_line
from skuflow.sources.codec import encode_inventory


def batch_dir(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={int(batch_id)}"


def snapshot_writer(path: str):
    """foreachBatch function: write the batch's rows under ``batch_id=N``.

    Overwriting the batch's own folder makes a re-run of the same batch
    (after a failure) replace, never duplicate, its rows.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(batch_dir(path, batch_id))

    return write


def read_snapshot_log(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a snapshot log; ``batch_id`` comes from the folder names."""
    return spark.read.option("basePath", path).parquet(path)


def compact_latest(log: DataFrame, keys: list[str], value: str = "currentStock") -> DataFrame:
    """Latest value per key = value of the highest batch id (partial aggregate)."""
    return log.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))


class StockTable:
    """A keyed table kept up to date by a stream: batch folders over a compacted base.

    Each micro-batch writes the new values of its changed keys to a folder of its own.
    Every ``compact_every`` batches the base and the folders above it become a new base
    (the latest value per key), and a marker file named after its batch switches readers
    to it: one atomic create, so a reader sees the old base or the new one, never half.
    What the marker covers is deleted after the switch. Reads and disk grow with the keys
    and at most ``compact_every`` batches, not with the history. A run that dies before
    the switch leaves a base without marker, which nobody reads and the next one replaces.
    """

    def __init__(self, path: str, keys: Sequence[str], value: str = "currentStock", compact_every: int = 10):
        self.path, self.keys, self.value, self.every = path.rstrip("/"), list(keys), value, compact_every

    def _fs(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, spark: SparkSession, folder: str, prefix: str) -> list[int]:
        p, fs = self._fs(spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())

    def state(self, spark: SparkSession) -> tuple[int | None, list[int]]:
        """(batch of the base in force, batches above it)."""
        marks = self._numbers(spark, f"{self.path}/switch", "base=")
        base = marks[-1] if marks else None
        return base, [b for b in self._numbers(spark, f"{self.path}/batches", "batch_id=") if base is None or b > base]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch function; a re-run batch replaces its folder."""
        spark = batch.sparkSession
        base, _ = self.state(spark)
        if base is not None and batch_id <= base:
            return  # already in the base: the batch committed nowhere but here before a restart
        batch.select(*self.keys, self.value).write.mode("overwrite").parquet(batch_dir(f"{self.path}/batches", batch_id))
        if len(self.state(spark)[1]) >= self.every:
            self.compact(spark)

    def compact(self, spark: SparkSession) -> None:
        old, batches = self.state(spark)
        if not batches:
            return
        new = f"{self.path}/base={batches[-1]}"
        self._rows(spark, old, batches).write.mode("overwrite").parquet(new)
        self.switch(spark, batches[-1])
        for b in batches:
            delete_path(spark, batch_dir(f"{self.path}/batches", b))
        if old is not None:
            delete_path(spark, f"{self.path}/base={old}")
            delete_path(spark, f"{self.path}/switch/base={old}")

    def switch(self, spark: SparkSession, batch_id: int) -> None:
        p, fs = self._fs(spark, f"{self.path}/switch/base={batch_id}")
        fs.create(p, False).close()

    def _rows(self, spark: SparkSession, base: int | None, batches: list[int]) -> DataFrame:
        parts = [spark.read.parquet(batch_dir(f"{self.path}/batches", b)).withColumn("batch_id", F.lit(b).cast("long")) for b in batches]
        if base is not None:
            parts.append(spark.read.parquet(f"{self.path}/base={base}").withColumn("batch_id", F.lit(base).cast("long")))
        if not parts:
            raise ValueError(f"no batch has been written to {self.path}")
        return compact_latest(reduce(DataFrame.unionByName, parts), self.keys, self.value)

    def read(self, spark: SparkSession) -> DataFrame:
        """The latest value per key."""
        return self._rows(spark, *self.state(spark))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system the path names (Hadoop API)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def kafka_inventory_sink(stock_updates: DataFrame, topic: str, options: Mapping[str, str], checkpoint: str):
    """Publish every changed stock (update mode) as keyed JSON to a topic."""
    return (
        encode_inventory(stock_updates)
        .writeStream.format("kafka")
        .outputMode("update")
        .options(**dict(options))
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def console_trace_sink(stock_updates: DataFrame, checkpoint: str):
    """Print ``{ itemID: X -> n`` lines for each changed item."""
    return (
        stock_updates.select(trace_line("itemID", "currentStock").alias("line"))
        .writeStream.format("console")
        .outputMode("update")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )
