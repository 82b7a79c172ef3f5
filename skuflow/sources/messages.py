"""Item-topic messages derived from the ``events`` table, and a file stand-in
for the topic (the Kafka connector is not on this classpath; see kafka.py).

One message per event, keyed by store name like the reference's producer:
page views carry their raw ``props`` JSON (a foreign payload a strict
reader must reject); every other event carries its transaction as JSON
with null fields omitted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.schema import ENVELOPE, ITEMS_TOPIC
from skuflow.sources.tables import read_table, tx_events_columns

# --- fixed values of the message mapping ------------------------------------
TOPIC_PARTITIONS = 3  # partition = user_id mod 3
FOREIGN_EVENT_TYPE = "view"  # these events carry props, not a transaction
# ---------------------------------------------------------------------------


# record time in epoch milliseconds, computed without any time-zone shift
# (events.ts has no zone), truncating sub-millisecond digits like a producer clock
EPOCH_MS = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"


def item_messages(events: DataFrame, with_timestamp: bool = False, foreign: bool = True) -> DataFrame:
    """Envelope ``topic, partition, offset, key, value`` (offset = event_id),
    plus ``ts_ms`` (record time, as the Kafka envelope gives it) on request.
    Without ``foreign`` page views carry their transaction too, so a reader gets
    the whole table.

    One projection over one scan: no join, no shuffle.
    """
    tx = tx_events_columns()
    store = tx[1]
    extra = [F.expr(EPOCH_MS).alias("ts_ms")] if with_timestamp else []
    return events.select(
        F.lit(ITEMS_TOPIC).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        store.alias("key"),
        (F.when(F.col("event_type") == F.lit(FOREIGN_EVENT_TYPE), F.col("props")).otherwise(F.to_json(F.struct(*tx)))
         if foreign else F.to_json(F.struct(*tx))).alias("value"),
        *extra,
    )


def events_messages(spark: SparkSession, sf_dir: str, with_timestamp: bool = False, foreign: bool = True) -> DataFrame:
    return item_messages(read_table(spark, sf_dir, "events"), with_timestamp, foreign)


def topic_to_files(envelope: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write an envelope as parquet files — the file stand-in for a topic."""
    envelope.select(*[f.name for f in ENVELOPE.fields]).write.mode(mode).parquet(path)


def read_topic_files(
    spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """Read the file stand-in, batch or as a stream (schema given, never inferred)."""
    if not streaming:
        return spark.read.schema(ENVELOPE).parquet(path)
    reader = spark.readStream.schema(ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)
