"""Kafka topics as Spark sources (batch and stream) and the option mapping.

The reference configures its clients from properties: every ``kafka.*``
property, then every ``quarkus.kafka.*`` one (later wins), prefix
stripped, then forces the brokers and ``auto.offset.reset=earliest``. On
Spark, consumer properties are passed as ``kafka.``-prefixed options, the
start position is ``startingOffsets`` and the application id (the unit of
resume) becomes the streaming checkpoint location.

The Kafka connector jar is not on this machine's classpath and there is
no broker, so only the option mapping is tested here; the readers and
writers are the standard ``format("kafka")`` calls.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
APP_PREFIX = "kafka."
FRAMEWORK_PREFIX = "quarkus.kafka."
DEFAULT_BROKERS = "localhost:9012"
INPUT_TOPIC_PROPERTY, OUTPUT_TOPIC_PROPERTY = "app.items.topic", "app.item.inventory.topic"
# Client properties that Spark's Kafka source manages itself.
SPARK_MANAGED = ("auto.offset.reset", "enable.auto.commit", "key.deserializer", "value.deserializer",
                 "key.serializer", "value.serializer", "interceptor.classes", "application.id",
                 "default.key.serde", "default.value.serde")
# ---------------------------------------------------------------------------
DEFAULT_APPLICATION_ID = "skuflow-inventory"


def client_properties(props: Mapping[str, str], brokers: str | None = None) -> dict[str, str]:
    """Collect client properties like the reference: app prefix, then framework prefix."""
    out: dict[str, str] = {}
    for prefix in (APP_PREFIX, FRAMEWORK_PREFIX):
        for k, v in props.items():
            if k.startswith(prefix) and v is not None:
                out[k[len(prefix):]] = str(v)
    out["bootstrap.servers"] = brokers or out.get("bootstrap.servers") or DEFAULT_BROKERS
    out["auto.offset.reset"] = "earliest"
    return out


def spark_kafka_options(client: Mapping[str, str]) -> dict[str, str]:
    """Client properties → options of ``spark.read(Stream).format("kafka")``."""
    opts = {f"kafka.{k}": v for k, v in client.items() if k not in SPARK_MANAGED}
    reset = client.get("auto.offset.reset", "earliest")
    opts["startingOffsets"] = "earliest" if reset == "earliest" else "latest"
    return opts


def checkpoint_name(client: Mapping[str, str], default: str = DEFAULT_APPLICATION_ID) -> str:
    """The application id names the checkpoint: same id resumes, a new id replays."""
    return client.get("application.id", default)


def sasl_ssl_options(user: str = "", password: str = "", mechanism: str = "PLAIN",
                     ca_location: str = "") -> dict[str, str]:
    """SASL_SSL client options (values supplied by the caller, e.g. from its environment)."""
    opts: dict[str, str] = {}
    if user:
        opts["kafka.security.protocol"] = "SASL_SSL"
        opts["kafka.sasl.mechanism"] = mechanism
        module = (
            "org.apache.kafka.common.security.scram.ScramLoginModule"
            if mechanism.upper().startswith("SCRAM")
            else "org.apache.kafka.common.security.plain.PlainLoginModule"
        )
        user, password = (x.replace("\\", "\\\\").replace('"', '\\"') for x in (user, password))
        opts["kafka.sasl.jaas.config"] = f'{module} required username="{user}" password="{password}";'
    if ca_location:
        opts["kafka.ssl.truststore.location"] = ca_location
        if ca_location.lower().endswith((".pem", ".crt", ".cer")):   # else the client expects a key store
            opts["kafka.ssl.truststore.type"] = "PEM"
    return opts


def envelope(raw: DataFrame, with_timestamp: bool = False) -> DataFrame:
    """Kafka source rows → ``topic, partition, offset, key, value`` as text.

    ``with_timestamp`` also keeps the record timestamp as epoch milliseconds
    (``ts_ms``), for changelogs ordered by ``(ts_ms, partition, offset)``.
    """
    cols = [
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    ]
    if with_timestamp:
        cols.append(F.unix_millis(F.col("timestamp")).alias("ts_ms"))
    return raw.select(*cols)


def read_topic(spark: SparkSession, topic: str, options: Mapping[str, str],
               with_timestamp: bool = False) -> DataFrame:
    """Bounded scan of a topic, earliest to latest (batch)."""
    opts = dict(options)
    opts.setdefault("startingOffsets", "earliest")
    opts.setdefault("endingOffsets", "latest")
    raw = spark.read.format("kafka").options(**opts).option("subscribe", topic).load()
    return envelope(raw, with_timestamp)


def read_topic_stream(spark: SparkSession, topic: str, options: Mapping[str, str],
                      max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Unbounded topic stream; ``maxOffsetsPerTrigger`` bounds each micro-batch."""
    r = spark.readStream.format("kafka").options(**dict(options)).option("subscribe", topic)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return envelope(r.load())


def write_topic(df: DataFrame, topic: str, options: Mapping[str, str]) -> None:
    """Batch publish of a ``key, value`` frame."""
    df.select("key", "value").write.format("kafka").options(**dict(options)).option("topic", topic).save()
