"""The inventory application: item-topic stream in, stock changes out.

Wires the pieces the way the original service runs them, as Structured
Streaming queries:

* stock per item (update mode) → inventory topic as keyed JSON (or, with
  no broker, the per-batch snapshot log);
* the same changes as console trace lines ``{ itemID: X -> n`` (optional);
* corrupt records → quarantine table (permissive policy), or the stock
  query fails on the first one (strict policy, the original behaviour).

Checkpoints and tables live under ``<output path>/<application id>``, or under
``<spark.checkpoint.dir>/<application id>`` without an output path: the same
application id resumes, a new one replays the topic from the start.

CLI::

    python -m skuflow.streaming.app --input-path DIR [--output-path DIR] [--available-now]
    python -m skuflow.streaming.app --brokers host:9092 [--properties FILE] [--available-now]
"""

from __future__ import annotations

import argparse
import os
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from skuflow.config import checkpoint_root
from skuflow.operators.stock import item_stock
from skuflow.schema import INVENTORY_TOPIC, ITEMS_TOPIC
from skuflow.sources import kafka as kf
from skuflow.sources.codec import decode_transactions
from skuflow.sources.messages import read_topic_files
from skuflow.streaming import pipeline as P
from skuflow.streaming.changes import changes_query, file_publisher, kafka_publisher
from skuflow.streaming.sinks import console_trace_sink, kafka_inventory_sink


@dataclass
class AppConfig:
    application_id: str = kf.DEFAULT_APPLICATION_ID
    input_topic: str = ITEMS_TOPIC
    output_topic: str = INVENTORY_TOPIC
    kafka_options: dict[str, str] = field(default_factory=dict)  # empty → file stand-in
    input_path: str | None = None  # file stand-in for the input topic
    output_path: str | None = None  # root for tables when there is no broker
    policy: str = "permissive"
    console: bool = False
    store_level: bool = False  # also keep the stock per store and item
    every_change: bool = False  # publish every change, not one per item and micro-batch
    available_now: bool = False
    trigger_interval: str = "10 seconds"
    max_offsets_per_trigger: int | None = None


def _source(spark: SparkSession, cfg: AppConfig) -> DataFrame:
    if cfg.kafka_options:
        return kf.read_topic_stream(spark, cfg.input_topic, cfg.kafka_options, cfg.max_offsets_per_trigger)
    if not cfg.input_path:
        raise ValueError("either kafka_options or input_path is required")
    return read_topic_files(spark, cfg.input_path, streaming=True, max_files=cfg.max_offsets_per_trigger)


def start(spark: SparkSession, cfg: AppConfig) -> dict[str, object]:
    """Start the application's streaming queries; returns them by name."""
    root = f"{cfg.output_path or checkpoint_root(spark)}/{cfg.application_id}"
    paths = P.StreamPaths(root)
    queries: dict[str, object] = {}
    if cfg.every_change:
        send = (kafka_publisher(cfg.output_topic, cfg.kafka_options) if cfg.kafka_options
                else file_publisher(f"{root}/topics/{cfg.output_topic}"))
        queries["inventory"] = changes_query(
            _source(spark, cfg), paths.changelog_checkpoint, publish=send, policy=cfg.policy,
            available_now=cfg.available_now, interval=cfg.trigger_interval)
    elif cfg.kafka_options:
        stock = item_stock(decode_transactions(_source(spark, cfg), cfg.policy))
        w = kafka_inventory_sink(stock, cfg.output_topic, cfg.kafka_options, paths.stock_checkpoint)
        queries["inventory"] = P.start_stateful(spark, w, cfg.available_now, cfg.trigger_interval)
    else:
        queries["inventory"] = P.item_stock_query(
            _source(spark, cfg), paths, cfg.available_now, cfg.trigger_interval, policy=cfg.policy
        )
    if cfg.store_level:
        queries["store_inventory"] = P.store_item_stock_query(
            _source(spark, cfg), paths, cfg.available_now, cfg.trigger_interval, policy=cfg.policy
        )
    if cfg.console:
        stock = item_stock(decode_transactions(_source(spark, cfg), cfg.policy))
        w = console_trace_sink(stock, f"{root}/checkpoint/console")
        queries["console"] = P.start_stateful(spark, w, cfg.available_now, cfg.trigger_interval)
    if cfg.policy == "permissive":
        queries["quarantine"] = P.quarantine_query(_source(spark, cfg), paths, cfg.available_now,
                                                   cfg.trigger_interval)
    return queries


_PLACEHOLDER = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_.]*)(?::([^}]*))?\}")


def expand(value: str, env: dict[str, str] | None = None) -> str:
    """Expand ``${NAME}`` / ``${NAME:default}`` from ``env``, by default the
    environment (secrets such as SASL passwords stay out of the file); unknown
    names without a default are left as written."""
    env = os.environ if env is None else env

    def sub(m: re.Match) -> str:
        name, default = m.group(1), m.group(2)
        if name in env:
            return env[name]
        return default if default is not None else m.group(0)

    return _PLACEHOLDER.sub(sub, value)


def read_properties(
    path: str | None, env: dict[str, str] | None = None, profile: str | None = None
) -> dict[str, str]:
    """``key=value`` / ``key: value`` lines; ``#`` and ``!`` comments; placeholders expanded.

    A placeholder names an environment variable or, if there is none, another property
    (of the active profile first); one that leads back to itself is left as written.
    Profile keys ``%<profile>.<key>`` override ``<key>`` when ``profile`` is
    active; keys of other profiles are ignored.
    """
    props: dict[str, str] = {}
    if not path:
        return props
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            line = line.strip()
            if not line or line[0] in "#!":
                continue
            cut = min((i for i in (line.find("="), line.find(":")) if i > 0), default=-1)
            if cut < 0:
                continue
            props[line[:cut].strip()] = line[cut + 1 :].strip()
    plain = {k: v for k, v in props.items() if not k.startswith("%")}
    if profile:
        prefix = f"%{profile}."
        plain.update({k[len(prefix):]: v for k, v in props.items() if k.startswith(prefix)})
    env = dict(os.environ if env is None else env)
    for _ in plain:   # a chain of references is no longer than the properties
        known = {k: v for k, v in plain.items() if not _PLACEHOLDER.search(v)} | env
        done = {k: expand(v, known) if _ready(v, plain, known) else v for k, v in plain.items()}
        if done == plain:
            break
        plain = done
    return plain


def _ready(value: str, props: dict[str, str], known: dict[str, str]) -> bool:
    """Whether every name in ``value`` is known, or no property at all (its default counts then)."""
    return all(m[1] in known or m[1] not in props for m in _PLACEHOLDER.finditer(value))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="item inventory stream application")
    ap.add_argument("--brokers")
    ap.add_argument("--properties", help="client properties file (kafka.* / quarkus.kafka.* keys)")
    ap.add_argument("--profile", help="active profile for %%<profile>.<key> entries (e.g. prod)")
    ap.add_argument("--input-path")
    ap.add_argument("--output-path")
    ap.add_argument("--application-id", help="names the checkpoint; default: application.id of the properties")
    ap.add_argument("--input-topic", help="default: app.items.topic of the properties")
    ap.add_argument("--output-topic", help="default: app.item.inventory.topic of the properties")
    ap.add_argument("--trigger-interval", default=AppConfig.trigger_interval)
    ap.add_argument("--max-offsets-per-trigger", type=int, help="bounds each micro-batch (files, with --input-path)")
    ap.add_argument("--sasl-user")
    ap.add_argument("--sasl-password-env", default="KAFKA_PASSWORD", help="environment variable that holds the password")
    ap.add_argument("--sasl-mechanism", default="PLAIN")
    ap.add_argument("--ca-file", help="certificates of the brokers' authority")
    ap.add_argument("--policy", choices=["strict", "permissive"], default="permissive")
    ap.add_argument("--console", action="store_true")
    ap.add_argument("--every-change", action="store_true", help="publish every change of an item's stock, in its order")
    ap.add_argument("--store-level", action="store_true", help="also keep the stock per store and item")
    ap.add_argument("--available-now", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("skuflow-inventory").getOrCreate()
    cfg = AppConfig(input_path=a.input_path, output_path=a.output_path, policy=a.policy,
                    console=a.console, store_level=a.store_level, every_change=a.every_change, available_now=a.available_now, trigger_interval=a.trigger_interval,
                    max_offsets_per_trigger=a.max_offsets_per_trigger)
    props = read_properties(a.properties, profile=a.profile)
    client = kf.client_properties(props, a.brokers)
    if a.brokers or a.properties and not a.input_path:
        cfg.kafka_options = kf.spark_kafka_options(client) | kf.sasl_ssl_options(
            a.sasl_user or "", os.environ.get(a.sasl_password_env, ""), a.sasl_mechanism, a.ca_file or "")
    cfg.application_id = a.application_id or kf.checkpoint_name(client)
    cfg.input_topic = a.input_topic or props.get(kf.INPUT_TOPIC_PROPERTY, cfg.input_topic)
    cfg.output_topic = a.output_topic or props.get(kf.OUTPUT_TOPIC_PROPERTY, cfg.output_topic)
    qs = start(spark, cfg)
    for q in qs.values():
        q.awaitTermination()


if __name__ == "__main__":
    main()
