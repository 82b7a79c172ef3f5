"""Command-line entry points, called in-process on the test session."""

from skuflow.config import scratch_path
from skuflow.operators.stock import store_item_stock
from skuflow.plans import run
from skuflow.sources.messages import events_messages, topic_to_files
from skuflow.sources.tables import events_transactions
from skuflow.streaming import app
from skuflow.streaming import pipeline as P

SF = "/root/testdata/sf0.001"


def test_run_lists_and_writes(spark, capsys):
    run.main(["--list"])
    listed = capsys.readouterr().out.split("\n")
    assert "item_stock" in listed and "stamp_transactions" in listed
    out = scratch_path(spark, "t-cli-run")
    run.main(["item_stock", "--sf-dir", SF, "--out", out])
    assert spark.read.parquet(out).count() == 200


def test_app_cli_on_files(spark):
    root = scratch_path(spark, "t-cli-app")
    topic_to_files(events_messages(spark, SF), f"{root}/topic")
    app.main(["--input-path", f"{root}/topic", "--output-path", f"{root}/out", "--available-now"])
    paths = P.StreamPaths(f"{root}/out/skuflow-inventory")
    assert P.stock_snapshot(spark, paths).count() == 99
    assert spark.read.parquet(paths.quarantine).count() == events_messages(spark, SF).where(
        "value not like '{\"id\"%'").count()


def test_app_kafka_wiring_reaches_the_connector(spark):
    import pytest

    from skuflow.sources import kafka as kf

    opts = kf.spark_kafka_options(kf.client_properties({"kafka.application.id": "x"}, "localhost:1"))
    cfg = app.AppConfig(kafka_options=opts, available_now=True, output_path=scratch_path(spark, "t-kafka"))
    try:
        qs = app.start(spark, cfg)
    except Exception as e:  # no connector jar here: the only failure must be the missing data source
        assert "kafka" in str(e).lower() and "data source" in str(e).lower()
    else:  # a connector is present: stop what started (no broker to talk to)
        for q in qs.values():
            q.stop()
        pytest.skip("Kafka connector present; wiring started")


def test_the_application_keeps_store_level_stock(spark):
    root = scratch_path(spark, "t-cli-store")
    topic_to_files(events_messages(spark, SF, foreign=False), f"{root}/topic")
    app.main(["--input-path", f"{root}/topic", "--output-path", f"{root}/out", "--available-now", "--store-level",
              "--policy", "strict", "--application-id", "a"])
    got = P.store_stock_snapshot(spark, P.StreamPaths(f"{root}/out/a"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, store_item_stock(events_transactions(spark, SF)).collect()), key=str)


def test_a_new_application_id_replays(spark):
    root = scratch_path(spark, "t-cli-id")
    topic_to_files(events_messages(spark, SF), f"{root}/topic")
    for name in ("one", "two"):
        app.main(["--input-path", f"{root}/topic", "--output-path", f"{root}/out", "--available-now", "--application-id", name])
        assert P.stock_snapshot(spark, P.StreamPaths(f"{root}/out/{name}")).count() == 99


def test_properties_and_flags_reach_the_application(monkeypatch, tmp_path, spark):
    f = tmp_path / "app.properties"
    f.write_text("app.items.topic=in-${env}\napp.item.inventory.topic=out\nenv=test\nkafka.application.id=app-1\n"
                 "kafka.bootstrap.servers=${host}:9092\nhost=${NO_SUCH_NAME:broker}\n")
    seen = []
    monkeypatch.setattr(app, "start", lambda spark, cfg: seen.append(cfg) or {})
    monkeypatch.setenv("PW_FOR_TEST", 'a"b')
    app.main(["--properties", str(f), "--trigger-interval", "5 seconds", "--max-offsets-per-trigger", "9", "--sasl-user", "u",
              "--sasl-password-env", "PW_FOR_TEST", "--ca-file", "/etc/ca.pem"])
    cfg = seen[0]
    assert (cfg.input_topic, cfg.output_topic, cfg.application_id) == ("in-test", "out", "app-1")
    assert (cfg.trigger_interval, cfg.max_offsets_per_trigger) == ("5 seconds", 9)
    assert cfg.kafka_options["kafka.bootstrap.servers"] == "broker:9092"
    assert 'password="a\\"b";' in cfg.kafka_options["kafka.sasl.jaas.config"]
    assert cfg.kafka_options["kafka.ssl.truststore.type"] == "PEM"


def test_references_that_lead_nowhere_stay(tmp_path):
    f = tmp_path / "app.properties"
    f.write_text("a=${b}\nb=${a}\nc=${d:x}\nd=${e:y}\n%prod.e=z\nf=${d}/${missing}\n")
    assert app.read_properties(str(f), env={}) == {"a": "${b}", "b": "${a}", "c": "y", "d": "y", "f": "y/${missing}"}
    assert app.read_properties(str(f), env={}, profile="prod")["c"] == "z"
