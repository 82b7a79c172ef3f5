"""Client-property → Spark Kafka option mapping (S7, S8)."""

from skuflow.sources.kafka import (
    DEFAULT_BROKERS,
    checkpoint_name,
    client_properties,
    sasl_ssl_options,
    spark_kafka_options,
)


def test_prefixes_stripped_framework_wins_and_forced_values():
    props = {
        "kafka.application.id": "item-aggregator",
        "kafka.auto.offset.reset": "latest",
        "kafka.security.protocol": "SSL",
        "quarkus.kafka.security.protocol": "SASL_SSL",
        "kafka.ssl.truststore.type": "PKCS12",
        "hostname": "localhost",
    }
    c = client_properties(props, brokers="b1:9092")
    assert c["bootstrap.servers"] == "b1:9092"
    assert c["auto.offset.reset"] == "earliest"
    assert c["security.protocol"] == "SASL_SSL"
    assert "hostname" not in c
    opts = spark_kafka_options(c)
    assert opts["kafka.bootstrap.servers"] == "b1:9092"
    assert opts["startingOffsets"] == "earliest"
    assert opts["kafka.ssl.truststore.type"] == "PKCS12"
    assert "kafka.application.id" not in opts and "kafka.auto.offset.reset" not in opts
    assert checkpoint_name(c) == "item-aggregator"


def test_default_brokers():
    assert client_properties({})["bootstrap.servers"] == DEFAULT_BROKERS


def test_sasl_options():
    o = sasl_ssl_options("u", "p", "SCRAM-SHA-512", "/certs/ca.pem")
    assert o["kafka.security.protocol"] == "SASL_SSL"
    assert o["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert 'username="u"' in o["kafka.sasl.jaas.config"] and "ScramLoginModule" in o["kafka.sasl.jaas.config"]
    assert o["kafka.ssl.truststore.location"] == "/certs/ca.pem"
    assert sasl_ssl_options() == {}


def test_envelope_projection(spark):
    import datetime

    from skuflow.sources.kafka import envelope

    raw = spark.createDataFrame(
        [(bytearray(b"Store-1"), bytearray(b'{"sku":"A"}'), "items", 2, 7, datetime.datetime(2024, 1, 1))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    r = envelope(raw, with_timestamp=True).first()
    assert (r.topic, r.partition, r.offset, r.key, r.value) == ("items", 2, 7, "Store-1", '{"sku":"A"}')
    assert r.ts_ms is not None
    assert envelope(raw).columns == ["topic", "partition", "offset", "key", "value"]


def test_properties_file_with_placeholders(tmp_path):
    from skuflow.sources.kafka import client_properties
    from skuflow.streaming.app import expand, read_properties

    f = tmp_path / "app.properties"
    f.write_text(
        "# comment\n"
        "kafka.application.id=item-aggregator\n"
        "kafka.ssl.truststore.password=${KAFKA_CERT_PWD}\n"
        "kafka.client.id: ${POD_IP:localhost}\n"
        "! another comment\n"
        "kafka.sasl.jaas.config=${MISSING}\n"
    )
    props = read_properties(str(f), env={"KAFKA_CERT_PWD": "s3cret"})
    assert props["kafka.ssl.truststore.password"] == "s3cret"
    assert props["kafka.client.id"] == "localhost"
    assert props["kafka.sasl.jaas.config"] == "${MISSING}"
    assert client_properties(props)["ssl.truststore.password"] == "s3cret"
    assert expand("${A}-${B:x}", {"A": "1"}) == "1-x"


def test_properties_profiles(tmp_path):
    from skuflow.streaming.app import read_properties

    f = tmp_path / "app.properties"
    f.write_text(
        "kafka.security.protocol=PLAINTEXT\n"
        "%prod.kafka.security.protocol=SSL\n"
        "%prod.kafka.ssl.truststore.type=PKCS12\n"
        "%dev.kafka.bootstrap.servers=localhost:9092\n"
    )
    assert read_properties(str(f), env={}) == {"kafka.security.protocol": "PLAINTEXT"}
    prod = read_properties(str(f), env={}, profile="prod")
    assert prod == {"kafka.security.protocol": "SSL", "kafka.ssl.truststore.type": "PKCS12"}
    assert read_properties(str(f), env={}, profile="dev")["kafka.bootstrap.servers"] == "localhost:9092"
