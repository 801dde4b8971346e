import pytest

from tickflow.functions.records import TICK, decode, encode
from tickflow.operators import moving
from tickflow.plans.params import REFERENCE
from tickflow.plans.session import session_settings
from tickflow.sources.documents import DocumentStore, FileStore, window_collection
from tickflow.sources.topics import BROKERS_VARIABLE, FileTopics, KafkaTopics


def test_kafka_options(monkeypatch):
    monkeypatch.delenv(BROKERS_VARIABLE, raising=False)
    assert KafkaTopics.from_environment().brokers == "localhost:9092"
    monkeypatch.setenv(BROKERS_VARIABLE, "broker:9092")
    topics = KafkaTopics.from_environment()
    assert topics.source_options("t", limit=1000, tolerate_loss=True) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
        "failOnDataLoss": "false",
    }
    assert "startingOffsets" not in topics.source_options("t", starting=None)
    assert topics.sink_options("t") == {"kafka.bootstrap.servers": "broker:9092", "topic": "t"}


def test_document_store_options():
    store = DocumentStore("mongodb://host")
    assert store.options("btc-price-zscore") == {
        "spark.mongodb.write.connection.uri": "mongodb://host",
        "spark.mongodb.write.database": "crypto",
        "spark.mongodb.write.collection": "btc-price-zscore",
    }
    assert window_collection("moving", "30s") == "btc-price-moving-30s"


def test_file_topic_replay_and_repeated_batch(spark, make_ticks, tmp_path):
    topics = FileTopics(str(tmp_path))
    messages = encode(make_ticks((0, 1.0), (1, 2.0)), TICK)
    topics.write(messages, "t", batch_id=0)
    topics.write(messages, "t", batch_id=0)
    topics.write(messages, "t", batch_id=1)
    assert decode(topics.replay(spark, "t"), TICK).count() == 4
    topics.write(messages, "once")
    topics.write(messages, "once")
    assert topics.replay(spark, "once").count() == 4


def test_windows_are_stored_apart(spark, make_ticks, tmp_path):
    store = FileStore(str(tmp_path))
    params = REFERENCE.only("30s", "1m")
    rows = moving.by_window(moving.as_array(moving.moving_stats(make_ticks((1, 1.0)), params), params), "windows")
    store.write_windows(rows, "moving", params.labels)
    one = store.read_window(spark, "moving", "1m")
    assert one.count() == 3 and {r["window"] for r in one.collect()} == {"1m"}
    assert "PartitionFilters: [isnotnull(window" in one._jdf.queryExecution().executedPlan().toString()


def test_a_repeated_batch_replaces_its_windows(spark, tmp_path):
    store = FileStore(str(tmp_path))
    rows = spark.createDataFrame([("S", "1m", 1.0), ("S", "5m", 2.0)], "symbol string, window string, price double")
    for batch_id in (0, 1, 1, 0):
        store.write_windows(rows, "moving", ["1m", "5m"], batch_id)
    assert [tuple(r) for r in store.read_window(spark, "moving", "1m").collect()] == [("S", 1.0, "1m")] * 2


def test_session_settings():
    settings = session_settings(shuffle_partitions=4)
    assert settings["spark.sql.shuffle.partitions"] == "4"
    assert settings["spark.sql.adaptive.enabled"] == "true"
    assert settings["spark.sql.adaptive.coalescePartitions.enabled"] == "true"
    assert settings["spark.serializer"].endswith("KryoSerializer")
    assert settings["spark.sql.streaming.stateStore.maintenanceInterval"] == "60s"
    assert "spark.sql.shuffle.partitions" not in session_settings()


def test_unknown_job_is_refused(spark, tmp_path):
    from tickflow.plans.jobs import JobConfig, job_writers

    with pytest.raises(KeyError):
        job_writers(spark, "nonsense", JobConfig(FileTopics(str(tmp_path)), FileStore(str(tmp_path)), str(tmp_path)))
