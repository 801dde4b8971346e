"""Topics of JSON messages: on a Kafka broker, or as folders of files with the same ``value`` column.

Both classes offer the same four calls, so a job does not know which one it runs on. Messages carry no key: a key of
the symbol would send a busy symbol's messages to one topic partition.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# Topic names, the broker variable with its default, and the ingest limit.
TICKS_TOPIC = "btc-price"
MOVING_TOPIC = "btc-price-moving"
ZSCORE_TOPIC = "btc-price-zscore"
HIGHER_TOPIC = "btc-price-higher"
LOWER_TOPIC = "btc-price-lower"
ALL_TOPICS = (TICKS_TOPIC, MOVING_TOPIC, ZSCORE_TOPIC, HIGHER_TOPIC, LOWER_TOPIC)
BROKERS_VARIABLE = "KAFKA_BOOTSTRAP_SERVERS"
DEFAULT_BROKERS = "localhost:9092"
INGEST_LIMIT = 1000

# The connector must match the running Spark and Scala versions.
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"


@dataclass(frozen=True)
class KafkaTopics:
    """Topics on a broker. Needs the connector package on the session (``KAFKA_PACKAGE``)."""

    brokers: str = DEFAULT_BROKERS

    @classmethod
    def from_environment(cls) -> KafkaTopics:
        return cls(os.environ.get(BROKERS_VARIABLE, DEFAULT_BROKERS))

    def source_options(
        self,
        topic: str,
        starting: str | None = "latest",
        limit: int | None = None,
        tolerate_loss: bool = False,
    ) -> dict[str, str]:
        options = {"kafka.bootstrap.servers": self.brokers, "subscribe": topic}
        if starting:
            options["startingOffsets"] = starting
        if limit:
            options["maxOffsetsPerTrigger"] = str(limit)
        if tolerate_loss:
            options["failOnDataLoss"] = "false"
        return options

    def sink_options(self, topic: str) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.brokers, "topic": topic}

    def read_stream(
        self,
        spark: SparkSession,
        topic: str,
        starting: str | None = "latest",
        limit: int | None = None,
        tolerate_loss: bool = False,
    ) -> DataFrame:
        options = self.source_options(topic, starting, limit, tolerate_loss)
        return spark.readStream.format("kafka").options(**options).load()

    def replay(self, spark: SparkSession, topic: str) -> DataFrame:
        """Everything the topic holds, as a table."""
        return spark.read.format("kafka").options(**self.source_options(topic, "earliest")).load()

    def write(self, messages: DataFrame, topic: str, batch_id: int | None = None) -> None:
        messages.write.format("kafka").options(**self.sink_options(topic)).save()

    def write_stream(self, messages: DataFrame, topic: str) -> DataStreamWriter:
        return messages.writeStream.format("kafka").options(**self.sink_options(topic)).outputMode("append")


@dataclass(frozen=True)
class FileTopics:
    """Topics as folders below ``root``, a path all executors share."""

    root: str

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def source_options(self, limit: int | None = None, tolerate_loss: bool = False) -> dict[str, str]:
        options = {}
        if limit:
            options["maxFilesPerTrigger"] = str(limit)
        if tolerate_loss:
            options["ignoreMissingFiles"] = "true"
        return options

    def read_stream(
        self,
        spark: SparkSession,
        topic: str,
        starting: str | None = "latest",
        limit: int | None = None,
        tolerate_loss: bool = False,
    ) -> DataFrame:
        """Folders have no "latest": every file not yet in the query's checkpoint is read."""
        options = self.source_options(limit, tolerate_loss)
        return spark.readStream.schema("value string").options(**options).parquet(self._files(topic))

    def replay(self, spark: SparkSession, topic: str) -> DataFrame:
        return spark.read.schema("value string").parquet(self._files(topic))

    def write(self, messages: DataFrame, topic: str, batch_id: int | None = None) -> None:
        """Append; with a ``batch_id`` a repeated write of the same batch replaces the first."""
        if batch_id is None:
            messages.select("value").write.mode("append").parquet(f"{self.path(topic)}/batch=once")
        else:
            messages.select("value").write.mode("overwrite").parquet(f"{self.path(topic)}/batch={batch_id}")

    def write_stream(self, messages: DataFrame, topic: str) -> DataStreamWriter:
        return (
            messages.select("value")
            .writeStream.format("parquet")
            .option("path", f"{self.path(topic)}/batch=stream")
            .outputMode("append")
        )

    def _files(self, topic: str) -> str:
        return f"{self.path(topic)}/batch=*"


Topics = KafkaTopics | FileTopics
