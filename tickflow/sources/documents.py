"""Stores for results: a document store, or parquet folders in its place."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# Database, collections and the pattern of the per-window collections.
DATABASE = "crypto"
ZSCORE_COLLECTION = "btc-price-zscore"
HIGHER_COLLECTION = "btc-price-higher"
LOWER_COLLECTION = "btc-price-lower"


def window_collection(metric: str, label: str) -> str:
    """Collection of one metric ("moving" or "zscore") and window, e.g. btc-price-moving-30s."""
    return f"btc-price-{metric}-{label}"


@dataclass(frozen=True)
class DocumentStore:
    """Needs a MongoDB Spark connector for Spark 4.1 / Scala 2.13 on the session."""

    uri: str
    database: str = DATABASE

    def options(self, collection: str) -> dict[str, str]:
        return {
            "spark.mongodb.write.connection.uri": self.uri,
            "spark.mongodb.write.database": self.database,
            "spark.mongodb.write.collection": collection,
        }

    def write_stream(self, records: DataFrame, collection: str) -> DataStreamWriter:
        return records.writeStream.format("mongodb").options(**self.options(collection)).outputMode("append")

    def write(self, records: DataFrame, collection: str) -> None:
        records.write.format("mongodb").mode("append").options(**self.options(collection)).save()

    def write_windows(self, rows: DataFrame, metric: str, labels: Iterable[str], batch_id: int | None = None) -> None:
        """One collection per window; ``rows`` is read once per label, so persist it when it is dear.

        A row of a batch gets an id from its symbol, time and window, so that a repeated batch replaces its rows.
        """
        if batch_id is not None:
            key = F.to_json(F.struct("symbol", "timestamp", "window"), {"ignoreNullFields": "false"})
            rows = rows.withColumn("_id", F.sha2(key, 256))
        for label in labels:
            self.write(rows.filter(F.col("window") == label), window_collection(metric, label))


@dataclass(frozen=True)
class FileStore:
    """The same calls on folders below ``root``; windows become partition folders written in one pass."""

    root: str

    def path(self, collection: str) -> str:
        return f"{self.root}/{collection}"

    def write_stream(self, records: DataFrame, collection: str) -> DataStreamWriter:
        return records.writeStream.format("parquet").option("path", self.path(collection)).outputMode("append")

    def write(self, records: DataFrame, collection: str) -> None:
        records.write.mode("append").parquet(self.path(collection))

    def write_windows(self, rows: DataFrame, metric: str, labels: Iterable[str], batch_id: int | None = None) -> None:
        """A repeated batch replaces what it wrote before; rows of no batch are added."""
        some = rows.filter(F.col("window").isin(*labels)).withColumn("batch", F.lit(-1 if batch_id is None else batch_id))
        mode = "append" if batch_id is None else "overwrite"
        written = some.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("window", "batch")
        written.parquet(self.path(f"btc-price-{metric}"))

    def read(self, spark: SparkSession, collection: str) -> DataFrame:
        return spark.read.parquet(self.path(collection))

    def read_window(self, spark: SparkSession, metric: str, label: str) -> DataFrame:
        """One window's rows; the other windows' folders are not opened."""
        return self.read(spark, f"btc-price-{metric}").filter(F.col("window") == label).drop("batch")
