"""The given ``events`` table as ticks, as a table and as a stream; and tables written for the time of a query."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.streaming.runner import scratch_folder

# A declared schema: no inference pass, and the stored wall clock is read as a UTC instant in any session time zone.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def stored(rows: DataFrame) -> DataFrame:
    """Write the rows to the session's shared folder and read them back: computed once, and of a size that Spark knows."""
    path = f"{scratch_folder(rows.sparkSession)}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream; the braces make the path a glob, which may name a file or a folder of files."""
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/{{events.parquet}}")


def as_ticks(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(
        *keep,
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("ts").alias("event_time"),
    )
