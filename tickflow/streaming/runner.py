"""Starting, finishing and restarting streaming queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for checkpoints and results below the shared ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder; on a cluster it is an error, since executors could
    not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tickflow-")
    return f"{base.rstrip('/')}/tickflow-{uuid.uuid4().hex}"


@contextmanager
def state_store(spark: SparkSession, provider: str | None = None):
    """Queries started inside keep their state with this provider.

    Without one, a provider the session names is kept; else a cluster session gets RocksDB, whose state lies on local
    disk and not on the executors' heap, and a local one Spark's default, which starts faster.
    """
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    if provider is None and before is None and not spark.sparkContext.master.startswith("local"):
        provider = ROCKSDB
    if provider is None:
        yield
        return
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def run_available(writer: DataStreamWriter, checkpoint: str, spark: SparkSession) -> StreamingQuery:
    """Process what the sources hold now, to the end. Run again with the same checkpoint, it goes on from there."""
    with state_store(spark):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_forever(spark: SparkSession, writers: dict[str, DataStreamWriter], checkpoint_root: str) -> None:
    """Start all queries, each with its own checkpoint, and wait until one of them ends.

    Then, or if one can't be started, the others are stopped; the error of the one that failed is raised.
    """
    started: list[StreamingQuery] = []
    spark.streams.resetTerminated()
    try:
        with state_store(spark):
            for name, writer in writers.items():
                started.append(writer.queryName(name).option("checkpointLocation", f"{checkpoint_root}/{name}").start())
        spark.streams.awaitAnyTermination()
    finally:
        for query in started:
            query.stop()


def stored_result(stream: DataFrame) -> DataFrame:
    """Run a streaming DataFrame to the end into a new folder and read it back as a table."""
    spark = stream.sparkSession
    folder = scratch_folder(spark)
    sink = stream.writeStream.format("parquet").option("path", f"{folder}/rows").outputMode("append")
    run_available(sink, f"{folder}/checkpoint", spark)
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def fan_out(
    stream: DataFrame, sinks: list[Callable[[DataFrame, int], None]]
) -> DataStreamWriter:
    """Write one result to several sinks: each batch is computed once, kept, and handed to all of them."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write_batch).outputMode("append")
