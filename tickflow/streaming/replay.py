"""Replaying a stored table as a stream that arrives in waves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickflow.streaming.runner import run_available, scratch_folder


def replay(
    rows: DataFrame, waves: int, writer: Callable[[DataFrame], DataStreamWriter], folder: str
) -> list[StreamingQuery]:
    """Feed ``rows`` to a query wave by wave (column ``arrival`` = 0, 1, ...) and return its runs.

    The rows are written once, by wave. For each wave the query is started on the same checkpoint, works off what is new
    and stops: every wave after the first is also a restart, with the state and the watermark the last run left.
    """
    spark = rows.sparkSession
    schema = rows.drop("arrival").schema
    rows.write.partitionBy("arrival").parquet(f"{folder}/in")
    runs = []
    for wave in range(waves):
        arrived = ",".join(str(n) for n in range(wave + 1))
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in/arrival={{{arrived}}}")
        runs.append(run_available(writer(stream), f"{folder}/checkpoint", spark))
    return runs


def run_in_waves(rows: DataFrame, waves: int, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Feed ``rows`` to ``transform`` wave by wave and return all it put out."""
    folder, put_out = scratch_folder(rows.sparkSession), []

    def writer(stream: DataFrame) -> DataStreamWriter:
        put_out.append(transform(stream))
        return put_out[-1].writeStream.format("parquet").option("path", f"{folder}/out").outputMode("append")

    replay(rows, waves, writer, folder)
    return rows.sparkSession.read.schema(put_out[-1].schema).parquet(f"{folder}/out")
