"""Rows that the watermark has released, kept in a folder until nothing can ask for them any more.

A streaming aggregate puts a row out once, when the watermark passes it. Micro-batches that need the rows before it as
well keep them here, by span of time: a batch reads only the spans it needs, and spans that no later batch can need are
deleted, so the folder does not grow with the stream. Whatever a repeated batch writes replaces what it wrote before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ReleasedRows:
    """``folder``, shared by the executors, with rows of the given columns (a schema text) by ``span``, and a mark per
    batch: the position up to which everything had been released after it."""

    spark: SparkSession
    folder: str
    columns: str

    def reached(self, batch_id: int) -> int | None:
        """The mark of a batch; none before the first one and before any release."""
        if batch_id < 0:
            return None
        return self.spark.read.schema("reached bigint").parquet(self._mark(batch_id)).first()[0]

    def keep(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch's rows (with ``span``), those of a span together in as few files as their size asks for."""
        (
            rows.withColumn("batch", F.lit(batch_id))
            .hint("rebalance", "span")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("span", "batch")
            .parquet(f"{self.folder}/rows")
        )

    def known(self, first_span: int | None) -> DataFrame:
        """The rows from a span on."""
        rows = self.spark.read.schema(f"{self.columns}, span bigint, batch bigint").parquet(f"{self.folder}/rows")
        if first_span is not None:
            rows = rows.filter(F.col("span") >= first_span)
        return rows.drop("span", "batch")

    def finish(self, batch_id: int, reached: int | None, first_span: int | None) -> None:
        """Mark a batch as done, and delete what neither its repetition nor a later batch can need: spans before
        ``first_span`` and marks older than the last batch's."""
        mark = self.spark.range(0, 1, 1, 1).select(F.lit(reached).cast("bigint").alias("reached"))
        mark.write.mode("overwrite").parquet(self._mark(batch_id))
        if first_span is not None:
            self._delete("rows", "span", first_span)
        self._delete("marks", "batch", batch_id - 1)

    def _mark(self, batch_id: int) -> str:
        return f"{self.folder}/marks/batch={batch_id}"

    def _delete(self, part: str, name: str, before: int) -> None:
        """Delete the folders <name>=<number> of lower numbers; there are only those since the last deletion."""
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{part}")
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(root):
            return
        for entry in files.listStatus(root):
            label, _, number = entry.getPath().getName().partition("=")
            if label == name and int(number) < before:
                files.delete(entry.getPath(), True)
