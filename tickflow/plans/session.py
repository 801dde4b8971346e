"""Session settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

MASTER_VARIABLE = "SPARK_MASTER"


def session_settings(
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    executor_memory: str | None = None,
    max_result_size: str | None = None,
    packages: tuple[str, ...] = (),
) -> dict[str, str]:
    """Settings of all jobs; what is not given is left to Spark or the cluster.

    A streaming query keeps the number of shuffle partitions it was first started with.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.sql.streaming.stateStore.maintenanceInterval": "60s",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        settings["spark.driver.memory"] = driver_memory
    if executor_memory:
        settings["spark.executor.memory"] = executor_memory
    if max_result_size:
        settings["spark.driver.maxResultSize"] = max_result_size
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    return settings


def session(name: str, log_level: str = "WARN", **settings) -> SparkSession:
    """A session on the master that the environment names, else on the one the job was submitted to."""
    builder = SparkSession.builder.appName(name)
    if master := os.environ.get(MASTER_VARIABLE):
        builder = builder.master(master)
    for key, value in session_settings(**settings).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark
