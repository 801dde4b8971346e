"""The streaming jobs: which topic goes through which operator to which topic or store.

    ticks topic -> moving                -> moving topic
    ticks topic, moving topic -> zscore  -> z-score topic
    ticks topic -> shortest              -> higher topic, lower topic
    z-score topic -> load                -> store, whole records
    moving, z-score, higher and lower topics -> load_windows -> store, one collection per metric and window

Run one or several from the command line: python -m tickflow.plans.jobs moving zscore
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tickflow.functions.records import HIGHER, LOWER, MOVING, TICK, ZSCORE, decode, encode
from tickflow.operators.moving import as_array, by_window
from tickflow.plans.params import REFERENCE, TickParams
from tickflow.plans.session import session
from tickflow.sources.documents import (
    HIGHER_COLLECTION,
    LOWER_COLLECTION,
    ZSCORE_COLLECTION,
    DocumentStore,
    FileStore,
)
from tickflow.sources.topics import (
    HIGHER_TOPIC,
    KAFKA_PACKAGE,
    LOWER_TOPIC,
    MOVING_TOPIC,
    TICKS_TOPIC,
    ZSCORE_TOPIC,
    FileTopics,
    KafkaTopics,
    Topics,
)
from tickflow.streaming.moving import moving_stats_writer
from tickflow.streaming.runner import fan_out, run_forever
from tickflow.streaming.shortest import higher_lower_sinks, shortest_windows_writer
from tickflow.streaming.zscore import stream_zscore_of_records


@dataclass(frozen=True)
class JobConfig:
    """``work_folder``, shared by the executors and kept between starts, holds checkpoints and closed panes."""

    topics: Topics
    store: DocumentStore | FileStore
    work_folder: str
    params: TickParams = REFERENCE
    ingest_limit: int | None = None


Writers = dict[str, DataStreamWriter]


def _ticks(spark: SparkSession, config: JobConfig, limit: int | None = None, tolerate_loss: bool = False) -> DataFrame:
    messages = config.topics.read_stream(spark, TICKS_TOPIC, limit=limit, tolerate_loss=tolerate_loss)
    return decode(messages, TICK)


def moving_job(spark: SparkSession, config: JobConfig) -> Writers:
    ticks = _ticks(spark, config, config.ingest_limit, tolerate_loss=True)

    def to_topic(stats: DataFrame, batch_id: int) -> None:
        config.topics.write(encode(as_array(stats, config.params), MOVING), MOVING_TOPIC, batch_id)

    return {"moving": moving_stats_writer(ticks, config.params, f"{config.work_folder}/moving", [to_topic])}


def zscore_job(spark: SparkSession, config: JobConfig) -> Writers:
    moving = decode(config.topics.read_stream(spark, MOVING_TOPIC, starting=None), MOVING)
    records = stream_zscore_of_records(_ticks(spark, config), moving, config.params)
    return {"zscore": config.topics.write_stream(encode(records, ZSCORE), ZSCORE_TOPIC)}


def shortest_job(spark: SparkSession, config: JobConfig) -> Writers:
    sinks = higher_lower_sinks(config.topics)
    return {"shortest": shortest_windows_writer(_ticks(spark, config), config.params, f"{config.work_folder}/shortest", sinks)}


def load_job(spark: SparkSession, config: JobConfig) -> Writers:
    records = decode(config.topics.read_stream(spark, ZSCORE_TOPIC), ZSCORE)
    return {"load": config.store.write_stream(records, ZSCORE_COLLECTION)}


def load_windows_job(spark: SparkSession, config: JobConfig) -> Writers:
    writers = {}
    for metric, topic, schema, elements in (
        ("moving", MOVING_TOPIC, MOVING, "windows"),
        ("zscore", ZSCORE_TOPIC, ZSCORE, "zscores"),
    ):
        rows = by_window(decode(config.topics.read_stream(spark, topic), schema), elements)
        writers[f"load_{metric}"] = fan_out(
            rows, [lambda batch, n, metric=metric: config.store.write_windows(batch, metric, config.params.labels, n)]
        )
    for topic, schema, collection in (
        (HIGHER_TOPIC, HIGHER, HIGHER_COLLECTION),
        (LOWER_TOPIC, LOWER, LOWER_COLLECTION),
    ):
        records = decode(config.topics.read_stream(spark, topic), schema)
        writers[f"load_{collection}"] = config.store.write_stream(records, collection)
    return writers


JOBS: dict[str, Callable[[SparkSession, JobConfig], Writers]] = {
    "moving": moving_job,
    "zscore": zscore_job,
    "shortest": shortest_job,
    "load": load_job,
    "load_windows": load_windows_job,
}


def job_writers(spark: SparkSession, name: str, config: JobConfig) -> Writers:
    """The writers of a job, not yet started."""
    return JOBS[name](spark, config)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run streaming jobs until one of them ends.")
    parser.add_argument("jobs", nargs="+", choices=sorted(JOBS))
    parser.add_argument("--topic-folder", help="keep topics as files in this shared folder instead of on a broker")
    parser.add_argument("--store-uri", default="mongodb://localhost", help="document store")
    parser.add_argument("--store-folder", help="keep results as files in this shared folder instead")
    parser.add_argument("--work-folder", required=True, help="shared folder of checkpoints and panes, the same for every start")
    parser.add_argument("--ingest-limit", type=int, help="messages (files in a topic folder) per batch; all there are by default")
    parser.add_argument("--shuffle-partitions", type=int)
    chosen = parser.parse_args(arguments)

    topics = FileTopics(chosen.topic_folder) if chosen.topic_folder else KafkaTopics.from_environment()
    store = FileStore(chosen.store_folder) if chosen.store_folder else DocumentStore(chosen.store_uri)
    packages = () if chosen.topic_folder else (KAFKA_PACKAGE,)
    spark = session("tickflow", shuffle_partitions=chosen.shuffle_partitions, packages=packages)
    try:
        work_folder = chosen.work_folder
        writers: Writers = {}
        for name in chosen.jobs:
            config = JobConfig(topics, store, work_folder, ingest_limit=chosen.ingest_limit or None)
            writers |= job_writers(spark, name, config)
        run_forever(spark, writers, f"{work_folder}/checkpoints")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
