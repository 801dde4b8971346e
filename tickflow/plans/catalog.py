"""Every operator as a query over the given tables: name -> function of (session, table folder).

Times leave a query as TIMESTAMP_NTZ in UTC and doubles are rounded, so that results can be compared with SQL
(``tickflow.plans.oracles``) value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickflow.functions.records import HIGHER, LOWER, MOVING, TICK, ZSCORE, decode, encode
from tickflow.functions.rounding import steady_round
from tickflow.functions.timegrid import naive_utc
from tickflow.operators import moving, shortest, ticks as tick_ops, zscore
from tickflow.plans.params import REFERENCE, SCALED
from tickflow.sources.documents import ZSCORE_COLLECTION, FileStore
from tickflow.sources.tables import as_ticks, events, events_stream
from tickflow.sources.topics import HIGHER_TOPIC, INGEST_LIMIT, LOWER_TOPIC, MOVING_TOPIC, TICKS_TOPIC
from tickflow.sources.topics import ZSCORE_TOPIC, FileTopics
from tickflow.streaming import moving as stream_moving, shortest as stream_shortest, zscore as stream_zscores
from tickflow.streaming.replay import replay, run_in_waves
from tickflow.streaming.runner import run_available, scratch_folder, stored_result

Query = Callable[[SparkSession, str], DataFrame]

SHORT_WINDOWS = ("30s", "1m")
OUTLIER_THRESHOLD = 1.5
WAVES = 3


def published(rows: DataFrame, digits: int = 6) -> DataFrame:
    columns: list[Column] = []
    for name, kind in rows.dtypes:
        if kind == "timestamp":
            columns.append(naive_utc(F.col(name)).alias(name))
        elif kind == "double":
            columns.append(steady_round(F.col(name), digits).alias(name))
        else:
            columns.append(F.col(name))
    return rows.select(*columns)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(events(spark, sf_dir))


def tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(events_stream(spark, sf_dir))


# Moving statistics


def moving_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(moving.moving_stats(ticks(spark, sf_dir), SCALED))


def moving_stats_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(moving.moving_stats(ticks(spark, sf_dir), REFERENCE))


def moving_stats_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(moving.moving_stats_join(ticks(spark, sf_dir), SCALED))


def _moving_avg_std(label: str, params=SCALED) -> Query:
    return lambda spark, sf_dir: published(moving.moving_avg_std(ticks(spark, sf_dir), params, label))


def _moving_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moving.as_array(moving.moving_stats(ticks(spark, sf_dir), SCALED), SCALED)


def moving_stats_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The array form, looked into by position."""
    element = [F.col("windows")[i] for i in range(len(SCALED.labels))]
    return published(
        _moving_records(spark, sf_dir).select(
            "timestamp",
            "symbol",
            F.array_join(F.col("windows.window"), ",").alias("labels"),
            *[e["avg_price"].alias(f"avg_{i}") for i, e in enumerate(element)],
            *[e["std_price"].alias(f"std_{i}") for i, e in enumerate(element)],
        )
    )


def moving_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(moving.by_window(_moving_records(spark, sf_dir), "windows"))


# z-scores


def _zscore_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zscore.zscore(ticks(spark, sf_dir), _moving_records(spark, sf_dir), SCALED)


def zscore_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = [F.col("zscores")[i] for i in range(len(SCALED.labels))]
    return published(
        _zscore_records(spark, sf_dir).select(
            "timestamp",
            "symbol",
            F.array_join(F.col("zscores.window"), ",").alias("labels"),
            *[e["zscore_price"].alias(f"zscore_{i}") for i, e in enumerate(element)],
        ),
        digits=4,
    )


def zscore_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(moving.by_window(_zscore_records(spark, sf_dir), "zscores"), digits=4)


def flag_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = moving.by_window(_zscore_records(spark, sf_dir), "zscores")
    return published(zscore.flag_outliers(rows, OUTLIER_THRESHOLD), digits=4)


# Shortest windows


def forward_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortest.forward_pairs(ticks(spark, sf_dir), SCALED, shown=published)


def shortest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(shortest.shortest_windows(ticks(spark, sf_dir), SCALED))


def shortest_windows_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(shortest.shortest_windows(ticks(spark, sf_dir), SCALED, with_found=True))


def shortest_higher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortest_windows(spark, sf_dir).select("timestamp", "higher_window")


def shortest_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortest_windows(spark, sf_dir).select("timestamp", "lower_window")


# Ticks


def normalize_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = events(spark, sf_dir).select(
        F.col("event_type").alias("symbol"),
        F.when(F.col("event_id") % 9 == 4, "n/a").otherwise(F.col("value").cast("string")).alias("price"),
        F.col("ts").alias("event_time"),
    )
    return published(tick_ops.normalize_ticks(quotes, REFERENCE.slot))


def _ticks_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh price is missing, as after a failed poll."""
    missing = F.when(F.col("event_id") % 11 != 3, F.col("price"))
    return _ticks_with(spark, sf_dir, price=missing).drop("event_id")


def conflate_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(tick_ops.conflate_latest(_ticks_with_gaps(spark, sf_dir), SCALED.slot))


def locf_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(tick_ops.locf_resample(_ticks_with_gaps(spark, sf_dir), SCALED.slide))


def _ticks_with(spark: SparkSession, sf_dir: str, **changed: Column) -> DataFrame:
    rows = as_ticks(events(spark, sf_dir), "event_id")
    return rows.withColumns(changed)


def valid_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ticks_with(
        spark,
        sf_dir,
        price=F.when(F.col("event_id") % 11 != 3, F.col("price")),
        event_time=F.when(F.col("event_id") % 13 != 5, F.col("event_time")),
    )
    return published(tick_ops.valid_ticks(rows))


def fill_placeholder_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ticks_with(spark, sf_dir, price=F.when(F.col("event_id") % 11 != 3, F.col("price")))
    return published(tick_ops.fill_placeholder_ticks(rows))


def drop_placeholder_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ticks_with(
        spark, sf_dir, price=F.when(F.col("event_id") % 17 == 0, 0.0).otherwise(F.col("price"))
    )
    return published(tick_ops.drop_placeholder_ticks(rows))


# Messages


def encode_ticks_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(ticks(spark, sf_dir), TICK)


def encode_moving_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _looked_into(encode(_moving_records(spark, sf_dir), MOVING), "windows", ("avg_price", "std_price"))


def encode_zscores_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _looked_into(encode(_zscore_records(spark, sf_dir), ZSCORE), "zscores", ("zscore_price",), digits=4)


def _looked_into(messages: DataFrame, elements: str, fields: tuple[str, ...], digits: int = 6) -> DataFrame:
    """JSON text by path: time and symbol as text, and of every element its label and numbers."""
    columns = [
        F.get_json_object("value", "$.timestamp").alias("timestamp"),
        F.get_json_object("value", "$.symbol").alias("symbol"),
    ]
    for i in range(len(SCALED.labels)):
        columns.append(F.get_json_object("value", f"$.{elements}[{i}].window").alias(f"window_{i}"))
        for field in fields:
            number = F.get_json_object("value", f"$.{elements}[{i}].{field}").cast("double")
            columns.append(number.alias(f"{field}_{i}"))
    return published(messages.select(*columns), digits)


def decode_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode_ticks_json(spark, sf_dir).select(F.col("value").cast("binary").alias("value"))
    return published(decode(messages, TICK))


def decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick messages of which most are damaged, each in one of five ways."""
    good = F.to_json(F.struct("symbol", "price", "event_time"))
    damage = F.col("event_id") % 7
    value = (
        F.when(damage == 0, F.expr("substring(good, 1, length(good) - 1)"))
        .when(damage == 1, F.regexp_replace("good", '"price":([^,]*)', '"price":"$1"'))
        .when(damage == 2, F.regexp_replace("good", '"event_time":"[^"]*"', '"event_time":"soon"'))
        .when(damage == 3, F.regexp_replace("good", r"\}$", ',"exchange":"x"}'))
        .when(damage == 4, F.lit(None).cast("string"))
        .otherwise(F.col("good"))
    )
    messages = as_ticks(events(spark, sf_dir), "event_id").withColumn("good", good).select("event_id", value.alias("value"))
    return published(decode(messages, TICK, keep=["event_id"]))


def decode_moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode(_moving_records(spark, sf_dir), MOVING)
    return published(moving.by_window(decode(messages, MOVING), "windows"))


def decode_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode(_zscore_records(spark, sf_dir), ZSCORE)
    return published(moving.by_window(decode(messages, ZSCORE), "zscores"), digits=4)


# Topics and stores


def replay_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = FileTopics(scratch_folder(spark))
    topics.write(encode_ticks_json(spark, sf_dir), TICKS_TOPIC)
    return published(decode(topics.replay(spark, TICKS_TOPIC), TICK))


def load_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic of z-score records to a store, as a stream; then read back from the store."""
    folder = scratch_folder(spark)
    topics, store = FileTopics(folder), FileStore(f"{folder}/store")
    topics.write(encode(_zscore_records(spark, sf_dir), ZSCORE), ZSCORE_TOPIC)
    records = decode(topics.read_stream(spark, ZSCORE_TOPIC), ZSCORE)
    run_available(store.write_stream(records, ZSCORE_COLLECTION), f"{folder}/checkpoint", spark)
    return published(moving.by_window(store.read(spark, ZSCORE_COLLECTION), "zscores"), digits=4)


def _stored_moving_windows(spark: SparkSession, sf_dir: str) -> FileStore:
    store = FileStore(scratch_folder(spark))
    store.write_windows(moving.by_window(_moving_records(spark, sf_dir), "windows"), "moving", SCALED.labels)
    return store


def readback_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_moving_windows(spark, sf_dir).read_window(spark, "moving", "1m")
    first = stored.orderBy("timestamp", "symbol").limit(5)
    return published(first.select("timestamp", "symbol", "avg_price", "std_price"))


def readback_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_moving_windows(spark, sf_dir).read_window(spark, "moving", "1m")
    return stored.agg(F.count(F.lit(1)).alias("n"))


# Streams


def stream_ticks_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = FileTopics(scratch_folder(spark))
    topics.write(encode_ticks_json(spark, sf_dir), TICKS_TOPIC)
    messages = topics.read_stream(spark, TICKS_TOPIC, limit=INGEST_LIMIT, tolerate_loss=True)
    return published(stored_result(decode(messages, TICK)))


def _arriving(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    """Ticks with the wave they arrive in (``arrival``), in the order of time; if wished, every tenth one wave late."""
    rows = events(spark, sf_dir)
    us = F.unix_micros("ts")
    first, last = rows.agg(F.min(us), F.max(us)).first()
    wave = F.call_function("div", (us - F.lit(first)) * WAVES, F.lit(last - first + 1))
    if late:
        wave = wave + F.when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    return as_ticks(rows.withColumn("arrival", wave), "arrival")


def _written_in_waves(ticks: DataFrame, writer: Callable, waves: int = WAVES) -> tuple[DataFrame, list[StreamingQuery]]:
    """What a writer (of ticks, durations, work folder, sinks) hands to its sink, wave by wave; and its runs."""
    folder = scratch_folder(ticks.sparkSession)

    def store(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    runs = replay(ticks, waves, lambda stream: writer(stream, SCALED, f"{folder}/work", [store]), folder)
    return ticks.sparkSession.read.parquet(f"{folder}/rows").drop("batch"), runs


def stream_moving_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(_written_in_waves(_arriving(spark, sf_dir), stream_moving.moving_stats_writer)[0])


def stream_window_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(
        run_in_waves(_arriving(spark, sf_dir), WAVES, lambda s: stream_moving.stream_window_ends(s, SCALED))
    )


def stream_moving_stats_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(stored_result(stream_moving.stream_moving_stats_join(tick_stream(spark, sf_dir), SCALED)))


def stream_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _written_in_waves(_arriving(spark, sf_dir), stream_zscores.zscore_writer)[0]
    return published(moving.by_window(records, "zscores"), digits=4)


def stream_zscore_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one streaming DataFrame, by a stream-stream join."""
    records = stored_result(stream_zscores.stream_zscore_of_ticks(tick_stream(spark, sf_dir), SCALED))
    return published(moving.by_window(records, "zscores"), digits=4)


def stream_zscore_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries: moving records go to a topic, from which the z-score query reads them."""
    folder = scratch_folder(spark)
    topics = FileTopics(folder)

    def to_topic(stats: DataFrame, batch_id: int) -> None:
        topics.write(encode(moving.as_array(stats, SCALED), MOVING), MOVING_TOPIC, batch_id)

    ticks = _arriving(spark, sf_dir)
    replay(
        ticks, WAVES, lambda s: stream_moving.moving_stats_writer(s, SCALED, f"{folder}/work", [to_topic]), f"{folder}/moving"
    )
    records = decode(topics.read_stream(spark, MOVING_TOPIC), MOVING)
    scores = run_in_waves(ticks, WAVES, lambda s: stream_zscores.stream_zscore_of_records(s, records, SCALED))
    return published(moving.by_window(scores, "zscores"), digits=4)


def stream_shortest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(_written_in_waves(_arriving(spark, sf_dir), stream_shortest.shortest_windows_writer)[0])


def stream_shortest_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one streaming DataFrame, by an interval self-join."""
    return published(stored_result(stream_shortest.stream_shortest_pairs(tick_stream(spark, sf_dir), SCALED)))


def stream_shortest_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One streaming result to two topics; both topics read back."""
    folder = scratch_folder(spark)
    topics = FileTopics(folder)
    sinks = stream_shortest.higher_lower_sinks(topics)
    writer = stream_shortest.shortest_windows_writer(tick_stream(spark, sf_dir), SCALED, f"{folder}/work", sinks)
    run_available(writer, f"{folder}/checkpoint", spark)
    sides = [
        decode(topics.replay(spark, topic), schema).select(
            F.lit(side).alias("side"), "timestamp", F.col(f"{side}_window").alias("seconds")
        )
        for side, topic, schema in (("higher", HIGHER_TOPIC, HIGHER), ("lower", LOWER_TOPIC, LOWER))
    ]
    return published(sides[0].unionByName(sides[1]))


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table arrives in time order in three waves, but every tenth event one wave late.

    A late event counts only for the windows the watermark has not closed before its wave.
    """
    counts = run_in_waves(
        _arriving(spark, sf_dir, late=True), WAVES + 1, lambda s: stream_moving.stream_window_counts(s, SCALED, "5m")
    )
    return published(counts)


def stream_late_moving_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving statistics of the same arrivals: a late tick counts only if its pane is still open."""
    late = _arriving(spark, sf_dir, late=True)
    return published(_written_in_waves(late, stream_moving.moving_stats_writer, WAVES + 1)[0])


def stream_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many panes and marks of symbols each wave brought too late, as the query's progress tells."""
    late = _arriving(spark, sf_dir, late=True)
    _, runs = _written_in_waves(late, stream_moving.moving_stats_writer, WAVES + 1)
    dropped = [
        (wave, sum(op["numRowsDroppedByWatermark"] for batch in run.recentProgress for op in batch["stateOperators"]))
        for wave, run in enumerate(runs)
    ]
    return spark.createDataFrame(dropped, "arrival long, dropped long")


QUERIES: dict[str, Query] = {
    "moving_stats": moving_stats,
    "moving_stats_reference": moving_stats_reference,
    "moving_stats_join": moving_stats_join,
    **{f"moving_avg_std_{label}": _moving_avg_std(label) for label in SCALED.labels},
    **{f"moving_avg_std_reference_{label}": _moving_avg_std(label, REFERENCE) for label in SHORT_WINDOWS},
    "moving_stats_array": moving_stats_array,
    "moving_by_window": moving_by_window,
    "zscore": zscore_array,
    "zscore_by_window": zscore_by_window,
    "flag_outliers": flag_outliers,
    "forward_pairs": forward_pairs,
    "shortest_windows": shortest_windows,
    "shortest_windows_found": shortest_windows_found,
    "shortest_higher": shortest_higher,
    "shortest_lower": shortest_lower,
    "normalize_ticks": normalize_ticks,
    "conflate_latest": conflate_latest,
    "locf_resample": locf_resample,
    "valid_ticks": valid_ticks,
    "fill_placeholder_ticks": fill_placeholder_ticks,
    "drop_placeholder_ticks": drop_placeholder_ticks,
    "encode_ticks_json": encode_ticks_json,
    "encode_moving_json": encode_moving_json,
    "encode_zscores_json": encode_zscores_json,
    "decode_ticks": decode_ticks,
    "decode_malformed": decode_malformed,
    "decode_moving": decode_moving,
    "decode_zscores": decode_zscores,
    "replay_ticks": replay_ticks,
    "load_zscores": load_zscores,
    "readback_limit": readback_limit,
    "readback_count": readback_count,
    "stream_ticks_passthrough": stream_ticks_passthrough,
    "stream_moving_stats": stream_moving_stats,
    "stream_window_ends": stream_window_ends,
    "stream_moving_stats_join": stream_moving_stats_join,
    "stream_zscore": stream_zscore,
    "stream_zscore_join": stream_zscore_join,
    "stream_zscore_chained": stream_zscore_chained,
    "stream_shortest_windows": stream_shortest_windows,
    "stream_shortest_pairs": stream_shortest_pairs,
    "stream_shortest_sinks": stream_shortest_sinks,
    "stream_late_data": stream_late_data,
    "stream_late_moving_stats": stream_late_moving_stats,
    "stream_late_dropped": stream_late_dropped,
}
