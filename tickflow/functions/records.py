"""Record schemas and their JSON text form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names, order and types of the JSON records.
TICK = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)
MOVING = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField(
            "windows",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("window", T.StringType()),
                        T.StructField("avg_price", T.DoubleType()),
                        T.StructField("std_price", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)
ZSCORE = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField(
            "zscores",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("window", T.StringType()),
                        T.StructField("zscore_price", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)
HIGHER = T.StructType(
    [T.StructField("timestamp", T.TimestampType()), T.StructField("higher_window", T.FloatType())]
)
LOWER = T.StructType(
    [T.StructField("timestamp", T.TimestampType()), T.StructField("lower_window", T.FloatType())]
)

MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS[XXX]"


def decode(messages: DataFrame, schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Messages with a binary or text ``value`` to typed columns.

    Bad text gives a record of NULLs, a bad field a NULL, an unknown field is ignored; no message is dropped.
    ``keep`` names transport columns to carry along.
    """
    record = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(*keep, record.alias("data")).select(*keep, "data.*")


def encode(
    records: DataFrame,
    schema: T.StructType,
    keep_nulls: bool = False,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Typed columns to messages with one JSON text column ``value``.

    Spark's defaults drop NULL fields and keep milliseconds; ``keep_nulls`` and ``timestamp_format`` change that.
    """
    options = {"timeZone": "UTC"}
    if keep_nulls:
        options["ignoreNullFields"] = "false"
    if timestamp_format:
        options["timestampFormat"] = timestamp_format
    return records.select(json_text(F.struct(*schema.fieldNames()), options).alias("value"))


def json_text(record: Column, options: dict[str, str] | None = None) -> Column:
    return F.to_json(record, options or {})
