"""The keyed, partitioned event log: a Kafka topic, or Parquet files with the same columns."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed default topic name.
TOPIC = "events"

# ``arrived_at`` is the log's own append time: the default event time that a replay repeats.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("arrived_at", T.TimestampType()),
    ]
)


def _from_kafka(rows: DataFrame) -> DataFrame:
    return rows.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrived_at"),
    )


def read_events_stream(
    spark: SparkSession,
    path: str | None = None,
    kafka: dict | None = None,
    topic: str = TOPIC,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The log as a stream, from its oldest message.

    ``kafka`` holds source options (``kafka.bootstrap.servers`` at least; ``maxOffsetsPerTrigger``
    bounds a batch) and needs Spark's Kafka package; ``path`` reads Parquet files as they appear.
    """
    if kafka is not None:
        options = {"subscribe": topic, "startingOffsets": "earliest", **kafka}
        return _from_kafka(spark.readStream.format("kafka").options(**options).load())
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_events_range(
    spark: SparkSession,
    path: str | None = None,
    lo: dict[int, int] | None = None,
    hi: dict[int, int] | None = None,
    kafka: dict | None = None,
    topic: str = TOPIC,
    partitions: int | None = None,
) -> DataFrame:
    """A stretch of history for a replay: per partition from ``lo`` on, up to but without ``hi``.

    Partitions that are not named are read whole. With ``partitions``, the topic's number of them, a
    Kafka range is cut at the broker; without it the whole topic is read and filtered.
    """
    lo, hi = lo or {}, hi or {}
    if kafka is not None:
        options = {"subscribe": topic, **kafka_range(topic, lo, hi, partitions), **kafka}
        rows = _from_kafka(spark.read.format("kafka").options(**options).load())
    else:
        rows = spark.read.schema(RAW_SCHEMA).parquet(path)
    for partition, offset in lo.items():
        rows = rows.filter((F.col("partition") != partition) | (F.col("offset") >= offset))
    for partition, offset in hi.items():
        rows = rows.filter((F.col("partition") != partition) | (F.col("offset") < offset))
    return rows


def kafka_range(topic: str, lo: dict[int, int], hi: dict[int, int], partitions: int | None) -> dict[str, str]:
    """Source options for a range. Kafka wants every partition named: -2 is its oldest message, -1 its end."""
    if partitions is None:
        return {}
    every = range(partitions)
    return {
        "startingOffsets": kafka_offsets(topic, {p: lo.get(p, -2) for p in every}),
        "endingOffsets": kafka_offsets(topic, {p: hi.get(p, -1) for p in every}),
    }


def kafka_offsets(topic: str, offsets: dict[int, int]) -> str:
    """``startingOffsets`` / ``endingOffsets`` text for a topic, to cut a replay at the broker."""
    return json.dumps({topic: {str(p): o for p, o in sorted(offsets.items())}})


def repartition_by_key(df: DataFrame, n: int, key: str = "user_id") -> DataFrame:
    """All rows of a key in one of ``n`` partitions."""
    return df.repartition(n, key)


def keyed_messages(events: DataFrame, key: str = "user_id") -> DataFrame:
    """Events as ``key``, ``value`` (JSON) messages, the shape a Kafka sink takes."""
    fields = [c for c in ("user_id", "event_type", "value", "timestamp", "trace_id") if c in events.columns]
    return events.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )
