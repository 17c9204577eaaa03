"""Event source: Kafka options, envelope projection and JSON decoding.

The same decoding works on bounded and streaming frames and on any frame with
the columns of ``ENVELOPE_SCHEMA``, wherever it was read from.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.schemas import EVENT_SCHEMA

ENVELOPE_COLUMNS = ("topic", "partition", "offset", "kafka_timestamp")


def kafka_stream_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of an unbounded subscription that tolerates lost offsets."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return {**options, **(extra or {})}


def kafka_batch_options(
    servers: str,
    topic: str,
    start: str = "earliest",
    end: str = "latest",
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a bounded read between offsets (names or offset JSON)."""
    if start == "latest":
        raise ValueError("a bounded read cannot start at 'latest'")
    if end == "earliest":
        raise ValueError("a bounded read cannot end at 'earliest'")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "endingOffsets": end,
    }
    return {**options, **(extra or {})}


def read_events_stream(spark: SparkSession, options: Mapping[str, str], source: str = "kafka") -> DataFrame:
    """Decoded unbounded events from a source that yields Kafka envelopes."""
    return events_from_envelope(spark.readStream.format(source).options(**options).load())


def read_events_batch(spark: SparkSession, options: Mapping[str, str], source: str = "kafka") -> DataFrame:
    """Decoded bounded events, for replay and tests."""
    return events_from_envelope(spark.read.format(source).options(**options).load(), derived=False)


def project_envelope(df: DataFrame) -> DataFrame:
    """Key and value as text; the broker's time gets its own name."""
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def decode_events(df: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """JSON values as typed columns beside the envelope columns.

    A bad field becomes NULL, a bad document NULL in every field. ``inline``
    keeps later filters above the parse, so each document is parsed once.
    """
    return df.select(
        "key",
        F.inline(F.array(F.from_json("value", schema))),
        *[c for c in ENVELOPE_COLUMNS if c in df.columns],
    )


def decode_avro(df: DataFrame, avsc: str) -> DataFrame:
    """Avro values as typed columns. Needs Spark's Avro package on the class path."""
    from pyspark.sql.avro.functions import from_avro

    return df.select(
        F.col("key").cast("string").alias("key"),
        from_avro("value", avsc, {"mode": "PERMISSIVE"}).alias("event"),
        *[c for c in ENVELOPE_COLUMNS if c in df.columns],
    ).select("key", "event.*", *[c for c in ENVELOPE_COLUMNS if c in df.columns])


def with_event_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """ISO text as timestamp (NULL if unreadable), and the time of processing."""
    return df.withColumns(
        {
            column: F.try_to_timestamp(F.col(column)),
            "processing_time": F.current_timestamp(),
        }
    )


def with_date_parts(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.withColumns(
        {
            "year": F.year(column),
            "month": F.month(column),
            "day": F.dayofmonth(column),
            "hour": F.hour(column),
        }
    )


def valid_events(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type").isNotNull())


def events_from_envelope(df: DataFrame, derived: bool = True) -> DataFrame:
    """Envelope to typed events with event time, optionally with date parts."""
    events = with_event_time(decode_events(project_envelope(df)))
    events = with_date_parts(events) if derived else events.drop("processing_time")
    return valid_events(events)


def latest_events(df: DataFrame, n: int = 100, order: tuple[str, ...] = ("kafka_timestamp", "partition", "offset")) -> DataFrame:
    """The newest ``n`` events; every task keeps only its own best ``n``."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
