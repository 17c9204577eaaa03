"""Starting streaming queries, and micro-batch writers that survive replays.

Spark may run a micro-batch again after a failure. The writers here put every
batch into a place of its own that a second run overwrites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyriver.operators.events import debug_view
from tallyriver.operators.points import point_lines, write_points
from tallyriver.operators.quality import bad_records, good_records, tag_records
from tallyriver.sinks.tables import dead_letter_records, kafka_writer, to_kafka_records
from tallyriver.storage import drop_old_versions, make_folder, path_exists, publish, rename_path

BatchWriter = Callable[[DataFrame, int], None]


def with_watermark(df: DataFrame, ts: str = "timestamp", delay: str = "10 seconds") -> DataFrame:
    """Set the event-time watermark. Do so once per stream: operators add none of their own."""
    return df.withWatermark(ts, delay)


def _skipping_empty(writer: BatchWriter) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not held.isEmpty():
                writer(held, batch_id)
        finally:
            held.unpersist()

    return write


def start_sink(
    df: DataFrame,
    writer: BatchWriter,
    mode: str = "append",
    trigger: str = "5 seconds",
    checkpoint: str | None = None,
    name: str | None = None,
    skip_empty: bool = False,
) -> StreamingQuery:
    """Run ``writer`` on every micro-batch.

    ``trigger`` is an interval, or ``"available"`` to read what is there and
    stop. ``checkpoint`` must stay the same over restarts and differ between
    queries. The writers of this module do nothing costly on an empty batch;
    for others, ``skip_empty`` holds each batch to look before calling them.
    """
    stream = df.writeStream.outputMode(mode).foreachBatch(_skipping_empty(writer) if skip_empty else writer)
    stream = stream.trigger(availableNow=True) if trigger == "available" else stream.trigger(processingTime=trigger)
    if checkpoint is not None:
        stream = stream.option("checkpointLocation", checkpoint)
    if name is not None:
        stream = stream.queryName(name)
    return stream.start()


def start_console(df: DataFrame, trigger: str = "10 seconds", checkpoint: str | None = None) -> StreamingQuery:
    """Print the debug columns of the stream."""
    stream = debug_view(df).writeStream.outputMode("append").format("console").trigger(processingTime=trigger)
    if checkpoint is not None:
        stream = stream.option("checkpointLocation", checkpoint)
    return stream.start()


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def parquet_writer(path: str) -> BatchWriter:
    """Every batch as its own partition folder ``batch_id=N``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def whole_batch_writer(path: str) -> BatchWriter:
    """Every batch as a folder ``batch_id=N`` that appears by one rename, for streams that read the folders.

    Such a reader never meets half a batch. A batch that is repeated finds its folder and leaves it, as new files would
    be read as new rows. Needs a file system that renames folders in one step.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, batch_folder(path, batch_id)
        if path_exists(spark, folder):
            return
        staged = batch_folder(f"{path.rstrip('/')}__staged", batch_id)
        batch.write.mode("overwrite").parquet(staged)
        make_folder(spark, path)
        rename_path(spark, staged, folder)

    return write


def latest_writer(path: str, keep: int = 3) -> BatchWriter:
    """The newest batch as the current version, for queries in complete mode.

    Read it with ``storage.read_current``; the last ``keep`` versions stay for readers that have begun.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(batch, path, batch_id)
        drop_old_versions(batch.sparkSession, path, keep)

    return write


def line_writer(path: str) -> BatchWriter:
    """Points as lines of text, every batch in its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        point_lines(batch).write.mode("overwrite").text(batch_folder(path, batch_id))

    return write


def point_writer(writer_factory: Callable[[], object], batch_size: int = 1000) -> BatchWriter:
    """Points to an external store, one writer per task."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_points(batch, writer_factory, batch_size)

    return write


def topic_writer(servers: str, topic: str, dead_letters: bool = False) -> BatchWriter:
    """Every batch to a Kafka topic: events as JSON, or unusable records with their reason."""

    def write(batch: DataFrame, batch_id: int) -> None:
        records = dead_letter_records(batch) if dead_letters else to_kafka_records(batch)
        kafka_writer(records, servers, topic).save()

    return write


def dead_letter_writer(good: BatchWriter, bad: BatchWriter) -> BatchWriter:
    """Split envelopes: decoded events to one writer, unusable records to the other.

    The batch is held while both are written, so each document is decoded once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_records(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good(good_records(tagged), batch_id)
            bad(bad_records(tagged), batch_id)
        finally:
            tagged.unpersist()

    return write
