"""Late events as a table of their own, instead of dropped in silence.

A windowed aggregation in append or update mode drops events whose window the
watermark has passed. ``late_splitter`` stands before it: every micro-batch is
parted by the watermark that the batches before it have set, the late events
go to a side table, the others to a table (or any other batch writer) that the
windows are computed from.

The windows then lose nothing. An event of batch k is on time if its window
ends after the newest time of the batches before k, less the delay. A stream
over the table of events on time, with the same delay and window, has seen
only batches before k when it meets that event, so its own watermark is no
further - if it takes each batch whole. ``sinks.whole_batch_writer`` writes
batches so; the stream must not limit the files of a trigger. Windows and side
table together then hold every event exactly once.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tallyriver.storage import child_names, current_folder, drop_old_versions, publish
from tallyriver.streaming.sinks import BatchWriter, batch_folder

BEHIND, NO_TIME = "behind watermark", "no time"
#: a replay of a batch needs the version before it
VERSIONS_KEPT = 3


def watermark_before(spark: SparkSession, path: str, batch_id: int, delay: str, kind: str = "timestamp") -> Column:
    """The watermark that the batches before ``batch_id`` have set, as a literal; null before the first event."""
    folder = current_folder(spark, f"{path}/newest", below=batch_id)
    # one row
    newest = None if folder is None else spark.read.parquet(folder).first()["newest"]
    return F.lit(newest).cast(kind) - F.expr(f"interval {delay}")


def _end(ts: str, window: str | None) -> Column:
    return F.col(ts) if window is None else F.window(ts, window)["end"]


def late_splitter(
    path: str, on_time: BatchWriter, ts: str = "timestamp", delay: str = "10 seconds", window: str | None = "1 minute"
) -> BatchWriter:
    """Hand events on time to ``on_time`` and keep late ones in the side table below ``path``.

    An event is late if its tumbling ``window`` (or, without one, its own time) ends at or before the watermark, which
    is the newest time of the batches before less ``delay``. Events without a time belong to no window and go to the
    side table, too. A batch that is repeated is parted by the same watermark and replaces its own output, so nothing
    is lost or counted twice. State is one row; only that row reaches the driver.

    ``path`` and the checkpoint of the stream belong together.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kind: DataType = batch.schema[ts].dataType
        before = watermark_before(spark, path, batch_id, delay, kind.simpleString())
        no_time, behind = F.col(ts).isNull(), F.coalesce(_end(ts, window) <= before, F.lit(False))
        if window is not None:
            # the window function leaves out rows without a time
            timed = batch.filter(~no_time).withColumn("__reason", F.when(behind, F.lit(BEHIND)))
            tagged = timed.unionByName(batch.filter(no_time).withColumn("__reason", F.lit(NO_TIME)))
        else:
            tagged = batch.withColumn("__reason", F.when(no_time, F.lit(NO_TIME)).when(behind, F.lit(BEHIND)))
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            late = tagged.filter(F.col("__reason").isNotNull())
            columns = [F.col(f"`{c}`") for c in batch.columns]
            side = late.select(*columns, F.col("__reason").alias("late_reason"), before.alias("watermark"))
            side.write.mode("overwrite").parquet(batch_folder(f"{path}/late", batch_id))
            on_time(tagged.filter(F.col("__reason").isNull()).select(*columns), batch_id)
            newest = tagged.agg(F.max(ts).alias("newest"))
            folder = current_folder(spark, f"{path}/newest", below=batch_id)
            if folder is not None:
                newest = newest.unionByName(spark.read.parquet(folder)).agg(F.max("newest").alias("newest"))
            # the last step: without it the batch counts as not done, and is repeated
            publish(newest.coalesce(1), f"{path}/newest", batch_id)
            drop_old_versions(spark, f"{path}/newest", VERSIONS_KEPT)
        finally:
            tagged.unpersist()

    return write


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The side table: the events' columns, ``late_reason``, ``watermark`` and the ``batch_id`` that brought them."""
    if not child_names(spark, f"{path}/late"):
        raise FileNotFoundError(f"no batch has been written to {path}")
    return spark.read.parquet(f"{path}/late")


def late_counts(spark: SparkSession, path: str, ts: str = "timestamp") -> DataFrame:
    """Late events of each batch and reason, and how far the oldest of them lay behind the watermark."""
    behind = F.unix_micros("watermark") - F.unix_micros(ts)
    return read_late(spark, path).groupBy("batch_id", "late_reason").agg(
        F.count(F.lit(1)).alias("late_events"), F.max(behind).alias("most_behind_micros")
    )
