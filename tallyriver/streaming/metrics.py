"""Exact distinct users in update and complete mode.

Spark allows only one aggregation in these modes. The stream therefore keeps
partial groups per user bucket (``metrics.minute_partials`` and
``campaign_partials``), and these writers add the buckets up in every batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.storage import current_folder, drop_batches, drop_old_versions
from tallyriver.streaming.sinks import BatchWriter, batch_folder

Merge = Callable[[DataFrame], DataFrame]
FOLD_EVERY = 16
FILES_PER_DATE = 8  # a parameter of the writer, to be set by the size of a date's state


def complete_writer(merge: Merge, write: BatchWriter) -> BatchWriter:
    """For complete mode: every batch holds all partial groups."""

    def merged(batch: DataFrame, batch_id: int) -> None:
        write(merge(batch), batch_id)

    return merged


def update_writer(
    path: str,
    keys: Sequence[str],
    merge: Merge,
    write: BatchWriter,
    files_per_date: int = FILES_PER_DATE,
    fold_every: int = FOLD_EVERY,
    retain: str | None = None,
) -> BatchWriter:
    """For update mode: a batch holds only the partial groups that changed.

    They are kept below ``path``, split by the date of their window. The
    result of a batch is every group of the windows it touched, from the
    newest state of all their partial groups; only the dates touched are read.

    Every ``fold_every`` batches the newest states become a base, and batches
    before the last base are removed, so a date has a bounded number of files
    however old the stream is. ``retain`` (an interval such as "2 days", longer
    than the watermark's delay) leaves windows out of the base that ended so
    long before the newest one: the stream never touches them again.
    """

    def merged(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.withColumn("window_date", F.to_date("window.start"))
        # so many files per date, however many state partitions there are
        spread = dated.repartition("window_date", F.pmod("user_bucket", F.lit(files_per_date)))
        spread.write.mode("overwrite").partitionBy("window_date").parquet(batch_folder(f"{path}/deltas", batch_id))
        kept = _states(spark, path, batch_id, dated.schema)
        current = kept.filter(F.col("batch_id") == batch_id)
        touched = current.select("window_date", "window", *keys).distinct()
        same = [kept[c].eqNullSafe(touched[c]) for c in ("window", *keys)]
        history = kept.join(touched, [kept["window_date"] == touched["window_date"], *same], "left_semi")
        write(merge(_newest(history, keys, batch.columns).drop("batch_id")), batch_id)
        if batch_id % fold_every == fold_every - 1:
            _fold(spark, path, batch_id, dated, keys, files_per_date, retain)

    return merged


def _states(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """States of a batch and of all before it: the newest base before the batch, and the batches since."""
    numbered = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    folder = current_folder(spark, f"{path}/base", below=batch_id)
    after = -1 if folder is None else int(folder.rsplit("=", 1)[1])
    deltas = spark.read.schema(numbered).parquet(f"{path}/deltas")
    rows = deltas.filter((F.col("batch_id") > after) & (F.col("batch_id") <= batch_id))
    return rows if folder is None else rows.unionByName(spark.read.schema(numbered).parquet(folder))


def _newest(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The newest state of every partial group, with its batch."""
    values = [c for c in columns if c not in ("window", "user_bucket", *keys)]
    newest = [F.max_by(c, "batch_id").alias(c) for c in values]
    return rows.groupBy("window", *keys, "user_bucket").agg(*newest, F.max("batch_id").alias("batch_id"))


def _fold(
    spark: SparkSession, path: str, batch_id: int, dated: DataFrame, keys: Sequence[str], files: int, retain: str | None
) -> None:
    rows = _states(spark, path, batch_id, dated.schema)
    if retain is not None:
        newest = rows.agg(F.max("window.end").alias("end")).first()["end"]
        if newest is not None:
            rows = rows.filter(F.col("window.end") > F.lit(newest) - F.expr(f"interval {retain}"))
    columns = [c for c in dated.columns if c != "window_date"]
    base = _newest(rows, keys, columns).withColumn("window_date", F.to_date("window.start"))
    spread = base.repartition("window_date", F.pmod("user_bucket", F.lit(files)))
    spread.write.mode("overwrite").partitionBy("window_date").parquet(f"{path}/base/version={batch_id}")
    # a replay of this batch starts from the base before, so what that one needs stays
    before = current_folder(spark, f"{path}/base", below=batch_id)
    if before is not None:
        drop_batches(spark, f"{path}/deltas", int(before.rsplit("=", 1)[1]))
    drop_old_versions(spark, f"{path}/base", 2)
