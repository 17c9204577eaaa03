"""The summary table as a streaming sink.

Every micro-batch writes its hourly deltas into a folder of its own, which a
replay overwrites, so no batch is ever added twice. Readers fold the deltas;
``compact_summary`` folds them into a base from time to time. The base is kept
by date, and a compaction writes the dates that its deltas touch: a small list,
one row for each date, says which version of a date counts. The work of a batch
does not depend on the size of the summary, that of a compaction on the dates
it touches.

A summary and the checkpoint of its stream belong together: batch ids start
again with a new checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyriver.operators.metrics import USER_SKETCH, hourly_rollup
from tallyriver.operators.summary import upsert_summary
from tallyriver.schemas import EVENT_SUMMARY_SCHEMA
from tallyriver.storage import (
    child_names,
    current_folder,
    drop_batches,
    drop_old_versions,
    drop_path,
    make_folder,
    path_exists,
    publish,
)
from tallyriver.streaming.sinks import BatchWriter, batch_folder, start_sink

#: how Spark names the folder of a null partition value
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
_SKETCHED_SCHEMA = T.StructType([*EVENT_SUMMARY_SCHEMA.fields, T.StructField(USER_SKETCH, T.BinaryType())])


_FOLDS = "folder string, version bigint"
FOLDS_KEPT = 2


def upsert_writer(
    path: str, ts: str = "timestamp", fold_every: int | None = None, sketch: int | None = None
) -> BatchWriter:
    """Deltas of transformed events, one folder per batch; every ``fold_every`` batches they are compacted.

    With ``sketch`` cells carry sketches of their users (see ``hourly_rollup``), and the summary keeps them from then on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if sketch is not None:
            make_folder(batch.sparkSession, f"{path}/sketches")
        hourly_rollup(batch, ts, sketch).write.mode("overwrite").parquet(batch_folder(f"{path}/deltas", batch_id))
        if fold_every and batch_id % fold_every == fold_every - 1:
            compact_summary(batch.sparkSession, path)

    return write


def start_upsert(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = "60 seconds",
    ts: str = "timestamp",
    fold_every: int | None = None,
    sketch: int | None = None,
) -> StreamingQuery:
    return start_sink(df, upsert_writer(path, ts, fold_every, sketch), "append", trigger, checkpoint)


def _schema(spark: SparkSession, path: str) -> T.StructType:
    """Columns of the summary: with sketches once a writer has kept them."""
    return _SKETCHED_SCHEMA if path_exists(spark, f"{path}/sketches") else EVENT_SUMMARY_SCHEMA


def _folds(spark: SparkSession, path: str) -> tuple[int | None, dict[str, int]]:
    """The last batch of the newest base, and the version of every date's folder."""
    folder = current_folder(spark, f"{path}/folds")
    if folder is None:
        return None, {}
    # one row for each date
    rows = spark.read.schema(_FOLDS).parquet(folder).collect()
    return int(folder.rsplit("=", 1)[1]), {r["folder"]: r["version"] for r in rows}


def _deltas(spark: SparkSession, path: str, after: int | None, last: int | None = None) -> DataFrame:
    schema = T.StructType([*_schema(spark, path).fields, T.StructField("batch_id", T.LongType())])
    if not child_names(spark, f"{path}/deltas"):
        return spark.createDataFrame([], schema)
    deltas = spark.read.schema(schema).parquet(f"{path}/deltas")
    if last is not None:
        deltas = deltas.filter(F.col("batch_id") <= last)
    return deltas if after is None else deltas.filter(F.col("batch_id") > after)


def read_summary(
    spark: SparkSession, path: str, literal: bool = False, last: int | None = None, folders: Sequence[str] | None = None
) -> DataFrame:
    """The summary as of the last batch written, or as of batch ``last``, which no base may be beyond.

    With ``folders`` the base is that of these dates only; all deltas count. Sketches of users come along if they are kept.
    """
    version, known = _folds(spark, path)
    wanted = [f"{path}/base/version={v}/{f}" for f, v in sorted(known.items()) if folders is None or f in folders]
    base = None
    if wanted:
        schema = _schema(spark, path)
        found = spark.read.schema(schema).option("basePath", f"{path}/base").parquet(*wanted)
        base = found.select(*schema.names)
    return upsert_summary(base, _deltas(spark, path, version, last), "batch_id", literal)


def _folder(date) -> str:
    return f"date={NO_DATE if date is None else date}"


def compact_summary(spark: SparkSession, path: str, literal: bool = False, retain_from: date | None = None) -> int | None:
    """Write a base that holds all batches so far; returns the last batch in it.

    Only dates that new batches touch are written; the files of all others stay as they are. Dates before
    ``retain_from`` are dropped whole. A batch that lands meanwhile stays a delta. What neither the newest base nor the
    one before needs is removed, so readers that have begun go on.
    """
    version, known = _folds(spark, path)
    deltas = _deltas(spark, path, version)
    last = deltas.agg(F.max("batch_id")).first()[0]
    if last is None:
        return None
    # as many rows as dates
    touched = {r["date"] for r in deltas.filter(F.col("batch_id") <= last).select("date").distinct().collect()}
    touched = {d for d in touched if retain_from is None or d is None or d >= retain_from}
    folders = {_folder(d) for d in touched}
    rows = read_summary(spark, path, literal, last, sorted(folders))
    if retain_from is not None:
        rows = rows.filter(F.col("date").isNull() | (F.col("date") >= F.lit(retain_from)))
    rows.repartition("date").write.mode("overwrite").partitionBy("date").parquet(f"{path}/base/version={last}")
    now = {**known, **dict.fromkeys(folders, last)}
    if retain_from is not None:
        now = {f: v for f, v in now.items() if f == _folder(None) or f >= _folder(retain_from)}
    publish(spark.createDataFrame(sorted(now.items()), _FOLDS).coalesce(1), f"{path}/folds", last)
    drop_old_versions(spark, f"{path}/folds", FOLDS_KEPT)
    if version is not None:
        drop_batches(spark, f"{path}/deltas", version)
    needed = {(v, f) for folds in (now, known) for f, v in folds.items()}
    for name in child_names(spark, f"{path}/base"):
        number, parts = int(name.split("=")[1]), child_names(spark, f"{path}/base/{name}")
        unused = [p for p in parts if p.startswith("date=") and (number, p) not in needed]
        if number != last and not any((number, p) in needed for p in parts):
            drop_path(spark, f"{path}/base/{name}")
        else:
            for part in unused:
                drop_path(spark, f"{path}/base/{name}/{part}")
    return last
