"""Session numbers and session starts on streams, in the JVM.

Every micro-batch is numbered like a bounded frame and goes on from the events that earlier batches had of its sessions.
Those counts are a table in hash buckets of the session: a delta of one row per session and batch, which a replay
overwrites, and a base per bucket. A batch reads the buckets it touches; every few batches the deltas are folded into
new bases of the buckets they touch, and what no later batch or replay needs is removed. There is no state in Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyriver.functions.columns import flag
from tallyriver.operators.sessions import HOT_ROWS, RANGES, with_session_numbers
from tallyriver.storage import (
    broadcast_if_small,
    child_names,
    current_folder,
    drop_batches,
    drop_old_versions,
    drop_path,
    path_exists,
    publish,
)
from tallyriver.streaming.sinks import BatchWriter, batch_folder

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FOLD_EVERY = 32
FOLDS_KEPT = 2
BUCKETS = 32


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the state of queries started from now on in RocksDB, for state larger than memory."""
    spark.conf.set(STATE_PROVIDER, ROCKSDB)


_COUNTS = "session string, n bigint, last timestamp"
_FOLD = "bucket int, version bigint, newest timestamp"


class _Table:
    """Counts of sessions as of a batch: bases of buckets, and the deltas of the batches since the last fold.

    ``folds/version=N`` lists, for the fold after batch N, the version of every bucket's base and the newest time
    (one row for each bucket). ``base/version=N/bucket=B`` and ``counts/batch_id=N/bucket=B`` hold the counts.
    """

    def __init__(self, spark: SparkSession, path: str, batch_id: int):
        self.spark, self.path = spark, path
        folder = current_folder(spark, f"{path}/folds", below=batch_id)
        self.fold = -1 if folder is None else int(folder.rsplit("=", 1)[1])
        # as many rows as buckets
        rows = [] if folder is None else spark.read.schema(_FOLD).parquet(folder).collect()
        self.bases = {r["bucket"]: r["version"] for r in rows}
        self.newest = max((r["newest"] for r in rows if r["newest"] is not None), default=None)
        found = child_names(spark, f"{path}/counts")
        self.batches = [n for n in found if n.startswith("batch_id=") and self.fold < int(n.split("=")[1]) < batch_id]

    def deltas(self, buckets: set[int] | None = None) -> list[str]:
        """Folders of the deltas since the last fold, of some buckets or all."""
        found = []
        for name in self.batches:
            parts = [p for p in child_names(self.spark, f"{self.path}/counts/{name}") if p.startswith("bucket=")]
            found += [f"{self.path}/counts/{name}/{p}" for p in parts if buckets is None or _bucket_of(p) in buckets]
        return found

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(_COUNTS).parquet(*folders) if folders else self.spark.createDataFrame([], _COUNTS)

    def files(self, buckets: set[int]) -> list[str]:
        """The folders that a batch of these buckets reads."""
        bases = [f"{self.path}/base/version={self.bases[b]}/bucket={b}" for b in sorted(buckets) if b in self.bases]
        return [f for f in bases if path_exists(self.spark, f)] + self.deltas(buckets)

    def known(self, buckets: set[int], ttl: float | None) -> DataFrame:
        """Events and last time of each session in these buckets, without those forgotten at the last fold."""
        folders = self.files(buckets)
        base = _remembered(self._read([f for f in folders if "/base/" in f]), self.newest, ttl)
        rows = base.unionByName(self._read([f for f in folders if "/counts/" in f]))
        return rows.groupBy("session").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def _bucket_of(folder: str) -> int:
    return int(folder.rsplit("bucket=", 1)[1])


def _remembered(rows: DataFrame, newest: datetime | None, ttl: float | None) -> DataFrame:
    if ttl is None or newest is None:
        return rows
    return rows.filter(F.col("last") >= F.lit(newest) - F.make_dt_interval(secs=F.lit(ttl)))


def _by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("session"), F.lit(buckets)).cast("int"))


def session_writer(
    path: str,
    write: BatchWriter,
    session: str = "session_id",
    ts: str = "timestamp",
    tie: Sequence[str] | None = None,
    ttl: float | None = None,
    hot_rows: int | None = HOT_ROWS,
    fold_every: int = FOLD_EVERY,
    salts: int = 1,
    buckets: int = BUCKETS,
) -> BatchWriter:
    """Add ``session_event_number`` and ``is_session_start`` to every micro-batch and hand it to ``write``.

    Within a micro-batch the order is that of ``with_session_numbers``; an
    event that comes in a later batch gets a later number even if it is older.
    Events without a session get no number.

    ``path`` belongs to one checkpoint and keeps its number of ``buckets``. Every ``fold_every`` batches the counts of
    the buckets touched are folded into new bases, and folders that neither later batches nor a replay of the last one
    need are removed. With ``ttl`` the fold forgets sessions whose last event is more than ``ttl`` seconds older than
    the newest event of any session, where times after the present do not count; such a session starts again. Without
    it sessions are kept for good. A batch whose largest session has more than ``hot_rows`` events is numbered by
    prefix sums, any other by a window. ``salts`` spreads hot sessions where the counts of a batch are too many to
    broadcast.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            keyed = held.filter(F.col(session).isNotNull())
            counts = keyed.groupBy(F.col(session).cast("string").alias("session")).agg(
                F.count(F.lit(1)).alias("n"), F.max(F.col(ts).cast("timestamp")).alias("last")
            )
            delta = batch_folder(f"{path}/counts", batch_id)
            dealt = _by_bucket(counts, buckets).repartition("bucket")
            dealt.write.mode("overwrite").partitionBy("bucket").parquet(delta)
            mine = spark.read.schema(f"{_COUNTS}, bucket int").parquet(delta)
            largest = mine.agg(F.max("n").alias("n")).first()["n"] or 0
            touched = {_bucket_of(p) for p in child_names(spark, delta) if p.startswith("bucket=")}
            met = _Table(spark, path, batch_id).known(touched, ttl).join(mine.select("session"), "session", "left_semi")
            # written, so that its size is known before it is broadcast
            before = batch_folder(f"{path}/before", batch_id)
            met.select("session", "n").write.mode("overwrite").parquet(before)
            offsets = spark.read.schema("session string, n bigint").parquet(before)
            offsets = offsets.select(F.col("session").alias("__session"), F.col("n").alias("__before"))
            method = None if hot_rows is None or largest <= hot_rows else RANGES
            numbered = with_session_numbers(held, session, ts, tie, hot_rows=method).drop("is_session_start")
            same = F.col(session).cast("string") == F.col("__session")
            if salts > 1:
                spread = F.pmod(F.xxhash64(ts, "session_event_number"), F.lit(salts)).cast("int")
                numbered = numbered.withColumn("__salt", spread)
                offsets = offsets.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
                same = same & (F.col("__salt") == F.col("__part"))
            joined = numbered.join(broadcast_if_small(offsets), same, "left")
            number = F.col("session_event_number") + F.coalesce("__before", F.lit(0))
            started = flag(F.col("session_event_number") == 1)
            result = joined.withColumn("session_event_number", number).withColumn("is_session_start", started)
            write(result.select(*held.columns, "session_event_number", "is_session_start"), batch_id)
            drop_batches(spark, f"{path}/before", batch_id)
            if batch_id % fold_every == fold_every - 1:
                _fold(spark, path, batch_id, buckets, ttl)
        finally:
            held.unpersist()

    return handle


def _fold(spark: SparkSession, path: str, batch_id: int, buckets: int, ttl: float | None) -> None:
    """New bases of the buckets touched since the last fold; a fold of the same batch is replaced."""
    table = _Table(spark, path, batch_id + 1)
    if table.fold == batch_id:
        table = _Table(spark, path, batch_id)
        table.batches.append(f"batch_id={batch_id}")
    deltas = table.deltas()
    touched = {_bucket_of(f) for f in deltas}
    newest = table.newest
    if deltas:
        past = F.when(F.col("last") <= F.current_timestamp(), F.col("last"))
        latest = table._read(deltas).agg(F.max(past).alias("newest")).first()["newest"]
        newest = max((t for t in (newest, latest) if t is not None), default=None)
    rows = _by_bucket(_remembered(table.known(touched, ttl), newest, ttl), buckets)
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/base/version={batch_id}")
    bases = {**table.bases, **dict.fromkeys(touched, batch_id)}
    publish(spark.createDataFrame([(b, v, newest) for b, v in sorted(bases.items())], _FOLD).coalesce(1), f"{path}/folds", batch_id)
    # a replay of this batch starts from the fold before, so what that one needs stays
    drop_batches(spark, f"{path}/counts", table.fold)
    drop_old_versions(spark, f"{path}/folds", FOLDS_KEPT)
    needed = {(b, v) for known in (bases, table.bases) for b, v in known.items()}
    for version in child_names(spark, f"{path}/base"):
        number, parts = int(version.split("=")[1]), child_names(spark, f"{path}/base/{version}")
        kept = [p for p in parts if p.startswith("bucket=") and (_bucket_of(p), number) in needed]
        if not kept and number != batch_id:
            drop_path(spark, f"{path}/base/{version}")
            continue
        for part in set(parts) - set(kept):
            if part.startswith("bucket="):
                drop_path(spark, f"{path}/base/{version}/{part}")


def start_writer(path: str, write: BatchWriter, **options) -> BatchWriter:
    """The first event of each session, once: what ``session_writer`` numbers 1, with the columns of the stream."""

    def starts(numbered: DataFrame, batch_id: int) -> None:
        first = numbered.filter(F.col("is_session_start") == 1)
        write(first.drop("session_event_number", "is_session_start"), batch_id)

    return session_writer(path, starts, **options)
