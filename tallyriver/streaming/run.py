"""Running the streaming queries together, and their progress as a table."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallyriver.functions.columns import money_sum
from tallyriver.operators.enrichment import Lookup, enrich
from tallyriver.operators.events import transform_events
from tallyriver.operators.points import event_points
from tallyriver.streaming.sinks import BatchWriter

#: seconds to wait for one query before looking at the next
WAIT = 0.2
FLUSH_EVERY = 50
_PROGRESS = "records bigint, seconds double, query_id string, batch_id bigint, logged bigint, observed map<string, double>"


def event_writer(
    lookup: Lookup, write: BatchWriter, ts: str = "timestamp", points: bool = True, salts: int = 1
) -> BatchWriter:
    """Enrich and transform each micro-batch with a dimension that is kept fresh, and write it.

    The batches must already carry session numbers: pass it to ``sessions.session_writer``.
    ``salts`` spreads hot users where the dimension is too large to broadcast.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        events = transform_events(enrich(batch, lookup.get(), ts, salts=salts), ts)
        write(event_points(events, ts) if points else events, batch_id)

    return handle


def run_all(
    spark: SparkSession, starters: Sequence[Callable[[], StreamingQuery]], timeout: float | None = None
) -> list[StreamingQuery]:
    """Start the queries, wait until one ends (or for ``timeout`` seconds), then stop all.

    If a query failed, its exception is raised after the others have stopped. Other queries of the session play no part.
    """
    started: list[StreamingQuery] = []
    until = None if timeout is None else time.monotonic() + timeout
    try:
        for start in starters:
            started.append(start())
        # raises the failure of a query that has ended with one
        while started and not any(query.awaitTermination(WAIT) for query in started):
            if until is not None and time.monotonic() >= until:
                break
    finally:
        for query in started:
            query.stop()
    return started


def run_available(starters: Sequence[Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start queries with the "available" trigger and wait until all have read everything.

    If one fails, the others are stopped before its exception is raised.
    """
    started: list[StreamingQuery] = []
    try:
        for start in starters:
            started.append(start())
        for query in started:
            query.awaitTermination()
    except Exception:
        for query in started:
            query.stop()
        raise
    return started


def followed_by(write: BatchWriter, start: Callable[[], StreamingQuery]) -> BatchWriter:
    """After each batch has been written, run a query with the "available" trigger over what is there.

    So a second stream takes its micro-batches from the batches of the first. A repeated batch runs it again, which
    then finds nothing new if ``write`` leaves a batch that is there alone.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        run_available([start])

    return handle


class ProgressLog(StreamingQueryListener):
    """Appends every batch's progress to a table, however long a stream runs.

    Register it with ``spark.streams.addListener`` before the queries start. Rows are collected and written
    ``flush_every`` at a time and when a query ends, so a slow store does not hold up each batch. Every observed metric
    of a stream (``DataFrame.observe``) that is a number comes along, named ``observation.metric``. Of a repeated batch
    the last row counts.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = FLUSH_EVERY):
        self._spark, self._path, self._flush_every = spark, path, flush_every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {
            f"{name}.{key}": float(value)
            for name, row in p.observedMetrics.items()
            for key, value in row.asDict().items()
            if isinstance(value, (int, float, Decimal))
        }
        seconds = p.durationMs.get("triggerExecution", 0) / 1000.0
        with self._lock:
            self._rows.append((p.numInputRows, seconds, str(p.id), p.batchId, time.time_ns(), observed))
            full = len(self._rows) >= self._flush_every
        if full:
            self.flush()

    def flush(self) -> None:
        """Write the rows collected so far; they stay if the write fails."""
        with self._lock:
            rows = list(self._rows)
            if rows:
                self._spark.createDataFrame(rows, _PROGRESS).coalesce(1).write.mode("append").parquet(self._path)
                del self._rows[: len(rows)]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()


def progress_frame(spark: SparkSession, path: str) -> DataFrame:
    """Records, seconds, records per second (0 if no time passed) and observed metrics of every batch that ``ProgressLog`` has seen."""
    rows = spark.read.schema(_PROGRESS).parquet(path)
    newest = F.max_by(F.struct("records", "seconds", "observed"), "logged").alias("row")
    rows = rows.groupBy("query_id", "batch_id").agg(newest).select("row.records", "row.seconds", "query_id", "batch_id", "row.observed")
    per_second = F.when(F.col("seconds") > 0, F.col("records") / F.col("seconds")).otherwise(F.lit(0.0))
    return rows.withColumn("records_per_second", per_second)


def observe_quality(df: DataFrame, columns: Sequence[str], amount: str = "total_amount", name: str = "quality") -> DataFrame:
    """The stream with metrics of every batch that need no second pass: rows, nulls of ``columns`` and the sum of ``amount``."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *nulls, money_sum(amount).cast("double").alias("revenue"))
