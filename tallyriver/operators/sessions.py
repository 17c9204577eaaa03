"""Session numbering and session starts on bounded frames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.functions.columns import flag
from tallyriver.storage import shared_folder

HOT_ROWS = 1_000_000
#: for ``hot_rows``: number by prefix sums over ranges of the sort order
RANGES = 0
# More slices than needed on average, as events crowd at some times.
SLICES_PER_LIMIT = 16


def _tie_break(df: DataFrame, tie: Sequence[str] | None) -> list[str]:
    if tie is not None:
        return list(tie)
    if {"partition", "offset"} <= set(df.columns):
        return ["partition", "offset"]
    return ["event_id"] if "event_id" in df.columns else []


def _too_large(df: DataFrame, keys: list[str], ts: str, limit: int, name: str) -> DataFrame:
    """Groups above ``limit`` rows with the start and the width of their slices of time."""
    micros = F.unix_micros(F.col(ts))
    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(micros).alias(f"{name}_from"), F.max(micros).alias("__to")
    )
    slices = F.ceil(F.col("__rows") / F.lit(limit)) * SLICES_PER_LIMIT
    width = F.floor((F.col("__to") - F.col(f"{name}_from")) / slices) + 1
    return sizes.filter(F.col("__rows") > limit).select(*keys, f"{name}_from", width.alias(f"{name}_width"))


def _slice(ts: str, name: str) -> Column:
    """Number of a row's slice: 0 outside large groups, -1 for rows without time, which come first."""
    micros = F.unix_micros(F.col(ts))
    part = F.floor((micros - F.col(f"{name}_from")) / F.col(f"{name}_width"))
    return F.when(F.col(f"{name}_width").isNull(), 0).when(micros.isNull(), -1).otherwise(part)


def _number_in_slices(df: DataFrame, session: str, ts: str, tie: list[str], hot_rows: int) -> DataFrame:
    """Number each session's rows in time order, hot sessions in slices of time.

    A session above ``hot_rows`` is cut into slices of equal width, and a
    slice still above it, as events crowd at some times, is cut once more.
    Rows are numbered inside their slice, and the counts of the earlier
    slices are added.

    Of n rows there are fewer than n / hot_rows large sessions and as many
    large slices; adaptive execution broadcasts these lists while they are
    small. The offsets join on the keys by which the rows are already
    partitioned and sorted. Two cuts do not part a burst that fills a small
    share of a slice, and events of one moment stay together.
    """
    # NULL sessions form a group of their own, so the key is made comparable
    key = [F.coalesce(F.col(session).cast("string"), F.lit("")).alias("__key"), F.col(session).isNull().alias("__none")]
    first, both = ["__key", "__none"], ["__key", "__none", "__coarse"]
    rows = df.select("*", *key)
    hot = _too_large(rows.select(*first, ts), first, ts, hot_rows, "__a")
    coarse = rows.join(hot, first, "left").withColumn("__coarse", _slice(ts, "__a"))
    in_hot = rows.select(*first, ts).join(hot, first, "inner").withColumn("__coarse", _slice(ts, "__a"))
    crowded = _too_large(in_hot, both, ts, hot_rows, "__b")

    parts = [*both, "__fine"]
    sliced = coarse.join(crowded, both, "left").withColumn("__fine", _slice(ts, "__b"))
    counts = (
        in_hot.join(crowded, both, "left")
        .withColumn("__fine", _slice(ts, "__b"))
        .groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    earlier = Window.partitionBy(*first).orderBy("__coarse", "__fine").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*parts, F.sum("__rows").over(earlier).alias("__before")).filter(F.col("__before").isNotNull())
    inside = Window.partitionBy(*parts).orderBy(ts, *tie)
    number = F.col("__number") + F.coalesce(F.col("__before"), F.lit(0))
    # the session travels once, as the key
    back = F.when(~F.col("__none"), F.col("__key")).cast(df.schema[session].dataType).alias(session)
    return (
        sliced.select(*[c for c in df.columns if c != session], *parts)
        .withColumn("__number", F.row_number().over(inside))
        .join(offsets, parts, "left")
        .select(*[back if c == session else c for c in df.columns], number.cast("bigint").alias("session_event_number"))
    )


def _count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by session, numbered within their partition."""
    part, last, carried = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key, none = batch.column("__key"), batch.column("__none")
        opens = np.ones(n, bool)
        for column, same in ((key, True), (none, False)):
            differs = pa.compute.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            opens[1:] = differs if same else opens[1:] | differs
        first = (key[0].as_py(), none[0].as_py())
        opens[0] = first != last
        places = np.arange(n)
        begins = np.maximum.accumulate(np.where(opens, places, -carried if not opens[0] else 0))
        numbers = places - begins + 1
        last, carried = (key[n - 1].as_py(), none[n - 1].as_py()), int(numbers[-1])
        columns = [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(numbers.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "__part", "__number"])


def _number_by_ranges(df: DataFrame, session: str, ts: str, tie: list[str], partitions: int | None) -> DataFrame:
    """Number each session's rows by prefix sums over range partitions.

    Rows are dealt out by ranges of (session, time, tie-break, hash of the row), so any session, burst or moment is
    parted wherever the sampled bounds fall; only rows that are equal throughout stay together. Each partition numbers
    its rows in the sort order. Only the session at its beginning can have rows in partitions before, whose counts are
    added from a table of one row for each partition.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "numbered-sessions")
    # NULL sessions form a group of their own, so the key is made comparable
    key = [F.coalesce(F.col(session).cast("string"), F.lit("")).alias("__key"), F.col(session).isNull().alias("__none")]
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    rows = df.select("*", *key).withColumn("__hash", F.xxhash64(*hashed))
    order = ["__none", "__key", ts, *tie, "__hash"]
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(count, *order).sortWithinPartitions(*order).drop("__hash")
    schema = T.StructType([*ranged.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__number", T.LongType())])
    # written, as bounds are sampled anew by every evaluation
    ranged.mapInArrow(_count_up, schema).write.parquet(path)
    numbered = spark.read.schema(schema).parquet(path)

    ends = numbered.groupBy("__part").agg(
        F.min(F.struct("__none", "__key")).alias("__first"), F.max(F.struct("__none", "__key", "__number")).alias("__last")
    )
    last = F.struct("__last.__none", "__last.__key")
    so_far = Window.partitionBy("__last.__none", "__last.__key").orderBy("__part")
    ends = ends.withColumn("__sum", F.sum("__last.__number").over(so_far)).withColumn("__session", last)
    # one row for each partition
    before = Window.orderBy("__part")
    goes_on = F.lag("__session").over(before) == F.col("__first")
    carry = ends.select("__part", "__first", F.when(goes_on, F.lag("__sum").over(before)).alias("__before"))
    carry = carry.filter(F.col("__before").isNotNull())
    leads = F.struct("__none", "__key") == F.col("__first")
    number = F.col("__number") + F.coalesce(F.when(leads, F.col("__before")), F.lit(0))
    joined = numbered.join(F.broadcast(carry), "__part", "left")
    return joined.select(*df.columns, number.cast("bigint").alias("session_event_number"))


def with_session_numbers(
    df: DataFrame,
    session: str = "session_id",
    ts: str = "timestamp",
    tie: Sequence[str] | None = None,
    null_session: str = "skip",
    hot_rows: int | None = RANGES,
    partitions: int | None = None,
) -> DataFrame:
    """Running event number of each session in time order, and the start flag.

    Ties in time are broken by ``tie``: broker partition and offset, or the
    event id, if the frame has them. Events without a session get no number
    and no start flag and stay out of the shuffle; ``null_session="group"``
    numbers them together as one session instead.

    By default rows are numbered by prefix sums over ``partitions`` ranges (``spark.sql.shuffle.partitions`` of them if
    not given) of the sort order, so no session, burst or moment is too large for a task. The numbered rows are written
    to a shared folder when this is called. ``hot_rows=None`` numbers with one window for each session, for sessions
    known to be small. With a number, sessions larger than that are cut into slices of time, twice where events crowd.
    """
    if df.isStreaming:
        raise ValueError("use streaming.sessions.session_writer on a stream")
    if null_session not in ("skip", "group"):
        raise ValueError("null_session is 'skip' or 'group'")
    order = _tie_break(df, tie)
    keyed = df if null_session == "group" else df.filter(F.col(session).isNotNull())
    if hot_rows is None:
        window = Window.partitionBy(session).orderBy(ts, *order)
        numbered = keyed.withColumn("session_event_number", F.row_number().over(window).cast("bigint"))
    elif hot_rows == RANGES:
        numbered = _number_by_ranges(keyed, session, ts, order, partitions)
    else:
        numbered = _number_in_slices(keyed, session, ts, order, hot_rows)
    if null_session == "skip":
        loose = df.filter(F.col(session).isNull())
        numbered = numbered.unionByName(
            loose.withColumn("session_event_number", F.lit(None).cast("bigint"))
        )
    return numbered.withColumn("is_session_start", flag(F.col("session_event_number") == 1))


def session_starts(
    df: DataFrame,
    session: str = "session_id",
    ts: str = "timestamp",
    tie: Sequence[str] | None = None,
) -> DataFrame:
    """The first event of each session.

    A minimum per session, which combines before the shuffle, so hot sessions
    need no special care.
    """
    order = _tie_break(df, tie)
    keyed = df.filter(F.col(session).isNotNull())
    key = F.struct(ts, *order)
    first = keyed.groupBy(session).agg(F.min_by(F.struct(*df.columns), key).alias("__first"))
    return first.select("__first.*")
