"""Time-series points: building, reading, merging, text form and writing.

A point has a measurement, tags, fields and a time. Fields live in three maps
by type: ``fields`` (double), ``int_fields`` and ``text_fields``. Tags and
fields without a value are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyriver.functions.columns import as_moment
from tallyriver.storage import shared_folder

#: Sets of tags and fields whose bounds are sent to all tasks at once, of some 1 KB each.
BROADCAST_BOUNDS = 50_000

# Measurements, tags and fields of the points.
EVENT_TAGS = (
    "event_type",
    "campaign_id",
    "country",
    "gender",
    "age_group",
    "region",
    "event_category",
    "campaign_type",
)
EVENT_FIELDS = (
    "user_id",
    "total_amount",
    "units",
    "revenue",
    "hour_of_day",
    "day_of_week",
    "data_quality_score",
    "age",
    "days_since_registration",
)
EVENT_FLAGS = ("is_conversion", "is_high_value", "is_weekend")
METRIC_FIELDS = ("event_count", "unique_users", "avg_amount", "total_revenue")
CAMPAIGN_FIELDS = (
    "total_events",
    "unique_users",
    "clicks",
    "purchases",
    "revenue",
    "conversion_rate",
    "revenue_per_user",
)
BRIDGE_TAGS = ("event_type", "campaign_id", "country", "gender", "device_type")
BRIDGE_FIELDS = {
    "user_id": "bigint",
    "product_id": "string",
    "amount": "double",
    "quantity": "bigint",
    "revenue": "double",
    "session_id": "string",
}


def _map(entries: Mapping[str, Column], value_type: str) -> Column:
    if not entries:
        return F.create_map().cast(f"map<string,{value_type}>")
    pairs = [c for name, value in entries.items() for c in (F.lit(name), value.cast(value_type))]
    if value_type == "double":
        return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def _point(
    measurement: str,
    tags: Mapping[str, Column],
    fields: Mapping[str, Column],
    ints: Mapping[str, Column],
    texts: Mapping[str, Column],
    time: Column,
) -> list[Column]:
    return [
        F.lit(measurement).alias("measurement"),
        _map(tags, "string").alias("tags"),
        _map(fields, "double").alias("fields"),
        _map(ints, "bigint").alias("int_fields"),
        _map(texts, "string").alias("text_fields"),
        F.date_trunc("second", time).alias("time"),
    ]


def to_points(
    df: DataFrame,
    measurement: str,
    tags: Sequence[str],
    fields: Sequence[str],
    ts: str,
    flags: Sequence[str] = (),
    now=None,
) -> DataFrame:
    """Points from columns: numeric and boolean fields as double, ``flags`` as integer, others as text.

    Columns the frame lacks are skipped. A missing time becomes ``now``.
    """
    types = dict(df.dtypes)
    numeric = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    present = [f for f in fields if f in types]
    doubles = {f: F.col(f) for f in present if types[f].startswith(numeric)}
    texts = {f: F.col(f) for f in present if f not in doubles}
    return df.select(
        *_point(
            measurement,
            {t: F.col(t) for t in tags if t in types},
            doubles,
            {f: F.col(f) for f in flags if f in types},
            texts,
            F.coalesce(F.col(ts), as_moment(now)),
        )
    )


def event_points(df: DataFrame, ts: str = "timestamp", extra_tags: Sequence[str] = (), now=None) -> DataFrame:
    """Points of transformed events. Tag ``event_id`` too to keep events of one second apart."""
    return to_points(df, "user_events", (*EVENT_TAGS, *extra_tags), EVENT_FIELDS, ts, EVENT_FLAGS, now)


def metrics_points(df: DataFrame) -> DataFrame:
    return to_points(df, "event_metrics", ("event_type",), METRIC_FIELDS, "window_start")


def campaign_points(df: DataFrame) -> DataFrame:
    return to_points(df, "campaign_analytics", ("campaign_id", "country"), CAMPAIGN_FIELDS, "window_start")


def bridge_points(df: DataFrame, ts: str = "timestamp", now=None) -> DataFrame:
    """Points straight from raw events with a declared type per field.

    A value that does not fit its type is kept as text. Tags that are empty
    text, 0 or false are left out; columns the frame lacks are skipped.
    """
    types = dict(df.dtypes)
    tags, doubles, ints, texts = {}, {}, {}, {}
    for name in (t for t in BRIDGE_TAGS if t in types):
        text = F.col(name).cast("string")
        if types[name] == "string":
            empty = text == ""
        elif types[name] == "boolean":
            empty = ~F.col(name)
        else:
            empty = F.col(name) == 0
        tags[name] = F.when(~empty, text)
    for name, kind in BRIDGE_FIELDS.items():
        if name not in types:
            continue
        if kind == "string":
            texts[name] = F.col(name).cast("string")
            continue
        value = F.col(name).try_cast(kind)
        (ints if kind == "bigint" else doubles)[name] = value
        if types[name] == "string":
            texts[name] = F.when(value.isNull(), F.col(name))
    time = F.coalesce(F.col(ts), as_moment(now))
    return df.select(*_point("user_events", tags, doubles, ints, texts, time))


def point_struct(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Measurement, tags and fields as struct columns beside the event."""
    return df.withColumns(
        {
            "measurement": F.lit("user_events"),
            "tags": F.struct("event_type", "campaign_id", "country", "age_group", "gender"),
            "fields": F.struct("user_id", "total_amount", "units", "revenue", "is_conversion"),
            "time": F.col(ts),
        }
    )


def points_long(points: DataFrame) -> DataFrame:
    """One row per point and field: ``kind`` tells in which value column it is."""
    kinds = (("fields", "float"), ("int_fields", "int"), ("text_fields", "text"))

    def rows(column: str, kind: str) -> Column:
        return F.transform(
            F.map_entries(column),
            lambda e: F.struct(
                e["key"].alias("field"),
                F.lit(kind).alias("kind"),
                (F.lit(None) if kind == "text" else e["value"]).cast("double").alias("value"),
                (e["value"] if kind == "text" else F.lit(None)).cast("string").alias("text_value"),
            ),
        )

    cells = F.concat(*[rows(c, k) for c, k in kinds])
    return points.select("measurement", "tags", "time", F.inline(cells))


def tags_text(tags: Column | str = "tags") -> Column:
    """Tags as text sorted by name, equal for equal tags: a key for grouping and joining."""
    entries = F.transform(F.map_entries(tags), lambda e: F.concat_ws("=", _escape(e["key"]), _escape(e["value"])))
    return F.array_join(F.array_sort(entries), ",")


def merge_points(long: DataFrame, order: str) -> DataFrame:
    """Points of equal measurement, tags and time as one: later field values win.

    Takes the long form with an ``order`` column, unique within a field of a
    point.
    """
    return (
        long.groupBy("measurement", tags_text().alias("series_tags"), "time", "field")
        .agg(
            F.max_by(F.struct("tags", "kind", "value", "text_value"), order).alias("__last"),
            F.max(order).alias(order),
        )
        .select("measurement", "time", "field", "__last.*", order)
    )


def _in_range(df: DataFrame, start: str, measurement: str, as_of) -> DataFrame:
    since = as_moment(as_of) - F.expr(f"interval {start}")
    return df.filter((F.col("time") >= since) & (F.col("measurement") == measurement))


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _no_later_than(rows: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """A ``__bound`` for each key that at least ``n`` of its rows do not exceed, and few more; none for keys of few rows.

    Rows are dealt out at random into twice as many buckets as are wanted. The least values of the buckets are those of
    different rows, so ``n`` rows do not exceed the ``n``-th of them: some 1.4 ``n`` rows, and those equal to it.
    Tasks keep one row of such values for each key and ten rows wanted, and sort nothing.
    """
    taken = max(1, min(n, 10))
    groups = -(-n // taken)
    group, bucket = F.floor(F.rand(1) * groups), F.floor(F.rand(2) * 2 * taken)
    dealt = rows.select(*keys, F.col(value).alias("__value"), group.alias("__group"), bucket.alias("__bucket"))
    least = F.array(*[F.min(F.when(F.col("__bucket") == b, F.col("__value"))) for b in range(2 * taken)])
    return (
        dealt.groupBy(*keys, "__group")
        .agg(F.get(F.sort_array(F.array_compact(least)), F.lit(taken - 1)).alias("__bound"))
        .groupBy(*keys)
        .agg(F.max("__bound").alias("__bound"), F.count("__bound").alias("__groups"))
        .filter(F.col("__groups") == groups)
        .drop("__groups")
    )


def first_points(
    points: DataFrame, start: str, measurement: str, n: int, as_of, broadcast_rows: int = BROADCAST_BOUNDS
) -> DataFrame:
    """The points, with the values, that :func:`read_points` takes and few others, before their long form is made.

    A point goes if ``n`` points with its tags and its fields are earlier, as each of its values then comes after
    ``n`` others of its series. In the last second kept, a number goes if ``n`` of its field are smaller; texts and
    equal numbers stay. The points are evaluated twice, so ``as_of`` is a fixed moment, the same as for
    :func:`read_points`. Bounds and the points within them are stored in the shared folder.
    """
    if as_of is None or isinstance(as_of, Column):
        raise ValueError("as_of is a fixed moment")

    def joined(left: DataFrame, bounds: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
        return left.join(F.broadcast(bounds) if rows <= broadcast_rows else bounds.hint("merge"), [*keys], "left")

    keys = {
        "__tags": F.sort_array(F.map_entries("tags")),
        "__cells": F.array(*[F.sort_array(F.map_keys(c)) for c in ("fields", "int_fields", "text_fields")]),
    }
    within = _in_range(points, start, measurement, as_of).withColumns(keys)
    bounds = _no_later_than(within, [*keys], "time", n).withColumnRenamed("__bound", "__until")
    bounds = _stored(bounds.withColumn("__set", F.monotonically_increasing_id()), "point-bounds")
    rows = bounds.count()
    if rows == 0:
        return within.drop(*keys)
    early = joined(within, bounds, keys, rows).filter(F.col("__until").isNull() | (F.col("time") <= F.col("__until")))
    early = _stored(early.drop(*keys), "first-points")

    def numbers(column: str) -> Column:
        return F.transform(
            F.map_entries(column),
            lambda e: F.struct(F.lit(column).alias("__map"), e["key"].alias("__field"), e["value"].cast("double").alias("__value")),
        )

    last = F.col("time") == F.col("__until")
    maps = ("fields", "int_fields")
    cells = early.filter(last).select("__set", F.inline(F.concat(*[numbers(c) for c in maps])))
    bound = F.struct("__field", "__bound")
    most = _no_later_than(cells, ["__set", "__map", "__field"], "__value", n).groupBy("__set").agg(
        *[F.map_from_entries(F.collect_list(F.when(F.col("__map") == c, bound))).alias(f"__most_{c}") for c in maps]
    )
    most = _stored(most, "value-bounds")

    def kept(column: str) -> Column:
        small = F.map_filter(
            column, lambda field, v: F.coalesce(v.cast("double") <= F.col(f"__most_{column}")[field], F.lit(True))
        )
        return F.when(last, small).otherwise(F.col(column))

    return joined(early, most, ["__set"], rows).withColumns({c: kept(c) for c in maps}).select(*points.columns)


def read_points(
    long: DataFrame, start: str, measurement: str, n: int = 10, as_of=None
) -> DataFrame:
    """The first ``n`` values of every series not older than ``start`` (an interval such as "5 minutes").

    A series is a measurement, a set of tags and a field. Spark keeps only
    ``n`` rows of each series in every task before the shuffle, but sorts the
    task's rows for it: of many rows, give it the long form of
    :func:`first_points`.
    """
    series = Window.partitionBy("tags", "field").orderBy("time", "kind", "value", "text_value")
    return (
        _in_range(long, start, measurement, as_of)
        .withColumn("tags", F.sort_array(F.map_entries("tags")))
        .withColumn("__rank", F.row_number().over(series))
        .filter(F.col("__rank") <= n)
        .withColumn("tags", F.map_from_entries("tags"))
        .drop("__rank")
    )


def _one_line(text: Column) -> Column:
    """Line breaks written out, as a line break ends a point."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _escape(text: Column) -> Column:
    for sign in ("\\", ",", "=", " "):
        text = F.replace(text, F.lit(sign), F.lit("\\" + sign))
    return _one_line(text)


def point_lines(points: DataFrame) -> DataFrame:
    """Points in line text form: ``measurement,tag=v field=1.0,flag=1i,text="x" seconds``.

    Points without any field have no line; empty tags are left out, and line breaks are written out.
    """

    def quoted(value: Column) -> Column:
        for sign in ("\\", '"'):
            value = F.replace(value, F.lit(sign), F.lit("\\" + sign))
        return F.concat(F.lit('"'), _one_line(value), F.lit('"'))

    def pairs(column: str, form: Callable[[Column], Column]) -> Column:
        return F.transform(
            F.map_entries(column), lambda e: F.concat(_escape(e["key"]), F.lit("="), form(e["value"]))
        )

    parts = [
        pairs("fields", lambda v: v.cast("string")),
        pairs("int_fields", lambda v: F.concat(v.cast("string"), F.lit("i"))),
        pairs("text_fields", quoted),
    ]
    fields = F.array_join(F.concat(*parts), ",")
    named = F.map_filter("tags", lambda _, v: v != "")
    head = F.concat_ws(",", _escape(F.col("measurement")), F.nullif(tags_text(named), F.lit("")))
    line = F.concat_ws(" ", head, fields, F.unix_seconds("time").cast("string"))
    return points.filter(F.size("fields") + F.size("int_fields") + F.size("text_fields") > 0).select(
        line.alias("line")
    )


def write_points(points: DataFrame, writer_factory: Callable[[], object], batch_size: int = 1000) -> int:
    """Write points from the executors and return how many were written.

    Each task makes one writer, only if it has points, calls its
    ``write(list_of_lines)`` with at most ``batch_size`` lines at a time and
    closes it. A repeated task writes the same points again, which replaces
    them, as measurement, tags and time identify a point.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, pending, written = None, [], 0
        try:
            for batch in batches:
                pending.extend(batch["line"])
                while len(pending) >= batch_size:
                    writer = writer or writer_factory()
                    writer.write(pending[:batch_size])
                    written += batch_size
                    pending = pending[batch_size:]
            if pending:
                writer = writer or writer_factory()
                writer.write(pending)
                written += len(pending)
        finally:
            if writer is not None:
                writer.close()
        yield pd.DataFrame({"written": [written]})

    counts = point_lines(points).mapInPandas(send, "written bigint")
    return counts.agg(F.coalesce(F.sum("written"), F.lit(0)).alias("n")).first()["n"]
