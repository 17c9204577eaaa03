"""Windowed metrics with exact or approximate distinct users, and rollups.

Distinct users come in three forms:

``exact``   bounded frames use Spark's distinct aggregation, which first
            groups by (keys, user): a hot group is spread over all tasks by
            user. Streams use the same two levels, which Spark allows in
            append mode.
``approx``  a sketch of fixed size per group, for every output mode.
partials    for streams in update or complete mode that need exact numbers:
            users are split into buckets, and the disjoint bucket counts are
            added up in the sink. Whole-number ids keep a bitmap for each
            bucket of 32,768 neighbouring ids, so the state of a window is
            bounded by the largest id over 8 bytes; other ids are hashed into
            buckets with a set each.

Sliding windows of bounded frames are put together from panes of one slide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.functions import columns as C

MINUTE_KEYS = ("event_type",)
CAMPAIGN_KEYS = ("campaign_id", "country")
USER_BUCKETS = 64
USER_SKETCH = "user_sketch"

# Additive measures: per group from rows, and again from partial groups by sum.
_EVENTS, _CLICKS, _PURCHASES, _AMOUNT, _AMOUNTS = "__events", "__clicks", "__purchases", "__amount", "__amounts"


def _additive(money: str = "total_amount") -> list[Column]:
    return [
        F.count(F.lit(1)).alias(_EVENTS),
        F.count_if(F.col("event_type") == "click").alias(_CLICKS),
        F.count_if(F.col("event_type") == "purchase").alias(_PURCHASES),
        C.money_sum(money).alias(_AMOUNT),
        F.count(F.col(money).try_cast(C.MONEY)).alias(_AMOUNTS),
    ]


def _combined() -> list[Column]:
    return [F.sum(c).alias(c) for c in (_EVENTS, _CLICKS, _PURCHASES, _AMOUNT, _AMOUNTS)]


def _grouped(df: DataFrame, keys: Sequence[str], ts: str, window: str, slide: str | None, distinct: str, rsd: float):
    frame = F.window(ts, window, slide) if slide else F.window(ts, window)
    if distinct == "approx":
        users = F.approx_count_distinct("user_id", rsd).alias("unique_users")
        return df.groupBy(frame.alias("window"), *keys).agg(*_additive(), users)
    if distinct != "exact":
        raise ValueError("distinct is 'exact' or 'approx'")
    if df.isStreaming:
        per_user = df.groupBy(frame.alias("window"), *keys, "user_id").agg(*_additive())
        return per_user.groupBy("window", *keys).agg(*_combined(), F.count("user_id").alias("unique_users"))
    if slide and _panes_fit(df, window, slide):
        return _from_panes(df, keys, ts, window, slide)
    users = F.count_distinct("user_id").alias("unique_users")
    return df.groupBy(frame.alias("window"), *keys).agg(*_additive(), users)


def _microseconds(df: DataFrame, interval: str) -> int | None:
    """The length of a fixed interval; None for one of months or years."""
    text = interval if interval.lower().lstrip().startswith("interval") else f"interval {interval}"
    kind = df.sparkSession.sql(f"select {text} as i").schema["i"].dataType
    if not isinstance(kind, T.DayTimeIntervalType):
        return None
    # a literal: nothing of the data is read
    length = df.sparkSession.sql(f"select {text} as i").first()["i"]
    return (length.days * 86_400 + length.seconds) * 1_000_000 + length.microseconds


def _panes_fit(df: DataFrame, window: str, slide: str) -> bool:
    whole, step = _microseconds(df, window), _microseconds(df, slide)
    return bool(whole and step) and whole % step == 0


def _from_panes(df: DataFrame, keys: Sequence[str], ts: str, window: str, slide: str) -> DataFrame:
    """Sliding windows from panes of one slide.

    Events are aggregated once for each pane and user, which combines before the shuffle. A user is counted in the
    windows of a pane that the user's pane before does not lie in; so no row of a user is repeated, only those of the
    panes of all users, and no task keeps a table of windows and users.
    """
    whole, step = _microseconds(df, window), _microseconds(df, slide)
    panes = df.groupBy(F.window(ts, slide)["start"].alias("__pane"), *keys, "user_id").agg(*_additive())
    own = Window.partitionBy(*keys, "user_id").orderBy("__pane")
    gap = (F.unix_micros("__pane") - F.unix_micros(F.lag("__pane").over(own))) / F.lit(step)
    # of the windows that begin 0, 1, ... slides before the pane, so many are the user's first
    fresh = F.when(F.col("user_id").isNull(), 0).otherwise(F.coalesce(F.least(gap, F.lit(whole // step)), F.lit(whole // step)))
    dealt = panes.repartition(*keys, "user_id").withColumn("__fresh", fresh.cast("int"))
    by_fresh = dealt.groupBy("__pane", *keys, "__fresh").agg(*_combined(), F.count(F.lit(1)).alias("__users"))
    back = F.explode(F.sequence(F.lit(0), F.lit(whole // step - 1))).alias("__back")
    spread = by_fresh.select("*", back)
    start = F.timestamp_micros(F.unix_micros("__pane") - F.col("__back") * F.lit(step).cast("bigint"))
    users = F.sum(F.when(F.col("__fresh") > F.col("__back"), F.col("__users")).otherwise(0)).alias("unique_users")
    grouped = spread.groupBy(start.alias("__start"), *keys).agg(*_combined(), users)
    end = F.timestamp_micros(F.unix_micros("__start") + F.lit(whole).cast("bigint"))
    framed = grouped.withColumn("window", F.struct(F.col("__start").alias("start"), end.alias("end")))
    return framed.drop("__start")


def _minute_columns(df: DataFrame) -> DataFrame:
    total = F.col(_AMOUNT).cast("double")
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *MINUTE_KEYS,
        F.col(_EVENTS).alias("event_count"),
        "unique_users",
        F.when(F.col(_AMOUNTS) > 0, total / F.col(_AMOUNTS)).alias("avg_amount"),
        total.alias("total_revenue"),
    )


def _campaign_columns(df: DataFrame) -> DataFrame:
    revenue = F.col(_AMOUNT).cast("double")
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *CAMPAIGN_KEYS,
        F.col(_EVENTS).alias("total_events"),
        "unique_users",
        F.col(_CLICKS).alias("clicks"),
        F.col(_PURCHASES).alias("purchases"),
        revenue.alias("revenue"),
        C.safe_ratio(F.col(_PURCHASES), F.col(_CLICKS)).alias("conversion_rate"),
        C.safe_ratio(revenue, F.col("unique_users")).alias("revenue_per_user"),
    )


def minute_metrics(
    df: DataFrame,
    window: str = "1 minute",
    slide: str | None = None,
    distinct: str = "exact",
    ts: str = "timestamp",
    rsd: float = 0.05,
) -> DataFrame:
    """Events, distinct users, average and total amount per window and event type."""
    return _minute_columns(_grouped(df, MINUTE_KEYS, ts, window, slide, distinct, rsd))


def campaign_analytics(
    df: DataFrame,
    window: str = "5 minutes",
    distinct: str = "exact",
    ts: str = "timestamp",
    rsd: float = 0.05,
) -> DataFrame:
    """Events, users, clicks, purchases, revenue and ratios per window, campaign and country.

    Takes enriched events: the country is that of the demographics.
    """
    return _campaign_columns(_grouped(df, CAMPAIGN_KEYS, ts, window, None, distinct, rsd))


def _partials(
    df: DataFrame, keys: Sequence[str], ts: str, window: str, buckets: int, slide: str | None = None, bitmaps: bool | None = None
) -> DataFrame:
    frame = F.window(ts, window, slide) if slide else F.window(ts, window)
    if bitmaps is None:
        bitmaps = isinstance(df.schema["user_id"].dataType, T.IntegralType)
    if bitmaps:
        # a null user has no bit, in any bucket
        bucket = F.coalesce(F.bitmap_bucket_number("user_id"), F.lit(1).cast("bigint"))
        users = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")))
    else:
        bucket = F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("bigint")
        users = F.size(F.collect_set("user_id")).cast("bigint")
    return df.groupBy(frame.alias("window"), *keys, bucket.alias("user_bucket")).agg(*_additive(), users.alias("unique_users"))


def _merge_partials(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partials.groupBy("window", *keys).agg(*_combined(), F.sum("unique_users").alias("unique_users"))


def minute_partials(
    df: DataFrame,
    window: str = "1 minute",
    buckets: int = USER_BUCKETS,
    ts: str = "timestamp",
    slide: str | None = None,
    bitmaps: bool | None = None,
) -> DataFrame:
    """Partial minute metrics per user bucket, for streams in update or complete mode.

    Whole-number user ids are kept as ``bitmaps`` unless that is False, which suits ids that are spread thinly over a
    wide range; then, and for other ids, ``buckets`` sets hold them.
    """
    return _partials(df, MINUTE_KEYS, ts, window, buckets, slide, bitmaps)


def merge_minute_partials(partials: DataFrame) -> DataFrame:
    """Exact minute metrics from one row per window, type and user bucket."""
    return _minute_columns(_merge_partials(partials, MINUTE_KEYS))


def campaign_partials(
    df: DataFrame,
    window: str = "5 minutes",
    buckets: int = USER_BUCKETS,
    ts: str = "timestamp",
    bitmaps: bool | None = None,
) -> DataFrame:
    return _partials(df, CAMPAIGN_KEYS, ts, window, buckets, bitmaps=bitmaps)


def merge_campaign_partials(partials: DataFrame) -> DataFrame:
    return _campaign_columns(_merge_partials(partials, CAMPAIGN_KEYS))


_FUNCTIONS = {"count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}


def aggregate(df: DataFrame, keys: Sequence[str], cols: Sequence[str], funcs: Sequence[str]) -> DataFrame:
    """The chosen functions over the chosen columns; results are named column_function."""
    unknown = [f for f in funcs if f not in _FUNCTIONS]
    if unknown:
        raise ValueError(f"unknown aggregation functions: {unknown}")
    return df.groupBy(*keys).agg(*[_FUNCTIONS[f](c).alias(f"{c}_{f}") for c in cols for f in funcs])


def type_shares(df: DataFrame) -> DataFrame:
    """Count and share of each event type; the total is one row."""
    counts = df.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
    total = F.broadcast(df.agg(F.count(F.lit(1)).alias("__total")))
    shares = counts.join(total, F.lit(True), "inner")
    return shares.withColumn("share", F.col("event_count") / F.col("__total")).drop("__total")


def hourly_rollup(df: DataFrame, ts: str = "timestamp", sketch: int | None = None) -> DataFrame:
    """Deltas of the summary table from transformed events.

    The conversion rate is that of the date, hour, campaign and country over
    all event types, as the event type is part of the key.

    With ``sketch`` (the binary logarithm of its registers, 4 to 21) every cell has a sketch of its users as
    ``user_sketch``. Sketches of cells can be united, where their distinct counts cannot be added.
    """
    keys = {
        "date": F.to_date(ts), "hour": F.hour(ts),
        **{c: F.col(c) for c in ("event_type", "campaign_id", "country")},
    }
    named = [c.alias(n) for n, c in keys.items()]
    if sketch is None:
        cells = df.groupBy(*named).agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("user_id").alias("unique_users"),
            F.coalesce(C.money_sum("revenue"), F.lit(0)).cast("decimal(18,2)").alias("total_revenue"),
        )
    else:
        # one row for each user of a cell first: no partial sketch for each event or user is shuffled
        per_user = df.groupBy(*named, "user_id").agg(
            F.count(F.lit(1)).alias(_EVENTS), C.money_sum("revenue").alias(_AMOUNT)
        )
        cells = per_user.groupBy(*keys).agg(
            F.sum(_EVENTS).alias("total_events"),
            F.count("user_id").alias("unique_users"),
            F.coalesce(F.sum(_AMOUNT), F.lit(0)).cast("decimal(18,2)").alias("total_revenue"),
            F.hll_sketch_agg("user_id", sketch).alias(USER_SKETCH),
        )
    group = Window.partitionBy("date", "hour", "campaign_id", "country")

    def of_type(name: str) -> Column:
        return F.sum(F.when(F.col("event_type") == name, F.col("total_events")).otherwise(0)).over(group)

    return (
        cells.withColumns({"__clicks": of_type("click"), "__purchases": of_type("purchase")})
        .withColumns(
            {
                "avg_order_value": (F.col("total_revenue") / F.greatest("total_events", F.lit(1))).cast("decimal(18,2)"),
                "conversion_rate": F.coalesce(
                    F.when(
                        F.col("__clicks") > 0,
                        F.col("__purchases").cast("decimal(18,0)") / F.col("__clicks").cast("decimal(18,0)"),
                    ),
                    F.lit(0),
                ).cast("decimal(18,4)"),
            }
        )
        .drop("__clicks", "__purchases")
    )
