"""The summary table: upsert by key, and the reports on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyriver.operators.metrics import USER_SKETCH
from tallyriver.schemas import EVENT_SUMMARY_SCHEMA, SUMMARY_KEYS
from tallyriver.storage import broadcast_if_small

_VALUES = ("total_events", "unique_users", "total_revenue", "avg_order_value", "conversion_rate")


def _united(sketch: str) -> Column:
    """The union of a group's sketches (the coarsest decides); null if a row has none."""
    return F.when(F.count(sketch) == F.count(F.lit(1)), F.hll_union_agg(sketch, True))


def upsert_summary(
    target: DataFrame | None, deltas: DataFrame, order_col: str, literal: bool = False
) -> DataFrame:
    """Merge deltas into the summary by its five keys (NULL keys match each other).

    A new key takes the delta as it is. Every further delta adds events and
    revenue, keeps the larger number of users, replaces the conversion rate
    and recomputes the average order value from the new totals. Deltas of one
    key are folded in the order of ``order_col``, which must be unique there.

    ``literal=True`` adds the last delta twice in the average, as an UPDATE
    does that reads columns it has already assigned.

    Sketches of users (``hourly_rollup(sketch=...)``) are united if the deltas carry them. A key whose old row or
    one of whose deltas has none gets none, as it would count too few.

    One aggregation does it all and combines before the shuffle, so neither
    many deltas per key nor hot keys gather in one task.
    """
    sketched = [USER_SKETCH] if USER_SKETCH in deltas.columns else []
    deltas = deltas.select(*SUMMARY_KEYS, *_VALUES, *sketched, F.col(order_col).alias("__order"))
    if target is not None:
        no_order = F.lit(None).cast(deltas.schema["__order"].dataType)
        kept = [c if c in target.columns else F.lit(None).cast("binary").alias(c) for c in sketched]
        deltas = target.select(*SUMMARY_KEYS, *_VALUES, *kept, no_order.alias("__order")).unionByName(deltas)

    def last(name: str) -> Column:
        # max_by skips rows without order, so the old row counts only if it is alone
        old = F.max(F.when(F.col("__order").isNull(), F.col(name)))
        return F.when(F.count("__order") > 0, F.max_by(name, "__order")).otherwise(old)

    folded = deltas.groupBy(*SUMMARY_KEYS).agg(
        F.count(F.lit(1)).alias("__steps"),
        F.sum("total_events").alias("__events"),
        F.max("unique_users").alias("__users"),
        F.sum("total_revenue").alias("__revenue"),
        F.max("avg_order_value").alias("__only_avg"),
        last("total_events").alias("__last_events"),
        last("total_revenue").alias("__last_revenue"),
        last("conversion_rate").alias("__last_rate"),
        *[_united(c).alias(c) for c in sketched],
    )
    revenue, events = F.col("__revenue"), F.col("__events")
    if literal:
        revenue, events = revenue + F.col("__last_revenue"), events + F.col("__last_events")
    merged_avg = revenue / F.greatest(events, F.lit(1)).cast("decimal(20,0)")
    values = {
        "total_events": F.col("__events"),
        "unique_users": F.col("__users"),
        "total_revenue": F.col("__revenue"),
        "avg_order_value": F.when(F.col("__steps") > 1, merged_avg).otherwise(F.col("__only_avg")),
        "conversion_rate": F.col("__last_rate"),
    }
    typed = [values[n].cast(EVENT_SUMMARY_SCHEMA[n].dataType).alias(n) for n in _VALUES]
    return folded.select(*SUMMARY_KEYS, *typed, *sketched)


def campaign_performance(summary: DataFrame, campaign_id: str, start: str, end: str) -> DataFrame:
    """Daily totals of one campaign between two dates, both included.

    ``total_unique_users`` adds up hourly distinct users, so a user active in
    several hours counts several times. A summary with sketches also gives ``estimated_unique_users``, the distinct
    users of the day to within a few per cent (relative standard error 1.04 / sqrt(2 ** sketch)); null if a row of the
    day has no sketch.
    """
    first, last = (F.lit(d).cast("date") for d in (start, end))
    sketched = [USER_SKETCH] if USER_SKETCH in summary.columns else []
    return (
        summary.filter((F.col("campaign_id") == campaign_id) & F.col("date").between(first, last))
        .groupBy("campaign_id", F.col("date").alias("summary_date"))
        .agg(
            F.sum("total_events").alias("total_events"),
            F.sum("unique_users").alias("total_unique_users"),
            F.sum("total_revenue").alias("total_revenue"),
            F.avg("conversion_rate").alias("avg_conversion_rate"),
            *[F.hll_sketch_estimate(_united(c)).alias("estimated_unique_users") for c in sketched],
        )
        .orderBy("summary_date")
    )


def campaign_summary(campaigns: DataFrame, summary: DataFrame) -> DataFrame:
    """Totals of every campaign, 0 for those without summary rows.

    The summary is aggregated by campaign before the join, so at most one row
    per campaign id meets the campaigns (whose id is unique).
    """
    totals = summary.groupBy(F.col("campaign_id").alias("id")).agg(
        F.sum("total_events").alias("total_events"),
        F.sum("total_revenue").alias("total_revenue"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    )
    columns = ["id", "name", "type", "start_date", "end_date", "budget", "target_audience"]
    wanted = totals.join(broadcast_if_small(campaigns.select("id")), "id", "left_semi")
    joined = campaigns.select(*columns).join(wanted, "id", "left")
    zeros = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in totals.columns if c != "id"]
    return joined.select(*columns, *zeros)
