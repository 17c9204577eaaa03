"""Derived event columns, cleaning, and the transformation of enriched events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyriver.functions import columns as C
from tallyriver.operators.enrichment import enrich
from tallyriver.operators.sessions import HOT_ROWS, with_session_numbers

SCORED_COLUMNS = ("user_id", "timestamp", "event_type", "country")


def with_event_categories(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "event_category": C.event_category("event_type"),
            "is_conversion": C.flag(F.col("event_type") == "purchase"),
            "is_high_value": C.flag(F.col("total_amount") > C.HIGH_VALUE_ABOVE),
        }
    )


def with_time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Weekday (1 = Sunday), hour, weekend flag, part of the day and quarter."""
    return df.withColumns(
        {
            "day_of_week": F.dayofweek(ts),
            "hour_of_day": F.hour(ts),
            "is_weekend": C.flag(F.dayofweek(ts).isin(1, 7)),
            "time_of_day": C.time_of_day(F.hour(ts)),
            "quarter": F.quarter(ts),
        }
    )


def with_business_metrics(df: DataFrame) -> DataFrame:
    """Revenue and quantity of purchases (0 for other events) and the campaign type."""
    purchase = F.col("event_type") == "purchase"
    return df.withColumns(
        {
            "revenue": F.when(purchase, F.col("total_amount")).otherwise(F.lit(0.0)),
            "quantity": F.when(purchase, F.col("units")).otherwise(0),
            "campaign_type": C.campaign_type("campaign_id"),
        }
    )


def clean_events(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.dropna(subset=["user_id", ts, "event_type"])


def with_quality_flags(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    scored = [ts if c == "timestamp" else c for c in SCORED_COLUMNS]
    return df.withColumns(
        {
            "has_demographics": C.flag(F.col("country").isNotNull()),
            "data_quality_score": C.share_present(scored),
        }
    )


def transform_events(df: DataFrame, ts: str = "timestamp", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All derived columns of enriched events, then the clean ones with quality flags.

    Sessions are numbered here unless the frame already carries the numbers,
    as it must on a stream.
    """
    shaped = with_business_metrics(with_time_features(with_event_categories(df), ts))
    if "session_event_number" not in df.columns:
        shaped = with_session_numbers(shaped, ts=ts, hot_rows=hot_rows)
    return with_quality_flags(clean_events(shaped, ts), ts)


def enriched_events(
    events: DataFrame,
    demographics: DataFrame,
    ts: str = "timestamp",
    hot_rows: int | None = HOT_ROWS,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Raw events to the full enriched record.

    Sessions are numbered before the join: the join keeps every event exactly
    once, so the numbers are the same and the sort moves narrower rows.
    """
    numbered = with_session_numbers(events, ts=ts, hot_rows=hot_rows)
    return transform_events(enrich(numbered, demographics, ts, broadcast_bytes=broadcast_bytes), ts)


def with_processing_metadata(df: DataFrame, version: str = "1.0") -> DataFrame:
    return df.withColumns({"processed_at": F.current_timestamp(), "processing_version": F.lit(version)})


def with_delay(df: DataFrame, event_time: str = "timestamp", processing_time: str = "processing_time") -> DataFrame:
    return df.withColumn("processing_delay", C.processing_delay(event_time, processing_time))


def drop_late(df: DataFrame, ts: str = "timestamp", minutes: int = 5, as_of=None) -> DataFrame:
    """Only rows younger than the grace period, by the wall clock or ``as_of``."""
    return df.filter(F.col(ts) > C.as_moment(as_of) - F.make_dt_interval(mins=F.lit(minutes)))


def retain(df: DataFrame, ts: str, days: int, as_of=None) -> DataFrame:
    """Only rows within the retention time."""
    return df.filter(F.col(ts) >= C.as_moment(as_of) - F.make_dt_interval(days=F.lit(days)))


def debug_view(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.select("user_id", "event_type", "campaign_id", "country", "age_group", ts)
