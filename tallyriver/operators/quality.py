"""Data quality: counts, checks, gates and the split of undecodable records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.functions import columns as C
from tallyriver.operators.metrics import type_shares
from tallyriver.schemas import DEMOGRAPHICS_REQUIRED, EVENT_SCHEMA
from tallyriver.sources.events import ENVELOPE_COLUMNS

# Bounds of the checks.
AGE_BOUNDS = (1, 120)
MIN_USERS = 1000
MIN_COUNTRIES = 5
AVERAGE_AGE_BOUNDS = (18, 65)
SHARE_BOUNDS = {"click": (0.7, 0.9), "purchase": (0.1, 0.3)}
REQUIRED_BY_TYPE = {
    "click": ("event_type", "user_id", "campaign_id", "timestamp"),
    "purchase": ("event_type", "user_id", "campaign_id", "order_id", "total_amount", "timestamp"),
}


class QualityError(ValueError):
    """A quality gate did not pass."""


def _unpivot(df: DataFrame, measures: Mapping[tuple[str, ...], Column], names: Sequence[str], value: str) -> DataFrame:
    """One aggregation over ``df``, its results as rows labelled by the measures' keys."""
    cells = [
        F.struct(*[F.lit(part).alias(name) for part, name in zip(key, names)], measure.alias(value))
        for key, measure in measures.items()
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls and rows per listed column, in one pass; absent columns are skipped."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, null_count bigint, total_count bigint")
    cells = {
        (c,): F.struct(F.count_if(F.col(c).isNull()).alias("null_count"), F.count(F.lit(1)).alias("total_count"))
        for c in present
    }
    return _unpivot(df, cells, ("column",), "counts").select("column", "counts.*")


def schema_check(df: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> dict:
    """Missing and extra column names; valid if none is missing. Runs no job."""
    expected, actual = set(schema.names), set(df.columns)
    missing = sorted(expected - actual)
    return {"is_valid": not missing, "missing_columns": missing, "extra_columns": sorted(actual - expected)}


def freshness(df: DataFrame, ts: str = "timestamp", max_age: float = 10, as_of=None) -> DataFrame:
    """Newest time, its age in minutes, and whether that is within ``max_age``."""
    latest = F.col("latest_timestamp")
    age = (F.unix_micros(C.as_moment(as_of)) - F.unix_micros(latest)) / F.lit(60e6)
    return (
        df.agg(F.max(ts).alias("latest_timestamp"))
        .withColumn("age_minutes", age)
        .withColumn("is_fresh", F.coalesce(F.col("age_minutes") <= max_age, F.lit(False)))
    )


def allowed_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is outside an enumeration (NULL is allowed)."""
    return df.filter(~F.col(column).isin(*values))


def _bad_age() -> Column:
    return ~F.coalesce(F.col("age").between(*AGE_BOUNDS), F.lit(False))


def _duplicate_ids(df: DataFrame) -> DataFrame:
    return df.groupBy("id").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def validate_demographics(df: DataFrame) -> DataFrame:
    """One row: missing columns, nulls in required ones, bad ages, repeated rows, and the verdict.

    Nulls are only reported, but for the id; a bad or missing age, a missing or
    repeated id or a missing column makes the table invalid.
    """
    missing = [c for c in DEMOGRAPHICS_REQUIRED if c not in df.columns]
    if missing:
        return df.sparkSession.range(1).select(
            F.array(*[F.lit(c) for c in missing]).alias("missing_columns"),
            F.lit(None).cast("bigint").alias("null_values"),
            F.lit(None).cast("bigint").alias("invalid_ages"),
            F.lit(None).cast("bigint").alias("duplicate_ids"),
            F.lit(False).alias("is_valid"),
        )
    nulls = [F.count_if(F.col(c).isNull()) for c in DEMOGRAPHICS_REQUIRED]
    # grouping by id first counts repetitions and checks the rows in a single pass
    per_id = df.groupBy("id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(_bad_age()).alias("bad_ages"),
        sum(nulls[1:], nulls[0]).alias("nulls"),
    )
    return per_id.agg(
        F.lit([]).cast("array<string>").alias("missing_columns"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_values"),
        F.coalesce(F.sum("bad_ages"), F.lit(0)).alias("invalid_ages"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_ids"),
        F.count_if(F.col("id").isNull()).alias("__no_id"),
    ).withColumn("is_valid", (F.col("invalid_ages") == 0) & (F.col("duplicate_ids") == 0) & (F.col("__no_id") == 0)).drop("__no_id")


def invalid_rows(df: DataFrame) -> DataFrame:
    """The offending rows with their reason: ``age`` or ``duplicate_id``."""
    ages = df.filter(_bad_age()).withColumn("reason", F.lit("age"))
    wanted = _duplicate_ids(df).select(F.col("id").alias("__id"))
    copies = df.join(wanted, df["id"].eqNullSafe(wanted["__id"]), "left_semi")
    return ages.unionByName(copies.withColumn("reason", F.lit("duplicate_id")))


def require_unique(df: DataFrame, key: str = "id") -> None:
    """Raise if a key occurs twice, as joining such a dimension would multiply events."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    example = repeated.limit(1).collect()
    if example:
        raise QualityError(f"{key} is not unique, for example {example[0][key]!r}")


def quality_gate(
    stats: DataFrame,
    min_users: int = MIN_USERS,
    min_countries: int = MIN_COUNTRIES,
    age_bounds: tuple[float, float] = AVERAGE_AGE_BOUNDS,
) -> DataFrame:
    """The load checks on a row of load statistics: one row per check."""
    checks = {
        "minimum_records": F.col("total_users") >= min_users,
        "minimum_countries": F.col("countries") >= min_countries,
        "reasonable_avg_age": F.col("avg_age").between(*age_bounds),
    }
    cells = [F.struct(F.lit(n).alias("check"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in checks.items()]
    return stats.select(F.inline(F.array(*cells)))


def require_quality(checks: DataFrame) -> None:
    """Raise with the names of the checks that failed."""
    failed = [r["check"] for r in checks.filter(~F.col("passed")).select("check").collect()]
    if failed:
        raise QualityError(f"quality checks failed: {sorted(failed)}")


def share_gate(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = SHARE_BOUNDS) -> DataFrame:
    """Share of each bounded event type and whether it lies within its bounds (0 if absent)."""
    shares = type_shares(df)
    cells = []
    for name, (low, high) in bounds.items():
        share = F.coalesce(F.max(F.when(F.col("event_type") == name, F.col("share"))), F.lit(0.0))
        cells.append(
            F.struct(F.lit(name).alias("event_type"), share.alias("share"), share.between(low, high).alias("passed"))
        )
    return shares.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def required_fields(df: DataFrame, rules: Mapping[str, Sequence[str]] = REQUIRED_BY_TYPE) -> DataFrame:
    """Violations per event type and rule, in one pass.

    A field rule counts nulls (all events, if the column is absent); purchases
    must also have an amount above 0.
    """
    measures: dict[tuple[str, ...], Column] = {}
    for event_type, names in rules.items():
        of_type = F.col("event_type") == event_type
        for name in names:
            absent = F.col(name).isNull() if name in df.columns else F.lit(True)
            measures[(event_type, f"{name} present")] = F.count_if(of_type & absent)
    if "purchase" in rules and "total_amount" in df.columns:
        low = (F.col("event_type") == "purchase") & (F.col("total_amount") <= 0)
        measures[("purchase", "total_amount positive")] = F.count_if(low)
    return _unpivot(df, measures, ("event_type", "rule"), "violations")


def tag_records(envelope: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Decoded records beside their raw value, with the reason if they are unusable.

    Takes the projected envelope. A record is unusable if it has no value, is
    not a JSON object, has no event type, or an amount that is no amount of money.
    """
    keep = [c for c in ENVELOPE_COLUMNS if c in envelope.columns]
    decoded = envelope.select(
        "key", F.col("value").alias("raw_value"), F.inline(F.array(F.from_json("value", schema))), *keep
    )
    odd_amount = F.lit(False)
    if "total_amount" in schema.names:
        odd_amount = F.col("total_amount").isNotNull() & F.col("total_amount").try_cast(C.MONEY).isNull()
    reason = (
        F.when(F.col("event_type").isNotNull() & odd_amount, "unusable amount")
        .when(F.col("event_type").isNotNull(), F.lit(None))
        .when(F.col("raw_value").isNull(), "missing value")
        .when(F.json_object_keys("raw_value").isNull(), "malformed json")
        .otherwise("missing event_type")
    )
    return decoded.withColumn("error_reason", reason)


def good_records(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("error_reason").isNull()).drop("error_reason", "raw_value")


def bad_records(tagged: DataFrame) -> DataFrame:
    keep = [c for c in ENVELOPE_COLUMNS if c in tagged.columns]
    return tagged.filter(F.col("error_reason").isNotNull()).select("error_reason", "key", "raw_value", *keep)


def split_bad(envelope: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(good, bad): decoded events, and unusable records with reason and raw value."""
    tagged = tag_records(envelope, schema)
    return good_records(tagged), bad_records(tagged)


def error_summary(bad: DataFrame) -> DataFrame:
    return bad.groupBy("error_reason").agg(F.count(F.lit(1)).alias("error_count"))

