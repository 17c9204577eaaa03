"""Column expressions. All stay inside Spark's generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) and labels.
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
OLDEST_BAND = "55+"
DAY_PARTS = ((6, "night"), (12, "morning"), (18, "afternoon"))
LAST_DAY_PART = "evening"

# Countries of each region.
REGIONS = {
    "North America": ("US", "CA"),
    "Europe": ("UK", "DE", "FR"),
    "Asia": ("JP", "IN"),
    "Oceania": ("AU",),
}
OTHER_REGION = "Other"

# Event types of each category.
EVENT_CATEGORIES = {"engagement": ("click", "cart_add", "view"), "conversion": ("purchase",)}
OTHER_CATEGORY = "other"

# Words inside a campaign id and the type they stand for, in order of precedence.
CAMPAIGN_WORDS = (
    ("SUMMER", "seasonal"),
    ("WINTER", "seasonal"),
    ("BLACK", "promotional"),
    ("CYBER", "promotional"),
)
DEFAULT_CAMPAIGN_TYPE = "regular"

HIGH_VALUE_ABOVE = 100
MONEY = "decimal(18,2)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _choose(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    (first, label), *rest = cases
    chain = F.when(first, label)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain.otherwise(default)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def age_group(age: Column | str) -> Column:
    return _choose([(_col(age) < bound, label) for bound, label in AGE_BANDS], OLDEST_BAND)


def region(country: Column | str) -> Column:
    return _choose([(_col(country).isin(*codes), name) for name, codes in REGIONS.items()], OTHER_REGION)


def event_category(event_type: Column | str) -> Column:
    return _choose(
        [(_col(event_type).isin(*types), name) for name, types in EVENT_CATEGORIES.items()], OTHER_CATEGORY
    )


def time_of_day(hour: Column | str) -> Column:
    return _choose([(_col(hour) < bound, label) for bound, label in DAY_PARTS], LAST_DAY_PART)


def campaign_type(campaign_id: Column | str) -> Column:
    return _choose([(_col(campaign_id).contains(word), kind) for word, kind in CAMPAIGN_WORDS], DEFAULT_CAMPAIGN_TYPE)


def processing_delay(event_time: Column | str, processing_time: Column | str) -> Column:
    """Seconds from event to processing; 0.0 if either time cannot be read."""
    start = F.unix_micros(F.try_to_timestamp(_col(event_time).cast("string")))
    end = F.unix_micros(F.try_to_timestamp(_col(processing_time).cast("string")))
    return F.coalesce((end - start) / F.lit(1e6), F.lit(0.0))


def json_map(text: Column | str) -> Column:
    """JSON object text as map<string,string>; empty for NULL or unreadable text."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return F.coalesce(F.from_json(_col(text), "map<string,string>"), empty)


def normalise_time(value: Column | str, default: Column | None = None) -> Column:
    """ISO text (with or without zone) or timestamp as timestamp, else the default (now)."""
    fallback = F.current_timestamp() if default is None else default
    return F.coalesce(F.try_to_timestamp(_col(value).cast("string")), fallback)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, 0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def money_sum(amount: Column | str) -> Column:
    """Exact sum in cents: the order of additions cannot change the result.

    Amounts beyond the money type are left out; ``quality.tag_records`` reports such events.
    """
    return F.sum(_col(amount).try_cast(MONEY))


def share_present(names: Sequence[str]) -> Column:
    """Share of the named columns that are not null, 0..1."""
    present = reduce(lambda a, b: a + b, [flag(F.col(n).isNotNull()) for n in names])
    return present / F.lit(len(names))


def as_moment(value) -> Column:
    """A literal ``as_of`` time, or now if none is given."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")
