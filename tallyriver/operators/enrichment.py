"""Demographics view, the enrichment join and the campaign join."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyriver.functions import columns as C
from tallyriver.storage import broadcast_if_small

DIMENSION_COLUMNS = ("age", "gender", "state", "country", "registration_date", "income_bracket", "age_group")


def with_age_group(df: DataFrame, age: str = "age") -> DataFrame:
    return df.withColumn("age_group", C.age_group(age))


def with_region(df: DataFrame, country: str = "country") -> DataFrame:
    return df.withColumn("region", C.region(country))


def with_tenure(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Days from registration to the event."""
    return df.withColumn("days_since_registration", F.date_diff(F.col(ts), F.col("registration_date")))


def demographics_grouped(df: DataFrame, as_of=None) -> DataFrame:
    """The demographics report view; days count up to ``as_of`` (today)."""
    return df.select(
        "id",
        "age",
        C.age_group("age").alias("age_group"),
        "gender",
        "state",
        "country",
        C.region("country").alias("region"),
        "registration_date",
        "income_bracket",
        "last_login",
        F.date_diff(C.as_moment(as_of), F.col("registration_date")).alias("days_since_registration"),
    )


def enrich(
    events: DataFrame,
    demographics: DataFrame,
    ts: str = "timestamp",
    user: str = "user_id",
    broadcast_bytes: int | None = None,
    salts: int = 1,
) -> DataFrame:
    """Left join events with the dimension and derive tenure and region.

    Every event stays. Ids of the dimension must be unique (see
    ``quality.require_unique``), or events would multiply.

    The dimension is broadcast only if its estimated size is within
    ``broadcast_bytes``. Beyond that the join shuffles, and adaptive execution
    splits the partitions of hot users. Streaming micro-batches have no such
    splitting: there ``salts`` > 1 spreads each user over that many tasks, at
    the price of as many copies of the dimension.
    """
    side = with_age_group(demographics).select(F.col("id").alias("__id"), *DIMENSION_COLUMNS)
    if salts > 1:
        spread = F.xxhash64(*[c for c, t in events.dtypes if not t.startswith("map")])
        events = events.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int"))
        side = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        matches = (events[user] == side["__id"]) & (events["__salt"] == side["__salt"])
        joined = events.join(side, matches, "left").drop(events["__salt"]).drop(side["__salt"])
    else:
        side = broadcast_if_small(side, broadcast_bytes)
        joined = events.join(side, events[user] == side["__id"], "left")
    return with_region(with_tenure(joined.drop("__id"), ts))


class Lookup:
    """A cached dimension that is read again once it is older than ``ttl`` seconds.

    Meant for ``foreachBatch``: call ``get`` in every micro-batch. Only its
    own cached frame is released on refresh.
    """

    def __init__(
        self,
        read: Callable[[], DataFrame],
        ttl: float,
        check: Callable[[DataFrame], None] | None = None,
        clock: Callable[[], float] = time.monotonic,
    ):
        self._read, self._ttl, self._check, self._clock = read, ttl, check, clock
        self._frame: DataFrame | None = None
        self._loads = 0
        self._loaded_at = 0.0

    def get(self) -> DataFrame:
        if self._frame is None or self._clock() - self._loaded_at >= self._ttl:
            self.refresh()
        return self._frame.drop("__load")

    def refresh(self) -> DataFrame:
        # Spark finds a cached frame by its plan; the number gives every load a plan of its own
        self._loads += 1
        fresh = self._read().withColumn("__load", F.lit(self._loads)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fresh.count()  # fills the cache, and with it the exact size for the join's choice
            if self._check is not None:
                self._check(fresh.drop("__load"))
        except Exception:
            fresh.unpersist()
            raise
        previous, self._frame = self._frame, fresh
        self._loaded_at = self._clock()
        if previous is not None:
            previous.unpersist()
        return fresh.drop("__load")


def campaign_join(campaigns: DataFrame, facts: DataFrame, key: str = "campaign_id") -> DataFrame:
    """Campaigns left join facts on id = ``key``.

    The kept side is the small one, which a left outer join cannot broadcast,
    and a hot campaign could not be split either. So the matches come from an
    inner join with the campaigns as the small side, and campaigns without
    facts are added from an anti join with the distinct keys. ``facts`` is
    evaluated twice, so pass a stored frame if it is costly.
    """
    clashes = [c for c in facts.columns if c in campaigns.columns]
    facts = facts.withColumnsRenamed({c: f"fact_{c}" for c in clashes})
    matched = facts.join(broadcast_if_small(campaigns), campaigns["id"] == facts[key], "inner")
    seen = facts.select(F.col(key).alias("id")).distinct()
    unmatched = campaigns.join(seen, "id", "left_anti")
    return matched.select(*campaigns.columns, *facts.columns).unionByName(unmatched, allowMissingColumns=True)
