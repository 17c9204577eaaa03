"""Plans and results under skew: hot users, hot campaigns, large dimensions."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyriver.operators import enrichment as J
from tallyriver.operators import events as E
from tallyriver.operators import metrics as M
from tallyriver.operators import summary as U
from tallyriver.plans import fixtures as X
from tallyriver.sources import tables as R

START = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the events belongs to one user and campaign, a third to none."""
    rows = []
    for i in range(3000):
        user = 1 if i % 3 == 0 else None if i % 3 == 1 else i % 50
        campaign = "HOT" if i % 3 == 0 else None if i % 3 == 1 else f"C{i % 7}"
        kind = "purchase" if i % 5 == 0 else "click"
        rows.append((i, START + timedelta(seconds=i % 600), user, kind, campaign, None, 1, i / 4 if kind == "purchase" else None))
    schema = "event_id bigint, timestamp timestamp, user_id int, event_type string, campaign_id string, session_id string, units int, total_amount double"
    return spark.createDataFrame(rows, schema).persist()


@pytest.fixture(scope="module")
def users(spark):
    rows = [(i, 20 + i % 40, "Male", "S", ["US", "DE", None][i % 3], date(2023, 1, 1), "x") for i in range(40)]
    schema = "id int, age int, gender string, state string, country string, registration_date date, income_bracket string"
    frame = spark.createDataFrame(rows, schema).persist()
    frame.count()  # gives the optimizer its size
    return frame


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def same(a, b):
    columns = a.columns
    return a.exceptAll(b.select(*columns)).isEmpty() and b.select(*columns).exceptAll(a).isEmpty()


def test_large_dimension_is_joined_by_shuffle(spark, skewed, users, no_broadcast):
    small = J.enrich(skewed, users)
    large = J.enrich(skewed, users, broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" in plan(large)
    assert large.count() == skewed.count() and same(small, large)
    salted = J.enrich(skewed, users, salts=5)
    assert "__salt" in plan(salted) and same(small, salted)


def test_beyond_the_limit_the_join_shuffles_once(spark, users, skewed, no_broadcast):
    """Adaptive execution may split the side that holds the events."""
    joined = J.enrich(skewed, users, broadcast_bytes=0)
    assert "LeftOuter" in plan(joined) and plan(joined).count("SortMergeJoin") == 1


def test_distinct_users_spread_a_hot_window(skewed):
    """The first exchange hashes by user as well, so no task gets a whole hot window."""
    text = plan(M.minute_metrics(skewed, "1 day"))
    assert text.count("Exchange hashpartitioning") == 2
    inner = text[text.rindex("Exchange hashpartitioning") :]
    assert "user_id" in inner.split("ENSURE")[0]


def test_bucketed_partials_equal_exact(skewed):
    assert same(M.minute_metrics(skewed, "5 minutes"), M.merge_minute_partials(M.minute_partials(skewed, "5 minutes", 7)))


def test_campaign_analytics_against_plain_python(skewed, users):
    rows = J.enrich(skewed, users).collect()
    groups = {}
    for r in rows:
        start = r.timestamp - timedelta(minutes=r.timestamp.minute % 5, seconds=r.timestamp.second)
        groups.setdefault((start, r.campaign_id, r.country), []).append(r)
    got = {(r.window_start, r.campaign_id, r.country): r for r in M.campaign_analytics(J.enrich(skewed, users)).collect()}
    assert set(got) == set(groups)
    for key, members in groups.items():
        clicks = sum(r.event_type == "click" for r in members)
        purchases = sum(r.event_type == "purchase" for r in members)
        people = len({r.user_id for r in members if r.user_id is not None})
        cents = [round(r.total_amount * 100 + 1e-9) for r in members if r.total_amount is not None]
        row = got[key]
        assert (row.total_events, row.clicks, row.purchases, row.unique_users) == (len(members), clicks, purchases, people)
        assert row.conversion_rate == (purchases / clicks if clicks else 0)
        assert (row.revenue is None) == (not cents)
        if not people:
            assert row.revenue_per_user == 0


def test_hot_campaign_joins_without_moving_the_facts(spark, skewed):
    campaigns = spark.createDataFrame([("HOT", "a"), ("NONE", "b")], "id string, name string")
    joined = J.campaign_join(campaigns, skewed.select("campaign_id", "event_id"))
    assert joined.count() == 1001 and "BroadcastHashJoin" in plan(joined)


def test_summary_aggregates_before_joining(spark, skewed, users):
    shaped = E.with_business_metrics(J.enrich(skewed, users))
    campaigns = X.campaigns(spark)
    out = U.campaign_summary(campaigns, M.hourly_rollup(shaped))
    assert out.count() == 6 and out.filter("total_events <> 0").isEmpty()


def test_scans_read_only_what_is_needed(spark, tmp_path, skewed):
    skewed.write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    text = plan(M.minute_metrics(events))
    assert "ReadSchema: struct<timestamp:timestamp,user_id:int,event_type:string,total_amount:double>" in text
    kept = plan(E.retain(events, "timestamp", 7, X.AS_OF).select("event_id"))
    assert "GreaterThanOrEqual(timestamp," in kept and "ReadSchema: struct<event_id:bigint,timestamp:timestamp>" in kept
    assert "IsNotNull(event_type)" in plan(events.filter("event_type is not null"))
    assert "GreaterThan(timestamp," in plan(R.read_since(events, "timestamp", "2024-01-01 00:05:00"))


def test_latest_events_keep_n_rows_per_task(skewed):
    from tallyriver.sources.events import latest_events

    assert "TakeOrderedAndProject" in plan(latest_events(skewed, 10, ("timestamp", "event_id")))


def test_bitmaps_equal_sets(spark, skewed):
    """Ids of either sign, beyond one bucket, and null ones."""
    far = skewed.withColumn("user_id", F.when(F.col("user_id") % 4 == 0, -F.col("user_id") * 40_000).otherwise(F.col("user_id").cast("bigint")))
    for frame in (skewed, far):
        exact = M.minute_metrics(frame, "5 minutes")
        for bitmaps in (True, False, None):
            assert same(exact, M.merge_minute_partials(M.minute_partials(frame, "5 minutes", 7, bitmaps=bitmaps)))
    text = skewed.withColumn("user_id", F.concat(F.lit("u"), F.col("user_id")))
    assert same(M.minute_metrics(text, "5 minutes"), M.merge_minute_partials(M.minute_partials(text, "5 minutes", 7)))


def test_state_of_a_window_is_bounded_by_ids(spark):
    """100,000 users of one window are four bitmaps."""
    events = spark.range(100_000).selectExpr(
        "cast(id as int) as user_id", "timestamp'2024-01-01' as timestamp", "'click' as event_type", "1.0D as total_amount"
    )
    partials = M.minute_partials(events)
    assert partials.count() <= 5 and "collect_set" not in plan(partials)
    assert M.merge_minute_partials(partials).first().unique_users == 100_000


def test_sliding_windows_come_from_panes(spark, skewed):
    text = plan(M.minute_metrics(skewed, "60 seconds", "10 seconds"))
    # what is repeated are rows of the panes, after they have been dealt out
    assert "REPARTITION_BY_COL" in text[text.index("Generate explode") :] and "Expand" not in text
    for window, slide in (("60 seconds", "10 seconds"), ("1 minute", "20 seconds"), ("1 hour", "15 minutes"), ("10 seconds", "10 seconds")):
        frame = F.window("timestamp", window, slide)
        wanted = skewed.groupBy(frame.alias("w"), "event_type").agg(
            F.count(F.lit(1)).alias("event_count"), F.count_distinct("user_id").alias("unique_users"), F.sum("total_amount").alias("total_revenue")
        ).select("w.start", "w.end", "event_type", "event_count", "unique_users", F.round("total_revenue", 2))
        got = M.minute_metrics(skewed, window, slide).select(
            "window_start", "window_end", "event_type", "event_count", "unique_users", F.round("total_revenue", 2)
        )
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, wanted.collect())))


def test_windows_that_are_no_whole_number_of_slides(skewed):
    assert "__pane" not in plan(M.minute_metrics(skewed, "25 seconds", "10 seconds"))
    assert M.minute_metrics(skewed, "25 seconds", "10 seconds").count() > 0


def test_quartiles_of_distinct_values_only(spark):
    """No task of the ranking stage gets more than its range."""
    import random

    import numpy as np

    from tallyriver.operators import dimension as D

    rng = random.Random(3)
    values = [rng.random() * 1000 - 500 for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 7, "v double").repartition(8)
    found = {r["key"]: r["value"] for r in D.profile(df, ["v"], []).collect()}
    assert found["count"] == 20_000
    for key, share in (("25%", 25), ("50%", 50), ("75%", 75)):
        assert abs(found[key] - np.percentile(values, share)) < 1e-9
    parts = D._counted_values(df.repartition(4), "v")
    assert parts.agg(F.max(F.col("below") + F.col("n"))).first()[0] == 20_000
    shares = [0, 0.1, 0.999, 1]
    assert np.allclose(D.exact_quantiles(df, "v", shares), np.quantile(values, shares))
    assert D.exact_quantiles(df.filter("v is null"), "v", [0.5]) == [None]
    ties = spark.createDataFrame([(float(i % 3),) for i in range(100)], "v double")
    assert D.exact_quantiles(ties, "v", [0.2, 0.5, 0.9]) == list(np.quantile([i % 3 for i in range(100)], [0.2, 0.5, 0.9]))


def test_ranking_is_spread_by_range(spark):
    from tallyriver.operators import dimension as D

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        values = D._counted_values(spark.range(10_000).selectExpr("cast(id as double) as v").repartition(8), "v")
        text = values._jdf.queryExecution().optimizedPlan().toString()
        assert "windowspecdefinition(part#" in text
        folder = values.inputFiles()
        assert len(folder) >= 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sliding_windows_repeat_no_users(spark, skewed):
    """What is repeated for the windows are panes of all users, and a user of several panes counts once."""
    text = plan(M.minute_metrics(skewed, "60 seconds", "10 seconds"))
    assert "user_id" not in text[: text.index("Generate explode")]
    times = [0, 1, 10, 55, 60, 200]
    rows = [(i, START + timedelta(seconds=t), user, "click", 1.0) for i, (t, user) in enumerate((t, u) for t in times for u in (7, None))]
    few = spark.createDataFrame(rows, "event_id bigint, timestamp timestamp, user_id int, event_type string, total_amount double")
    got = {r.window_start: (r.event_count, r.unique_users) for r in M.minute_metrics(few, "60 seconds", "10 seconds").collect()}
    starts = [START + timedelta(seconds=s) for s in range(-50, 201, 10)]
    inside = {s: sum(s <= START + timedelta(seconds=t) < s + timedelta(seconds=60) for t in times) for s in starts}
    assert got == {s: (2 * n, 1) for s, n in inside.items() if n}
