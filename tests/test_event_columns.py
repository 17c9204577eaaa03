"""Derived columns on hand-made rows, mostly their NULL rules."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyriver.functions import columns as C
from tallyriver.operators import enrichment as J
from tallyriver.operators import events as E
from tallyriver.operators import quality as Q

EVENT = "event_id bigint, timestamp timestamp, user_id int, event_type string, campaign_id string, session_id string, units int, total_amount double"
USER = "id int, age int, gender string, state string, country string, registration_date date, income_bracket string"


def values(spark, type_, items, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {type_}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v"))).collect()]


def test_age_group(spark):
    got = values(spark, "int", [24, 25, 34, 35, 44, 45, 54, 55, None], C.age_group)
    assert got == ["18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55+", "55+"]


def test_region(spark):
    got = values(spark, "string", ["US", "CA", "UK", "DE", "FR", "JP", "IN", "AU", "BR", None], C.region)
    assert got == ["North America"] * 2 + ["Europe"] * 3 + ["Asia"] * 2 + ["Oceania", "Other", "Other"]


def test_event_category(spark):
    got = values(spark, "string", ["click", "cart_add", "view", "purchase", "refund", None], C.event_category)
    assert got == ["engagement"] * 3 + ["conversion", "other", "other"]


def test_campaign_type(spark):
    ids = ["SUMMER2024", "WINTER_BLACK", "BLACKFRIDAY", "CYBER_MONDAY", "SPRING2024", "summer", None]
    got = values(spark, "string", ids, C.campaign_type)
    assert got == ["seasonal", "seasonal", "promotional", "promotional", "regular", "regular", "regular"]


def test_time_of_day(spark):
    got = values(spark, "int", [0, 5, 6, 11, 12, 17, 18, 23, None], C.time_of_day)
    assert got == ["night"] * 2 + ["morning"] * 2 + ["afternoon"] * 2 + ["evening"] * 3


def test_json_map(spark):
    got = values(spark, "string", ['{"a": 1}', "{bad", None, ""], C.json_map)
    assert got == [{"a": "1"}, {}, {}, {}]


def test_processing_delay(spark):
    rows = spark.createDataFrame(
        [("2024-01-01T00:00:00", "2024-01-01T00:00:01.5Z"), ("x", "2024-01-01T00:00:00"), (None, None)], "a string, b string"
    )
    assert [r[0] for r in rows.select(C.processing_delay("a", "b")).collect()] == [1.5, 0.0, 0.0]


def test_transform(spark):
    t = datetime(2024, 1, 6, 13, 0)  # a Saturday
    rows = [
        (1, t, 1, "purchase", "SPRING2024", None, 2, 100.0),
        (2, t, 1, "purchase", None, None, None, None),
        (3, t, 99, "click", "CYBER_MONDAY", "s", None, None),
        (4, t, None, "click", "CYBER_MONDAY", "s", None, None),
        (5, None, 1, "click", "CYBER_MONDAY", "s", None, None),
    ]
    users = spark.createDataFrame([(1, 30, "Male", "CA", "US", date(2024, 1, 1), "x")], USER)
    out = {r.event_id: r for r in E.enriched_events(spark.createDataFrame(rows, EVENT), users).collect()}
    assert set(out) == {1, 2, 3}
    first, second, third = out[1], out[2], out[3]
    assert (first.is_high_value, first.is_conversion, first.revenue, first.quantity) == (0, 1, 100.0, 2)
    assert (second.revenue, second.quantity, second.is_high_value, second.campaign_type) == (None, None, 0, "regular")
    assert (first.day_of_week, first.is_weekend, first.time_of_day, first.quarter) == (7, 1, "afternoon", 1)
    assert (first.days_since_registration, first.region, first.age_group) == (5, "North America", "25-34")
    assert (first.session_event_number, first.is_session_start) == (None, 0)
    # the number counts events that are cleaned away afterwards; the one without time came first
    assert (third.session_event_number, third.is_session_start) == (2, 0)
    assert (third.region, third.age_group, third.has_demographics) == ("Other", None, 0)
    assert (third.data_quality_score, first.data_quality_score) == (0.75, 1.0)


def test_duplicate_ids_are_refused(spark):
    users = spark.createDataFrame([(1, 30), (1, 31)], "id int, age int")
    with pytest.raises(Q.QualityError):
        J.Lookup(lambda: users, ttl=10, check=Q.require_unique).get()


def test_lookup_refreshes_after_ttl(spark):
    now, reads = [0.0], []

    def read():
        reads.append(1)
        return spark.createDataFrame([(len(reads),)], "id int")

    lookup = J.Lookup(read, ttl=10, clock=lambda: now[0])
    other = spark.range(3).cache()
    other.count()
    assert lookup.get().first()[0] == 1
    now[0] = 9.9
    assert lookup.get().first()[0] == 1
    now[0] = 10.0
    assert lookup.get().first()[0] == 2
    assert len(reads) == 2 and other.is_cached


def test_lookup_sees_a_folder_replaced_from_outside(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "users"
    folder.mkdir()

    def replace(name, ids):
        for old in folder.iterdir():
            old.unlink()
        pq.write_table(pa.table({"id": pa.array(ids, pa.int32())}), str(folder / name))

    replace("a.parquet", [1, 2])
    lookup = J.Lookup(lambda: spark.read.parquet(str(folder)), ttl=1e9, check=Q.require_unique)
    assert sorted(r.id for r in lookup.get().collect()) == [1, 2]
    replace("b.parquet", [3, 3])
    with pytest.raises(Q.QualityError):
        lookup.refresh()
    assert sorted(r.id for r in lookup.get().collect()) == [1, 2]
    replace("c.parquet", [4, 5, 6])
    lookup.refresh()
    assert sorted(r.id for r in lookup.get().collect()) == [4, 5, 6]
    assert "InMemoryTableScan" in lookup.get()._jdf.queryExecution().executedPlan().toString()


def test_drop_late_and_retain(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 0, m),) for m in (0, 5, 6)], "timestamp timestamp")
    assert E.drop_late(rows, minutes=5, as_of="2024-01-01 00:10:00").count() == 1
    assert E.retain(rows, "timestamp", 1, "2024-01-02 00:05:00").count() == 2


def test_campaign_join_keeps_campaigns_without_facts(spark):
    campaigns = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, name string")
    facts = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("z", 4)], "campaign_id string, n int")
    rows = J.campaign_join(campaigns, facts).collect()
    assert sorted((r.id, r.n or 0) for r in rows) == [("a", 1), ("a", 2), ("b", 0)]
