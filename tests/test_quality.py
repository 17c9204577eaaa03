"""Checks and gates."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyriver.functions.columns import campaign_type
from tallyriver.operators import dimension as D
from tallyriver.operators import quality as Q
from tallyriver.operators.metrics import aggregate
from tallyriver.schemas import CAMPAIGN_TYPES, PRODUCT_STATUSES, PRODUCTS_SCHEMA

USER = "id int, age int, gender string, state string, country string"
GOOD = [(1, 30, "Male", "CA", "US"), (2, 120, "Female", None, "US"), (3, 1, "Other", "x", "DE")]


def verdict(spark, rows, schema=USER):
    return Q.validate_demographics(spark.createDataFrame(rows, schema)).first()


def test_valid_with_nulls_reported(spark):
    v = verdict(spark, GOOD)
    assert v.is_valid and v.null_values == 1 and v.invalid_ages == 0 and v.duplicate_ids == 0


@pytest.mark.parametrize("age", [0, 121, None])
def test_bad_age(spark, age):
    v = verdict(spark, [*GOOD, (4, age, "Male", "x", "US")])
    assert not v.is_valid and v.invalid_ages == 1


def test_duplicate_id(spark):
    v = verdict(spark, [*GOOD, GOOD[0], GOOD[0]])
    assert not v.is_valid and v.duplicate_ids == 2
    bad = Q.invalid_rows(spark.createDataFrame([*GOOD, GOOD[0], GOOD[0]], USER))
    assert [r.id for r in bad.collect()] == [1, 1, 1]


def test_missing_column(spark):
    v = verdict(spark, [(1, 30)], "id int, age int")
    assert not v.is_valid and v.missing_columns == ["gender", "state", "country"]


def test_empty_table_is_valid(spark):
    assert verdict(spark, []).is_valid


def test_null_counts(spark):
    rows = Q.null_counts(spark.createDataFrame(GOOD, USER), ["state", "nothing"]).collect()
    assert [(r["column"], r.null_count, r.total_count) for r in rows] == [("state", 1, 3)]
    assert Q.null_counts(spark.createDataFrame([], USER), ["state"]).first().total_count == 0
    assert Q.null_counts(spark.createDataFrame(GOOD, USER), ["nothing"]).count() == 0


def test_freshness(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1),), (None,)], "t timestamp")
    fresh = Q.freshness(rows, "t", 10, "2024-01-01 00:10:00").first()
    assert fresh.is_fresh and fresh.age_minutes == 10
    assert not Q.freshness(rows, "t", 9.9, "2024-01-01 00:10:00").first().is_fresh
    empty = Q.freshness(rows.limit(0), "t", 10).first()
    assert not empty.is_fresh and empty.age_minutes is None


def test_quality_gate(spark):
    rows = spark.createDataFrame([(*r, None) for r in GOOD], USER + ", registration_date date")
    stats = D.load_statistics(rows)
    checks = Q.quality_gate(stats)
    assert {r["check"]: r.passed for r in checks.collect()} == {
        "minimum_records": False, "minimum_countries": False, "reasonable_avg_age": True,
    }
    with pytest.raises(Q.QualityError, match="minimum_countries"):
        Q.require_quality(checks)


def test_statistics_of_an_empty_table(spark):
    stats = D.load_statistics(spark.createDataFrame([], USER + ", registration_date date")).first()
    assert (stats.total_users, stats.avg_age, stats.earliest_registration) == (0, 0.0, None)


def test_share_gate(spark):
    events = spark.createDataFrame([("click",)] * 8 + [("purchase",)] * 2, "event_type string")
    assert all(r.passed for r in Q.share_gate(events).collect())
    only = spark.createDataFrame([("click",)] * 8, "event_type string")
    assert {r.event_type: (r.share, r.passed) for r in Q.share_gate(only).collect()} == {
        "click": (1.0, False), "purchase": (0.0, False),
    }


def test_required_fields(spark):
    events = spark.createDataFrame(
        [("click", 1, None, 0.0), ("purchase", None, "c", 0.0), ("view", None, None, None)],
        "event_type string, user_id int, campaign_id string, total_amount double",
    )
    got = {(r.event_type, r.rule): r.violations for r in Q.required_fields(events).collect()}
    assert got[("click", "campaign_id present")] == 1 and got[("click", "user_id present")] == 0
    assert got[("purchase", "user_id present")] == 1 and got[("purchase", "order_id present")] == 1
    assert got[("purchase", "total_amount positive")] == 1 and got[("click", "timestamp present")] == 1


def test_configurable_functions(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 3)], "k string, v int")
    out = aggregate(rows, ["k"], ["v"], ["count", "sum", "avg", "min", "max"]).first()
    assert tuple(out) == ("a", 2, 4, 2.0, 1, 3)
    with pytest.raises(ValueError):
        aggregate(rows, ["k"], ["v"], ["median"])


def test_profile_forms(spark):
    rows = spark.createDataFrame([(i, "x" if i % 2 else None) for i in range(1, 102)], "v int, g string")
    exact = {(r["column"], r.key): r.value for r in D.profile(rows, ["v"], ["g"]).collect()}
    assert exact[("v", "50%")] == 51 and exact[("v", "mean")] == 51 and exact[("g", None)] == 50
    assert abs(exact[("v", "std")] - 29.300170647967224) < 1e-9
    rough = {r.key: r.value for r in D.profile(rows, ["v"], [], exact=False).collect()}
    assert abs(rough["50%"] - 51) <= 1 and rough["count"] == 101


def test_an_amount_beyond_money_is_a_dead_letter_and_no_failure(spark):
    from tallyriver.operators import metrics as M
    from tallyriver.sources import events as S

    rows = [("u", '{"event_type": "purchase", "total_amount": 1e30}', 1), ("u", '{"event_type": "purchase", "total_amount": 5}', 2)]
    raw = spark.createDataFrame(rows, "key string, value string, offset bigint")
    envelope = raw.selectExpr("cast(key as binary) key", "cast(value as binary) value", "'t' topic", "0 partition", "offset", "timestamp'2024-01-01' timestamp")
    good, bad = Q.split_bad(S.project_envelope(envelope))
    assert [(r.error_reason, r.offset) for r in bad.collect()] == [("unusable amount", 1)]
    assert [r.offset for r in good.collect()] == [2]
    events = spark.sql("select timestamp'2024-01-01' as timestamp, 'purchase' as event_type, 1 as user_id, x as total_amount from values (1e30D), (5D) v(x)")
    row = M.minute_metrics(events).first()
    assert (row.event_count, row.total_revenue, row.avg_amount) == (2, 5.0, 5.0)


def test_values_outside_the_enumerations(spark):
    products = spark.createDataFrame(
        [(str(i), "n", None, None, None, None, None, None, status) for i, status in enumerate([*PRODUCT_STATUSES, "sold", "Active", None])],
        PRODUCTS_SCHEMA,
    )
    assert sorted(r.status for r in Q.allowed_values(products, "status", PRODUCT_STATUSES).collect()) == ["Active", "sold"]
    campaigns = spark.createDataFrame([("SUMMER_1",), ("CYBER_2",), ("other",), (None,)], "campaign_id string")
    kinds = campaigns.select(campaign_type(F.col("campaign_id")).alias("kind"))
    assert Q.allowed_values(kinds, "kind", CAMPAIGN_TYPES).count() == 0 and kinds.distinct().count() == len(CAMPAIGN_TYPES)
