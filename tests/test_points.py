"""Points: missing values, merging, text form and distributed writing."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyriver.operators import points as TS
from tallyriver.plans import catalogue
from tallyriver.plans import fixtures as X

T0 = datetime(2024, 1, 1, 0, 0, 0, 900_000)
SCHEMA = "timestamp timestamp, event_type string, campaign_id string, total_amount double, is_conversion int, note string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_missing_values_are_left_out(spark):
    rows = frame(spark, [(T0, "click", None, None, 1, None), (None, "click", "c", float("nan"), None, "x")])
    points = TS.event_points(rows, now="2024-02-02 00:00:00").collect()
    assert points[0].tags == {"event_type": "click"} and points[0].fields == {}
    assert points[0].int_fields == {"is_conversion": 1} and points[0].time == datetime(2024, 1, 1)
    assert points[1].fields == {} and points[1].time == datetime(2024, 2, 2)


def test_custom_points_by_type(spark):
    point = TS.to_points(
        frame(spark, [(T0, "click", "c", 1.5, 1, "hello")]), "m", ["event_type"], ["total_amount", "note", "absent"], "timestamp"
    ).first()
    assert point.fields == {"total_amount": 1.5} and point.text_fields == {"note": "hello"}


def test_bridge_keeps_misfits_as_text(spark):
    rows = spark.createDataFrame(
        [(T0, "click", "", "abc", "1.5", "7"), (T0, "view", "c", "12", "x", None)],
        "timestamp timestamp, event_type string, campaign_id string, user_id string, amount string, product_id string",
    )
    first, second = TS.bridge_points(rows).collect()
    assert first.tags == {"event_type": "click"} and first.text_fields == {"user_id": "abc", "product_id": "7"}
    assert first.fields == {"amount": 1.5} and first.int_fields == {}
    assert second.int_fields == {"user_id": 12} and second.text_fields == {"amount": "x"}


def long(spark, rows):
    """(order, tags, field, value) at one time."""
    return spark.createDataFrame(
        [(n, "m", tags, T0, field, "float", value, None) for n, tags, field, value in rows],
        "n int, measurement string, tags map<string,string>, time timestamp, field string, kind string, value double, text_value string",
    )


def test_later_values_win_and_merging_is_idempotent(spark):
    rows = [
        (1, {"a": "1", "b": "2"}, "x", 1.0),
        (2, {"b": "2", "a": "1"}, "x", 2.0),
        (1, {"a": "1", "b": "2"}, "y", 9.0),
        (3, {"a": "1"}, "x", 5.0),
    ]
    merged = TS.merge_points(long(spark, rows), "n")
    got = sorted((len(r.tags), r.field, r.value) for r in merged.collect())
    assert got == [(1, "x", 5.0), (2, "x", 2.0), (2, "y", 9.0)]
    again = TS.merge_points(merged, "n")
    assert sorted((len(r.tags), r.field, r.value) for r in again.collect()) == got


def test_read_limits_every_series(spark):
    rows = [(i, {"a": "1" if i % 3 else "2"}, "x", float(i)) for i in range(90)]
    data = long(spark, rows)
    out = TS.read_points(data, "5 minutes", "m", 10, "2024-01-01 00:01:00")
    assert out.groupBy(out.tags["a"]).count().collect()[0]["count"] == 10 and out.count() == 20
    assert TS.read_points(data, "5 minutes", "m", 10, "2024-01-01 00:06:00").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def points_frame(spark, rows):
    """(tags, fields, int_fields, text_fields, time) of one measurement."""
    return spark.createDataFrame(
        [("m", *row) for row in rows],
        "measurement string, tags map<string,string>, fields map<string,double>, int_fields map<string,bigint>, "
        "text_fields map<string,string>, time timestamp",
    )


def some(rng, **choices):
    return {k: rng.choice(v) for k, v in choices.items() if rng.random() < 0.7}


def values_read(long):
    return sorted(str((sorted(r.tags.items()) if r.tags else None, r.field, r.time, r.kind, r.value, r.text_value)) for r in long.collect())


@pytest.mark.parametrize("n", [1, 3, 10, 25])
def test_first_points_lose_no_value(spark, n):
    """Sparse fields, one name in several maps, equal times and values, nulls, NaN, other times and measurements."""
    rng = random.Random(n)
    odd = [0.0, 1.5, 2.5, -7.0, float("nan"), None]
    rows = [
        (
            {"a": rng.choice("xy"), **some(rng, b="pq")} if rng.random() < 0.95 else None,
            some(rng, v=odd, w=[i / 4]) if rng.random() < 0.95 else None,
            some(rng, v=[1, 2, None], k=[i % 50, 2**60 + i]),
            some(rng, v=["s", "t", None], note=["n" + str(i % 9)]),
            T0 + timedelta(seconds=rng.choice([0, 0, 0, 1, 2, rng.randrange(400)])) if rng.random() < 0.97 else None,
        )
        for i in range(4000)
    ]
    points = points_frame(spark, rows).withColumn("measurement", F.when(F.col("time") < "2024-01-01 00:05:30", "m").otherwise("o"))
    points = points.repartition(4, "time").persist()
    as_of = "2024-01-01 00:05:00.9"
    for start, limit in (("5 minutes", TS.BROADCAST_BOUNDS), ("299 seconds", 0)):
        wanted = values_read(TS.read_points(TS.points_long(points), start, "m", n, as_of))
        first = TS.first_points(points, start, "m", n, as_of, limit)
        assert first.columns == points.columns
        assert values_read(TS.read_points(TS.points_long(first), start, "m", n, as_of)) == wanted
    assert len(wanted) > 20 * n
    points.unpersist()


def test_first_points_are_few(spark):
    """Of each series those of some 1.4 n points, whether their times are apart or one second."""
    rows = spark.range(40_000).select(
        F.timestamp_seconds(1704067200 + F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(0)).alias("timestamp"),
        (F.col("id") % 2).cast("string").alias("event_type"),
        F.xxhash64("id").cast("double").alias("value"),
    )
    points = TS.to_points(rows, "m", ["event_type"], ["value"], "timestamp")
    for n, most in ((1, 15), (10, 60), (100, 600)):
        first = TS.points_long(TS.first_points(points, "5 minutes", "m", n, "2024-01-01 00:05:00"))
        assert 2 * n <= first.count() <= most
    # series of a point each are all kept
    alone = TS.to_points(rows.withColumn("event_type", F.col("value").cast("string")), "m", ["event_type"], ["value"], "timestamp")
    assert TS.first_points(alone, "5 minutes", "m", 10, "2024-01-01 00:05:00").count() == 40_000
    assert TS.first_points(points.limit(0), "5 minutes", "m", 10, "2024-01-01 00:05:00").count() == 0


def test_first_points_need_a_fixed_moment(spark):
    for moving in (None, F.current_timestamp()):
        with pytest.raises(ValueError):
            TS.first_points(points_frame(spark, []), "5 minutes", "m", 10, moving)


def test_the_range_read_sorts_few_values(spark, sf_dir, tmp_path, monkeypatch):
    """Sixty times the events, apart in time, give the sort a small part of their values and the same result."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    copy = F.explode(F.sequence(F.lit(0), F.lit(59))).alias("__copy")
    copies = events.select("*", copy).withColumns(
        {"event_id": F.col("event_id") + F.col("__copy") * 10_000_000, "ts": F.col("ts") + F.make_dt_interval(secs=F.col("__copy") * 7)}
    )
    copies.drop("__copy").write.parquet(str(tmp_path / "events.parquet"))
    spark.read.parquet(f"{sf_dir}/customer.parquet").write.parquet(str(tmp_path / "customer.parquet"))
    whole = TS.points_long(TS.event_points(catalogue._shaped(spark, str(tmp_path))))
    whole = whole.filter(F.col("time") >= F.lit(X.AS_OF).cast("timestamp") - F.expr("interval 20 days"))
    sorted_rows = []

    def read(long, *args):
        sorted_rows.append(long.count())
        return plain(long, *args)

    plain = TS.read_points
    monkeypatch.setattr(TS, "read_points", read)
    got = catalogue.QUERIES["point_range_read"](spark, str(tmp_path))
    wanted = catalogue.portable(catalogue._long(plain(whole, "20 days", "user_events", 10, X.AS_OF), TS.EVENT_TAGS))
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    assert sorted_rows[0] < whole.count() / 3


def test_lines(spark):
    point = TS.to_points(
        frame(spark, [(T0, "click", "a b,c=d", 1.5, 1, 'say "hi"')]),
        "m", ["event_type", "campaign_id"], ["total_amount", "note"], "timestamp", ["is_conversion"],
    )
    wanted = 'm,campaign_id=a\\ b\\,c\\=d,event_type=click total_amount=1.5,is_conversion=1i,note="say \\"hi\\"" 1704067200'
    assert TS.point_lines(point).first().line == wanted
    empty = TS.to_points(frame(spark, [(T0, "click", None, None, None, None)]), "m", ["event_type"], [], "timestamp")
    assert TS.point_lines(empty).count() == 0


def file_writer(folder):
    """A writer that appends every call as a block to a file of its own."""

    class FileWriter:
        def __init__(self):
            import uuid

            self.file = open(f"{folder}/{uuid.uuid4().hex}", "w")

        def write(self, lines):
            self.file.write(f"#{len(lines)}\n" + "".join(line + "\n" for line in lines))

        def close(self):
            self.file.close()

    return FileWriter


def test_writing_runs_in_tasks_and_in_batches(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.range(2500).repartition(2).select(
        F.lit(T0).alias("timestamp"), F.col("id").cast("string").alias("event_type"), F.lit(1).alias("n")
    )
    points = TS.to_points(rows, "m", ["event_type"], ["n"], "timestamp")
    assert TS.write_points(points, file_writer(folder), 1000) == 2500
    files = os.listdir(folder)
    assert len(files) == 2
    sizes, lines = [], []
    for name in files:
        for line in open(os.path.join(folder, name)):
            (sizes if line.startswith("#") else lines).append(line)
    assert len(set(lines)) == 2500 and all(int(s[1:]) <= 1000 for s in sizes)


def test_no_writer_without_points(spark, tmp_path):
    def refuse():
        raise AssertionError("no writer needed")

    points = TS.to_points(frame(spark, []), "m", ["event_type"], ["total_amount"], "timestamp")
    assert TS.write_points(points, refuse) == 0


def test_lines_stay_whole(spark):
    rows = spark.sql(
        "select timestamp'2024-01-01' as t, 'a\\nb' as place, '' as empty, true as ok, double('inf') as big, 'x\\r\\ny' as note"
    )
    points = TS.to_points(rows, "m", ("place", "empty"), ("ok", "big", "note"), "t")
    assert [r.line for r in TS.point_lines(points).collect()] == ['m,place=a\\nb ok=1.0,note="x\\r\\ny" 1704067200']
