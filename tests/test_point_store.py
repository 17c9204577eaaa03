"""The points format: round trips, pushed filters, whole commits, repeated batches and folded logs."""

import glob
import os
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import datasource as DS
from pyspark.sql import functions as F

from tallyriver.schemas import POINT_SCHEMA
from tallyriver.sources import point_store as PS
from tallyriver.streaming import sinks as SK

T0 = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def _format(spark):
    PS.register(spark)


def point(n, measurement="m", at=None):
    return (measurement, {"t": str(n % 3)}, {"f": n / 2}, {"i": n}, {"x": "a,b"}, at or T0 + timedelta(minutes=n))


def frame(spark, points):
    return spark.createDataFrame(points, POINT_SCHEMA)


def write(df, path, **options):
    df.write.format(PS.FORMAT).options(**options).mode("append").save(path)


def read(spark, path, **options):
    return spark.read.format(PS.FORMAT).options(**options).load(path)


def numbers(df):
    return sorted(r["n"] for r in df.select(F.col("int_fields")["i"].alias("n")).collect())


def data_files(path):
    return {os.path.basename(f) for f in glob.glob(f"{path}/data/*.parquet")}


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "p")
    odd = [
        (None, {}, {}, {}, {}, None),
        ("ünï", {"": ""}, {"f": float("inf")}, {"i": -(2**63)}, {"x": "line\nbreak"}, datetime(1969, 12, 31, 23, 59, 59, 999999)),
        ("m", {"t": None}, {"f": None}, None, {"x": None}, T0),
    ]
    df = frame(spark, [point(n) for n in range(20)] + odd + odd)
    write(df, path)
    back = read(spark, path)
    assert back.schema == POINT_SCHEMA
    plain = lambda d: sorted((str(r.asDict()) for r in d.collect()))
    assert plain(back) == plain(df)


def test_an_empty_frame_and_an_empty_store(spark, tmp_path):
    path = str(tmp_path / "p")
    assert read(spark, path).count() == 0
    write(frame(spark, []), path)
    assert read(spark, path).count() == 0 and not data_files(path)


def test_columns_in_another_order_and_extra_ones(spark, tmp_path):
    path = str(tmp_path / "p")
    df = frame(spark, [point(n) for n in range(5)])
    write(df.select("time", F.lit(1).alias("extra"), *[c for c in df.columns if c != "time"]), path)
    assert numbers(read(spark, path)) == list(range(5))


def test_what_is_no_points_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="no points"):
        write(spark.range(3), str(tmp_path / "p"))
    with pytest.raises(Exception, match="appended"):
        frame(spark, [point(1)]).write.format(PS.FORMAT).mode("overwrite").save(str(tmp_path / "p"))
    assert not data_files(tmp_path / "p")


def test_filters_leave_out_files(spark, tmp_path):
    path = str(tmp_path / "p")
    for day in range(4):
        write(frame(spark, [point(n, at=T0 + timedelta(days=day, minutes=n)) for n in range(10)]).coalesce(1), path)
    reader = PS.Reader({"path": path, "rows_per_partition": "1"})
    since, until = T0 + timedelta(days=1, minutes=5), T0 + timedelta(days=2)
    given = [DS.GreaterThanOrEqual(("time",), since), DS.LessThan(("time",), until), DS.EqualTo(("measurement",), "m")]
    assert list(reader.pushFilters(given)) == given
    # the bound at midnight is kept by the file after it, too, whose first point lies there
    assert sum(len(p.names) for p in reader.partitions()) == 2
    rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert rows == 6
    other = PS.Reader({"path": path})
    list(other.pushFilters([DS.EqualTo(("measurement",), "z")]))
    assert [p.names for p in other.partitions()] == [[]]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_filtered_reads_equal_filtered_frames(spark, tmp_path, zone):
    path = str(tmp_path / "p")
    df = frame(spark, [point(n, "abc"[n % 3]) for n in range(60)] + [point(99, None), (*point(98)[:5], None)])
    write(PS.by_time(df, 4), path)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for condition in (
            "time >= timestamp'2024-01-01 00:10:00 UTC' and time < timestamp'2024-01-01 00:30:00 UTC'",
            "measurement = 'b'",
            "measurement = 'b' and time > timestamp'2024-01-01 00:10:00 UTC' and time <= timestamp'2024-01-01 00:31:00 UTC'",
            "time = timestamp'2024-01-01 00:07:00 UTC'",
            "measurement = 'a' and measurement = 'b'",
            "measurement <=> null",
            "time is null",
            "measurement = 'a' or time < timestamp'2024-01-01 00:05:00 UTC'",
            "not (measurement = 'a')",
        ):
            assert numbers(read(spark, path).filter(condition)) == numbers(df.filter(condition)), condition
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_large_tasks_roll_files_and_small_files_share_tasks(spark, tmp_path):
    path = str(tmp_path / "p")
    df = frame(spark, [point(n) for n in range(1000)]).coalesce(1)
    write(df, path, rows_per_file=64)
    assert len(data_files(path)) == 16
    assert numbers(read(spark, path)) == list(range(1000))
    assert read(spark, path, rows_per_partition=256).rdd.getNumPartitions() == 4


def test_a_failed_write_leaves_no_points(spark, tmp_path):
    path = str(tmp_path / "p")
    write(frame(spark, [point(1)]), path)
    kept = data_files(path)
    df = frame(spark, [point(n) for n in range(400)]).repartition(4)
    broken = df.withColumn("measurement", F.when(F.col("int_fields")["i"] == 333, F.raise_error(F.lit("broken"))).otherwise("m"))
    with pytest.raises(Exception, match="broken"):
        write(broken, path, rows_per_file=10)
    assert numbers(read(spark, path)) == [1]
    assert data_files(path) == kept


def test_a_task_that_fails_removes_its_files(tmp_path):
    def batches():
        table = pa.table({"measurement": ["m"] * 30}).to_batches()[0]
        yield table

    with pytest.raises(Exception):
        PS._Task(str(tmp_path), 10).run(batches())
    assert not data_files(tmp_path)


def test_files_of_killed_tasks_are_unseen_and_can_be_removed(spark, tmp_path):
    path = str(tmp_path / "p")
    write(frame(spark, [point(n) for n in range(8)]).coalesce(1), path)
    (known,) = data_files(path)
    with open(f"{path}/data/{known}", "rb") as f, open(f"{path}/data/left.parquet", "wb") as g:
        g.write(f.read())
    assert numbers(read(spark, path)) == list(range(8))
    assert PS.remove_unlisted(path) == 0
    assert PS.remove_unlisted(path, older_than=0) == 1
    assert data_files(path) == {known}


def test_a_repeated_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "p")
    settings = PS._Settings({"path": path, "writer": "w"}, stream=True)
    batches = frame(spark, [point(n) for n in range(5)]).toArrow().to_batches()
    for batch_id in (0, 1, 1, 0, 2):
        writer = PS.StreamWriter(settings)
        writer.commit([writer.write(iter(batches)), None], batch_id)
    assert numbers(read(spark, path)) == sorted(3 * list(range(5)))
    assert len(data_files(path)) == 3


def test_a_log_is_folded(spark, tmp_path):
    path = str(tmp_path / "p")
    settings = PS._Settings({"path": path, "writer": "w", "fold_every": "5"}, stream=True)
    batches = frame(spark, [point(7)]).toArrow().to_batches()
    sizes = []
    for batch_id in range(40):
        writer = PS.StreamWriter(settings)
        writer.commit([writer.write(iter(batches))], batch_id)
        sizes.append(len(os.listdir(f"{path}/log/stream-w")))
    assert max(sizes[10:]) <= 12 and sizes[-1] == sizes[-6]
    assert read(spark, path).count() == 40
    log = PS.Log(path, "stream-w")
    assert [n for n, _ in log.entries(33, 38)] == [33, 34, 35, 36, 37]
    assert log.next() == 40 and log.holds(0) and not log.holds(40)


def _started(spark, path, source, checkpoint):
    stream = spark.readStream.schema(POINT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    sink = stream.writeStream.format(PS.FORMAT).option("path", path).option("writer", "main")
    query = sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def test_streams_in_and_out_go_on_after_a_stop(spark, tmp_path):
    path, source, out = (str(tmp_path / n) for n in ("p", "in", "out"))
    for k in range(4):
        frame(spark, [point(n) for n in range(10 * k, 10 * k + 10)]).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)
        if k % 2:
            _started(spark, path, source, str(tmp_path / "c1"))
            stored = spark.readStream.format(PS.FORMAT).load(path)
            SK.start_sink(stored, SK.parquet_writer(out), "append", "available", str(tmp_path / "c2")).awaitTermination()
            assert numbers(spark.read.parquet(out)) == list(range(10 * k + 10))
    # a batch write joins the same store under a log of its own
    write(frame(spark, [point(100)]), path)
    stored = spark.readStream.format(PS.FORMAT).load(path)
    SK.start_sink(stored, SK.parquet_writer(out), "append", "available", str(tmp_path / "c2")).awaitTermination()
    assert numbers(spark.read.parquet(out)) == [*range(40), 100]


def test_a_stream_without_a_name_is_refused(spark, tmp_path):
    frame(spark, [point(1)]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(POINT_SCHEMA).parquet(str(tmp_path / "in"))
    sink = stream.writeStream.format(PS.FORMAT).option("path", str(tmp_path / "p"))
    with pytest.raises(Exception, match="writer"):
        sink.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
