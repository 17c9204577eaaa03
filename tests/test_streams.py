"""Streams against batch, late events, restarts and run control."""

import tempfile
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyriver.operators import enrichment as J
from tallyriver.operators import events as E
from tallyriver.operators import metrics as M
from tallyriver.operators import points as TS
from tallyriver.operators import sessions as W
from tallyriver.sources import events as S
from tallyriver.storage import read_current
from tallyriver.streaming import late as SL
from tallyriver.streaming import metrics as SM
from tallyriver.streaming import run as SR
from tallyriver.streaming import sessions as SS
from tallyriver.streaming import sinks as SK
from tallyriver.streaming import upsert as SU


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def slices(spark, events, tmp_path):
    """The events in three files, oldest first; a function opens them as a stream."""
    folder = tmp_path / "in"
    ordered = events.orderBy("timestamp", "event_id").limit(events.count())
    numbered = ordered.withColumn("part", F.ntile(3).over(W.Window.orderBy("timestamp", "event_id")))
    for part in (1, 2, 3):
        numbered.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(1.1)

    def stream():
        reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
        return reader.option("latestFirst", False).parquet(str(folder))

    return stream


def run(df, writer, mode, checkpoint):
    (query,) = SR.run_available([lambda: SK.start_sink(df, writer, mode, "available", str(checkpoint))])
    return query


def test_complete_mode_equals_batch(spark, events, slices, tmp_path):
    writer = SM.complete_writer(M.merge_minute_partials, SK.latest_writer(str(tmp_path / "out")))
    query = run(M.minute_partials(SK.with_watermark(slices()), buckets=4), writer, "complete", tmp_path / "c")
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert rows_of(read_current(spark, str(tmp_path / "out"))) == rows_of(M.minute_metrics(events))


def test_update_mode_equals_batch(spark, events, slices, tmp_path):
    parts, out = str(tmp_path / "parts"), str(tmp_path / "out")
    writer = SM.update_writer(parts, M.MINUTE_KEYS, M.merge_minute_partials, SK.parquet_writer(out))
    run(M.minute_partials(SK.with_watermark(slices()), "1 day", 4), writer, "update", tmp_path / "c")
    written = spark.read.parquet(out)
    newest = written.groupBy("window_start", "event_type").agg(F.max_by(F.struct(*written.columns), "batch_id").alias("r"))
    got = newest.select("r.*").drop("batch_id")
    assert rows_of(got) == rows_of(M.minute_metrics(events, "1 day"))


def test_state_in_rocksdb_equals_batch(spark, events, slices, tmp_path):
    SS.use_rocksdb(spark)
    try:
        writer = SM.complete_writer(M.merge_minute_partials, SK.latest_writer(str(tmp_path / "out")))
        query = run(M.minute_partials(SK.with_watermark(slices()), buckets=4), writer, "complete", tmp_path / "c")
    finally:
        spark.conf.unset(SS.STATE_PROVIDER)
    metrics = [o["customMetrics"] for p in query.recentProgress for o in p["stateOperators"]]
    assert metrics and all(any(name.startswith("rocksdb") for name in m) for m in metrics)
    assert rows_of(read_current(spark, str(tmp_path / "out"))) == rows_of(M.minute_metrics(events))


def test_stream_of_points_to_a_store(spark, events, slices, tmp_path):
    folder = tmp_path / "store"
    folder.mkdir()

    class Store:
        def __init__(self):
            self.file = tempfile.NamedTemporaryFile("w", dir=str(folder), delete=False)

        def write(self, lines):
            self.file.write("".join(line + "\n" for line in lines))

        def close(self):
            self.file.close()

    def points(df):
        return TS.to_points(df, "m", ["event_type"], ["units", "total_amount"], "timestamp")

    run(points(slices()), SK.point_writer(Store, 100), "append", tmp_path / "c")
    written = [line.rstrip("\n") for path in folder.iterdir() for line in path.open()]
    assert sorted(written) == sorted(r.line for r in TS.point_lines(points(events)).collect())
    assert len(list(folder.iterdir())) >= 3


def test_campaigns_with_a_null_key(spark, events, demographics, slices, tmp_path):
    parts, out = str(tmp_path / "parts"), str(tmp_path / "out")
    writer = SM.update_writer(parts, M.CAMPAIGN_KEYS, M.merge_campaign_partials, SK.parquet_writer(out))
    stream = J.enrich(SK.with_watermark(slices()), demographics)
    run(M.campaign_partials(stream, "1 day", 4), writer, "update", tmp_path / "c")
    written = spark.read.parquet(out)
    keys = ["window_start", "campaign_id", "country"]
    newest = written.groupBy(*keys).agg(F.max_by(F.struct(*written.columns), "batch_id").alias("r"))
    got = newest.select("r.*").drop("batch_id")
    assert rows_of(got) == rows_of(M.campaign_analytics(J.enrich(events, demographics), "1 day"))


def test_append_mode_drops_late_events_and_open_windows(spark, tmp_path):
    t = datetime(2024, 1, 1)
    batches = [
        [(t, "click", 1, 1.0), (t + timedelta(seconds=5), "click", 2, None), (t + timedelta(minutes=5), "click", 1, 2.0)],
        [(t + timedelta(minutes=6), "click", 1, None)],
        [(t + timedelta(seconds=1), "click", 3, 5.0), (t + timedelta(minutes=9), "click", 1, 2.0)],
    ]
    schema = "timestamp timestamp, event_type string, user_id int, total_amount double"
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    metrics = M.minute_metrics(SK.with_watermark(stream))
    run(metrics, SK.parquet_writer(str(tmp_path / "out")), "append", tmp_path / "c")
    got = {(r.window_start, r.event_count, r.unique_users, r.total_revenue) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(t, 2, 2, 1.0), (t + timedelta(minutes=5), 1, 1, 2.0), (t + timedelta(minutes=6), 1, 1, None)}


def test_approximate_users_are_close(events):
    exact = {(r.window_start, r.event_type): r.unique_users for r in M.minute_metrics(events, "30 days").collect()}
    for r in M.minute_metrics(events, "30 days", distinct="approx", rsd=0.02).collect():
        assert abs(r.unique_users - exact[(r.window_start, r.event_type)]) <= max(1, 0.1 * exact[(r.window_start, r.event_type)])


@pytest.mark.parametrize("options", [{}, {"fold_every": 1, "hot_rows": 3, "salts": 3}])
def test_session_numbers_over_batches_equal_batch(spark, events, slices, tmp_path, options):
    writer = SS.session_writer(str(tmp_path / "s"), SK.parquet_writer(str(tmp_path / "out")), **options)
    run(slices(), writer, "append", tmp_path / "c")
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch_id")
    wanted = W.with_session_numbers(events).select(*got.columns)
    assert rows_of(got) == rows_of(wanted)


def session_batches(spark, batches):
    """(event, session, hours) rows of each batch as frames."""
    t = datetime(2024, 1, 1)
    schema = "event_id bigint, session_id string, timestamp timestamp"
    return [spark.createDataFrame([(i, s, t + timedelta(hours=h)) for i, s, h in b], schema) for b in batches]


def numbers(spark, tmp_path, batches, **options):
    out = str(tmp_path / "out")
    writer = SS.session_writer(str(tmp_path / "s"), SK.parquet_writer(out), **options)
    for i, batch in batches:
        writer(batch, i)
    return {r.event_id: r.session_event_number for r in spark.read.parquet(out).collect()}


def test_a_far_future_event_changes_no_other_session(spark, tmp_path):
    frames = session_batches(spark, [[(0, "s", 0)], [(1, "other", 24 * 40_000)], [(2, "s", 1), (3, None, 1)], [(4, "s", 2)]])
    got = numbers(spark, tmp_path, enumerate(frames), ttl=24 * 3600, fold_every=1)
    assert got == {0: 1, 1: 1, 2: 2, 3: None, 4: 3}


def test_sessions_are_forgotten_after_their_time(spark, tmp_path):
    frames = session_batches(spark, [[(0, "s", 0)], [(1, "s", 1)], [(2, "other", 30)], [(3, "s", 31), (4, "other", 31)]])
    assert numbers(spark, tmp_path, enumerate(frames), ttl=24 * 3600, fold_every=1) == {0: 1, 1: 2, 2: 1, 3: 1, 4: 2}


def test_a_replayed_batch_gets_the_same_numbers(spark, tmp_path):
    a, b = session_batches(spark, [[(0, "s", 0), (1, "s", 1)], [(2, "s", 2)]])
    assert numbers(spark, tmp_path, [(0, a), (1, b), (1, b), (0, a)], fold_every=1) == {0: 1, 1: 2, 2: 3}


def test_session_starts_once_over_batches_far_apart(spark, events, slices, tmp_path):
    writer = SS.start_writer(str(tmp_path / "s"), SK.parquet_writer(str(tmp_path / "out")))
    run(slices(), writer, "append", tmp_path / "c")
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch_id")
    assert rows_of(got) == rows_of(W.session_starts(events).select(*got.columns))


def test_restart_continues_without_duplicates(spark, events, tmp_path):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")

    def once():
        stream = spark.readStream.schema(events.schema).parquet(source)
        run(stream, SK.parquet_writer(out), "append", checkpoint)

    events.filter("event_id % 2 = 0").write.parquet(source)
    once()
    once()
    events.filter("event_id % 2 = 1").write.mode("append").parquet(source)
    once()
    got = spark.read.parquet(out)
    assert got.count() == events.count() and got.select("event_id").distinct().count() == events.count()


def test_upsert_stream_equals_batches(spark, events, demographics, slices, tmp_path):
    shaped = E.with_business_metrics(J.enrich(slices(), demographics))
    path = str(tmp_path / "summary")
    SR.run_available([lambda: SU.start_upsert(shaped, path, str(tmp_path / "c"), "available")])
    got = SU.read_summary(spark, path)
    whole = M.hourly_rollup(E.with_business_metrics(J.enrich(events, demographics)))
    totals = lambda df: df.agg(F.sum("total_events"), F.sum("total_revenue"), F.count(F.lit(1))).first()
    assert tuple(totals(got)) == tuple(totals(whole))


def test_main_stream_writes_points(spark, events, demographics, slices, tmp_path):
    lookup = J.Lookup(lambda: demographics, ttl=60)
    writer = SR.event_writer(lookup, SK.parquet_writer(str(tmp_path / "out")))
    run(slices(), SS.session_writer(str(tmp_path / "s"), writer), "append", tmp_path / "c")
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch_id")
    wanted = TS.event_points(E.enriched_events(events, demographics))
    text = lambda df: rows_of(TS.point_lines(df))
    assert text(got) == text(wanted)


def test_dead_letters_of_a_stream(spark, tmp_path):
    from test_decode import LINES, envelope

    envelope(spark).write.parquet(str(tmp_path / "in"))
    stream = S.project_envelope(spark.readStream.schema(envelope(spark).schema).parquet(str(tmp_path / "in")))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    run(stream, SK.dead_letter_writer(SK.parquet_writer(good), SK.parquet_writer(bad)), "append", tmp_path / "c")
    assert spark.read.parquet(good).count() + spark.read.parquet(bad).count() == len(LINES)
    assert {r.offset for r in spark.read.parquet(bad).collect()} == {4, 6, 9, 10}


def test_empty_batches_can_be_skipped(spark, events, slices, tmp_path):
    calls = []
    none = slices().filter("event_id < 0")
    query = SK.start_sink(none, lambda df, i: calls.append(i), "append", "available", str(tmp_path / "c"), skip_empty=True)
    query.awaitTermination()
    assert calls == [] and query.recentProgress
    all_rows = SK.start_sink(slices(), lambda df, i: calls.append(df.count()), "append", "available", str(tmp_path / "d"), skip_empty=True)
    all_rows.awaitTermination()
    assert sum(calls) == events.count()


def test_run_all_stops_every_query(spark, slices, tmp_path):
    seen = []
    slow = lambda: SK.start_sink(slices(), lambda df, i: seen.append(i), "append", "1 second", str(tmp_path / "a"))
    short = lambda: SK.start_sink(slices(), lambda df, i: None, "append", "available", str(tmp_path / "b"))
    queries = SR.run_all(spark, [slow, short])
    assert not any(q.isActive for q in queries) and not spark.streams.active


def test_run_all_raises_the_failure(spark, slices, tmp_path):
    def fail(df, i):
        raise RuntimeError("writer failed")

    with pytest.raises(Exception, match="writer failed"):
        SR.run_all(spark, [lambda: SK.start_sink(slices(), fail, "append", "available", str(tmp_path / "a"))])
    assert not spark.streams.active


def test_progress(spark, events, slices, tmp_path):
    log = SR.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        run(slices(), SK.parquet_writer(str(tmp_path / "out")), "append", tmp_path / "c")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(log)
    frame = SR.progress_frame(spark, str(tmp_path / "progress"))
    assert frame.agg(F.sum("records")).first()[0] == events.count()
    assert frame.filter("records > 0 and records_per_second <= 0").isEmpty()


def test_console(spark, events, demographics, slices, tmp_path):
    query = SK.start_console(J.enrich(slices(), demographics), "1 second", str(tmp_path / "c"))
    try:
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        query.stop()


def test_lines_sink(spark, events, slices, tmp_path):
    points = TS.to_points(slices(), "visits", ["event_type"], ["user_id"], "timestamp")
    run(points, SK.line_writer(str(tmp_path / "out")), "append", tmp_path / "c")
    assert spark.read.text(str(tmp_path / "out")).count() == events.count()


def test_a_batch_that_lands_during_compaction_counts_once(spark, events, demographics, tmp_path, monkeypatch):
    path = str(tmp_path / "summary")
    write, shaped = SU.upsert_writer(path), E.with_business_metrics(E.with_event_categories(J.enrich(events, demographics)))
    write(shaped, 0)
    read = SU.read_summary

    def landing(*args):
        write(shaped, 1)
        return read(*args)

    monkeypatch.setattr(SU, "read_summary", landing)
    assert SU.compact_summary(spark, path) == 0
    monkeypatch.undo()
    assert SU.read_summary(spark, path).agg(F.sum("total_events")).first()[0] == 2 * events.count()


def test_a_failing_query_stops_the_others(spark, slices, tmp_path):
    def broken(batch, batch_id):
        raise RuntimeError("no")

    others = []

    def endless():
        others.append(SK.start_sink(slices(), lambda b, i: None, "append", "1 second", str(tmp_path / "a")))
        return others[0]

    failing = lambda: SK.start_sink(slices(), broken, "append", "available", str(tmp_path / "b"))
    with pytest.raises(Exception, match="no"):
        SR.run_available([failing, endless])
    assert not others[0].isActive


def test_only_the_last_versions_of_a_complete_result_stay(spark, tmp_path):
    out = str(tmp_path / "out")
    writer = SK.latest_writer(out, keep=2)
    for batch_id in range(5):
        writer(spark.range(batch_id), batch_id)
    assert read_current(spark, out).count() == 4
    assert len([p for p in (tmp_path / "out").iterdir() if p.is_dir()]) == 2


def test_files_per_date_stay_bounded(spark, tmp_path):
    path, out = tmp_path / "parts", str(tmp_path / "out")
    writer = SM.update_writer(str(path), M.MINUTE_KEYS, M.merge_minute_partials, SK.parquet_writer(out), files_per_date=1, fold_every=3, retain="2 days")
    most = 0
    for batch_id in range(20):
        # users so far in one window, seen again and again, and one new window a day
        rows = [(u, f"2024-01-{1 + batch_id // 4:02d} 00:00:30") for u in range(batch_id + 1)]
        events = spark.createDataFrame(rows, "user_id int, at string").selectExpr(
            "user_id", "cast(at as timestamp) as timestamp", "'click' as event_type", "1.0D as total_amount"
        )
        writer(M.minute_partials(events, buckets=2), batch_id)
        most = max(most, len(list(path.rglob("window_date=2024-01-05/part-*"))) if batch_id >= 16 else 0)
        dates = {p.name for p in path.glob("base/*/window_date=*")}
    assert 0 < most <= 8 and len(list((path / "deltas").glob("batch_id=*"))) <= 6
    assert "window_date=2024-01-01" not in dates
    last = spark.read.parquet(out).groupBy("window_start").agg(F.max_by("unique_users", "batch_id").alias("n"))
    assert sorted(r.n for r in last.collect()) == [4, 8, 12, 16, 20]


def test_files_read_by_a_batch_stay_constant(spark, tmp_path):
    """40 batches of sessions that come again and again: the folders read and kept reach a plateau."""
    path, out = tmp_path / "s", str(tmp_path / "out")
    writer = SS.session_writer(str(path), SK.parquet_writer(out), fold_every=4, buckets=4)
    read, kept = [], []
    for batch_id in range(40):
        t = datetime(2024, 1, 1) + timedelta(hours=batch_id)
        rows = [(10 * batch_id + i, f"s{i}", t) for i in range(5)] + [(10 * batch_id + 9, f"once{batch_id}", t)]
        read.append(len(SS._Table(spark, str(path), batch_id).files(set(range(4)))))
        writer(spark.createDataFrame(rows, "event_id bigint, session_id string, timestamp timestamp"), batch_id)
        kept.append(len([p for p in path.rglob("*") if p.is_dir()]))
    # a base and the deltas of three batches for each bucket
    assert max(read) <= 4 * 4 and max(kept[20:]) <= 65
    assert not list((path / "before").glob("batch_id=*")) and len(list((path / "counts").glob("batch_id=*"))) <= 8
    numbers = {r.event_id: r.session_event_number for r in spark.read.parquet(out).collect()}
    assert all(numbers[10 * b + i] == b + 1 for b in range(40) for i in range(5))
    assert all(numbers[10 * b + 9] == 1 for b in range(40))


def test_only_touched_buckets_are_written(spark, tmp_path):
    path, out = tmp_path / "s", str(tmp_path / "out")
    writer = SS.session_writer(str(path), SK.parquet_writer(out), fold_every=1, buckets=16)
    schema = "event_id bigint, session_id string, timestamp timestamp"
    t = datetime(2024, 1, 1)
    writer(spark.createDataFrame([(i, f"s{i}", t) for i in range(100)], schema), 0)
    writer(spark.createDataFrame([(200, "s0", t)], schema), 1)
    assert len(list((path / "base" / "version=0").glob("bucket=*"))) == 16
    assert len(list((path / "base" / "version=1").glob("bucket=*"))) == 1
    writer(spark.createDataFrame([(300, "s0", t), (301, "s1", t)], schema), 2)
    numbers = {r.event_id: r.session_event_number for r in spark.read.parquet(out).collect()}
    assert (numbers[200], numbers[300], numbers[301]) == (2, 3, 2)


def test_run_all_ignores_failures_before_it(spark, slices, tmp_path):
    def fail(df, i):
        raise RuntimeError("an earlier query")

    query = SK.start_sink(slices(), fail, "append", "available", str(tmp_path / "a"))
    with pytest.raises(Exception, match="an earlier query"):
        query.awaitTermination()
    seen = []
    (done,) = SR.run_all(spark, [lambda: SK.start_sink(slices(), lambda df, i: seen.append(i), "append", "available", str(tmp_path / "b"))])
    assert len(seen) == 3 and done.exception() is None


def test_run_all_stops_after_its_time(spark, slices, tmp_path):
    started = time.monotonic()
    (query,) = SR.run_all(spark, [lambda: SK.start_sink(slices(), lambda df, i: None, "append", "1 second", str(tmp_path / "a"))], timeout=2)
    assert not query.isActive and 2 <= time.monotonic() - started < 60


def test_a_second_compaction_leaves_untouched_dates(spark, events, demographics, tmp_path):
    path = tmp_path / "summary"
    shaped = E.with_business_metrics(E.with_event_categories(J.enrich(events, demographics)))
    write = SU.upsert_writer(str(path))
    write(shaped, 0)
    assert SU.compact_summary(spark, str(path)) == 0
    files = lambda: {str(p): p.stat().st_mtime_ns for p in path.glob("base/*/date=*/part-*")}
    before = files()
    dates = {p.parent.name for p in path.glob("base/*/date=*/part-*")}
    one_day = shaped.filter(F.to_date("timestamp") == "2024-01-05")
    write(one_day, 1)
    assert SU.compact_summary(spark, str(path)) == 1
    after = files()
    assert {p: t for p, t in after.items() if p in before} == before and len(dates) > 20
    assert {p.split("/")[-2] for p in set(after) - set(before)} == {"date=2024-01-05"}
    counts = SU.read_summary(spark, str(path)).agg(F.sum("total_events")).first()[0]
    assert counts == shaped.count() + one_day.count()
    # what no base needs any more goes with the next compaction
    write(one_day, 2)
    assert SU.compact_summary(spark, str(path)) == 2
    assert not (path / "deltas" / "batch_id=0").exists() and (path / "deltas" / "batch_id=2").exists()
    write(one_day, 3)
    SU.compact_summary(spark, str(path))
    versions = {p.parent.parent.name for p in path.glob("base/*/date=2024-01-05/part-*")}
    assert versions == {"version=2", "version=3"}
    assert SU.read_summary(spark, str(path)).agg(F.sum("total_events")).first()[0] == counts + 2 * one_day.count()


def test_old_dates_are_dropped_whole(spark, events, demographics, tmp_path):
    from datetime import date

    path = str(tmp_path / "summary")
    shaped = E.with_business_metrics(E.with_event_categories(J.enrich(events, demographics)))
    write = SU.upsert_writer(path)
    write(shaped, 0)
    SU.compact_summary(spark, path)
    write(shaped.filter(F.to_date("timestamp") >= "2024-01-20"), 1)
    SU.compact_summary(spark, path, retain_from=date(2024, 1, 10))
    kept = SU.read_summary(spark, path)
    assert kept.agg(F.min("date")).first()[0] == date(2024, 1, 10)
    late = shaped.filter(F.to_date("timestamp") >= "2024-01-10").count() + shaped.filter(F.to_date("timestamp") >= "2024-01-20").count()
    assert kept.agg(F.sum("total_events")).first()[0] == late


def test_an_upsert_stream_folds_by_itself(spark, events, demographics, tmp_path):
    path = tmp_path / "summary"
    shaped = E.with_business_metrics(E.with_event_categories(J.enrich(events, demographics)))
    write, kept = SU.upsert_writer(str(path), fold_every=2), []
    for batch_id in range(8):
        write(shaped.filter(F.col("event_id") % 8 == batch_id), batch_id)
        kept.append(len(list((path / "deltas").glob("batch_id=*"))))
    assert max(kept) <= 4
    assert SU.read_summary(spark, str(path)).agg(F.sum("total_events")).first()[0] == events.count()


def test_progress_is_written_in_bulk(spark, slices, tmp_path):
    path = tmp_path / "progress"
    log = SR.ProgressLog(spark, str(path))
    spark.streams.addListener(log)
    observed = SR.observe_quality(slices(), ["campaign_id"])
    try:
        run(observed, SK.parquet_writer(str(tmp_path / "out")), "append", tmp_path / "c")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    log.flush()
    rows = [r for r in SR.progress_frame(spark, str(path)).collect() if r.records]
    assert len(rows) == 3 and len(list(path.glob("part-*"))) <= 2
    assert all(r.observed["quality.rows"] == r.records for r in rows)


LATE_SCHEMA = "timestamp timestamp, event_type string, user_id int, total_amount double, id int"
_T = datetime(2024, 1, 1)


def _late_batches():
    def row(minutes, n, seconds=0):
        return (_T + timedelta(minutes=minutes, seconds=seconds), "click", 1, 1.0, n)

    return [
        [row(0, 1), row(5, 2)],
        [row(0, 3), row(4, 4, 50), row(4, 5), row(3, 6, 59), row(20, 7), (None, "click", 1, 1.0, 8)],
        [row(5, 9), row(19, 10), row(18, 11, 59), row(20, 12, 1)],
    ]


def test_late_events_by_hand(spark, tmp_path):
    path, kept = str(tmp_path / "late"), str(tmp_path / "kept")
    write = SL.late_splitter(path, SK.parquet_writer(kept), delay="10 seconds", window="1 minute")
    for n, batch in enumerate(_late_batches()):
        write(spark.createDataFrame(batch, LATE_SCHEMA), n)
    late = {(r["id"], r["batch_id"], r["late_reason"]) for r in SL.read_late(spark, path).collect()}
    # batch 1 stands behind 4:50, batch 2 behind 19:50: a window that ends there or before is closed
    assert late == {(3, 1, SL.BEHIND), (6, 1, SL.BEHIND), (8, 1, SL.NO_TIME), (9, 2, SL.BEHIND), (11, 2, SL.BEHIND)}
    assert {r["id"] for r in spark.read.parquet(kept).collect()} == {1, 2, 4, 5, 7, 10, 12}
    counts = {(r["batch_id"], r["late_reason"]): (r["late_events"], r["most_behind_micros"]) for r in SL.late_counts(spark, path).collect()}
    assert counts == {(1, SL.BEHIND): (2, 290_000_000), (1, SL.NO_TIME): (1, None), (2, SL.BEHIND): (2, 890_000_000)}


def test_late_events_without_a_window(spark, tmp_path):
    path, kept = str(tmp_path / "late"), str(tmp_path / "kept")
    write = SL.late_splitter(path, SK.parquet_writer(kept), delay="10 seconds", window=None)
    for n, batch in enumerate(_late_batches()):
        write(spark.createDataFrame(batch, LATE_SCHEMA), n)
    assert {r["id"] for r in SL.read_late(spark, path).collect()} == {3, 4, 5, 6, 8, 9, 10, 11}


def test_a_repeated_batch_is_parted_alike(spark, tmp_path):
    path, kept = str(tmp_path / "late"), str(tmp_path / "kept")
    write = SL.late_splitter(path, SK.whole_batch_writer(kept))
    frames = [spark.createDataFrame(b, LATE_SCHEMA) for b in _late_batches()]
    for n in (0, 1, 1, 2, 2):
        write(frames[n], n)
    ids = [r["id"] for r in SL.read_late(spark, path).select("id").union(spark.read.parquet(kept).select("id")).collect()]
    assert sorted(ids) == list(range(1, 13))


def test_empty_batches_keep_the_watermark(spark, tmp_path):
    path, kept = str(tmp_path / "late"), str(tmp_path / "kept")
    write = SL.late_splitter(path, SK.parquet_writer(kept))
    frames = [spark.createDataFrame(b, LATE_SCHEMA) for b in _late_batches()]
    write(frames[0].limit(0), 0)
    write(frames[0], 1)
    write(frames[0].limit(0), 2)
    write(frames[1], 3)
    assert {r["id"] for r in SL.read_late(spark, path).collect()} == {3, 6, 8}


def test_windows_and_side_table_add_up(spark, tmp_path):
    """Three batches through both streams: nothing is dropped by the second one's own watermark."""
    path, kept, out = (str(tmp_path / n) for n in ("late", "kept", "out"))
    source = str(tmp_path / "in")
    for batch in _late_batches():
        spark.createDataFrame(batch, LATE_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)
    writer = SM.update_writer(str(tmp_path / "parts"), M.MINUTE_KEYS, M.merge_minute_partials, SK.parquet_writer(out))

    def second():
        on_time = spark.readStream.schema(LATE_SCHEMA).parquet(f"{kept}/batch_id=*")
        partials = M.minute_partials(SK.with_watermark(on_time), buckets=2)
        return SK.start_sink(partials, writer, "update", "available", str(tmp_path / "c2"))

    split = SL.late_splitter(path, SR.followed_by(SK.whole_batch_writer(kept), second))
    stream = spark.readStream.schema(LATE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    run(stream, split, "append", tmp_path / "c1")
    newest = spark.read.parquet(out).groupBy("window_start").agg(F.max_by("event_count", "batch_id").alias("n"))
    windows = newest.agg(F.sum("n")).first()[0]
    assert (windows, SL.read_late(spark, path).count()) == (7, 5)


def test_large_parts_of_a_stream_are_read_by_several_tasks(spark, sf_dir, tmp_path, monkeypatch):
    """The same micro-batches as from one file for each part, also where events are too few for the files."""
    from tallyriver.plans import fixtures as X

    def batches(folder, stream):
        out = str(tmp_path / folder)
        run(stream, SK.parquet_writer(out), "append", tmp_path / f"{folder}-c")
        return rows_of(spark.read.parquet(out).select("batch_id", "event_id", "timestamp", "user_id"))

    whole = batches("one", X.events_stream(spark, sf_dir, 30.5, 7))
    monkeypatch.setattr(X, "ROWS_PER_FILE", 40)
    wide = X.events_stream(spark, sf_dir, 30.5, 7)
    assert batches("many", wide) == whole and {r[0] for r in whole} == set(range(X.FILES))
    files = len(spark.read.parquet(X.event_files(spark, sf_dir)).inputFiles())
    assert files > X.FILES and files % X.FILES == 0
    raw = X.table(spark, sf_dir, "events").limit(3)
    raw.write.parquet(str(tmp_path / "few" / "events.parquet"))
    monkeypatch.setattr(X, "ROWS_PER_FILE", 1)
    few = batches("few-out", X.events_stream(spark, str(tmp_path / "few")))
    assert len(few) == 3
