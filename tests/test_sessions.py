"""Session numbers: ties, hot sessions, missing sessions and times."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyriver.operators import sessions as W

SCHEMA = "event_id bigint, session_id string, timestamp timestamp"
START = datetime(2024, 1, 1)


def brute_force(rows, nulls=False):
    groups = defaultdict(list)
    for event_id, session, ts in rows:
        groups[session].append((ts is not None, ts or START, event_id))
    numbers = {}
    for session, members in groups.items():
        for n, (_, _, event_id) in enumerate(sorted(members), 1):
            numbers[event_id] = None if session is None and not nulls else n
    return numbers


def numbered(df, **options):
    return {r.event_id: r.session_event_number for r in W.with_session_numbers(df, **options).collect()}


def hot_rows():
    """A third of all rows in one session, most of them within one second."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        if i % 3 == 0:
            ts = START + timedelta(microseconds=rng.randrange(200) if i % 2 else rng.randrange(10**9))
            rows.append((i, "hot", ts))
        else:
            rows.append((i, rng.choice(["a", "b", "c", None]), START + timedelta(seconds=rng.randrange(60))))
    rows.append((900, "hot", None))
    return rows


@pytest.mark.parametrize("limit", [None, 1, 7, 50, 10**6])
def test_hot_session(spark, limit):
    rows = hot_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    assert numbered(df, hot_rows=limit) == brute_force(rows)


@pytest.mark.parametrize("limit", [None, 20])
def test_missing_sessions_as_one_group(spark, limit):
    rows = hot_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    assert numbered(df, hot_rows=limit, null_session="group") == brute_force(rows, nulls=True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 30))), min_size=1, max_size=40
    ),
    st.integers(1, 5),
)
def test_any_rows(spark, items, limit):
    rows = [(i, s, None if t is None else START + timedelta(microseconds=t)) for i, (s, t) in enumerate(items)]
    assert numbered(spark.createDataFrame(rows, SCHEMA), hot_rows=limit) == brute_force(rows)


def test_start_flag_and_first_events(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    flagged = W.with_session_numbers(df, hot_rows=10).filter("is_session_start = 1")
    assert {r.event_id for r in flagged.collect()} == {e for e, n in brute_force(rows).items() if n == 1}
    assert {r.event_id for r in W.session_starts(df.filter("timestamp is not null")).collect()} == {
        e for e, n in brute_force([r for r in rows if r[2]]).items() if n == 1
    }


def test_broker_position_breaks_ties(spark):
    rows = [("s", START, 1, 5), ("s", START, 0, 9), ("s", START, 1, 4)]
    df = spark.createDataFrame(rows, "session_id string, timestamp timestamp, partition int, offset bigint")
    out = W.with_session_numbers(df).orderBy("session_event_number").collect()
    assert [(r.partition, r.offset) for r in out] == [(0, 9), (1, 4), (1, 5)]


def test_a_hot_session_is_cut_into_slices(spark):
    """Evenly spread events; see the operator for what two cuts cannot part."""
    rows = [(i, "hot", START + timedelta(seconds=i)) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    plan = W.with_session_numbers(df, hot_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "__coarse" in plan and "__fine" in plan
    assert numbered(df, hot_rows=100) == brute_force(rows)


def test_stream_is_refused(spark, tmp_path):
    spark.createDataFrame(hot_rows(), SCHEMA).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        W.with_session_numbers(stream)


@pytest.mark.parametrize("partitions", [None, 1, 3, 40])
def test_ranges_equal_brute_force(spark, partitions):
    rows = hot_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert numbered(df, partitions=partitions) == brute_force(rows)
    assert numbered(df, partitions=partitions, null_session="group") == brute_force(rows, nulls=True)


def test_ranges_of_an_empty_frame(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert W.with_session_numbers(df).count() == 0


def rows_per_task(spark, df):
    """Rows that each task of the numbering stage has written."""
    import glob

    import pyarrow.parquet as pq

    made = []
    folder = W.shared_folder

    def noted(session, purpose):
        made.append(folder(session, purpose))
        return made[-1]

    W.shared_folder = noted
    try:
        numbers = numbered(df, partitions=20)
    finally:
        W.shared_folder = folder
    return numbers, [pq.read_metadata(f).num_rows for f in glob.glob(f"{made[0]}/*.parquet")]


def test_one_moment_is_parted_over_tasks(spark):
    """10,000 events of one session and one moment, beside a few others."""
    rows = [(i, "hot", START) for i in range(10_000)] + [(10_000 + i, f"s{i % 50}", START) for i in range(500)]
    numbers, sizes = rows_per_task(spark, spark.createDataFrame(rows, SCHEMA).repartition(8))
    assert numbers == brute_force(rows)
    assert len(sizes) >= 15 and max(sizes) <= 3 * 10_500 / 20


def test_columns_of_every_kind_come_back(spark):
    df = spark.sql(
        "select id as event_id, 's' as session_id, timestamp'2024-01-01' as timestamp, map('a', id) as m, "
        "named_struct('x', id, 'y', array(id)) as t, cast(id as decimal(18,2)) as d from range(20)"
    )
    found = W.with_session_numbers(df)
    assert found.select(*df.columns).dtypes == df.dtypes
    assert {r.event_id: (r.session_event_number, r.m, r.t.y, int(r.d)) for r in found.collect()} == {
        i: (i + 1, {"a": i}, [i], i) for i in range(20)
    }
