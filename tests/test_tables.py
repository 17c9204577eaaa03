"""Readers, writers and the dimension's refresh."""

import pytest
from pyspark.sql import functions as F

from tallyriver.operators import dimension as D
from tallyriver.operators import quality as Q
from tallyriver.sinks import tables as K
from tallyriver.sources import events as S
from tallyriver.sources import tables as R
from tallyriver.storage import broadcast_if_small, child_names, read_current

HEADER = "id,age,gender,state,country,registration_date,income_bracket,last_login\n"


def csv(tmp_path, lines, header=HEADER):
    path = tmp_path / "users.csv"
    path.write_text(header + "".join(line + "\n" for line in lines))
    return str(path)


def people(n, age=30):
    codes = ["US", "DE", "FR", "JP", "AU", "IN"]
    return [f"{i},{age},Male,S,{codes[i % 6]},2023-01-01,<30k,2024-01-01" for i in range(n)]


class Recorder:
    """Stands in for Spark's reader and writer: remembers the options, touches nothing."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        return self.seen


class FakeSpark:
    def __init__(self):
        self.read = Recorder()
        self.readStream = Recorder()


def test_kafka_options():
    options = S.kafka_stream_options("h:1", "t", max_per_trigger=5)
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "5" and options["subscribe"] == "t"
    bounded = S.kafka_batch_options("h:1", "t")
    assert (bounded["startingOffsets"], bounded["endingOffsets"]) == ("earliest", "latest")
    with pytest.raises(ValueError):
        S.kafka_batch_options("h:1", "t", start="latest")


def test_jdbc_reads_pass_their_options():
    spark = FakeSpark()
    options = R.jdbc_options("jdbc:x", user="u", partition_column="id", lower=0, upper=9, partitions=3)
    seen = R.read_table(spark, options, "user_demographics")
    assert seen["format"] == "jdbc" and seen["dbtable"] == "user_demographics" and seen["numPartitions"] == "3"
    assert R.read_query(FakeSpark(), options, "select 1")["dbtable"] == "(select 1) q"
    assert R.read_query(FakeSpark(), R.jdbc_options("jdbc:x"), "select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x", partition_column="id")


def test_lookup_forms(spark):
    users = spark.range(5000).selectExpr("cast(id as int) as id")
    assert R.lookup_by_ids(users, []).count() == 0 and R.lookup_by_ids(users, []).columns == ["id"]
    assert sorted(r.id for r in R.lookup_by_ids(users, [3, 4, 9999]).collect()) == [3, 4]
    assert R.lookup_by_ids(users, list(range(2000))).count() == 2000
    repeated = spark.createDataFrame([(7,), (7,), (None,)], "u int")
    assert [r.id for r in R.lookup_by_ids(users, repeated).collect()] == [7]


def test_lookup_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    plan = R.lookup_by_ids(spark.read.parquet(str(tmp_path / "t")), [3, 4])
    assert "In(id, [3,4])" in plan._jdf.queryExecution().executedPlan().toString()


def test_long_lists_of_ids_are_joined(spark):
    rows = spark.range(3000).selectExpr("id % 7 as other", "id")
    ids = [*range(R.MAX_LITERALS), 5, "x", None, 2999]
    found = R.lookup_by_ids(rows, ids)
    assert found.columns == rows.columns == R.lookup_by_ids(rows, ids[:3]).columns
    assert sorted(r.id for r in found.collect()) == [*range(R.MAX_LITERALS), 2999]
    assert " IN (" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_csv_keeps_nulls_and_types(spark, tmp_path):
    path = csv(tmp_path, ["1,30,,S,US,2023-01-01,,", "x,abc,Male,S,US,nodate,<30k,2024-01-01"])
    rows = R.read_demographics_csv(spark, path).collect()
    assert (rows[0].gender, rows[0].income_bracket, str(rows[0].registration_date)) == (None, None, "2023-01-01")
    assert (rows[1].id, rows[1].age, rows[1].registration_date) == (None, None, None)


def test_csv_headers_are_checked_in_every_file(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("id,age,country\n1,30,US\n")
    (tmp_path / "d" / "b.csv").write_text("id,country,age\n2,US,30\n")
    with pytest.raises(Exception, match="(?i)header"):
        R.read_demographics_csv(spark, str(tmp_path / "d")).collect()


def test_lookup_takes_ids_of_any_type_and_number(spark):
    rows = spark.range(3000)
    assert R.lookup_by_ids(rows, ["5", 7, "x", None]).count() == 2
    assert R.lookup_by_ids(rows, [str(i) for i in range(1500)]).count() == 1500
    assert R.lookup_by_ids(rows, []).count() == 0


def test_insert_ignore_takes_the_first_by_order(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    new = spark.createDataFrame([(2, "b"), (2, "a"), (1, "c")], "id int, v string")
    assert sorted((r.id, r.v) for r in K.insert_ignore(target, new, ["id"], ["v"]).collect()) == [(1, "old"), (2, "a")]


def test_one_label_for_unknown_genders(spark):
    rows = spark.createDataFrame([(1, None, "US"), (2, "unknown", "US")], "age int, gender string, country string")
    found = [r for r in D.verify_load(rows).collect() if r.statistic.startswith("gender")]
    assert [(r.statistic, r.value) for r in found] == [("gender unknown", 2)]


def test_incremental_marks(spark):
    rows = spark.sql("select timestamp'2024-01-01' + make_interval(0,0,0,id) as t from range(5)")
    assert R.read_since(rows, "t").count() == 5
    assert R.read_since(rows, "t", "2024-01-03").count() == 2
    mark = R.next_high_water(rows, "t", None).first()[0]
    assert R.read_since(rows, "t", str(mark)).count() == 0
    assert R.next_high_water(rows.limit(0), "t", mark).first()[0] == mark


def test_insert_ignore(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "x"), (2, "x"), (None, "n"), (None, "n")], "id int, v string")
    rows = sorted((r.id or 0, r.v) for r in K.insert_ignore(target, new, ["id"]).collect())
    assert rows == [(0, "n"), (0, "n"), (1, "old"), (2, "x")]


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    K.overwrite_table(spark.range(5), path)
    K.overwrite_table(spark.range(3), path)
    with pytest.raises(Exception):
        K.overwrite_table(spark.range(9).select(F.assert_true(F.col("id") < 0), "id"), path)
    loaded = read_current(spark, path)
    assert loaded.count() == 3 and {"created_at", "updated_at"} <= set(loaded.columns)
    K.append_rows(loaded, str(tmp_path / "u"))
    K.append_rows(loaded, str(tmp_path / "u"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 6


def test_refresh_publishes(spark, tmp_path):
    target = str(tmp_path / "dim")
    result = D.refresh_demographics(spark, csv(tmp_path, people(1200)), target)
    assert result["statistics"]["total_users"] == 1200 and result["previous"] is None
    assert result["verification"]["total_records"] == 1200
    again = D.refresh_demographics(spark, csv(tmp_path, people(1300)), target)
    assert read_current(spark, target).count() == 1300
    assert spark.read.parquet(again["previous"]).count() == 1200


@pytest.mark.parametrize(
    "lines",
    [people(10), people(1200, age=0), [*people(1200), people(1)[0]], people(1200, age="abc"), [*people(1200), "abc" + people(1)[0][1:]]],
    ids=["too few", "bad age", "duplicate", "age missing", "no id"],
)
def test_failed_refresh_leaves_the_target(spark, tmp_path, lines):
    target = str(tmp_path / "dim")
    D.refresh_demographics(spark, csv(tmp_path, people(1200)), target)
    before = sorted(child_names(spark, target))
    with pytest.raises(Q.QualityError):
        D.refresh_demographics(spark, csv(tmp_path, lines), target)
    assert sorted(child_names(spark, target)) == before


def test_missing_csv_column_fails(spark, tmp_path):
    path = csv(tmp_path, ["1,30"], "id,age\n")
    with pytest.raises(Q.QualityError, match="gender"):
        D.refresh_demographics(spark, path, str(tmp_path / "dim"))


def test_missing_csv_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        D.refresh_demographics(spark, str(tmp_path / "no.csv"), str(tmp_path / "dim"))


def test_catalog_check(spark):
    spark.range(4).createOrReplaceTempView("four_rows")
    rows = {r.table_name: (r.table_exists, r.row_count) for r in R.catalog_summary(spark, ["four_rows", "nope"]).collect()}
    assert rows == {"four_rows": (True, 4), "nope": (False, None)}


def test_broadcast_only_within_the_limit(spark, tmp_path):
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(table))
    assert not hinted(broadcast_if_small(table, 1000))


def test_topic_writers_send_records(spark, monkeypatch):
    import json

    from tallyriver.streaming import sinks as SK

    sent = []

    class Writer:
        def __init__(self, frame, servers, topic):
            self.row, self.to = frame.first(), (servers, topic)

        def save(self):
            sent.append((self.to, self.row.key, json.loads(self.row.value)))

    monkeypatch.setattr(SK, "kafka_writer", Writer)
    SK.topic_writer("h:1", "events")(spark.sql("select 7 as user_id, 'click' as event_type"), 0)
    bad = spark.sql("select 'missing value' as error_reason, binary('k') as key, binary('{x') as raw_value, 3L as offset")
    SK.topic_writer("h:1", "dead", dead_letters=True)(bad, 0)
    assert sent == [
        (("h:1", "events"), "7", {"user_id": 7, "event_type": "click"}),
        (("h:1", "dead"), "k", {"error_reason": "missing value", "offset": 3, "raw_value": "{x"}),
    ]
    monkeypatch.undo()
    options = Recorder()
    frame = type("Frame", (), {"write": options})()
    K.kafka_writer(frame, "h:1", "events")
    assert options.seen == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "kafka.acks": "all", "topic": "events"}
