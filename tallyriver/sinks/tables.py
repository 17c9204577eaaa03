"""Batch writers: full reload, inserts, appends, CSV and Kafka records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyriver.storage import publish


def with_load_times(df: DataFrame) -> DataFrame:
    return df.withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})


def overwrite_table(
    df: DataFrame,
    target: str,
    batch_size: int = 1000,
    jdbc: Mapping[str, str] | None = None,
) -> None:
    """Replace a table: a Parquet folder, or with ``jdbc`` options a database table.

    The folder gets a new version, and the one before stays in use until the
    new one is complete; read it with ``storage.read_current``. The database table is emptied rather than dropped, so its keys and indexes
    stay, and each task inserts in batches of ``batch_size``.
    """
    stamped = with_load_times(df)
    if jdbc is None:
        publish(stamped, target)
    else:
        jdbc_writer(stamped, target, batch_size, jdbc).mode("overwrite").save()


def jdbc_writer(df: DataFrame, table: str, batch_size: int, options: Mapping[str, str]):
    return (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("truncate", True)
    )


def insert_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The target and those new rows whose key it lacks; one row per new key.

    Of several new rows of one key the first by ``order`` is taken; without it
    they must be equal for the choice to be unique. NULL keys never match, so
    they are always inserted.
    """
    keyed = new.dropna(subset=list(keys))
    if order:
        first = Window.partitionBy(*keys).orderBy(*order)
        keyed = keyed.withColumn("__rank", F.row_number().over(first)).filter("__rank = 1").drop("__rank")
    else:
        keyed = keyed.dropDuplicates(list(keys))
    fresh = keyed.join(target.select(*keys), list(keys), "left_anti")
    any_null = F.col(keys[0]).isNull()
    for key in keys[1:]:
        any_null = any_null | F.col(key).isNull()
    return target.unionByName(fresh).unionByName(new.filter(any_null))


def append_rows(df: DataFrame, target: str) -> None:
    df.write.mode("append").parquet(target)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


#: times keep their microseconds, which JSON functions cut by default
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def to_kafka_records(df: DataFrame, user: str = "user_id") -> DataFrame:
    """Key = user id as text (NULL if missing or empty), value = the row as JSON."""
    key = F.nullif(F.col(user).cast("string"), F.lit(""))
    value = F.to_json(F.struct(*df.columns), {"timestampFormat": JSON_TIME})
    return df.select(key.alias("key"), value.alias("value"))


def kafka_writer(df: DataFrame, servers: str, topic: str):
    """The writer of key and value records to a topic, acknowledged by all replicas."""
    writer = df.write.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("kafka.acks", "all").option("topic", topic)


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Send rows as JSON records to a topic. Needs the Kafka package."""
    kafka_writer(to_kafka_records(df), servers, topic).save()


def dead_letter_records(bad: DataFrame) -> DataFrame:
    """Unusable records as they came, with the reason and their place in the source as JSON."""
    kept = [c for c in ("error_reason", "topic", "partition", "offset") if c in bad.columns]
    raw = F.col("raw_value").cast("string").alias("raw_value")
    return bad.select(F.col("key").cast("string").alias("key"), F.to_json(F.struct(*kept, raw)).alias("value"))
