"""The model's tables derived from the driver's tables.

``EVENTS_SQL`` and ``DEMOGRAPHICS_SQL`` are plain SQL that Spark and DuckDB
both read. Customers with a hole in the key pattern keep their row but get an
id no event uses, so some events stay unmatched without dropping any row.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyriver.schemas import CAMPAIGNS_SCHEMA
from tallyriver.storage import child_names, shared_folder

#: Parts of a stream, each a micro-batch.
FILES = 5
#: A part of more events has several files.
ROWS_PER_FILE = 100_000
AS_OF = "2024-01-31 00:00:00"

EVENTS_SQL = """
select cast(event_id as bigint) as event_id,
       ts as event_time,
       cast(user_id as int) as user_id,
       event_type,
       case k % 8 when 0 then 'SUMMER2024' when 1 then 'WINTER2024' when 2 then 'SPRING2024'
                  when 3 then 'FALL2024' when 4 then 'BLACKFRIDAY' when 5 then 'CYBER_MONDAY'
                  when 6 then 'OTHER2024' end as campaign_id,
       case when event_type <> 'purchase'
            then concat('sess_', cast(user_id as string), '_', cast(day(ts) as string)) end as session_id,
       concat('PROD_', cast(k % 50 as string)) as product_id,
       case when event_type = 'purchase' then concat('ORD_', cast(event_id as string)) end as order_id,
       case when event_type = 'purchase' then cast(k % 5 + 1 as int) end as units,
       case when event_type = 'purchase' then value end as total_amount
from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from {events}) e
"""

DEMOGRAPHICS_SQL = """
select cast(case when c_custkey % 7 = 3 then 1000000000 + c_custkey else c_custkey end as int) as id,
       cast(18 + (c_custkey * 7) % 48 as int) as age,
       case when c_custkey % 10 = 9 then 'Other' when c_custkey % 2 = 0 then 'Male' else 'Female' end as gender,
       concat('State_', cast(c_custkey % 10 as string)) as state,
       case c_nationkey % 11 when 1 then 'CA' when 2 then 'UK' when 3 then 'DE' when 4 then 'FR'
            when 5 then 'JP' when 6 then 'AU' when 7 then 'IN' when 8 then 'BR' when 9 then 'MX'
            else 'US' end as country,
       date '2022-01-01' + cast(c_custkey % 730 as int) as registration_date,
       c_mktsegment as income_bracket,
       date '2024-01-01' + cast(c_custkey % 31 as int) as last_login
from {customer}
"""

# The reference campaigns (id, name, type, start, end, budget, audience).
CAMPAIGNS = (
    ("SUMMER2024", "Summer Sale 2024", "seasonal", "2024-06-01", "2024-08-31", "50000.00", "All demographics"),
    ("WINTER2024", "Winter Collection", "seasonal", "2024-12-01", "2025-02-28", "75000.00", "Cold climate regions"),
    ("SPRING2024", "Spring Launch", "seasonal", "2024-03-01", "2024-05-31", "40000.00", "Young adults"),
    ("FALL2024", "Fall Fashion", "seasonal", "2024-09-01", "2024-11-30", "60000.00", "Fashion conscious"),
    ("BLACKFRIDAY", "Black Friday Deals", "promotional", "2024-11-29", "2024-11-29", "100000.00", "Bargain hunters"),
    ("CYBER_MONDAY", "Cyber Monday Sale", "promotional", "2024-12-02", "2024-12-02", "80000.00", "Online shoppers"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shape_events(raw: DataFrame) -> DataFrame:
    """The driver's events, bounded or streaming, as user events."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    purchase = F.col("event_type") == "purchase"
    names = ["SUMMER2024", "WINTER2024", "SPRING2024", "FALL2024", "BLACKFRIDAY", "CYBER_MONDAY", "OTHER2024"]
    ts = F.col("ts").cast("timestamp")
    return raw.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        ts.alias("timestamp"),
        F.col("user_id").cast("int").alias("user_id"),
        "event_type",
        F.get(F.array(*[F.lit(n) for n in names]), k % 8).alias("campaign_id"),
        F.when(
            ~purchase, F.concat(F.lit("sess_"), F.col("user_id").cast("string"), F.lit("_"), F.dayofmonth(ts).cast("string"))
        ).alias("session_id"),
        F.concat(F.lit("PROD_"), (k % 50).cast("string")).alias("product_id"),
        F.when(purchase, F.concat(F.lit("ORD_"), F.col("event_id").cast("string"))).alias("order_id"),
        F.when(purchase, (k % 5 + 1).cast("int")).alias("units"),
        F.when(purchase, F.col("value")).alias("total_amount"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shaped = spark.sql(EVENTS_SQL, events=table(spark, sf_dir, "events"))
    columns = [F.col("event_time").cast("timestamp").alias("timestamp") if c == "event_time" else c for c in shaped.columns]
    return shaped.select(*columns)


def wide_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the model's further fields, the address for purchases only."""
    purchase = F.col("event_type") == "purchase"
    user = F.col("user_id")
    address = F.struct(
        F.lit("US").alias("country"),
        F.concat(F.lit("State_"), (user % 10).cast("string")).alias("state"),
        F.lit(None).cast("string").alias("city"),
        user.cast("string").alias("postal_code"),
    )
    return events(spark, sf_dir).withColumns(
        {
            "unit_price": F.col("total_amount"),
            "currency": F.when(purchase, F.lit("USD")),
            "page_url": F.concat(F.lit("/p/"), F.col("product_id")),
            "user_agent": F.concat(F.lit('agent "'), (user % 3).cast("string"), F.lit('"')),
            "ip_address": F.concat(F.lit("10.0.0."), (user % 250).cast("string")),
            "payment_method": F.when(purchase, F.lit("card")),
            "shipping_address": F.when(purchase, address),
            "metadata": F.create_map(F.lit("product"), F.col("product_id"), F.lit("type"), F.col("event_type")),
        }
    )


def _data_files(spark: SparkSession, folder: str) -> int:
    return sum(name.endswith(".parquet") for name in child_names(spark, folder))


def event_files(spark: SparkSession, sf_dir: str, minutes: float = 0, delayed: int = 0) -> str:
    """All raw events in a folder in ``FILES`` parts, oldest first: six days each, cut ``minutes`` past midnight.

    With ``delayed`` every so many-th event (by id) comes one part after its time. All parts have as many files, one if
    they are small: as the largest needs, but no more than two for each core. So tasks share the writing and reading of
    a part, and so many files at a time are a part. Where a part has too few events for its files, empty ones fill up.
    """
    folder = shared_folder(spark, "event-files")
    raw = table(spark, sf_dir, "events")
    since = F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))
    part = F.greatest(F.lit(0), F.least(F.lit(FILES - 1), F.floor((since - 60 * minutes) / (6 * 86400))))
    if delayed:
        part = F.least(F.lit(FILES - 1), part + F.when(F.col("event_id") % delayed == 0, 1).otherwise(0))
    # one row for each part
    largest = raw.groupBy(part.alias("part")).count().agg(F.max("count").alias("n")).first()["n"] or 0
    files = max(1, min(-(-largest // ROWS_PER_FILE), 2 * spark.sparkContext.defaultParallelism))
    empty = spark.createDataFrame([], raw.schema).coalesce(1)
    for k in range(FILES):
        raw.filter(part == k).repartition(files).write.mode("append").parquet(folder)
        for _ in range((k + 1) * files - _data_files(spark, folder)):
            empty.write.mode("append").parquet(folder)
    return folder


def events_stream(spark: SparkSession, sf_dir: str, minutes: float = 0, delayed: int = 0) -> DataFrame:
    """The events of ``event_files`` as a stream, one part in each micro-batch."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = table(spark, sf_dir, "events").schema
    folder = event_files(spark, sf_dir, minutes, delayed)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", _data_files(spark, folder) // FILES)
    return shape_events(reader.parquet(folder))


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DEMOGRAPHICS_SQL, customer=table(spark, sf_dir, "customer"))


def campaigns(spark: SparkSession) -> DataFrame:
    rows = ", ".join(str(row) for row in CAMPAIGNS)
    text = spark.sql(f"select * from values {rows} as c({', '.join(CAMPAIGNS_SCHEMA.names)})")
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CAMPAIGNS_SCHEMA])


def envelope(events: DataFrame, dirty: bool = False) -> DataFrame:
    """Events as Kafka envelopes with JSON values.

    ``dirty`` makes errors malformed, takes the type from signups and the
    value from views, so that every kind of unusable record occurs.
    """
    fields = [c for c in events.columns if c not in ("event_id", "timestamp")]
    at = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    value = F.to_json(F.struct(*fields, at))
    if dirty:
        untyped = F.to_json(F.struct(*[c for c in fields if c != "event_type"], at))
        value = (
            F.when(F.col("event_type") == "error", F.concat(F.lit("{"), F.col("event_id").cast("string")))
            .when(F.col("event_type") == "signup", untyped)
            .when(F.col("event_type") == "view", F.lit(None))
            .otherwise(value)
        )
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("user_events").alias("topic"),
        F.pmod("user_id", F.lit(6)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("timestamp"),
    )
