"""The registered queries: every operator run over the given tables.

Results are made portable between engines: dates and times as text, decimals
as double.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.functions import columns as C
from tallyriver.operators import dimension as D
from tallyriver.operators import enrichment as J
from tallyriver.operators import events as E
from tallyriver.operators import metrics as M
from tallyriver.operators import points as TS
from tallyriver.operators import quality as Q
from tallyriver.operators import sessions as W
from tallyriver.operators import summary as U
from tallyriver.plans import fixtures as X
from tallyriver.sinks import tables as K
from tallyriver.sources import events as S
from tallyriver.sources import point_store as PS
from tallyriver.sources import tables as R
from tallyriver.storage import read_current, shared_folder
from tallyriver.streaming import late as SL
from tallyriver.streaming import metrics as SM
from tallyriver.streaming import run as SR
from tallyriver.streaming import sessions as SS
from tallyriver.streaming import sinks as SK
from tallyriver.streaming import upsert as SU

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as double, in the given column order."""

    def form(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, TIME_FORMAT).alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*[form(f) for f in df.schema])


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
    return fn


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return J.enrich(X.events(spark, sf), X.demographics(spark, sf))


def _transformed(spark: SparkSession, sf: str) -> DataFrame:
    return E.enriched_events(X.events(spark, sf), X.demographics(spark, sf))


def _shaped(spark: SparkSession, sf: str) -> DataFrame:
    """Transformed without the session columns, where no result needs them."""
    enriched = _enriched(spark, sf)
    shaped = E.with_business_metrics(E.with_time_features(E.with_event_categories(enriched)))
    return E.with_quality_flags(E.clean_events(shaped))


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return M.hourly_rollup(_shaped(spark, sf))


# --- sources ---------------------------------------------------------------


@query
def decode_envelope(spark, sf):
    records = S.project_envelope(X.envelope(X.events(spark, sf)))
    return records.select("key", "topic", "partition", "offset", "kafka_timestamp", F.col("value").isNotNull().alias("has_value"))


@query
def decode_json_events(spark, sf):
    """All seventeen fields, the struct and the map included."""
    events = S.events_from_envelope(X.envelope(X.wide_events(spark, sf)), derived=False)
    address = [F.col(f"shipping_address.{c}").alias(f"to_{c}") for c in ("country", "state", "city", "postal_code")]
    return events.select(
        "key", "event_type", "user_id", "campaign_id", "timestamp", "session_id", "product_id", "order_id", "units",
        "unit_price", "total_amount", "currency", "page_url", "user_agent", "ip_address", "payment_method", *address,
        F.col("metadata")["product"].alias("meta_product"), F.size("metadata").alias("meta_size"), "partition", "offset",
    )


@query
def parse_event_time(spark, sf):
    events = S.decode_events(S.project_envelope(X.envelope(X.events(spark, sf))))
    timed = S.with_event_time(events)
    return timed.select("offset", "timestamp", F.col("processing_time").isNotNull().alias("has_processing_time"))


@query
def date_parts(spark, sf):
    return S.with_date_parts(X.events(spark, sf)).select("event_id", "year", "month", "day", "hour")


@query
def drop_null_events(spark, sf):
    events = S.events_from_envelope(X.envelope(X.events(spark, sf), dirty=True))
    return events.select("offset", "event_type", "user_id", "year", "month", "day", "hour")


@query
def lookup_by_ids(spark, sf):
    return R.lookup_by_ids(X.demographics(spark, sf), X.events(spark, sf).select("user_id"))


@query
def get_user(spark, sf):
    return R.lookup_by_ids(X.demographics(spark, sf), [42])


@query
def table_row_count(spark, sf):
    return R.table_stats(X.events(spark, sf))


@query
def table_catalog_check(spark, sf):
    X.events(spark, sf).createOrReplaceTempView("tr_user_events")
    X.demographics(spark, sf).createOrReplaceTempView("tr_user_demographics")
    return R.catalog_summary(spark, ["tr_user_events", "tr_user_demographics", "tr_no_such_table"])


@query
def point_range_read(spark, sf):
    first = TS.first_points(TS.event_points(_shaped(spark, sf)), "20 days", "user_events", 10, X.AS_OF)
    return _long(TS.read_points(TS.points_long(first), "20 days", "user_events", 10, X.AS_OF), TS.EVENT_TAGS)


@query
def incremental_read(spark, sf):
    return R.read_since(X.events(spark, sf), "timestamp", "2024-01-15 12:00:00")


@query
def high_water_mark(spark, sf):
    return R.next_high_water(X.events(spark, sf), "timestamp", "2024-01-15 12:00:00")


# --- sinks -----------------------------------------------------------------


@query
def debug_projection(spark, sf):
    return E.debug_view(_enriched(spark, sf))


@query
def kafka_json_sink(spark, sf):
    records = K.to_kafka_records(X.events(spark, sf))
    event = F.from_json("value", "event_id bigint, user_id int, event_type string, total_amount double")
    return records.select("key", event.alias("event")).select("key", "event.*")


@query
def kafka_json_full(spark, sf):
    """All fields of the sent JSON, read back."""
    events = X.events(spark, sf)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    records = K.to_kafka_records(events)
    return records.select("key", F.from_json("value", fields).alias("event")).select("key", "event.*")


@query
def insert_if_absent(spark, sf):
    known = X.demographics(spark, sf).select("id", "age", "gender", "country")
    seen = X.events(spark, sf).select(
        F.col("user_id").alias("id"),
        F.lit(30).alias("age"),
        F.lit("Other").alias("gender"),
        F.lit("US").alias("country"),
    )
    return K.insert_ignore(known, seen, ["id"])


@query
def csv_write(spark, sf):
    """CSV with header, written and read back."""
    path = shared_folder(spark, "csv")
    K.write_csv(X.demographics(spark, sf), path)
    return R.read_demographics_csv(spark, path)


@query
def overwrite_load(spark, sf):
    """Two full reloads into one target; the second replaces the first."""
    path = shared_folder(spark, "reload")
    rows = X.demographics(spark, sf)
    K.overwrite_table(rows, path)
    K.overwrite_table(rows, path)
    loaded = read_current(spark, path)
    return loaded.withColumns(
        {"created_at": F.col("created_at").isNotNull(), "updated_at": F.col("updated_at").isNotNull()}
    )


@query
def append_rows(spark, sf):
    path = shared_folder(spark, "append")
    summary = _summary(spark, sf)
    K.append_rows(summary, path)
    K.append_rows(M.hourly_rollup(_shaped(spark, sf).withColumn("event_type", F.lit("all"))), path)
    return spark.read.parquet(path)


@query
def refresh_demographics(spark, sf):
    """CSV to published dimension through every check; the smallest table has 150 users."""
    csv, target = shared_folder(spark, "incoming"), shared_folder(spark, "dimension")
    K.write_csv(X.demographics(spark, sf), csv)
    D.refresh_demographics(spark, csv, target, gate={"min_users": 100})
    return read_current(spark, target).drop("created_at", "updated_at")


# --- event columns ---------------------------------------------------------


@query
def age_group(spark, sf):
    return J.with_age_group(X.demographics(spark, sf)).select("id", "age", "age_group")


@query
def region(spark, sf):
    return J.with_region(_enriched(spark, sf).drop("region")).select("event_id", "country", "region")


@query
def days_since_registration(spark, sf):
    return _enriched(spark, sf).select("event_id", "registration_date", "days_since_registration")


@query
def event_category(spark, sf):
    return E.with_event_categories(X.events(spark, sf)).select(
        "event_id", "event_type", "event_category", "is_conversion", "is_high_value"
    )


@query
def time_features(spark, sf):
    return E.with_time_features(X.events(spark, sf)).select(
        "event_id", "day_of_week", "hour_of_day", "is_weekend", "time_of_day", "quarter"
    )


@query
def business_metrics(spark, sf):
    return E.with_business_metrics(X.events(spark, sf)).select("event_id", "revenue", "quantity", "campaign_type")


@query
def transform_all(spark, sf):
    return _transformed(spark, sf)


@query
def clean_filter(spark, sf):
    events = S.events_from_envelope(X.envelope(X.events(spark, sf), dirty=True))
    return E.clean_events(events).select("offset", "user_id", "event_type", "timestamp")


@query
def quality_flags(spark, sf):
    return E.with_quality_flags(_enriched(spark, sf)).select("event_id", "has_demographics", "data_quality_score")


@query
def processing_metadata(spark, sf):
    stamped = E.with_processing_metadata(X.events(spark, sf))
    return stamped.select("event_id", F.col("processed_at").isNotNull().alias("is_stamped"), "processing_version")


@query
def processing_delay(spark, sf):
    raw = X.table(spark, sf, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    event_time = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    timed = raw.select("event_id", event_time.alias("a"), (F.col("ts") + F.make_dt_interval(secs=k)).cast("string").alias("b"))
    return E.with_delay(timed, "a", "b").select("event_id", "processing_delay")


@query
def safe_json_map(spark, sf):
    raw = X.table(spark, sf, "events")
    text = F.when(F.col("event_type") == "error", F.lit("{bad")).when(F.col("event_type") != "view", F.col("props"))
    parsed = raw.select("event_id", C.json_map(text).alias("m"))
    return parsed.select("event_id", F.size("m").alias("entries"), F.col("m")["k"].alias("k"))


@query
def normalise_time(spark, sf):
    raw = X.table(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(F.col("event_type") == "error", F.lit("yesterday"))
        .when(F.col("event_type") == "view", F.concat(iso, F.lit("Z")))
        .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(iso)
    )
    return raw.select("event_id", C.normalise_time(text, F.lit(X.AS_OF).cast("timestamp")).alias("event_time"))


@query
def demographics_view(spark, sf):
    return J.demographics_grouped(X.demographics(spark, sf), X.AS_OF)


@query
def late_data_filter(spark, sf):
    """The grace period before the newest moment of the fixture's month."""
    return E.drop_late(X.events(spark, sf), "timestamp", 7 * 24 * 60, X.AS_OF)


@query
def retention_prune(spark, sf):
    return E.retain(X.events(spark, sf), "timestamp", 7, X.AS_OF)


# --- joins -----------------------------------------------------------------


@query
def enrich_left_join(spark, sf):
    return _enriched(spark, sf)


@query
def enrich_salted(spark, sf):
    """The form for streams with a large dimension and hot users."""
    return J.enrich(X.events(spark, sf), X.demographics(spark, sf), salts=4)


@query
def refreshable_lookup(spark, sf):
    lookup = J.Lookup(lambda: X.demographics(spark, sf), ttl=3600, check=Q.require_unique)
    joined = J.enrich(X.events(spark, sf), lookup.get()).groupBy("country", "age_group")
    return joined.agg(F.count(F.lit(1)).alias("event_count"))


@query
def campaign_left_join(spark, sf):
    path = shared_folder(spark, "summary")
    K.append_rows(_summary(spark, sf), path)
    return J.campaign_join(X.campaigns(spark), spark.read.parquet(path))


# --- aggregations ----------------------------------------------------------


@query
def minute_metrics(spark, sf):
    return M.minute_metrics(X.events(spark, sf))


@query
def campaign_analytics(spark, sf):
    return M.campaign_analytics(_enriched(spark, sf))


@query
def approx_distinct_window(spark, sf):
    """Estimated users beside the exact ones: whether each lies within three standard errors."""
    rsd = 0.05
    estimate = M.minute_metrics(X.events(spark, sf), "1 day", distinct="approx", rsd=rsd)
    exact = M.minute_metrics(X.events(spark, sf), "1 day").select("window_start", "event_type", F.col("unique_users").alias("exact"))
    joined = estimate.join(exact, ["window_start", "event_type"])
    near = F.abs(F.col("unique_users") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * rsd * F.col("exact"))
    return joined.withColumn("within_bound", near).drop("unique_users", "exact")


@query
def exact_distinct_window(spark, sf):
    """Exact users per day from the bucketed partial groups that streams use."""
    partials = M.minute_partials(X.events(spark, sf), "1 day", buckets=8)
    return M.merge_minute_partials(partials)


@query
def sliding_metrics(spark, sf):
    return M.minute_metrics(X.events(spark, sf), "60 seconds", "10 seconds")


@query
def configurable_aggs(spark, sf):
    events = X.events(spark, sf).withColumn("amount", F.col("total_amount").cast(C.MONEY))
    result = M.aggregate(events, ["event_type", "campaign_id"], ["amount", "units"], ["count", "sum", "min", "max"])
    averages = M.aggregate(events, ["event_type", "campaign_id"], ["units"], ["avg"])
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("event_type", "campaign_id")]
    return result.alias("a").join(averages.alias("b"), same, "inner").select("a.*", "b.units_avg")


@query
def load_statistics(spark, sf):
    return D.load_statistics(X.demographics(spark, sf))


@query
def verify_load(spark, sf):
    return D.verify_load(X.demographics(spark, sf))


@query
def campaign_summary(spark, sf):
    return U.campaign_summary(X.campaigns(spark), _summary(spark, sf))


@query
def profile(spark, sf):
    facts = D.profile(X.demographics(spark, sf), ["age"], ["gender", "country"])
    return facts.withColumn("value", F.round("value", 6))


@query
def distribution_share(spark, sf):
    return M.type_shares(X.events(spark, sf))


@query
def hourly_rollup(spark, sf):
    return _summary(spark, sf)


# --- sessions --------------------------------------------------------------

_NUMBERED = ("event_id", "session_id", "session_event_number", "is_session_start")


@query
def session_event_number(spark, sf):
    return W.with_session_numbers(X.events(spark, sf)).select(*_NUMBERED)


@query
def session_event_number_split(spark, sf):
    """Sessions above three events count as hot and are numbered in slices."""
    return W.with_session_numbers(X.events(spark, sf), hot_rows=3).select(*_NUMBERED)


@query
def session_event_number_literal(spark, sf):
    """Events without a session are numbered together, and that group is split."""
    return W.with_session_numbers(X.events(spark, sf), null_session="group", hot_rows=500).select(*_NUMBERED)


@query
def session_start(spark, sf):
    return W.session_starts(X.events(spark, sf))


# --- sorts and limits ------------------------------------------------------


@query
def latest_events(spark, sf):
    events = S.events_from_envelope(X.envelope(X.events(spark, sf)), derived=False)
    return S.latest_events(events, 100, ("kafka_timestamp", "offset")).select("offset", "event_type", "kafka_timestamp")


@query
def country_distribution(spark, sf):
    return D.country_distribution(X.demographics(spark, sf))


@query
def top_countries(spark, sf):
    return D.top_countries(X.demographics(spark, sf), 5)


# --- summary table ---------------------------------------------------------


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Purchases as the target, and the deltas of every event type in a fixed order, under common keys."""
    shaped = _shaped(spark, sf)
    target = M.hourly_rollup(shaped.filter(F.col("event_type") == "purchase").withColumn("event_type", F.lit("any")))
    deltas = M.hourly_rollup(shaped)
    order = F.array_position(F.array(*[F.lit(t) for t in ("click", "view", "purchase", "signup", "error")]), F.col("event_type"))
    return target, deltas.withColumn("step", order).withColumn("event_type", F.lit("any"))


@query
def upsert_summary(spark, sf):
    target, deltas = _halves(spark, sf)
    return U.upsert_summary(target, deltas, "step")


@query
def upsert_summary_literal(spark, sf):
    target, deltas = _halves(spark, sf)
    return U.upsert_summary(target, deltas, "step", literal=True)


@query
def campaign_performance(spark, sf):
    return U.campaign_performance(_summary(spark, sf), "SUMMER2024", "2024-01-05", "2024-01-25")


#: registers of the queries' sketches, as a binary logarithm
REGISTERS = 12


def _near_exact(report, spark, sf):
    """A day's exact users beside the report, and whether the estimate lies within three standard errors of them."""
    events = _enriched(spark, sf).filter(F.col("campaign_id") == "SUMMER2024")
    exact = events.groupBy(F.to_date("timestamp").alias("summary_date")).agg(F.count_distinct("user_id").alias("distinct_users"))
    bound = F.greatest(F.lit(1.0), 3 * 1.04 / 2 ** (REGISTERS / 2) * F.col("distinct_users"))
    near = F.abs(F.col("estimated_unique_users") - F.col("distinct_users")) <= bound
    return report.join(exact, "summary_date").withColumn("within_bound", near).drop("estimated_unique_users")


@query
def campaign_performance_users(spark, sf):
    """Distinct users of a day from sketches that an upsert has united, beside the sum of hourly users."""
    shaped = _shaped(spark, sf)
    early = F.minute("timestamp") < 30
    first, then = (M.hourly_rollup(shaped.filter(part), sketch=REGISTERS) for part in (early, ~early))
    united = U.upsert_summary(first, then.withColumn("step", F.lit(1)), "step")
    report = U.campaign_performance(united, "SUMMER2024", "2024-01-05", "2024-01-25")
    wanted = report.select("campaign_id", "summary_date", "total_events", "total_revenue", "estimated_unique_users")
    return _near_exact(wanted, spark, sf)


# --- data quality ----------------------------------------------------------


@query
def null_counts(spark, sf):
    wanted = ["user_id", "campaign_id", "session_id", "total_amount", "country", "no_such_column"]
    return Q.null_counts(_enriched(spark, sf), wanted)


@query
def freshness(spark, sf):
    return Q.freshness(X.events(spark, sf), "timestamp", 10, X.AS_OF)


def _flawed(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension with flaws: twice the suppliers, some ages missing or out of range."""
    supplier = X.table(spark, sf, "supplier").select(
        (F.lit(2_000_000_000) + F.col("s_suppkey")).cast("int").alias("id"),
        F.when(F.col("s_nationkey") < 5, F.lit(None)).otherwise(F.col("s_nationkey") * 10).cast("int").alias("age"),
        F.lit("Other").alias("gender"),
        F.when(F.col("s_nationkey") != 7, F.lit("State_0")).alias("state"),
        F.lit("US").alias("country"),
    )
    base = X.demographics(spark, sf).select(*supplier.columns)
    return base.unionByName(supplier).unionByName(supplier)


@query
def demographics_validation(spark, sf):
    verdict = Q.validate_demographics(_flawed(spark, sf))
    return verdict.withColumn("missing_columns", F.size("missing_columns"))


@query
def invalid_rows(spark, sf):
    return Q.invalid_rows(_flawed(spark, sf))


@query
def quality_gate(spark, sf):
    return Q.quality_gate(D.load_statistics(X.demographics(spark, sf)))


@query
def share_gate(spark, sf):
    return Q.share_gate(X.events(spark, sf))


@query
def field_requirements(spark, sf):
    return Q.required_fields(X.events(spark, sf))


@query
def dead_letter(spark, sf):
    _, bad = Q.split_bad(S.project_envelope(X.envelope(X.events(spark, sf), dirty=True)))
    return bad.select("error_reason", "key", F.col("raw_value").isNotNull().alias("has_value"), "topic", "partition", "offset")


@query
def dead_letter_values(spark, sf):
    """The raw values of unusable records: the broken text, or the fields of JSON without a type."""
    _, bad = Q.split_bad(S.project_envelope(X.envelope(X.events(spark, sf), dirty=True)))
    return _raw_values(bad)


def _raw_values(bad: DataFrame) -> DataFrame:
    raw = F.col("raw_value").cast("string")
    names = ("user_id", "campaign_id", "session_id", "product_id", "timestamp", "event_type")
    fields = [F.get_json_object(raw, f"$.{n}").alias(f"raw_{n}") for n in names]
    broken = F.when(F.col("error_reason") == "malformed json", raw).alias("raw_text")
    return bad.select("error_reason", "offset", F.col("raw_value").isNotNull().alias("has_value"), broken, *fields)


@query
def dead_letter_good(spark, sf):
    good, _ = Q.split_bad(S.project_envelope(X.envelope(X.events(spark, sf), dirty=True)))
    return good.select("key", "event_type", "user_id", "total_amount", "partition", "offset")


@query
def error_counts(spark, sf):
    _, bad = Q.split_bad(S.project_envelope(X.envelope(X.events(spark, sf), dirty=True)))
    return Q.error_summary(bad)


@query
def enumeration_check(spark, sf):
    """Events whose type is not one of the model's."""
    return Q.allowed_values(X.events(spark, sf), "event_type", ["click", "view", "cart_add", "purchase"])


# --- points ----------------------------------------------------------------


def _long(long: DataFrame, tags) -> DataFrame:
    flat = [F.col("tags")[t].alias(f"tag_{t}") for t in tags]
    return long.select("measurement", *flat, "time", "field", "kind", "value", "text_value")


@query
def metrics_points(spark, sf):
    points = TS.metrics_points(M.minute_metrics(X.events(spark, sf)))
    return _long(TS.points_long(points), ("event_type",))


@query
def campaign_points(spark, sf):
    points = TS.campaign_points(M.campaign_analytics(_enriched(spark, sf)))
    return _long(TS.points_long(points), ("campaign_id", "country"))


@query
def event_points(spark, sf):
    return _long(TS.points_long(TS.event_points(_shaped(spark, sf))), TS.EVENT_TAGS)


@query
def merge_points(spark, sf):
    """Hourly points of each type and country: the latest event's values win."""
    hourly = _shaped(spark, sf).withColumn("at", F.date_trunc("hour", "timestamp"))
    tags = ("event_type", "country", "event_id")
    long = TS.points_long(TS.to_points(hourly, "hourly", tags, ("user_id", "total_amount"), "at"))
    ordered = long.withColumn("n", F.col("tags")["event_id"].cast("bigint")).withColumn(
        "tags", F.map_filter("tags", lambda k, _: k != "event_id")
    )
    return _long(TS.merge_points(ordered, "n"), ("event_type", "country"))


@query
def bridge_points(spark, sf):
    raw = X.events(spark, sf).withColumns(
        {
            "amount": F.coalesce(F.col("total_amount").cast(C.MONEY).cast("string"), F.lit("none")),
            "quantity": F.col("units"),
            "country": F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.lit("US")),
        }
    )
    return _long(TS.points_long(TS.bridge_points(raw)), ("event_type", "campaign_id", "country"))


@query
def custom_point(spark, sf):
    points = TS.to_points(X.events(spark, sf), "orders", ("event_type",), ("units", "order_id"), "timestamp")
    return _long(TS.points_long(points), ("event_type",))


@query
def point_struct(spark, sf):
    flat = TS.point_struct(_shaped(spark, sf))
    return flat.select(
        "event_id", "measurement", "time",
        *[F.col(f"tags.{t}").alias(f"tag_{t}") for t in ("event_type", "campaign_id", "country", "age_group", "gender")],
        *[F.col(f"fields.{f}").alias(f"field_{f}") for f in ("user_id", "total_amount", "units", "revenue", "is_conversion")],
    )


@query
def point_lines(spark, sf):
    """The text form of whole-number points."""
    points = TS.to_points(
        X.events(spark, sf), "visits", ("event_type", "campaign_id"), (), "timestamp", flags=("user_id", "units")
    )
    return TS.point_lines(points)


def _point_store(spark, path):
    PS.register(spark)
    return spark.read.format(PS.FORMAT).load(path)


@query
def point_store_range(spark, sf):
    """Points of events and of minutes written to the store, and one measurement of two days read back."""
    path = shared_folder(spark, "points")
    PS.register(spark)
    events, minutes = TS.event_points(_shaped(spark, sf)), TS.metrics_points(M.minute_metrics(X.events(spark, sf)))
    PS.by_time(events.unionByName(minutes)).write.format(PS.FORMAT).mode("append").save(path)
    since, until = (F.lit(d).cast("timestamp") for d in ("2024-01-10", "2024-01-12"))
    stored = _point_store(spark, path)
    wanted = stored.filter((F.col("measurement") == "user_events") & (F.col("time") >= since) & (F.col("time") < until))
    return _long(TS.points_long(wanted), TS.EVENT_TAGS)


# --- streams ---------------------------------------------------------------


#: The files of a stream end in the middle of minutes and hours, so that windows span micro-batches.
CUT = 30.5
#: Every so many-th event of a stream with late events comes one file after its time.
DELAYED = 7


def _drain(start: Callable[[], object]) -> None:
    SR.run_available([start])


def _newest(written: DataFrame) -> DataFrame:
    """The last state of each window that update mode has written."""
    keys = ["window_start", "window_end", "event_type"]
    values = [c for c in written.columns if c not in (*keys, "batch_id")]
    return written.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in values])


@query
def stream_minute_metrics(spark, sf):
    """Append mode, exact users in two levels; windows past the watermark come out."""
    out, state = shared_folder(spark, "stream"), shared_folder(spark, "state")
    stream = M.minute_metrics(SK.with_watermark(X.events_stream(spark, sf, CUT)))
    schema = stream.schema
    _drain(lambda: SK.start_sink(stream, SK.parquet_writer(out), "append", "available", state))
    return spark.read.schema(schema).parquet(out).drop("batch_id")


@query
def stream_metrics_update(spark, sf):
    """Update mode, exact users from bucketed partial groups; the last state of each window."""
    out, parts, state = (shared_folder(spark, n) for n in ("stream", "parts", "state"))
    partials = M.minute_partials(SK.with_watermark(X.events_stream(spark, sf, CUT)), "1 hour")
    writer = SM.update_writer(parts, M.MINUTE_KEYS, M.merge_minute_partials, SK.parquet_writer(out), fold_every=2)
    _drain(lambda: SK.start_sink(partials, writer, "update", "available", state))
    return _newest(spark.read.parquet(out))


@query
def stream_campaign_analytics(spark, sf):
    """Complete mode, joined with the static dimension, exact users from partial groups."""
    out, state = shared_folder(spark, "stream"), shared_folder(spark, "state")
    events = J.enrich(SK.with_watermark(X.events_stream(spark, sf, CUT)), X.demographics(spark, sf))
    writer = SM.complete_writer(M.merge_campaign_partials, SK.latest_writer(out))
    partials = M.campaign_partials(events, buckets=8)
    _drain(lambda: SK.start_sink(partials, writer, "complete", "available", state))
    return read_current(spark, out)


@query
def stream_sliding_metrics(spark, sf):
    """Exact sliding windows in update mode; the last state of each window."""
    out, parts, state = (shared_folder(spark, n) for n in ("stream", "parts", "state"))
    events = SK.with_watermark(X.events_stream(spark, sf, CUT))
    partials = M.minute_partials(events, "60 seconds", buckets=4, slide="10 seconds")
    writer = SM.update_writer(parts, M.MINUTE_KEYS, M.merge_minute_partials, SK.parquet_writer(out), files_per_date=1)
    _drain(lambda: SK.start_sink(partials, writer, "update", "available", state))
    return _newest(spark.read.parquet(out))


@query
def stream_session_numbers(spark, sf):
    """Session numbers that go on over micro-batches."""
    out, counts, state = (shared_folder(spark, n) for n in ("stream", "sessions", "state"))
    writer = SS.session_writer(counts, SK.parquet_writer(out), fold_every=2)
    _drain(lambda: SK.start_sink(X.events_stream(spark, sf, CUT), writer, "append", "available", state))
    return spark.read.parquet(out).select(*_NUMBERED)


@query
def stream_enriched_events(spark, sf):
    """The main stream: session numbers, a dimension read again between batches, all derived columns."""
    out, counts, state = (shared_folder(spark, n) for n in ("stream", "sessions", "state"))
    lookup = J.Lookup(lambda: X.demographics(spark, sf), ttl=0, check=Q.require_unique)
    writer = SS.session_writer(counts, SR.event_writer(lookup, SK.parquet_writer(out), points=False))
    _drain(lambda: SK.start_sink(X.events_stream(spark, sf, CUT), writer, "append", "available", state))
    return spark.read.parquet(out).drop("batch_id")


@query
def stream_session_start(spark, sf):
    out, counts, state = (shared_folder(spark, n) for n in ("stream", "sessions", "state"))
    writer = SS.start_writer(counts, SK.parquet_writer(out))
    _drain(lambda: SK.start_sink(X.events_stream(spark, sf, CUT), writer, "append", "available", state))
    return spark.read.parquet(out).drop("batch_id")


@query
def stream_upsert(spark, sf):
    path, state = shared_folder(spark, "summary"), shared_folder(spark, "state")
    enriched = J.enrich(X.events_stream(spark, sf), X.demographics(spark, sf))
    shaped = E.clean_events(E.with_business_metrics(E.with_event_categories(enriched)))
    _drain(lambda: SU.start_upsert(shaped, path, state, "available"))
    SU.compact_summary(spark, path)
    return SU.read_summary(spark, path)


@query
def stream_upsert_folded(spark, sf):
    """The summary of a stream that folds its deltas by itself every other batch."""
    path, state = shared_folder(spark, "summary"), shared_folder(spark, "state")
    enriched = J.enrich(X.events_stream(spark, sf, CUT), X.demographics(spark, sf))
    shaped = E.clean_events(E.with_business_metrics(E.with_event_categories(enriched)))
    _drain(lambda: SU.start_upsert(shaped, path, state, "available", fold_every=2))
    return SU.read_summary(spark, path)


@query
def stream_upsert_sketches(spark, sf):
    """Distinct users of a day from the sketches of a streamed summary that folds by itself."""
    path, state = shared_folder(spark, "summary"), shared_folder(spark, "state")
    enriched = J.enrich(X.events_stream(spark, sf, CUT, DELAYED), X.demographics(spark, sf))
    shaped = E.clean_events(E.with_business_metrics(E.with_event_categories(enriched)))
    _drain(lambda: SU.start_upsert(shaped, path, state, "available", fold_every=2, sketch=REGISTERS))
    report = U.campaign_performance(SU.read_summary(spark, path), "SUMMER2024", "2024-01-05", "2024-01-25")
    wanted = report.select("campaign_id", "summary_date", "total_events", "total_revenue", "estimated_unique_users")
    return _near_exact(wanted, spark, sf)


@query
def stream_dead_letter(spark, sf):
    good, bad, state = (shared_folder(spark, n) for n in ("good", "bad", "state"))
    records = S.project_envelope(X.envelope(X.events_stream(spark, sf), dirty=True))
    writer = SK.dead_letter_writer(SK.parquet_writer(good), SK.parquet_writer(bad))
    _drain(lambda: SK.start_sink(records, writer, "append", "available", state))
    raw = F.when(F.col("error_reason") == "malformed json", F.col("raw_value").cast("string")).alias("raw_text")
    return spark.read.parquet(bad).select("error_reason", "key", raw, "topic", "partition", "offset")


@query
def stream_dead_letter_values(spark, sf):
    """The raw values of a stream's dead letters."""
    good, bad, state = (shared_folder(spark, n) for n in ("good", "bad", "state"))
    records = S.project_envelope(X.envelope(X.events_stream(spark, sf), dirty=True))
    writer = SK.dead_letter_writer(SK.parquet_writer(good), SK.parquet_writer(bad))
    _drain(lambda: SK.start_sink(records, writer, "append", "available", state))
    return _raw_values(spark.read.parquet(bad))


@query
def stream_dead_letter_good(spark, sf):
    """The decoded events beside a stream's dead letters."""
    good, bad, state = (shared_folder(spark, n) for n in ("good", "bad", "state"))
    records = S.project_envelope(X.envelope(X.events_stream(spark, sf), dirty=True))
    writer = SK.dead_letter_writer(SK.parquet_writer(good), SK.parquet_writer(bad))
    _drain(lambda: SK.start_sink(records, writer, "append", "available", state))
    return spark.read.parquet(good).select("key", "event_type", "user_id", "total_amount", "partition", "offset")


@query
def stream_points(spark, sf):
    """The main stream to its end: session numbers, enrichment, all columns, then points of all tags and fields."""
    out, counts, state = (shared_folder(spark, n) for n in ("stream", "sessions", "state"))
    lookup = J.Lookup(lambda: X.demographics(spark, sf), ttl=0, check=Q.require_unique)
    writer = SS.session_writer(counts, SR.event_writer(lookup, SK.parquet_writer(out)), fold_every=2)
    _drain(lambda: SK.start_sink(X.events_stream(spark, sf, CUT), writer, "append", "available", state))
    return _long(TS.points_long(spark.read.parquet(out).drop("batch_id")), TS.EVENT_TAGS)


@query
def stream_point_store(spark, sf):
    """A stream of points into the store, and a second stream that reads them from it."""
    path, out, first, second = (shared_folder(spark, n) for n in ("points", "stream", "state", "state"))
    PS.register(spark)
    enriched = J.enrich(X.events_stream(spark, sf, CUT), X.demographics(spark, sf))
    shaped = E.with_business_metrics(E.with_time_features(E.with_event_categories(enriched)))
    points = TS.event_points(E.with_quality_flags(E.clean_events(shaped)))
    sink = points.writeStream.format(PS.FORMAT).option("path", path).option("writer", "main").option("fold_every", 2)
    _drain(lambda: sink.option("checkpointLocation", first).trigger(availableNow=True).start())
    stored = spark.readStream.format(PS.FORMAT).load(path)
    _drain(lambda: SK.start_sink(stored, SK.parquet_writer(out), "append", "available", second))
    return _long(TS.points_long(spark.read.parquet(out).drop("batch_id")), TS.EVENT_TAGS)


@query
def stream_observed_metrics(spark, sf):
    """Rows, nulls and revenue of every batch, observed while it runs."""
    out, state, path = (shared_folder(spark, n) for n in ("stream", "state", "progress"))
    events = SR.observe_quality(X.events_stream(spark, sf), ["campaign_id", "session_id", "total_amount"])
    log = SR.ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        _drain(lambda: SK.start_sink(events, SK.parquet_writer(out), "append", "available", state))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    log.flush()
    progress = SR.progress_frame(spark, path).filter("records > 0")
    names = ("rows", "campaign_id_nulls", "session_id_nulls", "total_amount_nulls", "revenue")
    return progress.select("records", *[F.round(F.col("observed")[f"quality.{n}"], 2).alias(n) for n in names])


def _split_late(spark, sf, then=None):
    """The folder of the side table, after the whole stream; ``then`` gets the events on time, batch by batch."""
    kept, side, state = (shared_folder(spark, n) for n in ("on-time", "late", "state"))
    stream = X.events_stream(spark, sf, CUT, DELAYED)
    write = SK.whole_batch_writer(kept)
    if then is not None:
        write = SR.followed_by(write, lambda: then(spark.readStream.schema(stream.schema).parquet(f"{kept}/batch_id=*")))
    _drain(lambda: SK.start_sink(stream, SL.late_splitter(side, write, window="1 hour"), "append", "available", state))
    return side


@query
def stream_late_events(spark, sf):
    """The side table of late events: which batch brought them, and the watermark they were behind."""
    late = SL.read_late(spark, _split_late(spark, sf)).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return late.select("event_id", "timestamp", "event_type", "user_id", "total_amount", "late_reason", "watermark", "batch_id")


@query
def stream_late_counts(spark, sf):
    return SL.late_counts(spark, _split_late(spark, sf)).withColumn("batch_id", F.col("batch_id").cast("bigint"))


@query
def stream_on_time_windows(spark, sf):
    """Hourly windows of the events on time, by a second stream; with the side table they add up to all events."""
    out, parts, state = (shared_folder(spark, n) for n in ("stream", "parts", "state"))
    writer = SM.update_writer(parts, M.MINUTE_KEYS, M.merge_minute_partials, SK.parquet_writer(out), fold_every=2)

    def windows(on_time):
        partials = M.minute_partials(SK.with_watermark(on_time), "1 hour")
        return SK.start_sink(partials, writer, "update", "available", state)

    _split_late(spark, sf, windows)
    return _newest(spark.read.parquet(out))


@query
def stream_event_points(spark, sf):
    """Raw events as points in the text form."""
    out, state = shared_folder(spark, "lines"), shared_folder(spark, "state")
    points = TS.to_points(
        X.events_stream(spark, sf), "visits", ("event_type", "campaign_id"), (), "timestamp", flags=("user_id", "units")
    )
    _drain(lambda: SK.start_sink(points, SK.line_writer(out), "append", "available", state))
    return spark.read.text(out).select(F.col("value").alias("line"))


@query
def stream_batch_metrics(spark, sf):
    out, state = shared_folder(spark, "stream"), shared_folder(spark, "state")
    events, path = X.events_stream(spark, sf), shared_folder(spark, "progress")
    log = SR.ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        _drain(lambda: SK.start_sink(events, SK.parquet_writer(out), "append", "available", state))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    progress = SR.progress_frame(spark, path)
    return progress.agg(F.sum("records").alias("records"), F.min(F.col("records_per_second") >= 0).alias("has_rate"))

