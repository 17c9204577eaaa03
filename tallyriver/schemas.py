"""Declared schemas of events and tables, and the values they allow.

Counts in the summary table are BIGINT and its rate has 14 digits before the
point, so sums over very large inputs do not overflow.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("units", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField(
            "shipping_address",
            T.StructType(
                [
                    T.StructField("country", T.StringType()),
                    T.StructField("state", T.StringType()),
                    T.StructField("city", T.StringType()),
                    T.StructField("postal_code", T.StringType()),
                ]
            ),
        ),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Fields an event must carry in its Avro form; all others may be null there.
EVENT_REQUIRED = ("event_type", "user_id", "campaign_id", "timestamp")

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

DEMOGRAPHICS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("registration_date", T.DateType()),
        T.StructField("income_bracket", T.StringType()),
        T.StructField("last_login", T.DateType()),
    ]
)
DEMOGRAPHICS_REQUIRED = ("id", "age", "gender", "state", "country")

CAMPAIGNS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("type", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("budget", T.DecimalType(10, 2)),
        T.StructField("target_audience", T.StringType()),
    ]
)

PRODUCTS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("cost", T.DecimalType(10, 2)),
        T.StructField("description", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

SUMMARY_KEYS = ("date", "hour", "event_type", "campaign_id", "country")

EVENT_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("unique_users", T.LongType()),
        T.StructField("total_revenue", T.DecimalType(18, 2)),
        T.StructField("avg_order_value", T.DecimalType(18, 2)),
        T.StructField("conversion_rate", T.DecimalType(18, 4)),
    ]
)

POINT_SCHEMA = T.StructType(
    [
        T.StructField("measurement", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("fields", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("int_fields", T.MapType(T.StringType(), T.LongType())),
        T.StructField("text_fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("time", T.TimestampType()),
    ]
)

# The domains of the enumerated columns.
CAMPAIGN_TYPES = ("seasonal", "promotional", "regular")
PRODUCT_STATUSES = ("active", "inactive", "discontinued")

_AVRO_NAMES = {
    T.StringType: "string",
    T.IntegerType: "int",
    T.LongType: "long",
    T.DoubleType: "double",
    T.BooleanType: "boolean",
}


def avro_schema(
    schema: T.StructType = EVENT_SCHEMA,
    name: str = "UserEvent",
    required: tuple[str, ...] = EVENT_REQUIRED,
) -> str:
    """The Avro record schema of ``schema`` as JSON text.

    Fields in ``required`` are plain, all others a union with null.
    """

    def type_of(data_type: T.DataType, path: str):
        if isinstance(data_type, T.StructType):
            return {
                "type": "record",
                "name": path,
                "fields": [
                    {"name": f.name, "type": ["null", type_of(f.dataType, f"{path}_{f.name}")], "default": None}
                    for f in data_type
                ],
            }
        if isinstance(data_type, T.MapType):
            return {"type": "map", "values": type_of(data_type.valueType, path)}
        return _AVRO_NAMES[type(data_type)]

    fields = []
    for field in schema:
        avro = type_of(field.dataType, field.name)
        if field.name in required:
            fields.append({"name": field.name, "type": avro})
        else:
            fields.append({"name": field.name, "type": ["null", avro], "default": None})
    return json.dumps({"type": "record", "name": name, "fields": fields})
