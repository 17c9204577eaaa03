"""Table readers: JDBC, CSV, lookups by id, row counts and incremental reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.schemas import DEMOGRAPHICS_SCHEMA

#: Longer lists of ids are joined, not written into the plan.
MAX_LITERALS = 500


def jdbc_options(
    url: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Connection options; a partition column splits the scan over ``partitions`` tasks."""
    options = {"url": url, "fetchsize": str(fetch_size)}
    for name, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            options[name] = value
    if partition_column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partitioned scan needs lower, upper and partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return {**options, **(extra or {})}


def read_table(spark: SparkSession, options: Mapping[str, str], table: str) -> DataFrame:
    """A whole JDBC table; filters and column choices reach the database."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def read_query(spark: SparkSession, options: Mapping[str, str], sql: str) -> DataFrame:
    """The result of any SQL text the database accepts."""
    if "partitionColumn" in options:
        return spark.read.format("jdbc").options(**options).option("dbtable", f"({sql}) q").load()
    return spark.read.format("jdbc").options(**options).option("query", sql).load()


def lookup_by_ids(df: DataFrame, ids: Sequence | DataFrame, column: str = "id") -> DataFrame:
    """Rows whose id is among ``ids``: a list, or a frame whose first column holds them.

    Ids are cast to the column's type; what cannot be cast matches nothing. A list of up to ``MAX_LITERALS`` ids
    becomes a filter, which reaches the scan; a longer one becomes a frame and a semi-join.
    """
    data_type = df.schema[column].dataType
    if not isinstance(ids, DataFrame):
        texts = [None if i is None else str(i) for i in ids]
        if not texts:
            return df.filter(F.lit(False))
        if len(texts) <= MAX_LITERALS:
            return df.filter(F.col(column).isin(*[F.lit(t).try_cast(data_type) for t in texts]))
        ids = df.sparkSession.createDataFrame(pa.table({"id": pa.array(texts, pa.string())}))
    wanted = ids.select(F.col(ids.columns[0]).try_cast(data_type).alias("wanted__")).distinct()
    return df.join(wanted, df[column] == wanted["wanted__"], "left_semi")


def table_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def catalog_summary(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """One row per name: does the table exist, and its number of rows (NULL if absent)."""

    def one(name: str) -> DataFrame:
        if spark.catalog.tableExists(name):
            counted = table_stats(spark.table(name))
        else:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        return counted.select(
            F.lit(name).alias("table_name"),
            F.col("row_count").isNotNull().alias("table_exists"),
            "row_count",
        )

    return reduce(DataFrame.unionByName, [one(name) for name in names])


def read_demographics_csv(spark: SparkSession, path: str, schema: T.StructType = DEMOGRAPHICS_SCHEMA) -> DataFrame:
    """The dimension's CSV with header, columns taken by name from the file.

    All files must have the header of the first; a file with another one
    fails when it is read. Values that do not fit the declared type become NULL. Columns the header
    lacks are absent in the result, so that validation can report them.
    """
    header = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    typed = []
    for name in header.columns:
        if name in schema.names:
            typed.append(F.col(f"`{name}`").try_cast(schema[name].dataType).alias(name))
        else:
            typed.append(F.col(f"`{name}`"))
    return header.select(*typed)


def read_since(df: DataFrame, ts_col: str, high_water=None) -> DataFrame:
    """Rows newer than the mark; all rows if there is none yet."""
    if high_water is None:
        return df
    mark = high_water if not isinstance(high_water, str) else F.lit(high_water).cast(df.schema[ts_col].dataType)
    return df.filter(F.col(ts_col) > mark)


def next_high_water(df: DataFrame, ts_col: str, high_water=None) -> DataFrame:
    """One row with the new mark; the old one stays if there are no newer rows."""
    data_type = df.schema[ts_col].dataType
    return df.agg(F.greatest(F.max(ts_col), F.lit(high_water).cast(data_type)).alias("high_water"))
