"""The demographics dimension: statistics, checks and the full refresh."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyriver.operators.quality import QualityError, quality_gate, require_quality, validate_demographics
from tallyriver.schemas import DEMOGRAPHICS_REQUIRED, DEMOGRAPHICS_SCHEMA
from tallyriver.sinks.tables import with_load_times
from tallyriver.sources.tables import read_demographics_csv
from tallyriver.storage import current_folder, publish_staged, shared_folder, staged_folder


def load_statistics(df: DataFrame) -> DataFrame:
    """Users, distinct countries and states, mean age (0 if unknown), registration range."""
    return df.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_distinct("country").alias("countries"),
        F.count_distinct("state").alias("states"),
        F.coalesce(F.round(F.sum("age") / F.nullif(F.count("age"), F.lit(0)), 1), F.lit(0.0)).alias("avg_age"),
        F.min("registration_date").alias("earliest_registration"),
        F.max("registration_date").alias("latest_registration"),
    )


def verify_load(df: DataFrame) -> DataFrame:
    """Row count, distinct countries, age range and the count of each gender, as rows."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("country").alias("countries"),
        F.min("age").cast("bigint").alias("min_age"),
        F.max("age").cast("bigint").alias("max_age"),
    )
    names = ["total_records", "countries", "min_age", "max_age"]
    cells = [F.struct(F.lit(n).alias("statistic"), F.col(n).alias("value")) for n in names]
    label = F.concat(F.lit("gender "), F.coalesce("gender", F.lit("unknown"))).alias("statistic")
    genders = df.groupBy(label).agg(F.count(F.lit(1)).alias("value"))
    return totals.select(F.inline(F.array(*cells))).unionByName(genders)


def country_distribution(df: DataFrame) -> DataFrame:
    counts = df.groupBy("country").agg(F.count(F.lit(1)).alias("user_count"))
    return counts.orderBy(F.col("user_count").desc(), "country")


def top_countries(df: DataFrame, n: int = 5) -> DataFrame:
    return country_distribution(df).limit(n)


def _counted_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their counts and the number of smaller rows, stored in the order of the values.

    Values are dealt out by range. Each partition sums its own counts, and the sums of the partitions before, one row
    for each, are added, so no task gets all values. Columns ``v``, ``n`` and ``below``.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "profiled-values")
    value = F.col(column).cast("double")
    counts = df.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("v").isNotNull())
    # written, as bounds are sampled anew by every evaluation
    counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()).write.parquet(path)
    counts = spark.read.schema("v double, n bigint, part int").parquet(path)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"))
    # one row for each partition
    parts = parts.select("part", F.coalesce(F.sum("total").over(before.orderBy("part")), F.lit(0)).alias("offset"))
    inside = F.coalesce(F.sum("n").over(before.partitionBy("part").orderBy("v")), F.lit(0))
    counted = counts.withColumn("inside", inside).join(F.broadcast(parts), "part")
    return counted.select("v", "n", (F.col("inside") + F.col("offset")).alias("below"))


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Interpolated quantiles of a numeric column, whatever the number of its distinct values; None without values.

    Only the two neighbours of each rank come to the driver.
    """
    return _quantiles(_counted_values(df, column), shares)


def _quantiles(counted: DataFrame, shares: Sequence[float]) -> list[float | None]:
    total = counted.agg(F.sum("n").alias("n")).first()["n"] or 0
    if not total:
        return [None] * len(shares)
    ranks = [share * (total - 1) for share in shares]
    wanted = sorted({int(r) for r in ranks} | {min(int(r) + 1, total - 1) for r in ranks})
    hit = reduce(lambda a, b: a | b, [(F.col("below") <= r) & (F.col("below") + F.col("n") > r) for r in wanted])
    # at most two values for each rank
    rows = counted.filter(hit).collect()
    at = {r: row["v"] for r in wanted for row in rows if row["below"] <= r < row["below"] + row["n"]}
    found = []
    for rank in ranks:
        low, high = at[int(rank)], at[min(int(rank) + 1, total - 1)]
        found.append(low if low == high else low + (high - low) * (rank - int(rank)))
    return found


def _numeric_profile(df: DataFrame, column: str, exact: bool) -> DataFrame:
    value = F.col(column).cast("double")
    quartiles = [0.25, 0.5, 0.75]
    if exact:
        source = _counted_values(df, column)
        n, total = F.sum("n"), F.sum(F.col("v") * F.col("n"))
        squares = F.sum(F.col("v") * F.col("v") * F.col("n"))
        spread = F.when(n > 1, F.sqrt(F.greatest((squares - total * total / n) / (n - 1), F.lit(0.0))))
        stats: list[tuple[str, Column]] = [("count", n), ("mean", total / n), ("std", spread), ("min", F.min("v"))]
        ranks = [F.lit(q) for q in _quantiles(source, quartiles)]
        largest = F.max("v")
    else:
        stats = [("count", F.count(value)), ("mean", F.avg(value)), ("std", F.stddev_samp(value)), ("min", F.min(value))]
        near = F.percentile_approx(value, quartiles, 10_000)
        ranks = [near[i] for i in range(3)]
        source, largest = df, F.max(value)
    stats += [(label, rank) for label, rank in zip(("25%", "50%", "75%"), ranks)]
    stats.append(("max", largest))
    cells = [F.struct(F.lit(name).alias("key"), stat.cast("double").alias("value")) for name, stat in stats]
    return source.agg(F.array(*cells).alias("cells")).select(F.lit(column).alias("column"), F.inline("cells"))


def profile(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Summary statistics of numeric columns and value counts of the others, as rows.

    Quartiles are interpolated. They come from the counts of distinct values in
    ranges, of any number; ``exact=False`` estimates them in one pass.
    """
    parts = [_numeric_profile(df, c, exact) for c in num_cols]
    for c in cat_cols:
        counts = df.groupBy(F.col(c).cast("string").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value"))
        parts.append(counts.select(F.lit(c).alias("column"), "key", "value"))
    return reduce(DataFrame.unionByName, parts)


def refresh_demographics(spark: SparkSession, csv: str, target: str, gate: Mapping | None = None) -> dict:
    """Reload the dimension from CSV and publish it only if every check passes.

    The new data is staged below the target, so that the CSV is parsed once,
    checked there, and published by one rename as the newest version. A failed
    check or a crash leaves the version before in use; read it with
    ``storage.read_current``. ``gate`` holds bounds of ``quality_gate``.
    """
    incoming = read_demographics_csv(spark, csv)
    missing = [c for c in DEMOGRAPHICS_REQUIRED if c not in incoming.columns]
    if missing:
        raise QualityError(f"demographics lack columns: {missing}")
    staged_path = staged_folder(target)
    wanted = [c for c in DEMOGRAPHICS_SCHEMA.names if c in incoming.columns]
    with_load_times(incoming.select(*wanted)).write.parquet(staged_path)

    staged = spark.read.parquet(staged_path)
    verdict = validate_demographics(staged).first().asDict()
    if not verdict["is_valid"]:
        raise QualityError(f"demographics are not valid: {verdict}")
    # five numbers, and one row for each gender text of a table that has passed validation
    checks = {r["statistic"]: r["value"] for r in verify_load(staged).collect()}
    stats_frame = load_statistics(staged)
    require_quality(quality_gate(stats_frame, **(gate or {})))
    stats = stats_frame.first().asDict()
    previous = current_folder(spark, target)
    published = publish_staged(spark, staged_path, target)
    return {"validation": verdict, "verification": checks, "statistics": stats, "previous": previous, "published": published}
