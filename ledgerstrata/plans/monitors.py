"""Checks on delivered data: gaps, drift, volume and lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import INGESTED, LANDING, RESCUED, SNAPSHOT, SOURCE_FILE


def missing_days(bronze: DataFrame, day: str = SNAPSHOT) -> DataFrame:
    """Days without a delivery between the first and the last one."""
    present = bronze.select(F.col(day).alias("missing_day")).where("missing_day IS NOT NULL").distinct()
    span = present.agg(F.min("missing_day").alias("a"), F.max("missing_day").alias("b"))
    expected = span.where("a IS NOT NULL").select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("missing_day"))
    return expected.join(present, "missing_day", "left_anti")


def drifted_rows(bronze: DataFrame) -> DataFrame:
    """Per file, rows that did not fit the schema and were kept aside."""
    return bronze.groupBy(SOURCE_FILE).agg(
        F.count(F.lit(1)).alias("rows"), F.count(RESCUED).alias("rescued_rows"))


def drifted_headers(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Files below ``path`` whose first line is not the expected header.

    Only lines of a file's first block are compared, and of them only the first.
    """
    expected = ",".join(LANDING[entity])
    lines = spark.read.option("recursiveFileLookup", True).text(path).where("_metadata.file_block_start = 0")
    firsts = lines.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE), "value", F.monotonically_increasing_id().alias("_line")
    ).groupBy(SOURCE_FILE).agg(F.min_by("value", "_line").alias("header"))
    bare = F.regexp_replace("header", r'^\x{FEFF}|"|\r$', "")
    return firsts.where(bare != expected).select(SOURCE_FILE)


def volume_anomalies(rows: DataFrame, day: str, window_days: int, tolerance: float) -> DataFrame:
    """Days whose row count strays from the days before.

    Counts are compared with mean and deviation of the ``window_days`` reported
    days before. The window sees one row per day, after the count.
    """
    daily = rows.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("day").rowsBetween(-window_days, -1)
    stats = daily.select(
        "day", "rows",
        F.avg("rows").over(before).alias("mean_rows"),
        F.stddev_pop("rows").over(before).alias("stddev_rows"),
        F.count("rows").over(before).alias("days_before"))
    far = F.abs(F.col("rows") - F.col("mean_rows")) > tolerance * F.col("stddev_rows")
    return stats.withColumn("is_anomaly", F.coalesce(far & (F.col("days_before") == window_days), F.lit(False)))


def late_deliveries(bronze: DataFrame, max_hours: int) -> DataFrame:
    """Snapshots taken in more than ``max_hours`` after their day began."""
    lag_hours = F.floor(
        (F.unix_timestamp(INGESTED) - F.unix_timestamp(F.col(SNAPSHOT).cast("timestamp"))) / 3600)
    per_snapshot = bronze.where(F.col(SNAPSHOT).isNotNull()).groupBy(SNAPSHOT).agg(
        F.count(F.lit(1)).alias("rows"), F.max(lag_hours).cast("bigint").alias("delay_hours"))
    return per_snapshot.where(F.col("delay_hours") > max_hours)


def daily_activity(facts: DataFrame) -> DataFrame:
    """Transactions and active customers per day."""
    return facts.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.countDistinct("customer_id").alias("active_customers"))

