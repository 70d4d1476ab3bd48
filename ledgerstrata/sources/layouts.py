"""Tables laid out for what is asked of them: buckets for joins, sorted row groups for look-ups, whole files for scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import TABLES
from ..config import Settings, dropping_shuffles, tasks_of
from .tables import path_of, read_table

#: Bytes below which a file counts as small.
SMALL_FILE = 64 << 20
#: Bytes of the partitions that are rewritten in one job.
REWRITTEN_AT_ONCE = 2 << 30


def write_bucketed(df: DataFrame, settings: Settings, name: str, keys: Sequence[str], buckets: int) -> str:
    """Store rows in the session catalog, in buckets by key and sorted within; returns the table's name.

    Tables with equal keys and buckets are joined, and grouped by key, without a shuffle. Rows are dealt to the buckets'
    tasks first, so each bucket is one file. Choose buckets so that one fits a task; a crowded key makes its bucket
    crowded, so keep tables with such keys unbucketed, where the adaptive skew join can split them.
    """
    database = settings.schema("bucketed")
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", settings.path("bucketed", name)).saveAsTable(f"`{database}`.`{name}`"))
    return f"{database}.{name}"


def write_for_lookup(df: DataFrame, path: str, keys: Sequence[str], *, expected_keys: int = 1_000_000, group_bytes: int = 16 << 20) -> None:
    """Store rows sorted by key, in small row groups with bloom filters of each key column.

    A look-up by the first key reads the row groups whose range holds the value; by any other, those whose
    bloom filter may. ``expected_keys`` is the number of different keys of a file the filters are sized for.
    """
    writer = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option("parquet.block.size", group_bytes)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", expected_keys)
    writer.parquet(path)


def partition_files(spark: SparkSession, settings: Settings, name: str, small: int = SMALL_FILE) -> DataFrame:
    """Files, small files and bytes of each partition of a table, by their listing alone."""
    parts = TABLES[name].partitions(settings)
    if not parts:
        raise ValueError(f"{name} is not partitioned")
    files = spark.read.format("binaryFile").load(path_of(settings, name)).select(*parts, "length")
    return files.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") < small).alias("small_files"), F.sum("length").alias("bytes"))


def compact_crowded(spark: SparkSession, settings: Settings, name: str, *, small: int = SMALL_FILE, at_least: int = 2) -> int:
    """Rewrite every partition that holds ``at_least`` small files; returns how many there were.

    What is whole stays untouched, so a second call finds nothing to do. A job takes partitions of about ``REWRITTEN_AT_ONCE``
    bytes, so the disk for its shuffle and for old files next to new ones does not grow with the table. They are replaced when it commits.
    """
    parts = list(TABLES[name].partitions(settings))
    crowded = partition_files(spark, settings, name, small).where(F.col("small_files") >= at_least).select(*parts, "bytes")
    chosen = crowded.collect()  # partitions with small files
    if not chosen:
        return 0
    jobs, filled = [[]], 0
    for partition in chosen:
        if jobs[-1] and filled + partition["bytes"] > REWRITTEN_AT_ONCE:
            jobs.append([])
            filled = 0
        jobs[-1].append(partition)
        filled += partition["bytes"]
    for job in jobs:
        rows = read_table(spark, settings, name)
        due = spark.createDataFrame(job, crowded.schema).select(*(F.col(p).cast(rows.schema[p].dataType).alias(p) for p in parts))
        # A task's rows are smaller as a file; in smaller tasks a month would be cut in small files again, and rewritten by each call.
        with dropping_shuffles(spark), tasks_of(spark, 4 * small):
            (rows.join(F.broadcast(due), parts, "left_semi").hint("rebalance", *map(F.col, parts))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path_of(settings, name)))
    return len(chosen)
