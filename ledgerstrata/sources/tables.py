"""Reading, writing, publishing and compacting the lakehouse's tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import FACTS, METRICS, TABLES
from ..config import Settings, dropping_shuffles
from ..schemas import SNAPSHOT_ENTITIES, bronze_schema

#: Folder (``batch=N``) of a table that micro-batches write, each its own; no column of the table.
BATCH = "batch"
#: Tables that the streaming chain keeps as increments of its own.
FED = frozenset({FACTS, METRICS, *(f"dim_{e}" for e in SNAPSHOT_ENTITIES)})


def path_of(settings: Settings, name: str) -> str:
    return settings.path(TABLES[name].layer, name)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of Spark's own reader."""
    try:
        return bool(spark.read.text(path).columns)
    except AnalysisException:
        return False


def is_streamed(spark: SparkSession, settings: Settings, name: str) -> bool:
    """Whether a stream owns the table's files; nobody else may rewrite them."""
    return any(exists(spark, f"{path_of(settings, name)}/{mark}") for mark in ("_spark_metadata", f"{BATCH}=0"))


def schema_of(spark: SparkSession, settings: Settings, name: str) -> T.StructType:
    """Schema a table has by contract, found by building it from empty inputs."""
    table = TABLES[name]
    if table.build is None:
        return bronze_schema(name.removesuffix("_bronze"))
    empty = {i: spark.createDataFrame([], schema_of(spark, settings, i)) for i in table.inputs}
    return table.build(empty, settings).schema


def read_table(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    """A table's rows. Partition columns are typed by contract, not by guess.

    A table that only increments have written so far is read from them.
    """
    if name in FED and not exists(spark, path_of(settings, name)):
        from ..streaming.run import read_increments

        return read_increments(spark, settings, name)
    reader = spark.read
    if TABLES[name].partitions(settings):
        reader = reader.schema(schema_of(spark, settings, name))
    return reader.parquet(path_of(settings, name)).drop(BATCH)


def stream_table(spark: SparkSession, settings: Settings, name: str, max_files: int = 10_000, max_bytes: int | None = None) -> DataFrame:
    """Rows appended to a table, as a stream; ``max_files`` or else ``max_bytes`` bounds one micro-batch."""
    schema = schema_of(spark, settings, name)
    bound = ("maxFilesPerTrigger", max_files) if max_bytes is None else ("maxBytesPerTrigger", max_bytes)
    reader = spark.readStream.schema(schema).option(*bound)
    return reader.parquet(path_of(settings, name)).select(*schema.names)


def declare(spark: SparkSession, settings: Settings, name: str) -> None:
    """Create a table empty, with its contract's columns, unless it has files."""
    path = path_of(settings, name)
    empty = spark.createDataFrame([], schema_of(spark, settings, name)).coalesce(1)
    empty.write.mode("ignore").parquet(path)


def sized_for_writing(df: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    """Even out the files of a partitioned write; a crowded partition is split."""
    columns = [F.col(c) for c in partition_by]
    return df.hint("rebalance", *columns) if columns else df


def write_table(df: DataFrame, settings: Settings, name: str) -> None:
    """Replace a table's content."""
    parts = TABLES[name].partitions(settings)
    writer = sized_for_writing(df, parts).write.mode("overwrite").option("partitionOverwriteMode", "static")
    with dropping_shuffles(df.sparkSession):
        (writer.partitionBy(*parts) if parts else writer).parquet(path_of(settings, name))


def write_batch(df: DataFrame, settings: Settings, name: str, batch: int) -> None:
    """Replace what a micro-batch has written of a table."""
    parts = TABLES[name].partitions(settings)
    writer = sized_for_writing(df, parts).write.mode("overwrite").option("partitionOverwriteMode", "static")
    with dropping_shuffles(df.sparkSession):
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{path_of(settings, name)}/{BATCH}={batch}")


def refresh(spark: SparkSession, settings: Settings, names: Iterable[str] | None = None) -> None:
    """Rebuild derived tables (default: all of them) from the raw ones.

    Tables that a stream appends to are up to date as they are: they are left
    alone, and naming one is an error, as a rewrite would cut the stream off
    from its own log.
    """
    chosen = set(TABLES if names is None else names)
    streamed = {n for n in chosen if TABLES[n].build is not None and is_streamed(spark, settings, n)}
    if names is not None and streamed:
        raise ValueError(f"written by streams, not to be rebuilt: {sorted(streamed)}")
    for name, table in TABLES.items():
        if name in chosen - streamed and table.build is not None:
            inputs = {i: read_table(spark, settings, i) for i in table.inputs}
            write_table(table.build(inputs, settings), settings, name)


def compact(spark: SparkSession, settings: Settings, name: str, partition: Mapping[str, object]) -> None:
    """Rewrite one partition's small files as few large ones.

    Dynamic overwrite replaces the partition only when the job commits, so the
    old files stay readable (and the job repeatable) until then.
    """
    parts = TABLES[name].partitions(settings)
    unknown = set(partition) ^ set(parts)
    if not parts or unknown:
        raise ValueError(f"{name} is partitioned by {parts}, not {tuple(partition)}")
    rows = read_table(spark, settings, name)
    for column, value in partition.items():
        rows = rows.where(F.col(column).eqNullSafe(F.lit(value)))
    with dropping_shuffles(spark):
        (rows.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(path_of(settings, name)))


def publish(spark: SparkSession, settings: Settings, name: str) -> str:
    """Make a written table known to the session catalog, with its metadata."""
    table = TABLES[name]
    database = settings.schema(table.layer)
    quoted = f"`{database}`.`{name}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in table.properties.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted} USING parquet LOCATION '{path_of(settings, name)}' "
        f"COMMENT '{table.comment}'" + (f" TBLPROPERTIES ({properties})" if properties else ""))
    if table.partitions(settings):
        spark.sql(f"MSCK REPAIR TABLE {quoted}")
    spark.catalog.refreshTable(quoted)
    return f"{database}.{name}"


def reset(spark: SparkSession, settings: Settings, names: Iterable[str], *, confirmed: bool = False) -> None:
    """Drop tables from the catalog. Their files stay; nothing happens unconfirmed."""
    if not confirmed:
        raise ValueError("pass confirmed=True to drop tables")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{settings.schema(TABLES[name].layer)}`.`{name}`")
