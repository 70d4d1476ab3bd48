"""Append-only streams: files to raw tables, raw to clean, clean to good and bad."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..catalog import TABLES
from ..config import Settings
from ..operators import quality
from ..plans import silver
from ..schemas import SNAPSHOT_ENTITIES
from ..sources.headers import header_table, read_by_header
from ..sources.landing import stream_landing
from ..sources.tables import BATCH, exists, path_of, stream_table, write_batch


def checkpoint_of(settings: Settings, query: str) -> str:
    return f"{settings.root.rstrip('/')}/_checkpoints/{settings.env or 'main'}/{query}"


def append(df: DataFrame, settings: Settings, name: str) -> StreamingQuery:
    """Append what is there now to a table, exactly once, and stop."""
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    parts = TABLES[name].partitions(settings)
    if parts:
        writer = writer.partitionBy(*parts)
    return (writer.option("checkpointLocation", checkpoint_of(settings, name))
            .queryName(name).start(path_of(settings, name)))


def ingest(spark: SparkSession, settings: Settings, landing: str, entity: str, *, by_header: bool = False, **options) -> StreamingQuery:
    """New landing files into the raw table; ``by_header`` as :func:`ingest_by_header`."""
    if by_header:
        return ingest_by_header(spark, settings, landing, entity, **options)
    return append(stream_landing(spark, landing, entity, **options), settings, f"{entity}_bronze")


def _own_folders(spark: SparkSession, settings: Settings, name: str) -> str:
    """The path of a table that micro-batches write as folders, each its own."""
    path = path_of(settings, name)
    if exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{name} belongs to another stream, whose readers would not see these rows")
    return path


def ingest_by_header(
    spark: SparkSession, settings: Settings, landing: str, entity: str, *, types: Mapping[str, str] | None = None,
    multi_line: bool = True, max_files: int = 1000,
) -> StreamingQuery:
    """New landing files into the raw table, bound by the names in their own headers.

    The stream lists files only; each micro-batch stores their headers in a table of its own, then reads them. A repeated batch
    replaces its folder.
    """
    path = _own_folders(spark, settings, f"{entity}_bronze")

    def take(rows: DataFrame, batch: int) -> None:
        files = [r["path"] for r in rows.collect()]  # at most max_files
        noted = f"{path}_headers/batch={batch}"
        header_table(spark, files).coalesce(1).write.mode("overwrite").parquet(noted)
        headers = spark.read.schema("file string, header string").parquet(noted)
        found = read_by_header(spark, files, entity, types=types, multi_line=multi_line, headers=headers)
        write_batch(found, settings, f"{entity}_bronze", batch)

    listed = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).load(f"{landing.rstrip('/')}/{entity}").select("path"))
    return (listed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_of(settings, f"{entity}_bronze"))
            .queryName(f"{entity}_bronze").trigger(availableNow=True).start())


def clean(spark: SparkSession, settings: Settings, entity: str) -> StreamingQuery:
    """New raw rows into the cleaned table."""
    raw = stream_table(spark, settings, f"{entity}_bronze")
    if entity not in SNAPSHOT_ENTITIES:
        return append(silver.clean_fact(entity, raw, settings), settings, f"{entity}_silver")
    return append(silver.clean_snapshot(entity, raw, settings), settings, f"{entity}_clean_silver")


def clean_and_count(spark: SparkSession, settings: Settings, entity: str, **options) -> StreamingQuery:
    """New raw rows of a snapshot entity into the cleaned table, its rules counted on the way.

    The counts are observed by the write itself, so raw rows are read once. Rows and counts of a micro-batch have
    folders of their own; a repeated batch replaces both. A batch without rows (an empty file) leaves nothing observed, as Spark
    drops the counters with a plan that turns out empty; it is counted as it was written.
    """
    rules = quality.rules_for(entity, settings)
    path = _own_folders(spark, settings, f"{entity}_clean_silver")

    def take(rows: DataFrame, batch: int) -> None:
        passing, observation = quality.observed(silver.clean_snapshot(entity, rows, settings), rules, f"{entity}_{batch}")
        write_batch(passing, settings, f"{entity}_clean_silver", batch)
        stored = spark.read.schema(passing.schema).parquet(f"{path}/{BATCH}={batch}")
        seen = stored.agg(*quality.counters(rules)).first().asDict() if stored.isEmpty() else observation.get
        counts = [(rule, seen[f"{rule}__passed"], seen[f"{rule}__failed"]) for rule in rules]
        (spark.createDataFrame(counts, "rule string, passed_rows long, failed_rows long").coalesce(1)
         .write.mode("overwrite").parquet(f"{rules_root(settings)}/entity={entity}/batch={batch}"))

    return (stream_table(spark, settings, f"{entity}_bronze", **options).writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint_of(settings, f"{entity}_clean_silver"))
            .queryName(f"{entity}_clean_silver").trigger(availableNow=True).start())


def count_rules(spark: SparkSession, settings: Settings, entity: str, **options) -> StreamingQuery:
    """Passes and failures per rule of new raw rows, one folder per micro-batch.

    A repeated batch replaces its counts, and no batch is forgotten, however
    many a run has.
    """
    rules = quality.rules_for(entity, settings)

    def take(rows: DataFrame, batch: int) -> None:
        counted = quality.rule_counts(silver.clean_snapshot(entity, rows, settings), rules)
        counted.write.mode("overwrite").parquet(f"{rules_root(settings)}/entity={entity}/batch={batch}")

    return (stream_table(spark, settings, f"{entity}_bronze", **options).writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint_of(settings, f"rules_{entity}"))
            .queryName(f"rules_{entity}").trigger(availableNow=True).start())


def rules_root(settings: Settings) -> str:
    return f"{settings.root.rstrip('/')}/{settings.schema('silver')}/rule_metrics"


def rule_totals(spark: SparkSession, settings: Settings) -> DataFrame:
    """``entity, rule, passed_rows, failed_rows`` over all batches so far."""
    schema = "rule string, passed_rows long, failed_rows long, entity string, batch long"
    return spark.read.schema(schema).parquet(rules_root(settings)).groupBy("entity", "rule").agg(
        F.sum("passed_rows").alias("passed_rows"), F.sum("failed_rows").alias("failed_rows"))


def route(spark: SparkSession, settings: Settings, entity: str) -> list[StreamingQuery]:
    """New cleaned rows into the good and the bad table."""
    rows = stream_table(spark, settings, f"{entity}_clean_silver")
    return [
        append(quality.good_records(rows), settings, f"{entity}_clean_good_records"),
        append(quality.bad_records(rows), settings, f"{entity}_clean_bad_records"),
    ]
