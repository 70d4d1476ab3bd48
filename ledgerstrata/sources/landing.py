"""Landing CSV files as raw rows with their lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lineage
from ..schemas import INGESTED, RESCUED, SNAPSHOT, SNAPSHOT_ENTITIES, SOURCE_FILE, landing_schema


def _options(rescue: bool, multi_line: bool) -> dict[str, object]:
    return {
        "header": True,
        "multiLine": multi_line,
        "quote": '"',
        "escape": '"',
        "recursiveFileLookup": True,
        "columnNameOfCorruptRecord": RESCUED,
        # A header check and kept-aside rows exclude each other: checked files
        # fail on a changed header, rescued files bind columns by position.
        "enforceSchema": rescue,
    }


def with_lineage(rows: DataFrame, entity: str) -> DataFrame:
    """Append the source file, the load time and, for snapshots, their date."""
    marked = rows.select("*", lineage.source_file().alias(SOURCE_FILE))
    marked = marked.withColumn(INGESTED, F.current_timestamp())
    if entity in SNAPSHOT_ENTITIES:
        marked = marked.withColumn(SNAPSHOT, lineage.snapshot_date(F.col(SOURCE_FILE)))
    return marked


def read_landing(
    spark: SparkSession, landing: str, entity: str, *, rescue: bool = False, multi_line: bool = True
) -> DataFrame:
    """All files of an entity.

    A multi-line file is read by one task, so deliver large entities as many
    files, or pass ``multi_line=False`` where no field holds a line break.
    """
    reader = spark.read.schema(landing_schema(entity)).options(**_options(rescue, multi_line))
    return with_lineage(reader.csv(f"{landing.rstrip('/')}/{entity}"), entity)


def stream_landing(
    spark: SparkSession, landing: str, entity: str, *, rescue: bool = False, multi_line: bool = True,
    max_files: int = 1000,
) -> DataFrame:
    """New files of an entity, each once; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(landing_schema(entity)).options(**_options(rescue, multi_line))
    reader = reader.option("maxFilesPerTrigger", max_files)
    return with_lineage(reader.csv(f"{landing.rstrip('/')}/{entity}"), entity)
