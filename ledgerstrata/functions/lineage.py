"""Columns that tie a raw row to the file it came from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dated folder below an entity's landing folder, and its format.
SNAPSHOT_FOLDER = r"/landing_data/[^/]+/(\d{4}\.\d{2}\.\d{2})/"
SNAPSHOT_FORMAT = "yyyy.MM.dd"


def source_file() -> Column:
    return F.col("_metadata.file_path")


def snapshot_date(path: Column) -> Column:
    """Date of the dated folder, NULL without one or for an impossible date."""
    return F.try_to_date(F.regexp_extract(path, SNAPSHOT_FOLDER, 1), SNAPSHOT_FORMAT)
