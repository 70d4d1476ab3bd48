"""Landing CSV files bound by the names in their own header.

Each file's first line says which column is where. Files are read once per distinct header, by
position within it, and columns are bound by name: an added, missing or moved column
neither fails nor shifts a value. What does not fit goes into one JSON value in the rescue column, with
the file it came from:

* values of columns the contract does not know, under their name;
* values that are not of the type asked for (``types``), under their name; the column itself is NULL;
* the whole line, under ``_line``, where a row has more or fewer fields than its header.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LANDING, RESCUED, bronze_schema
from .landing import with_lineage

FILE, LINE = "_file_path", "_line"


def header_table(spark: SparkSession, files: Iterable[str]) -> DataFrame:
    """``file, header``: the first line of each file; empty files have none.

    Spark reads the lines as text and drops them at once; nothing but one line per file is kept.
    """
    lines = spark.read.text(list(files)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_nr"), "value")
    return lines.where("_block = 0").groupBy("file").agg(F.min_by("value", "_nr").alias("header"))


def header_names(header: str) -> list[str]:
    """Column names of a header line: trimmed, lower case, no byte order mark, repeated ones numbered."""
    names: list[str] = []
    for raw in next(csv.reader([header.lstrip("\ufeff").rstrip("\r")], skipinitialspace=True), []):
        name = raw.strip().lower() or "_unnamed"
        nr = sum(n == name or n.startswith(f"{name}__") for n in names)
        names.append(f"{name}__{nr + 1}" if nr else name)
    return names


def _bound(rows: DataFrame, names: list[str], entity: str, types: Mapping[str, str]) -> DataFrame:
    """Rows read by position (``c0``, ``c1``, ...) as columns of the contract and the rescue column."""
    place = {name: F.col(f"c{i}") for i, name in enumerate(names)}
    columns, misfits = [], []
    for name in LANDING[entity]:
        value = place.pop(name, F.lit(None).cast("string"))
        if name in types:
            fits = value.try_cast(types[name]).isNotNull()
            misfits.append(F.struct(F.lit(name).alias("key"), F.when(~fits, value).alias("value")))
            value = F.when(fits, value)
        columns.append(value.alias(name))
    misfits += [F.struct(F.lit(name).alias("key"), value.alias("value")) for name, value in place.items()]
    misfits.append(F.struct(F.lit(LINE).alias("key"), F.col(RESCUED).alias("value")))
    found = F.filter(F.array(*misfits), lambda m: m["value"].isNotNull())
    source = F.array(F.struct(F.lit(FILE).alias("key"), F.col("_metadata.file_path").alias("value")))
    rescued = F.when(F.size(found) > 0, F.to_json(F.map_from_entries(F.concat(found, source))))
    return rows.select(*columns, rescued.alias(RESCUED))


def read_by_header(
    spark: SparkSession, files: Iterable[str], entity: str, *, types: Mapping[str, str] | None = None,
    multi_line: bool = True, headers: DataFrame | None = None,
) -> DataFrame:
    """Raw rows of the files, with lineage; as many reads as there are different headers.

    ``headers`` is their :func:`header_table` where it is stored already. One line per file reaches the driver. Files
    without any line give no rows; a header must be one line.
    """
    unknown = set(types or ()) - set(LANDING[entity])
    if unknown:
        raise ValueError(f"{entity} has no columns {sorted(unknown)}")
    table = header_table(spark, files) if headers is None else headers
    by_header: dict[str, list[str]] = {}
    for file, header in table.select("file", "header").collect():
        by_header.setdefault(header, []).append(unquote(file))
    out = spark.createDataFrame([], bronze_schema(entity))
    for header, group in sorted(by_header.items()):
        names = header_names(header)
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField(RESCUED, T.StringType())])
        rows = spark.read.schema(schema).options(
            header=True, enforceSchema=True, multiLine=multi_line, quote='"', escape='"', columnNameOfCorruptRecord=RESCUED).csv(group)
        out = out.unionByName(with_lineage(_bound(rows, names, entity, types or {}), entity))
    return out
