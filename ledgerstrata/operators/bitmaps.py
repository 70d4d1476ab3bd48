"""Exact distinct counts that can be merged.

Keys get dense numbers once; a set of them is a bitmap in blocks of 32,768 bits. Bitmaps of batches are merged by OR, so
a distinct count over any batches and days is exact without any row being read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import cut_lineage

ID, BLOCK, BITS = "_id", "_block", "_bits"


def numbered(keys: DataFrame, after: int | Column = 0) -> DataFrame:
    """The rows with numbers without gaps, from ``after`` + 1 on, in ``_id``.

    Rows are numbered within their partition as written; one count per partition says where each begins.
    """
    placed = cut_lineage(keys.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    nr = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_base") + after + 1
    return placed.withColumn("_part", part).join(starts, "_part").withColumn(ID, nr).drop("_part", "_place", "_base")


def pieces(rows: DataFrame, by: Sequence[str], id_: str = ID) -> DataFrame:
    """``by, _block, _bits``: the ids of each group as bitmaps; rows without an id are left out."""
    return rows.where(F.col(id_).isNotNull()).groupBy(*by, F.bitmap_bucket_number(id_).alias(BLOCK)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias(BITS))


def distinct_counts(stored: DataFrame, by: Sequence[str], count: str) -> DataFrame:
    """Distinct ids per group over all pieces, of whatever batches."""
    merged = stored.groupBy(*by, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(count))
