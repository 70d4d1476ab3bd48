"""Splitting keys that hold too many rows for one task.

A window over a key runs in one task per key. Where one key may hold a third of
the data, its rows are range-partitioned by key and order into slices of even
size; each slice is a window of its own and only a summary per (key, slice)
crosses slice borders. Any column that Spark can sort serves as the order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import cut_lineage

#: Rows one key may hold before its windows are sliced.
HOT_ROWS = 2_000_000

#: Range partitions per core that hot keys are sorted in.
TASKS_PER_CORE = 4

SLICE = "_slice"


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on NULL-safe equality of the keys, keeping the left side's."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*(f"_right_{k}" for k in keys))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None when there are none.

    Reads the key columns only; the count is combined before the shuffle. There
    are at most ``rows / hot_rows`` such keys; they are kept as a small table, which
    Spark broadcasts while its size is below its own limit.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.where(F.col("_rows") > hot_rows).select(*keys)
    if hot.isEmpty():
        return None
    return cut_lineage(hot)


def split_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of hot keys, and all others."""
    return join_on(df, hot, keys, "left_semi"), join_on(df, hot, keys, "left_anti")


def in_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], slice_rows: int) -> DataFrame:
    """The rows with their slice number, about ``slice_rows`` to a slice.

    Spark samples the borders of range partitions, one per slice. Where that would be more than a few per core,
    each holds several slices: sorted, every ``slice_rows`` rows are one. So the number of tasks and files follows the
    cluster, not ``slice_rows``. Slice numbers follow the order, and rows that are equal in it may lie in neighbouring
    slices. The numbered rows are written, as a repeated task might number them otherwise.
    """
    spark = df.sparkSession
    most = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = max(2, -(-df.count() // slice_rows))
    by = [*(F.col(k) for k in keys), *order]
    ranged = df.repartitionByRange(min(most, wanted), *by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id()  # the partition in the upper bits, the row in the lower 33
    row = place.bitwiseAND(F.lit((1 << 33) - 1))
    within = F.floor(row / slice_rows) if wanted > most else F.lit(0)
    return cut_lineage(ranged.withColumn(SLICE, place - row + within))
