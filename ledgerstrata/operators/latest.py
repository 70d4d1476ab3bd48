"""Latest row per key. Aggregates, so groups of copies shrink before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The row that is last by ``order``, then by content, for each key.

    Only ``columns`` (default: all) besides the keys are carried along.
    """
    content = [c for c in df.columns if c not in {*keys, *order}]
    wanted = [c for c in df.columns if c not in keys and (columns is None or c in columns)]
    rank = F.struct(*order, F.xxhash64(*content) if content else F.lit(0))
    newest = F.max_by(F.struct(F.lit(0).alias("_"), *wanted), rank)
    shown = {**{k: F.col(k) for k in keys}, **{c: F.col(f"_row.{c}").alias(c) for c in wanted}}
    return df.groupBy(*keys).agg(newest.alias("_row")).select(
        *(shown[c] for c in df.columns if c in shown))


def surplus_owners(current: DataFrame, unique_on: Sequence[str]) -> DataFrame:
    """How many open versions are set aside to leave one per ``unique_on``."""
    per_key = current.groupBy(*unique_on).agg(F.count(F.lit(1)).alias("open_versions"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("open_versions") - 1), F.lit(0)).cast("bigint").alias("set_aside"),
        F.count_if(F.col("open_versions") > 1).cast("bigint").alias("keys_affected"),
    )
