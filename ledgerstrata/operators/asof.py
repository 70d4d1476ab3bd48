"""Join facts to the version that was valid when they happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import cut_lineage
from ..schemas import END, START
from .hotkeys import HOT_ROWS, SLICE, hot_keys, in_slices, join_on, split_hot


def asof_join(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    columns: Sequence[str],
    *,
    start: str = START,
    end: str = END,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Facts with ``columns`` of the version with ``start <= at < end``.

    Facts without a valid version are dropped (inner join). Both sides are laid
    on one time line per key and each fact takes the version last opened before
    it, so the work is one shuffle and sort of both sides; no pair of fact and
    version is formed but the result's. Versions of a key must not overlap.
    To look for hot keys the history is written once and counted there.
    """
    version = F.struct(*columns, F.col(end).alias("_until"))
    kind = facts.schema[at].dataType
    openings = history.select(
        *keys, F.col(start).cast(kind).alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"))
    happenings = facts.select(
        *keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        F.struct(*(c for c in facts.columns if c not in keys)).alias("_fact"))
    if hot_rows is not None:
        openings = cut_lineage(openings)
    line = openings.unionByName(happenings, allowMissingColumns=True).where(F.col("_at").isNotNull())

    hot = hot_keys(line, keys, hot_rows) if hot_rows is not None else None
    if hot is None:
        found = _last_opened(line, keys)
    else:
        crowded, rest = split_hot(line, hot, keys)
        found = _last_opened(rest, keys).unionByName(
            _last_opened_in_slices(crowded, keys, hot_rows))

    until = F.col("_version._until")
    valid = found.where(
        F.col("_version").isNotNull() & (until.isNull() | (F.col("_at") < until.cast(kind))))
    rest_of_fact = [F.col(f"_fact.{c}").alias(c) for c in facts.columns if c not in keys]
    return valid.select(*keys, *rest_of_fact, *(F.col(f"_version.{c}").alias(c) for c in columns))


def _up_to_here(cell: Sequence[str]):
    return Window.partitionBy(*cell).orderBy("_at", "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)


def _last_opened(line: DataFrame, keys: Sequence[str]) -> DataFrame:
    seen = F.last("_version", ignorenulls=True).over(_up_to_here(keys))
    return line.withColumn("_version", seen).where("_kind = 1")


def _last_opened_in_slices(line: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """As :func:`_last_opened`, with the last version of earlier slices carried in."""
    # The hash parts facts of one moment; versions of that moment come before them.
    content = F.xxhash64("_fact")
    sliced = in_slices(line, keys, ["_at", "_kind", content], hot_rows)
    cell = [*keys, SLICE]
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    opened_last = F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_at")))
    carried = sliced.groupBy(*cell).agg(opened_last.alias("_carried")).select(
        *cell, F.last("_carried", ignorenulls=True).over(before).alias("_carried"))
    seen = F.last("_version", ignorenulls=True).over(_up_to_here(cell))
    inner = sliced.withColumn("_version", seen).where("_kind = 1")
    return join_on(inner, carried, cell, "left").select(
        *(F.coalesce("_version", "_carried").alias(c) if c == "_version" else c for c in line.columns))
