"""Two streams matched within a bound of time.

Rows of the left stream meet rows of the right one with equal keys that happened at most ``within``
before them. Both carry a watermark, so the state holds the bound's width of each side and no more; a left row that
finds no partner leaves by the outer join once the watermark has passed it, with an empty right side. Rows
later than the watermark are dropped by Spark, as nothing could be said about them any more.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Says on which side of the output a row lies.
MATCHED = "matched"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def matched_in_time(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, *, within: str, delay: str,
) -> DataFrame:
    """Left rows with the columns of their partners, and ``matched``.

    ``within`` and ``delay`` are intervals such as ``60 days``. Keys compare by plain equality: a NULL key has no partner.
    A row with several partners comes once with each. Columns of the right side that clash get ``right_`` before their name.
    """
    taken = {c: f"right_{c}" for c in right.columns if c in left.columns}
    late_left = left.withWatermark(left_time, delay)
    late_right = right.withColumnsRenamed(taken).withWatermark(taken.get(right_time, right_time), delay)
    happened, met = F.col(left_time), F.col(taken.get(right_time, right_time))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(taken[k]) for k in keys])
    near = (met <= happened) & (met >= happened - F.expr(f"INTERVAL {within}"))
    return late_left.join(late_right, same & near, "left_outer").drop(*(taken[k] for k in keys)).withColumn(MATCHED, met.isNotNull())


def store_matches(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has been decided by now, pairs and rows still without a partner in folders of their own, and stop.

    State is kept in RocksDB on the executors' disks and in the checkpoint, not in their heaps.
    """
    spark = rows.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return (rows.writeStream.format("parquet").outputMode("append").partitionBy(MATCHED)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def read_matches(spark: SparkSession, path: str, rows: DataFrame, matched: bool = True) -> DataFrame:
    """Pairs, or the rows that waited for a partner in vain."""
    return spark.read.schema(rows.schema).parquet(path).where(F.col(MATCHED) == matched)


def state_rows(query: StreamingQuery) -> int:
    """Rows both sides hold in state after the last micro-batch."""
    progress = query.lastProgress
    return sum(s["numRowsTotal"] for s in progress["stateOperators"]) if progress else 0
