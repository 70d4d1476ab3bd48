"""Type 2 history kept up to date by micro-batches.

Deliveries are full copies, so nearly all rows of a batch repeat what is known. Each
row is compared with the open version of its key by a hash of the tracked columns:
keys of which nothing but the date has moved get a narrow line that says when they were
seen; only the others are logged in full and get new versions.

Files below one root, every batch writing only folders of its own number, so
that a repeated batch replaces what it wrote before:

``log/batch=N``       the good rows of the batch, the truth late rows go back to; rows
                      that are the ``same`` as the open version hold no tracked column
``late/batch=N``      keys with rows at or before what had been seen of them
``versions/batch=N``  versions closed by the batch, and the open ones of its changed keys;
                      every ``FOLD``-th batch holds the open versions of all keys
``published/batch=N`` written last; readers see the newest published batch

A key's open version is that of the newest batch that has one, last seen when its newest
line says. Keys with late rows are rebuilt from their log, in which lines take their content from the
full row of equal hash, and their closed versions of earlier batches no longer count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import Settings, cut_lineage
from ..operators.hotkeys import join_on
from ..operators.quality import good_records
from ..operators.scd2 import scd2, with_timestamps
from ..plans.silver import flagged_snapshot, untracked_columns
from ..schemas import END, HISTORY_KEYS, INGESTED, QUARANTINED, SNAPSHOT, START, bronze_schema
from ..sources.tables import exists, path_of, sized_for_writing, stream_table
from .feeds import checkpoint_of

#: Parts of the log by key; files are sorted by them, so that a look-up of few keys skips row groups.
LOG_BUCKETS = 64
#: Hashes of the tracked columns, and the rank among rows of one key and moment.
CONTENT = ("_content1", "_content2")
RANK = "_rank"
#: Batches between two that write the open versions of all keys.
FOLD = 16


class HistoryFeed:
    """The history dimension of one entity."""

    def __init__(self, spark: SparkSession, settings: Settings, entity: str):
        self.spark, self.settings, self.entity = spark, settings, entity
        self.keys = list(HISTORY_KEYS[entity])
        self.root = path_of(settings, f"dim_{entity}") + "_feed"
        empty = spark.createDataFrame([], bronze_schema(entity))
        self.row_schema = flagged_snapshot(entity, empty, settings).drop(QUARANTINED).schema
        day = self.row_schema[SNAPSHOT].dataType
        self.version_schema = T.StructType(
            [f for f in self.row_schema if f.name != INGESTED]
            + [T.StructField(START, day), T.StructField(END, day)])
        self.untracked = list(untracked_columns(entity, settings))
        self.tracked = [f.name for f in self.row_schema if f.name not in {*self.keys, SNAPSHOT, INGESTED, *self.untracked}]
        self.bucket = F.pmod(F.xxhash64(*self.keys), F.lit(LOG_BUCKETS)).cast("int")

    def run(self) -> StreamingQuery:
        """Take in the raw rows that are there now, and stop."""
        raw = stream_table(self.spark, self.settings, f"{self.entity}_bronze")
        good = good_records(flagged_snapshot(self.entity, raw, self.settings))
        return (
            good.writeStream.foreachBatch(self.take)
            .option("checkpointLocation", checkpoint_of(self.settings, f"dim_{self.entity}"))
            .queryName(f"dim_{self.entity}").trigger(availableNow=True).start())

    def take(self, rows: DataFrame, batch: int) -> None:
        before = self._newest_published(before=batch)
        standing = self._open(before)
        self._file(rows, standing if before is None else self._stamped(standing), batch)
        log = self._lines(batch).where(F.col("batch") == batch)
        lines, arrived = log.where("same"), log.where("NOT same").select(*self.row_schema.names)
        if before is not None:
            changed = arrived.select(*self.keys).distinct()
            # A fold writes every key, so it goes on from every open version as last seen now.
            standing = self._last_seen(standing, lines) if batch % FOLD == 0 else join_on(standing, changed, self.keys, "left_semi")

        first = arrived.groupBy(*self.keys).agg(F.min(SNAPSHOT).alias("_first"))
        seen = standing.select(*self.keys, F.col(SNAPSHOT).alias("_seen"))
        late = join_on(first, seen, self.keys, "inner").where("_first <= _seen").select(*self.keys)
        late.write.mode("overwrite").parquet(f"{self.root}/late/batch={batch}")
        late = self.spark.read.schema(late.schema).parquet(f"{self.root}/late/batch={batch}")

        # At most LOG_BUCKETS numbers reach the driver; they prune the log's row groups.
        late_buckets = [r[0] for r in late.select(self.bucket.alias("b")).distinct().collect()]
        if late_buckets:
            standing, arrived = (join_on(side, late, self.keys, "left_anti") for side in (standing, arrived))
        versions = self._continued(standing, arrived)
        if late_buckets:
            versions = versions.unionByName(
                self._rebuilt(self._log(batch, late_buckets), late))
        (versions.withColumn("is_open", F.col(END).isNull())
         .write.mode("overwrite").partitionBy("is_open").parquet(f"{self.root}/versions/batch={batch}"))
        (self.spark.range(1).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.root}/published/batch={batch}"))
        if batch % FOLD == 0:  # batches since the last fold may still be read
            for old in range(max(0, batch - 2 * FOLD), batch - FOLD):
                self.expire(old)

    def _history(self, log: DataFrame) -> DataFrame:
        return scd2(log, self.keys, SNAPSHOT, tie_break=[INGESTED],
                    untracked=untracked_columns(self.entity, self.settings))

    def _continued(self, standing: DataFrame, arrived: DataFrame) -> DataFrame:
        """Go on from each open version as one row where it began, one where last seen."""
        last_seen = standing.drop(START, END).withColumn(INGESTED, F.lit(None).cast("timestamp"))
        began = standing.withColumn(SNAPSHOT, F.col(START)).drop(START, END).withColumn(
            INGESTED, F.lit(None).cast("timestamp"))
        return self._history(arrived.unionByName(began).unionByName(last_seen))

    def _rebuilt(self, log: DataFrame, late: DataFrame) -> DataFrame:
        """Histories of the late keys from all their rows."""
        return self._history(join_on(log, late, self.keys, "left_semi").drop("batch", "bucket"))

    def _stamped(self, rows: DataFrame) -> DataFrame:
        """The rows with the hashes of their tracked columns."""
        one, two = CONTENT
        return rows.withColumn(one, F.xxhash64(*self.tracked)).withColumn(two, F.xxhash64(F.lit(1), *self.tracked))

    def _file(self, rows: DataFrame, standing: DataFrame, batch: int) -> None:
        """Write the rows into the log; of keys that only were seen again, without what is tracked.

        That holds for a key if all its rows have the content of its open version and come after it was last seen, or at
        that moment with equal untracked values.
        """
        rows = self._stamped(rows).withColumn("bucket", self.bucket)
        rest = [c for c in rows.columns if c not in {*self.keys, SNAPSHOT, INGESTED, *CONTENT, "bucket"}]
        rows = rows.withColumn(RANK, F.xxhash64(*rest))
        if CONTENT[0] not in standing.columns:  # nothing is known yet
            marked = rows.withColumn("same", F.lit(False))
        else:
            carried = F.xxhash64(*self.untracked) if self.untracked else F.lit(0)
            known = standing.select(*self.keys, F.col(SNAPSHOT).alias("_seen"), carried.alias("_carried"), *(F.col(c).alias(f"_of{c}") for c in CONTENT))
            held = join_on(rows.select(*self.keys, SNAPSHOT, *CONTENT, carried.alias("_now")), known, self.keys, "left")
            seen_again = (F.col(SNAPSHOT) > F.col("_seen")) | ((F.col(SNAPSHOT) == F.col("_seen")) & (F.col("_now") == F.col("_carried")))
            for c in CONTENT:
                seen_again &= F.col(c) == F.col(f"_of{c}")
            moved = cut_lineage(held.where(~F.coalesce(seen_again, F.lit(False))).select(*self.keys).distinct().withColumn("_moved", F.lit(True)))
            marked = join_on(rows, moved, self.keys, "left").withColumn("same", F.col("_moved").isNull()).drop("_moved")
            marked = marked.withColumns({c: F.when(~F.col("same"), F.col(c)) for c in self.tracked})
        (sized_for_writing(marked, ["same", "bucket"]).sortWithinPartitions("same", "bucket").write.mode("overwrite")
         .partitionBy("same").parquet(f"{self.root}/log/batch={batch}"))

    def _lines(self, batch: int) -> DataFrame:
        """The log as it is stored."""
        added = [*((c, T.LongType()) for c in (*CONTENT, RANK, "batch")), ("bucket", T.IntegerType()), ("same", T.BooleanType())]
        schema = T.StructType([*self.row_schema, *(T.StructField(*a) for a in added)])
        return self.spark.read.schema(schema).parquet(f"{self.root}/log").where(F.col("batch") <= batch)

    def _log(self, batch: int, buckets: list[int] | None = None) -> DataFrame:
        """All rows of the log in full, or those of some buckets."""
        stored = self._lines(batch)
        if buckets is not None:
            stored = stored.where(F.col("bucket").isin(buckets))
        whole, lines = stored.where("NOT same"), stored.where("same").drop(*self.tracked)
        contents = whole.dropDuplicates([*self.keys, *CONTENT]).select(*self.keys, *CONTENT, *self.tracked)
        restored = join_on(lines, contents, [*self.keys, *CONTENT], "inner")
        return whole.unionByName(restored).drop(*CONTENT, RANK, "same")

    def _last_seen(self, versions: DataFrame, lines: DataFrame) -> DataFrame:
        """The open versions as last seen by the lines."""
        carried = [SNAPSHOT, *self.untracked]
        newest = lines.groupBy(*self.keys).agg(F.max_by(F.struct(*carried), F.struct(SNAPSHOT, INGESTED, RANK)).alias("_line"))
        both = join_on(versions, newest, self.keys, "left")
        later = F.col(f"_line.{SNAPSHOT}") >= F.col(SNAPSHOT)
        return both.withColumns({c: F.when(later, F.col(f"_line.{c}")).otherwise(F.col(c)) for c in reversed(carried)}).drop("_line")

    def _newest_published(self, before: int | None = None) -> int | None:
        published = self.spark.read.schema("id long, batch long").parquet(f"{self.root}/published") \
            if exists(self.spark, f"{self.root}/published") else None
        if published is None:
            return None
        if before is not None:
            published = published.where(F.col("batch") < before)
        return published.agg(F.max("batch")).first()[0]

    def _versions(self) -> DataFrame:
        schema = T.StructType([*self.version_schema, T.StructField("batch", T.LongType()),
                               T.StructField("is_open", T.BooleanType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/versions")

    def _open(self, batch: int | None) -> DataFrame:
        if batch is None:
            return self.spark.createDataFrame([], self.version_schema)
        since = F.col("batch").between(batch - batch % FOLD, batch)
        rest = [c for c in self.version_schema.names if c not in self.keys]
        rows = self._versions().where(since & F.col("is_open"))
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "batch").alias("_v"))
        newest = newest.select(*self.keys, *(F.col(f"_v.{c}").alias(c) for c in rest)).select(*self.version_schema.names)
        return self._last_seen(newest, self._lines(batch).where(since & F.col("same")))

    def current(self) -> DataFrame:
        """Open versions; reads the batches since the last fold."""
        return with_timestamps(self._open(self._newest_published()))

    def history(self) -> DataFrame:
        """All versions as of the newest published batch."""
        newest = self._newest_published()
        if newest is None:
            return with_timestamps(self._open(None))
        late = self.spark.read.schema(
            T.StructType([*(f for f in self.version_schema if f.name in self.keys),
                          T.StructField("batch", T.LongType())])
        ).parquet(f"{self.root}/late").where(F.col("batch") <= newest)
        rebuilt = late.groupBy(*self.keys).agg(F.max("batch").alias("_rebuilt"))
        closed = self._versions().where((F.col("batch") <= newest) & ~F.col("is_open"))
        valid = join_on(closed, rebuilt, self.keys, "left").where(
            F.col("_rebuilt").isNull() | (F.col("batch") >= F.col("_rebuilt")))
        return with_timestamps(
            valid.drop("batch", "is_open", "_rebuilt").unionByName(self._open(newest)))

    def expire(self, batch: int) -> None:
        """Empty the open versions of a batch that a later fold has replaced."""
        newest = self._newest_published()
        if newest is None or batch >= newest - newest % FOLD:
            raise ValueError(f"batch {batch} is still being read")
        (self.spark.createDataFrame([], self.version_schema).write.mode("overwrite")
         .parquet(f"{self.root}/versions/batch={batch}/is_open=true"))
