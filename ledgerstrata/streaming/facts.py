"""New transactions joined to the dimensions as they stand.

Each micro-batch writes folders of its own number, so a repeated batch replaces
its rows, and readers see a batch once its marker is there. A transaction whose
card or account is not known yet is stored once among the waiting ones; when
dimensions have changed, :meth:`FactFeed.settle` looks up only the keys that are new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..catalog import FACTS, METRICS, PERIOD
from ..config import Settings, dropping_shuffles, passing_tables
from ..operators.hotkeys import join_on
from ..plans import gold
from ..schemas import FACT_COLUMNS
from ..sources.tables import exists, path_of, sized_for_writing, stream_table
from .feeds import checkpoint_of

#: Folders that waiting rows are filed in by key; a look-up of few keys reads few of them.
WAITING_BUCKETS = 64
#: Bytes of files that one micro-batch takes in; its shuffles take disk in proportion.
BYTES_AT_ONCE = 1 << 30


class FactFeed:
    """Card or account transactions into facts and business metrics.

    ``dimensions`` returns the owners (by card or by account), cities and
    regions; it is called per batch, so each batch sees their newest state.
    """

    def __init__(self, spark: SparkSession, settings: Settings, kind: str, dimensions):
        self.spark, self.settings, self.kind, self.dimensions = spark, settings, kind, dimensions
        card = kind == gold.CARD
        self.source = "card_transactions_silver" if card else "financial_transactions_silver"
        self.key = "card_id" if card else "account_id"
        self.own = gold.paid_by_card if card else gold.moved_on_account
        self.transactions = stream_table(spark, settings, self.source, max_bytes=BYTES_AT_ONCE)
        self.late = f"{kind}_late"

    def run(self) -> StreamingQuery:
        """Take in the transactions that are there now, and stop."""
        return (
            self.transactions.writeStream.foreachBatch(self.take)
            .option("checkpointLocation", checkpoint_of(self.settings, f"{FACTS}_{self.kind}"))
            .queryName(f"{FACTS}_{self.kind}").trigger(availableNow=True).start())

    def _folder(self, table: str, batch: int, feed: str | None = None) -> str:
        return f"{feed_root(self.settings, table)}/feed={feed or self.kind}/batch={batch}"

    def take(self, rows: DataFrame, batch: int) -> None:
        """Facts of the rows whose owner is known; the others are set aside, once."""
        owners, cities, regions = self.dimensions()
        with passing_tables(self.spark) as passing:
            owners = passing(owners)
            bucket = F.pmod(F.xxhash64(self.key), F.lit(WAITING_BUCKETS)).cast("int")
            unknown = join_on(rows, owners.select(self.key), [self.key], "left_anti").withColumn("bucket", bucket)
            with dropping_shuffles(unknown.sparkSession):
                (sized_for_writing(unknown, ["bucket"]).write.mode("overwrite").partitionBy("bucket")
                 .parquet(self._folder("waiting", batch)))
            self._publish(self.own(rows, owners), cities, regions, batch, self.kind)

    def settle(self) -> None:
        """Facts of waiting rows whose owner has become known since the last call.

        The key column of the owners is kept from call to call. Keys that were not
        there before are looked up among the waiting rows, from the batch on that
        their last look-up has not covered, so no row is taken twice even if an owner goes and comes.
        """
        newest = self._newest(self.kind)
        if newest is None:
            return
        last = self._newest(self.late)
        turn = 0 if last is None else last + 1
        owners, cities, regions = self.dimensions()
        with passing_tables(self.spark) as passing:
            self._settle(newest, last, turn, passing(owners), cities, regions)

    def _settle(self, newest: int, last: int | None, turn: int, owners: DataFrame, cities: DataFrame, regions: DataFrame) -> None:
        """Facts of the waiting rows of batches up to ``newest`` whose owners were not there at the turn ``last``."""
        known = owners.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        known.write.mode("overwrite").parquet(self._folder("known", turn, self.late))
        known = self.spark.read.schema(known.schema).parquet(self._folder("known", turn, self.late))
        new = known
        if last is not None:
            before = self.spark.read.schema(known.schema).parquet(self._folder("known", last, self.late))
            new = known.join(before, self.key, "left_anti")
        looked = new.withColumn("upto", F.lit(newest).cast("long"))
        looked.write.mode("overwrite").parquet(self._folder("looked", turn, self.late))
        new = self.spark.read.schema(looked.schema).parquet(self._folder("looked", turn, self.late)).select(self.key)

        earlier = (self.spark.read.schema(f"{self.key} string, upto long, feed string, batch long")
                   .parquet(feed_root(self.settings, "looked")).where((F.col("feed") == self.late) & (F.col("batch") < turn))
                   .groupBy(self.key).agg(F.max("upto").alias("upto")))
        # Owners that are due are joined with their last look-up first, so that waiting rows are dealt out only once.
        due = owners.join(new.join(earlier, self.key, "left").withColumnRenamed("upto", "_upto"), self.key)
        waiting = self._waiting().where(F.col("batch") <= newest)
        # At most WAITING_BUCKETS numbers reach the driver; they prune the folders of waiting rows.
        bucket = F.pmod(F.xxhash64(self.key), F.lit(WAITING_BUCKETS)).cast("int")
        buckets = [r[0] for r in new.select(bucket.alias("b")).distinct().collect()]
        waiting = waiting.where(F.col("bucket").isin(buckets)).select(*self.transactions.columns, F.col("batch").alias("_batch"))
        owned = self.own(waiting, due).where("_upto IS NULL OR _batch > _upto").drop("_upto", "_batch")
        self._publish(owned, cities, regions, turn, self.late)
        if last:  # the call before the last is no longer compared with
            known.limit(0).write.mode("overwrite").parquet(self._folder("known", last - 1, self.late))

    def _publish(self, owned: DataFrame, cities, regions, batch: int, feed: str) -> None:
        """Write the facts and metrics of transactions with their owners.

        Rows are dealt to the periods before names and segments widen them. Files of facts lie by period, so
        metrics are written from them without being dealt again.
        """
        facts = gold.enriched(gold.by_period(owned), cities, regions, self.settings)
        self._write(facts, FACTS, batch, feed)
        written = self.spark.read.schema(facts.schema).parquet(self._folder(FACTS, batch, feed))
        self._write(gold.business_metrics(written, self.settings), METRICS, batch, feed)
        (self.spark.range(1).coalesce(1).write.mode("overwrite")
         .parquet(self._folder("published", batch, feed)))

    def _write(self, df: DataFrame, table: str, batch: int, feed: str) -> None:
        with dropping_shuffles(df.sparkSession):
            df.write.mode("overwrite").partitionBy(*(c for c in PERIOD if c in df.columns)).parquet(self._folder(table, batch, feed))

    def _newest(self, feed: str) -> int | None:
        if not exists(self.spark, feed_root(self.settings, "published")):
            return None
        done = _published(self.spark, self.settings).where(F.col("feed") == feed)
        return done.agg(F.max("batch")).first()[0]

    def _waiting(self) -> DataFrame:
        schema = T.StructType([*self.transactions.schema, T.StructField("feed", T.StringType()),
                               T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(feed_root(self.settings, "waiting"))
        return rows.where(F.col("feed") == self.kind)

    def waiting(self, batch: int) -> DataFrame:
        """Transactions that were set aside in a batch."""
        return self._waiting().where(F.col("batch") == batch).drop("feed", "batch", "bucket")


def feed_root(settings: Settings, table: str) -> str:
    """Folder of increments: of a published table, or of the feeds' own notes."""
    return f"{path_of(settings, table)}_feed" if table in (FACTS, METRICS) else f"{path_of(settings, FACTS)}_{table}"


def _published(spark: SparkSession, settings: Settings) -> DataFrame:
    return spark.read.schema("id long, feed string, batch long").parquet(feed_root(settings, "published"))


def read_feed(spark: SparkSession, settings: Settings, table: str) -> DataFrame:
    """What all finished batches have written; filters on year and month prune folders."""
    done = _published(spark, settings).select("feed", "batch").distinct()
    rows = spark.read.parquet(feed_root(settings, table))
    rows = rows.join(done, ["feed", "batch"], "left_semi").drop("feed", "batch")
    return rows.select(*FACT_COLUMNS) if table == FACTS else rows
