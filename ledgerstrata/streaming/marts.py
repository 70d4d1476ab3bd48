"""Marts kept by increments: partial results per batch, merged when they are read.

A batch writes one folder per table, so a repeated batch replaces what it wrote, and late rows are just part of a later
batch. Reading sums a few rows per group and batch; transactions are never read again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import METRICS
from ..config import Settings
from ..operators import bitmaps
from ..operators.hotkeys import join_on
from ..sources.tables import exists, path_of, sized_for_writing

#: Partial tables and the columns they are grouped by.
PARTIALS = {
    "dashboard": ("region_name", "time_period", "transaction_year", "transaction_month"),
    "trends": ("day_type", "income_segment", "transaction_value_segment", "transaction_date"),
    "segments": ("income_segment",),
    "days": ("transaction_date",),
}


class MartFeed:
    """Partial results of the metrics, batch by batch."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark = spark
        self.root = f"{path_of(settings, METRICS)}_partials"

    def _folder(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def take(self, metrics: DataFrame, batch: int) -> None:
        """Fold a batch of metrics in; batches come in order, and may come again."""
        for table, keys in PARTIALS.items():
            amounts = metrics.groupBy(*keys).agg(
                F.count(F.lit(1)).alias("rows"), F.count("amount").alias("amounts"), F.sum("amount").cast("decimal(38,2)").alias("volume"))
            amounts.write.mode("overwrite").parquet(self._folder(table, batch))
        people = metrics.where("customer_id IS NOT NULL").select("customer_id", "transaction_date").distinct()
        known = self._ids().where(F.col("batch") < batch).drop("batch")
        new = join_on(people.select("customer_id").distinct(), known, ["customer_id"], "left_anti")
        last = known.agg(F.max(bitmaps.ID)).first()[0] or 0
        bitmaps.numbered(new, last).write.mode("overwrite").parquet(self._folder("ids", batch))
        ids = self._ids().where(F.col("batch") <= batch).drop("batch")
        active = bitmaps.pieces(people.join(ids, "customer_id"), ["transaction_date"])
        sized_for_writing(active, []).write.mode("overwrite").parquet(self._folder("active", batch))

    def _ids(self) -> DataFrame:
        schema = f"customer_id string, {bitmaps.ID} long, batch long"
        if not exists(self.spark, f"{self.root}/ids"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/ids")

    def _merged(self, table: str) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.root}/{table}")
        return rows.groupBy(*PARTIALS[table]).agg(*(F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in ("rows", "amounts", "volume")))

    def executive_dashboard(self, year: int, month: int) -> DataFrame:
        chosen = self._merged("dashboard").where((F.col("transaction_year") == year) & (F.col("transaction_month") == month))
        return chosen.select("region_name", "time_period", F.col("rows").alias("transaction_count"), F.col("volume").alias("total_volume"))

    def transaction_trends(self, since: dt.date) -> DataFrame:
        keys = PARTIALS["trends"][:3]
        sums = self._merged("trends").where(F.col("transaction_date") >= F.lit(since)).groupBy(*keys).agg(
            F.sum("rows").alias("transactions"), F.sum("volume").cast("double").alias("_volume"), F.sum("amounts").alias("_amounts"))
        return sums.select(*keys, "transactions", F.try_divide("_volume", "_amounts").alias("avg_amount"))

    def income_segment_behaviour(self) -> DataFrame:
        return self._merged("segments").select(
            "income_segment", F.col("rows").alias("transactions"),
            F.try_divide(F.col("volume").cast("double"), "amounts").alias("avg_amount"), F.col("volume").alias("total_volume"))

    def daily_activity(self) -> DataFrame:
        """Transactions and active customers per day, the latter exact by merged bitmaps."""
        active = bitmaps.distinct_counts(self.spark.read.parquet(f"{self.root}/active"), ["transaction_date"], "_active")
        days = self._merged("days").select("transaction_date", F.col("rows").alias("transactions"))
        both = join_on(days, active, ["transaction_date"], "left")
        return both.select("transaction_date", "transactions", F.coalesce("_active", F.lit(0)).alias("active_customers"))
