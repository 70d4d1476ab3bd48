"""Layouts, sweeps, bitmaps and marts by increments."""

import dataclasses
import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerstrata.catalog import FACTS, PERIOD, TABLES
from ledgerstrata.config import Settings
from ledgerstrata.operators import bitmaps
from ledgerstrata.operators.sweep import open_by_day
from ledgerstrata.sources import layouts
from ledgerstrata.sources.tables import path_of, read_table, schema_of
from ledgerstrata.streaming.marts import MartFeed

AS_OF = dt.date(2024, 6, 30)
DAY = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(3))
def test_open_versions_by_day(spark, rows_of, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(200):
        begin = rng.choice([None, *range(-20, 60)])
        rows.append((rng.choice(["a", "b", None]), begin is not None and DAY(begin) or None, rng.choice([None, DAY((begin or 0) + rng.randrange(40))])))
    history = spark.createDataFrame(rows, "kind string, __START_AT timestamp, __END_AT timestamp")
    got = rows_of(open_by_day(history, ["kind"], DAY(0).date(), DAY(30).date()))
    want = {}
    for kind, begin, end in rows:
        for n in range(31):
            if begin is not None and begin <= DAY(n) and (end is None or DAY(n) < end):
                want[kind, DAY(n).date()] = want.get((kind, DAY(n).date()), 0) + 1
    assert got == sorted(((*k, n) for k, n in want.items()), key=repr)
    assert open_by_day(history.limit(0), ["kind"], DAY(0).date(), DAY(3).date()).collect() == []


def test_numbers_without_gaps(spark):
    keys = spark.range(1000).repartition(7).select(F.col("id").cast("string").alias("k"))
    first = bitmaps.numbered(keys)
    assert sorted(r[0] for r in first.select(bitmaps.ID).collect()) == list(range(1, 1001))
    assert sorted(r[0] for r in bitmaps.numbered(keys.limit(3), 1000).select(bitmaps.ID).collect()) == [1001, 1002, 1003]
    assert bitmaps.numbered(keys.limit(0)).collect() == []


def test_bitmaps_merge_to_exact_counts(spark):
    rng = random.Random(4)
    rows = [(rng.choice("xy"), rng.choice([1, 32768, 32769, rng.randrange(1, 200_000), None])) for _ in range(3000)]
    df = spark.createDataFrame(rows, f"d string, {bitmaps.ID} long")
    halves = [bitmaps.pieces(df.where(F.pmod(F.xxhash64(bitmaps.ID), F.lit(2)) == i), ["d"]) for i in (0, 1)]
    got = {r.d: r.n for r in bitmaps.distinct_counts(halves[0].unionByName(halves[1]).unionByName(halves[1]), ["d"], "n").collect()}
    assert got == {d: len({i for x, i in rows if x == d and i is not None}) for d in "xy"}


def test_marts_after_repeated_and_late_batches(spark, rows_of, tmp_path):
    settings = Settings(root=str(tmp_path), as_of=AS_OF)
    metrics = spark.createDataFrame([
        (i, f"T{i}", None if i % 7 == 0 else f"C{i % 5}", DAY(i % 4).date(), f"R{i % 2}", "Night", "Weekday", "Low Income", "Low Value", 2024, 1, f"{i}.50")
        for i in range(60)], "nr int, transaction_id string, customer_id string, transaction_date date, region_name string, time_period string, day_type string, "
        "income_segment string, transaction_value_segment string, transaction_year int, transaction_month int, amount string").withColumn("amount", F.col("amount").cast("decimal(20,2)"))
    feed = MartFeed(spark, settings)
    for batch, where in enumerate(["nr < 20", "nr >= 40", "nr BETWEEN 20 AND 39"]):
        feed.take(metrics.where("nr = 59"), batch)  # a first try that is replaced
        feed.take(metrics.where(where), batch)
    want = metrics.groupBy("transaction_date").agg(F.count("*").alias("t"), F.countDistinct("customer_id").alias("a"))
    assert rows_of(feed.daily_activity()) == rows_of(want)
    want = metrics.groupBy("region_name", "time_period").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("v"))
    assert rows_of(feed.executive_dashboard(2024, 1)) == rows_of(want) and feed.executive_dashboard(2023, 1).count() == 0
    assert feed.income_segment_behaviour().first()["avg_amount"] == pytest.approx(30.0)
    assert feed.transaction_trends(DAY(2).date()).first()["transactions"] == 30


def test_bucketed_tables_join_without_exchange(spark, rows_of, tmp_path):
    settings = dataclasses.replace(Settings(root=str(tmp_path), as_of=AS_OF), env=f"t{uuid.uuid4().hex[:8]}")
    paid = spark.range(2000).select((F.col("id") % 300).cast("string").alias("card_id"), F.col("id").alias("amount"))
    owners = spark.range(300).select(F.col("id").cast("string").alias("card_id"), (F.col("id") % 9).alias("customer_id"))
    names = [layouts.write_bucketed(df, settings, name, ["card_id"], 8) for df, name in ((paid, "paid"), (owners, "owners"))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table(names[0]).join(spark.table(names[1]), "card_id").groupBy("card_id").agg(F.sum("amount").alias("s"))
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert rows_of(joined) == rows_of(paid.join(owners, "card_id").groupBy("card_id").agg(F.sum("amount").alias("s")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in names:
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"DROP DATABASE {settings.schema('bucketed')}")


def test_lookups_skip_row_groups(spark, tmp_path):
    rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.sha2((F.col("id") + 7).cast("string"), 256).alias("other"), "id")
    layouts.write_for_lookup(rows, str(tmp_path / "t"), ["k", "other"], expected_keys=200_000, group_bytes=1 << 20)
    for column, value in (("k", rows.where("id = 5").first().k), ("other", rows.where("id = 77").first().other)):
        found = spark.read.parquet(str(tmp_path / "t")).where(F.col(column) == value)
        assert found.count() == 1
        found.collect()
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numOutputRows").value() < 50_000
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_only_crowded_partitions_are_rewritten(spark, tmp_path):
    settings = Settings(root=str(tmp_path), as_of=AS_OF)
    schema = schema_of(spark, settings, FACTS)
    rows = spark.range(90).select(*(
        F.when(F.col("id") < 60, 1).otherwise(2).cast("int").alias(f.name) if f.name == "transaction_month" else F.lit(2024).cast("int").alias(f.name) if f.name == "transaction_year"
        else F.col("id").cast("string").cast(f.dataType).alias(f.name) if f.dataType.simpleString() == "string" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
    rows.where("transaction_month = 1").repartition(5).write.partitionBy(*PERIOD).parquet(path_of(settings, FACTS))
    rows.where("transaction_month = 2").coalesce(1).write.mode("append").partitionBy(*PERIOD).parquet(path_of(settings, FACTS))
    files = lambda: {r["transaction_month"]: r["files"] for r in layouts.partition_files(spark, settings, FACTS).collect()}
    whole = {str(p) for p in tmp_path.rglob("transaction_month=2/*.parquet")}
    assert files() == {1: 5, 2: 1} and TABLES[FACTS].partition_by == PERIOD
    assert layouts.compact_crowded(spark, settings, FACTS) == 1
    assert files() == {1: 1, 2: 1} and {str(p) for p in tmp_path.rglob("transaction_month=2/*.parquet")} == whole
    assert layouts.compact_crowded(spark, settings, FACTS) == 0
    assert sorted(int(r["transaction_id"]) for r in read_table(spark, settings, FACTS).collect()) == list(range(90))


def test_crowded_partitions_are_rewritten_in_bounded_jobs(spark, tmp_path, rows_of, monkeypatch):
    settings = Settings(root=str(tmp_path))
    schema = schema_of(spark, settings, FACTS)
    for _ in range(3):
        rows = spark.range(4).selectExpr("cast(id as string) AS transaction_id", "2024 AS transaction_year", "cast(id + 1 as int) AS transaction_month")
        filled = rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
        filled.coalesce(1).write.mode("append").partitionBy(*PERIOD).parquet(path_of(settings, FACTS))
    before = rows_of(read_table(spark, settings, FACTS), "transaction_id", "transaction_month")
    jobs = []

    def seen(session, writes=layouts.dropping_shuffles):
        jobs.append(len(layouts.partition_files(spark, settings, FACTS).where("files > 1").collect()))
        return writes(session)

    monkeypatch.setattr(layouts, "dropping_shuffles", seen, raising=False)
    monkeypatch.setattr(layouts, "REWRITTEN_AT_ONCE", 1, raising=False)
    assert layouts.compact_crowded(spark, settings, FACTS) == 4 and jobs == [4, 3, 2, 1]
    assert layouts.compact_crowded(spark, settings, FACTS) == 0
    assert rows_of(read_table(spark, settings, FACTS), "transaction_id", "transaction_month") == before
