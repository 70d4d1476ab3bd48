"""Physical plans: what is shuffled, pruned, pushed down and split."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerstrata.checks.sparkquery import QUERIES, Bank
from ledgerstrata.operators.hotkeys import SLICE, in_slices
from ledgerstrata.plans import gold

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_runs_python_per_row(spark):
    for name in ("fact_union", "dim_customers", "asof_join_events", "quality_metrics", "geography"):
        assert not re.search(r"Python|Pandas|Arrow", plan_of(QUERIES[name](spark, SF))), name


def test_report_reads_only_its_columns(spark):
    plan = plan_of(QUERIES["exec_dashboard"](spark, SF))
    lines = re.search(r"\[(l_[^\]]*)\]", plan).group(1)
    assert {c.split("#")[0] for c in lines.split(",")} == {"l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate"}


def test_transactions_are_shuffled_once(spark):
    """Dimensions are joined among themselves first."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        bank = Bank(spark, SF)
        owned = bank.fact_source("card_transactions").join(bank.card_owners(), "card_id")
        plan = plan_of(owned)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above_scan = plan.split("l_orderkey")[0]
    assert above_scan.count("Exchange hashpartitioning(card_id") == 1
    assert above_scan.count("Exchange") == 1


def test_small_dimensions_are_broadcast_by_size(spark):
    plan = plan_of(Bank(spark, SF).card_facts())
    assert "BroadcastHashJoin [region_id" in plan and "BroadcastHashJoin [city_id" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_a_hot_card_is_split_at_run_time(spark, tmp_path):
    """A third of the payments by one card: the join splits its partition."""
    session = spark.newSession()
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }.items():
        session.conf.set(key, value)
    path = str(tmp_path / "payments")
    session.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 900).cast("string")).alias("card_id"),
        F.md5(F.col("id").cast("string")).alias("card_transaction_id")).write.parquet(path)
    cards = session.range(900).select(F.col("id").cast("string").alias("card_id"), F.lit("A").alias("account_id"))
    cards = cards.unionByName(session.createDataFrame([("hot", "A")], "card_id string, account_id string"))
    owners = session.createDataFrame([("A", "1", 40, 1)], "account_id string, customer_id string, client_age int, customer_income int")
    joined = session.read.parquet(path).join(gold.card_owners(cards, owners), "card_id")
    assert len(joined.collect()) == 60000
    assert "skew=true" in plan_of(joined)


@pytest.mark.parametrize("kind", ["date", "timestamp", "bigint", "string", "decimal(12,2)"])
def test_slices_are_even_and_ordered(spark, kind):
    made = {"date": "date_add(DATE'2000-01-01', int(id))", "timestamp": "timestamp_seconds(id * 1000)", "string": "lpad(id, 6, '0')"}
    rows = spark.range(5000).select(F.lit("k").alias("k"), F.expr(made.get(kind, f"cast(id as {kind})")).alias("t"))
    sliced = in_slices(rows, ["k"], ["t"], 600)
    bounds = sliced.groupBy(SLICE).agg(F.count("t").alias("n"), F.min("t").alias("a"), F.max("t").alias("b")).orderBy(SLICE).collect()
    assert len(bounds) == 9 and all(r["n"] < 1200 for r in bounds)
    assert all(x["b"] < y["a"] for x, y in zip(bounds, bounds[1:]))


def test_one_moment_is_cut_into_slices(spark):
    """A thousand facts of one key and one date do not meet in one task."""
    rows = spark.range(1000).select(F.lit("k").alias("k"), F.expr("DATE'2024-01-01'").alias("_at"), F.lit(1).alias("_kind"), "id")
    counts = in_slices(rows, ["k"], ["_at", "_kind", F.xxhash64("id")], 100).groupBy(SLICE).count().collect()
    assert len(counts) == 10 and max(r["count"] for r in counts) < 250
