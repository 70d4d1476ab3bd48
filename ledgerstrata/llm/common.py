"""Shared pieces of the corpus operators: connected components and table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.config import cut_lineage

#: Rows of text handed to a Python worker at once; keeps a batch of long documents small.
TEXT_ROWS_PER_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS_PER_BATCH) -> None:
    """Bound the Arrow batches of the session, as one document can hold megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as edges ``a, b`` of any orderable type.

    Returns ``node, component_id`` for every node that has an edge to another node;
    ``component_id`` is the smallest node of the component. Rounds of large-star and
    small-star (every node hands its neighbours to the smallest of them) run until the
    edges form stars. Each round is two aggregates and two joins with their written results;
    as both sides of a join come from files, Spark can split a node with many neighbours.
    Nothing is gathered per component. Null ends and loops are ignored.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = cut_lineage(edges.distinct())
    while not _are_stars(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.distinct())
        lowest = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
    members = stars.select(F.col("u").alias("node"), F.col("v").alias("component_id"))
    centres = stars.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
    return members.unionByName(centres)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every left end occurs once and is no right end."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("left"), F.lit(0).alias("right")).unionAll(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("left"), F.lit(1).alias("right")))
    odd = ends.groupBy("n").agg(F.sum("left").alias("left"), F.max("right").alias("right"))
    return odd.where("left + right > 1").isEmpty()
