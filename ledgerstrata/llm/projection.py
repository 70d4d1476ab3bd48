"""Embedding near-duplicates by sorted projection passes.

In each pass every vector gets ``HASHES`` bits, the sides of random hyperplanes that it lies
on. Vectors are ordered by label and by these bits read as one word, cut into blocks of
``BLOCK`` neighbours, and each block is compared with itself and the next one. Pairs of cosine
``THRESHOLD`` or more are verified in double precision; a comparison hands on only the pairs
that join something new, so crowds of copies stay cheap. The passes together give the groups.

Links are then counted inside the groups, in tiles of bounded size, so that the number of
links of a vector is whole even where a group is much larger than a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ledgerstrata.config import cut_lineage
from ledgerstrata.llm.common import connected_components

THRESHOLD = 0.93
PASSES = 16
HASHES = 48
BLOCK = 256
#: Members of a group that are compared in one piece; larger groups are cut into tiles of this size.
TILE = 256
SEED = 11


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pass_keys(unit: np.ndarray) -> np.ndarray:
    """One sort key per vector and pass, as non-negative integers of ``HASHES`` bits."""
    planes = np.random.default_rng([SEED, unit.shape[1]]).normal(size=(PASSES, unit.shape[1], HASHES))
    weights = np.int64(1) << np.arange(HASHES - 1, -1, -1, dtype=np.int64)
    return np.stack([((unit @ planes[p]) >= 0) @ weights for p in range(PASSES)], axis=1)


def _roots(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that connect something that was apart."""
    parent, kept = list(range(n)), []
    for a, b in pairs.tolist():
        x, y = a, b
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[x] = y
            kept.append((a, b))
    return kept


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """Rows with id, label and a vector that is finite and not zero; hashes tell vectors apart."""
    v = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.cast("array<double>").alias("embedding"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).where(sound)
    return rows.withColumn("h1", F.xxhash64(v)).withColumn("h2", F.xxhash64(F.lit(1), v))


def _forest_edges(reps: DataFrame) -> DataFrame:
    """``a, b``: verified pairs of the passes, as far as they join what their block had apart."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, same in batch.groupby(batch["embedding"].map(len)):
                unit = unit_rows(same["embedding"].tolist())
                keys = pass_keys(unit)
                blobs = [u.tobytes() for u in unit]
                for p in range(PASSES):
                    yield pd.DataFrame({"pass": p, "space": same["space"].to_numpy(), "key": keys[:, p], "node": same["node"].to_numpy(), "unit": blobs})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) > BLOCK:
                yield held[:BLOCK].assign(task=task, number=number)
                held, number = held[BLOCK:].reset_index(drop=True), number + 1
        if held is not None and len(held):
            yield held.assign(task=task, number=number)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, _), same in group.groupby([group["pass"], group["unit"].map(len)]):
            unit = np.stack([np.frombuffer(u) for u in same["unit"]])
            space, nodes, first = same["space"].to_numpy(), same["node"].to_numpy(), same["first"].to_numpy()
            near = np.argwhere(np.triu((unit @ unit.T >= THRESHOLD) & (space[:, None] == space[None, :]) & (first[:, None] | first[None, :]), 1))
            found += [(nodes[i], nodes[j]) for i, j in _roots(len(nodes), near)]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    shape = "pass int, space string, key long, node long, unit binary"
    order = ["pass", "space", "key", "node"]
    rows = cut_lineage(reps.mapInPandas(keyed, shape))
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    cut = cut_lineage(ordered.mapInPandas(blocks, shape + ", task int, number int").drop("key"))
    sizes = sorted(cut.groupBy("task").agg(F.max("number").alias("n")).collect())  # one row per task
    starts, at = [], 0
    for task, n in sizes:
        starts.append((task, at))
        at += n + 1
    if not starts:
        return rows.sparkSession.createDataFrame([], "a long, b long")
    base = cut.sparkSession.createDataFrame(starts, "task int, base long")
    block = cut.join(base, "task").withColumn("block", F.col("base") + F.col("number")).drop("task", "number", "base")
    twice = block.withColumn("first", F.lit(True)).unionByName(
        block.withColumn("block", F.col("block") - 1).withColumn("first", F.lit(False)))
    return twice.where("block >= 0").groupBy("block").applyInPandas(compare, "a long, b long")


def _link_counts(members: DataFrame) -> DataFrame:
    """``node, links``: weights of the other members of the group within the threshold.

    ``members``: node, group, weight, space, embedding. Small groups share a task; a group above
    ``TILE`` is cut by hash into tiles, and each pair of tiles is one piece of work.
    """
    sizes = members.groupBy("group").agg(F.count("*").alias("size"))
    tiles = F.greatest(F.lit(1), F.ceil(F.col("size") / TILE)).cast("int")
    rows = members.join(sizes, "group").withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    pieces = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda i: F.struct(F.least(i, F.col("tile")).alias("i"), F.greatest(i, F.col("tile")).alias("j")))
    rows = rows.withColumn("piece", F.explode(pieces)).withColumn(
        "work", F.when(F.col("tiles") > 1, F.xxhash64("group", "piece")).otherwise(F.pmod(F.xxhash64("group"), F.lit(1 << 12))))

    def count(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, same in group.groupby(["group", "i", "j", "space"], sort=False):
            unit, weight, tile = unit_rows(same["embedding"].tolist()), same["weight"].to_numpy(), same["tile"].to_numpy()
            i, j = same["i"].iloc[0], same["j"].iloc[0]
            near = unit @ unit.T >= THRESHOLD
            np.fill_diagonal(near, False)
            if i != j:
                near &= tile[:, None] != tile[None, :]
            out.append(pd.DataFrame({"node": same["node"].to_numpy(), "links": near @ weight}))
        return pd.concat(out)

    work = rows.select("work", "group", "node", "weight", "space", "embedding", "tile", "piece.i", "piece.j")
    return work.groupBy("work").applyInPandas(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame) -> DataFrame:
    """One row per vector row: ``vec_id, n_links, component_id, kept``.

    Only vectors of equal label (and length) are compared. Vectors that are null, zero, or hold
    null or non-finite numbers, and those with a null label or id, link with nothing: no link,
    the own id as component, kept. Equal vectors are one node with a weight, so copies are never
    expanded into pairs. Rows that repeat an id and its vector count once; rows of one id with
    different vectors are one node and their links add up. Other columns are not read; an
    empty table gives no rows.
    """
    rows = cut_lineage(usable_vectors(vectors).withColumn("space", F.concat_ws(":", F.col("label").cast("string"), F.size("embedding"))))
    place = ["space", "h1", "h2"]
    copies = rows.groupBy(*place).agg(F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("weight"))
    copies = cut_lineage(copies)
    reps = cut_lineage(rows.join(copies, place).where("vec_id = node").dropDuplicates(["node", *place])
                       .select("node", "weight", "space", "embedding"))
    groups = cut_lineage(connected_components(_forest_edges(reps)))
    members = reps.join(groups.withColumnRenamed("component_id", "group"), "node")
    counts = _link_counts(members)
    named = (copies.join(groups, "node", "left").join(counts, "node", "left")
             .select(*place, F.coalesce("component_id", "node").alias("component_id"),
                     (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    ids = rows.join(named, place).select("vec_id", "n_links", "component_id").groupBy("vec_id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(ids, "vec_id", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce("vec_id", F.lit(0)).eqNullSafe(F.coalesce("component_id", "vec_id", F.lit(0))).alias("kept"))
