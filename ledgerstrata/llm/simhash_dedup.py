"""SimHash near-duplicates by multi-index hashing.

A text gets a 64-bit fingerprint from its word shingles. Fingerprints within ``RADIUS``
bits are linked. A fingerprint is cut in two segments of 32 bits: two fingerprints at
most 3 bits apart differ by at most one bit in one of the segments, so probing a table
of segments with the Hamming ball of radius one finds every such pair. A ball is probed
upwards only (zero bits set to one), as the other of the two has the bit set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstrata.config import cut_lineage
from ledgerstrata.llm.common import connected_components, small_batches

RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
SEGMENTS = 2
SEGMENT_BITS = 64 // SEGMENTS
#: Shingles voted on at once, so that memory does not follow the length of a text.
VOTES_AT_ONCE = 16_384

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def text_fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of one whole text; zero where there is no word."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate([[0], ends[:-1]])
    width = min(words, len(tokens))
    first, last = starts[: len(tokens) - width + 1].tolist(), (ends[width - 1:] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), VOTES_AT_ONCE):
        part = slice(at, at + VOTES_AT_ONCE)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first[part], last[part])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp`` of every row; a null text counts as empty."""
    small_batches(docs.sparkSession)

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "fp": np.array([text_fingerprint(t) for t in batch["text"]], dtype=np.int64)})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(per_batch, "id long, fp long").withColumnRenamed("id", id_col)


def _near(a: str | Column, b: str | Column) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= RADIUS


def near_fingerprints(fps: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect the same groups as all pairs of distinct ``fp`` within the radius.

    Per segment value the smallest fingerprint that owns it is the hub. First everything
    that hits the value is compared with the hub, a number of rows linear in the input.
    Only values whose fingerprints are still in several groups are then compared in
    full, and only across groups, so a large group of near copies gives no square of
    pairs and no link is lost.
    """
    whole = F.array(*[F.struct(F.lit(s).alias("segment"),
                               F.shiftrightunsigned("fp", s * SEGMENT_BITS).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1)).alias("value"))
                      for s in range(SEGMENTS)])
    owners = fps.select("fp", F.inline(whole))
    flips = F.array(*[F.lit(1 << bit) for bit in range(SEGMENT_BITS)])
    visitors = (owners.select("fp", "segment", "value", F.explode(flips).alias("flip"))
                .where(F.col("value").bitwiseAND(F.col("flip")) == 0)
                .select("fp", "segment", F.col("value").bitwiseOR(F.col("flip")).alias("value")))
    hubs = cut_lineage(owners.groupBy("segment", "value").agg(F.min("fp").alias("hub")))
    # Spark sizes exploded rows as if they were one each, and would broadcast all visitors: so both sides are shuffled, always.
    hits = (owners.withColumn("owner", F.lit(True)).unionByName(visitors.withColumn("owner", F.lit(False)))
            .hint("merge").join(hubs, ["segment", "value"]).where("fp <> hub or not owner"))
    hits = cut_lineage(hits)
    edges = hits.where(_near("fp", "hub")).select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    groups = cut_lineage(connected_components(edges))

    hubs_hit = hits.select("segment", "value", F.col("hub").alias("fp"), F.lit(True).alias("owner")).distinct()
    placed = (hits.drop("hub").unionByName(hubs_hit).hint("merge")
              .join(groups.select(F.col("node").alias("fp"), F.col("component_id").alias("g")), "fp", "left")
              .withColumn("g", F.coalesce("g", "fp")))
    placed = cut_lineage(placed)
    mixed = placed.groupBy("segment", "value").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").drop("lo", "hi")
    placed = cut_lineage(placed.join(cut_lineage(mixed), ["segment", "value"]))
    own = placed.where("owner").select("segment", "value", F.col("fp").alias("a"), F.col("g").alias("ga"))
    other = placed.select("segment", "value", F.col("fp").alias("b"), F.col("g").alias("gb"), "owner")
    rest = (own.hint("merge").join(other, ["segment", "value"])
            .where((F.col("ga") != F.col("gb")) & (~F.col("owner") | (F.col("a") < F.col("b"))) & _near("a", "b"))
            .select("a", "b"))
    return groups.where("node <> component_id").select(F.col("component_id").alias("a"), F.col("node").alias("b")).unionByName(rest)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, fingerprint, component_id``.

    ``fingerprint`` is 16 lower-case hex digits, ``component_id`` the smallest id that is
    reachable by links of at most ``RADIUS`` bits, itself included. Texts without words
    (empty, blank, null) have fingerprint zero and are linked like any other. Repeated
    rows and ids stay. A row with a null id is returned and connects others, but names no
    group: ``component_id`` is null only where all ids of its group are null. Other
    columns of ``docs`` are not read; an empty table gives no rows.
    """
    fps = cut_lineage(fingerprints(docs, id_col, text_col))
    first = cut_lineage(fps.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    groups = cut_lineage(connected_components(near_fingerprints(first.select("fp"))))
    grouped = (first.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "first_id", F.coalesce("component_id", "fp").alias("root")))
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(smallest, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, one of each group: the one that names it. Columns stay as they are.

    Rows that repeat the naming id are reduced to one; rows with a null id are kept, as
    they cannot be told apart.
    """
    keep = (simhash_groups(docs, id_col, text_col).where(F.col(id_col) == F.col("component_id"))
            .select(F.col(id_col).alias("_keep")).distinct())
    one = docs.join(keep, docs[id_col] == keep["_keep"], "left_semi").dropDuplicates([id_col])
    return one.unionByName(docs.where(F.col(id_col).isNull()))
