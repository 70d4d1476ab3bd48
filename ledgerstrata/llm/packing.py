"""Best-fit packing by large-item matching.

Texts become token ids; those longer than a sequence are cut. What decides where a piece
goes is only how many pieces have each length, at most ``capacity`` numbers, whatever the
corpus. The plan is made on these counts:

* pieces above a third of the capacity are large; at most two fit one sequence. From the
  longest down, each is matched with the longest large piece that still fits;
* smaller pieces, from the longest down, go to the sequence with the least room that holds them.

A plan is a list of runs: so many equal sequences, each taking so many pieces of a length at
an offset. Pieces get a number within their length and look their run up.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ledgerstrata.config import cut_lineage
from ledgerstrata.llm.common import small_batches
from ledgerstrata.llm.tokens import Encoder

CAPACITY = 2048
#: Closes every document.
END_ID = 0


def piece_bounds(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Runs of a packing of ``counts[length]`` pieces, sorted by length and first piece.

    Run columns: length, first (number of its first piece within the length), pieces, each
    (pieces per sequence), sequence (its first sequence), offset (of the first piece there).
    """
    left = {n: c for n, c in counts.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    bins = 0
    rooms: dict[int, list[tuple[int, int]]] = {}

    def place(length: int, pieces: int, each: int, sequence: int, offset: int) -> None:
        runs.append((length, taken[length], pieces, each, sequence, offset))
        taken[length] += pieces
        left[length] -= pieces

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large.pop()
        while left[longest]:
            fit = bisect.bisect_right(large, capacity - longest)
            if 2 * longest <= capacity and left[longest] > 1:
                partner, n = longest, left[longest] // 2
            elif fit:
                partner = large[fit - 1]
                n = min(left[longest], left[partner])
            else:
                partner, n = 0, left[longest]
            place(longest, n, 1, bins, 0)
            if partner:
                place(partner, n, 1, bins, longest)
                if not left[partner] and partner != longest:
                    large.remove(partner)
            rooms.setdefault(capacity - longest - partner, []).append((bins, n))
            bins += n
    open_rooms = sorted(r for r in rooms if r)

    def put_back(room: int, sequences: tuple[int, int]) -> None:
        if room:
            if room not in rooms or not rooms[room]:
                rooms[room] = []
                bisect.insort(open_rooms, room)
            rooms[room].append(sequences)

    for length in sorted((n for n in left if left[n]), reverse=True):
        while left[length]:
            at = bisect.bisect_left(open_rooms, length)
            if at == len(open_rooms):
                need = -(-left[length] // (capacity // length))
                put_back(capacity, (bins, need))
                bins += need
                continue
            room = open_rooms[at]
            first, n = rooms[room].pop()
            if not rooms[room]:
                open_rooms.pop(at)
            each = room // length
            full = min(n, left[length] // each)
            if full:
                place(length, full * each, each, first, capacity - room)
                put_back(room - each * length, (first, full))
            first, n = first + full, n - full
            if n and left[length]:
                some = left[length]
                place(length, some, some, first, capacity - room)
                put_back(room - some * length, (first, 1))
                first, n = first + 1, n - 1
            if n:
                put_back(room, (first, n))
    names = ("length", "first", "pieces", "each", "sequence", "offset")
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, len(names))
    return dict(zip(names, table.T))


def tokenized_pieces(docs: DataFrame, capacity: int = CAPACITY, encoder: Encoder | None = None,
                     keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, task, number`` and, if asked for, ``ids``.

    ``number`` counts the pieces of one length within a task, from 0. Every text gets its
    closing id, so a null or empty text is one piece of one id.
    """
    small_batches(docs.sparkSession)
    encoder = encoder or Encoder()

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encoder.ids(text), np.uint32(END_ID)).astype("<u4")
                for piece, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    own = ids[start:start + length]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own.tobytes()), task, int(seen[length]), own.astype(np.int64) if keep_ids else None))
                    seen[length] += 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "number", "ids"])
            yield out.astype({"doc_id": "Int64"}) if keep_ids else out.drop(columns="ids").astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"
    return rows.mapInPandas(per_task, schema + (", ids array<long>" if keep_ids else ""))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, encoder: Encoder | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    The pieces of a sequence lie one after another from offset 0 and never exceed the
    capacity. Null texts are empty; empty texts are one closing id; equal lengths are
    taken in the order of their table part. Repeated rows and null ids are packed like others; other
    columns are not read; an empty table gives no rows.

    The tokenized pieces are written once. To the driver goes one count per length.
    """
    pieces = cut_lineage(tokenized_pieces(docs, capacity, encoder, keep_ids))
    parts = cut_lineage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    plan = plan_packing({r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    # One row per length and task: the numbers of a task start where the tasks before it end.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = (pieces.join(starts, ["length", "task"])
                .withColumn("number", F.col("number") + F.col("base")).drop("base", "task"))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scale = 1 << 44
        keys = plan["length"] * scale + plan["first"]
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch.pop("number").to_numpy()
            run = np.searchsorted(keys, length * scale + number, side="right") - 1
            nth = number - plan["first"][run]
            batch["sequence_id"] = plan["sequence"][run] + nth // plan["each"][run]
            batch["offset"] = plan["offset"][run] + nth % plan["each"][run] * length
            yield batch.astype({"doc_id": "Int64"})

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    schema = ", ".join(f"{c} {t}" for c, t in numbered.select(*names).dtypes) + ", sequence_id long, offset long"
    return numbered.select(*names, "number").mapInPandas(placed, schema)
