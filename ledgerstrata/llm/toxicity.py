"""Toxicity scores by a factorization machine over hashed terms.

A text is the set of its hashed terms: lower-case words and the first letters of long
words, so that unseen endings of a known stem still count. The machine has a weight per
term and a short vector per term whose dot products weigh pairs of terms.

The machine is fitted on at most ``FIT_ROWS`` labelled rows that may be learned from, those
with the smallest id hash, at most half of them of one label; the bias is then set back to the odds
of all labelled rows, so that a score means the same at every size. Of their terms the ``TERMS``
that tell the labels apart best enter the machine. All documents are scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.config import cut_lineage
from ledgerstrata.llm.common import small_batches

SLOTS = 1 << 20
STEMS = (4, 5, 6)
TERMS = 8192
#: A term enters when its log odds are this many standard errors from zero.
MIN_Z = 2.5
FACTORS = 4
#: Upper bound of the labelled rows that are learned from; half of it for either label.
FIT_ROWS = 40_000
EPOCHS = 30
FOLDS = 5
#: Words a worker remembers between texts.
REMEMBERED = 400_000

_WORD = re.compile(r"[^\W_]+")


def word_slots(word: str) -> tuple[int, ...]:
    """Slots of one lower-case word: the word, and its stems where it is longer than they are."""
    terms = [word, *(f"{word[:n]}\u0001" for n in STEMS if len(word) > n)]
    return tuple(xxhash.xxh32_intdigest(t.encode("utf-8", "surrogatepass")) % SLOTS for t in terms)


class _Terms:
    """Texts to sorted term numbers, of all slots or of a chosen few."""

    def __init__(self, chosen: np.ndarray | None = None):
        self.rank = None if chosen is None else {int(s): i for i, s in enumerate(chosen)}
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str | None) -> list[int]:
        found: set[int] = set()
        known = self.known
        for word in set(_WORD.findall((text or "").lower())):
            got = known.get(word)
            if got is None:
                got = word_slots(word)
                if self.rank is not None:
                    got = tuple(self.rank[s] for s in got if s in self.rank)
                if len(known) >= REMEMBERED:
                    known.clear()
                known[word] = got
            if got:
                found.update(got)
        return sorted(found)


@dataclass
class Machine:
    """A fitted machine; ``terms`` are slots, in the order of ``weights`` and ``factors``."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, numbers: list[int]) -> float:
        x = self.bias
        if numbers:
            v = self.factors[numbers]
            x += self.weights[numbers].sum() + 0.5 * (v.sum(axis=0) ** 2 - (v ** 2).sum(axis=0)).sum()
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def fit_machine(terms: np.ndarray, rows: list[tuple[np.ndarray, int]], seed: int = 7) -> Machine:
    """Adagrad on the logistic loss, in small batches; a bounded number of rows by construction."""
    random = np.random.default_rng(seed)
    n = len(terms)
    weights, factors = np.zeros(n), random.normal(0, 0.05, (n, FACTORS))
    labels = np.array([y for _, y in rows], dtype=float)
    rate = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.0
    bias = float(np.log(rate / (1 - rate))) if 0 < rate < 1 else -30.0
    if not len(labels) or labels.min() == labels.max():
        return Machine(terms, bias, weights, factors * 0)
    gw, gv, gb = np.full(n, 1e-8), np.full((n, FACTORS), 1e-8), 1e-8
    size, step, shrink = 64, 0.1, 1e-5
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), size):
            part = order[at:at + size]
            ids = np.concatenate([rows[i][0] for i in part]).astype(np.int64)
            owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            v = factors[ids]
            total = np.zeros((len(part), FACTORS))
            np.add.at(total, owner, v)
            squares = np.bincount(owner, (v ** 2).sum(axis=1), len(part))
            x = bias + np.bincount(owner, weights[ids], len(part)) + 0.5 * ((total ** 2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(x, -30, 30))) - labels[part]) / size
            db = error.sum()
            gb += db * db
            bias -= step * db / np.sqrt(gb)
            touched, place = np.unique(ids, return_inverse=True)
            dw = np.bincount(place, error[owner], len(touched)) + shrink * weights[touched]
            dv = np.zeros((len(touched), FACTORS))
            np.add.at(dv, place, error[owner, None] * (total[owner] - v))
            dv += shrink * factors[touched]
            gw[touched] += dw * dw
            weights[touched] -= step * dw / np.sqrt(gw[touched])
            gv[touched] += dv * dv
            factors[touched] -= step * 0.3 * dv / np.sqrt(gv[touched])
    return Machine(terms, bias, weights, factors)


def _term_counts(labelled: DataFrame) -> DataFrame:
    """``slot, n0, n1``: texts of either label that hold the term, of the rows given."""

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, counts = _Terms(), np.zeros((2, SLOTS), np.int32)
        for batch in batches:
            for text, y in zip(batch["text"], batch["toxic"]):
                counts[int(y), terms.of(text)] += 1
        slots = np.flatnonzero(counts.sum(axis=0))
        for at in range(0, len(slots), 50_000):
            part = slots[at:at + 50_000]
            yield pd.DataFrame({"slot": part, "n0": counts[0, part], "n1": counts[1, part]})

    found = labelled.select("text", "toxic").mapInPandas(per_task, "slot int, n0 long, n1 long")
    return found.groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on the texts of ``docs`` whose ``labels.toxic`` is 0 or 1 and whose fold is not 0.

    Labels are aggregated per ``doc_id`` (the highest counts), so repeated label rows do
    no harm; labels that are null are ignored. Without both labels every score is the
    share of toxic rows (0 where there is none).
    """
    small_batches(docs.sparkSession)
    marks = (labels.where("toxic in (0, 1) and doc_id is not null")
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    marks = cut_lineage(marks)
    chosen_rows = None
    for y in (0, 1):
        part = marks.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS // 2)
        chosen_rows = part if chosen_rows is None else chosen_rows.unionByName(part)
    chosen_rows = cut_lineage(chosen_rows)  # at most FIT_ROWS ids and labels, so a broadcast is bounded
    everyone, taken = ({r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()} for rows in (marks, chosen_rows))
    # Log ratio of the true odds of toxic rows to those of the sample; the cut of a label only moves the bias.
    shift = float(np.log(everyone[1] / taken[1]) - np.log(everyone[0] / taken[0])) if len(taken) == 2 else 0.0
    labelled = cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                           .join(F.broadcast(chosen_rows), "doc_id").dropDuplicates(["doc_id"]))
    totals = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = float(totals.get(0, 0)), float(totals.get(1, 0))
    counts = _term_counts(labelled)
    odds = F.log((F.col("n1") + 0.5) / (n1 - F.col("n1") + 0.5)) - F.log((F.col("n0") + 0.5) / (n0 - F.col("n0") + 0.5))
    error = F.sqrt(sum(1 / x for x in (F.col("n1") + 0.5, n1 - F.col("n1") + 0.5, F.col("n0") + 0.5, n0 - F.col("n0") + 0.5)))
    best = (counts.where("n0 + n1 >= 3").withColumn("z", F.abs(odds / error)).where(F.col("z") >= MIN_Z)
            .orderBy(F.desc("z"), "slot").limit(TERMS).select("slot").collect())
    chosen = np.array(sorted(r["slot"] for r in best), dtype=np.int64)

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = _Terms(chosen)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": [terms.of(t) for t in batch["text"]]})

    sample = (labelled.select("doc_id", "text", "toxic")
              .mapInPandas(reduce_rows, "doc_id long, toxic int, terms array<int>").collect())
    sample.sort(key=lambda r: (r["doc_id"], r["terms"]))
    machine = fit_machine(chosen, [(np.array(r["terms"], dtype=np.int64), r["toxic"]) for r in sample])
    if n0 and n1:
        machine.bias += shift
    return machine


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Whole texts are scored; null and empty texts get the score of no terms. ``held_out``
    rows (crc32 of the id as text divisible by 5, and rows with a null id) are never
    learned from. Label, language, source and id are no inputs of a score. Repeated rows
    are scored each; other columns are not read; an empty table gives no rows.
    """
    machine = train(docs, labels)  # sent to every task: at most TERMS x (FACTORS + 2) numbers

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = _Terms(machine.terms)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"],
                                "score": [machine.score(terms.of(t)) for t in batch["text"]]})

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return (rows.mapInPandas(per_batch, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, columns unchanged, without a join or shuffle."""
    machine = train(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms(machine.terms)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([machine.score(terms.of(t)) < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
