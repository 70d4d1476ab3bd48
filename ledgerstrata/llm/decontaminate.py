"""Benchmark decontamination: a BM25 index of test items, queried by every training passage.

Each item is a document of the index; each passage of a text, two halves of ``stride``
words that overlap the next passage by one half, is a query. An item of at most ``stride``
words lies whole in some passage. A passage retrieves an item when its BM25 score reaches
``SHARE`` of the score that the item's own text gets.

Retrieval is block-max WAND: items stand in blocks of ``BLOCK``; per term and block the
highest impact, in units of the item's threshold, bounds what the term can add there. The
cheapest terms of an item, together at most ``CHEAP`` of its own score, are not looked up;
the most that they can add is part of the bound. Only blocks whose bound reaches one are
scored. Retrieved items are verified by the share of their five-word shingles in the passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.config import cut_lineage
from ledgerstrata.llm.common import small_batches

K1, B = 1.2, 0.75
SHARE = 0.6
CHEAP = 0.3
BLOCK = 8
SHINGLE_WORDS = 5
OVERLAP = 0.8
#: Halves of passages are at least so long; longer items get longer ones, by powers of four.
STRIDE = 64
#: Item text that one index, sent to every task, may hold. Larger benchmarks are cut into several indexes.
INDEX_BYTES = 4_000_000
#: Words of a text that are looked at together.
WORDS_AT_ONCE = 1 << 16

_PLAIN = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII punctuation and white space separate them."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    """Runs of five words; a shorter text is one shingle, an empty one none."""
    width = min(SHINGLE_WORDS, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()


def question_and_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """The last line, or else the last sentence, is the answer; a single sentence is both."""
    whole = (text or "").strip()
    for mark in ("\n", "? ", "! ", ". "):
        question, found, answer = whole.rpartition(mark)
        if found and words_of(question) and words_of(answer):
            return words_of(question), words_of(answer)
    return words_of(whole), words_of(whole)


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    own = shingles(part)
    width = min(SHINGLE_WORDS, len(part))
    there = {tuple(passage[i:i + width]) for i in range(len(passage) - width + 1)}
    return len(own & there) / len(own) if own else 0.0


def leaked(whole: float, question: float, answer: float) -> bool:
    return whole >= OVERLAP or (question >= OVERLAP and answer >= OVERLAP)


@dataclass
class _Index:
    """Items of one length class, sorted so that similar ones share a block."""

    stride: int
    items: list[tuple[int, str]]
    scores: list[dict[int, float]]
    thresholds: np.ndarray
    rest: np.ndarray
    start: np.ndarray
    blocks: np.ndarray
    bounds: np.ndarray

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(passage, item) of the words ``ids``: passage k starts at word k * stride."""
        counts = self.start[ids + 1] - self.start[ids]
        at = np.flatnonzero(counts)
        if not len(at):
            return
        n = counts[at]
        jump = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        entry = np.repeat(self.start[ids[at]], n) + jump
        halves, width = len(ids) // self.stride + 2, len(self.rest)
        cell = np.repeat(at // self.stride + 1, n) * width + self.blocks[entry]
        half = np.bincount(cell, self.bounds[entry], halves * width).reshape(halves, width)
        bound = half[:-1] + half[1:] + self.rest
        for k, block in zip(*np.nonzero(bound >= 1 - 1e-9)):
            first = max(0, (int(k) - 1) * self.stride)
            terms = set(ids[first:(int(k) + 1) * self.stride].tolist())
            for item in range(int(block) * BLOCK, min(len(self.items), (int(block) + 1) * BLOCK)):
                mine = self.scores[item]
                if sum(mine[t] for t in mine.keys() & terms) >= self.thresholds[item] * (1 - 1e-9):
                    yield int(k) - 1, item


class Benchmark:
    """A bounded part of the benchmark, ready to be asked; ``df`` counts over the whole of it."""

    def __init__(self, items: list[tuple[int, str]], df: dict[bytes, int], n_items: int, mean_words: float, names: dict[int, int | None]):
        self.names = names
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted(df))}
        by_class: dict[int, list[tuple[int, str]]] = {}
        for item in items:
            n, stride = len(words_of(item[1])), STRIDE
            while stride < n:
                stride *= 4
            if n:
                by_class.setdefault(stride, []).append(item)
        self.indexes = [self._index(stride, group, df, n_items, mean_words) for stride, group in sorted(by_class.items())]
        self.texts = {i: (words_of(t), *question_and_answer(t)) for i, t in items}

    def _index(self, stride, group, df, n_items, mean_words) -> _Index:
        group = sorted(group, key=lambda item: (sorted(set(words_of(item[1])), key=lambda w: (df[w], w))[-3:], item[0]))
        scores, thresholds, entries = [], [], []
        rest = np.zeros((len(group) + BLOCK - 1) // BLOCK)
        for at, (_, text) in enumerate(group):
            words = words_of(text)
            unique, tf = np.unique(np.array(words, dtype=object), return_counts=True)
            idf = np.log1p([(n_items - df[w] + 0.5) / (df[w] + 0.5) for w in unique])
            impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            threshold = SHARE * impact.sum()
            order = np.argsort(impact, kind="stable")
            cheap = np.cumsum(impact[order]) <= CHEAP * impact.sum()
            rest[at // BLOCK] = max(rest[at // BLOCK], impact[order][cheap].sum() / threshold)
            entries += [(self.vocabulary[unique[i]], at // BLOCK, impact[i] / threshold) for i in order[~cheap]]
            scores.append({self.vocabulary[w]: float(x) for w, x in zip(unique, impact)})
            thresholds.append(threshold)
        table = pd.DataFrame(entries, columns=["term", "block", "bound"]).groupby(["term", "block"], as_index=False)["bound"].max()
        counts = np.bincount(table["term"], minlength=len(self.vocabulary) + 1)
        start = np.concatenate([[0], np.cumsum(counts)])
        return _Index(stride, group, scores, np.array(thresholds), rest, start, table["block"].to_numpy(), table["bound"].to_numpy())

    def search(self, text: str | None) -> dict[int, tuple[int, float, float, float]]:
        """Per leaked item: first word of a passage that holds it best, and the overlaps of all, question, answer."""
        words = words_of(text)
        known = self.vocabulary.get
        ids = np.array([known(w, 0) for w in words], dtype=np.int64)
        best: dict[int, tuple[int, float, float, float]] = {}
        for index in self.indexes:
            step = max(1, WORDS_AT_ONCE // index.stride) * index.stride
            for origin in range(0, len(words), step):
                for k, item in index.candidates(ids[origin:origin + step + index.stride]):
                    first = origin + max(0, k * index.stride)
                    passage = words[first:origin + (k + 2) * index.stride]
                    number = index.items[item][0]
                    whole, question, answer = self.texts[number]
                    found = (first, overlap(whole, passage), overlap(question, passage), overlap(answer, passage))
                    if leaked(*found[1:]) and (number not in best or found[1:] > best[number][1:]):
                        best[number] = found
        return best


def benchmarks(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[Benchmark]:
    """The benchmark in parts of about ``INDEX_BYTES`` of text, with term statistics of all of it.

    An item is an id, null or not, with a text; each has a number of its own, and ``names`` says which id it has. So
    benchmarks joined from several sets may use an id twice. Rows without a text are left out, repeated ones count once.
    """
    items = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("name"), F.col(text_col).cast("string").alias("text")).distinct()
    items = cut_lineage(items.withColumn("id", F.xxhash64(F.col("name").isNull(), F.coalesce("name", F.lit(0)), "text")))

    def item_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, w) for i, t in zip(batch["id"], batch["text"]) for w in set(words_of(t))]
            yield pd.DataFrame(rows, columns=["id", "word"])

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [len(words_of(t)) for t in batch["text"]]})

    sizes = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not sizes["n"]:
        return []
    mean = items.mapInPandas(lengths, "n long").agg(F.avg("n")).first()[0] or 1.0
    parts = 1 + sizes["bytes"] // INDEX_BYTES
    items = items.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
    words = items.mapInPandas(item_words, "id long, word binary")
    df = words.groupBy("word").agg(F.count("*").alias("df"))
    out = []
    for part in range(parts):
        own = items.where(F.col("part") == part)
        mine = own.mapInPandas(item_words, "id long, word binary").select("word").distinct()
        counts = {bytes(r["word"]): r["df"] for r in df.join(mine, "word").collect()}
        held = own.orderBy("id").collect()
        out.append(Benchmark([(r["id"], r["text"]) for r in held], counts, sizes["n"], mean, {r["id"]: r["name"] for r in held}))
    return out


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, item_id, first_word, overlap, question_overlap, answer_overlap`` of each leak.

    One row per document row and leaked item (an id with one of its texts): the passage that holds the item best. A leak
    has ``OVERLAP`` or more of the item's shingles in one passage, or of both its question
    and its answer. Whole texts are searched; null and empty texts and items have no leak;
    repeated rows are each searched; a null id stays null; other columns are not read.
    """
    small_batches(docs.sparkSession)
    schema = "id long, item_id long, first_word long, overlap double, question_overlap double, answer_overlap double"
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    found = None
    for benchmark in benchmarks(items):
        def per_batch(batches: Iterator[pd.DataFrame], benchmark=benchmark) -> Iterator[pd.DataFrame]:
            for batch in batches:
                hits = [(i, benchmark.names[item], *hit) for i, t in zip(batch["id"], batch["text"]) for item, hit in benchmark.search(t).items()]
                out = pd.DataFrame(hits, columns=["id", "item_id", "first_word", "overlap", "question_overlap", "answer_overlap"])
                yield out.astype({"id": "Int64", "item_id": "Int64"})

        part = rows.mapInPandas(per_batch, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.withColumnRenamed("id", doc_id)


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a leaked item, columns unchanged, without a join or shuffle."""
    for benchmark in benchmarks(items):
        def keep(batches: Iterator[pa.RecordBatch], benchmark=benchmark) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                yield batch.filter(pa.array([not benchmark.search(t) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
