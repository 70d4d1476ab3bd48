"""Exact substring dedup by prefix-free parsing.

The rolling hash of every ``GRAM`` bytes is taken along a text; the smallest within a string of
``MATCH`` bytes is its trigger. Consecutive strings with the same trigger make up a phrase: the
bytes from the first to the end of the last. Triggers depend on the bytes of a string alone,
so equal strings have equal triggers at equal places, whatever stands around them.

The parse is the table of phrase occurrences, the dictionary the distinct phrases. A phrase that
occurs twice is repeated as a whole, and nothing else is asked of it. Strings of a phrase that
occurs once can only be equal to strings of other phrases of the same trigger, so the
``MATCH``-byte prefixes of the suffixes of these phrases are put in order (of their
fingerprints; only equality is asked for) and neighbours that are equal are repeats. Repetitive text
gives many occurrences of few phrases, and only the dictionary is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.config import cut_lineage
from ledgerstrata.llm.common import small_batches

MATCH = 400
GRAM = 64
#: Strings of a text that are parsed together; their positions need 24 bits.
STRINGS_AT_ONCE = 1 << 23
#: Phrases compared in one piece. A trigger with more of them is compared string by string in Spark.
CROWD = 2000

_BYTES = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hash of each run of GRAM bytes, by doubling (GRAM is a power of two)."""
    h, width, base = _BYTES[data], 1, _BASE
    while width < GRAM:
        h = h[:-width] * np.uint64(base) + h[width:]
        width, base = 2 * width, base * base % (1 << 64)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def phrases_of(text: bytes) -> list[tuple[int, int, int]]:
    """(trigger, first, last) of the phrases of a text: where strings of one trigger start."""
    out: list[tuple[int, int, int]] = []
    mask, span = np.uint64((1 << 24) - 1), MATCH - GRAM + 1
    for origin in range(0, len(text) - MATCH + 1, STRINGS_AT_ONCE):
        part = np.frombuffer(text, np.uint8)[origin:origin + STRINGS_AT_ONCE + MATCH - 1]
        key = _gram_hashes(part)
        key = (key & ~mask) | np.arange(len(key), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        n = len(part) - MATCH + 1
        trigger = (np.minimum(key[:n], key[span - width:span - width + n]) & mask).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
        last = np.concatenate([first[1:] - 1, [n - 1]])
        out += zip((trigger[first] + origin).tolist(), (first + origin).tolist(), (last + origin).tolist())
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.xxhash64(doc_id, text).alias("row"), doc_id.alias("doc_id"), text.cast("binary").alias("text"))


def parse(docs: DataFrame) -> DataFrame:
    """``trigger, phrase, row, first, last``: the occurrences of all phrases of all texts."""
    small_batches(docs.sparkSession)

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            out = [(_signed(digest(text[t:t + GRAM])), _signed(digest(text[a:b + MATCH])), row, a, b)
                   for row, text in zip(batch["row"], batch["text"]) for t, a, b in phrases_of(text)]
            yield pd.DataFrame(out, columns=["trigger", "phrase", "row", "first", "last"])

    return _rows(docs).select("row", "text").mapInPandas(per_batch, "trigger long, phrase long, row long, first int, last int")


def _contents(phrase: bytes) -> list[int]:
    digest = xxhash.xxh3_64_intdigest
    return [digest(phrase[i:i + MATCH]) for i in range(len(phrase) - MATCH + 1)]


def _spans(offsets: np.ndarray) -> list[dict]:
    cut = np.flatnonzero(np.diff(offsets) > 1)
    return [{"lo": int(a), "hi": int(b)} for a, b in zip(offsets[np.concatenate([[0], cut + 1])], offsets[np.concatenate([cut, [len(offsets) - 1]])])]


SPANS = "trigger long, phrase long, spans array<struct<lo: int, hi: int>>"


def _equal_suffixes(dictionary: DataFrame) -> DataFrame:
    """``trigger, phrase, spans``: strings (by offset in the phrase) that another phrase has too.

    ``dictionary``: trigger, phrase, crowd (phrases of the trigger) and bytes.
    """

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        lists = [_contents(b) for b in group["bytes"]]
        sizes = np.array([len(x) for x in lists])
        _, place, counts = np.unique(np.array([c for x in lists for c in x], dtype=np.uint64), return_inverse=True, return_counts=True)
        repeated, at = np.split(counts[place] > 1, np.cumsum(sizes)[:-1]), []
        for hit in repeated:
            offsets = np.flatnonzero(hit)
            at.append(_spans(offsets) if len(offsets) else [])
        out = pd.DataFrame({"trigger": group["trigger"], "phrase": group["phrase"], "spans": at})
        return out[out["spans"].map(len) > 0]

    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lists = [_contents(b) for b in batch["bytes"]]
            sizes = [len(x) for x in lists]
            yield pd.DataFrame({"trigger": np.repeat(batch["trigger"].to_numpy(), sizes), "phrase": np.repeat(batch["phrase"].to_numpy(), sizes),
                                "offset": np.concatenate([np.arange(n) for n in sizes]) if sizes else [],
                                "content": np.array([c for x in lists for c in x], dtype=np.uint64).view(np.int64)})

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"trigger": batch["trigger"], "phrase": batch["phrase"], "spans": [_spans(np.array(o)) for o in batch["offsets"]]})

    few = dictionary.where(F.col("crowd") <= CROWD)
    pieces = 1 + few.count() // CROWD
    small = few.withColumn("piece", F.pmod(F.xxhash64("trigger"), F.lit(pieces))).groupBy("piece").applyInPandas(compare, SPANS)
    strings = cut_lineage(dictionary.where(F.col("crowd") > CROWD).mapInPandas(suffixes, "trigger long, phrase long, offset int, content long"))
    twice = strings.groupBy("content").agg(F.count("*").alias("n")).where("n > 1").select("content")
    offsets = strings.join(twice, "content").groupBy("trigger", "phrase").agg(F.array_sort(F.collect_list("offset")).alias("offsets"))
    return small.unionByName(offsets.mapInPandas(gathered, SPANS))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``row, spans``: start and end (exclusive) of the repeated strings of a text; they may overlap."""
    parsed = cut_lineage(parse(docs))
    # Counts are written before they are joined: from files on both sides, Spark can split a crowded trigger.
    again = cut_lineage(parsed.groupBy("trigger").agg(F.count("*").alias("n")).where("n > 1").select("trigger"))
    live = cut_lineage(parsed.join(again, "trigger"))
    place = F.struct("row", "first", "last")
    phrases = cut_lineage(live.groupBy("trigger", "phrase").agg(F.count("*").alias("n"), F.min(place).alias("place")))
    crowds = phrases.groupBy("trigger").agg(F.count("*").alias("crowd"), F.min("n").alias("least")).where("crowd > 1 and least = 1").drop("least")
    crowds = cut_lineage(crowds)
    wanted = cut_lineage(phrases.join(crowds, "trigger").select("trigger", "phrase", "crowd", "place.*"))
    per_row = wanted.groupBy("row").agg(F.collect_list(F.struct("trigger", "phrase", "crowd", "first", "last")).alias("picks"))

    texts = _rows(docs).select("row", "text").join(per_row, "row")
    dictionary = texts.select("text", F.explode("picks").alias("p")).select(
        "p.trigger", "p.phrase", "p.crowd", F.expr("substring(text, p.first + 1, p.last - p.first + {0})".format(MATCH)).alias("bytes"))
    dictionary = cut_lineage(dictionary.distinct())
    single = phrases.where("n = 1").select("trigger", "phrase")
    parts = cut_lineage(_equal_suffixes(dictionary).join(single, ["trigger", "phrase"], "left_semi"))
    some = live.join(parts, ["trigger", "phrase"]).select(
        "row", F.inline(F.transform("spans", lambda s: F.struct((s["lo"] + F.col("first")).alias("start"), (s["hi"] + F.col("first") + MATCH).alias("end")))))
    whole = live.join(phrases.where("n > 1").select("trigger", "phrase"), ["trigger", "phrase"], "left_semi").select(
        "row", F.col("first").alias("start"), (F.col("last") + MATCH).alias("end"))
    return whole.unionByName(some).groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per document row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, bytes).

    A byte goes if a string of ``MATCH`` bytes that covers it also starts elsewhere, in any
    text or in its own. Null texts are empty; texts shorter than a match lose nothing. Rows
    that repeat an id and text are each a text, so their strings repeat; a null id stays null.
    Other columns are not read; an empty table gives no rows. ``kept`` may not be valid UTF-8, as cuts are made between bytes.
    """
    small_batches(docs.sparkSession)
    spans = cut_lineage(repeated_spans(docs))
    rows = _rows(docs).join(spans, "row", "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, found in zip(batch["text"], batch["spans"]):
                merged = _merged(found) if found is not None else []
                kept, at = [], 0
                for start, end in merged:
                    kept.append(text[at:start])
                    at = end
                kept = b"".join([*kept, text[at:]])
                out.append((len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            frame = frame.astype({"doc_id": "Int64"})
            yield frame if keep_text else frame.drop(columns="kept")

    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.mapInPandas(cut, shape + (", kept binary" if keep_text else ""))
