"""The corpus pipeline against plain Python versions of its stages."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from ledgerstrata.llm import decontaminate, packing, toxicity  # noqa: E402
from ledgerstrata.llm.tokens import Encoder  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, size=3000):
    return " ".join(f"t{rng.randrange(size)}e" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(33)
    items = [(i, f"What is {sentence(rng, 25)}? It is {sentence(rng, 8)}.") for i in range(6)]
    footer = "All rights to this page belong to its many authors"
    texts, labels = {}, []
    for i in range(160):
        lines = [sentence(rng, 30) for _ in range(4)]
        if i % 5 == 0:
            lines[1] += " utterfilth" if i % 2 else " vilescum"
        if i % 6 == 1:
            lines.append(footer)
        if i % 8 == 3:
            lines[2] += " " + items[i % 6][1]
        texts[i] = "\n".join(lines)
        if i < 120:
            labels.append((i, 1, int(i % 5 == 0)))
    texts[200] = texts[1]
    texts[201] = texts[2].replace("t", "T") + " end"
    texts[202], texts[203], texts[204] = None, "", sentence(rng, 6000)
    root = tmp_path_factory.mktemp("corpus")
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), texts, items


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]


def test_each_stage_matches_its_plain_version(spark, corpus):
    root, texts, items = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    machine = toxicity.train(docs, spark.read.parquet(f"{root}/labels.parquet"))
    terms = toxicity._Terms(machine.terms)
    left = {i: t for i, t in texts.items() if machine.score(terms.of(t)) < 0.5}
    assert not any("vilescum" in (t or "") or "utterfilth" in (t or "") for t in left.values()) and len(left) > 125
    wanted = [left]

    gone = brute.removed_lines(left, min_words=1, fuzzy_words=1, radius=64)
    trimmed = {}
    for i, t in left.items():
        kept = "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in gone[i])
        if not gone[i]:
            trimmed[i] = t
        elif kept.strip():
            trimmed[i] = kept
    wanted.append(trimmed)
    group = brute.components(sorted({brute.simhash(t) for t in trimmed.values()}), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for i in sorted(trimmed):
        first.setdefault(group[brute.simhash(trimmed[i])], i)
    wanted.append({i: trimmed[i] for i in first.values()})
    parts = [decontaminate.shingles(decontaminate.words_of(t)) for _, t in items]
    wanted.append({i: t for i, t in wanted[-1].items()
                   if all(len(p & decontaminate.shingles(decontaminate.words_of(t))) < 0.8 * len(p) for p in parts)})
    assert [len(w) for w in wanted] == sorted({len(w) for w in wanted}, reverse=True)

    for (name, stage), want in zip(corpus_pipeline.STAGES, wanted):
        docs = stage(spark, docs, root)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = corpus_pipeline.cut_lineage(docs)
        assert {r.doc_id: r.text for r in docs.collect()} == want, name
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in docs.collect()), name

    slow = Encoder().slow
    packed = corpus_pipeline.run(spark, root).collect()
    pieces = {}
    for r in packed:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert set(pieces) == set(wanted[-1])
    for i, text in wanted[-1].items():
        ids = np.array([*slow.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert sum(n for _, n, _ in pieces[i]) == len(ids)
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == crc for s, n, crc in pieces[i])
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= packing.CAPACITY


def test_an_empty_corpus(spark, corpus, tmp_path):
    root, _, _ = corpus
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{root}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
