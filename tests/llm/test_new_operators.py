"""Operators 11 to 13 against plain Python versions."""

import collections
import itertools
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstrata.llm import collocations, curriculum, whitening

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, words int, copy string"


def documents(spark, rows):
    """Rows (doc_id, text, lang, source), with columns whose names clash."""
    return spark.createDataFrame([(*r, 1, 7, 8, "c") for r in rows], DOCS)


# 11 --------------------------------------------------------------- phrases


def brute_collocations(rows, threshold, longest, listed):
    counts = collections.Counter()
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts["und" if lang is None else lang, tuple(w[i:i + m])] += 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= threshold}
    out = collections.defaultdict(list)
    for (lang, w), a in found.items():
        if any(lang == other and len(v) > len(w) and 100 * b >= 50 * a and any(v[i:i + len(w)] == w for i in range(len(v)))
               for (other, v), b in found.items()):
            continue
        score, k = min((math.floor(Fraction(1000000 * a * a, counts[lang, w[:k]] * counts[lang, w[k:]])), k) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    total = collections.Counter()
    for (lang, w), a in counts.items():
        total[lang] += a if len(w) == 1 else 0
    return {(lang, i + 1, p.decode(), -a, left, right, total[lang], -s)
            for lang, own in out.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:listed])}


@pytest.mark.parametrize("longest, shards, cells", [(3, 3, 1 << 16), (4, 1, 1 << 16), (3, 5, 64)])
def test_collocations_match_brute_force(spark, monkeypatch, longest, shards, cells):
    """Also with so few cells that nearly every phrase is active by chance."""
    monkeypatch.setattr(collocations, "PAIR_CELLS", 32768)
    monkeypatch.setattr(collocations, "ROW_BYTES", 400)
    rng = random.Random(31)
    vocabulary = ["a", "B", "Éa", "naïve", "x y", "𝄞", "of", "the", "-", "ÄÖ"]
    rows = []
    for i in range(160):
        w = rng.choices(vocabulary, range(10, 0, -1), k=rng.randrange(25))
        text = "".join(x + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b"]) for x in w)
        rows.append((i % 90, text, rng.choice(["en", "en", "en", "de", None]), "s"))
    rows += [(200, None, "en", None), (None, "", None, None), (201, "alone", "fr", "s"), (202, " . ,", "xx", "s"), (203, "of the " * 3000, "en", "s")]
    got = collocations.collocations(documents(spark, rows).repartition(5), 4, longest, 12, shards, cells).collect()
    want = brute_collocations([(t, lang) for _, t, lang, _ in rows], 4, longest, 12)
    assert {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got} == want and len(got) == len(want) > 30
    assert "fr" not in {r.lang for r in got}


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.collocations(documents(spark, [(1, None, None, None), (2, " \n", "en", "s")])).collect() == []


def test_pieces_and_words():
    words, ids = collocations.encode_texts(["One two,two  ONE".encode(), b"", b"\x00 one!"])
    assert words.to_pylist()[:2] == ["one", "two"] and [words[i].as_py() if i >= 0 else None for i in ids] == ["one", "two", None, "two", "one", None, "\x00", "one"]


def test_large_products_stay_exact(spark):
    """a^2 * 10^6 beyond 64 bits, through the same columns as the operator."""
    row = spark.sql("SELECT cast(1000000 AS decimal(38,0)) * cast(a AS decimal(38,0)) * cast(a AS decimal(38,0)) aa, "
                    "cast(a + 1 AS decimal(38,0)) * cast(a AS decimal(38,0)) lr FROM (SELECT 1000000000000L a)")
    assert row.select(F.expr("aa div lr")).first()[0] == 10**6 * 10**24 // (10**12 * (10**12 + 1)) == 999999


# 12 ------------------------------------------------------------- whitening


def brute_whitening(vectors, components=16, copies=False):
    x = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors]
    fit = x if copies else sorted(set(x))
    n, s = len(fit), [sum(col) for col in zip(*fit)]
    mean = np.array([float(Fraction(t, n)) for t in s])
    centred = np.array(fit, float) - mean
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    white = (np.array(x, float) - mean) @ u / np.sqrt(e)
    deviation = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    return n, deviation, white, e / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("copies", [False, True])
def test_whitening_matches_numpy(spark, copies):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 24)) * np.linspace(1, 3, 24) @ rng.normal(size=(24, 24))
    vectors = [list(map(float, v)) for v in base] + [list(map(float, base[0]))] * 40 + [list(map(float, base[1] + 1e-9))]
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)]
    rows += [(900, None, 1, "x"), (901, [None] + vectors[0][1:], 1, "x"), (902, [math.nan] + vectors[0][1:], 1, "x"), (903, [math.inf] + vectors[0][1:], 1, "x"),
             (904, [], 1, "x"), (5, vectors[5], 1, "x"), (None, vectors[6], None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, component string")
    got = whitening.whitened(df, fit_copies=copies).collect()
    kept = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    n, deviation, white, explained = brute_whitening([r[1] for r in kept], copies=copies)
    assert len(got) == 16 * len(kept) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    signs = {}
    own = {r[0]: (deviation[i], white[i]) for i, r in enumerate(kept)}
    for r in got:
        want = own[r.vec_id][1][r.component - 1]
        signs.setdefault(r.component, np.sign(want * r.whitened) if abs(want) > 1e-3 else 0)
        if signs[r.component] == 0:
            del signs[r.component]
            continue
        assert r.deviation == own[r.vec_id][0]
        assert r.whitened * signs[r.component] == pytest.approx(want, abs=1e-7)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    assert sorted(signs) == list(range(1, 17))


def test_whitening_of_little(spark):
    shape = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], shape)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], shape)).collect() == []
    got = whitening.whitened(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [1.0])], shape)).collect()
    # One direction for the two vectors of length two, none for the one alone in its length.
    assert sorted((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9), round(r.explained, 9)) for r in got) == [(1, 1, 2, 2 * 64**2, 1, 1), (2, 1, 2, 2 * 64**2, 1, 1)]


def test_exact_sums_beyond_64_bits():
    x = np.array([[2**40, -2**40], [0, 5]], np.int64)
    deviation = whitening.whole_deviations(x, 2**30, [2**60, -2**62])
    assert [[int(v) for v in row] for row in deviation] == [[2**70 - 2**60, -2**70 + 2**62], [-2**60, 5 * 2**30 + 2**62]]
    with pytest.raises(OverflowError):
        whitening.squared_lengths(deviation)
    assert whitening.squared_lengths(np.array([[3_000_000_000, 1]])).tolist() == [9 * 10**18 + 1]


def test_entries_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whitened(spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id long, embedding array<double>")).collect()


# 13 ---------------------------------------------------------------- mixing


def brute_targets(sizes):
    """Shares by weight, what is above twice the size cut off and reshared, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: Fraction((5, 2, 1)[i % 3]) for i, s in enumerate(names)}
    left, open_, target = Fraction(3 * sum(sizes.values()), 2), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        for s in above or list(open_):
            target[s] = Fraction(2 * sizes[s]) if above else share[s]
        left -= sum(target[s] for s in above)
        open_ -= set(above or open_)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mix_meets_its_targets(spark, monkeypatch, seed):
    monkeypatch.setattr(curriculum, "SLICE_ROWS", 10)
    rng = random.Random(seed)
    names = [None, "", "Z", "a", "é", "😀", "～"][: 7 - seed]
    rows = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.choice([0, 1, 5, 50, 900 if i % 40 == 0 else 7]))), "en", names[min(rng.randrange(14), len(names) - 1)]) for i in range(300)]
    rows += [(500, None, None, "empty"), (501, " \t\x0b", "en", None), (None, "no id here", "en", "a"), (3, rows[3][1], "en", rows[3][3]), (502, "x y\x1cz 1", "en", "a")]
    got = curriculum.mixed(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += size(t)
    want = brute_targets(sizes)
    by_id = {r[0]: r for r in rows}
    taken = collections.Counter()
    for r in got:
        _, text, _, source = by_id[r.doc_id]
        assert (r.size, r.source_size) == (size(text), sizes[source]) and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(float(want[source]), rel=1e-12) and (r.position is None) == (r.taken == 0)
        taken[source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    placed = [r.position for r in got if r.position is not None]
    assert placed == sorted(placed) and all(0 <= p <= 1 for p in placed) and got[: len(placed)] == [r for r in got if r.position is not None]
    again = curriculum.mixed(documents(spark, list(reversed(rows))).repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_positions_invert_the_integral(spark):
    """The words read up to a moment are the schedule's integral times the target, but for a document."""
    schedules = (((0.0, 0.0), (0.25, 4.0), (1.0, 1.0)), ((0.0, 3.0), (0.5, 0.0), (1.0, 0.0)))
    rows = [(i, "w " * (1 + i % 5), "en", "ab"[i % 2]) for i in range(400)]
    out = curriculum.planned(documents(spark, rows), schedules, (1, 2), 3).select("source", "target", F.explode("copies").alias("c")).select("source", "target", "c.*").collect()
    for source, schedule in zip("ab", schedules):
        own = [r for r in out if r.source == source]
        for t in (0.1, 0.25, 0.4, 0.5, 0.77, 1.0):
            part = sum((min(t, t1) - t0) * (w0 + w0 + (w1 - w0) * (min(t, t1) - t0) / (t1 - t0)) / 2 for (t0, w0), (t1, w1) in itertools.pairwise(schedule) if t > t0)
            read = sum(r.words for r in own if r.position <= t + 1e-12)
            assert abs(read - own[0].target * part / curriculum.integral(schedule)) <= 5.5
    with pytest.raises(ValueError):
        curriculum.planned(documents(spark, rows), (((0.0, 1.0), (0.5, 1.0)),)).collect()


def test_training_order_holds_the_documents(spark):
    rows = [(i, "w " * (i % 7), "en", "abc"[i % 3]) for i in range(60)] + [(1, "w ", "en", "b"), (None, "w w", "en", None)]
    docs = documents(spark, rows)
    plan = curriculum.mixed(docs).collect()
    order = curriculum.training_order(docs).collect()
    assert order[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", "rank", "words_", "copy_", "copy", "words", "position"}
    assert sum(r.words for r in order) == sum(r.taken for r in plan)
    assert [r.position for r in order] == sorted(r.position for r in order) and all(r.words <= len(r.text.split()) for r in order)


def test_mix_of_nothing(spark):
    assert curriculum.mixed(spark.createDataFrame([], DOCS)).collect() == []
    got = curriculum.mixed(documents(spark, [(1, None, None, None), (2, " ", "en", "s")])).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken, r.position) for r in got) == [(1, 0, 0, 0.0, 0, None), (2, 0, 0, 0.0, 0, None)]
