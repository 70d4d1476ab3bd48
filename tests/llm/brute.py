"""Plain Python versions of the corpus operators, for small tables."""

import collections
import re

import numpy as np
import xxhash


def components(nodes, linked):
    """Smallest node of each node's group; ``linked(a, b)`` says whether two are linked."""
    nodes = list(nodes)
    group = {n: n for n in nodes}

    def find(n):
        while group[n] != n:
            n = group[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                group[y] = x
    return {n: find(n) for n in nodes}


def simhash(text, width=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    width = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def line_words(line):
    return [w for w in re.split(r"[\W_]+", line.lower()) if w]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def removed_lines(texts, min_words=5, fuzzy_words=10, radius=3, similarity=0.8):
    """Per document of ``texts`` (id to text) the numbers of lines that repeat an earlier one."""
    place = {}
    for doc_id in sorted(texts):
        for n, line in enumerate((texts[doc_id] or "").split("\n")):
            words = tuple(line_words(line))
            if len(words) >= min_words:
                place.setdefault(words, []).append((doc_id, n))

    def fingerprint(words):
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    lines = sorted(place)
    fp = {w: fingerprint(w) for w in lines if len(w) >= fuzzy_words}

    def linked(a, b):
        if a not in fp or b not in fp or (fp[a] ^ fp[b]).bit_count() > radius:
            return False
        return edit_distance(a, b) <= int(max(len(a), len(b)) * (1 - similarity) + 1e-9)

    groups = collections.defaultdict(list)
    for words, root in components(lines, linked).items():
        groups[root] += place[words]
    out = collections.defaultdict(list)
    for group in groups.values():
        for doc_id, n in sorted(group)[1:]:
            out[doc_id].append(n)
    return {doc_id: sorted(out[doc_id]) for doc_id in texts}


def kept_bytes(texts, match):
    """Per key of ``texts`` (bytes) the bytes left, their number removed and the runs removed."""
    seen = collections.Counter(t[i:i + match] for t in texts.values() for i in range(len(t) - match + 1))
    out = {}
    for key, t in texts.items():
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - match + 1):
            if seen[t[i:i + match]] > 1:
                gone[i:i + match] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[key] = bytes(np.frombuffer(t, np.uint8)[~gone]), int(gone.sum()), runs
    return out
