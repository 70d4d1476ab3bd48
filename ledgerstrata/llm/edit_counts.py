"""Edit-aware token counts over segment trees of pre-tokens.

Byte pair merges never cross a pre-token, so a text has as many tokens as its pre-tokens have
together. A document keeps a segment tree: leaves are runs of up to ``LEAF`` pre-tokens with
their characters and tokens, inner nodes are sums. An edit walks down to the leaf two characters
before it (the split pattern looks no further ahead than that behind a pre-token, and never
back), splits from that leaf on until a boundary meets one that the tree has behind the edit,
counts the pre-tokens of this stretch, and updates the sums above the touched leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.common import small_batches
from ledgerstrata.llm.tokens import Encoder

LEAF = 64
#: How far ahead of its end a pre-token can depend on the text.
LOOKAHEAD = 2
#: Pre-tokens whose count a worker remembers.
REMEMBERED = 400_000

TREE = "struct<chars: array<int>, tokens: array<int>, text: long>"
EDITS = "array<struct<start: int, removed: int, inserted: string>>"

#: What the query redacts, and by what.
REDACTIONS = (
    (r"[\w.+-]+@[\w-]+\.[\w.-]*\w", "<EMAIL>"),
    (r"https?://\S+", "<URL>"),
    (r"\b[0-9a-f]{32,}\b", "<SECRET>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<ADDRESS>"),
    (r"\+?\d[\d ()-]{6,}\d", "<NUMBER>"),
    (r"(?m)^.*\bLicense\b.*$\n?", ""),
)

_REDACTIONS = [(regex.compile(p), new) for p, new in REDACTIONS]


class Counter:
    """Splits texts and counts tokens of pre-tokens; remembers counts between texts."""

    def __init__(self, encoder: Encoder | None = None):
        import public_tokenizers

        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.encoder = encoder or Encoder()
        self.known: dict[str, int] = {}

    def count(self, pieces: list[str]) -> int:
        known, total = self.known, 0
        for piece in pieces:
            n = known.get(piece)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[piece] = len(self.encoder.ids(piece))
            total += n
        return total


class TokenTree:
    """Sums of characters and tokens over leaves; ``chars[1]`` and ``tokens[1]`` are those of the text."""

    def __init__(self, chars: list[int], tokens: list[int]):
        """From the node sums of a full binary tree, node 1 the root, node 0 unused."""
        self.chars, self.tokens = list(chars), list(tokens)

    @classmethod
    def of_leaves(cls, leaves: list[tuple[int, int]]) -> "TokenTree":
        width = 1
        while width < len(leaves):
            width *= 2
        chars, tokens = [0] * (2 * width), [0] * (2 * width)
        for i, (c, t) in enumerate(leaves):
            chars[width + i], tokens[width + i] = c, t
        for node in range(width - 1, 0, -1):
            chars[node], tokens[node] = chars[2 * node] + chars[2 * node + 1], tokens[2 * node] + tokens[2 * node + 1]
        return cls(chars, tokens)

    @classmethod
    def of_text(cls, text: str, counter: Counter) -> "TokenTree":
        pieces = counter.pattern.findall(text)
        parts = [pieces[i:i + LEAF] for i in range(0, len(pieces), LEAF)]
        return cls.of_leaves([(sum(map(len, p)), counter.count(p)) for p in parts])

    @property
    def width(self) -> int:
        return len(self.chars) // 2

    def find(self, position: int) -> tuple[int, int]:
        """(leaf, where it starts) of the character at ``position``; the last filled leaf beyond the end."""
        position = min(position, self.chars[1] - 1)
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if position - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.width
        self.chars[node], self.tokens[node] = chars, tokens
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def leaves(self) -> list[tuple[int, int]]:
        return list(zip(self.chars[self.width:], self.tokens[self.width:]))


def apply_edit(tree: TokenTree, text: str, start: int, removed: int, inserted: str, counter: Counter) -> tuple[TokenTree, str, int]:
    """(tree, text, characters split anew) after one edit; positions beyond the text are moved to its end."""
    start = min(max(start, 0), len(text))
    end = min(start + max(removed, 0), len(text))
    new, moved = text[:start] + inserted + text[end:], len(inserted) - (end - start)
    if not text:
        return TokenTree.of_text(new, counter), new, len(new)
    first, origin = tree.find(max(0, start - LOOKAHEAD))
    last, at = tree.find(max(end - 1, origin))
    ahead = at + tree.chars[last + tree.width]  # the end of the last touched leaf, in the old text
    pieces: list[str] = []
    place = origin
    for match in counter.pattern.finditer(new, origin):
        while ahead + moved < place or (ahead < end and last + 1 < tree.width):
            last += 1
            if last >= tree.width:
                break
            ahead += tree.chars[last + tree.width]
        if place == ahead + moved and ahead >= end:
            break
        pieces.append(match.group())
        place = match.end()
    else:
        last = tree.width - 1
    slots = min(last, tree.width - 1) - first + 1
    parts = [pieces[i:i + LEAF] for i in range(0, len(pieces), LEAF)]
    filled = [(sum(map(len, p)), counter.count(p)) for p in parts]
    if len(filled) <= slots:
        for i in range(slots):
            tree.put(first + i, *(filled[i] if i < len(filled) else (0, 0)))
    else:  # more leaves than there were: the tree grows
        old = tree.leaves()
        tree = TokenTree.of_leaves([x for x in old[:first] + filled + old[first + slots:] if x[0]])
    return tree, new, place - origin


def text_mark(text: str) -> int:
    """Hash that says which text a stored tree belongs to."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def token_trees(docs: DataFrame, encoder: Encoder | None = None) -> DataFrame:
    """``doc_id, tree`` to be kept as a table: node sums of each text (null: empty), root first."""
    small_batches(docs.sparkSession)
    encoder = encoder or Encoder()

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(encoder)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            trees = [(TokenTree.of_text(t, counter), text_mark(t)) for t in texts]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "tree": [{"chars": t.chars, "tokens": t.tokens, "text": mark} for t, mark in trees]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(per_batch, f"doc_id long, tree {TREE}")


def redactions(text: str | None) -> list[tuple[int, int, str]]:
    """Edits that replace personal data, secrets and license lines, last one first; none overlap."""
    found, free = [], len(text or "")
    spans = sorted(((m.start(), m.end(), new) for pattern, new in _REDACTIONS for m in pattern.finditer(text or "")), reverse=True)
    for start, end, new in spans:
        if end <= free:
            found.append((start, end - start, new))
            free = start
    return found


def with_redactions(docs: DataFrame) -> DataFrame:
    """``docs`` with ``edits``, the :func:`redactions` of each text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(EDITS)
    def edits(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": s, "removed": n, "inserted": new} for s, n, new in redactions(t)] for t in texts])

    return docs.withColumn("edits", edits(F.col("text").cast("string")))


def count_edited(docs: DataFrame, trees: DataFrame | None = None, encoder: Encoder | None = None) -> DataFrame:
    """Token counts of ``docs`` (doc_id, text, edits) before and after the edits of each document.

    Returns ``doc_id, n_edits, tokens_before, tokens_after, chars_after, chars_recounted, tree``.
    Edits are applied one after another: each has ``start`` in the text as the edits before it
    left it, ``removed`` characters there and the text ``inserted`` instead. Positions
    outside a text are moved to its ends; a null edit or null list does nothing; null in a field
    counts as 0 or empty. ``trees`` (of :func:`token_trees`) are matched by ``doc_id``; a document without
    one, or with one of another text (told by a hash), gets one built. Null texts are empty;
    repeated rows are counted each; other columns are not read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    encoder = encoder or Encoder()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("edits").cast(EDITS).alias("edits"))
    if trees is None:
        rows = rows.withColumn("tree", F.lit(None).cast(TREE))
    else:
        rows = rows.join(trees.select("doc_id", "tree").dropDuplicates(["doc_id"]), "doc_id", "left")

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(encoder)
        for batch in batches:
            out = []
            for text, edits, kept in zip(batch["text"], batch["edits"], batch["tree"]):
                text = text or ""
                tree = TokenTree(kept["chars"], kept["tokens"]) if kept is not None else None
                if tree is None or kept["text"] != text_mark(text):
                    tree = TokenTree.of_text(text, counter)
                before, anew, done = tree.tokens[1], 0, 0
                for edit in edits if edits is not None else ():
                    if edit is None:
                        continue
                    tree, text, n = apply_edit(tree, text, int(edit["start"] or 0), int(edit["removed"] or 0), edit["inserted"] or "", counter)
                    anew, done = anew + n, done + 1
                out.append((done, before, tree.tokens[1], len(text), anew, {"chars": tree.chars, "tokens": tree.tokens, "text": text_mark(text)}))
            frame = pd.DataFrame(out, columns=["n_edits", "tokens_before", "tokens_after", "chars_after", "chars_recounted", "tree"])
            frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield frame.astype({"doc_id": "Int64"})

    shape = f"doc_id long, n_edits int, tokens_before long, tokens_after long, chars_after long, chars_recounted long, tree {TREE}"
    return rows.mapInPandas(per_batch, shape)
