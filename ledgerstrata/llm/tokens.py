"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import base64
import os
import re

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"

#: Printable ASCII, tab, line feed, and letters and marks of western scripts. On texts of these
#: the two libraries split alike (same pattern, same character classes in every Unicode version).
_USUAL = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ſ]")
_SPECIAL = "<|endoftext|>"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``ids(text)`` as the tokenizers library gives them without special tokens added.

    The byte pair ranks of the same vocabulary are applied by the faster library where a text
    has usual characters only; any other text, and one that spells a special token, goes to
    the tokenizers library itself. The files are opened on first use, in the worker.
    """

    def __init__(self, tokenizer: str | None = None, ranks: str | None = None):
        self.tokenizer, self.ranks = tokenizer, ranks
        self._slow = self._fast = None

    def __getstate__(self):
        return {"tokenizer": self.tokenizer, "ranks": self.ranks, "_slow": None, "_fast": None}

    @property
    def slow(self):
        if self._slow is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.tokenizer or public_path(TOKENIZER))
        return self._slow

    @property
    def fast(self):
        if self._fast is None:
            import public_tokenizers
            import tiktoken

            lines = open(self.ranks or public_path(RANKS), "rb")
            with lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return self._fast

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if _USUAL.search(text) or _SPECIAL in text:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)
