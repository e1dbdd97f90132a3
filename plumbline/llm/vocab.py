"""Encoding through a public tokenizer with each worker's cache of words.

Both byte-level and word-end tokenizers split a text before merging, and never merge across a space
between two characters that are not white space. So a text is cut there, every distinct word is
encoded by the library once, and a text is the joined ids of its words, exactly as the library gives
them for the whole text. The added special strings hold no space, so a cut never falls inside one.
"""

from __future__ import annotations

import os
import re
from array import array
#: Words a worker's cache may hold, and the longest word that goes into it.
CACHE_WORDS = 1_600_000
CACHE_CHARS = 64
#: A space that ends one word and leads the next.
CUT = re.compile(r"(?<=\S) (?=\S)")

_OPEN: dict[str, WordEncoder] = {}


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text."""
        known = self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        split, missing = [], set()
        for text in texts:
            parts = text.split(" ")
            new = {p for p in parts[1:] if p not in known}
            # A part that is empty or has white space at an end is never in the cache: then cut with care.
            if parts[0] != parts[0].strip() or any(not p or p != p.strip() for p in new):
                parts = CUT.split(text)
                new = {p for p in parts[1:] if p not in known}
            missing |= new
            split.append(parts)
        rare = {}
        if missing:
            words = list(missing)
            for word, ids in zip(words, self.library([" " + w for w in words])):
                (known if len(word) <= CACHE_CHARS and word and word == word.strip() else rare)[word] = ids
        out = []
        for parts, first in zip(split, self.library([parts[0] for parts in split])):
            ids = list(map(known.get, parts[1:]))
            if None in ids:
                ids = [rare[p] if i is None else i for p, i in zip(parts[1:], ids)]
            out.append(first + b"".join(ids))
        return out


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _OPEN:
        _OPEN[path] = WordEncoder(path)
    return _OPEN[path]
