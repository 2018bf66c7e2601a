"""Token ids of whole texts by a public tokenizer file, with a bounded cache per word.

Both tokenizers used here never join characters across a space, so a text is cut
at spaces and each distinct word is encoded once per worker.  What a cut could
change (runs of white space, special-token strings) goes to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

CACHE_WORDS = 700_000  # words, and as many pieces of words
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?:;#$%&*|()]*)")
ID = np.dtype("<u4")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE files use for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    """word -> its ids as bytes; starts afresh when it is full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = ids
        return ids


class WordTokenizer:
    """``ids(text)`` equals ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = _byte_letters()
        self.letters = [letters[b] for b in range(256)]
        self.model = self.tok.model
        self.spaced = spec["normalizer"] is None  # byte level: a space belongs to the word after it
        self.pieces = _Cache(self._piece)
        self.cache = _Cache(self._spaced_word if self.spaced else self._dropped_word)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """One pre-token straight through the BPE model."""
        if piece.isascii():  # printable ASCII stands for itself
            piece = piece.replace(" ", self.letters[32]).replace("\n", self.letters[10])
        else:
            piece = "".join([self.letters[b] for b in piece.encode()])
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _spaced_word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.pieces[" " + word]
        line = word[:1] == "\n"  # a line end is a piece of its own, a space belongs to the word after it
        m = PLAIN.fullmatch(word, 1 if line else 0)
        if not m:
            return self._whole(word if line else " " + word)
        head = self.pieces["\n"] + self.pieces[m[1]] if line else self.pieces[" " + m[1]]
        return head + self.pieces[m[2]] if m[2] else head

    def _dropped_word(self, word: str) -> bytes:
        m = PLAIN.fullmatch(word)
        if not m:
            return self._whole(word) if word else b""
        return self.pieces[m[1].lower()] + (self.pieces[m[2]] if m[2] else b"")

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, ID)
        if self.spaced:
            # anything but single spaces and line ends between words goes whole
            if " ".join(text.split()) != text.replace("\n", " ") or any(s in text for s in self.special):
                return np.frombuffer(self._whole(text), ID)
            first, *rest = text.replace("\n", " \n").split(" ")
            return np.frombuffer(b"".join([self._whole(first), *map(self.cache.__getitem__, rest)]), ID)
        return np.frombuffer(b"".join(map(self.cache.__getitem__, text.replace("\n", " ").split(" "))), ID)


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so its cache outlives a task."""
    return WordTokenizer(path)
