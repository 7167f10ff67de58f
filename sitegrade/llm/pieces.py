"""Pre-tokens of two public tokenizers, cut and encoded with a worker's memory.

Cutting uses plain character classes for texts of Latin letters and common
punctuation; every other text, and every text holding a special string, goes to
the tokenizer library whole, so results are always the library's own.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np

#: Code points U+0000 to U+02AF by class, and common punctuation.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ʯ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\t-\r \x85\xa0"
OTHER_MARKS = "‐-‧‰-⁎€"
#: The ending forms both tokenizers split off.
ENDINGS = "'(?:[stmd]|re|ve|ll)"

_BYTE_PIECES = re.compile(
    f" ?[{LETTERS}]+| ?[{NUMBERS}]+|{ENDINGS}| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
_WORD_PIECES = re.compile(
    f"[{LETTERS}]+|[{NUMBERS}]|{ENDINGS}|[^{SPACES}{LETTERS}{NUMBERS}]+"
)
_UNUSUAL = re.compile(f"[^\x00-ʯ{OTHER_MARKS}]")
#: For the lower-casing, normalising tokenizer: without letters of odd case forms;
#: no character left in it changes under NFC.
_UNUSUAL_CASE = re.compile(f"[^\x00-\xff\u0100-\u012f\u0132-\u0148\u014a-\u017e{OTHER_MARKS}]")


def _byte_alphabet() -> dict[int, str]:
    """The byte-level spelling: printable Latin-1 stays, the rest moves above U+0100."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + n) for n, b in enumerate(moved)}


class Pieces:
    """Cuts texts into pre-tokens and encodes each distinct one once.

    ``known`` maps a pre-token to its ids (32-bit little-endian, as bytes) or to
    their number. It starts from a broadcast table of frequent pre-tokens and
    grows with what the worker meets; beyond ``limit`` entries it falls back to
    the frequent ones, so memory stays bounded.
    """

    def __init__(self, path: str, lower: bool, frequent: dict | None = None,
                 limit: int = 400_000, counts_only: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.specials = [
            t.content for t in self.library.get_added_tokens_decoder().values()
        ]
        self.alphabet = _byte_alphabet()
        self.lower = lower
        self.counts_only = counts_only
        self.limit = limit
        self.frequent = frequent or {}
        self.known: dict = dict(self.frequent)
        self.find = (_WORD_PIECES if lower else _BYTE_PIECES).findall
        self.unusual = (_UNUSUAL_CASE if lower else _UNUSUAL).search

    def start_from(self, frequent: dict) -> None:
        """Take over a table of frequent pre-tokens, once."""
        if self.frequent is not frequent:
            self.frequent = frequent
            self.known.update(frequent)

    def cut(self, text: str) -> list[str] | None:
        """The pre-tokens of a text, or None where the library must cut."""
        if any(s in text for s in self.specials):
            return None
        if not text.isascii() and self.unusual(text):
            return None
        return self.find(text.lower() if self.lower else text)

    def learn(self, pieces: set[str]) -> None:
        known, tokenize = self.known, self.model.tokenize
        fresh = [p for p in pieces if p not in known]
        if len(known) + len(fresh) > self.limit:
            known = self.known = dict(self.frequent)
            fresh = [p for p in pieces if p not in known]
        for piece in fresh:
            spelled = piece.encode().decode("latin-1").translate(self.alphabet)
            tokens = tokenize(spelled)
            known[piece] = len(tokens) if self.counts_only else b"".join(
                [t.id.to_bytes(4, "little") for t in tokens])

    def lengths(self, texts: list[str]) -> list[int]:
        """Token counts of whole texts."""
        cut = [self.cut(t) for t in texts]
        self.learn(set(chain.from_iterable(p for p in cut if p)))
        at = self.known.__getitem__
        return [
            len(self.library.encode(t, add_special_tokens=False).ids)
            if p is None else sum(map(at, p))
            for t, p in zip(texts, cut, strict=True)
        ]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Token ids of whole texts, 32-bit little-endian."""
        cut = [self.cut(t) for t in texts]
        self.learn(set(chain.from_iterable(p for p in cut if p)))
        at = self.known.__getitem__
        return [
            np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            if p is None else b"".join(map(at, p))
            for t, p in zip(texts, cut, strict=True)
        ]


@lru_cache(maxsize=2)
def worker_pieces(path: str, lower: bool, counts_only: bool = False, table: int | None = None,
                  ) -> Pieces:
    """The pieces of this worker process, kept from task to task: some 60 MB at most.

    ``table`` numbers the broadcast table of frequent pre-tokens in use; its
    content is given to ``start_from`` by the first task that needs it.
    """
    return Pieces(path, lower, limit=120_000, counts_only=counts_only)
