"""SentencePiece encoding and decoding with N-best segmentations.

The pieces that match a text form a lattice. Forward Viterbi scores give, for
every position, the best score of any way to reach it; they are the exact
heuristic of an A-star search that walks backward from the end, so the first N
complete paths it pops are the N best segmentations, and nothing off their
course is opened.

No piece of these models crosses the start of a word (a space mark after
something else), nor, where the model allows it, the end of its letters before a
full stop or comma, so a text's lattice is a chain of word lattices. A task keeps
each distinct word's best once, and the N best of a text differ from its best
one only at the words with the smallest gaps. A worker process keeps its words
from task to task, up to a bound.
"""

from __future__ import annotations

import heapq
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrade.llm.common import map_batches

SPACE = "▁"
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: The same, ending words before a full stop or comma that follows a letter.
_BARE_WORDS = re.compile(
    f"(?=.){SPACE}*+(?:[^{SPACE}.,]++(?:(?<=[{_LETTER}])(?=[.,])|[^{SPACE}]*+)|[^{SPACE}]*+)", re.DOTALL)


@dataclass(frozen=True)
class Segmentation:
    """One way to cut a text: piece ids as 32-bit little-endian bytes, and its score."""

    score: float
    data: bytes

    @property
    def ids(self) -> list[int]:
        return np.frombuffer(self.data, "<u4").tolist()


def _smallest(values: tuple[float, ...], n: int) -> list[int]:
    """Places of the n smallest values, smallest first, ties in order."""
    if not 0 < n < len(values):
        return sorted(range(len(values)), key=values.__getitem__)[:n]
    found = np.array(values)
    near = np.flatnonzero(found <= np.partition(found, n - 1)[n - 1])
    return near[np.argsort(found[near], kind="stable")[:n]].tolist()


def _tree(scored: dict[str, tuple[float, bytes]]) -> dict[str, tuple]:
    """The beginnings of all pieces, one character a level; the ends share one empty level."""
    nothing: dict[str, tuple] = {}
    tree: dict[str, tuple] = {}
    for piece in sorted(scored):
        level = tree
        for at, char in enumerate(piece, 1):
            after, *known = level.get(char, (nothing, None, None))
            if at == len(piece):
                known = scored[piece]
            elif after is nothing:
                after = {}
            level[char] = (after, *known)
            level = after
    return tree


class PieceModel:
    """Pieces, scores and byte fallback of a SentencePiece model file."""

    def __init__(self, path: str, n_best: int = 4, limit: int = 900_000):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(size)]
        special = [self.library.is_control(i) or self.library.is_unknown(i) for i in range(size)]
        self.byte_ids = {
            int(p[3:5], 16): i for i, p in enumerate(pieces) if self.library.is_byte(i)}
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else b"" if special[i] else p.encode()
            for i, p in enumerate(pieces)]
        self.scored = {
            p: (self.library.get_score(i), i.to_bytes(4, "little")) for i, p in enumerate(pieces)
            if not special[i] and not self.library.is_byte(i)}
        #: Beginnings of pieces by their next character: (what follows, score, ids or None).
        self.beginnings = _tree(self.scored)
        #: A character without a piece costs more than any piece does.
        self.unknown = min(s for s, _ in self.scored.values()) - 10.0
        crossing = re.compile(f"[{_LETTER}][.,]").search
        #: Words may end before punctuation where no piece of the model crosses that place.
        self.cut = (_WORDS if any(map(crossing, self.scored)) else _BARE_WORDS).findall
        self.n_best, self.limit = n_best, limit
        self.longest = max(map(len, self.scored))
        #: Sums of whole numbers are exact, so that equal scores are found by comparison.
        self.exact = all(s.is_integer() for s, _ in self.scored.values())
        self.known: dict[str, tuple] = {}
        self.searched: dict[tuple[str, int], list[Segmentation]] = {}

    def lattice(self, text: str) -> tuple[list[list[tuple]], list[float]]:
        """For each end position its arcs (start, score, ids), and the forward Viterbi scores."""
        size = len(text)
        ends: list[list[tuple]] = [[] for _ in range(size + 1)]
        best = [0.0] + [float("-inf")] * size
        tree = self.beginnings
        for start, reached in enumerate(best):
            after, end = tree, start
            for char in text[start:start + self.longest]:
                node = after.get(char)
                if node is None:
                    break
                end += 1
                after, score, ids = node
                if ids is not None:
                    ends[end].append((start, score, ids))
                    if reached + score > best[end]:
                        best[end] = reached + score
                if not after:
                    break
            if start < size and text[start] not in self.scored:
                raw = b"".join(
                    self.byte_ids[b].to_bytes(4, "little") for b in text[start].encode())
                ends[start + 1].append((start, self.unknown, raw))
                best[start + 1] = max(best[start + 1], reached + self.unknown)
        return ends, best

    def search(self, text: str, n: int) -> list[Segmentation]:
        """The n best segmentations of a normalised text, best first.

        Among ties the latest find is popped first, which reaches the start soon. A
        position is left n times at most: its pops come best suffix first, and no
        later one can be part of the n best.
        """
        if not text:
            return [Segmentation(0.0, b"")]
        ends, best = self.lattice(text)
        # (-(bound), -order, position, score of the suffix, suffix chain)
        heap: list[tuple] = [(-best[-1], 0, len(text), 0.0, None)]
        pushed, out = 0, []
        left = [n] * len(ends)
        push, pop = heapq.heappush, heapq.heappop
        while heap:
            _, _, at, suffix, chain = pop(heap)
            if at == 0:
                parts = []
                while chain is not None:
                    parts.append(chain[0])
                    chain = chain[1]
                out.append(Segmentation(suffix, b"".join(parts)))
                if len(out) == n:
                    break
                continue
            if not left[at]:
                continue
            left[at] -= 1
            for start, score, ids in ends[at]:
                pushed -= 1
                total = suffix + score
                push(heap, (-(total + best[start]), pushed, start, total, (ids, chain)))
        return out

    def best(self, text: str) -> tuple[bytes, float, float]:
        """(best ids, its score, gap to the second): the first two of :meth:`search`.

        With an exact heuristic the search goes straight down the best way, by the
        latest of equal arcs, and the second leaves that way at its best other arc.
        """
        if not self.exact:
            ways = self.search(text, 2)
            gap = ways[0].score - ways[1].score if len(ways) > 1 else float("inf")
            return ways[0].data, ways[0].score, gap
        ends, best = self.lattice(text)
        at, parts, gap = len(text), [], float("inf")
        while at:
            bound, taken = best[at], None
            for arc in ends[at]:
                lost = bound - arc[1] - best[arc[0]]
                if lost:
                    if lost < gap:
                        gap = lost
                else:
                    if taken is not None:
                        gap = 0.0
                    taken = arc
            at = taken[0]
            parts.append(taken[2])
        parts.reverse()
        return b"".join(parts), best[-1], gap

    def word(self, text: str) -> tuple[bytes, float, float, bool]:
        """(best ids, its score, gap to the second, decodes back) of a word, kept by the task."""
        found = self.known.get(text)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            data, score, gap = self.best(text)
            back = self.joined(np.frombuffer(data, "<u4").tolist()) == text
            found = self.known[text] = (data, score, gap, back)
        return found

    def ways(self, text: str, n: int) -> list[Segmentation]:
        """The n best of a word; texts share the words with small gaps, so some are kept."""
        found = self.searched.get((text, n))
        if found is None:
            if len(self.searched) >= 20_000:
                self.searched.clear()
            found = self.searched[text, n] = self.search(text, n)
        return found

    def encode(self, text: str, n: int | None = None) -> tuple[list[Segmentation], bool]:
        """The n best segmentations of a whole text, and whether their words decode back."""
        n = self.n_best if n is None else n
        parts = self.cut(self.library.normalize(text))
        if not parts:
            return [Segmentation(0.0, b"")], True
        words = [*map(self.known.get, parts)]
        if None in words:
            words = [*map(self.word, parts)]
        data, scores, gaps, back = zip(*words, strict=True)
        base = sum(scores)
        # changes at n - 1 words with the smallest gaps suffice: each alone is as good as any other
        near = _smallest(gaps, n - 1)
        ways: list[tuple[float, dict[int, Segmentation]]] = [(0.0, {})]
        for i in near:
            if gaps[i] == float("inf"):
                break
            found = self.ways(parts[i], n)
            ways = heapq.nsmallest(n, (
                (lost + found[0].score - way.score, chosen if k == 0 else chosen | {i: way})
                for lost, chosen in ways for k, way in enumerate(found)), key=lambda x: x[0])
        out = []
        for lost, chosen in ways[:n]:
            some = data
            if chosen:
                some = [*data]
                for i, way in chosen.items():
                    some[i] = way.data
            out.append(Segmentation(base - lost, b"".join(some)))
        return out, all(back)

    def joined(self, ids: list[int]) -> str:
        """The normalised text of piece ids; bytes that are no text are replaced."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        """The text of piece ids: space marks become spaces, the one added in front goes."""
        return self.joined(ids).replace(SPACE, " ").removeprefix(" ")


@lru_cache(maxsize=1)
def piece_model(path: str, n_best: int) -> PieceModel:
    """The model of a worker process, with the words it has met."""
    return PieceModel(path, n_best)


def encode_documents(
    documents: DataFrame, model: str, n_best: int = 4, doc_id: str = "doc_id", text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, scores, n_tokens, ids_crc32, decodes (and ids).

    The arrays hold one entry per segmentation, best first; fewer than
    ``n_best`` where a text has no more. Texts are encoded whole; a null or
    empty text has one empty segmentation; repeated rows are encoded each;
    other columns are ignored.
    """

    def make():
        pieces = piece_model(model, n_best)

        def step(batch: pa.RecordBatch) -> dict:
            found = [pieces.encode(t) for t in batch.column("text").to_pylist()]
            columns = {
                "doc_id": batch.column("doc_id"),
                "scores": [[w.score for w in ways] for ways, _ in found],
                "n_tokens": [[len(w.data) // 4 for w in ways] for ways, _ in found],
                "ids_crc32": [[zlib.crc32(w.data) for w in ways] for ways, _ in found],
                "decodes": [back for _, back in found],
            }
            if with_ids:
                columns["ids"] = [[w.ids for w in ways] for ways, _ in found]
            return columns

        return step

    id_type = documents.schema[doc_id].dataType.simpleString()
    schema = (f"doc_id {id_type}, scores array<double>, n_tokens array<bigint>, "
              "ids_crc32 array<bigint>, decodes boolean")
    return map_batches(
        documents.select(F.col(doc_id).alias("doc_id"),
                         F.coalesce(F.col(text), F.lit("")).alias("text")),
        make, schema + (", ids array<array<bigint>>" if with_ids else ""))


def decode_documents(
    encoded: DataFrame, model: str, doc_id: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """(doc_id, text) of rows holding one array of piece ids; null ids give a null text."""

    def make():
        pieces = piece_model(model, 1)

        def step(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column("doc_id"), "text": [
                None if x is None else pieces.decode(x) for x in batch.column("ids").to_pylist()]}

        return step

    id_type = encoded.schema[doc_id].dataType.simpleString()
    return map_batches(encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")),
                       make, f"doc_id {id_type}, text string")
