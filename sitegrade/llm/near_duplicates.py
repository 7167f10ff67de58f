"""Near-duplicate documents: a multi-index Hamming join on minhash signatures.

A document is the set of its distinct five-word shingles. Its signature holds
``chunks * width`` minhashes of 16 bits. Two signatures that differ in at most
``chunks * (errors + 1) - 1`` symbols agree, by the pigeonhole principle, in all
but ``errors`` symbols of some chunk; so every chunk is entered once for each
choice of ``errors`` symbols left out, and all such pairs share a key.

Sharing a key is only a candidate. Keys are read as stars around their smallest
document: the documents of all keys with one centre form a cell. Cells are
thinned by signature distance, then compared on full shingle sets in blocks;
only spanning links leave a block, never all pairs. Cells larger than a block
are compared block by block, after the links inside blocks have merged most of
the cell, and blocks of one component are skipped.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade.llm.common import cut_lineage, map_batches
from sitegrade.llm.components import connected

WORDS = 5
SHARE = (75, 100)  # links: 100 * intersection >= 75 * union
CHUNKS, WIDTH, ERRORS = 10, 4, 1
#: Pairs further apart than this are not compared: at a similarity of 0.75 the
#: distance of 40 symbols exceeds it with a probability of 5e-6.
FARTHEST = 23
BLOCK = 512
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Hashes of words, kept for the task up to a bound."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, hashes: dict, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    found = text.encode().lower().split()  # bytes: only A-Z change, ASCII white space splits
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(h))
    out = np.zeros(len(h) - width + 1, np.uint64)
    for j in range(width):
        out = out * _ROOT + h[j:j + len(out)]
    out ^= out >> np.uint64(29)
    out *= _MIX
    return np.unique(out ^ (out >> np.uint64(32)))


@cache
def _hash_functions(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    factor = rng.integers(0, 2**32, size, dtype=np.uint32) | np.uint32(1)
    return factor, rng.integers(0, 2**32, size, dtype=np.uint32)


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` minhashes of 16 bits; the hash functions are fixed by their number."""
    factor, shift = _hash_functions(size)
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    least = np.full(size, 2**32 - 1, np.uint32)
    for start in range(0, len(low), 4096):
        part = low[None, start:start + 4096] * factor[:, None] + shift[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return ((least * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def sketches(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
             mark: str | None = None) -> DataFrame:
    """(doc_id, mark, n_shingles, digest, sig): set size, set identity, signature."""

    def make():
        hashes = WordHashes()

        def step(batch: pa.RecordBatch) -> dict:
            sets = [shingle_set(t, hashes) for t in batch.column(1).to_pylist()]
            return {
                "doc_id": batch.column(0),
                "mark": batch.column(2),
                "n_shingles": [len(s) for s in sets],
                "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "sig": [signature(s, CHUNKS * WIDTH).tobytes() if len(s) else None for s in sets],
            }

        return step

    return map_batches(
        documents.select(F.col(doc_id).cast("bigint").alias("doc_id"),
                         F.coalesce(F.col(text), F.lit("")).alias("text"),
                         (F.lit(None) if mark is None else F.col(mark)).cast("bigint").alias("mark")),
        make, "doc_id bigint, mark bigint, n_shingles bigint, digest binary, sig binary")


def chunk_keys(sig: str = "sig") -> Column:
    """All keys of a signature: each chunk with each choice of symbols left out."""
    def symbol(i: int) -> Column:
        return F.substring(sig, 2 * i + 1, 2)

    return F.array(*(
        F.xxhash64(F.lit(chunk), F.lit(slot), *(symbol(chunk * WIDTH + i) for i in kept))
        for chunk in range(CHUNKS)
        for slot, kept in enumerate(combinations(range(WIDTH), WIDTH - ERRORS))
    ))


def cells(representatives: DataFrame) -> DataFrame:
    """Distinct (centre, rep, n_shingles, sig): documents that share a key with a centre.

    The smallest document of a key is found by a map-side-combined minimum, so
    a hot key costs one row per map task before the join brings it back.
    """
    entries = representatives.select("rep", F.explode(chunk_keys()).alias("key"))
    shared = (
        entries.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("top"))
        .where("centre < top").select("key", "centre")
    )
    return (
        entries.join(shared, "key").select("centre", "rep").distinct()
        .join(representatives.select("rep", "n_shingles", "sig"), "rep")
    )


def _close(rows: pd.DataFrame) -> np.ndarray:
    """Which rows have another one near enough in signature and size."""
    sig = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(len(rows), -1)
    size = rows["n_shingles"].to_numpy()
    found = np.zeros(len(rows), bool)
    for i in range(len(rows) - 1):
        near = (sig[i + 1:] != sig[i]).sum(axis=1) <= FARTHEST
        near &= SHARE[1] * np.minimum(size[i + 1:], size[i]) >= (
            SHARE[0] * np.maximum(size[i + 1:], size[i]))
        if near.any():
            found[i] = True
            found[i + 1:] |= near
    return found


def _links(rows: pd.DataFrame, label: np.ndarray, pairs_of: np.ndarray | None) -> list:
    """Spanning links of the rows whose full sets are similar enough.

    Rows that ``label`` already holds together are not compared; ``pairs_of``
    restricts comparison to rows of different sides.
    """
    sets = [np.asarray(s, np.int64) for s in rows["shingles"]]
    ids = rows["rep"].to_numpy()
    size = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    place = np.empty(len(values), np.int64)
    place[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(values)]))
    ends = np.r_[starts[1:], len(values)]
    bounds = np.r_[0, np.cumsum(size)]
    label = label.copy()
    out: list = []
    if (label == label[:1]).all():
        return out
    for i in range(len(sets) - 1):
        # how many of document i's shingles every other one has
        groups = place[bounds[i]:bounds[i + 1]]
        counts = ends[groups] - starts[groups]
        shared = groups[counts > 1]
        if not len(shared):
            continue
        counts = counts[counts > 1]
        steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = owner[np.repeat(starts[shared], counts) + steps]
        common = np.bincount(at, minlength=len(sets))
        ok = SHARE[1] * common >= SHARE[0] * (size + size[i] - common)
        ok[:i + 1] = False
        if pairs_of is not None:
            ok &= pairs_of != pairs_of[i]
        for j in np.flatnonzero(ok):
            if label[j] != label[i]:
                out.append((ids[i], ids[j]))
                label[label == label[j]] = label[i]
    return out


def _compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """All links inside a block."""
    return pd.DataFrame(_links(rows, np.arange(len(rows)), None), columns=["a", "b"])


def _compare_sides(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks, or anew in one, that could join two components."""
    _, low, high = key
    sides = rows["block"].to_numpy() if low < high else None
    found = _links(rows, pd.factorize(rows["component"])[0], sides)
    return pd.DataFrame(found, columns=["a", "b"])


def _thin(members: DataFrame) -> DataFrame:
    """Members of cells of one block, without those far from all others."""
    return members.groupBy("centre").applyInPandas(
        lambda key, rows: rows.loc[_close(rows), ["centre", "rep"]], "centre bigint, rep bigint")


def similar_links(documents: DataFrame, representatives: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all similar representatives."""
    members = cut_lineage(cells(representatives))
    sizes = members.groupBy("centre").agg(F.count("*").alias("n"))
    sized = members.join(sizes, "centre")
    # one block: thinned by signatures; more blocks: kept whole
    kept = _thin(sized.where(F.col("n") <= BLOCK)).withColumn("n", F.lit(1).cast("bigint")).unionByName(
        sized.where(F.col("n") > BLOCK).select("centre", "rep", "n"))
    kept = cut_lineage(kept.withColumn("blocks", F.ceil(F.col("n") / BLOCK)))

    def make():
        hashes = WordHashes()

        def step(batch: pa.RecordBatch) -> dict:
            return {
                "rep": batch.column(0),
                "shingles": [shingle_set(t, hashes).view(np.int64)
                             for t in batch.column(1).to_pylist()],
            }

        return step

    wanted = documents.join(
        kept.select("rep").distinct(), documents["doc_id"] == F.col("rep"), "left_semi")
    sets = cut_lineage(map_batches(
        wanted.select(F.col("doc_id").alias("rep"), F.coalesce("text", F.lit("")).alias("text")),
        make, "rep bigint, shingles array<bigint>").dropDuplicates(["rep"]))
    inside = cut_lineage(
        kept.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
        .join(sets, "rep").select("centre", "block", "rep", "shingles")
        .groupBy("centre", "block").applyInPandas(_compare, "a bigint, b bigint"))
    large = kept.where("blocks > 1")
    if large.isEmpty():
        return inside
    # between blocks: small components share a block, one that fills blocks has its own
    joined = connected(inside)
    labelled = cut_lineage(
        large.join(joined, F.col("rep") == F.col("node"), "left")
        .select("centre", "rep", "blocks", F.coalesce("component", "rep").alias("component")))
    crowd = labelled.groupBy("centre", "component").agg(
        (F.count("*") > BLOCK).alias("crowd"))
    crowds = crowd.groupBy("centre").agg(F.count_if("crowd").alias("crowds"))
    placed = labelled.join(crowd, ["centre", "component"]).join(crowds, "centre").withColumn(
        "block", F.when(F.col("crowd"), F.pmod(F.xxhash64("rep"), "blocks") + F.col("blocks"))
        .otherwise(F.pmod(F.xxhash64("component"), "blocks")))
    sides = (
        placed.withColumn("other", F.explode(F.sequence(F.lit(0), 2 * F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        .where("low < blocks OR crowds > 1")  # a single crowd is one component already
    )
    across = (
        sides.join(sets, "rep")
        .select("centre", "low", "high", "block", "rep", "component", "shingles")
        .groupBy("centre", "low", "high").applyInPandas(_compare_sides, "a bigint, b bigint"))
    return inside.unionByName(cut_lineage(across))


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str | None = None,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, and ``mark`` where named.

    Texts are read whole. A null or empty text, or one without words, has an
    empty set and is linked with nothing; with fewer than five words the whole
    word sequence is the one shingle. Repeated rows of one doc_id are the same
    document; a null doc_id is never kept, and its component is that of its
    copies, else null; other columns are ignored.
    ``kept`` marks the smallest doc_id of each component. ``mark`` names a bigint
    column that comes along with each row, to tell rows of one doc_id apart.
    """
    plain = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    drawn = cut_lineage(sketches(documents, doc_id, text, mark))
    # copies: documents with the same set are one representative
    representatives = cut_lineage(
        drawn.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
        .agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("r"))
        .select("digest", F.col("r.doc_id").alias("rep"), "r.n_shingles", "r.sig"))
    components = connected(similar_links(plain, representatives))
    classes = (
        representatives.select("digest", "rep")
        .join(components, F.col("rep") == F.col("node"), "left")
        .select("digest", F.coalesce("component", "rep").alias("component"))
    )
    own = F.coalesce(F.col("component"), F.col("doc_id"))
    empty = drawn.where("digest IS NULL").withColumn("component", F.lit(None).cast("bigint"))
    filled = drawn.where("digest IS NOT NULL").join(classes, "digest", "left")
    return filled.unionByName(empty).select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce(own == F.col("doc_id"), F.lit(False)).alias("kept"),
        *([] if mark is None else ["mark"]))
