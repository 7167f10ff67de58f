"""Spelling variants by PartEnum signatures of letter multisets.

A word is a binary vector over (letter, how many-th of its kind). One inserted
or deleted letter changes one component, a replaced one changes two, so near
words are vectors at a Hamming distance of at most two. The components are dealt
to ``PARTS`` parts; two differences touch at most two of them, so near words
agree on all others. A signature is the projection on one choice of ``PARTS - 2``
parts: every choice is enumerated, and near words share at least one signature.

Signatures of common letters would be crowded, so each is split twice: by length
(a word of c letters meets words of c and of c + 1) and by an untouched half,
since one edit leaves the first or the last half of the shorter word as it is.
Both keep every near pair. Words with equal signatures meet in an equi-join whose
condition verifies the edit distance, so only near pairs leave it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrade.llm.common import arrow_schema, cut_lineage, map_batches, shared_folder

LETTERS = 6  # of a word, at least
TIMES = 5  # a word occurs, at least
RATIO = 5  # a form occurs that many times as often as its variant
#: Every 199th run of letters, by checksum, is read with one letter missing.
SLIP = 199
PARTS = 4
DIFFERENT = 2
#: Distinct words a task counts before it passes its counts on.
HELD = 500_000

#: Maximal runs that are too short to give a word are never cut out.
_RUNS = re.compile(f"[A-Za-zÀ-ÿ]{{{LETTERS},}}").findall


def words_of(doc_id: str, text: str) -> Counter:
    """Occurrences of the words of a whole text, slips applied."""
    found: Counter = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    low = text.encode().lower().decode()  # bytes: only A-Z change
    for run, n in Counter(_RUNS(low)).items():
        h = zlib.crc32(run.encode(), start)
        if h % SLIP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LETTERS:
                continue
        found[run] += n
    return found


def count_words(documents: DataFrame, doc_id: str, text: str, times: int = TIMES) -> DataFrame:
    """(word, n) of all words with at least ``times`` occurrences."""
    schema = arrow_schema("word string, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                schema=schema)

        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                held.update(words_of(key.as_py(), value.as_py()))
                if len(held) > HELD:
                    yield counted()
                    held = Counter()
        if held:
            yield counted()

    return documents.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).mapInArrow(run, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")).where(F.col("n") >= times)


def projections(word: str, parts: int = PARTS) -> list[str]:
    """The components of a word's vector, by part; a component is a letter of some order."""
    dealt: list[list[str]] = [[] for _ in range(parts)]
    order: Counter = Counter()
    for letter in sorted(word):
        dealt[(ord(letter) + 7 * order[letter]) % parts].append(letter)
        order[letter] += 1
    return ["".join(p) for p in dealt]


def signatures(word: str, parts: int = PARTS) -> list[int]:
    """All signatures of a word, hashed: choices of parts, by length and untouched half."""
    dealt = projections(word, parts)
    chosen = ["|".join(dealt[i] for i in kept) + f"|{number}" for number, kept in enumerate(
        combinations(range(parts), parts - DIFFERENT))]
    out = []
    for size in (len(word), len(word) - 1):
        half = size // 2
        for start in (f"{size}<{word[:half]}|", f"{size}>{word[half - size:]}|"):
            out += [xxhash.xxh3_64_intdigest(start + c) - 2**63 for c in chosen]
    return out


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """Distinct (a, a_n, b, b_n): every pair a < b of words (word, n) one edit apart.

    A crowded signature is one key of a sort-merge join, which adaptive
    execution may split on either side.
    """

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            names = batch.column(0).to_pylist()
            found = [signatures(w, parts) for w in names]
            width = len(found[0]) if found else 0
            at = [i for i in range(len(names)) for _ in range(width)]
            return {"key": [k for keys in found for k in keys],
                    "word": batch.column(0).take(pa.array(at, pa.int32())),
                    "n": batch.column(1).take(pa.array(at, pa.int32()))}
        return step

    entries = map_batches(words.select("word", "n"), make, "key bigint, word string, n bigint")
    left = entries.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = entries.select(
        F.col("key").alias("other"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    return left.join(right.hint("merge"), (F.col("key") == F.col("other")) & (F.col("a") < F.col("b"))
                     & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n").distinct()


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of words (word, form): the end of each chain of at most ``steps`` forms.

    Every round doubles the length of chain that is followed.
    """
    ends = cut_lineage(forms.select("word", F.col("form").alias("root")))
    for _ in range(ceil(log2(max(steps, 1)))):
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("end"))
        ends = cut_lineage(ends.join(onward, "root", "left").select(
            "word", F.coalesce("end", "root").alias("root")))
    return ends


def spelling_variants(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", times: int = TIMES,
    parts: int = PARTS,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Texts are read whole. A null text has no words, a null doc_id is the empty
    string in the checksum; repeated rows are counted each; of near words with
    equal counts the smallest is the form; an empty table gives no rows; other
    columns are ignored.
    """
    spark = documents.sparkSession
    folder = shared_folder(spark, "spelling")
    count_words(documents, doc_id, text, times).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    pairs = near_words(words, parts)
    both = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"),
                        F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"),
                     F.col("a_n").alias("near_n")))
    best = both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best_n = -F.col("best.less")
    fits = best_n >= RATIO * F.col("n")
    found = cut_lineage(best.select(
        "word", "n_near", F.when(fits, F.col("best.near")).alias("form"),
        F.when(fits, best_n).alias("form_n")))
    # counts grow by RATIO from form to form, so their range bounds the chains
    top = words.agg(F.max("n")).first()[0] or 1
    steps = 0
    while times * RATIO ** steps <= top:
        steps += 1
    ends = roots(found.where("form IS NOT NULL"), steps)
    return (
        words.join(found, "word", "left").join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"))
