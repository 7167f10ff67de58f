"""Phrase collocations by SETM: mining over sorted relations of occurrences.

The relation of length k holds, in the order of the text, every place where a
frequent group of k words starts. Two neighbouring places of one piece are
merge-joined to an occurrence of k + 1 words: its group is the pair of the
groups at the two places. Groups are counted with a sort and a run count in each
task and one aggregate in Spark; occurrences of groups that are not frequent
leave the relation (the semi-join) before the next length is tried. Every part
of a frequent phrase is frequent, so nothing of use is lost.

A relation is a table of blocks, each a run of whole texts with its places and
groups as packed numbers. It is written to the shared folder, read by the next
step, and removed when the step after it is written. Occurrences never move:
only counts are shuffled, and the groups kept come back by a broadcast where
they are few (``sent``), else by a join on the distinct groups of each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitegrade.llm.common import arrow_schema, drop_folder, shared_folder

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences of a candidate
COVERED = (80, 100)  # a longer phrase covers a part with 100 * f(longer) >= 80 * f(part)
REPORTED = 2000  # phrases of a language that are returned
#: Words a block of a relation holds; a longer text is one block.
BLOCK = 1 << 17
#: Occurrences whose groups a task sorts at once (some 25 MB with what it makes of them).
HELD = 1 << 18
#: Frequent groups, and bytes of frequent words, that may be broadcast: each worker process
#: holds 16 bytes a group, but some eight times the bytes of the words.
SENT = 1 << 20
_SENT_BYTES = 4 << 20
#: Bytes of rows that go to a worker process at once; a block alone may be larger.
BATCH = "4m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: A-Z to a-z, and every mark that ends a piece to a full stop.
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9)
_NARROW = 1 << 32


class _Codes(dict):
    """Numbers of one language's words in a block; words new to it are appended to ``labels``."""

    def __init__(self, lang: bytes, labels: list[bytes]):
        super().__init__({b".": 0})
        self.start, self.labels = lang + b"\n", labels

    def __missing__(self, word: bytes) -> int:
        self.labels.append(self.start + word)
        code = self[word] = len(self.labels)
        return code


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Send blocks to worker processes a few at a time: one is megabytes, a task holds dozens."""
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, BATCH)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def word_blocks(documents: DataFrame, lang: str, text: str) -> DataFrame:
    """(block, labels, codes): the words of whole texts in order, 0 between pieces.

    A label is the language, a line end (which no word holds) and the word.
    """
    schema = arrow_schema("block bigint, labels array<binary>, codes binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        labels: list[bytes] = []
        tables: dict[bytes, _Codes] = {}
        parts: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "block": [(task << 33) + number], "labels": [labels],
                "codes": [np.concatenate(parts).tobytes()]}, schema=schema)

        for batch in batches:
            for language, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      strict=True):
                words = data.translate(_FOLD).replace(b".", b" . ").split()
                words.append(b".")
                table = tables.get(language)
                if table is None:
                    table = tables[language] = _Codes(language, labels)
                parts.append(np.fromiter(map(table.__getitem__, words), np.int32, len(words)))
                held += len(words)
                if held >= BLOCK:
                    yield block()
                    number, held, labels, tables, parts = number + 1, 0, [], {}, []
        if held:
            yield block()

    return documents.select(
        F.coalesce(F.col(lang), F.lit("und")).cast("binary").alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    ).mapInArrow(run, "block bigint, labels array<binary>, codes binary")


def count_words(blocks: DataFrame) -> DataFrame:
    """(label, a): occurrences of every word; a label without a word has its language's sum."""
    schema = arrow_schema("label binary, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for labels, codes in zip(batch.column(0), batch.column(1), strict=True):
                values = labels.values
                n = np.bincount(np.frombuffer(codes.as_py(), np.int32), minlength=len(values) + 1)[1:]
                words = values.to_pylist()
                totals: dict[bytes, int] = {}
                for word, times in zip(words, n.tolist(), strict=True):
                    start = word[:word.rindex(b"\n") + 1]
                    totals[start] = totals.get(start, 0) + times
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*words, *totals], pa.binary()),
                     pa.array([*n.tolist(), *totals.values()], pa.int64())], schema=schema)

    return (blocks.select("labels", "codes").mapInArrow(run, "label binary, n bigint")
            .groupBy("label").agg(F.sum("n").alias("a")))


def packed(places: np.ndarray, groups: np.ndarray) -> tuple[bytes, bytes]:
    """A block's sorted occurrences as bytes: steps between places, and groups."""
    return np.diff(places, prepend=0).astype(np.int32).tobytes(), groups.astype(np.int64).tobytes()


def unpacked(steps: bytes, groups: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(steps, np.int32), dtype=np.int64), np.frombuffer(groups, np.int64)


def neighbours(places: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join with the next place of the piece: place, its group, and the next one's."""
    at = np.flatnonzero(np.diff(places) == 1)
    return places[at], groups[at], groups[at + 1]


def runs(left: np.ndarray, right: np.ndarray, places: bool = True) -> tuple:
    """Distinct pairs in order: left, right, number of each, and the run of each occurrence.

    Without ``places``, the last is left out where that saves an argument sort.
    """
    if not len(left):
        return left, right, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if max(left.max(), right.max()) < _NARROW:
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        if places:
            key, run, n = np.unique(key, return_inverse=True, return_counts=True)
        else:
            run, (key, n) = None, np.unique(key, return_counts=True)
        return ((key >> np.uint64(32)).astype(np.int64), (key & np.uint64(_NARROW - 1)).astype(np.int64),
                n, run)
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])]
    run = np.empty(len(left), np.int64)
    run[order] = np.cumsum(first) - 1
    at = np.flatnonzero(first)
    return left[at], right[at], np.diff(np.r_[at, len(left)]), run


def count_pairs(relation: DataFrame) -> DataFrame:
    """(left, right, a): occurrences of every group of one more word."""
    schema = arrow_schema("left bigint, right bigint, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            left, right = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            columns = runs(left, right, places=False)[:3]
            for low in range(0, len(columns[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[low:low + (1 << 16)], pa.int64()) for x in columns], schema=schema)

        for batch in batches:
            for steps, groups in zip(batch.column(0), batch.column(1), strict=True):
                _, left, right = neighbours(*unpacked(steps.as_py(), groups.as_py()))
                held.append((left, right))
                size += len(left)
                if size >= HELD:
                    yield from counted()
                    size = 0
        if held:
            yield from counted()

    return (relation.select("steps", "groups").mapInArrow(run, "left bigint, right bigint, n bigint")
            .groupBy("left", "right").agg(F.sum("n").alias("a")))


def numbered(groups: DataFrame, path: str) -> DataFrame:
    """Write a table and read it with ``id``: 0, 1, 2, ... without gaps.

    Rows are numbered within the partitions that wrote them; only the sizes of
    the partitions, a row each, are summed on the driver.
    """
    groups.withColumn("mark", F.monotonically_increasing_id()).write.option(
        "compression", "zstd").parquet(path)
    spark = groups.sparkSession
    found = spark.read.parquet(path)
    part = F.shiftright("mark", 33)
    sizes = sorted(found.groupBy(part.alias("part")).count().collect())
    ends = np.cumsum([0] + [n for _, n in sizes]).tolist()
    starts = spark.createDataFrame(
        [(p, at) for (p, _), at in zip(sizes, ends, strict=False)], "part bigint, first bigint")
    return (
        found.withColumn("part", part).join(F.broadcast(starts), "part")
        .withColumn("id", F.col("first") + F.col("mark").bitwiseAND((1 << 33) - 1))
        .drop("mark", "part", "first"))


_RELATION = "block bigint, steps binary, groups binary"


def _semi_join(rows: DataFrame, columns: list[str], distinct: Callable,
               shared: Callable | None = None, found: DataFrame | None = None) -> DataFrame:
    """Keep the occurrences of frequent groups, under the numbers of those groups.

    ``distinct`` gives a row's distinct groups and the run of each occurrence.
    Their numbers come from ``shared`` (a function of the broadcast table) or
    from ``found`` (block, run, id), sorted in behind the row.
    """
    schema = arrow_schema(_RELATION)

    def related(block: int, ids: np.ndarray, run_of: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        of = ids[run_of]
        kept = of >= 0
        steps, data = packed(places[kept], of[kept])
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([steps], pa.binary()), pa.array([data], pa.binary())],
            schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = shared()
        for batch in batches:
            for block, *values in zip(*batch.columns, strict=True):
                groups, run_of, places = distinct(*values)
                yield related(block.as_py(), look(groups), run_of, places)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            runs_, ids = (batch.column(i).to_numpy() for i in (1, 2))
            heads = np.flatnonzero(runs_ < 0).tolist()
            for low, high in zip([0, *heads], [*heads, batch.num_rows], strict=True):
                if high > low and runs_[low] < 0:
                    if held is not None:
                        yield related(*held)
                    groups, run_of, places = distinct(*(batch.column(i)[low] for i in (3, 4)))
                    held = batch.column(0)[low].as_py(), np.full(len(groups[0]), -1, np.int64), run_of, places
                    low += 1
                if high > low:
                    held[1][runs_[low:high]] = ids[low:high]
        if held is not None:
            yield related(*held)

    rows = rows.select("block", *columns)
    if found is None:
        return rows.mapInArrow(run, _RELATION)
    # one number a row: neither a task nor a group holds the numbers of many blocks
    heads = rows.select("block", F.lit(-1).alias("run"), F.lit(-1).cast("bigint").alias("id"), *columns)
    none = [F.lit(None).cast(heads.schema[c].dataType).alias(c) for c in columns]
    behind = heads.unionByName(found.select("block", "run", "id", *none))
    return behind.repartition("block").sortWithinPartitions("block", "run").mapInArrow(follow, _RELATION)


def _distinct_words(labels: pa.Scalar, codes: pa.Scalar) -> tuple:
    found = np.frombuffer(codes.as_py(), np.int32)
    places = np.flatnonzero(found)
    return (labels.values.to_pylist(),), found[places] - 1, places


def _distinct_pairs(steps: pa.Scalar, groups: pa.Scalar) -> tuple:
    places, left, right = neighbours(*unpacked(steps.as_py(), groups.as_py()))
    left, right, _, run = runs(left, right)
    return (left, right), run, places


def _ids_of_blocks(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    """(block, run, id): the numbers of the frequent groups of each block, by a shuffled join."""
    return rows.join(groups.select(*on, "id").hint("merge"), on).select("block", F.col("run").cast("int"), "id")


def keep_words(blocks: DataFrame, words: DataFrame, sent: int = SENT,
               sending: list | None = None) -> DataFrame:
    """The relation of length 1: places of frequent words (label, id) in every block.

    A broadcast made for it is added to ``sending``, to be freed once the relation is written.
    """
    n, size = words.agg(F.count("*"), F.coalesce(F.sum(F.length("label")), F.lit(0))).first()
    if n <= sent and size <= _SENT_BYTES:
        table = words.select("label", "id").toArrow()
        known = dict(zip(table["label"].to_pylist(), table["id"].to_pylist(), strict=True))
        shared = blocks.sparkSession.sparkContext.broadcast(known)
        if sending is not None:
            sending.append(shared)

        def look() -> Callable:
            get = shared.value.get
            return lambda groups: np.fromiter((get(w, -1) for w in groups[0]), np.int64, len(groups[0]))

        return _semi_join(blocks, ["labels", "codes"], _distinct_words, look)
    rows = blocks.select("block", F.posexplode("labels").alias("run", "label"))
    return _semi_join(blocks, ["labels", "codes"], _distinct_words,
                      found=_ids_of_blocks(rows, words, ["label"]))


def keep_pairs(relation: DataFrame, pairs: DataFrame, sent: int = SENT) -> DataFrame:
    """The relation of one more word: places of frequent groups (left, right, id)."""
    n, top = pairs.agg(F.count("*"), F.max(F.greatest("left", "right"))).first()
    if n <= sent and (top or 0) < _NARROW:
        table = pairs.select("left", "right", "id").toArrow()
        left, right, ids = (table[c].to_numpy() for c in ("left", "right", "id"))
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        order = np.argsort(key)
        shared = relation.sparkSession.sparkContext.broadcast((key[order], ids[order]))

        def look() -> Callable:
            keys, numbers = shared.value

            def find(groups: tuple) -> np.ndarray:
                # both sides of the search are sorted, so it walks the table once
                key = groups[0].astype(np.uint64) << np.uint64(32) | groups[1].astype(np.uint64)
                if not len(keys):
                    return np.full(len(key), -1, np.int64)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                return np.where(keys[at] == key, numbers[at], -1)

            return find

        return _semi_join(relation, ["steps", "groups"], _distinct_pairs, look)
    schema = arrow_schema("block bigint, run int, left bigint, right bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *values in zip(*batch.columns, strict=True):
                (left, right), _, _ = _distinct_pairs(*values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(left), block.as_py()), pa.int64()),
                     pa.array(np.arange(len(left)), pa.int32()),
                     pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)

    rows = relation.select("block", "steps", "groups").mapInArrow(
        run, "block bigint, run int, left bigint, right bigint")
    return _semi_join(relation, ["steps", "groups"], _distinct_pairs,
                      found=_ids_of_blocks(rows, pairs, ["left", "right"]))


def described(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Phrases of one more word: language, text, and the counts of all their parts.

    ``before`` counts the first 1, 2, ... words, ``after`` the last 1, 2, ...;
    ``left`` and ``right`` are the groups of one word less.
    """
    def side(name: str) -> DataFrame:
        return parts.select(F.col("id").alias(name), F.struct(parts.columns).alias(f"{name}_part"))

    joined = pairs.join(side("left"), "left").join(side("right"), "right")
    left, right = F.col("left_part"), F.col("right_part")
    return joined.select(
        "id", left["lang"].alias("lang"), F.concat_ws(" ", left["phrase"], right["last"]).alias("phrase"),
        right["last"].alias("last"), "a",
        F.concat(left["before"], F.array(left["a"])).alias("before"),
        F.concat(right["after"], F.array(right["a"])).alias("after"), "left", "right")


def _scored(phrases: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each phrase: score, l and r."""
    k = F.size("before")
    cuts = F.transform(F.sequence(F.lit(1), k), lambda cut: F.struct(
        cut.alias("cut"), F.get("before", cut - 1).alias("l"), F.get("after", k - cut).alias("r")))
    scored = F.transform(cuts, lambda c: F.struct(
        F.call_function("div", F.col("a").cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)"),
                        (c["l"] + c["r"]).cast("decimal(20,0)")).alias("score"),
        c["cut"].alias("cut"), c["l"].alias("l"), c["r"].alias("r")))
    best = phrases.withColumn("best", F.array_min(scored))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _first(rows: DataFrame, keys: list[Column], limit: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def _mined(
    documents: DataFrame, lang: str, text: str, least: int, sent: int,
) -> tuple[list[DataFrame], DataFrame]:
    """For each length its described phrases, and the words of each language.

    All work on blocks is done when it returns.
    """
    spark = documents.sparkSession
    folder = shared_folder(spark, "collocations")

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    enough = F.col("a") >= least
    blocks = written(word_blocks(documents, lang, text), "blocks")
    label = F.col("label").cast("string")
    word = F.substring_index(label, "\n", -1)
    seen = (
        count_words(blocks).withColumn("word", word).where(enough | (F.col("word") == ""))
        .withColumn("lang", F.left(label, F.length(label) - F.length("word") - 1)))
    words = numbered(seen, f"{folder}/words")
    totals = words.where("word = ''").select("lang", F.col("a").alias("n"))
    words = words.where("word <> ''")
    none = F.array().cast("array<bigint>")
    parts = words.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a",
                         none.alias("before"), none.alias("after"))
    sending: list = []
    relation = written(keep_words(blocks, words, sent, sending), "length1")
    for shared in sending:
        shared.destroy()
    drop_folder(spark, f"{folder}/blocks")
    found = []
    for length in range(2, LONGEST + 1):
        pairs = numbered(count_pairs(relation).where(enough), f"{folder}/groups{length}")
        # written, as each length reads the one before twice: plans and broadcasts would double
        parts = written(described(pairs, parts), f"phrases{length}")
        found.append(parts)
        if length < LONGEST:
            relation = written(keep_pairs(relation, pairs, sent), f"length{length}")
        drop_folder(spark, f"{folder}/length{length - 1}")
    return found, totals


def collocations(
    documents: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST,
    reported: int = REPORTED, sent: int = SENT,
) -> DataFrame:
    """The best ``reported`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are read whole. A null text is empty, a null language is ``und``;
    repeated rows are counted each; ties of score and count go to the smaller
    phrase in byte order; an empty table, or one without a frequent phrase, gives
    no rows; other columns, of whatever name, are ignored. ``sent`` bounds the
    frequent groups that are broadcast and changes no result.
    """
    spark = documents.sparkSession
    with small_batches(spark):
        found, totals = _mined(documents, lang, text, least, sent)
    kept = []
    for i, phrases in enumerate(found):
        if i + 1 < len(found):
            # a phrase inside a longer one is inside one of a single word more, which is as frequent
            cover = found[i + 1].select(
                F.explode(F.array("left", "right")).alias("id"), F.col("a").alias("cover")
            ).groupBy("id").agg(F.max("cover").alias("cover"))
            phrases = phrases.join(cover, "id", "left").where(
                F.col("cover").isNull() | (COVERED[1] * F.col("cover") < COVERED[0] * F.col("a")))
        kept.append(_scored(phrases))
    candidates = kept[0]
    for more in kept[1:]:
        candidates = candidates.unionByName(more)
    # first within slices of a language, so that no task orders all of its phrases
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = _first(candidates, [F.col("lang"), F.pmod(F.xxhash64("phrase"), F.lit(slices))], reported)
    return _first(near.drop("rank"), [F.col("lang")], reported).join(
        F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
