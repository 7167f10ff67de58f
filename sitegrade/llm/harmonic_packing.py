"""Harmonic packing of token documents into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes: class k holds the pieces longer
than capacity / (k + 1) and at most capacity / k, and a bin of class k takes
exactly k of them. So a task fills bins by counting, without looking at any
other task. A document is cut where a whole piece would leave its class's bins
emptier than ``min_fill``: the cut takes a piece of exactly capacity / (k + 1),
and the rest, which is much shorter, is classed again.

What a task leaves over (fewer than k pieces of each class) meets the leavings
of other tasks, ``fan_in`` of them at a time, until one group per class is left.
The last bins, at most one per class, are then filled by best fit.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade.llm.common import arrow_schema, cut_lineage
from sitegrade.llm.pieces import worker_pieces

CAPACITY = 2048
_PIECE_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
_PLACE_COLUMNS = ("sequence_id", "offset")
_SCHEMA = ("doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
           "sequence_id bigint, offset bigint")


def cut_points(n: int, capacity: int, min_fill: float) -> list[int]:
    """Lengths of the pieces a document of ``n`` tokens is cut into, in order.

    >>> cut_points(1500, 2048, 0.97)
    [1024, 409, 67]
    """
    lengths = [capacity] * (n // capacity)
    n -= capacity * len(lengths)
    while n:
        k = capacity // n
        if k * n >= min_fill * capacity:
            lengths.append(n)
            break
        lengths.append(capacity // (k + 1))
        n -= lengths[-1]
    return lengths


class _Bins:
    """Open bins of one task, one per class: pieces are placed by counting alone."""

    def __init__(self, first: int):
        self.next = first
        self.open: dict[int, list[tuple]] = defaultdict(list)

    def add(self, size_class: int, piece: tuple) -> list[tuple]:
        """The placed pieces of a bin once it holds its class's count, else nothing."""
        waiting = self.open[size_class]
        waiting.append(piece)
        if len(waiting) < size_class:
            return []
        del self.open[size_class]
        number, self.next = self.next, self.next + 1
        offset, placed = 0, []
        for doc, start, length, crc, total in waiting:
            placed.append((doc, start, length, crc, total, number, offset))
            offset += length
        return placed

    def rest(self) -> list[tuple]:
        return [(*p, None, None) for pieces in self.open.values() for p in pieces]


def _first_sequence(level: int, task: int) -> int:
    """The start of a range of sequence ids that no other level or task uses."""
    return (level << 56) + (task << 28)


def _fill_rows(rows: pd.DataFrame, first: int) -> pd.DataFrame:
    """Deal waiting pieces of one class to bins; what is left over waits on."""
    bins, placed = _Bins(first), []
    ordered = rows.sort_values(["doc_id", "start"])
    for size_class, *piece in ordered[["size_class", *_PIECE_COLUMNS]].itertuples(index=False):
        placed += bins.add(size_class, tuple(piece))
    # objects, since a null would turn whole numbers into floats
    return pd.DataFrame(
        placed + bins.rest(), columns=[*_PIECE_COLUMNS, *_PLACE_COLUMNS], dtype=object)


def _best_fit(rows: pd.DataFrame, capacity: int, first: int) -> pd.DataFrame:
    """Pack the last leavings, fewer than k of each class, longest first."""
    rows = rows.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
    free: list[tuple[int, int]] = []  # (room, bin), ordered
    sequence, place, opened = [], [], 0
    for length in rows["length"].tolist():
        at = bisect.bisect_left(free, (length, -1))
        if at < len(free):
            room, number = free.pop(at)
        else:
            room, number, opened = capacity, opened, opened + 1
        sequence.append(first + number)
        place.append(capacity - room)
        if room > length:
            bisect.insort(free, (room - length, number))
    return rows[list(_PIECE_COLUMNS)].assign(sequence_id=sequence, offset=place)


def pack(
    documents: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
    min_fill: float = 0.97, fan_in: int = 512, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document (its tokens, then ``end_id``) lies in one piece.
    A null or empty text is the end id alone; repeated rows are packed each;
    an empty table gives no rows; other columns are ignored. Texts of any
    length are read whole. ``tokenizer`` is the path of a tokenizers file whose
    rules ``Pieces`` knows.
    """
    id_type = documents.schema[doc_id].dataType.simpleString()
    schema = _SCHEMA.format(id=id_type)
    arrow = arrow_schema(schema + ", task int")

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(tokenizer, lower=True)
        last = end_id.to_bytes(4, "little")
        task = TaskContext.get().partitionId()
        bins = _Bins(_first_sequence(0, task))

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = [*zip(*rows, strict=True), [task] * len(rows)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)],
                schema=arrow)

        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                placed: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(),
                                    pieces.ids(part.column(1).to_pylist()), strict=True):
                    ids += last
                    total, start = len(ids) // 4, 0
                    for length in cut_points(total, capacity, min_fill):
                        crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                        placed += bins.add(capacity // length, (doc, start, length, crc, total))
                        start += length
                if placed:
                    yield out(placed)
        if rest := bins.rest():
            yield out(rest)

    texts = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed = cut_lineage(texts.mapInArrow(tokenize, schema + ", task int"))
    columns = [*_PIECE_COLUMNS, *_PLACE_COLUMNS]
    done = placed.where("sequence_id IS NOT NULL").select(columns)
    waiting = placed.where("sequence_id IS NULL").withColumn("size_class", _size_class(capacity))
    groups, level = texts.rdd.getNumPartitions(), 0
    while groups > 1:
        groups, level = ceil(groups / fan_in), level + 1
        filled = cut_lineage(
            waiting.withColumn("task", F.floor(F.col("task") / fan_in).cast("int"))
            .groupBy("size_class", "task")
            .applyInPandas(_merge_step(level), schema + ", task int"))
        done = done.unionByName(filled.where("sequence_id IS NOT NULL").select(columns))
        waiting = filled.where("sequence_id IS NULL").withColumn(
            "size_class", _size_class(capacity))
    last = waiting.groupBy().applyInPandas(
        lambda rows: _best_fit(rows, capacity, _first_sequence(level + 1, 0)), schema)
    return done.unionByName(last)


def _size_class(capacity: int) -> Column:
    return F.floor(F.lit(capacity) / F.col("length")).cast("int")


def _merge_step(level: int):
    """Fill bins of one class from the leavings of ``fan_in`` tasks."""

    def step(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        size_class, task = map(int, key)
        # a class fills fewer than 2**16 bins here: fan_in * k pieces make at most fan_in bins
        first = _first_sequence(level, task) + (size_class << 16)
        return _fill_rows(rows, first).assign(task=task)

    return step
