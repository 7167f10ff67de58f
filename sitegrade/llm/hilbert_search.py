"""Approximate nearest neighbours on several shifted Hilbert curves.

Every curve projects the vectors on a few random orthogonal directions, shifts
the grid, and orders all rows by Hilbert key. Spark range-partitions each order,
so a row's rank is its place in its partition plus the rows before it. Blocks of
ranks meet the windows around them: each query is scored exactly against its
block and half a window on both sides, and the best of all curves are merged
and reranked. Windows are a fixed share of the rows, so recall does not fall as
the table grows; data of low dimension allow a far smaller share.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegrade.llm.common import cut_lineage

_FOUND = "query_id bigint, vec_id bigint, score double"


@dataclass(frozen=True)
class Curves:
    """Number and grid of the curves, and the share of rows in a window."""

    curves: int = 16
    directions: int = 8
    bits: int = 5
    window: float = 0.05
    least_block: int = 512
    slice_rows: int = 65_536  # candidates one task group holds
    fit_rows: int = 2048  # bounded sample that sets the range of each direction
    seed: int = 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of integer cells (rows, directions).

    The transposed form: undo excess work from the highest bit down, then Gray
    code, then interleave the bits.
    """
    axes = cells.astype(np.int64).T.copy()
    n = len(axes)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            hit = (axes[i] & q) > 0
            swap = np.where(hit, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(hit, axes[0] ^ low, axes[0] ^ swap)
            axes[i] ^= swap
        q >>= 1
    for i in range(1, n):
        axes[i] ^= axes[i - 1]
    turn = np.zeros_like(axes[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((axes[n - 1] & q) > 0, turn ^ (q - 1), turn)
        q >>= 1
    axes ^= turn
    key = np.zeros(axes.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((axes[i] >> b) & 1)
    return key


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v as double): without null, zero or non-finite vectors and null ids."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < F.lit(float("inf"))))
    return vectors.where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
        & F.exists("embedding", lambda x: x != 0)
    ).select(F.col("vec_id").cast("bigint").alias("vec_id"),
             F.col("embedding").cast("array<double>").alias("v"))


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    """Rows as one array; shorter vectors are filled up with zeros, longer ones cut."""
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, :len(v)] = v[:width]
    return out


def _directions(width: int, c: Curves) -> np.ndarray:
    """(curves, width, directions): orthogonal directions of each curve."""
    rng = np.random.default_rng(c.seed)
    size = max(width, c.directions)
    return np.stack([
        np.linalg.qr(rng.standard_normal((size, c.directions)))[0][:width]
        for _ in range(c.curves)])


def curve_keys(vectors: DataFrame, c: Curves) -> DataFrame:
    """(curve, key, vec_id): the place of every row on every curve."""
    sample = (
        vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(c.fit_rows).select("v").toPandas()["v"])
    width = max(map(len, sample), default=1)
    directions = _directions(width, c)
    fitted = np.einsum("nw,cwd->cnd", _matrix(sample, width), directions)
    if not len(sample):
        fitted = np.zeros((c.curves, 1, c.directions))
    low, high = (np.quantile(fitted, x, axis=1) for x in (0.005, 0.995))
    cell = np.maximum(high - low, 1e-12) / (2**c.bits - 4)
    # each curve's grid is shifted by its own part of a few cells
    shift = np.random.default_rng(c.seed + 1).uniform(0, 4, low.shape)

    def keys(parts):
        for part in parts:
            points = _matrix(part["v"], width)
            for k in range(c.curves):
                cells = np.floor((points @ directions[k] - low[k]) / cell[k] + shift[k])
                cells = np.clip(cells, 0, 2**c.bits - 1).astype(np.int64)
                yield pd.DataFrame({
                    "curve": np.int32(k), "key": hilbert_keys(cells, c.bits),
                    "vec_id": part["vec_id"]})

    return vectors.mapInPandas(keys, "curve int, key bigint, vec_id bigint")


def curve_ranks(vectors: DataFrame, rows: int, c: Curves) -> DataFrame:
    """(curve, vec_id, rank): ranks along each curve, from range partitions."""
    parts = max(1, ceil(rows * c.curves / 65_536))
    numbered = cut_lineage(
        curve_keys(vectors, c).repartitionByRange(parts, "curve", "key", "vec_id")
        .sortWithinPartitions("curve", "key", "vec_id")
        .select("curve", "vec_id", F.monotonically_increasing_id().alias("at"))
        .withColumn("part", F.shiftright("at", 33)))
    counts = numbered.groupBy("curve", "part").agg(
        F.count("*").alias("n"), F.min("at").alias("first"))
    order = Window.partitionBy("curve").orderBy("part")
    before = F.sum("n").over(order) - F.col("n")
    starts = counts.select("curve", "part", (before - F.col("first")).alias("offset"))
    return numbered.join(starts, ["curve", "part"]).select(
        "curve", "vec_id", (F.col("at") + F.col("offset")).alias("rank"))


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in component order."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def _score_group(k: int):
    def step(key: tuple, points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        ids, own = points["vec_id"].to_numpy(), asked["query_id"].to_numpy()
        if not len(ids) or not len(own):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        width = max(points["v"].map(len).max(), asked["v"].map(len).max())
        x, q = _matrix(points["v"], width), _matrix(asked["v"], width)
        out = []
        for low in range(0, len(q), 256):
            some, some_ids = q[low:low + 256], own[low:low + 256]
            rough = some @ x.T
            rough[some_ids[:, None] == ids[None, :]] = -np.inf
            # all within rounding of the k-th best are scored exactly
            most = min(k, len(ids))
            kth = np.partition(rough, -most, axis=1)[:, -most]
            row, col = np.nonzero((rough >= (kth - 1e-9 * (1 + np.abs(kth)))[:, None])
                                  & np.isfinite(rough))
            score = _inner(some[row], x[col])
            order = np.lexsort((ids[col], -score, row))
            row, col, score = row[order], col[order], score[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            best = place < k
            out.append(pd.DataFrame({
                "query_id": some_ids[row[best]], "vec_id": ids[col[best]], "score": score[best]}))
        return pd.concat(out)

    return step


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, c: Curves = Curves()
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found by inner product.

    ``vectors`` has (vec_id, v), every row of it is indexed; ``queries`` holds
    (query_id) of rows among them. Ties go to the smaller vec_id; a query does
    not find its own row. Repeated ids are one row; empty tables give no rows.
    """
    vectors = cut_lineage(vectors.groupBy("vec_id").agg(F.min("v").alias("v")))
    rows = vectors.count()
    half = ceil(c.window * rows / 2)
    block = max(c.least_block, 2 * half)
    slices = max(1, ceil((block + 2 * half) / c.slice_rows))
    ranks = cut_lineage(curve_ranks(vectors, rows, c))

    def block_of(rank):
        return F.floor(rank / F.lit(block)).cast("int")

    last = block_of(F.lit(max(rows - 1, 0)))
    points = (
        ranks.withColumn("block", F.explode(F.sequence(
            F.greatest(block_of(F.col("rank") - half), F.lit(0)),
            F.least(block_of(F.col("rank") + half), last))))
        .withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int"))
        .join(vectors, "vec_id").select("curve", "block", "slice", "vec_id", "v"))
    asked = (
        queries.select("query_id").distinct()
        .join(vectors.withColumnRenamed("vec_id", "query_id"), "query_id")
        .join(ranks.withColumnRenamed("vec_id", "query_id"), "query_id")
        .withColumn("block", block_of(F.col("rank")))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        # new names, since both sides of the cogroup descend from the same tables
        .select(*(F.col(n).alias(n) for n in ("curve", "block", "slice", "query_id", "v"))))
    found = points.groupBy("curve", "block", "slice").cogroup(
        asked.groupBy("curve", "block", "slice")).applyInPandas(_score_group(k), _FOUND)
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
