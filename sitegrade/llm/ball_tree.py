"""Exact top-k inner products: ball-tree branch and bound in each shard.

Rows are dealt to shards of bounded size and queries to blocks of bounded size;
one task group searches one block in one shard. Inside, a ball tree is searched
best bound first: the inner product of a query with anything in a ball is at
most ``q . centre + |q| * radius``. The k-th score found so far prunes for all
later nodes. It is also shared across shards: a first round searches each block
in one shard, and its k-th scores prune the search of all others.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegrade.llm.common import cut_lineage

SHARD_ROWS = 4096
BLOCK_QUERIES = 1024
LEAF = 128
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def grid_vectors(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as long; bad vectors are left out.

    Null vectors and those holding null or non-finite components take no part,
    nor do rows with a null id.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < F.lit(float("inf"))))
    grid = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), grid.cast("array<bigint>").alias("v"))


def matrix(values: pd.Series, width: int) -> np.ndarray:
    """Rows as one array of exact numbers; shorter vectors are filled up with zeros."""
    if all(len(v) == width for v in values):
        out = np.array(values.tolist(), dtype=np.int64).reshape(len(values), width)
    else:
        out = np.zeros((len(values), width), np.int64)
        for i, v in enumerate(values):
            out[i, :len(v)] = v
    return out


class BallTree:
    """A tree over integer vectors, split at the median of the widest direction."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # (low, high, centre, radius, left, right)
        self._points = points.astype(np.float64)
        self._build(0, len(points), leaf)
        self.points = self._points[self.order]

    def _build(self, low: int, high: int, leaf: int) -> int:
        rows = self._points[self.order[low:high]]
        centre = rows.mean(axis=0)
        gaps = rows - centre
        radius = float(np.sqrt((gaps * gaps).sum(axis=1).max())) * (1 + 1e-9) + 1e-9
        number = len(self.nodes)
        self.nodes.append((low, high, centre, radius, -1, -1))
        if high - low > leaf and radius > 1e-6:
            # the direction from the farthest row to the row farthest from it
            first = rows[(gaps * gaps).sum(axis=1).argmax()]
            away = ((rows - first) ** 2).sum(axis=1).argmax()
            side = np.argsort(rows @ (rows[away] - first), kind="stable")
            self.order[low:high] = self.order[low:high][side]
            middle = (low + high) // 2
            left = self._build(low, middle, leaf)
            right = self._build(middle, high, leaf)
            self.nodes[number] = (low, high, centre, radius, left, right)
        return number


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, points: np.ndarray,
    k: int, bound: np.ndarray,
) -> tuple[list, list, list]:
    """Up to k best of ``points`` for every query, none below its ``bound``.

    Nodes are visited by their largest upper bound over the queries that still
    need them; a node is opened only for those queries.
    """
    exact = np.float64
    top = int(np.abs(points).max(initial=0)) * int(np.abs(queries).max(initial=0))
    if top * max(1, points.shape[1]) >= 2**52:
        exact = np.int64
    tree = BallTree(points)
    tree_points = points[tree.order].astype(exact)
    tree_ids = ids[tree.order]
    q = queries.astype(np.float64)
    q_exact = queries.astype(exact)
    norms = np.sqrt((q * q).sum(axis=1))
    slack = 1e-6 + 1e-12 * norms
    kth = bound.astype(np.float64)
    best_score: list[np.ndarray] = [np.zeros(0, np.int64) for _ in query_ids]
    best_id: list[np.ndarray] = [np.zeros(0, np.int64) for _ in query_ids]

    def upper(node: int, of: np.ndarray) -> np.ndarray:
        _, _, centre, radius, _, _ = tree.nodes[node]
        return q[of] @ centre + norms[of] * radius + slack[of] + 1e-9 * norms[of] * radius

    every = np.arange(len(query_ids))
    first = upper(0, every)
    heap = [(-float(first.max(initial=-np.inf)), 0, every, first)]
    while heap:
        _, node, of, limit = heapq.heappop(heap)
        alive = limit >= kth[of]
        of = of[alive]
        if not len(of):
            continue
        low, high, _, _, left, right = tree.nodes[node]
        if left < 0:
            scores = q_exact[of] @ tree_points[low:high].T
            here = tree_ids[low:high]
            ok = (scores >= kth[of][:, None]) & (here[None, :] != query_ids[of][:, None])
            for row in np.flatnonzero(ok.any(axis=1)):
                i = of[row]
                s = np.r_[best_score[i], scores[row, ok[row]].astype(np.int64)]
                c = np.r_[best_id[i], here[ok[row]]]
                keep = np.lexsort((c, -s))[:k]
                best_score[i], best_id[i] = s[keep], c[keep]
                if len(keep) == k:
                    kth[i] = max(kth[i], s[keep[-1]])
            continue
        for child in (left, right):
            limit = upper(child, of)
            need = limit >= kth[of]
            if need.any():
                heapq.heappush(heap, (-float(limit[need].max()), child, of[need], limit[need]))
    counts = [len(s) for s in best_score]
    return (np.repeat(query_ids, counts), np.concatenate(best_id) if counts else [],
            np.concatenate(best_score) if counts else [])


def _dealt(column: str, rows: int, most: int) -> Column:
    """A number below ceil(rows / most): shares of about ``most`` rows."""
    return F.pmod(F.xxhash64(column), F.lit(max(1, -(-rows // most)))).cast("int")


def _search_group(k: int):
    def step(key: tuple, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        width = max(points["v"].map(len).max(), queries["v"].map(len).max())
        bound = queries["bound"].astype("float64").fillna(-np.inf).to_numpy()
        found = search(
            queries["query_id"].to_numpy(), matrix(queries["v"], width),
            points["vec_id"].to_numpy(), matrix(points["v"], width), k, bound)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    return step


def exact_top_k(
    grid: DataFrame, queries: DataFrame, k: int = 20,
    shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every query.

    ``grid`` has (vec_id, v) with integer components, ``queries`` (query_id, v).
    Ties go to the smaller vec_id, and a query does not find its own row.
    Repeated ids are one row (the smallest vector); vectors of unequal length
    are compared over their common components. Empty tables give no rows.
    """
    grid = cut_lineage(grid.groupBy("vec_id").agg(F.min("v").alias("v")))
    queries = cut_lineage(queries.groupBy("query_id").agg(F.min("v").alias("v")))
    n, m = grid.count(), queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // block_queries))
    points = grid.withColumn("shard", _dealt("vec_id", n, shard_rows))
    asked = queries.withColumn("block", _dealt("query_id", m, block_queries))
    home = F.pmod(F.col("block"), F.lit(shards))

    def round_of(points: DataFrame, asked: DataFrame) -> DataFrame:
        return points.groupBy("shard", "block").cogroup(
            asked.groupBy("shard", "block")).applyInPandas(_search_group(k), _FOUND)

    dealt = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    unbound = asked.withColumn("shard", home).withColumn("bound", F.lit(None).cast("bigint"))
    first = cut_lineage(round_of(dealt.where(F.col("shard") == home), unbound))
    kth = first.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    rest = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(
        F.col("shard") != home).join(kth, "query_id", "left")
    found = first.unionByName(round_of(dealt.where(F.col("shard") != home), rest))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
