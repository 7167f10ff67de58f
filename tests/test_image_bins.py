"""Bins of the image search: few copies of a point, and no pair lost at their borders."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sitegrade.functions.geometry import orthogonal_matrix
from sitegrade.operators.radius import _binned, grid_counts, image_radius_join

_IDENTITY = ("image_index int, is_ncs boolean, r11 double, r12 double, r13 double, r21 double, r22 double,"
             " r23 double, r31 double, r32 double, r33 double, t1 double, t2 double, t3 double")
_MATRIX = ("m11", "m12", "m13", "m22", "m23", "m33")


def _cells(spark, *rows):
    sides = ("a", "b", "c", "alpha", "beta", "gamma")
    raw = spark.createDataFrame(list(rows), "entry_id string, " + ", ".join(f"{c} double" for c in sides))
    return raw.withColumns(orthogonal_matrix(*[F.col(c) for c in sides])).select("entry_id", *_MATRIX)


def test_a_point_visits_at_most_eight_bins_and_one_in_a_small_cell(spark):
    cells = _cells(spark, ("large", 60.0, 40.0, 26.0, 90.0, 100.0, 90.0), ("small", 20.0, 19.0, 18.0, 90.0, 90.0, 90.0))
    points = spark.createDataFrame(
        [(e, i, i * 0.137, i * 0.311, i * 0.071) for e in ("large", "small") for i in range(-20, 60)],
        "entry_id string, i int, u double, v double, w double")
    visited = _binned(points.join(grid_counts(cells, 4.0), "entry_id"), ("u", "v", "w"), True)
    most = {r.entry_id: r.n for r in visited.groupBy("entry_id", "i").count().groupBy("entry_id").agg(
        F.max("count").alias("n")).collect()}
    assert most == {"large": 8, "small": 1}
    again = visited.groupBy("entry_id", "i", "bin1", "bin2", "bin3").count().where("count > 1")
    assert again.isEmpty()


def test_pairs_across_borders_of_bins_and_cells(spark):
    cells = _cells(spark, ("c", 60.0, 40.0, 26.0, 90.0, 100.0, 90.0))
    ops = spark.createDataFrame([
        ("c", 0, False, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0),
        ("c", 1, False, -1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.5, 0.0),
        ("c", 2, True, -1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0, 1.0, 0.37, 0.21, 0.13),
    ], "entry_id string, " + _IDENTITY)
    left = [(i, *((i * k) % 101 / 100 for k in (7, 13, 29))) for i in range(40)]
    right = [(i, *((i * k) % 97 / 97 * 1.5 - 0.2 for k in (5, 11, 31))) for i in range(120)]
    ldf = spark.createDataFrame([("c", *r) for r in left], "entry_id string, l int, lu double, lv double, lw double")
    rdf = spark.createDataFrame([("c", *r) for r in right], "entry_id string, r int, ru double, rv double, rw double")
    found = [((x.l, x.r, x.image_index), x.distance)
             for x in image_radius_join(ldf, rdf, cells, ops, 4.0).collect()]
    m11, m12, m13, m22, m23, m33 = cells.first()[1:]
    want = {}
    for i, *p in left:
        for j, *q in right:
            for k, r, t in ((0, (1, 1, 1), (0, 0, 0)), (1, (-1, 1, -1), (0, 0.5, 0)), (2, (-1, -1, 1), (0.37, 0.21, 0.13))):
                u, v, w = (r[x] * q[x] + t[x] - p[x] for x in range(3))
                near = min(
                    math.hypot(m11 * (u + a) + m12 * (v + b) + m13 * (w + c), m22 * (v + b) + m23 * (w + c), m33 * (w + c))
                    for a in range(-3, 4) for b in range(-3, 4) for c in range(-3, 4))
                if near <= 4.0:
                    want[i, j, k] = near
    assert len(found) == len(want) > 20 and dict(found).keys() == want.keys()
    assert all(math.isclose(d, want[key], abs_tol=1e-9) for key, d in found)
