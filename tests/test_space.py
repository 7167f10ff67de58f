"""Radius joins, nearest neighbours, images and collapse against brute force."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from sitegrade.functions.geometry import orthogonal_matrix
from sitegrade.operators import contacts as con
from sitegrade.operators.radius import image_radius_join, nearest_neighbors, radius_join


def _points(rng, n, size):
    return [(rng.choice("ab"), i, *[rng.uniform(0, size) for _ in range(3)]) for i in range(n)]


def test_radius_join_matches_brute_force_with_and_without_slices(spark):
    rng = random.Random(1)
    left, right = _points(rng, 40, 6), _points(rng, 300, 6)
    ldf = spark.createDataFrame(left, "k string, l long, lx double, ly double, lz double")
    rdf = spark.createDataFrame(right, "k string, r long, rx double, ry double, rz double")
    want = {(a[1], b[1]) for a in left for b in right if a[0] == b[0] and math.dist(a[2:], b[2:]) <= 2.0}
    for hot in (100_000, 4):
        found = radius_join(ldf, rdf, 2.0, ["k"], ["lx", "ly", "lz"], ["rx", "ry", "rz"], hot_cell_rows=hot)
        pairs = [(r.l, r.r) for r in found.collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_nearest_neighbors_reach_past_the_first_radius(spark):
    rng = random.Random(2)
    rows = _points(rng, 60, 50) + [("a", 900, 400.0, 0.0, 0.0), ("c", 901, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, i long, x double, y double, z double")
    got = {r.i: r for r in nearest_neighbors(df, ["k"], ["i"], ["x", "y", "z"], 2.0).collect()}
    for k, i, *p in rows:
        others = [(math.dist(p, q), j) for k2, j, *q in rows if k2 == k and j != i]
        if not others:
            assert got[i].nearest_distance is None and got[i].near_count == 0
            continue
        distance, j = min(others)
        assert math.isclose(got[i].nearest_distance, distance) and got[i].nearest_i == j
        assert got[i].near_count == sum(d <= 2.0 for d, _ in others)


def test_image_join_matches_all_shifts_in_narrow_and_wide_cells(spark):
    rng = random.Random(4)
    ops = [(0, (1, 1, 1), (0, 0, 0)), (1, (-1, 1, -1), (0, 0.5, 0))]
    cells = {"w": (20.0, 19.0, 18.0, 90.0, 105.0, 90.0), "n": (6.0, 7.0, 5.0, 90.0, 100.0, 90.0)}
    matrices = {}
    for name, (a, b, c, *angles) in cells.items():
        ca, cb, cg = (math.cos(math.radians(x)) for x in angles)
        sg = math.sin(math.radians(angles[2]))
        v = math.sqrt(1 - ca**2 - cb**2 - cg**2 + 2 * ca * cb * cg)
        matrices[name] = (a, b * cg, c * cb, b * sg, c * (ca - cb * cg) / sg, c * v / sg)
    left = [(n, i, *[rng.uniform(-0.5, 1.5) for _ in range(3)]) for n in cells for i in range(6)]
    right = [(n, i, *[rng.uniform(-0.5, 1.5) for _ in range(3)]) for n in cells for i in range(40)]
    raw = spark.createDataFrame([(n, *c) for n, c in cells.items()], "entry_id string, a double, b double, c double, alpha double, beta double, gamma double")
    frame = raw.withColumns(orthogonal_matrix(*[F.col(c) for c in ("a", "b", "c", "alpha", "beta", "gamma")])).select("entry_id", "m11", "m12", "m13", "m22", "m23", "m33")
    rows = [
        (n, i, False, float(r[0]), 0.0, 0.0, 0.0, float(r[1]), 0.0, 0.0, 0.0, float(r[2]), *map(float, t))
        for n in cells for i, r, t in ops
    ]
    odf = spark.createDataFrame(rows, "entry_id string, image_index int, is_ncs boolean, r11 double, r12 double, r13 double, r21 double, r22 double, r23 double, r31 double, r32 double, r33 double, t1 double, t2 double, t3 double")
    ldf = spark.createDataFrame(left, "entry_id string, l int, lu double, lv double, lw double")
    rdf = spark.createDataFrame(right, "entry_id string, r int, ru double, rv double, rw double")
    got = {
        (x.entry_id, x.l, x.r, x.image_index): x.distance
        for x in image_radius_join(ldf, rdf, frame, odf, 4.0).collect()
    }
    want = {}
    span = range(-4, 5)
    for n, i, *p in left:
        m11, m12, m13, m22, m23, m33 = matrices[n]
        for n2, j, *q in right:
            if n2 != n:
                continue
            for k, r, t in ops:
                base = [r[x] * q[x] + t[x] - p[x] for x in range(3)]
                d = min(
                    math.sqrt((m11 * (base[0] + a) + m12 * (base[1] + b) + m13 * (base[2] + c)) ** 2 + (m22 * (base[1] + b) + m23 * (base[2] + c)) ** 2 + (m33 * (base[2] + c)) ** 2)
                    for a in span for b in span for c in span
                )
                if d <= 4.0:
                    want[n, i, j, k] = d
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)


def test_collapse_keeps_the_preferred_image_and_its_provenance(spark):
    rows = [
        ("s", 1, 2.0, 0.0, ["proximity_4A"]), ("s", 2, 1.0, 0.5, ["LINK"]), ("s", 3, 0.5, 9.0, ["LINK"]),
    ]
    df = spark.createDataFrame(rows, "g string, rank int, d double, x double, sources array<string>")
    df = df.withColumns({"y": F.lit(0.0), "z": F.lit(0.0)})
    got = con.collapse_images(df, ("g",), ("rank", "d", "x", "y", "z"), ("x", "y", "z"), 0.8, ("sources",))
    assert {(r["rank"], tuple(r.sources)) for r in got.collect()} == {(1, ("proximity_4A", "LINK")), (3, ("LINK",))}


def test_group_status(spark):
    df = spark.createDataFrame(
        [(1, False, True), (2, False, True), (2, True, False), (2, False, False)], "n int, far boolean, near boolean"
    )
    got = [r[0] for r in df.select(con.group_status(F.col("n"), F.col("far"), F.col("near"))).collect()]
    assert got == ["single_donor", "consistent", "suspect", "indeterminate"]
