"""Declared connections at symmetry images, against brute force over a trigonal cell."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from sitegrade.functions.geometry import orthogonal_matrix
from sitegrade.operators import declared as dec
from sitegrade.operators.contacts import ATOM_COLUMNS

#: Rotations and translations: a threefold screw axis, and an NCS copy of each operation.
ROTATIONS = [((1, 0, 0), (0, 1, 0), (0, 0, 1)), ((0, -1, 0), (1, -1, 0), (0, 0, 1)), ((-1, 1, 0), (-1, 0, 0), (0, 0, 1))]
SHIFTS = [(0.0, 0.0, 0.0), (0.0, 0.0, 1 / 3), (0.0, 0.0, 2 / 3)]
NCS = ((-1, 0, 0), (0, -1, 0), (0, 0, 1)), (0.31, 0.12, 0.07)


def _operations():
    rows = [(i, False, np.array(r, float), np.array(t)) for i, (r, t) in enumerate(zip(ROTATIONS, SHIFTS))]
    turn, move = np.array(NCS[0], float), np.array(NCS[1])
    return rows + [(i + 3, True, r @ turn, r @ move + t) for i, _, r, t in rows]


def _frames(spark, entries):
    cells = spark.createDataFrame(
        [(e, 30.0, 30.0, 40.0, 90.0, 90.0, 120.0) for e in entries],
        "entry_id string, a double, b double, c double, alpha double, beta double, gamma double")
    cells = cells.withColumns(orthogonal_matrix(*(F.col(c) for c in ("a", "b", "c", "alpha", "beta", "gamma"))))
    rows = [(e, i, n, *r.ravel().tolist(), *t.tolist()) for e in entries for i, n, r, t in _operations()]
    names = ", ".join(f"r{i}{j} double" for i in (1, 2, 3) for j in (1, 2, 3))
    return cells, spark.createDataFrame(
        rows, f"entry_id string, image_index int, is_ncs boolean, {names}, t1 double, t2 double, t3 double")


MATRIX = np.array([[30.0, -15.0, 0.0], [0.0, 30.0 * math.sqrt(3) / 2, 0.0], [0.0, 0.0, 40.0]])


def _brute(m, n, elsewhere):
    inverse = np.linalg.inv(MATRIX)
    fm, fn = inverse @ m, inverse @ n
    found = []
    for index, _, r, t in _operations():
        g = r @ fn + t
        shift = np.round(fm - g)
        if elsewhere and index == 0 and not shift.any():
            continue
        found.append((round(float(np.linalg.norm(MATRIX @ (g + shift) - m)), 6), index, *shift.astype(int).tolist()))
    return min(found)


def _outcomes(spark, cases):
    """Resolved declarations: (entry, position, asu, metal xyz, neighbour xyz, own residue)."""
    atom = "struct<" + ",".join(
        f"{c}:" + ("double" if c in ("occupancy", "x", "y", "z", "b_iso") else "boolean" if c in ("occupancy_valid", "is_water")
                   else "int" if c.endswith("_index") else "string") for c in (*ATOM_COLUMNS, "polymer_position")) + ">"

    def made(place, element, residue, xyz, water):
        given = {"chain_index": 0, "residue_index": place, "atom_index": place, "chain_id": "A", "residue_name": residue,
                 "resnum": str(place), "insertion_code": "", "atom_name": element, "altloc": "", "element": element,
                 "occupancy": 1.0, "occupancy_valid": True, "x": xyz[0], "y": xyz[1], "z": xyz[2], "b_iso": 20.0,
                 "is_water": water, "polymer_position": "-"}
        return tuple(given[c] for c in (*ATOM_COLUMNS, "polymer_position"))

    rows = [
        (e, p, "LINK", f"c{p}", "metalc", "", asu, 2.1, made(1, "ZN", "ZN", m, False),
         made(1 if own else 2, "O", "HOH" if p % 2 else "XYZ", n, p % 2 == 1), "own_residue" if own else "candidate", False, True, p % 2 == 1)
        for e, p, asu, m, n, own in cases]
    return spark.createDataFrame(rows, (
        "entry_id string, position long, source string, connection_id string, connection_type string, link_id string, asu string,"
        f" reported_distance double, metal {atom}, neighbor {atom}, outcome string, substituted boolean, involves_metal boolean,"
        " donor_class_supported boolean"))


def test_placed_declarations_equal_brute_force(spark):
    rng = random.Random(7)

    def point():
        return tuple(rng.uniform(-20, 50) for _ in range(3))

    cases, position = [], 0
    for entry in ("e1", "e2", "bare"):
        for asu in ("same", "any", "different", " Different ", "", None):
            for own in (False, True):
                for _ in range(4):
                    position += 1
                    m, n = point(), point()
                    if rng.random() < 0.4:
                        n = tuple(x + rng.uniform(-1.5, 1.5) for x in m)
                    cases.append((entry, position, asu, m, n, own))
    cells, operations = _frames(spark, ["e1", "e2"])
    placed = dec.place_declared(_outcomes(spark, cases), cells, operations)
    got = {r.position: r for r in placed.collect()}
    assert len(got) == len(cases)
    kinds = set()
    for entry, p, asu, m, n, own in cases:
        r, m, n = got[p], np.array(m), np.array(n)
        stated = (asu or "").strip().lower()
        best = (round(float(np.linalg.norm(n - m)), 6), 0, 0, 0, 0)
        if entry != "bare" and stated != "same":
            best = _brute(m, n, stated == "different")
        made = best[1:] != (0, 0, 0, 0)
        want = ("unplaced" if stated == "different" and not made else "own_residue" if own and not made else "placed")
        assert r.placement == want
        kinds.add((want, r.contact_scope if want == "placed" else None))
        if want == "placed":
            assert (r.image_index, r.tx, r.ty, r.tz) == best[1:] and abs(r.distance - best[0]) < 1e-5
            assert r.symmetry_contact == made and r.strict_ncs_contact == (best[1] >= 3)
            assert ("declared_donor_outside_supported_classes" in r.warnings) == (p % 2 == 0)
        else:
            assert not r.warnings
            assert (r.issue is not None) == (want == "unplaced")
            if want == "unplaced":
                assert r.issue == f"LINK c{p} geometry unresolved: symmetry metadata unavailable"
    assert {"unplaced", "own_residue", "placed"} == {k for k, _ in kinds}
    assert {"explicit", "crystallographic"} <= {s for _, s in kinds} and any("ncs" in (s or "") for _, s in kinds)
    none = dec.place_declared(_outcomes(spark, cases))
    assert none.where("symmetry_contact").count() == 0
