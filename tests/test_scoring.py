"""Levels, matrix, rounding, ranks and score inputs against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sitegrade.functions import scoring as fs
from sitegrade.functions.rounding import decimal_text, with_rounded
from sitegrade.operators import distribution as dist
from sitegrade.operators.prefix import exact_median, ordinal_within, running_before, running_best

DENSITY = (0.5, 2.0, 2.5, 3.0, 4.0, 5.0, 6.5, 8.0)
GEOMETRY = (0.25, 0.75, 1.0, 1.5, 2.5)


def _inputs(spark, rows):
    return spark.createDataFrame(
        [(f"e{i % 3}", f"s{i}", d, g) for i, (d, g) in enumerate(rows)],
        "entry_id string, metal_site_id string, rszd_abs double, geometry_rms_zbond double",
    )


def test_exact_rounding_matches_decimal_expansion(spark):
    rng = random.Random(7)
    values = [1.2345, 2.9995, 0.0005, 0.0015, 2.5, -1.0005, 99.9, 0.125, 1e-9, 123456.7895]
    values += [rng.uniform(-50, 50) for _ in range(3000)]
    values += [k / 2000 for k in range(-300, 300)] + [k / 16 for k in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = with_rounded(df, {"a": ("x", 3), "b": ("x", 6), "c": ("x", 4), "d": ("x", 12)}).collect()
    for row in got:
        assert row["a"] == float(f"{row['x']:.3f}")
        assert row["b"] == float(f"{row['x']:.6f}")
        assert row["c"] == round(row["x"], 4)
        assert row["d"] == float(f"{row['x']:.12f}")


def test_decimal_text(spark):
    df = spark.createDataFrame([(1.5,), (100.0,), (0.1234567,), (None,), (float("nan"),)], "x double")
    assert [r[0] for r in df.select(decimal_text("x")).collect()] == ["1.5", "100", "0.123457", "", ""]


@pytest.mark.parametrize(
    "value, level",
    [(2.9999999, "PASS"), (3.0, "REVIEW"), (5.9999, "REVIEW"), (6.0, "SUSPECT"), (-0.1, "INCOMPLETE"), (None, "INCOMPLETE"), (float("nan"), "INCOMPLETE"), (float("inf"), "INCOMPLETE")],
)
def test_density_levels_use_raw_thresholds(spark, value, level):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(fs.density_level("x")).first()[0] == level


def test_ranks_equal_brute_force_for_seen_and_unseen_values(spark):
    cohort = [(d, g) for d in DENSITY for g in GEOMETRY] + [(None, 1.0), (2.0, None), (None, None)]
    asked = [(d, g) for d in (0.1, 2.0, 2.2, 7.7, 9.0, 99.9) for g in (0.25, 1.2, 3.0)]
    frozen = dist.value_histogram(_inputs(spark, cohort))
    got = {
        r["metal_site_id"]: r
        for r in dist.rank_against(_inputs(spark, asked), frozen).collect()
    }

    def rank(population, value):
        below = sum(v < value for v in population)
        equal = sum(v == value for v in population)
        return 100 * (len(population) - below - 0.5 * equal) / len(population)

    ds = [d for d, _ in cohort if d is not None]
    gs = [g for _, g in cohort if g is not None]
    for i, (d, g) in enumerate(asked):
        assert math.isclose(got[f"s{i}"]["density_rank"], rank(ds, d))
        assert math.isclose(got[f"s{i}"]["geometry_rank"], rank(gs, g))


def test_running_totals_match_one_window(spark):
    rng = random.Random(3)
    rows = [(k, p, rng.randint(0, 9)) for k in "ab" for p in rng.sample(range(-500, 5000), 400)]
    df = spark.createDataFrame(rows, "k string, p long, n long")
    got = {(r.k, r.p): r.s for r in running_before(df, ["k"], "p", "n", "s", (10, 10, 10)).collect()}
    for k, p, _ in rows:
        assert got[k, p] == sum(n for k2, p2, n in rows if k2 == k and p2 < p)
    places = {(r.k, r.p): r.o for r in ordinal_within(df, ["k"], "p", "o", (7, 5)).collect()}
    for k, p, _ in rows:
        assert places[k, p] == 1 + sum(k2 == k and p2 < p for k2, p2, _ in rows)
    best = {(r.k, r.p): r.b for r in running_best(df, ["k"], "p", "n", "b", 13).collect()}
    for k, p, _ in rows:
        earlier = [n for k2, p2, n in rows if k2 == k and p2 < p]
        assert best[k, p] == (min(earlier) if earlier else None)


def test_exact_median_matches_sorting(spark):
    rng = random.Random(5)
    rows = [(k, round(rng.uniform(0, 30), 2)) for k in range(5) for _ in range(rng.randint(1, 90))]
    df = spark.createDataFrame(rows + [(0, None)], "k long, v double")
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m").collect()}
    for k in range(5):
        vs = sorted(v for k2, v in rows if k2 == k)
        mid = (vs[(len(vs) - 1) // 2] + vs[len(vs) // 2]) / 2
        assert math.isclose(got[k], mid)


def test_fingerprint_sees_every_change(spark):
    base = [("density", 0.001 * i, i + 1) for i in range(3000)] + [("geometry", 1.5, 2)]
    df = spark.createDataFrame(base, dist_schema := "component string, value double, count long")
    same = spark.createDataFrame(base[::-1], dist_schema)
    other = spark.createDataFrame([*base[:-1], ("geometry", 1.5, 3)], dist_schema)
    one = dist.fingerprint(df, "p").first()[0]
    assert one == dist.fingerprint(same, "p").first()[0]
    assert one != dist.fingerprint(other, "p").first()[0]
    assert one != dist.fingerprint(df, "q").first()[0]


def test_matrix_is_total(spark):
    levels = ("INCOMPLETE", "PASS", "REVIEW", "SUSPECT")
    df = spark.createDataFrame([(d, g) for d in levels for g in levels], "d string, g string")
    rows = {(r.d, r.g): r for r in df.select("d", "g", fs.site_level("d", "g").alias("s"), fs.verdict_reason("d", "g").alias("v")).collect()}
    assert rows["REVIEW", "REVIEW"].s == "SUSPECT" and rows["REVIEW", "REVIEW"].v == "review_plus_review"
    assert rows["PASS", "INCOMPLETE"].s == "PASS"
    assert rows["INCOMPLETE", "INCOMPLETE"].v == "no_assessable_evidence"
    assert all(r.s == "SUSPECT" for (d, g), r in rows.items() if "SUSPECT" in (d, g))


def test_saturated_density_scores_zero(spark):
    df = spark.createDataFrame([(99.9, 40.0), (99.8, 40.0)], "x double, r double")
    assert [r[0] for r in df.select(fs.density_score("x", "r")).collect()] == [0.0, 40.0]


def test_least_ignores_missing(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(fs.overall_score(F.col("a"), F.col("b"))).collect()] == [1.0, None, 2.0]
