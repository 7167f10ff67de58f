"""Distance joins on a grid: pairs within a radius, nearest neighbours, images.

Space is cut into cells two radii wide, so the ball around a point touches two
cells along every axis and the join becomes an equi-join on the cell. The
smaller side visits these eight cells; the larger side is never copied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade.functions.geometry import squared_distance
from sitegrade.session import cut_lineage

CELL = ("cell_x", "cell_y", "cell_z")
#: A cell with more rows than this is joined in several slices.
HOT_CELL_ROWS = 100_000


def _cells(xyz: Sequence[str], size: float) -> list[Column]:
    return [
        F.floor(F.col(axis) / F.lit(size)).cast("long").alias(cell)
        for axis, cell in zip(xyz, CELL, strict=True)
    ]


def _visited(df: DataFrame, xyz: Sequence[str], size: float) -> DataFrame:
    """Each row once per cell that the ball of half a cell around it touches."""
    reach = F.lit(size / 2 * (1 + 1e-9))
    spread = df
    for axis, cell in zip(xyz, CELL, strict=True):
        first, last = (
            F.floor(edge / F.lit(size)).cast("long") for edge in (F.col(axis) - reach, F.col(axis) + reach))
        spread = spread.withColumn(cell, F.explode(F.sequence(first, last)))
    return spread


def radius_join(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    keys: Sequence[str],
    left_xyz: Sequence[str],
    right_xyz: Sequence[str],
    *,
    hot_cell_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """All pairs of equal ``keys`` no farther apart than ``radius``.

    ``left`` is the smaller side; apart from ``keys`` the sides share no column
    names. Adds ``distance``. Cells holding more than ``hot_cell_rows`` rows of
    ``right`` are cut into slices, each met by a copy of the cell's ``left``
    rows, so one crowded cell spreads over many tasks.
    """
    placed = right.select("*", *_cells(right_xyz, 2 * radius))
    visitors = _visited(left, left_xyz, 2 * radius)
    on = [*keys, *CELL]
    gap = squared_distance(
        tuple(F.col(c) for c in left_xyz), tuple(F.col(c) for c in right_xyz)
    )

    def near(pairs: DataFrame) -> DataFrame:
        found = pairs.withColumn("distance", F.sqrt(gap))
        return found.where(F.col("distance") <= F.lit(radius)).drop(*CELL, "slice")

    counts = placed.groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    largest = counts.agg(F.max("rows")).first()[0] or 0
    if largest <= hot_cell_rows:
        return near(visitors.join(placed, on))
    hot = cut_lineage(
        counts.where(F.col("rows") > hot_cell_rows).select(
            *on, F.ceil(F.col("rows") / hot_cell_rows).cast("int").alias("slices")
        )
    )
    ordinary = visitors.join(hot, on, "left_anti").join(
        placed.join(hot, on, "left_anti"), on
    )
    row_hash = F.xxhash64(*[F.col(c) for c in right.columns])
    sliced_right = placed.join(hot, on).withColumn(
        "slice", F.pmod(row_hash, F.col("slices")).cast("int")
    ).drop("slices")
    sliced_left = visitors.join(hot, on).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    ).drop("slices")
    crowded = sliced_left.join(sliced_right, [*on, "slice"])
    columns = [c for c in crowded.columns if c != "slice"]
    return near(ordinary.select(*columns).unionByName(crowded.select(*columns)))


def nearest_neighbors(
    points: DataFrame,
    keys: Sequence[str],
    id_columns: Sequence[str],
    xyz: Sequence[str],
    radius: float,
) -> DataFrame:
    """Each point's nearest other point of the same ``keys``, and its near count.

    Returns the id columns, ``nearest_distance`` (null for a lone point), the
    neighbour's ids as ``nearest_<id>``, and ``near_count`` within ``radius``.
    Equidistant neighbours resolve to the lowest id.

    The search widens in rounds: a point that met nobody within the radius
    tries twice the radius next. Points still searching at radius ``r`` lie
    more than ``r`` apart from everyone, so only a fixed number of them fits
    around any cell and each round stays linear in the data.
    """
    ids = list(id_columns)
    seeker = points.select(*keys, *ids, *xyz)
    target = points.select(
        *keys,
        *[F.col(c).alias(f"nearest_{c}") for c in ids],
        *[F.col(c).alias(f"to_{c}") for c in xyz],
    )
    same = F.lit(True)
    for c in ids:
        same = same & F.col(c).eqNullSafe(F.col(f"nearest_{c}"))
    spans = points.agg(*[(F.max(c) - F.min(c)).alias(c) for c in xyz]).first()
    reach = sum((span or 0.0) ** 2 for span in spans) ** 0.5
    remaining, found, first_counts = seeker, None, None
    while True:
        pairs = radius_join(
            remaining, target, radius, keys, xyz, [f"to_{c}" for c in xyz]
        ).where(~same)
        best = cut_lineage(
            pairs.groupBy(*keys, *ids).agg(
                F.min(F.struct("distance", *[f"nearest_{c}" for c in ids])).alias("best"),
                F.count(F.lit(1)).alias("near_count"),
            )
        )
        if found is None:
            first_counts = best.select(*keys, *ids, "near_count")
        part = best.select(
            *keys, *ids, F.col("best.distance").alias("nearest_distance"),
            *[F.col(f"best.nearest_{c}").alias(f"nearest_{c}") for c in ids],
        )
        found = part if found is None else found.unionByName(part)
        if radius > reach:
            break
        remaining = cut_lineage(remaining.join(best, [*keys, *ids], "left_anti"))
        if remaining.isEmpty():
            break
        radius = radius * 2
    result = points.join(found, [*keys, *ids], "left").join(
        first_counts, [*keys, *ids], "left"
    )
    return result.withColumn("near_count", F.coalesce(F.col("near_count"), F.lit(0)))


# ---- symmetry images -----------------------------------------------------------
#: The 27 whole-cell shifts around the rounded one.
_SHIFTS = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
#: Inverse of a 3x3 operation by cofactors; crystal operations have determinant ±1.
_DETERMINANT = (
    "(r11 * (r22 * r33 - r23 * r32) - r12 * (r21 * r33 - r23 * r31)"
    " + r13 * (r21 * r32 - r22 * r31))"
)
_COFACTORS = (
    ("r22 * r33 - r23 * r32", "r13 * r32 - r12 * r33", "r12 * r23 - r13 * r22"),
    ("r23 * r31 - r21 * r33", "r11 * r33 - r13 * r31", "r13 * r21 - r11 * r23"),
    ("r21 * r32 - r22 * r31", "r12 * r31 - r11 * r32", "r11 * r22 - r12 * r21"),
)


def grid_counts(cells: DataFrame, radius: float) -> DataFrame:
    """Add ``n1, n2, n3``, bins per axis, ``h1, h2, h3``, the radius as a share of the
    cell, and ``wide``: two radii fit along every axis.

    ``cells`` carries the orthogonalization columns ``m11``..``m33``. Bins are at
    least two radii wide. An axis with room for two bins only is not cut, since
    nearly every ball touches both.
    """
    widths = (
        "(1 / sqrt(1 / (m11 * m11) + pow(m12 / (m11 * m22), 2)"
        " + pow((m12 * m23 - m13 * m22) / (m11 * m22 * m33), 2)))",
        "(1 / sqrt(1 / (m22 * m22) + pow(m23 / (m22 * m33), 2)))",
        "m33",
    )
    return cells.selectExpr(
        "*",
        *[
            f"CASE WHEN {w} >= {6 * radius} THEN CAST(floor({w} / {2 * radius}) AS INT) ELSE 1 END AS n{i}"
            for i, w in enumerate(widths, start=1)
        ],
        *[f"{radius * (1 + 1e-9)!r}D / {w} AS h{i}" for i, w in enumerate(widths, start=1)],
        " AND ".join(f"{w} >= {2 * radius}" for w in widths) + " AS wide",
    )


def _binned(df: DataFrame, point: Sequence[str], around: bool) -> DataFrame:
    """Bin of a fractional point inside the wrapped cell, or those its ball touches."""
    out = df
    for axis, name in enumerate(point, start=1):
        place, n = f"(({name} - floor({name})) * n{axis})", f"n{axis}"
        if around:
            reach = 0.5 * (1 + 1e-9)
            near = (
                f"explode(CASE WHEN {n} = 1 THEN array(0) ELSE transform("
                f"sequence(CAST(floor({place} - {reach!r}D) AS INT), CAST(floor({place} + {reach!r}D) AS INT)),"
                f" o -> pmod(o, {n})) END)"
            )
            out = out.selectExpr("*", f"{near} AS bin{axis}")
        else:
            out = out.selectExpr("*", f"least({n} - 1, CAST(floor({place}) AS INT)) AS bin{axis}")
    return out


def image_radius_join(
    left: DataFrame,
    right: DataFrame,
    cells: DataFrame,
    operations: DataFrame,
    radius: float,
    key: str = "entry_id",
) -> DataFrame:
    """Pairs within ``radius`` over all symmetry images of ``right``.

    ``left`` and ``right`` carry fractional coordinates ``lu, lv, lw`` and
    ``ru, rv, rw``; ``cells`` one row per ``key`` with ``m..``; ``operations``
    the rows of ``key`` with ``image_index``, ``is_ncs``, ``r..`` and ``t..``.
    For every (left, right, operation) the nearest lattice translation is kept.
    Adds ``image_index, tx, ty, tz, distance``, the image's fractional position
    ``iu, iv, iw`` and the columns of ``cells``.

    A crystal operation maps the lattice onto itself, so it is undone on the
    few ``left`` rows and the many ``right`` rows stay as they are. A strict
    NCS transform does not, so those images are generated on the right.
    """
    gridded = grid_counts(cells, radius)
    bins = [key, "bin1", "bin2", "bin3"]
    ops = operations.select(
        key, "image_index", "is_ncs", *[f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)],
        "t1", "t2", "t3",
    )
    left_cell = left.join(gridded, key)
    right_cell = right.join(gridded.select(key, "n1", "n2", "n3"), key)
    undone = left_cell.join(ops.where(~F.col("is_ncs")), key).selectExpr(
        "*",
        *[
            "(" + " + ".join(
                f"({term}) * ({base} - t{j})"
                for j, (term, base) in enumerate(zip(_COFACTORS[i], ("lu", "lv", "lw")), start=1)
            ) + f") / {_DETERMINANT} AS p{i + 1}"
            for i in range(3)
        ],
    )
    # the box around the ball leaves few pairs for the distance, and is cheap to test
    boxed = " AND ".join(f"abs(q{i} - p{i} - floor(q{i} - p{i} + 0.5D)) <= h{i}" for i in (1, 2, 3))
    at, to = ("p1", "p2", "p3"), ("q1", "q2", "q3")
    placed_right = right_cell.selectExpr("*", "ru AS q1", "rv AS q2", "rw AS q3")
    crystal = _binned(undone, at, True).join(
        _binned(placed_right, to, False).drop("n1", "n2", "n3"), bins
    ).where(boxed).drop(*at, *to)
    generated = right_cell.join(ops.where("is_ncs"), key).selectExpr(
        "*",
        *[f"r{i}1 * ru + r{i}2 * rv + r{i}3 * rw + t{i} AS q{i}" for i in (1, 2, 3)],
    )
    seen = left_cell.selectExpr("*", "lu AS p1", "lv AS p2", "lw AS p3")
    copied = _binned(seen, at, True).join(
        _binned(generated, to, False).drop("n1", "n2", "n3"), bins
    ).where(boxed).drop(*at, *to)
    columns = crystal.columns
    pairs = crystal.unionByName(copied.select(*columns))
    placed = pairs.selectExpr(
        "*", *[f"r{i}1 * ru + r{i}2 * rv + r{i}3 * rw + t{i} AS g{i}" for i in (1, 2, 3)]
    ).selectExpr(
        "*",
        *[f"CAST(floor({b} - g{i} + 0.5D) AS INT) AS s{i}" for i, b in ((1, "lu"), (2, "lv"), (3, "lw"))],
    )
    # In a cell two radii wide along every axis only the rounded shift can come
    # within reach; narrower cells try all 27 shifts around it.
    # As a generated row the distance stays out of the join's condition, which would
    # compute it for every pair.
    rounded = placed.where("wide").selectExpr(
        "*", f"inline(array(struct({_shifted_square('0', '0', '0')} AS near_d2, s1 AS tx, s2 AS ty, s3 AS tz)))"
    )
    shifts = ", ".join(f"struct({i} AS i, {j} AS j, {k} AS k)" for i, j, k in _SHIFTS)
    searched = placed.where("NOT wide").selectExpr(
        "*",
        f"array_min(transform(array({shifts}), o -> struct("
        f"{_shifted_square('o.i', 'o.j', 'o.k')} AS d2,"
        " s1 + o.i AS x, s2 + o.j AS y, s3 + o.k AS z))) AS near",
    ).selectExpr("*", "near.d2 AS near_d2", "near.x AS tx", "near.y AS ty", "near.z AS tz")
    nearest = rounded.unionByName(searched.drop("near"))
    dropped = {
        *bins[1:], "is_ncs", "n1", "n2", "n3", "h1", "h2", "h3", "wide", "t1", "t2", "t3",
        *[f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)],
    }
    return nearest.where(F.col("near_d2") <= radius * radius).selectExpr(
        *[c for c in columns if c not in dropped],
        "tx", "ty", "tz",
        "sqrt(near_d2) AS distance",
        "g1 + tx AS iu", "g2 + ty AS iv", "g3 + tz AS iw",
    )


def _shifted_square(i: str, j: str, k: str) -> str:
    """Squared distance after the rounded shift plus a whole-cell offset."""
    du, dv, dw = (f"(g1 + s1 + {i} - lu)", f"(g2 + s2 + {j} - lv)", f"(g3 + s3 + {k} - lw)")
    return (
        f"pow(m11 * {du} + m12 * {dv} + m13 * {dw}, 2)"
        f" + pow(m22 * {dv} + m23 * {dw}, 2) + pow(m33 * {dw}, 2)"
    )


def coincident_images(
    points: DataFrame, cells: DataFrame, operations: DataFrame, cutoff: float,
    key: str = "entry_id",
) -> DataFrame:
    """Add ``coincident``: non-identity crystal images of a point within ``cutoff`` of it.

    ``points`` carries fractional coordinates ``lu, lv, lw`` and is the small
    side; each meets the operations of its own entry only.
    """
    ops = operations.where(~F.col("is_ncs") & (F.col("image_index") > 0))
    names = [c for c in points.columns]
    met = points.join(cells, key).join(ops, key, "left").selectExpr(
        "*",
        *[
            f"r{i}1 * lu + r{i}2 * lv + r{i}3 * lw + t{i} - {b} AS g{i}"
            for i, b in ((1, "lu"), (2, "lv"), (3, "lw"))
        ],
    ).selectExpr("*", *[f"g{i} - round(g{i}) AS d{i}" for i in (1, 2, 3)])
    squared = (
        "pow(m11 * d1 + m12 * d2 + m13 * d3, 2) + pow(m22 * d2 + m23 * d3, 2) + pow(m33 * d3, 2)"
    )
    return met.groupBy(*names).agg(
        F.count_if(F.expr(f"{squared} <= {cutoff * cutoff}")).alias("coincident"),
        (F.count("image_index") + 1).alias("operation_count"),
    )
