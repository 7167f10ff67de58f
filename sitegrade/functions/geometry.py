"""Distances, bond z-scores, and the arithmetic of sites and donors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import as_col, finite, first_label


def squared_distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Squared distance of two points given as coordinate columns."""
    total = F.lit(0.0)
    for left, right in zip(a, b, strict=True):
        total = total + (left - right) * (left - right)
    return total


def distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Distance of two points given as coordinate columns."""
    return F.sqrt(squared_distance(a, b))


def bond_zscore(
    observed: str | Column, mu: str | Column, sigma: str | Column, precision: str | Column
) -> Column:
    """``(d - mu) / sqrt(precision² + sigma²)``; null unless every term is finite."""
    d, m, s, p = (finite(c) for c in (observed, mu, sigma, precision))
    spread = F.sqrt(p * p + s * s)
    return F.when(spread > 0, (d - m) / spread)


def is_outlier(zscore: str | Column) -> Column:
    """Whether a raw z-score is at or past the cutoff; null when unassessed."""
    return F.abs(as_col(zscore)) >= vocab.OUTLIER_CUTOFF


def metal_donor_comparison(metal_b: str, donor_b: str) -> dict[str, tuple[Column, int]]:
    """Ratio, difference and similarity of a metal B factor and its donors' median.

    Each value comes with its published decimals, for ``with_rounded``.
    """
    m, d = F.col(metal_b), F.col(donor_b)
    ratio = F.when((m > 0) & (d > 0), m / d)
    return {
        "donor_median_b_iso": (d, 3),
        "metal_donor_b_ratio": (ratio, 4),
        "metal_minus_donor_b_iso": (m - d, 3),
        "metal_donor_b_similarity": (F.exp(-F.abs(F.ln(ratio))), 4),
    }


def precision_index(
    atoms: str | Column, volume: str | Column, reflections: str | Column, r_free: str | Column
) -> Column:
    """``1.28 · Ni^½ · Va^⅓ · nobs^(−5/6) · Rfree``; published at four decimals."""
    n, v, o, r = (as_col(c) for c in (atoms, volume, reflections, r_free))
    return 1.28 * F.pow(n, F.lit(0.5)) * F.pow(v, F.lit(1 / 3)) * F.pow(o, F.lit(-5 / 6)) * r


def precision_reason(
    has_source: Column,
    metadata_numeric: Column,
    occupancy_failed: Column,
    reflections: Column,
    r_free: Column,
    volume: Column,
    atoms: Column,
) -> Column:
    """The first term that rules the precision index out, or blank."""

    def unusable(term: Column) -> Column:
        return finite(term).isNull() | (finite(term) <= 0)

    return first_label(
        [
            (~F.coalesce(has_source, F.lit(False)), "missing_dpi_metadata_source"),
            (~F.coalesce(metadata_numeric, F.lit(True)), "invalid_dpi_metadata"),
            (F.coalesce(occupancy_failed, F.lit(False)), "invalid_occupancy"),
            (unusable(reflections), "missing_or_invalid_reflection_count"),
            (unusable(r_free), "missing_or_invalid_rfree"),
            (unusable(volume), "missing_or_invalid_asu_volume"),
            (unusable(atoms), "invalid_dpi_atom_count"),
        ],
        "",
    )


def site_symmetry(
    coincident: str | Column, operations: str | Column, occupancy: str | Column, valid: str | Column
) -> dict[str, Column]:
    """Site-symmetry order, expected occupancy and whether the occupancy agrees.

    An order that does not divide the number of operations comes from a metal
    slightly off its axis: the special position stands, the order does not.
    """
    order = as_col(coincident).cast("long") + 1
    count = as_col(operations).cast("long")
    broken = (count > 0) & (F.pmod(count, order) != 0)
    expected = F.lit(1.0) / order
    return {
        "metal_special_position": (order > 1) | broken,
        "metal_site_symmetry_order": F.when(~broken, order),
        "metal_expected_crystallographic_occupancy": F.when(
            ~broken, F.floor(expected * 1e6 + 0.5) / F.lit(1e6)
        ),
        "metal_occupancy_matches_site_symmetry": F.when(
            ~broken & as_col(valid),
            F.abs(as_col(occupancy) - expected) <= vocab.SPECIAL_POSITION_OCCUPANCY_TOLERANCE,
        ),
    }


def cell_volume(a: Column, b: Column, c: Column, alpha: Column, beta: Column, gamma: Column) -> Column:
    """Unit-cell volume from its edges and angles in degrees."""
    ca, cb, cg = (F.cos(F.radians(angle)) for angle in (alpha, beta, gamma))
    return a * b * c * F.sqrt(1 - ca * ca - cb * cb - cg * cg + 2 * ca * cb * cg)


def orthogonal_matrix(
    a: Column, b: Column, c: Column, alpha: Column, beta: Column, gamma: Column
) -> dict[str, Column]:
    """The upper-triangular matrix from fractional to Cartesian coordinates."""
    ca, cb, cg = (F.cos(F.radians(angle)) for angle in (alpha, beta, gamma))
    sg = F.sin(F.radians(gamma))
    height = F.sqrt(1 - ca * ca - cb * cb - cg * cg + 2 * ca * cb * cg) / sg
    return {
        "m11": a,
        "m12": b * cg,
        "m13": c * cb,
        "m22": b * sg,
        "m23": c * (ca - cb * cg) / sg,
        "m33": c * height,
    }


def orthogonalize(u: Column, v: Column, w: Column) -> tuple[Column, Column, Column]:
    """Cartesian coordinates of a fractional point, with ``m..`` columns in scope."""
    m = F.col
    return (
        m("m11") * u + m("m12") * v + m("m13") * w,
        m("m22") * v + m("m23") * w,
        m("m33") * w,
    )


def fractionalize(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Fractional coordinates of a Cartesian point, with ``m..`` columns in scope."""
    m = F.col
    w = z / m("m33")
    v = (y - m("m23") * w) / m("m22")
    u = (x - m("m12") * v - m("m13") * w) / m("m11")
    return u, v, w


def apply_operation(u: Column, v: Column, w: Column, prefix: str = "") -> tuple[Column, ...]:
    """An operation with columns ``r11``..``r33``, ``t1``..``t3`` on a fractional point."""
    c = lambda name: F.col(prefix + name)
    return tuple(
        c(f"r{i}1") * u + c(f"r{i}2") * v + c(f"r{i}3") * w + c(f"t{i}") for i in (1, 2, 3)
    )


def image_provenance(
    image_index: str | Column,
    translation: tuple[str | Column, ...],
    operations: str | Column,
) -> dict[str, Column]:
    """How a generated image relates to the deposited asymmetric unit.

    Images are numbered identity first, then the other space-group operations,
    then one full block of operations per strict-NCS transform.
    """
    index, count = as_col(image_index), as_col(operations)
    moved = F.lit(False)
    for part in translation:
        moved = moved | (as_col(part) != 0)
    ncs = index >= count
    crystal = (F.pmod(index, count) != 0) | moved
    return {
        "crystallographic_contact": crystal,
        "strict_ncs_contact": ncs,
        "symmetry_contact": crystal | ncs,
        "ncs_block": F.when(ncs, F.floor(index / count).cast("int")),
        "contact_scope": first_label(
            [
                (ncs & crystal, "strict_ncs_and_crystallographic"),
                (ncs, "strict_ncs"),
                (crystal, "crystallographic"),
            ],
            "explicit",
        ),
    }


def generated_scope(
    generated: str | Column, crystallographic: str | Column, strict_ncs: str | Column
) -> Column:
    """The site's scope of generated contacts; null when images were not searched."""
    total, crystal, ncs = as_col(generated), as_col(crystallographic), as_col(strict_ncs)
    return F.when(
        total.isNotNull(),
        first_label(
            [
                (total == 0, "none"),
                ((crystal > 0) & (ncs > 0), "strict_ncs_and_crystallographic"),
                (crystal > 0, "crystallographic"),
            ],
            "strict_ncs",
        ),
    )
