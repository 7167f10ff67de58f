"""Levels, the verdict matrix, and the final score as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import as_col, finite, first_label


def component_level(value: str | Column, review: float, suspect: float) -> Column:
    """PASS, REVIEW or SUSPECT by raw thresholds; INCOMPLETE without a measurement."""
    x = finite(value)
    return first_label(
        [
            (x.isNull() | (x < 0), "INCOMPLETE"),
            (x < review, "PASS"),
            (x < suspect, "REVIEW"),
        ],
        "SUSPECT",
    )


def density_level(value: str | Column) -> Column:
    """The level of an absolute density z-score."""
    return component_level(value, vocab.DENSITY_REVIEW, vocab.DENSITY_SUSPECT)


def geometry_level(value: str | Column) -> Column:
    """The level of a site's RMS bond z-score."""
    return component_level(value, vocab.GEOMETRY_REVIEW, vocab.GEOMETRY_SUSPECT)


def verdict_reason(density: str | Column, geometry: str | Column) -> Column:
    """The rule of the decision matrix that fires for two component levels."""
    d, g = as_col(density), as_col(geometry)
    return first_label(
        [
            ((d == "INCOMPLETE") & (g == "INCOMPLETE"), "no_assessable_evidence"),
            ((d == "SUSPECT") & (g == "SUSPECT"), "density_and_geometry_suspect"),
            (d == "SUSPECT", "density_suspect"),
            (g == "SUSPECT", "geometry_suspect"),
            ((d == "REVIEW") & (g == "REVIEW"), "review_plus_review"),
            (d == "REVIEW", "density_review"),
            (g == "REVIEW", "geometry_review"),
        ],
        "all_available_components_pass",
    )


def site_level(density: str | Column, geometry: str | Column) -> Column:
    """The site's verdict: no component can compensate for another."""
    d, g = as_col(density), as_col(geometry)
    return first_label(
        [
            ((d == "INCOMPLETE") & (g == "INCOMPLETE"), "INCOMPLETE"),
            ((d == "SUSPECT") | (g == "SUSPECT"), "SUSPECT"),
            ((d == "REVIEW") & (g == "REVIEW"), "SUSPECT"),
            ((d == "REVIEW") | (g == "REVIEW"), "REVIEW"),
        ],
        "PASS",
    )


def evidence_basis(density: str | Column, geometry: str | Column) -> Column:
    """Which components the verdict rests on."""
    has_d = as_col(density) != "INCOMPLETE"
    has_g = as_col(geometry) != "INCOMPLETE"
    return first_label(
        [
            (has_d & has_g, "density_and_geometry"),
            (has_d, "density_only"),
            (has_g, "geometry_only"),
        ],
        "no_assessable_evidence",
    )


def is_saturated(value: str | Column) -> Column:
    """Whether an absolute density z-score sits at the printed ceiling."""
    return F.coalesce(finite(value) >= vocab.DENSITY_SATURATION, F.lit(False))


def density_score(value: str | Column, rank: str | Column) -> Column:
    """The density rank, with a saturated measurement pinned to zero."""
    return F.when(is_saturated(value), F.lit(0.0)).otherwise(as_col(rank))


def overall_score(density: str | Column, geometry: str | Column) -> Column:
    """The lower of the scores that exist."""
    return F.least(as_col(density), as_col(geometry))


def input_status(has_density: Column, has_geometry: Column) -> Column:
    """Which evidence components a prepared row carries."""
    return first_label(
        [
            (has_density & has_geometry, "complete"),
            (has_density, "density_only"),
            (has_geometry, "geometry_only"),
        ],
        "unscorable",
    )


def with_verdict(df: DataFrame, rszd_abs: str, rms_zbond: str) -> DataFrame:
    """Add the component levels and the verdict columns drawn from them."""
    levelled = df.withColumns(
        {"density_level": density_level(rszd_abs), "geometry_level": geometry_level(rms_zbond)}
    )
    d, g = "density_level", "geometry_level"
    return levelled.withColumns(
        {
            "site_level": site_level(d, g),
            "evidence_basis": evidence_basis(d, g),
            "verdict_reason": verdict_reason(d, g),
        }
    )
