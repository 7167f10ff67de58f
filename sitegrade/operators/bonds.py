"""Per-site aggregation of assigned contacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade.functions.clean import finite, first_label

NEIGHBOR_COLUMNS = (
    "neighbor_resname", "neighbor_chain", "neighbor_resnum", "neighbor_atom",
)
#: Counts that read zero, not null, for a site without contacts.
ZERO_COLUMNS = (
    "assigned_contact_count", "reference_covered_contact_count", "geometry_bond_count",
    "declared_contact_count", "inferred_contact_count", "declared_scored_bond_count",
    "inferred_scored_bond_count", "multi_donor_contact_count",
)


def _is_true(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def bond_summary(bonds: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Geometry evidence of each site, one row per ``keys``.

    All measures combine map-side, so a site with very many contacts costs one
    partial row per task. ``order`` names columns that order a site's contacts;
    the worst bond is the first one with the largest absolute z-score.
    """
    z = finite("zscore")
    scored = _is_true("score_eligible") & z.isNotNull()
    declared = _is_true("declared_connection")
    inferred = F.coalesce(F.trim("coordination_status") == "inferred", F.lit(False))
    zs = F.when(scored, z)
    worst = F.min_by(
        F.struct(
            F.col("contact_id"),
            first_label([(declared, "declared"), (inferred, "inferred")], "").alias("source"),
            *[F.col(c) for c in NEIGHBOR_COLUMNS],
        ),
        F.when(scored, F.struct((-F.abs(z)).alias("size"), *[F.col(c) for c in order])),
    )
    summed = bonds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("assigned_contact_count"),
        F.count_if(_is_true("reference_covered")).alias("reference_covered_contact_count"),
        F.count(zs).alias("geometry_bond_count"),
        F.sqrt(F.avg(zs * zs)).alias("geometry_rms_zbond"),
        F.max(F.abs(zs)).alias("geometry_max_abs_zbond"),
        F.avg(F.abs(zs)).alias("geometry_mean_abs_zbond"),
        F.avg(zs).alias("geometry_mean_signed_zbond"),
        worst.alias("worst"),
        F.count_if(declared).alias("declared_contact_count"),
        F.count_if(inferred).alias("inferred_contact_count"),
        F.count_if(scored & declared).alias("declared_scored_bond_count"),
        F.count_if(scored & inferred).alias("inferred_scored_bond_count"),
        F.count_if(_is_true("multi_donor_detected")).alias("multi_donor_contact_count"),
    )
    return summed.select(
        *keys,
        "assigned_contact_count",
        "reference_covered_contact_count",
        "geometry_bond_count",
        (F.col("reference_covered_contact_count") / F.col("assigned_contact_count")).alias(
            "geometry_coverage"
        ),
        "geometry_rms_zbond",
        "geometry_max_abs_zbond",
        "geometry_mean_abs_zbond",
        "geometry_mean_signed_zbond",
        F.col("worst.contact_id").alias("worst_bond"),
        F.col("worst.source").alias("worst_bond_source"),
        *[F.col(f"worst.{c}").alias(f"worst_bond_{c}") for c in NEIGHBOR_COLUMNS],
        "declared_contact_count",
        "inferred_contact_count",
        "declared_scored_bond_count",
        "inferred_scored_bond_count",
        contact_basis("declared_scored_bond_count", "inferred_scored_bond_count").alias(
            "geometry_contact_basis"
        ),
        "multi_donor_contact_count",
    )


def contact_basis(declared: str, inferred: str) -> Column:
    """Which provenance the scored contacts came from."""
    has_d, has_i = F.col(declared) > 0, F.col(inferred) > 0
    return first_label(
        [
            (has_d & has_i, "declared_and_inferred"),
            (has_d, "declared_only"),
            (has_i, "inferred_only"),
        ],
        "none",
    )


def fill_unbonded(joined: DataFrame) -> DataFrame:
    """Give a site without contacts zero counts, zero coverage and basis ``none``."""
    return joined.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ZERO_COLUMNS},
            "geometry_coverage": F.coalesce(F.col("geometry_coverage"), F.lit(0.0)),
            "geometry_contact_basis": F.coalesce(
                F.col("geometry_contact_basis"), F.lit("none")
            ),
        }
    )


def first_seen_labels(
    items: Column, vocabulary: Sequence[str], order: Sequence[str]
) -> tuple[list[Column], Column]:
    """Ordered distinct union of a label array over a group, without collecting it.

    The vocabulary is closed, so the group keeps only the earliest position of
    each label. Returns the aggregate columns and the column that assembles
    them afterwards.
    """
    firsts = []
    for index, label in enumerate(vocabulary):
        where = F.array_position(items, label)
        place = F.when(
            where > 0, F.struct(*[F.col(c) for c in order], where.alias("__pos"))
        )
        firsts.append(F.min(place).alias(f"__label_{index}"))
    pairs = F.array(
        *[
            F.when(
                F.col(f"__label_{index}").isNotNull(),
                F.struct(F.col(f"__label_{index}").alias("at"), F.lit(label).alias("label")),
            )
            for index, label in enumerate(vocabulary)
        ]
    )
    present = F.array_sort(F.filter(pairs, lambda p: p.isNotNull()))
    return firsts, F.transform(present, lambda p: p["label"])
