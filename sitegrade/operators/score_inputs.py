"""Score inputs: sites and contacts joined, with every counted site kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import finite, first_label, labels
from sitegrade.functions.ids import site_key
from sitegrade.functions.rounding import METRIC_PLACES, with_rounded
from sitegrade.functions.scoring import input_status, is_saturated
from sitegrade.operators.bonds import bond_summary, fill_unbonded, first_seen_labels

LEGACY_KEY = (
    "metal_model_index", "metal_chain_index", "metal_residue_index", "metal_atom_index",
)
#: Identity columns copied from the site row, or from a bond row without one.
IDENTITY_COLUMNS = (
    "entry_id", "metal_site_id", "category", "density_observation_id", "density_scope",
    "density_shared_site_count", "density_is_shared", "coordinate_mapping_status",
    "selected_metal_site_status", *LEGACY_KEY, "metal_resname", "metal_chain",
    "metal_resnum", "metal_atom", "metal_element", "metal_icode", "metal_altloc",
)
DENSITY_COLUMNS = ("rszd", "rszd_abs", "rszd_negative", "rszd_positive", "density_saturated")
SUMMARY_COLUMNS = (
    "assigned_contact_count", "reference_covered_contact_count", "geometry_bond_count",
    "geometry_coverage", "geometry_rms_zbond", "geometry_max_abs_zbond",
    "geometry_mean_abs_zbond", "geometry_mean_signed_zbond", "worst_bond",
    "worst_bond_source", "worst_bond_neighbor_resname", "worst_bond_neighbor_chain",
    "worst_bond_neighbor_resnum", "worst_bond_neighbor_atom", "declared_contact_count",
    "inferred_contact_count", "declared_scored_bond_count", "inferred_scored_bond_count",
    "geometry_contact_basis", "multi_donor_contact_count",
)
SCORE_INPUT_COLUMNS = (
    *IDENTITY_COLUMNS, *DENSITY_COLUMNS, *SUMMARY_COLUMNS,
    "suspect_multi_donor_residue_group_count", "context_warning",
    "context_warning_reasons", "score_inputs_status", "score_inputs_missing_reasons",
)
PLACEHOLDER_REASONS = (
    "rszd_unavailable", "site_identity_unavailable", "site_evidence_unavailable",
)


def with_site_key(df: DataFrame) -> DataFrame:
    """Add ``site_key``, the text that identifies a site across tables."""
    return df.withColumn("site_key", site_key("entry_id", "metal_site_id", LEGACY_KEY))


def geometry_gaps() -> list[tuple[Column, str]]:
    """Conditions and reasons for missing geometry, worst first."""
    covered = F.col("reference_covered_contact_count")
    scored = F.col("geometry_bond_count")
    assigned = F.col("assigned_contact_count")
    return [
        (covered == 0, "no_geometry_reference"),
        ((covered > 0) & (scored < covered), "zbond_unavailable_for_reference"),
        (covered < assigned, "partial_geometry_coverage"),
    ]


def prepare_score_inputs(
    sites: DataFrame, bonds: DataFrame, *, cofactor_ids: Sequence[str] = ()
) -> DataFrame:
    """One row per selected site, plus one per bonded site that has no site row.

    Contacts are summed to sites before the join, so both sides of the full
    outer join carry one row per key and no key can grow it.
    """
    selected = with_site_key(
        sites.where(F.trim("selected_metal_site_status") == "selected")
    )
    keyed = with_site_key(bonds)
    order = ["contact_order"]
    summary = bond_summary(keyed, ["site_key"], order)
    firsts, assembled = first_seen_labels(
        F.col("context_warning_reasons"), vocab.CONTEXT_REASONS, order
    )
    bond_only = [c for c in IDENTITY_COLUMNS if c in bonds.columns]
    orphan_side = keyed.groupBy("site_key").agg(
        F.min_by(
            F.struct(*[F.col(c) for c in bond_only], F.col("parent_type")),
            F.struct(*order),
        ).alias("bond_row"),
        F.bool_or(F.coalesce(F.col("context_warning"), F.lit(False))).alias("bond_warning"),
        *firsts,
    ).select("site_key", "bond_row", "bond_warning", assembled.alias("bond_reasons"))
    evidence = summary.join(orphan_side, "site_key")
    joined = fill_unbonded(
        selected.withColumn("__site", F.lit(True)).join(evidence, "site_key", "full_outer")
    )
    rounded = [c for c in SUMMARY_COLUMNS if c.endswith("zbond")]
    joined = joined.withColumns(
        {"is_site": F.coalesce(F.col("__site"), F.lit(False)), "zd": finite("zd_main")}
    )
    joined = with_rounded(
        joined,
        {
            "rszd": ("zd", METRIC_PLACES),
            "rszd_abs": (F.abs("zd"), METRIC_PLACES),
            **{c: (c, METRIC_PLACES) for c in rounded},
        },
    )
    is_site, zd = F.col("is_site"), F.col("zd")
    has_density = is_site & zd.isNotNull()
    has_geometry = F.col("geometry_bond_count") > 0
    no_contacts = F.col("assigned_contact_count") == 0
    reasons = labels(
        [
            (is_site & ~F.coalesce(F.col("metal_coordinates_valid"), F.lit(True)),
             "non_finite_metal_coordinates"),
            (~has_density, "rszd_unavailable"),
            (~is_site, "density_row_unavailable"),
            (is_site & no_contacts, "no_assigned_contacts"),
            *[(~no_contacts & gap, reason) for gap, reason in geometry_gaps()],
        ]
    )
    orphan_category = first_label(
        [
            (F.upper("bond_row.metal_resname").isin(*cofactor_ids)
             if cofactor_ids else F.lit(False), "cofactor"),
            (F.col("bond_row.parent_type") == "ion", "metal"),
        ],
        "",
    )
    overrides = {
        "category": orphan_category,
        "coordinate_mapping_status": F.lit("density_row_unavailable"),
        "selected_metal_site_status": F.lit("selected_without_density_row"),
    }
    identity = []
    for name in IDENTITY_COLUMNS:
        kind = selected.schema[name].dataType
        fallback = overrides.get(
            name, F.col(f"bond_row.{name}") if name in bond_only else F.lit(None)
        ).cast(kind)
        identity.append(F.when(is_site, F.col(name)).otherwise(fallback).alias(name))
    return joined.select(
        *identity,
        "rszd",
        "rszd_abs",
        finite("zd_minus").alias("rszd_negative"),
        finite("zd_plus").alias("rszd_positive"),
        F.when(is_site, is_saturated(F.abs(zd))).alias("density_saturated"),
        *SUMMARY_COLUMNS,
        "suspect_multi_donor_residue_group_count",
        F.when(is_site, F.col("context_warning")).otherwise(F.col("bond_warning")).alias(
            "context_warning"
        ),
        F.when(is_site, F.col("context_warning_reasons"))
        .otherwise(F.col("bond_reasons"))
        .alias("context_warning_reasons"),
        input_status(has_density, has_geometry).alias("score_inputs_status"),
        reasons.alias("score_inputs_missing_reasons"),
    )


def add_entry_reason(reasons: Column, entry_reason: Column) -> Column:
    """A row's reasons with the entry-level one appended when it is new."""
    known = F.coalesce(entry_reason, F.lit("")) != ""
    return F.when(known, F.array_union(reasons, F.array(entry_reason))).otherwise(reasons)


def complete_site_count(inputs: DataFrame, entries: DataFrame) -> DataFrame:
    """Add placeholders until each entry has as many rows as it has sites.

    ``entries`` holds ``entry_id``, ``n_metals`` and ``missing_reason``; the
    entry's reason is also noted on the rows that exist.
    """
    counted = inputs.groupBy("entry_id").agg(F.count(F.lit(1)).alias("have"))
    reason = entries.select("entry_id", "missing_reason")
    annotated = inputs.join(reason, "entry_id", "left").withColumn(
        "score_inputs_missing_reasons",
        add_entry_reason(F.col("score_inputs_missing_reasons"), F.col("missing_reason")),
    )
    have = F.coalesce(F.col("have"), F.lit(0)).cast("int")
    wanted = F.col("n_metals").cast("int")
    gaps = (
        entries.join(counted, "entry_id", "left")
        .where(wanted > have)
        .withColumn("place", F.explode(F.sequence(have + 1, wanted)))
    )
    fixed = {
        "entry_id": F.col("entry_id"),
        "selected_metal_site_status": F.lit("selected_site_unresolved"),
        "metal_atom_index": F.concat(F.lit("unresolved-"), F.col("place").cast("string")),
        "context_warning": F.lit(True),
        "context_warning_reasons": F.array(F.lit("site_evidence_unavailable")),
        "score_inputs_status": F.lit("unscorable"),
        "score_inputs_missing_reasons": add_entry_reason(
            F.array(*[F.lit(r) for r in PLACEHOLDER_REASONS]), F.col("missing_reason")
        ),
    }
    placeholders = gaps.select(
        *[
            fixed.get(f.name, F.lit(None)).cast(
                "string" if f.name == "metal_atom_index" else f.dataType
            ).alias(f.name)
            for f in inputs.schema.fields
        ]
    )
    kept = annotated.select(
        *[
            F.col(c).cast("string").alias(c) if c == "metal_atom_index" else F.col(c)
            for c in inputs.columns
        ]
    )
    return kept.unionByName(placeholders)


def excess_entries(inputs: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries with more rows than sites; a job refuses to continue past any."""
    counted = inputs.groupBy("entry_id").agg(F.count(F.lit(1)).alias("have"))
    return counted.join(entries, "entry_id").where(F.col("have") > F.col("n_metals")).select(
        "entry_id", "have", "n_metals"
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their multiplicity."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    )
