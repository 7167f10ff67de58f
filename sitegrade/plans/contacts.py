"""Contact analysis of all entries at once: candidate, bond and site tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.geometry import generated_scope
from sitegrade.functions.ids import contact_id, site_id, symmetry_code
from sitegrade.operators import contacts as con
from sitegrade.operators.lookup import residue_classes
from sitegrade.operators.radius import nearest_neighbors
from sitegrade.session import cut_lineage, stored

SHIFT = ("tx", "ty", "tz")


@dataclass(frozen=True)
class ContactTables:
    """The three tables a contact analysis writes."""

    candidates: DataFrame
    bonds: DataFrame
    sites: DataFrame


@dataclass(frozen=True)
class _Scope:
    candidates: DataFrame
    contacts: DataFrame


def _assess(found: DataFrame, declared: DataFrame | None, reference: DataFrame, entries: DataFrame) -> _Scope:
    """Merge, judge, collapse, score and group the candidates of one scope."""
    merged = found if declared is None else con.merge_candidates(found, declared)
    judged = stored(con.with_eligibility(con.with_donor_policy(merged), reference))
    precise = judged.join(entries.select("entry_id", "dpi"), "entry_id", "left")
    kept = con.collapse_images(con.assigned(precise))
    return _Scope(judged, stored(con.with_groups(con.with_geometry(kept))))


def _identified(rows: DataFrame, model_index: int = 0) -> DataFrame:
    """Add ``metal_site_id``, ``symmetry_operation`` and ``contact_id``."""
    with_ids = rows.withColumns(
        {
            "metal_site_id": site_id(
                "entry_id", F.lit(model_index), "m_chain_index", "m_residue_index", "m_atom_index"
            ),
            "symmetry_operation": symmetry_code("image_index", SHIFT),
        }
    )
    parts: list[str | Column] = [
        F.lit(model_index), "n_chain_index", "n_residue_index", "n_atom_index", "contact_scope",
        "strict_ncs_operation_id", "image_index", "symmetry_operation", *SHIFT,
    ]
    return with_ids.withColumn("contact_id", contact_id("metal_site_id", parts))


def _ncs_ids(rows: DataFrame, operations: DataFrame | None) -> DataFrame:
    """Add the id of the NCS operation that generated a contact; blank for others."""
    if operations is None or "ncs_id" not in operations.columns:
        block = F.concat(F.lit("strict_ncs_"), F.col("ncs_block").cast("string"))
        return rows.withColumn("strict_ncs_operation_id", F.coalesce(block, F.lit("")))
    names = operations.where("is_ncs").select(
        "entry_id", "image_index", F.col("ncs_id").alias("strict_ncs_operation_id")
    )
    return rows.join(names, ["entry_id", "image_index"], "left").fillna(
        "", ["strict_ncs_operation_id"]
    )


def _connection_columns() -> dict[str, Column]:
    """Provenance of declared connections as aligned pipe lists."""
    def joined(field: str) -> Column:
        items = F.transform("declared", lambda d: F.coalesce(d[field].cast("string"), F.lit("")))
        return F.coalesce(F.array_join(items, "|"), F.lit(""))

    declared, inferred = F.col("is_declared"), F.col("inferred_contact_eligible")
    return {
        "coordination_status": con.coordination_status(declared, inferred),
        "coordination_source": F.when(declared, joined("source"))
        .when(inferred, F.lit("proximity_rule")).otherwise(F.lit("")),
        "declared_connection": declared,
        "connection_id": joined("connection_id"),
        "connection_type": joined("connection_type"),
        "connection_link_id": joined("link_id"),
        "connection_asu": joined("asu"),
        "connection_reported_distance": joined("reported_distance"),
    }


def _common_columns() -> dict[str, Column]:
    """Identity and image columns bond and candidate rows share."""
    sides = {}
    for side, prefix in (("metal", "m_"), ("neighbor", "n_")):
        for name, source in (
            ("resname", "residue_name"), ("chain", "chain_id"), ("resnum", "resnum"),
            ("element", "element"), ("atom", "atom_name"), ("icode", "insertion_code"),
            ("altloc", "altloc"), ("occupancy", "occupancy"), ("chain_index", "chain_index"),
            ("residue_index", "residue_index"), ("atom_index", "atom_index"),
        ):
            sides[f"{side}_{name}"] = F.col(prefix + source)
    return {
        **sides,
        "metal_model_index": F.lit(0),
        "neighbor_model_index": F.lit(0),
        "neighbor_b_iso": F.col("n_b_iso"),
        "neighbor_class": F.col("neighbor_class"),
        "symmetry_image_index": F.col("image_index"),
        "cell_translation_x": F.col("tx"),
        "cell_translation_y": F.col("ty"),
        "cell_translation_z": F.col("tz"),
        "transformed_neighbor_x": F.col("px"),
        "transformed_neighbor_y": F.col("py"),
        "transformed_neighbor_z": F.col("pz"),
    }


IMAGE_COLUMNS = (
    "contact_scope", "symmetry_contact", "crystallographic_contact", "strict_ncs_contact",
    "strict_ncs_operation_id", "symmetry_operation",
)
DONOR_COLUMNS = ("inferred_donor_allowed", "inferred_donor_rule", "donor_rule_override")
GEOMETRY_COLUMNS = (
    "zscore", "reference_covered", "geometry_outlier", "geometry_consistent",
    "multi_donor_detected", "multi_donor_contact_count", "multi_donor_geometry_status",
    "multi_donor_contains_suspect_bond", "score_eligible", "score_exclusion_reason", "dpi",
)
ELIGIBILITY_COLUMNS = (
    "eligibility_status", "eligibility_reason", "first_sphere_eligible", "first_sphere_cutoff",
    "assignment_reference", "inferred_contact_eligible",
)


def _select(rows: DataFrame, fixed: tuple[str, ...], extra: dict[str, Column], reasons: Column) -> DataFrame:
    common = _common_columns()
    return rows.select(
        "entry_id", "metal_site_id", "contact_id",
        *[c.alias(n) for n, c in {**common, **_connection_columns()}.items()],
        *IMAGE_COLUMNS, *DONOR_COLUMNS, *fixed,
        (F.size(reasons) > 0).alias("context_warning"),
        reasons.alias("context_warning_reasons"),
        *[c.alias(n) for n, c in extra.items()],
    )


def candidate_table(scope: DataFrame, bonds: DataFrame) -> DataFrame:
    """Published candidate rows, flagged when they became a bond."""
    made = bonds.select("contact_id", F.lit(True).alias("__bond"))
    rows = _select(
        scope, ELIGIBILITY_COLUMNS,
        {
            "candidate_source": F.array_join(F.array_sort("sources"), "|"),
            "candidate_distance": F.col("distance"),
            "assignment_target": F.col("target"),
            "assignment_tolerance": F.lit(vocab.FIRST_SPHERE_TOLERANCE),
            "assignment_reference_kind": F.col("reference_kind"),
        },
        con.contact_reasons(False),
    )
    return rows.join(made, "contact_id", "left").withColumn(
        "assigned_as_bond", F.coalesce("__bond", F.lit(False))
    ).drop("__bond")


def bond_table(contacts: DataFrame) -> DataFrame:
    """Published bond rows with the order that breaks their ties."""
    order = F.struct(
        "n_chain_index", "n_residue_index", "n_atom_index", "symmetry_operation", *SHIFT, "px", "py", "pz"
    )
    return _select(
        contacts, GEOMETRY_COLUMNS,
        {
            "distance": F.col("reported_distance"),
            "literature_distance": F.col("mu"),
            "literature_stdev": F.col("sigma"),
            "bonded_to": F.when(F.col("n_is_water"), F.lit("HOH")).otherwise(F.lit("P")),
            "zscore_outlier_cutoff": F.lit(vocab.OUTLIER_CUTOFF),
            "contact_order": order,
        },
        con.contact_reasons(True),
    )


IMAGE_COUNTS = (
    "symmetry_contact_count", "crystallographic_contact_count", "strict_ncs_contact_count",
    "combined_ncs_crystallographic_contact_count",
)


def site_table(
    metals: DataFrame, explicit: _Scope, primary: _Scope, entries: DataFrame
) -> DataFrame:
    """One row per metal: both scopes, context, donors, neighbours.

    ``metals`` holds every selected metal with ``m_`` columns, positions or
    not; ``entries`` adds ``dpi_reason`` and ``searched``. ``primary`` holds the
    image-inclusive scope of searched entries and the explicit one of the rest;
    it is what a site's counts, context and donors speak of.
    """
    keys = list(con.SITE)
    base = metals.select(*keys, "m_x", "m_y", "m_z", "m_b_iso", "m_element").join(
        entries.select(
            "entry_id", "dpi_reason", F.coalesce("searched", F.lit(False)).alias("searched"),
            *[c for c in ("entry_median_b_iso",) if c in entries.columns],
        ), "entry_id", "left"
    ).fillna(False, ["searched"])
    yes, searched = F.lit(True), F.col("searched")
    out = con.empty_scope(base.join(con.scope_summary(explicit.contacts), keys, "left"), yes)
    scope_columns = (*con.COUNT_COLUMNS, "geometry_coverage", "geometry_status")
    out = out.withColumnsRenamed({c: f"explicit_{c}" for c in scope_columns})
    out = con.empty_scope(out.join(con.scope_summary(primary.contacts), keys, "left"), yes)
    # the image-inclusive columns stay null where no images were searched
    out = out.withColumns({
        f"image_inclusive_{c}": F.when(searched, F.col(c)) for c in scope_columns})
    out = out.join(con.image_counts(primary.contacts), keys, "left").withColumns({
        c: F.when(searched, F.coalesce(F.col(c), F.lit(0).cast("long"))) for c in IMAGE_COUNTS})
    scored = F.coalesce(F.col("scored_geometry_outlier_contact_count"), F.lit(0)) + F.coalesce(
        F.col("scored_geometry_consistent_contact_count"), F.lit(0)
    )
    finite = F.col("m_x").isNotNull() & F.col("m_y").isNotNull() & F.col("m_z").isNotNull()
    near = nearest_neighbors(
        metals.where("m_x IS NOT NULL AND m_y IS NOT NULL AND m_z IS NOT NULL").select(
            *keys, "m_x", "m_y", "m_z"
        ),
        ["entry_id"], keys[1:], ["m_x", "m_y", "m_z"], vocab.NEARBY_METAL_RADIUS + vocab.SEARCH_EPSILON,
    ).select(
        *keys, "nearest_distance", F.col("near_count").alias("nearby_metal_count_6a"),
        *[f"nearest_{c}" for c in keys[1:]],
    )
    neighbour = metals.select(
        "entry_id", *[F.col(c).alias(f"nearest_{c}") for c in keys[1:]],
        F.col("m_element").alias("nearest_metal_element"),
    )
    return (
        out.join(con.site_context(primary.contacts, primary.candidates), keys, "left")
        .join(con.donor_b_factors(primary.contacts), keys, "left")
        .join(near, keys, "left")
        .join(neighbour, ["entry_id", *[f"nearest_{c}" for c in keys[1:]]], "left")
        .withColumns(
            {
                "metal_site_id": site_id("entry_id", F.lit(0), *keys[1:]),
                "metal_coordinates_valid": finite,
                "generated_contact_scope": generated_scope(*IMAGE_COUNTS[:3]),
                "geometry_classification_changes_with_generated_images": F.when(
                    searched, F.col("explicit_geometry_status") != F.col("geometry_status")
                ),
                "coordination_depends_on_crystallographic_symmetry": F.col("crystallographic_contact_count") > 0,
                "coordination_depends_on_strict_ncs": F.col("strict_ncs_contact_count") > 0,
                "geometry_not_assessed_reason": con.not_assessed_reason(
                    F.coalesce("dpi_reason", F.lit("")), searched, scored, finite
                ),
                "context_warning": F.coalesce("context_warning", F.lit(False)),
                "nearest_metal_site_id": F.when(
                    F.col("nearest_distance").isNotNull(),
                    site_id("entry_id", F.lit(0), *[f"nearest_{c}" for c in keys[1:]]),
                ),
            }
        )
    )


def analyze_contacts(
    atoms: DataFrame,
    entries: DataFrame,
    reference: DataFrame,
    cells: DataFrame | None = None,
    operations: DataFrame | None = None,
    declared: DataFrame | None = None,
    components: DataFrame | None = None,
) -> ContactTables:
    """Candidate, bond and site tables of all entries.

    ``atoms`` are the selected conformers' atoms, ``entries`` carries
    ``entry_id, dpi, dpi_reason, searched``. Without ``cells`` and
    ``operations`` only deposited coordinates are searched; with them the
    image-inclusive scope is primary for every entry that has them.
    ``declared`` holds placed candidate rows of declared connections.
    ``components`` (``residue_name, residue_class``) classes the residues of
    neighbours. Proximity finds standard amino acids and waters only, declared
    connections any residue, so ``declared`` needs the table.
    """
    if declared is not None and components is None:
        raise ValueError("declared neighbours may be of any residue: give the class table of components")
    classes = residue_classes(atoms.sparkSession, components)
    atoms = stored(con.searched(atoms))
    metals, donors = con.metals_of(atoms), con.donors_of(atoms)
    near = None if declared is None else declared.where(~F.col("symmetry_contact"))
    nearby = con.explicit_candidates(metals, donors)
    explicit = _assess(nearby, near, reference, entries)
    primary = explicit
    if cells is None or operations is None:
        entries = entries.withColumn("searched", F.lit(False))
    else:
        # images are searched where the entry asks for it and has a cell
        celled = cells.select("entry_id", F.lit(True).alias("__celled")).distinct()
        entries = cut_lineage(
            entries.join(celled, "entry_id", "left").withColumn(
                "searched", F.coalesce("searched", F.lit(False)) & F.coalesce("__celled", F.lit(False))
            ).drop("__celled"))
        asked = entries.where("searched").select("entry_id")
        rest = entries.where("NOT searched").select("entry_id")
        found = con.image_candidates(
            metals.join(asked, "entry_id", "left_semi"), donors,
            cells.join(asked, "entry_id", "left_semi"), operations)
        placed = None if declared is None else declared.join(asked, "entry_id", "left_semi")
        image = _assess(found.select(*nearby.columns), placed, reference, entries)
        primary = _Scope(*(
            wide.unionByName(own.join(rest, "entry_id", "left_semi"))
            for wide, own in ((image.candidates, explicit.candidates), (image.contacts, explicit.contacts))
        ))
    contacts, found = (
        con.with_neighbor_class(_identified(_ncs_ids(rows, operations)), classes)
        for rows in (primary.contacts, primary.candidates))
    bonds = cut_lineage(bond_table(contacts))
    candidates = candidate_table(found, bonds)
    everyone = con._prefixed(atoms.where(con.is_metal()), "m_")
    return ContactTables(candidates, bonds, site_table(everyone, explicit, primary, entries))
