"""Contact discovery, donor policy, eligibility, geometry and site summaries.

Stages run over all entries at once, in this order: discovery, merge of
provenance, donor policy, eligibility, collapse of coincident images, geometry,
residue groups, summaries. Metal columns carry ``m_``, donor columns ``n_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import first_label, labels
from sitegrade.functions.geometry import (
    bond_zscore, distance, image_provenance, is_outlier, metal_donor_comparison,
    orthogonalize,
)
from sitegrade.functions.rounding import with_rounded
from sitegrade.operators.bonds import first_seen_labels
from sitegrade.operators.lookup import lookup_with_fallback
from sitegrade.operators.prefix import exact_median
from sitegrade.operators.radius import image_radius_join, radius_join

ATOM_COLUMNS = (
    "chain_index", "residue_index", "atom_index", "chain_id", "residue_name", "resnum",
    "insertion_code", "atom_name", "altloc", "element", "occupancy", "occupancy_valid",
    "x", "y", "z", "b_iso", "is_water",
)
SITE = ("entry_id", "m_chain_index", "m_residue_index", "m_atom_index")
DONOR = ("n_chain_index", "n_residue_index", "n_atom_index")
RESIDUE_IMAGE = ("n_chain_index", "n_residue_index", "image_index", "tx", "ty", "tz")
DECLARED_TYPE = (
    "array<struct<source:string,connection_id:string,connection_type:string,"
    "link_id:string,asu:string,reported_distance:double>>"
)


def absent(name: str) -> Column:
    """Whether an atom is modelled with a valid occupancy of zero."""
    valid = F.coalesce(F.col(f"{name}occupancy_valid"), F.lit(False))
    return valid & F.coalesce(F.col(f"{name}occupancy") == 0, F.lit(False))


def is_metal() -> Column:
    """Known metal element, not modelled as absent."""
    return F.coalesce(F.col("element").isin(*vocab.METALS), F.lit(False)) & ~absent("")


def has_position() -> Column:
    """All three coordinates present."""
    return F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()


def metals_of(atoms: DataFrame) -> DataFrame:
    """Metal side of the search, columns prefixed ``m_``; positions required."""
    return _prefixed(atoms.where(is_metal() & has_position()), "m_")


def is_donor() -> Column:
    """N, O or S of a water or amino acid, really modelled, with a position."""
    supported = F.col("is_water") | F.col("residue_name").isin(*vocab.AMINO_ACIDS)
    modelled = F.col("occupancy_valid") & (F.col("occupancy") > 0)
    return F.col("element").isin(*vocab.DONOR_ELEMENTS) & supported & modelled & has_position()


def donors_of(atoms: DataFrame) -> DataFrame:
    """Donor side of the search: the atoms of :func:`is_donor`, columns prefixed ``n_``."""
    return _prefixed(atoms.where(is_donor()), "n_", extra=("polymer_position",))


def searched(atoms: DataFrame) -> DataFrame:
    """Every metal, positions or not, and every donor, with the columns a search carries."""
    kept = atoms.where(is_metal() | F.coalesce(is_donor(), F.lit(False)))
    return kept.select("entry_id", *ATOM_COLUMNS, "polymer_position")


def _prefixed(atoms: DataFrame, prefix: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return atoms.select(
        "entry_id", *[F.col(c).alias(prefix + c) for c in (*ATOM_COLUMNS, *extra)]
    )


def _same_residue() -> Column:
    return (F.col("m_chain_index") == F.col("n_chain_index")) & (
        F.col("m_residue_index") == F.col("n_residue_index")
    )


def _in_reach() -> Column:
    limit = vocab.SEARCH_RADIUS + vocab.ACCEPT_EPSILON
    return (F.col("distance") > 0) & (F.col("distance") <= limit)


def explicit_candidates(metals: DataFrame, donors: DataFrame) -> DataFrame:
    """Donors within reach of each metal among the deposited coordinates."""
    pairs = radius_join(
        metals, donors, vocab.SEARCH_RADIUS + vocab.SEARCH_EPSILON, ["entry_id"],
        ["m_x", "m_y", "m_z"], ["n_x", "n_y", "n_z"],
    )
    return as_explicit(pairs.where(_in_reach() & ~_same_residue())).withColumns(
        {
            "sources": F.array(F.lit("proximity_4A")),
            "declared": F.lit(None).cast(DECLARED_TYPE),
            "donor_class_supported": F.lit(True),
        }
    )


def as_explicit(pairs: DataFrame) -> DataFrame:
    """Image columns of a contact inside the deposited asymmetric unit."""
    return pairs.withColumns(
        {
            "image_index": F.lit(0),
            "tx": F.lit(0),
            "ty": F.lit(0),
            "tz": F.lit(0),
            "px": F.col("n_x"),
            "py": F.col("n_y"),
            "pz": F.col("n_z"),
            "crystallographic_contact": F.lit(False),
            "strict_ncs_contact": F.lit(False),
            "symmetry_contact": F.lit(False),
            "ncs_block": F.lit(None).cast("int"),
            "contact_scope": F.lit("explicit"),
        }
    )


def image_candidates(
    metals: DataFrame, donors: DataFrame, cells: DataFrame, operations: DataFrame
) -> DataFrame:
    """Donors within reach of each metal over all symmetry images."""
    matrix = cells.select("entry_id", "m11", "m12", "m13", "m22", "m23", "m33")
    counts = operations.where(~F.col("is_ncs")).groupBy("entry_id").agg(
        F.count(F.lit(1)).cast("int").alias("operation_count")
    )
    counted = matrix.join(counts, "entry_id")

    def fractional(df: DataFrame, prefix: str, names: tuple[str, str, str]) -> DataFrame:
        x, y, z = (f"{prefix}{axis}" for axis in "xyz")
        w = f"({z} / m33)"
        v = f"(({y} - m23 * {w}) / m22)"
        u = f"(({x} - m12 * {v} - m13 * {w}) / m11)"
        return df.join(matrix, "entry_id").selectExpr(
            *df.columns, f"{u} AS {names[0]}", f"{v} AS {names[1]}", f"{w} AS {names[2]}"
        )

    pairs = image_radius_join(
        fractional(metals, "m_", ("lu", "lv", "lw")),
        fractional(donors, "n_", ("ru", "rv", "rw")),
        counted, operations, vocab.SEARCH_RADIUS + vocab.SEARCH_EPSILON,
    )
    px, py, pz = orthogonalize(F.col("iu"), F.col("iv"), F.col("iw"))
    provenance = image_provenance("image_index", ("tx", "ty", "tz"), "operation_count")
    kept = pairs.withColumns({"px": px, "py": py, "pz": pz, **provenance}).drop(
        "lu", "lv", "lw", "ru", "rv", "rw", "iu", "iv", "iw",
        "m11", "m12", "m13", "m22", "m23", "m33", "operation_count",
    )
    return kept.where(_in_reach() & ~(_same_residue() & ~F.col("symmetry_contact"))).withColumns(
        {
            "sources": F.array(F.lit("proximity_4A")),
            "declared": F.lit(None).cast(DECLARED_TYPE),
            "donor_class_supported": F.lit(True),
        }
    )


def merge_candidates(proximity: DataFrame, declared: DataFrame) -> DataFrame:
    """One row per atom image, whichever ways it was found.

    Two records of one image differ in position only by arithmetic noise.
    Records outside that tolerance of the image's first record stay apart.
    """
    image = [*SITE, *DONOR, "image_index", "tx", "ty", "tz"]
    both = proximity.withColumn("route", F.lit(0)).unionByName(
        declared.withColumn("route", F.lit(1))
    )
    # dealt once by site; images and their records are settled there
    led = both.repartition(*SITE).withColumn(
        "lead", F.min(F.struct("route", "px", "py", "pz")).over(Window.partitionBy(*image)))
    away = distance(
        tuple(F.col(c) for c in ("px", "py", "pz")),
        tuple(F.col(f"lead.{c}") for c in ("px", "py", "pz")),
    )
    joined = led.withColumn(
        "__apart",
        F.when(away > vocab.SAME_IMAGE_TOLERANCE, F.struct("px", "py", "pz")),
    )
    carried = [
        c for c in proximity.columns
        if c not in (*image, "sources", "declared", "donor_class_supported")
    ]
    return (
        joined.groupBy(*image, "__apart")
        .agg(
            F.min_by(F.struct(*carried), F.struct("route", "px", "py", "pz")).alias("row"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("sources"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("declared")))).alias("found"),
            F.bool_and("donor_class_supported").alias("donor_class_supported"),
        )
        .select(
            *image, *[F.col(f"row.{c}").alias(c) for c in carried], "sources",
            F.when(F.size("found") > 0, F.col("found")).cast(DECLARED_TYPE).alias("declared"),
            "donor_class_supported",
        )
        .select(*proximity.columns)
    )


def is_declared() -> Column:
    """Whether a candidate carries at least one declared connection."""
    return F.coalesce(F.size("declared") > 0, F.lit(False)) & F.col("declared").isNotNull()


def donor_rule() -> Column:
    """Which rule decides that an atom may be inferred as a donor by geometry."""
    name, residue = F.upper(F.trim("n_atom_name")), F.col("n_residue_name")
    amino = residue.isin(*vocab.AMINO_ACIDS)
    side_chain = F.lit(False)
    for owner, atoms in vocab.SIDE_CHAIN_DONORS.items():
        if atoms:
            side_chain = side_chain | ((residue == owner) & name.isin(*atoms))
    position = F.coalesce(F.col("n_polymer_position"), F.lit(""))
    return first_label(
        [
            (F.col("n_is_water") & (F.col("n_element") == "O"), "water_oxygen"),
            (F.col("n_is_water") | ~amino, "outside_typical_donor_list"),
            (name == "O", "backbone_carbonyl_oxygen"),
            (side_chain, "typical_sidechain_donor"),
            (position.isin("N", "NC") & name.isin(*vocab.N_TERMINAL_DONORS),
             "n_terminal_nitrogen"),
            (position.isin("C", "NC") & name.isin(*vocab.C_TERMINAL_DONORS),
             "c_terminal_oxygen"),
        ],
        "outside_typical_donor_list",
    )


def with_donor_policy(candidates: DataFrame) -> DataFrame:
    """Add the donor rule, whether it allows inference, and a declared override."""
    ruled = candidates.withColumns(
        {"inferred_donor_rule": donor_rule(), "is_declared": is_declared()}
    ).withColumn(
        "inferred_donor_allowed", F.col("inferred_donor_rule") != "outside_typical_donor_list"
    )
    overridden = (
        F.col("is_declared") & ~F.col("inferred_donor_allowed") & F.col("donor_class_supported")
    )
    return ruled.withColumn(
        "donor_rule_override",
        F.when(overridden, F.lit("declared_connection")).otherwise(F.lit("")),
    )


def reference_key() -> dict[str, Column]:
    """The (residue, donor) literature key of a donor atom; the metal is the third part."""
    name, element = F.trim("n_atom_name"), F.col("n_element")
    water = F.col("n_is_water") & (element == "O")
    return {
        "key_residue": F.when(water, F.lit("HOH"))
        .when(name.isin(*vocab.N_TERMINAL_DONORS), F.lit("NTERM"))
        .when(name.isin(*vocab.C_TERMINAL_DONORS), F.lit("CTERM"))
        .when(name == "O", F.lit("CA"))
        .otherwise(F.col("n_residue_name")),
        "key_donor": F.when(water, F.lit("O"))
        .when(name.isin(*vocab.N_TERMINAL_DONORS), F.lit("N"))
        .when(
            name.isin(*vocab.C_TERMINAL_DONORS) | name.startswith("O"), F.lit("O")
        )
        .otherwise(element),
    }


def with_eligibility(candidates: DataFrame, reference: DataFrame) -> DataFrame:
    """Add the assignment target, cutoff and first-sphere eligibility."""
    keyed = candidates.withColumns(reference_key())
    found = lookup_with_fallback(
        keyed, reference,
        {"key_residue": "residue", "key_donor": "donor", "m_element": "metal"},
        {"m_element": "metal", "n_element": "donor"},
    )
    cutoff = F.when(
        F.col("target").isNotNull(),
        F.least(
            F.lit(vocab.SEARCH_RADIUS), F.col("target") + vocab.FIRST_SPHERE_TOLERANCE
        ),
    )
    sided = found.withColumns(
        {
            "first_sphere_cutoff": cutoff,
            "is_absent": absent("m_") | absent("n_"),
            "assignment_reference": F.when(
                F.col("reference_kind") == "exact",
                F.concat_ws(":", "key_residue", "key_donor", "m_element"),
            )
            .when(
                F.col("reference_kind") == "element_fallback",
                F.concat_ws(":", F.lit("*"), "n_element", "m_element"),
            )
            .otherwise(F.lit("")),
        }
    )
    unreferenced = F.col("first_sphere_cutoff").isNull()
    within = F.col("distance") <= F.col("first_sphere_cutoff") + vocab.SEARCH_EPSILON
    allowed = F.col("inferred_donor_allowed")
    needed = allowed | (F.col("is_declared") & F.col("donor_class_supported"))
    status = first_label(
        [
            (F.col("is_absent"), "zero_occupancy"),
            (unreferenced & needed, "missing_assignment_reference"),
            (unreferenced, "non_typical_donor"),
            (within & allowed, "first_sphere_eligible"),
            (within, "non_typical_donor"),
        ],
        "outside_first_sphere",
    )
    reason = first_label(
        [
            (F.col("is_absent"), "zero_occupancy_atom_is_not_contact_evidence"),
            (unreferenced & needed, "no_metal_donor_assignment_reference"),
            (unreferenced, "atom_not_in_typical_inferred_donor_list"),
            (within & allowed, "distance_within_target_plus_0.75"),
            (within, "atom_not_in_typical_inferred_donor_list"),
        ],
        "distance_exceeds_target_plus_0.75",
    )
    inside = F.coalesce(within & ~F.col("is_absent"), F.lit(False))
    return sided.withColumns(
        {
            "eligibility_status": status,
            "eligibility_reason": reason,
            "first_sphere_eligible": inside,
            "inferred_contact_eligible": inside & allowed,
        }
    ).drop("is_absent")


def metals_without_position(atoms: DataFrame, named: int = 5) -> DataFrame:
    """Per entry, why its geometry is partial: selected metals without finite coordinates.

    ``reason_code`` and a ``message`` that names the first ``named`` sites in
    model order and counts the rest.
    """
    lost = atoms.where(
        is_metal() & (F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull())
    ).select(
        "entry_id", F.struct("chain_index", "residue_index", "atom_index").alias("place"),
        F.concat_ws(
            "/", "residue_name", F.when(F.col("chain_id") == "", "_").otherwise(F.col("chain_id")),
            "resnum", "atom_name",
        ).alias("site"),
    )
    first = lost.withColumn(
        "number", F.row_number().over(Window.partitionBy("entry_id").orderBy("place"))
    ).where(F.col("number") <= named)
    shown = first.groupBy("entry_id").agg(F.array_sort(F.collect_list(F.struct("number", "site"))).alias("sites"))
    counts = lost.groupBy("entry_id").agg(F.count(F.lit(1)).alias("n"))
    rest = F.col("n") - named
    return counts.join(shown, "entry_id").select(
        "entry_id", F.lit("non_finite_metal_coordinates").alias("reason_code"),
        F.concat(
            F.lit("geometry unavailable for selected metal site(s) with non-finite coordinates: "),
            F.array_join(F.transform("sites", lambda s: s["site"]), ", "),
            F.when(rest > 0, F.concat(F.lit(" (and "), rest.cast("string"), F.lit(" more)")))
            .otherwise(F.lit("")),
        ).alias("message"),
    )


def unsupported_pairs(candidates: DataFrame) -> DataFrame:
    """Per entry, the metal-donor pairs no reference covers, sorted and shortened."""
    return _pairs_without_reference(candidates, "m_element", "n_element")


def uncovered_pairs(candidates: DataFrame) -> DataFrame:
    """The same of published candidate rows."""
    return _pairs_without_reference(candidates, "metal_element", "neighbor_element")


def _pairs_without_reference(candidates: DataFrame, metal: str, donor: str) -> DataFrame:
    pairs = candidates.where(
        F.col("eligibility_status") == "missing_assignment_reference"
    ).select("entry_id", F.concat_ws("-", metal, donor).alias("pair")).distinct()
    return pairs.groupBy("entry_id").agg(
        F.array_sort(F.collect_list("pair")).alias("pairs")
    )


def assigned(candidates: DataFrame) -> DataFrame:
    """Inferred contacts, and declared ones that could be assessed."""
    declared = (
        F.col("is_declared")
        & F.col("donor_class_supported")
        & (F.col("eligibility_status") != "zero_occupancy")
    )
    return candidates.where(F.col("inferred_contact_eligible") | declared)


def collapse_images(
    contacts: DataFrame,
    keys: tuple[str, ...] = (*SITE, *DONOR),
    preference: tuple[str, ...] = (
        "symmetry_contact", "distance", "image_index", "tx", "ty", "tz", "px", "py", "pz",
    ),
    position: tuple[str, str, str] = ("px", "py", "pz"),
    cutoff: float = vocab.SPECIAL_POSITION_CUTOFF,
    merged: tuple[str, ...] = ("sources", "declared"),
) -> DataFrame:
    """Collapse near-coincident images of one deposited atom around one metal.

    Images are visited in ``preference`` order; one within ``cutoff`` of an
    image already kept gives it its provenance and disappears. A group holds
    one image per symmetry operation, so it is small by nature.
    """
    rest = [c for c in contacts.columns if c not in keys and c not in preference]
    row = F.struct(*preference, *rest)
    grouped = contacts.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("images"))

    def step(kept: Column, image: Column) -> Column:
        near = F.transform(
            kept,
            lambda k: distance(
                tuple(k[c] for c in position), tuple(image[c] for c in position)
            ) <= cutoff,
        )
        at = F.array_position(near, True)

        def absorb(k: Column, index: Column) -> Column:
            widened = k
            for name in merged:
                union = F.array_union(
                    F.coalesce(k[name], F.array()), F.coalesce(image[name], F.array())
                )
                widened = widened.withField(name, F.when(F.size(union) > 0, union))
            return F.when(index + 1 == at, widened).otherwise(k)

        return F.when(at > 0, F.transform(kept, absorb) if merged else kept).otherwise(
            F.concat(kept, F.array(image))
        )

    lone = F.size("images") == 1
    folded = F.when(lone, F.col("images")).otherwise(
        F.aggregate("images", F.slice("images", 1, 0), step)
    )
    flat = grouped.select(*keys, F.explode(folded).alias("image"))
    return flat.select(
        *[F.col(c) if c in keys else F.col(f"image.{c}").alias(c) for c in contacts.columns]
    )


def with_geometry(contacts: DataFrame, precision: str = "dpi") -> DataFrame:
    """Add the raw z-score's verdicts and the published distance and z-score."""
    raw = contacts.withColumn(
        "zscore_raw", bond_zscore("distance", "mu", "sigma", precision)
    )
    rounded = with_rounded(
        raw, {"reported_distance": ("distance", 3), "zscore": ("zscore_raw", 4)}
    )
    outlier = is_outlier("zscore_raw")
    return rounded.withColumns(
        {
            "reference_covered": F.col("mu").isNotNull(),
            "geometry_outlier": outlier,
            "geometry_consistent": ~outlier,
            "score_eligible": F.col("zscore_raw").isNotNull(),
            "score_exclusion_reason": F.when(
                F.col("zscore_raw").isNull(), F.lit("zscore_unavailable")
            ).otherwise(F.lit("")),
        }
    )


def group_status(count: Column, any_outlier: Column, all_consistent: Column) -> Column:
    """The verdict on contacts that share one residue image."""
    return first_label(
        [
            (count < 2, "single_donor"),
            (all_consistent, "consistent"),
            (any_outlier, "suspect"),
        ],
        "indeterminate",
    )


def residue_groups(contacts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per donor-residue image: size, status, and whether it is suspect."""
    summed = contacts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("multi_donor_contact_count"),
        F.bool_or(F.coalesce(F.col("geometry_outlier"), F.lit(False))).alias("any_outlier"),
        F.bool_and(F.coalesce(F.col("geometry_consistent"), F.lit(False))).alias("all_consistent"),
    )
    told = _group_columns(F.col("any_outlier"), F.col("all_consistent"))
    return summed.select(
        *keys, "multi_donor_contact_count", *[c.alias(name) for name, c in told.items()])


def _group_columns(any_outlier: Column, all_consistent: Column) -> dict[str, Column]:
    """What the size of a residue group and its contacts' verdicts tell."""
    count = F.col("multi_donor_contact_count")
    return {
        "multi_donor_detected": count >= 2,
        "multi_donor_geometry_status": group_status(count, any_outlier, all_consistent),
        "multi_donor_contains_suspect_bond": (count >= 2) & any_outlier,
    }


def with_groups(
    contacts: DataFrame, keys: tuple[str, ...] = (*SITE, *RESIDUE_IMAGE)
) -> DataFrame:
    """Add the residue-group columns of :func:`residue_groups` to every contact.

    A group is one residue image around one metal, so each is settled in place.
    """
    group = Window.partitionBy(*keys)
    outlier, consistent = (
        F.coalesce(F.col(c), F.lit(False)) for c in ("geometry_outlier", "geometry_consistent"))
    counted = contacts.withColumns({
        "multi_donor_contact_count": F.count(F.lit(1)).over(group),
        "__any_outlier": F.bool_or(outlier).over(group),
        "__all_consistent": F.bool_and(consistent).over(group),
    })
    return counted.withColumns(
        _group_columns(F.col("__any_outlier"), F.col("__all_consistent"))
    ).drop("__any_outlier", "__all_consistent")


def contact_reasons(assigned_row: bool) -> Column:
    """Context reasons of one contact, or of a candidate row when not assigned."""
    off_list = ~F.col("inferred_donor_allowed")
    declared, inside = F.col("is_declared"), F.col("first_sphere_eligible")
    pairs = [
        (absent("n_"), "zero_occupancy_neighbor"),
        (off_list & declared, "declared_non_typical_donor"),
        (off_list & ~declared & inside, "non_typical_first_sphere_candidate"),
    ]
    if assigned_row:
        pairs.append((F.col("multi_donor_contains_suspect_bond"), "suspect_multi_donor_group"))
    else:
        pairs.append((off_list & ~declared & ~inside, "non_typical_proximal_candidate"))
    return labels(pairs)


COUNT_COLUMNS = (
    "candidate_contact_count", "reference_covered_contact_count",
    "geometry_outlier_contact_count", "geometry_consistent_contact_count",
    "score_eligible_contact_count", "score_excluded_contact_count",
    "scored_geometry_outlier_contact_count", "scored_geometry_consistent_contact_count",
    "multi_donor_residue_group_count", "multi_donor_contact_count",
    "suspect_multi_donor_residue_group_count", "indeterminate_multi_donor_residue_group_count",
)


def geometry_status(outliers: Column, consistent: Column) -> Column:
    """The site's geometry verdict from its scored contacts."""
    return first_label(
        [(outliers + consistent == 0, "insufficient data"), (outliers > 0, "suspect")],
        "plausible",
    )


def scope_summary(
    contacts: DataFrame,
    site: tuple[str, ...] = SITE,
    residue: tuple[str, ...] = RESIDUE_IMAGE,
) -> DataFrame:
    """Contact counts, coverage and status of each site in one search scope."""
    outlier = F.coalesce(F.col("geometry_outlier"), F.lit(False))
    consistent = F.coalesce(F.col("geometry_consistent"), F.lit(False))
    eligible = F.col("score_eligible")
    counted = contacts.groupBy(*site).agg(
        F.count(F.lit(1)).alias("candidate_contact_count"),
        F.count_if("reference_covered").alias("reference_covered_contact_count"),
        F.count_if(outlier).alias("geometry_outlier_contact_count"),
        F.count_if(consistent).alias("geometry_consistent_contact_count"),
        F.count_if(eligible).alias("score_eligible_contact_count"),
        F.count_if(~eligible).alias("score_excluded_contact_count"),
        F.count_if(eligible & outlier).alias("scored_geometry_outlier_contact_count"),
        F.count_if(eligible & consistent).alias("scored_geometry_consistent_contact_count"),
    )
    groups = residue_groups(contacts, (*site, *residue)).groupBy(*site).agg(
        F.count_if("multi_donor_detected").alias("multi_donor_residue_group_count"),
        F.coalesce(
            F.sum(F.when(F.col("multi_donor_detected"), F.col("multi_donor_contact_count"))),
            F.lit(0),
        ).alias("multi_donor_contact_count"),
        F.count_if(F.col("multi_donor_geometry_status") == "suspect").alias(
            "suspect_multi_donor_residue_group_count"
        ),
        F.count_if(F.col("multi_donor_geometry_status") == "indeterminate").alias(
            "indeterminate_multi_donor_residue_group_count"
        ),
    )
    summary = counted.join(groups, list(site))
    ratio = F.col("reference_covered_contact_count") / F.col("candidate_contact_count")
    return with_rounded(summary, {"geometry_coverage": (ratio, 4)}).withColumn(
        "geometry_status",
        geometry_status(
            F.col("scored_geometry_outlier_contact_count"),
            F.col("scored_geometry_consistent_contact_count"),
        ),
    )


def empty_scope(summary: DataFrame, searched: Column) -> DataFrame:
    """Zero counts for a site searched in vain; nulls for one never searched."""
    zero = F.when(searched, F.lit(0).cast("long"))
    return summary.withColumns(
        {
            **{c: F.coalesce(F.col(c), zero) for c in COUNT_COLUMNS},
            "geometry_status": F.coalesce(
                F.col("geometry_status"), F.when(searched, F.lit("insufficient data"))
            ),
        }
    )


def image_counts(contacts: DataFrame, site: tuple[str, ...] = SITE) -> DataFrame:
    """Generated contacts of each site by provenance."""
    crystal, ncs = F.col("crystallographic_contact"), F.col("strict_ncs_contact")
    return contacts.groupBy(*site).agg(
        F.count_if(crystal | ncs).alias("symmetry_contact_count"),
        F.count_if(crystal).alias("crystallographic_contact_count"),
        F.count_if(ncs).alias("strict_ncs_contact_count"),
        F.count_if(crystal & ncs).alias("combined_ncs_crystallographic_contact_count"),
    )


def site_context(
    contacts: DataFrame,
    candidates: DataFrame,
    order: tuple[str, ...] = (*DONOR, "image_index", "tx", "ty", "tz"),
    site: tuple[str, ...] = SITE,
) -> DataFrame:
    """Ordered distinct context reasons and the counts behind them, per site."""
    reasoned = contacts.withColumn("reasons", contact_reasons(True))
    firsts, assembled = first_seen_labels(
        F.col("reasons"), vocab.CONTEXT_REASONS, list(order)
    )
    from_contacts = reasoned.groupBy(*site).agg(
        *firsts,
        F.count_if(F.col("donor_rule_override") == "declared_connection").alias("overrides"),
    ).select(*site, assembled.alias("reasons"), "overrides")
    off_list = candidates.groupBy(*site).agg(
        F.count_if(
            ~F.col("inferred_donor_allowed") & F.col("first_sphere_eligible")
        ).alias("off_list")
    )
    none = F.array().cast("array<string>")
    joined = from_contacts.join(off_list, list(site), "full_outer")
    extra = F.when(
        F.col("off_list") > 0, F.array(F.lit("non_typical_first_sphere_candidate"))
    ).otherwise(none)
    reasons = F.array_union(F.coalesce(F.col("reasons"), none), extra)
    return joined.select(
        *site,
        (F.size(reasons) > 0).alias("context_warning"),
        reasons.alias("context_warning_reasons"),
        F.coalesce("off_list", F.lit(0)).alias("non_typical_first_sphere_candidate_count"),
        F.coalesce("overrides", F.lit(0)).alias("declared_donor_override_contact_count"),
    )


def donor_b_factors(
    contacts: DataFrame, site: tuple[str, ...] = SITE, metal_b: str = "m_b_iso",
    donor_b: str = "n_b_iso",
) -> DataFrame:
    """Median donor B factor of each site compared with the metal's own."""
    medians = exact_median(contacts, list(site), donor_b, "median_b")
    owners = contacts.groupBy(*site).agg(F.max(metal_b).alias("metal_b"))
    joined = owners.join(medians, list(site), "left")
    compared = with_rounded(joined, metal_donor_comparison("metal_b", "median_b"))
    return compared.select(
        *site,
        F.coalesce("median_b_count", F.lit(0)).alias("donor_b_iso_count"),
        "donor_median_b_iso", "metal_donor_b_ratio", "metal_minus_donor_b_iso",
        "metal_donor_b_similarity",
    )


def not_assessed_reason(
    precision_reason: Column, searched: Column, assessable: Column, finite_metal: Column
) -> Column:
    """Why a site's geometry could not be assessed, pipe-joined; blank when it was."""
    reasons = F.array_distinct(
        F.concat(
            F.filter(F.array(precision_reason), lambda r: r != ""),
            labels(
                [
                    (~searched, "symmetry_search_unavailable"),
                    (assessable == 0, "no_assessable_reference_contacts"),
                ]
            ),
        )
    )
    return F.when(finite_metal, F.array_join(reasons, "|")).otherwise(
        F.lit("non_finite_metal_coordinates")
    )


def coordination_status(declared: Column, inferred: Column) -> Column:
    """How a contact came to be assigned."""
    return first_label([(declared, "declared"), (inferred, "inferred")], "unassigned")


def with_neighbor_class(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Add the coarse chemical class of a donor residue; ``other`` if no class is told.

    ``classes`` holds ``residue_name, residue_class``, one row per component.
    """
    named = classes.select(
        F.col("residue_name").alias("n_residue_name"), F.col("residue_class").alias("__class"))
    return rows.join(named, "n_residue_name", "left").withColumn(
        "neighbor_class",
        F.when(F.col("n_is_water"), F.lit("water")).otherwise(F.coalesce("__class", F.lit("other"))),
    ).drop("__class")
