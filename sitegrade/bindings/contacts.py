"""Contact queries: radius joins, eligibility, geometry and site summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.bindings.common import Query, derived, exact_sql, fixed, fixed_sql, table
from sitegrade.bindings.inventory import SELECTION_CTE, selected_atoms, source_atoms
from sitegrade.functions.clean import bounded_list
from sitegrade.functions.geometry import cell_volume, generated_scope, orthogonal_matrix, site_symmetry
from sitegrade.operators import contacts as con
from sitegrade.operators.inventory import overfull_sites
from sitegrade.operators.lookup import literature, residue_classes
from sitegrade.operators.radius import coincident_images, nearest_neighbors, radius_join
from sitegrade.session import cut_lineage, stored

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_METALS = ", ".join(f"'{m}'" for m in vocab.METALS)
_AMINO = ", ".join(f"'{a}'" for a in vocab.AMINO_ACIDS)
_LITERATURE = ", ".join(
    "('{}', '{}', '{}', {}e0, {}e0)".format(*line.split())
    for line in vocab.literature_lines() if line[:1] != "#" and not line.startswith("residue")
)

#: Unit cells: even entries orthorhombic, odd ones monoclinic.
CELLS = """
SELECT DISTINCT concat('e', CAST(CAST(floor(l_orderkey / 40) AS BIGINT) AS STRING)) AS entry_id,
  CAST(floor(l_orderkey / 40) AS BIGINT) AS entry_no,
  20e0 AS a, 19e0 AS b, 18e0 AS c, 90e0 AS alpha,
  CASE WHEN CAST(floor(l_orderkey / 40) AS BIGINT) % 2 = 0 THEN 90e0 ELSE 105e0 END AS beta, 90e0 AS gamma
FROM {lineitem}
"""
#: Symmetry operations: four or two crystal ones, and an NCS copy of the whole
#: set for every fifth entry. The last column says which entries use a row.
_BASE_OPS = (
    # index, diagonal of R, translation, parity of the entries
    (0, (1, 1, 1), (0.0, 0.0, 0.0), 0), (1, (-1, -1, 1), (0.5, 0.0, 0.5), 0),
    (2, (-1, 1, -1), (0.0, 0.5, 0.5), 0), (3, (1, -1, -1), (0.5, 0.5, 0.0), 0),
    (0, (1, 1, 1), (0.0, 0.0, 0.0), 1), (1, (-1, 1, -1), (0.0, 0.5, 0.0), 1),
)
_NCS_DIAGONAL, _NCS_SHIFT = (-1, -1, 1), (0.37, 0.21, 0.13)


def _operation_rows() -> list[tuple]:
    rows = []
    for index, diagonal, shift, parity in _BASE_OPS:
        rows.append((index, False, *(float(d) for d in diagonal), *shift, parity))
        count = 4 if parity == 0 else 2
        turned = tuple(float(d * n) for d, n in zip(diagonal, _NCS_DIAGONAL))
        moved = tuple(d * n + s for d, n, s in zip(diagonal, _NCS_SHIFT, shift))
        rows.append((index + count, True, *turned, *moved, parity))
    return rows


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unit cell per derived entry, with its orthogonalization columns; found once."""
    raw = derived(spark, sf_dir, CELLS)
    sides = [F.col(c) for c in ("a", "b", "c", "alpha", "beta", "gamma")]
    return stored(raw).withColumns(orthogonal_matrix(*sides))


def operations(spark: SparkSession, sf_dir: str, frame: DataFrame | None = None) -> DataFrame:
    """The symmetry operations of every derived entry, or of those in ``frame``."""
    rows = spark.createDataFrame(
        _operation_rows(),
        "image_index int, is_ncs boolean, r11 double, r22 double, r33 double,"
        " t1 double, t2 double, t3 double, parity long",
    ).withColumns({c: F.lit(0.0) for c in ("r12", "r13", "r21", "r23", "r31", "r32")})
    owners = (cells(spark, sf_dir) if frame is None else frame).select("entry_id", "entry_no")
    joined = owners.join(F.broadcast(rows), F.pmod("entry_no", F.lit(2)) == F.col("parity"))
    return joined.where(~F.col("is_ncs") | (F.col("entry_no") % 5 == 0)).drop("parity")


def contact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected atoms, stored once for the searches that read them twice."""
    return stored(selected_atoms(spark, sf_dir).drop("extra_records"))


def searched_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metals and donors among the selected atoms: all that a contact search reads."""
    return stored(con.searched(selected_atoms(spark, sf_dir)))


def explicit_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated candidates of the explicit scope."""
    atoms = searched_atoms(spark, sf_dir)
    found = con.explicit_candidates(con.metals_of(atoms), con.donors_of(atoms))
    return con.with_eligibility(con.with_donor_policy(found), literature(spark))


def explicit_contacts(
    spark: SparkSession, sf_dir: str, stage: DataFrame | None = None
) -> DataFrame:
    """Assigned contacts of the explicit scope, scored, grouped and stored once."""
    stage = explicit_stage(spark, sf_dir) if stage is None else stage
    precise = stage.withColumn(
        "dpi",
        0.05 + F.pmod(F.regexp_extract("entry_id", r"(\d+)", 1).cast("long"), F.lit(10)) / 100,
    )
    kept = con.collapse_images(con.assigned(precise))
    return stored(con.with_groups(con.with_geometry(kept)))


#: Explicit candidates and contacts in SQL.
CONTACT_CTE = f"""{SELECTION_CTE},
lit(residue, donor, metal, mu, sigma) AS (VALUES {_LITERATURE}),
coarse AS (SELECT metal, donor, max(mu) AS far FROM lit GROUP BY ALL),
metals AS (SELECT * FROM atoms WHERE element IN ({_METALS}) AND NOT coalesce(ok AND occupancy = 0, FALSE)
           AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL),
donors AS (SELECT * FROM atoms WHERE element IN ('N', 'O', 'S') AND (is_water OR residue_name IN ({_AMINO}))
           AND ok AND occupancy > 0 AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL),
pairs AS (
  SELECT m.entry_id, m.entry_no, m.chain_index AS mc, m.residue_index AS mr, m.atom_index AS ma,
    m.element AS me, m.b_iso AS mb, n.chain_index AS nc, n.residue_index AS nr, n.atom_index AS na,
    n.atom_name, n.residue_name, n.element AS ne, n.b_iso AS nb, n.is_water, n.polymer_position AS pos,
    sqrt((m.x - n.x) * (m.x - n.x) + (m.y - n.y) * (m.y - n.y) + (m.z - n.z) * (m.z - n.z)) AS d
  FROM metals m JOIN donors n ON m.entry_id = n.entry_id
  WHERE NOT (m.chain_index = n.chain_index AND m.residue_index = n.residue_index)
),
ruled AS (
  SELECT *, CASE
    WHEN is_water THEN CASE WHEN ne = 'O' THEN 'water_oxygen' ELSE 'outside_typical_donor_list' END
    WHEN atom_name = 'O' THEN 'backbone_carbonyl_oxygen'
    WHEN residue_name || ' ' || atom_name IN ('ASN OD1', 'ASP OD1', 'ASP OD2', 'CYS SG', 'GLN OE1',
      'GLU OE1', 'GLU OE2', 'HIS ND1', 'HIS NE2', 'LYS NZ', 'MET SD', 'SER OG', 'THR OG1', 'TYR OH')
      THEN 'typical_sidechain_donor'
    WHEN atom_name = 'N' AND pos IN ('N', 'NC') THEN 'n_terminal_nitrogen'
    WHEN atom_name IN ('OXT', 'OT1', 'OT2') AND pos IN ('C', 'NC') THEN 'c_terminal_oxygen'
    ELSE 'outside_typical_donor_list' END AS rule,
    CASE WHEN is_water AND ne = 'O' THEN 'HOH' WHEN atom_name = 'N' THEN 'NTERM'
      WHEN atom_name IN ('OXT', 'OT1', 'OT2') THEN 'CTERM' WHEN atom_name = 'O' THEN 'CA'
      ELSE residue_name END AS key_residue,
    CASE WHEN atom_name = 'N' THEN 'N' WHEN atom_name LIKE 'O%' THEN 'O' ELSE ne END AS key_donor
  FROM pairs WHERE d > 0 AND d <= 4.000000001e0
),
cand AS (
  SELECT r.*, rule <> 'outside_typical_donor_list' AS allowed, l.mu, l.sigma,
    coalesce(l.mu, c.far) AS target,
    CASE WHEN l.mu IS NOT NULL THEN 'exact' WHEN c.far IS NOT NULL THEN 'element_fallback'
         ELSE 'missing' END AS reference_kind,
    least(4e0, coalesce(l.mu, c.far) + 0.75e0) AS cut0
  FROM ruled r
  LEFT JOIN lit l ON l.residue = key_residue AND l.donor = key_donor AND l.metal = me
  LEFT JOIN coarse c ON c.metal = me AND c.donor = ne
),
judged AS (
  SELECT *, CASE WHEN target IS NOT NULL THEN cut0 END AS cutoff,
    coalesce(target IS NOT NULL AND d <= cut0 + 1e-6, FALSE) AS inside
  FROM cand
),
scored AS (
  SELECT *, CASE WHEN mu IS NOT NULL THEN
      (d - mu) / sqrt((0.05e0 + (entry_no % 10) / 100e0) * (0.05e0 + (entry_no % 10) / 100e0) + sigma * sigma) END AS z
  FROM judged WHERE inside AND allowed
)"""


# ---- generic radius joins ------------------------------------------------------
def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label",
        *[F.col("embedding")[i].cast("double").alias(a) for i, a in enumerate("xyz")],
    )


def radius_join_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as points of their first three components, labels as entries."""
    points = _points(spark, sf_dir)
    left = points.where(F.col("vec_id") % 10 == 0).selectExpr(
        "label", "vec_id AS metal", "x AS mx", "y AS my", "z AS mz"
    )
    right = points.where(F.col("vec_id") % 10 != 0).withColumnRenamed("vec_id", "donor")
    found = radius_join(left, right, 0.1, ["label"], ["mx", "my", "mz"], ["x", "y", "z"])
    return found.select("label", "metal", "donor", fixed("distance").alias("distance"))


_POINTS_SQL = """p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x,
  CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)"""
_GAP = "sqrt((m.x - n.x) * (m.x - n.x) + (m.y - n.y) * (m.y - n.y) + (m.z - n.z) * (m.z - n.z))"
QUERIES["radius_join_3d"] = radius_join_3d
ORACLES["radius_join_3d"] = f"""
WITH {_POINTS_SQL}
SELECT m.label, m.vec_id AS metal, n.vec_id AS donor, {fixed_sql(_GAP)} AS distance
FROM p m JOIN p n ON m.label = n.label
WHERE m.vec_id % 10 = 0 AND n.vec_id % 10 <> 0 AND {_GAP} <= 0.1e0
"""


def nearest_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest_neighbors(
        _points(spark, sf_dir), ["label"], ["vec_id"], ["x", "y", "z"], 0.1
    )
    return found.select(
        "vec_id", fixed("nearest_distance").alias("nearest_distance"), "nearest_vec_id",
        "near_count",
    )


QUERIES["nearest_site"] = nearest_site
ORACLES["nearest_site"] = f"""
WITH {_POINTS_SQL},
d AS (SELECT m.vec_id, n.vec_id AS other, {_GAP} AS d FROM p m JOIN p n
      ON m.label = n.label AND m.vec_id <> n.vec_id)
SELECT p.vec_id, {fixed_sql("min(d)")} AS nearest_distance,
  arg_min(other, (d, other)) AS nearest_vec_id,
  count(*) FILTER (d <= 0.1e0) AS near_count
FROM p LEFT JOIN d ON p.vec_id = d.vec_id GROUP BY p.vec_id
"""


def nearest_metal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each metal's nearest other metal of its entry and the count within 6 A."""
    metals = con.metals_of(searched_atoms(spark, sf_dir)).select(
        "entry_id", "m_chain_index", "m_residue_index", "m_atom_index", "m_x", "m_y", "m_z",
        "m_element",
    )
    found = nearest_neighbors(
        metals, ["entry_id"], ["m_chain_index", "m_residue_index", "m_atom_index"],
        ["m_x", "m_y", "m_z"], vocab.NEARBY_METAL_RADIUS + vocab.SEARCH_EPSILON,
    )
    return found.select(
        "entry_id", "m_atom_index", fixed("nearest_distance", 5).alias("nearest_distance"),
        "nearest_m_atom_index", F.col("near_count").alias("nearby_metal_count_6a"),
    )


QUERIES["nearest_metal"] = nearest_metal
ORACLES["nearest_metal"] = f"""
WITH {CONTACT_CTE},
d AS (SELECT m.entry_id, m.chain_index, m.residue_index, m.atom_index, n.chain_index AS nc,
        n.residue_index AS nr, n.atom_index AS na, {_GAP} AS d
      FROM metals m JOIN metals n ON m.entry_id = n.entry_id
      AND NOT (m.chain_index = n.chain_index AND m.residue_index = n.residue_index AND m.atom_index = n.atom_index))
SELECT m.entry_id, m.atom_index AS m_atom_index, {fixed_sql("min(d)", 5)} AS nearest_distance,
  arg_min(na, (d, nc, nr, na)) AS nearest_m_atom_index,
  count(*) FILTER (d <= 6.000001e0) AS nearby_metal_count_6a
FROM metals m LEFT JOIN d USING (entry_id, chain_index, residue_index, atom_index)
GROUP BY m.entry_id, m.chain_index, m.residue_index, m.atom_index
"""


# ---- candidates ----------------------------------------------------------------
def contact_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = con.with_neighbor_class(explicit_stage(spark, sf_dir), residue_classes(spark))
    return stage.select(
        "entry_id", "m_atom_index", "n_atom_index", fixed("distance").alias("distance"),
        "inferred_donor_rule", "reference_kind", "assignment_reference",
        fixed("target").alias("target"), fixed("first_sphere_cutoff").alias("cutoff"),
        "eligibility_status", "eligibility_reason", "first_sphere_eligible",
        "inferred_contact_eligible",
        F.array_join(con.contact_reasons(False), "|").alias("context_reasons"),
        "neighbor_class",
    )


QUERIES["contact_candidates"] = contact_candidates
ORACLES["contact_candidates"] = f"""
WITH {CONTACT_CTE}
SELECT entry_id, ma AS m_atom_index, na AS n_atom_index, {fixed_sql("d")} AS distance,
  rule AS inferred_donor_rule, reference_kind,
  CASE reference_kind WHEN 'exact' THEN key_residue || ':' || key_donor || ':' || me
    WHEN 'element_fallback' THEN '*:' || ne || ':' || me ELSE '' END AS assignment_reference,
  {fixed_sql("target")} AS target, {fixed_sql("cutoff")} AS cutoff,
  CASE WHEN target IS NULL THEN CASE WHEN allowed THEN 'missing_assignment_reference' ELSE 'non_typical_donor' END
    WHEN inside THEN CASE WHEN allowed THEN 'first_sphere_eligible' ELSE 'non_typical_donor' END
    ELSE 'outside_first_sphere' END AS eligibility_status,
  CASE WHEN target IS NULL THEN CASE WHEN allowed THEN 'no_metal_donor_assignment_reference'
         ELSE 'atom_not_in_typical_inferred_donor_list' END
    WHEN inside THEN CASE WHEN allowed THEN 'distance_within_target_plus_0.75'
         ELSE 'atom_not_in_typical_inferred_donor_list' END
    ELSE 'distance_exceeds_target_plus_0.75' END AS eligibility_reason,
  inside AS first_sphere_eligible, inside AND allowed AS inferred_contact_eligible,
  CASE WHEN allowed THEN '' WHEN inside THEN 'non_typical_first_sphere_candidate'
    ELSE 'non_typical_proximal_candidate' END AS context_reasons,
  CASE WHEN is_water THEN 'water' ELSE 'amino_acid' END AS neighbor_class
FROM judged
"""


def unsupported_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.unsupported_pairs(explicit_stage(spark, sf_dir)).select(
        "entry_id", F.size("pairs").cast("long").alias("n"), bounded_list(F.col("pairs"), 5).alias("pairs")
    )


QUERIES["unsupported_pairs"] = unsupported_pairs
ORACLES["unsupported_pairs"] = f"""
WITH {CONTACT_CTE},
u AS (SELECT DISTINCT entry_id, me || '-' || ne AS pair FROM judged WHERE target IS NULL AND allowed),
l AS (SELECT entry_id, list(pair ORDER BY pair) AS ps FROM u GROUP BY entry_id)
SELECT entry_id, len(ps) AS n, array_to_string(ps[1:5], ', ')
  || CASE WHEN len(ps) > 5 THEN ' (and ' || (len(ps) - 5) || ' more)' ELSE '' END AS pairs
FROM l
"""


def metals_without_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.metals_without_position(selected_atoms(spark, sf_dir))


QUERIES["metals_without_position"] = metals_without_position
ORACLES["metals_without_position"] = f"""
WITH {CONTACT_CTE},
lost AS (SELECT entry_id, residue_name || '/' || chain_id || '/' || resnum || '/' || atom_name AS site,
    row_number() OVER (PARTITION BY entry_id ORDER BY chain_index, residue_index, atom_index) AS k
  FROM atoms WHERE element IN ({_METALS}) AND NOT coalesce(ok AND occupancy = 0, FALSE)
    AND (x IS NULL OR y IS NULL OR z IS NULL))
SELECT entry_id, 'non_finite_metal_coordinates' AS reason_code,
  'geometry unavailable for selected metal site(s) with non-finite coordinates: '
  || string_agg(CASE WHEN k <= 5 THEN site END, ', ' ORDER BY k)
  || CASE WHEN count(*) > 5 THEN ' (and ' || (count(*) - 5) || ' more)' ELSE '' END AS message
FROM lost GROUP BY entry_id
"""


# ---- contacts, groups, summaries -----------------------------------------------
def bond_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explicit_contacts(spark, sf_dir).select(
        "entry_id", "m_atom_index", "n_atom_index", "reported_distance", "zscore",
        "reference_covered", "geometry_outlier", "geometry_consistent", "score_eligible",
        "score_exclusion_reason", "multi_donor_detected", "multi_donor_contact_count",
        "multi_donor_geometry_status", "multi_donor_contains_suspect_bond",
        F.array_join(con.contact_reasons(True), "|").alias("context_reasons"),
    )


_GROUPS_SQL = """grouped AS (
  SELECT *, abs(z) >= 6 AS far,
    count(*) OVER w AS size, coalesce(bool_or(abs(z) >= 6) OVER w, FALSE) AS any_far,
    bool_and(coalesce(abs(z) < 6, FALSE)) OVER w AS all_near
  FROM scored WINDOW w AS (PARTITION BY entry_id, mc, mr, ma, nc, nr)
),
statused AS (
  SELECT *, CASE WHEN size < 2 THEN 'single_donor' WHEN all_near THEN 'consistent'
    WHEN any_far THEN 'suspect' ELSE 'indeterminate' END AS status FROM grouped
)"""
QUERIES["bond_geometry"] = bond_geometry
ORACLES["bond_geometry"] = f"""
WITH {CONTACT_CTE}, {_GROUPS_SQL}
SELECT entry_id, ma AS m_atom_index, na AS n_atom_index, {exact_sql("d", 3)} AS reported_distance,
  {exact_sql("z", 4)} AS zscore, mu IS NOT NULL AS reference_covered, far AS geometry_outlier,
  NOT far AS geometry_consistent, z IS NOT NULL AS score_eligible,
  CASE WHEN z IS NULL THEN 'zscore_unavailable' ELSE '' END AS score_exclusion_reason,
  size >= 2 AS multi_donor_detected, size AS multi_donor_contact_count,
  status AS multi_donor_geometry_status, size >= 2 AND any_far AS multi_donor_contains_suspect_bond,
  CASE WHEN size >= 2 AND any_far THEN 'suspect_multi_donor_group' ELSE '' END AS context_reasons
FROM statused
"""


def residue_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sites and suppliers as residues: groups of contacts and their status."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey",
        F.when(F.col("l_tax") > 0, F.col("l_discount") >= 0.08).alias("geometry_outlier"),
    ).withColumn("geometry_consistent", ~F.col("geometry_outlier"))
    return con.residue_groups(lines, ("l_orderkey", "l_suppkey"))


QUERIES["residue_groups"] = residue_groups
ORACLES["residue_groups"] = """
WITH l AS (SELECT l_orderkey, l_suppkey, CASE WHEN l_tax > 0 THEN l_discount >= 0.08e0 END AS o FROM lineitem),
g AS (SELECT l_orderkey, l_suppkey, count(*) AS n, count(*) FILTER (o) AS bad,
        count(*) FILTER (NOT o) AS good FROM l GROUP BY ALL)
SELECT l_orderkey, l_suppkey, n AS multi_donor_contact_count, n >= 2 AS multi_donor_detected,
  CASE WHEN n < 2 THEN 'single_donor' WHEN good = n THEN 'consistent' WHEN bad > 0 THEN 'suspect'
       ELSE 'indeterminate' END AS multi_donor_geometry_status,
  n >= 2 AND bad > 0 AS multi_donor_contains_suspect_bond
FROM g
"""


def scope_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.scope_summary(explicit_contacts(spark, sf_dir))


QUERIES["scope_summary"] = scope_summary
ORACLES["scope_summary"] = f"""
WITH {CONTACT_CTE}, {_GROUPS_SQL},
s AS (
  SELECT entry_id, mc AS m_chain_index, mr AS m_residue_index, ma AS m_atom_index,
    count(*) AS candidate_contact_count, count(mu) AS reference_covered_contact_count,
    count(*) FILTER (far) AS geometry_outlier_contact_count,
    count(*) FILTER (NOT far) AS geometry_consistent_contact_count,
    count(z) AS score_eligible_contact_count, count(*) - count(z) AS score_excluded_contact_count,
    count(*) FILTER (far) AS scored_geometry_outlier_contact_count,
    count(*) FILTER (NOT far) AS scored_geometry_consistent_contact_count,
    count(DISTINCT CASE WHEN size >= 2 THEN nc || '/' || nr END) AS multi_donor_residue_group_count,
    count(*) FILTER (size >= 2) AS multi_donor_contact_count,
    count(DISTINCT CASE WHEN status = 'suspect' THEN nc || '/' || nr END) AS suspect_multi_donor_residue_group_count,
    count(DISTINCT CASE WHEN status = 'indeterminate' THEN nc || '/' || nr END) AS indeterminate_multi_donor_residue_group_count
  FROM statused GROUP BY ALL
)
SELECT *, {exact_sql("(reference_covered_contact_count / candidate_contact_count)", 4)} AS geometry_coverage,
  CASE WHEN score_eligible_contact_count = 0 THEN 'insufficient data'
       WHEN geometry_outlier_contact_count > 0 THEN 'suspect' ELSE 'plausible' END AS geometry_status
FROM s
"""


def site_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = cut_lineage(explicit_stage(spark, sf_dir))
    context = con.site_context(explicit_contacts(spark, sf_dir, stage), stage)
    return context.withColumn(
        "context_warning_reasons", F.array_join("context_warning_reasons", "|")
    )


QUERIES["site_context"] = site_context
ORACLES["site_context"] = f"""
WITH {CONTACT_CTE}, {_GROUPS_SQL},
c AS (SELECT entry_id, mc, mr, ma, count(*) FILTER (NOT allowed AND inside) AS off FROM judged GROUP BY ALL),
g AS (SELECT entry_id, mc, mr, ma, bool_or(size >= 2 AND any_far) AS bad FROM statused GROUP BY ALL)
SELECT entry_id, mc AS m_chain_index, mr AS m_residue_index, ma AS m_atom_index,
  coalesce(bad, FALSE) OR off > 0 AS context_warning,
  concat_ws('|', CASE WHEN bad THEN 'suspect_multi_donor_group' END,
    CASE WHEN off > 0 THEN 'non_typical_first_sphere_candidate' END) AS context_warning_reasons,
  off AS non_typical_first_sphere_candidate_count, CAST(0 AS BIGINT) AS declared_donor_override_contact_count
FROM c LEFT JOIN g USING (entry_id, mc, mr, ma)
"""


def donor_b_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    # exp and ln differ in the last bit between engines, hence one decimal less.
    return con.donor_b_factors(explicit_contacts(spark, sf_dir)).withColumn(
        "metal_donor_b_similarity", fixed("metal_donor_b_similarity", 3)
    )


QUERIES["donor_b_factors"] = donor_b_factors
ORACLES["donor_b_factors"] = f"""
WITH {CONTACT_CTE},
s AS (SELECT entry_id, mc, mr, ma, count(nb) AS n, median(nb) AS b, max(mb) AS m FROM scored GROUP BY ALL),
r AS (SELECT *, CASE WHEN m > 0 AND b > 0 THEN m / b END AS q, m - b AS diff,
        exp(-abs(ln(CASE WHEN m > 0 AND b > 0 THEN m / b END))) AS sim FROM s)
SELECT entry_id, mc AS m_chain_index, mr AS m_residue_index, ma AS m_atom_index,
  n AS donor_b_iso_count, {exact_sql("b", 3)} AS donor_median_b_iso, {exact_sql("q", 4)} AS metal_donor_b_ratio,
  {exact_sql("diff", 3)} AS metal_minus_donor_b_iso, {fixed_sql(exact_sql("sim", 4), 3)} AS metal_donor_b_similarity
FROM r
"""


def metal_overfull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each metal's own alternates sum above one; null when unreadable."""
    judged = overfull_sites(source_atoms(spark, sf_dir)).where(
        F.col("element_key").isin(*vocab.METALS)
    )
    return judged.select(
        "entry_id", "chain_index", "residue_index", "atom_name",
        F.col("overfull").alias("metal_overfull_occupancy"),
    )


QUERIES["metal_overfull"] = metal_overfull
ORACLES["metal_overfull"] = f"""
WITH {CONTACT_CTE}
SELECT entry_id, chain_index, residue_index, atom_name,
  CASE WHEN bool_and(ok) THEN count(*) > 1 AND sum(CAST(occupancy AS DECIMAL(18, 6))) > 1 END AS metal_overfull_occupancy
FROM source WHERE element_key IN ({_METALS}) GROUP BY entry_id, chain_index, residue_index, atom_name, element_key
"""


# ---- symmetry images -----------------------------------------------------------
def image_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates over all symmetry images."""
    atoms, frame = searched_atoms(spark, sf_dir), cells(spark, sf_dir)
    return con.image_candidates(
        con.metals_of(atoms), con.donors_of(atoms), frame, operations(spark, sf_dir, frame),
    )


def image_radius_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_stage(spark, sf_dir).select(
        "entry_id", "m_atom_index", "n_atom_index", "image_index", "tx", "ty", "tz",
        fixed("distance", 5).alias("distance"), "contact_scope", "ncs_block",
        "crystallographic_contact", "strict_ncs_contact",
    )


_OPS_SQL = ", ".join(
    f"({i}, {str(n).upper()}, {a}, {b}, {c}, {t}e0, {u}e0, {v}e0, {p})"
    for i, n, a, b, c, t, u, v, p in _operation_rows()
)
#: Symmetry images in SQL: every operation and the 27 nearest whole-cell shifts.
_IMAGE_CTE = f"""{CONTACT_CTE},
ops(image_index, is_ncs, a, b, c, t1, t2, t3, parity) AS (VALUES {_OPS_SQL}),
framed AS (
  SELECT *, CASE WHEN entry_no % 2 = 0 THEN cos(radians(90e0)) ELSE cos(radians(105e0)) END AS cb,
    CASE WHEN entry_no % 2 = 0 THEN 4 ELSE 2 END AS n_ops
  FROM atoms WHERE x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL
),
fract AS (
  SELECT *, z / (18e0 * sqrt(1 - cb * cb)) AS w, y / 19e0 AS v,
    (x - 18e0 * cb * (z / (18e0 * sqrt(1 - cb * cb)))) / 20e0 AS u
  FROM framed
),
shifts AS (SELECT i.s AS si, j.s AS sj, k.s AS sk FROM (SELECT unnest(generate_series(-1, 1)) AS s) i,
  (SELECT unnest(generate_series(-1, 1)) AS s) j, (SELECT unnest(generate_series(-1, 1)) AS s) k),
imaged AS (
  SELECT n.*, o.image_index, o.is_ncs, o.a * n.u + o.t1 AS gu, o.b * n.v + o.t2 AS gv, o.c * n.w + o.t3 AS gw
  FROM fract n JOIN ops o ON n.entry_no % 2 = o.parity AND (NOT o.is_ncs OR n.entry_no % 5 = 0)
),
met AS (
  SELECT m.entry_id, m.chain_index AS mc, m.residue_index AS mr, m.atom_index AS ma,
    n.chain_index AS nc, n.residue_index AS nr, n.atom_index AS na, n.image_index, n.is_ncs, n.n_ops, m.cb,
    n.gu - m.u AS du, n.gv - m.v AS dv, n.gw - m.w AS dw
  FROM fract m JOIN imaged n ON m.entry_id = n.entry_id
  WHERE (m.entry_id, m.chain_index, m.residue_index, m.atom_index) IN
      (SELECT entry_id, chain_index, residue_index, atom_index FROM metals)
    AND (n.entry_id, n.chain_index, n.residue_index, n.atom_index) IN
      (SELECT entry_id, chain_index, residue_index, atom_index FROM donors)
),
shifted AS (
  SELECT met.*, si - CAST(round(du) AS INT) AS tx, sj - CAST(round(dv) AS INT) AS ty,
    sk - CAST(round(dw) AS INT) AS tz,
    sqrt((20e0 * (du - round(du) + si) + 18e0 * cb * (dw - round(dw) + sk)) ** 2
      + (19e0 * (dv - round(dv) + sj)) ** 2
      + (18e0 * sqrt(1 - cb * cb) * (dw - round(dw) + sk)) ** 2) AS d
  FROM met, shifts
),
images AS (
  SELECT * FROM shifted WHERE d <= 4.000000001e0
  QUALIFY row_number() OVER (PARTITION BY entry_id, mc, mr, ma, nc, nr, na, image_index ORDER BY d) = 1
),
image_pairs AS (
  SELECT *, is_ncs OR image_index % n_ops <> 0 OR tx <> 0 OR ty <> 0 OR tz <> 0 AS generated,
    image_index % n_ops <> 0 OR tx <> 0 OR ty <> 0 OR tz <> 0 AS crystal
  FROM images WHERE d > 0 AND d <= 4.000000001e0
)"""
QUERIES["image_radius_join"] = image_radius_join_query
ORACLES["image_radius_join"] = f"""
WITH {_IMAGE_CTE}
SELECT entry_id, ma AS m_atom_index, na AS n_atom_index, image_index, tx, ty, tz,
  {fixed_sql("d", 5)} AS distance,
  CASE WHEN is_ncs AND crystal THEN 'strict_ncs_and_crystallographic' WHEN is_ncs THEN 'strict_ncs'
       WHEN crystal THEN 'crystallographic' ELSE 'explicit' END AS contact_scope,
  CASE WHEN is_ncs THEN image_index // n_ops END AS ncs_block,
  crystal AS crystallographic_contact, is_ncs AS strict_ncs_contact
FROM image_pairs WHERE NOT (mc = nc AND mr = nr AND NOT generated)
"""


def image_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = con.image_counts(image_stage(spark, sf_dir))
    return counted.withColumn(
        "generated_contact_scope",
        generated_scope(
            "symmetry_contact_count", "crystallographic_contact_count",
            "strict_ncs_contact_count",
        ),
    )


QUERIES["image_counts"] = image_counts
ORACLES["image_counts"] = f"""
WITH {_IMAGE_CTE},
c AS (SELECT entry_id, mc AS m_chain_index, mr AS m_residue_index, ma AS m_atom_index,
  count(*) FILTER (generated) AS symmetry_contact_count,
  count(*) FILTER (crystal) AS crystallographic_contact_count,
  count(*) FILTER (is_ncs) AS strict_ncs_contact_count,
  count(*) FILTER (is_ncs AND crystal) AS combined_ncs_crystallographic_contact_count
  FROM image_pairs WHERE NOT (mc = nc AND mr = nr AND NOT generated) GROUP BY ALL)
SELECT *, CASE WHEN symmetry_contact_count = 0 THEN 'none'
  WHEN crystallographic_contact_count > 0 AND strict_ncs_contact_count > 0 THEN 'strict_ncs_and_crystallographic'
  WHEN crystallographic_contact_count > 0 THEN 'crystallographic' ELSE 'strict_ncs' END AS generated_contact_scope
FROM c
"""


def special_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coincident images of every metal; the cutoff is wide so that some occur."""
    owners = cells(spark, sf_dir)
    frame = owners.select("entry_id", "m11", "m12", "m13", "m22", "m23", "m33")
    metals = con.metals_of(selected_atoms(spark, sf_dir)).join(frame, "entry_id")
    points = metals.selectExpr(
        "entry_id", "m_atom_index", "m_occupancy", "m_occupancy_valid",
        "m_z / m33 AS lw", "(m_y - m23 * m_z / m33) / m22 AS lv",
        "(m_x - m12 * ((m_y - m23 * m_z / m33) / m22) - m13 * m_z / m33) / m11 AS lu",
    )
    found = coincident_images(points, frame, operations(spark, sf_dir, owners), 3.0)
    judged = site_symmetry("coincident", "operation_count", "m_occupancy", "m_occupancy_valid")
    return found.select(
        "entry_id", "m_atom_index", "coincident", *[c.alias(n) for n, c in judged.items()]
    )


QUERIES["special_positions"] = special_positions
ORACLES["special_positions"] = f"""
WITH {_IMAGE_CTE},
near AS (
  SELECT m.entry_id, m.atom_index AS ma, m.occupancy, m.ok, m.n_ops, o.image_index, m.cb,
    n.gu - m.u - round(n.gu - m.u) AS du, n.gv - m.v - round(n.gv - m.v) AS dv,
    n.gw - m.w - round(n.gw - m.w) AS dw
  FROM fract m JOIN imaged n ON m.entry_id = n.entry_id AND m.chain_index = n.chain_index
    AND m.residue_index = n.residue_index AND m.atom_index = n.atom_index
    JOIN ops o ON o.image_index = n.image_index AND o.parity = m.entry_no % 2 AND NOT o.is_ncs AND NOT n.is_ncs
  WHERE (m.entry_id, m.chain_index, m.residue_index, m.atom_index) IN
      (SELECT entry_id, chain_index, residue_index, atom_index FROM metals)
),
c AS (SELECT entry_id, ma, any_value(occupancy) AS occ, any_value(ok) AS ok, any_value(n_ops) AS n_ops,
    count(*) FILTER (image_index > 0 AND (20e0 * du + 18e0 * cb * dw) ** 2 + (19e0 * dv) ** 2
      + (18e0 * sqrt(1 - cb * cb) * dw) ** 2 <= 9e0) AS k
  FROM near GROUP BY ALL)
SELECT entry_id, ma AS m_atom_index, k AS coincident, k > 0 AS metal_special_position,
  CASE WHEN n_ops % (k + 1) = 0 THEN k + 1 END AS metal_site_symmetry_order,
  CASE WHEN n_ops % (k + 1) = 0 THEN {fixed_sql("1e0 / (k + 1)")} END AS metal_expected_crystallographic_occupancy,
  CASE WHEN n_ops % (k + 1) = 0 AND ok THEN abs(occ - 1e0 / (k + 1)) <= 0.015e0 END AS metal_occupancy_matches_site_symmetry
FROM c
"""


def image_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label near one another collapse; ten vectors make a group."""
    points = _points(spark, sf_dir).select(
        "label", F.floor(F.col("vec_id") / 100).alias("block"), "vec_id", "x", "y", "z",
        F.array(F.col("vec_id").cast("string")).alias("sources"),
    )
    kept = con.collapse_images(
        points, ("label", "block"), ("vec_id", "x", "y", "z"), ("x", "y", "z"), 0.2, ("sources",)
    )
    return kept.select("label", "block", "vec_id", F.array_join("sources", "|").alias("sources"))


QUERIES["image_collapse"] = image_collapse
ORACLES["image_collapse"] = f"""
WITH RECURSIVE {_POINTS_SQL},
o AS (SELECT *, vec_id // 100 AS block,
        row_number() OVER (PARTITION BY label, vec_id // 100 ORDER BY vec_id) AS i FROM p),
w AS (
  SELECT label, block, i, [struct_pack(id := vec_id, x := x, y := y, z := z)] AS kept,
         [[vec_id]] AS merged FROM o WHERE i = 1
  UNION ALL
  SELECT o.label, o.block, o.i,
    CASE WHEN hit IS NULL THEN list_append(w.kept, struct_pack(id := o.vec_id, x := o.x, y := o.y, z := o.z)) ELSE w.kept END,
    CASE WHEN hit IS NULL THEN list_append(w.merged, [o.vec_id])
      ELSE list_transform(w.merged, lambda m, j: CASE WHEN j = hit THEN list_append(m, o.vec_id) ELSE m END) END
  FROM w JOIN o ON o.label = w.label AND o.block = w.block AND o.i = w.i + 1,
    LATERAL (SELECT list_position(list_transform(w.kept, lambda k: sqrt((k.x - o.x) * (k.x - o.x)
      + (k.y - o.y) * (k.y - o.y) + (k.z - o.z) * (k.z - o.z)) <= 0.2e0), TRUE) AS h0) a,
    LATERAL (SELECT CASE WHEN h0 > 0 THEN h0 END AS hit) b
),
last AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY label, block ORDER BY i DESC) = 1),
u AS (SELECT label, block, unnest(kept) AS k, unnest(merged) AS m FROM last)
SELECT label, CAST(block AS BIGINT) AS block, k.id AS vec_id,
  array_to_string(list_transform(m, lambda v: CAST(v AS VARCHAR)), '|') AS sources
FROM u
"""


def unit_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = cells(spark, sf_dir)
    volume = cell_volume(*[F.col(c) for c in ("a", "b", "c", "alpha", "beta", "gamma")])
    counts = operations(spark, sf_dir).where(~F.col("is_ncs")).groupBy("entry_id").agg(
        F.count(F.lit(1)).alias("n_ops")
    )
    return raw.join(counts, "entry_id").select(
        "entry_id", fixed(volume).alias("volume"),
        fixed(volume / F.col("n_ops")).alias("asu_volume"),
    )


QUERIES["unit_cells"] = unit_cells
ORACLES["unit_cells"] = f"""
SELECT DISTINCT 'e' || e AS entry_id,
  {fixed_sql("20e0 * 19e0 * 18e0 * (CASE WHEN e % 2 = 0 THEN 1 ELSE sin(radians(105e0)) END)")} AS volume,
  {fixed_sql("20e0 * 19e0 * 18e0 * (CASE WHEN e % 2 = 0 THEN 1 ELSE sin(radians(105e0)) END) / (CASE WHEN e % 2 = 0 THEN 4 ELSE 2 END)")} AS asu_volume
FROM (SELECT CAST(floor(l_orderkey / 40) AS BIGINT) AS e FROM lineitem)
"""
