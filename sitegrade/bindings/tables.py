"""Whole contact tables: candidates, bonds and sites in both scopes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade.bindings import contacts as bc
from sitegrade.bindings.common import Query, derived, exact_sql, fixed, fixed_sql, plain, table
from sitegrade.bindings.inventory import selected_atoms, source_atoms
from sitegrade.operators import contacts as con
from sitegrade.operators.lookup import literature
from sitegrade.plans.contacts import ContactTables, analyze_contacts
from sitegrade.plans.sites import annotated_sites, entry_precision
from sitegrade.session import cut_lineage

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _analysis(spark: SparkSession, sf_dir: str, images: bool) -> ContactTables:
    """With images: a third of the entries asks for no search, a seventh has no cell."""
    frame = bc.cells(spark, sf_dir)
    entries = frame.select(
        "entry_id",
        (0.05 + F.pmod("entry_no", F.lit(10)) / 100).alias("dpi"),
        F.lit("").alias("dpi_reason"),
        (F.lit(images) & (F.pmod("entry_no", F.lit(3)) != 1)).alias("searched"),
    )
    return analyze_contacts(
        selected_atoms(spark, sf_dir), entries, literature(spark),
        frame.where("entry_no % 7 <> 3") if images else None,
        bc.operations(spark, sf_dir, frame) if images else None,
    )


def bond_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir, False).bonds.select(
        "metal_site_id", "contact_id", "neighbor_atom_index", "distance", "zscore",
        "coordination_status", "coordination_source", "bonded_to", "neighbor_class",
    )


_CODES = f"""
named AS (SELECT *, entry_id || ':m0:c' || mc || ':r' || mr || ':a' || ma AS metal_site_id FROM judged),
keyed AS (SELECT *, metal_site_id || ':c' || substring(sha256(concat_ws(chr(31), '0', nc, nr, na, 'explicit', '', '0', '1_555', '0', '0', '0')), 1, 24) AS contact_id FROM named)"""
QUERIES["bond_rows"] = bond_rows
ORACLES["bond_rows"] = f"""WITH {bc.CONTACT_CTE}, {_CODES},
z AS (SELECT *, CASE WHEN mu IS NOT NULL THEN (d - mu) / sqrt((0.05e0 + (entry_no % 10) / 100e0) * (0.05e0 + (entry_no % 10) / 100e0) + sigma * sigma) END AS z
  FROM keyed WHERE inside AND allowed)
SELECT metal_site_id, contact_id, na AS neighbor_atom_index, {exact_sql("d", 3)} AS distance, {exact_sql("z", 4)} AS zscore,
  'inferred' AS coordination_status, 'proximity_rule' AS coordination_source,
  CASE WHEN is_water THEN 'HOH' ELSE 'P' END AS bonded_to, CASE WHEN is_water THEN 'water' ELSE 'amino_acid' END AS neighbor_class
FROM z"""


def candidate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir, False).candidates.select(
        "metal_site_id", "contact_id", "assigned_as_bond", "candidate_source", "eligibility_status",
        "coordination_status", fixed("candidate_distance").alias("candidate_distance"), "symmetry_operation",
    )


QUERIES["candidate_rows"] = candidate_rows
ORACLES["candidate_rows"] = f"""WITH {bc.CONTACT_CTE}, {_CODES}
SELECT metal_site_id, contact_id, inside AND allowed AS assigned_as_bond, 'proximity_4A' AS candidate_source,
  CASE WHEN target IS NULL THEN CASE WHEN allowed THEN 'missing_assignment_reference' ELSE 'non_typical_donor' END
    WHEN inside THEN CASE WHEN allowed THEN 'first_sphere_eligible' ELSE 'non_typical_donor' END
    ELSE 'outside_first_sphere' END AS eligibility_status,
  CASE WHEN inside AND allowed THEN 'inferred' ELSE 'unassigned' END AS coordination_status,
  {fixed_sql("d")} AS candidate_distance, '1_555' AS symmetry_operation
FROM keyed"""


def site_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of entries with and without an image search, both scopes side by side."""
    return _analysis(spark, sf_dir, True).sites.select(
        "metal_site_id", "metal_coordinates_valid", "explicit_candidate_contact_count",
        "explicit_geometry_status", "candidate_contact_count", "geometry_status",
        "image_inclusive_candidate_contact_count", "score_eligible_contact_count",
        "symmetry_contact_count", "crystallographic_contact_count", "strict_ncs_contact_count",
        "generated_contact_scope", "geometry_classification_changes_with_generated_images",
        "coordination_depends_on_crystallographic_symmetry", "coordination_depends_on_strict_ncs",
        "geometry_not_assessed_reason", "context_warning", "donor_b_iso_count",
        "nearby_metal_count_6a", "nearest_metal_element",
    )


_SEARCHED = "(entry_no % 3 <> 1 AND entry_no % 7 <> 3)"
#: The explicit chain of tables over image pairs: same rules, other names.
_RULED = bc.CONTACT_CTE[bc.CONTACT_CTE.index("ruled AS ("):] + ", " + bc._GROUPS_SQL
for _name in ("ruled", "cand", "judged", "scored", "grouped", "statused"):
    _RULED = re.sub(rf"\b{_name}\b", f"i_{_name}", _RULED)
_RULED = re.sub(r"FROM pairs WHERE .*", "FROM i_pairs", _RULED).replace(
    "PARTITION BY entry_id, mc, mr, ma, nc, nr", "PARTITION BY entry_id, mc, mr, ma, nc, nr, image_index, tx, ty, tz")
QUERIES["site_rows"] = site_rows
ORACLES["site_rows"] = f"""WITH {bc._IMAGE_CTE}, {bc._GROUPS_SQL},
i_pairs AS (
  SELECT p.entry_id, m.entry_no, p.mc, p.mr, p.ma, m.element AS me, m.b_iso AS mb, p.nc, p.nr, p.na,
    n.atom_name, n.residue_name, n.element AS ne, n.b_iso AS nb, n.is_water, n.polymer_position AS pos, p.d,
    p.image_index, p.tx, p.ty, p.tz, p.generated, p.crystal, p.is_ncs
  FROM image_pairs p
  JOIN atoms m ON m.entry_id = p.entry_id AND m.chain_index = p.mc AND m.residue_index = p.mr AND m.atom_index = p.ma
  JOIN atoms n ON n.entry_id = p.entry_id AND n.chain_index = p.nc AND n.residue_index = p.nr AND n.atom_index = p.na
  WHERE NOT (p.mc = p.nc AND p.mr = p.nr AND NOT p.generated)
),
{_RULED},
sites AS (
  SELECT entry_id, entry_no, chain_index AS mc, residue_index AS mr, atom_index AS ma, element, {_SEARCHED} AS searched,
    x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL AS finite, x, y, z
  FROM atoms WHERE element IN ({bc._METALS}) AND NOT coalesce(ok AND occupancy = 0, FALSE)
),
primary_contacts AS (
  SELECT entry_id, mc, mr, ma, z, far, nb, size >= 2 AND any_far AS bad, generated, crystal, is_ncs
  FROM i_statused WHERE {_SEARCHED}
  UNION ALL
  SELECT entry_id, mc, mr, ma, z, far, nb, size >= 2 AND any_far, FALSE, FALSE, FALSE
  FROM statused WHERE NOT {_SEARCHED}
),
primary_candidates AS (
  SELECT entry_id, mc, mr, ma, inside AND NOT allowed AS off FROM i_judged WHERE {_SEARCHED}
  UNION ALL SELECT entry_id, mc, mr, ma, inside AND NOT allowed FROM judged WHERE NOT {_SEARCHED}
),
e AS (SELECT entry_id, mc, mr, ma, count(*) AS n, count(z) AS nz, count(*) FILTER (far) AS bad FROM statused GROUP BY ALL),
p AS (SELECT entry_id, mc, mr, ma, count(*) AS n, count(z) AS nz, count(*) FILTER (far) AS bad, count(nb) AS nb,
    bool_or(bad) AS grouped_bad, count(*) FILTER (generated) AS g, count(*) FILTER (crystal) AS c,
    count(*) FILTER (is_ncs) AS k FROM primary_contacts GROUP BY ALL),
o AS (SELECT entry_id, mc, mr, ma, bool_or(off) AS off FROM primary_candidates GROUP BY ALL),
near AS (
  SELECT m.entry_id, m.mc, m.mr, m.ma, count(*) FILTER (d <= 6.000001e0) AS n6,
    arg_min(ne, (d, nc, nr, na)) AS nearest
  FROM (SELECT a.*, b.element AS ne, b.mc AS nc, b.mr AS nr, b.ma AS na,
      sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS d
    FROM sites a JOIN sites b ON a.entry_id = b.entry_id AND a.finite AND b.finite
      AND NOT (a.mc = b.mc AND a.mr = b.mr AND a.ma = b.ma)) m GROUP BY ALL
),
f AS (
  SELECT s.*, coalesce(e.n, 0) AS en, coalesce(p.n, 0) AS pn, coalesce(p.nz, 0) AS pz, coalesce(p.nb, NULL) AS pnb,
    CASE WHEN coalesce(e.nz, 0) = 0 THEN 'insufficient data' WHEN e.bad > 0 THEN 'suspect' ELSE 'plausible' END AS es,
    CASE WHEN coalesce(p.nz, 0) = 0 THEN 'insufficient data' WHEN p.bad > 0 THEN 'suspect' ELSE 'plausible' END AS ps,
    CASE WHEN searched THEN coalesce(p.g, 0) END AS g, CASE WHEN searched THEN coalesce(p.c, 0) END AS c,
    CASE WHEN searched THEN coalesce(p.k, 0) END AS k,
    coalesce(p.grouped_bad, FALSE) OR coalesce(o.off, FALSE) AS warned, near.n6, near.nearest
  FROM sites s LEFT JOIN e USING (entry_id, mc, mr, ma) LEFT JOIN p USING (entry_id, mc, mr, ma)
  LEFT JOIN o USING (entry_id, mc, mr, ma) LEFT JOIN near USING (entry_id, mc, mr, ma)
)
SELECT entry_id || ':m0:c' || mc || ':r' || mr || ':a' || ma AS metal_site_id, finite AS metal_coordinates_valid,
  en AS explicit_candidate_contact_count, es AS explicit_geometry_status,
  pn AS candidate_contact_count, ps AS geometry_status,
  CASE WHEN searched THEN pn END AS image_inclusive_candidate_contact_count, pz AS score_eligible_contact_count,
  g AS symmetry_contact_count, c AS crystallographic_contact_count, k AS strict_ncs_contact_count,
  CASE WHEN g = 0 THEN 'none' WHEN c > 0 AND k > 0 THEN 'strict_ncs_and_crystallographic'
    WHEN c > 0 THEN 'crystallographic' WHEN g > 0 THEN 'strict_ncs' END AS generated_contact_scope,
  CASE WHEN searched THEN es <> ps END AS geometry_classification_changes_with_generated_images,
  c > 0 AS coordination_depends_on_crystallographic_symmetry, k > 0 AS coordination_depends_on_strict_ncs,
  CASE WHEN NOT finite THEN 'non_finite_metal_coordinates' ELSE concat_ws('|',
    CASE WHEN NOT searched THEN 'symmetry_search_unavailable' END,
    CASE WHEN pz = 0 THEN 'no_assessable_reference_contacts' END) END AS geometry_not_assessed_reason,
  warned AS context_warning, pnb AS donor_b_iso_count,
  CASE WHEN finite THEN coalesce(n6, 0) END AS nearby_metal_count_6a, nearest AS nearest_metal_element
FROM f"""


# ---- columns of the entry and the metal ----------------------------------------
PRECISION = """
SELECT DISTINCT concat('e', CAST(CAST(floor(l_orderkey / 40) AS BIGINT) AS STRING)) AS entry_id,
  1.5e0 + (CAST(floor(l_orderkey / 40) AS BIGINT) % 20) / 10e0 AS resolution,
  CASE WHEN floor(l_orderkey / 40) % 9 <> 0 THEN 0.21e0 END AS r_free,
  (CAST(floor(l_orderkey / 40) AS BIGINT) % 13) * 1500e0 AS reflection_count,
  6840e0 AS asu_volume, 120e0 + (CAST(floor(l_orderkey / 40) AS BIGINT) % 50) / 7e0 AS occupancy_weighted_atom_count,
  60e0 + (CAST(floor(l_orderkey / 40) AS BIGINT) % 50) / 14e0 AS deposited_occupancy_weighted_atom_count,
  floor(l_orderkey / 40) % 10 <> 7 AS has_source, floor(l_orderkey / 40) % 17 <> 0 AS metadata_numeric,
  floor(l_orderkey / 40) % 11 = 0 AS occupancy_validation_failed
FROM {lineitem}
"""


def site_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every selected metal with the columns of its entry and of itself; a third has no symmetry."""
    records = cut_lineage(source_atoms(spark, sf_dir))
    atoms = bc.contact_table(spark, sf_dir)
    metals = con._prefixed(atoms.where(con.is_metal()), "m_").select(*con.SITE)
    structural = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_nationkey") == 0, "HEM").otherwise(F.concat(F.lit("N"), "n_nationkey")).alias("residue_name"),
        F.when(F.col("n_nationkey") == 0, "heme").otherwise("cluster").alias("structural_class"))
    found = annotated_sites(
        metals, records, atoms, entry_precision(derived(spark, sf_dir, PRECISION)),
        bc.cells(spark, sf_dir).where("entry_no % 3 <> 2"), bc.operations(spark, sf_dir), structural, cutoff=3.0)
    return found.withColumns({"resolution": fixed("resolution", 3), "asu_volume": fixed("asu_volume", 3)})


QUERIES["site_annotations"] = site_annotations
ORACLES["site_annotations"] = f"""
WITH {bc._IMAGE_CTE},
site AS (SELECT * FROM atoms WHERE element IN ({bc._METALS}) AND NOT coalesce(ok AND occupancy = 0, FALSE)),
near AS (
  SELECT m.entry_id, m.chain_index, m.residue_index, m.atom_index, o.image_index, m.cb,
    n.gu - m.u - round(n.gu - m.u) AS du, n.gv - m.v - round(n.gv - m.v) AS dv, n.gw - m.w - round(n.gw - m.w) AS dw
  FROM fract m JOIN imaged n ON m.entry_id = n.entry_id AND m.chain_index = n.chain_index
    AND m.residue_index = n.residue_index AND m.atom_index = n.atom_index
    JOIN ops o ON o.image_index = n.image_index AND o.parity = m.entry_no % 2 AND NOT o.is_ncs AND NOT n.is_ncs
  WHERE m.element IN ({bc._METALS}) AND m.entry_no % 3 <> 2
),
k AS (SELECT entry_id, chain_index, residue_index, atom_index,
    count(*) FILTER (image_index > 0 AND (20e0 * du + 18e0 * cb * dw) ** 2 + (19e0 * dv) ** 2
      + (18e0 * sqrt(1 - cb * cb) * dw) ** 2 <= 9e0) AS k FROM near GROUP BY ALL),
f AS (SELECT entry_id, chain_index, residue_index, atom_name, element_key,
    CASE WHEN bool_and(ok) THEN count(*) > 1 AND sum(CAST(occupancy AS DECIMAL(18, 6))) > 1 END AS over
  FROM source WHERE element_key IN ({bc._METALS}) GROUP BY ALL),
parts AS (SELECT entry_id, chain_index, residue_index, count(*) AS n FROM atoms GROUP BY ALL),
b AS (SELECT entry_id, median(b_iso) AS b FROM atoms
  WHERE NOT is_water AND NOT is_hydrogen AND NOT coalesce(ok AND occupancy = 0, FALSE) GROUP BY entry_id),
p AS (SELECT *, CASE WHEN NOT has_source THEN 'missing_dpi_metadata_source' WHEN NOT metadata_numeric THEN 'invalid_dpi_metadata'
    WHEN occupancy_validation_failed THEN 'invalid_occupancy' WHEN reflection_count <= 0 THEN 'missing_or_invalid_reflection_count'
    WHEN r_free IS NULL THEN 'missing_or_invalid_rfree' ELSE '' END AS dpi_reason FROM ({plain(PRECISION)})),
d AS (SELECT *, CASE WHEN dpi_reason = '' THEN 1.28e0 * pow(occupancy_weighted_atom_count, 0.5e0) * pow(asu_volume, 1e0 / 3)
    * pow(reflection_count, -5e0 / 6) * r_free END AS raw FROM p),
j AS (
  SELECT s.*, k.k, CASE WHEN s.entry_no % 2 = 0 THEN 4 ELSE 2 END AS n_ops, f.over, parts.n AS parts
  FROM site s LEFT JOIN k USING (entry_id, chain_index, residue_index, atom_index)
  LEFT JOIN f ON f.entry_id = s.entry_id AND f.chain_index = s.chain_index AND f.residue_index = s.residue_index
    AND f.atom_name = s.atom_name AND f.element_key = s.element
  LEFT JOIN parts ON parts.entry_id = s.entry_id AND parts.chain_index = s.chain_index AND parts.residue_index = s.residue_index
)
SELECT j.entry_id, j.chain_index AS m_chain_index, j.residue_index AS m_residue_index, j.atom_index AS m_atom_index,
  over AS metal_overfull_occupancy,
  CASE WHEN residue_name = 'HEM' THEN 'heme' WHEN parts = 1 THEN 'ion' ELSE 'other' END AS metal_component_class,
  k > 0 AS metal_special_position, CASE WHEN n_ops % (k + 1) = 0 THEN k + 1 END AS metal_site_symmetry_order,
  CASE WHEN n_ops % (k + 1) = 0 THEN {fixed_sql("1e0 / (k + 1)")} END AS metal_expected_crystallographic_occupancy,
  CASE WHEN n_ops % (k + 1) = 0 AND ok THEN abs(occupancy - 1e0 / (k + 1)) <= 0.015e0 END AS metal_occupancy_matches_site_symmetry,
  {exact_sql("b", 3)} AS entry_nonwater_median_b_iso, {exact_sql("raw", 4)} AS dpi, dpi_reason,
  {fixed_sql("resolution", 3)} AS resolution, r_free, reflection_count, {fixed_sql("asu_volume", 3)} AS asu_volume,
  {exact_sql("occupancy_weighted_atom_count", 6)} AS occupancy_weighted_atom_count,
  {exact_sql("deposited_occupancy_weighted_atom_count", 6)} AS deposited_occupancy_weighted_atom_count
FROM j LEFT JOIN b ON b.entry_id = j.entry_id LEFT JOIN d ON d.entry_id = j.entry_id"""
