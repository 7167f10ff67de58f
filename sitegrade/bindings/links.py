"""Declared connections, catalog, reflection, source and streaming queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.bindings import contacts as bc
from sitegrade.bindings.common import ATOMS, Query, derived, exact_sql, fixed, fixed_sql, plain, table
from sitegrade.bindings.inventory import SELECTION_CTE, records
from sitegrade.bindings.runs import MANIFEST, manifest
from sitegrade.functions.geometry import distance
from sitegrade.operators import catalog as cat
from sitegrade.operators import contacts as con
from sitegrade.operators import declared as dec
from sitegrade.operators import inventory as inv
from sitegrade.operators import reflections as ref
from sitegrade.operators.distribution import value_histogram
from sitegrade.session import cut_lineage, ensure_checkpoint_dir, stored_where_dealt
from sitegrade.sources import files as src
from sitegrade.sources import tables
from sitegrade.streaming import jobs
from sitegrade.streaming.store import EntryStore

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_METALS = ", ".join(f"'{m}'" for m in vocab.METALS)


def _add(name: str, query: Query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


# ---- declared connections ------------------------------------------------------
CONNECTIONS = f"""
SELECT m.entry_id, m.source_order * 7 + n.source_order AS position, 'LINK' AS source,
  concat('c', CAST(n.source_order % 5 AS STRING)) AS connection_id,
  'metalc' AS connection_type, '' AS link_id, 'same' AS asu, 2.1e0 AS reported_distance,
  m.chain_id AS p1_chain, m.residue_name AS p1_resname, m.resnum AS p1_resnum,
  m.atom_name AS p1_atom, '' AS p1_altloc,
  n.chain_id AS p2_chain, n.residue_name AS p2_resname, n.resnum AS p2_resnum,
  CASE WHEN n.source_order % 13 = 0 THEN 'XX' ELSE n.atom_name END AS p2_atom,
  CASE WHEN n.source_order % 3 = 0 THEN n.altloc ELSE '' END AS p2_altloc
FROM ({ATOMS}) m JOIN ({ATOMS}) n ON m.entry_id = n.entry_id
  AND n.chain_index = (m.chain_index + 1) % 4 AND n.residue_index = (m.residue_index + 1) % 10
WHERE m.residue_name IN ('ZN', 'HEM')
"""


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, CONNECTIONS)


#: The same, the neighbour also in the metal's own residue, over all statements of the unit.
IMAGE_CONNECTIONS = CONNECTIONS.replace("""  AND n.chain_index = (m.chain_index + 1) % 4 AND n.residue_index = (m.residue_index + 1) % 10
""", """  AND ((n.chain_index = (m.chain_index + 1) % 4 AND n.residue_index = (m.residue_index + 1) % 10)
    OR (n.chain_index = m.chain_index AND n.residue_index = m.residue_index AND n.source_order <> m.source_order))
""").replace("m.source_order * 7 + n.source_order AS position", "m.source_order * 1000003 + n.source_order AS position"
            ).replace("'same' AS asu", "split_part('same,any,different,', ',', CAST(n.source_order % 4 + 1 AS INT)) AS asu")


def outcomes(spark: SparkSession, sf_dir: str, stated: DataFrame | None = None) -> DataFrame:
    source = inv.dedupe_records(records(spark, sf_dir).repartition("entry_id"))
    named = dec.unique_connection_ids(connections(spark, sf_dir) if stated is None else stated)
    return dec.declared_outcomes(dec.resolve_partners(named, source, dealt=True))


def connection_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dec.unique_connection_ids(connections(spark, sf_dir)).select(
        "entry_id", "position", "connection_id"
    )


def _ids_sql(text: str) -> str:
    return f"""conn AS ({plain(text)}),
named AS (SELECT * EXCLUDE (connection_id), CASE WHEN row_number() OVER (PARTITION BY entry_id, connection_id ORDER BY position) = 1
    THEN connection_id ELSE connection_id || '_' || position END AS connection_id FROM conn)"""


_IDS_SQL = _ids_sql(CONNECTIONS)
_add("connection_ids", connection_ids, f"WITH {_IDS_SQL} SELECT entry_id, position, connection_id FROM named")


def declared_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_where_dealt(outcomes(spark, sf_dir).select(
        "entry_id", "position", "outcome", "issue", F.array_join("warnings", "|").alias("warnings"),
        F.when(F.col("outcome") == "candidate", F.col("metal.atom_index")).alias("metal_atom"),
        F.when(F.col("outcome") == "candidate", F.col("neighbor.atom_index")).alias("neighbor_atom"),
    ))


def _side_sql(side: str) -> str:
    return f"""{side}r AS (
  SELECT c.position, c.entry_id, s.chain_index, s.residue_index, s.atom_name, s.atom_index, s.element,
    row_number() OVER (PARTITION BY c.entry_id, c.position ORDER BY s.altloc <> sel.selected_altloc, s.source_order) AS i
  FROM named c JOIN source s ON s.entry_id = c.entry_id AND s.chain_id = c.{side}_chain AND s.resnum = c.{side}_resnum
    AND s.residue_name = c.{side}_resname AND s.atom_name = c.{side}_atom AND (c.{side}_altloc = '' OR c.{side}_altloc = s.altloc)
  JOIN selections sel ON sel.entry_id = s.entry_id AND sel.chain_index = s.chain_index AND sel.residue_index = s.residue_index
),
{side} AS (
  SELECT r.position, r.entry_id, r.element AS declared_element, r.atom_index AS declared_atom, a.*  EXCLUDE (entry_id),
    a.element IN ({_METALS}) AND NOT coalesce(a.ok AND a.occupancy = 0, FALSE) AS is_metal
  FROM {side}r r LEFT JOIN atoms a ON a.entry_id = r.entry_id AND a.chain_index = r.chain_index
    AND a.residue_index = r.residue_index AND a.atom_name = r.atom_name AND a.element IS NOT DISTINCT FROM r.element
  WHERE r.i = 1
)"""


_OUTCOME_CTE = f"""{SELECTION_CTE}, {_IDS_SQL}, {_side_sql("p1")}, {_side_sql("p2")},
joined AS (
  SELECT c.entry_id, c.position, c.connection_id, a.declared_atom AS da, b.declared_atom AS db, a.atom_index AS fa, b.atom_index AS fb,
    coalesce(a.is_metal, FALSE) AS m1, coalesce(b.is_metal, FALSE) AS m2,
    coalesce(a.declared_element IN ({_METALS}), FALSE) OR coalesce(b.declared_element IN ({_METALS}), FALSE) OR c.p1_resname = 'ZN' OR c.p2_resname = 'ZN' AS ev,
    a.x AS ax, a.y AS ay, a.z AS az, b.x AS bx, b.y AS by_, b.z AS bz, a.chain_index AS ac, a.residue_index AS ar, b.chain_index AS bc, b.residue_index AS br,
    a.element AS ae, b.element AS be, a.is_water AS aw, b.is_water AS bw, a.residue_name AS an, b.residue_name AS bn,
    a.ok AND a.occupancy = 0 AS azero, b.ok AND b.occupancy = 0 AS bzero
  FROM named c LEFT JOIN p1 a ON a.entry_id = c.entry_id AND a.position = c.position
  LEFT JOIN p2 b ON b.entry_id = c.entry_id AND b.position = c.position
),
labelled_out AS (
  SELECT *, (da IS NOT NULL AND fa IS NULL) OR (db IS NOT NULL AND fb IS NULL) AS lost_conformer,
    coalesce(fa <> da, FALSE) OR coalesce(fb <> db, FALSE) AS swapped,
    CASE WHEN m1 THEN be ELSE ae END AS ne, CASE WHEN m1 THEN bw ELSE aw END AS nw, CASE WHEN m1 THEN bn ELSE an END AS nn,
    CASE WHEN m1 THEN bzero ELSE azero END AS nz
  FROM joined
),
decided AS (
  SELECT *, CASE WHEN lost_conformer THEN CASE WHEN ev THEN 'conformer_deselected' ELSE 'ignored' END
    WHEN (fa IS NULL OR fb IS NULL) AND NOT (ev OR m1 OR m2) THEN 'ignored'
    WHEN fa IS NULL AND fb IS NULL THEN 'neither_resolved' WHEN fa IS NULL OR fb IS NULL THEN 'unresolved'
    WHEN m1 = m2 THEN 'ignored'
    WHEN ax IS NULL OR bx IS NULL OR ay IS NULL OR by_ IS NULL OR az IS NULL OR bz IS NULL THEN 'non_finite'
    WHEN ne IS NULL OR ne NOT IN ('N', 'O', 'S') THEN 'unsupported_element'
    WHEN ac = bc AND ar = br THEN 'own_residue' ELSE 'candidate' END AS outcome
  FROM labelled_out
)"""
_AMINO = ", ".join(f"'{a}'" for a in vocab.AMINO_ACIDS)
_add("declared_outcomes", declared_outcomes, f"""WITH {_OUTCOME_CTE}
SELECT entry_id, position, outcome,
  CASE outcome WHEN 'conformer_deselected' THEN 'LINK ' || connection_id || ' partner names a conformer whose selected alternative has no matching atom'
    WHEN 'neither_resolved' THEN 'LINK ' || connection_id || ' neither partner resolved'
    WHEN 'unresolved' THEN 'LINK ' || connection_id || ' partner unresolved'
    WHEN 'non_finite' THEN 'LINK ' || connection_id || ' geometry unavailable: partner has non-finite coordinates' END AS issue,
  concat_ws('|', CASE WHEN swapped AND (ev OR m1 OR m2) AND outcome IN ('candidate', 'conformer_deselected', 'neither_resolved', 'unresolved', 'non_finite') THEN 'declared_connection_conformer_substituted' END,
    CASE WHEN outcome = 'candidate' AND coalesce(nz, FALSE) THEN 'declared_connection_zero_occupancy_partner' END,
    CASE WHEN outcome = 'unsupported_element' THEN 'declared_donor_element_unsupported' END,
    CASE WHEN outcome = 'candidate' AND NOT (nw OR nn IN ({_AMINO})) THEN 'declared_donor_outside_supported_classes' END) AS warnings,
  CASE WHEN outcome = 'candidate' THEN CASE WHEN m1 THEN fa ELSE fb END END AS metal_atom,
  CASE WHEN outcome = 'candidate' THEN CASE WHEN m1 THEN fb ELSE fa END END AS neighbor_atom
FROM decided""")


#: What a merge of candidates itself reads.
_MERGE_KEYS = (*con.SITE, *con.DONOR, "image_index", "tx", "ty", "tz", "px", "py", "pz", "sources", "declared",
               "donor_class_supported")


def merged_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proximity and declared candidates of one image merged into one row."""
    pairs = dec.declared_pairs(outcomes(spark, sf_dir)).drop("asu")
    near = tuple(F.col(f"m_{a}") for a in "xyz"), tuple(F.col(f"n_{a}") for a in "xyz")
    declared = con.as_explicit(pairs.withColumn("distance", distance(*near)))
    atoms = bc.searched_atoms(spark, sf_dir)
    read = [*_MERGE_KEYS, "distance", *[f"n_{c}" for c in (
        "atom_name", "residue_name", "is_water", "element", "polymer_position")]]
    proximity = con.explicit_candidates(con.metals_of(atoms), con.donors_of(atoms)).select(*read)
    merged = con.merge_candidates(proximity, stored_where_dealt(declared.select(*read)))
    return con.with_donor_policy(merged).select(
        "entry_id", "m_atom_index", "n_atom_index", fixed("distance", 5).alias("distance"),
        F.array_join("sources", "|").alias("sources"),
        F.array_join(F.transform("declared", lambda d: d["connection_id"]), "|").alias("connection_ids"),
        "donor_class_supported", "donor_rule_override",
        con.coordination_status(F.col("is_declared"), F.col("inferred_donor_allowed")).alias("coordination_status"),
    )


_add("merged_candidates", merged_candidates, f"""WITH {bc.CONTACT_CTE}, {_OUTCOME_CTE.replace(SELECTION_CTE + ",", "", 1)},
decl AS (
  SELECT entry_id, CASE WHEN m1 THEN fa ELSE fb END AS ma, CASE WHEN m1 THEN fb ELSE fa END AS na,
    string_agg(connection_id, '|' ORDER BY connection_id) AS ids, bool_and(nw OR nn IN ({_AMINO})) AS supported,
    any_value(sqrt((ax - bx) * (ax - bx) + (ay - by_) * (ay - by_) + (az - bz) * (az - bz))) AS d
  FROM decided WHERE outcome = 'candidate' GROUP BY ALL
),
prox AS (SELECT entry_id, ma, na, d, allowed FROM cand),
rules AS (SELECT m.entry_id, m.ma, m.na, rule <> 'outside_typical_donor_list' AS allowed FROM (
  SELECT d.entry_id, d.ma, d.na, CASE
    WHEN n.is_water THEN CASE WHEN n.element = 'O' THEN 'water_oxygen' ELSE 'outside_typical_donor_list' END
    WHEN n.residue_name NOT IN ({_AMINO}) THEN 'outside_typical_donor_list'
    WHEN n.atom_name = 'O' THEN 'carbonyl'
    WHEN n.residue_name || ' ' || n.atom_name IN ('ASP OD1', 'ASP OD2', 'CYS SG', 'GLU OE1', 'GLU OE2', 'HIS ND1', 'HIS NE2', 'LYS NZ', 'SER OG') THEN 'side'
    WHEN n.atom_name = 'N' AND n.polymer_position IN ('N', 'NC') THEN 'n'
    WHEN n.atom_name IN ('OXT', 'OT1', 'OT2') AND n.polymer_position IN ('C', 'NC') THEN 'c'
    ELSE 'outside_typical_donor_list' END AS rule
  FROM decl d JOIN atoms n ON n.entry_id = d.entry_id AND n.atom_index = d.na) m)
SELECT coalesce(p.entry_id, d.entry_id) AS entry_id, coalesce(p.ma, d.ma) AS m_atom_index, coalesce(p.na, d.na) AS n_atom_index,
  {fixed_sql("coalesce(p.d, d.d)", 5)} AS distance,
  CASE WHEN p.d IS NULL THEN 'LINK' WHEN d.ids IS NULL THEN 'proximity_4A' ELSE 'LINK|proximity_4A' END AS sources,
  d.ids AS connection_ids, coalesce(d.supported, TRUE) AS donor_class_supported,
  CASE WHEN d.ids IS NOT NULL AND d.supported AND NOT r.allowed THEN 'declared_connection' ELSE '' END AS donor_rule_override,
  CASE WHEN d.ids IS NOT NULL THEN 'declared' WHEN p.allowed THEN 'inferred' ELSE 'unassigned' END AS coordination_status
FROM prox p FULL OUTER JOIN decl d ON p.entry_id = d.entry_id AND p.ma = d.ma AND p.na = d.na
LEFT JOIN rules r ON r.entry_id = d.entry_id AND r.ma = d.ma AND r.na = d.na""")


# ---- declared connections on symmetry images -----------------------------------
def _searched_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the entries whose images are searched; every seventh entry has none."""
    return bc.cells(spark, sf_dir).where("entry_no % 7 <> 0")


def placed_connections(spark: SparkSession, sf_dir: str, frame: DataFrame | None = None) -> DataFrame:
    stated = derived(spark, sf_dir, IMAGE_CONNECTIONS)
    frame = _searched_cells(spark, sf_dir) if frame is None else frame
    return dec.place_declared(outcomes(spark, sf_dir, stated), frame, bc.operations(spark, sf_dir, frame))


def declared_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every resolved declaration lies: image, scope, distance, issue, warnings."""
    at = F.col("placement") == "placed"
    return stored_where_dealt(placed_connections(spark, sf_dir).select(
        "entry_id", "position", "placement", *[F.when(at, F.col(c)).alias(c) for c in (
            "image_index", "tx", "ty", "tz", "contact_scope")],
        F.when(at, fixed("distance", 5)).alias("distance"), "issue",
        F.array_join("warnings", "|").alias("warnings")))


_PLACED_CTE = f"""{bc._IMAGE_CTE}, {_OUTCOME_CTE.replace(SELECTION_CTE + ",", "", 1).replace(_IDS_SQL, _ids_sql(IMAGE_CONNECTIONS), 1)},
usable AS (
  SELECT d.*, n.asu, CAST(substr(d.entry_id, 2) AS BIGINT) AS no, outcome = 'own_residue' AS own,
    CASE WHEN m1 THEN ax ELSE bx END AS mx, CASE WHEN m1 THEN ay ELSE by_ END AS my, CASE WHEN m1 THEN az ELSE bz END AS mz,
    CASE WHEN m1 THEN bx ELSE ax END AS nx, CASE WHEN m1 THEN by_ ELSE ay END AS ny, CASE WHEN m1 THEN bz ELSE az END AS nz_,
    CASE WHEN CAST(substr(d.entry_id, 2) AS BIGINT) % 2 = 0 THEN cos(radians(90e0)) ELSE cos(radians(105e0)) END AS cb
  FROM decided d JOIN named n ON n.entry_id = d.entry_id AND n.position = d.position
  WHERE outcome IN ('candidate', 'own_residue')
),
turned AS (
  SELECT u.entry_id, u.position, u.cb, u.mx, u.my, u.mz, o.image_index, o.is_ncs, u.asu,
    o.a * ((nx - 18e0 * cb * (nz_ / (18e0 * sqrt(1 - cb * cb)))) / 20e0) + o.t1 AS gu,
    o.b * (ny / 19e0) + o.t2 AS gv, o.c * (nz_ / (18e0 * sqrt(1 - cb * cb))) + o.t3 AS gw,
    (mx - 18e0 * cb * (mz / (18e0 * sqrt(1 - cb * cb)))) / 20e0 AS lu, my / 19e0 AS lv,
    mz / (18e0 * sqrt(1 - cb * cb)) AS lw
  FROM usable u JOIN ops o ON u.no % 2 = o.parity AND (NOT o.is_ncs OR u.no % 5 = 0)
  WHERE u.no % 7 <> 0 AND u.asu <> 'same'
),
set_down AS (
  SELECT *, CAST(round(lu - gu) AS INT) AS tx, CAST(round(lv - gv) AS INT) AS ty, CAST(round(lw - gw) AS INT) AS tz FROM turned
),
gaps AS (
  SELECT *, sqrt((20e0 * (gu + tx) + 18e0 * cb * (gw + tz) - mx) ** 2 + (19e0 * (gv + ty) - my) ** 2
    + (18e0 * sqrt(1 - cb * cb) * (gw + tz) - mz) ** 2) AS d
  FROM set_down
),
image_of AS (
  SELECT * FROM gaps WHERE NOT (asu = 'different' AND image_index = 0 AND tx = 0 AND ty = 0 AND tz = 0)
  QUALIFY row_number() OVER (PARTITION BY entry_id, position ORDER BY floor(d * 1e6 + 0.5e0), image_index) = 1
),
put AS (
  SELECT u.*, i.image_index, i.is_ncs, i.tx, i.ty, i.tz, i.d AS image_d, u.no % 7 <> 0 AS searched,
    coalesce(i.image_index <> 0 OR i.tx <> 0 OR i.ty <> 0 OR i.tz <> 0, FALSE) AS made,
    i.image_index % (CASE WHEN u.no % 2 = 0 THEN 4 ELSE 2 END) <> 0 OR i.tx <> 0 OR i.ty <> 0 OR i.tz <> 0 AS crystal
  FROM usable u LEFT JOIN image_of i ON i.entry_id = u.entry_id AND i.position = u.position
),
placed AS (
  SELECT *, CASE WHEN asu = 'different' AND NOT made THEN 'unplaced' WHEN own AND NOT made THEN 'own_residue' ELSE 'placed' END AS placement,
    CASE WHEN made THEN image_index ELSE 0 END AS pi, CASE WHEN made THEN tx ELSE 0 END AS ptx,
    CASE WHEN made THEN ty ELSE 0 END AS pty, CASE WHEN made THEN tz ELSE 0 END AS ptz,
    CASE WHEN made THEN image_d ELSE sqrt((mx - nx) * (mx - nx) + (my - ny) * (my - ny) + (mz - nz_) * (mz - nz_)) END AS pd,
    CASE WHEN NOT made THEN 'explicit' WHEN is_ncs AND crystal THEN 'strict_ncs_and_crystallographic' WHEN is_ncs THEN 'strict_ncs'
      WHEN crystal THEN 'crystallographic' ELSE 'explicit' END AS scope
  FROM put
)"""
_add("declared_images", declared_images, f"""WITH {_PLACED_CTE}
SELECT entry_id, position, placement, CASE WHEN placement = 'placed' THEN pi END AS image_index,
  CASE WHEN placement = 'placed' THEN ptx END AS tx, CASE WHEN placement = 'placed' THEN pty END AS ty,
  CASE WHEN placement = 'placed' THEN ptz END AS tz, CASE WHEN placement = 'placed' THEN scope END AS contact_scope,
  CASE WHEN placement = 'placed' THEN {fixed_sql("pd", 5)} END AS distance,
  CASE WHEN placement = 'unplaced' THEN 'LINK ' || connection_id || ' geometry unresolved: '
    || CASE WHEN searched THEN 'no image in a different unit' ELSE 'symmetry metadata unavailable' END END AS issue,
  concat_ws('|', CASE WHEN placement <> 'own_residue' AND swapped AND (ev OR m1 OR m2) THEN 'declared_connection_conformer_substituted' END,
    CASE WHEN placement = 'placed' AND coalesce(nz, FALSE) THEN 'declared_connection_zero_occupancy_partner' END,
    CASE WHEN placement = 'placed' AND NOT (nw OR nn IN ({_AMINO})) THEN 'declared_donor_outside_supported_classes' END) AS warnings
FROM placed""")


def merged_image_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image-inclusive proximity and declared candidates, one row per atom image."""
    atoms = bc.searched_atoms(spark, sf_dir)
    frame = _searched_cells(spark, sf_dir)
    read = [*_MERGE_KEYS, "distance", "contact_scope"]
    proximity = con.image_candidates(
        con.metals_of(atoms), con.donors_of(atoms), frame, bc.operations(spark, sf_dir, frame)).select(*read)
    declared = placed_connections(spark, sf_dir, frame).where("placement = 'placed'").join(
        frame.select("entry_id"), "entry_id", "left_semi").select(*read)
    return con.merge_candidates(proximity, stored_where_dealt(declared)).select(
        "entry_id", "m_atom_index", "n_atom_index", "image_index", "tx", "ty", "tz",
        fixed("distance", 5).alias("distance"), "contact_scope",
        F.array_join("sources", "|").alias("sources"),
        F.array_join(F.transform("declared", lambda d: d["connection_id"]), "|").alias("connection_ids"),
        "donor_class_supported")


_add("merged_image_candidates", merged_image_candidates, f"""WITH {_PLACED_CTE},
decl AS (
  SELECT entry_id, CASE WHEN m1 THEN fa ELSE fb END AS ma, CASE WHEN m1 THEN fb ELSE fa END AS na, pi, ptx, pty, ptz,
    string_agg(connection_id, '|' ORDER BY connection_id) AS ids, bool_and(nw OR nn IN ({_AMINO})) AS supported,
    any_value(pd) AS d, any_value(scope) AS scope
  FROM placed WHERE placement = 'placed' AND searched GROUP BY ALL
),
prox AS (
  SELECT entry_id, ma, na, image_index AS pi, tx AS ptx, ty AS pty, tz AS ptz, d,
    CASE WHEN is_ncs AND crystal THEN 'strict_ncs_and_crystallographic' WHEN is_ncs THEN 'strict_ncs'
         WHEN crystal THEN 'crystallographic' ELSE 'explicit' END AS scope
  FROM image_pairs WHERE NOT (mc = nc AND mr = nr AND NOT generated) AND CAST(substr(entry_id, 2) AS BIGINT) % 7 <> 0
)
SELECT entry_id, ma AS m_atom_index, na AS n_atom_index, pi AS image_index, ptx AS tx, pty AS ty, ptz AS tz,
  {fixed_sql("coalesce(p.d, d.d)", 5)} AS distance, coalesce(p.scope, d.scope) AS contact_scope,
  CASE WHEN p.d IS NULL THEN 'LINK' WHEN d.ids IS NULL THEN 'proximity_4A' ELSE 'LINK|proximity_4A' END AS sources,
  d.ids AS connection_ids, coalesce(d.supported, TRUE) AS donor_class_supported
FROM prox p FULL OUTER JOIN decl d USING (entry_id, ma, na, pi, ptx, pty, ptz)""")


def polymer_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as sequence positions, the order's largest as its length."""
    lines = table(spark, sf_dir, "lineitem")
    lengths = lines.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("length"))
    position = dec.polymer_position(
        F.col("l_orderkey") % 5 != 0,
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_linenumber")),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("length")),
    )
    return lines.join(lengths, "l_orderkey").groupBy(position.alias("position")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("total")
    )


_add("polymer_positions", polymer_positions, """
WITH l AS (SELECT *, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS len FROM lineitem),
p AS (SELECT l_linenumber, CASE WHEN l_orderkey % 5 = 0 THEN '-' WHEN l_partkey % 9 = 0 OR l_orderkey % 7 = 0 THEN '?'
  WHEN len = 1 THEN 'NC' WHEN l_linenumber = 1 THEN 'N' WHEN l_linenumber = len THEN 'C' ELSE 'M' END AS position FROM l)
SELECT position, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total FROM p GROUP BY position""")


def modeled_termini(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as modelled residues; every third talk lost its last turn."""
    talks = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn + 1 AS position", "role AS name")
    modeled = talks.where("NOT (conv_id % 3 = 0 AND position >= 3)")
    return dec.modeled_termini(modeled, talks, ("conv_id",))


_add("modeled_termini", modeled_termini, """
WITH t AS (SELECT conv_id, turn + 1 AS position, max(turn + 1) OVER (PARTITION BY conv_id) AS len FROM conversations)
SELECT conv_id, position, position = 1 AS is_first, position = len AS is_last FROM t
WHERE (conv_id % 3 <> 0 OR len < 3) AND (position = 1 OR position = len)""")


def restored_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers renamed by a mapping that covers some of them."""
    residues = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_mktsegment AS chain", "c_nationkey AS number")
    mapping = table(spark, sf_dir, "nation").selectExpr(
        "'BUILDING' AS chain", "n_nationkey AS number",
        "CASE WHEN n_nationkey % 2 = 0 THEN 'B' ELSE 'BUILDING' END AS source_chain", "n_nationkey AS source_number",
    )
    return dec.restore_identity(residues, mapping, ("chain", "number"))


_add("restored_identities", restored_identities, """
SELECT c_custkey, c_mktsegment AS coordinate_chain, c_nationkey AS coordinate_number,
  CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey % 2 = 0 THEN 'B' ELSE c_mktsegment END AS chain,
  c_nationkey AS number, c_mktsegment = 'BUILDING' AND c_nationkey % 2 = 0 AS packed FROM customer""")


def matched_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned and accepted lines of an order matched by line number, then in order."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_returnflag", "(CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 10000 + l_suppkey AS serial"
    )
    left = lines.where("l_returnflag <> 'N' OR serial % 5 = 0")
    right = lines.where("l_returnflag <> 'A' OR serial % 3 = 0")
    return dec.match_records(left, right, ["l_orderkey"], "serial").groupBy("l_orderkey").agg(
        F.count_if(F.col("left_serial").isNotNull() & F.col("right_serial").isNotNull()).alias("matched"),
        F.count_if(F.col("right_serial").isNull()).alias("unmatched_left"),
        F.count_if(F.col("left_serial").isNull()).alias("unmatched_right"),
        F.count_if(F.col("left_serial") == F.col("right_serial")).alias("by_serial"),
    )


_add("matched_records", matched_records, """
WITH r AS (SELECT l_orderkey, l_returnflag, (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 10000 + l_suppkey AS s FROM lineitem),
c AS (SELECT l_orderkey, count(*) FILTER (l_returnflag <> 'N' OR s % 5 = 0) AS a, count(*) FILTER (l_returnflag <> 'A' OR s % 3 = 0) AS b,
    count(*) FILTER ((l_returnflag <> 'N' OR s % 5 = 0) AND (l_returnflag <> 'A' OR s % 3 = 0)) AS common FROM r GROUP BY 1)
SELECT l_orderkey, common + least(a - common, b - common) AS matched, a - common - least(a - common, b - common) AS unmatched_left,
  b - common - least(a - common, b - common) AS unmatched_right, common AS by_serial FROM c WHERE a + b > 0""")


# ---- catalog -------------------------------------------------------------------
COMPONENT_ATOMS = """
SELECT CAST(l_orderkey AS STRING) AS component_id, CAST((CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 10000 + l_suppkey AS STRING) AS atom_id,
  split_part('FE,S,N,C,O,NI', ',', CAST(l_partkey % 6 + 1 AS INT)) AS element,
  (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 10000 + l_suppkey AS place FROM {lineitem}
"""
COMPONENT_BONDS = f"""
SELECT component_id, atom_id AS atom_id_1, other AS atom_id_2 FROM (
  SELECT component_id, atom_id, lead(atom_id, 1) OVER (PARTITION BY component_id ORDER BY place) AS other FROM ({COMPONENT_ATOMS}) s1
  UNION ALL
  SELECT component_id, atom_id, lead(atom_id, 2) OVER (PARTITION BY component_id ORDER BY place) AS other FROM ({COMPONENT_ATOMS}) s2) b
WHERE other IS NOT NULL
"""


def formula_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    formulas = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS order_key",
        "concat('C', l_linenumber, ' H', CAST(l_quantity AS INT), CASE WHEN l_partkey % 3 = 0 THEN ' Zn2' ELSE ' N' END) AS formula",
    )
    return cat.formula_elements(formulas, "order_key", "formula")


_add("formula_elements", formula_elements, """
WITH t AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_key, 'C' AS element, l_linenumber AS n FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'H', CAST(l_quantity AS BIGINT) FROM lineitem
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), CASE WHEN l_partkey % 3 = 0 THEN 'ZN' ELSE 'N' END, CASE WHEN l_partkey % 3 = 0 THEN 2 ELSE 1 END FROM lineitem)
SELECT order_key, element, CAST(sum(n) AS BIGINT) AS count FROM t GROUP BY ALL""")


def component_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    atoms = derived(spark, sf_dir, COMPONENT_ATOMS).drop("place")
    bonds = derived(spark, sf_dir, COMPONENT_BONDS)
    components = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS component_id",
        "CASE o_orderkey % 4 WHEN 0 THEN 'C2 H4 Fe' WHEN 1 THEN 'C6 H6' WHEN 2 THEN '' ELSE '?' END AS formula",
    )
    return cat.build_catalog(components, atoms, bonds)


_add("component_catalog", component_catalog, f"""
WITH a AS ({plain(COMPONENT_ATOMS)}), b AS ({plain(COMPONENT_BONDS)}),
e AS (SELECT component_id, atom_id_1 AS f, atom_id_2 AS t FROM b UNION SELECT component_id, atom_id_2, atom_id_1 FROM b),
k AS (SELECT DISTINCT e.component_id FROM e JOIN a s ON s.component_id = e.component_id AND s.atom_id = f AND s.element = 'S'
  JOIN a m ON m.component_id = e.component_id AND m.atom_id = t AND m.element IN ('FE', 'NI') GROUP BY e.component_id, f HAVING count(*) >= 2),
n AS (SELECT component_id, count(*) AS n, bool_or(element IN ('FE', 'NI')) AS metal FROM a GROUP BY 1),
o AS (SELECT CAST(o_orderkey AS VARCHAR) AS component_id, CASE o_orderkey % 4 WHEN 0 THEN 'C2 H4 Fe' WHEN 1 THEN 'C6 H6' ELSE '?' END AS formula, o_orderkey % 4 AS q FROM orders)
SELECT o.component_id, formula, CASE WHEN k.component_id IS NOT NULL THEN 'cluster' ELSE '' END AS structural_class
FROM o LEFT JOIN n ON n.component_id = o.component_id LEFT JOIN k ON k.component_id = o.component_id
WHERE NOT coalesce(n.n = 1 AND metal, FALSE) AND (q = 0 OR (q >= 2 AND coalesce(metal, FALSE)))""")


# ---- reflections ---------------------------------------------------------------
REFLECTIONS = """
SELECT CAST(l_suppkey AS STRING) AS entry_id, CAST(l_linenumber - 4 AS INT) AS h, CAST(l_partkey % 7 - 3 AS INT) AS k,
  CAST(CAST(l_quantity AS BIGINT) % 5 - 2 AS INT) AS l, l_quantity / 10e0 AS d,
  CASE WHEN l_partkey % 31 <> 0 THEN l_extendedprice / 1000e0 END AS fwt, l_tax * 1000e0 AS phwt,
  l_extendedprice / 9000e0 AS delfwt, l_tax * 1000e0 + 5e0 AS phdelwt,
  CASE WHEN l_partkey % 37 <> 0 THEN l_extendedprice / 1300e0 END AS fc_all, l_tax * 1000e0 - 3e0 AS phic_all,
  l_orderkey, l_linenumber, l_partkey FROM {lineitem}
"""


def resolution_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ref.resolution_range(derived(spark, sf_dir, REFLECTIONS))


_add("resolution_ranges", resolution_ranges, f"""
SELECT entry_id, max(d) AS resolution_low, min(d) AS resolution_high FROM ({plain(REFLECTIONS)}) WHERE fwt IS NOT NULL AND d > 0 GROUP BY entry_id""")


def coefficient_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ref.coefficient_residual(derived(spark, sf_dir, REFLECTIONS))
    return found.withColumn("max_residual", fixed("max_residual", 5))


_add("coefficient_residuals", coefficient_residuals, f"""
WITH p AS (SELECT *, fwt * cos(radians(phwt)) AS a, fwt * sin(radians(phwt)) AS b, fc_all * cos(radians(phic_all)) AS c,
    fc_all * sin(radians(phic_all)) AS e, 2 * delfwt * cos(radians(phdelwt)) AS f, 2 * delfwt * sin(radians(phdelwt)) AS g
  FROM ({plain(REFLECTIONS)}) WHERE fwt IS NOT NULL AND fc_all IS NOT NULL)
SELECT entry_id, count(*) AS usable_reflections,
  {fixed_sql("max(sqrt((a - c - f) ** 2 + (b - e - g) ** 2) / greatest(1e0, sqrt((a - c) ** 2 + (b - e) ** 2), sqrt(f * f + g * g), sqrt(a * a + b * b), sqrt(c * c + e * e)))", 5)} AS max_residual
FROM p GROUP BY entry_id""")


def normalized_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    reflections = derived(spark, sf_dir, REFLECTIONS)
    owners = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("entry_id"))
    # two operations of each entry: the identity and a two-fold axis
    sides = F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(("r11", "r22", "r33"), r)])
        for r in ((1.0, 1.0, 1.0), (-1.0, 1.0, -1.0))])
    ops = owners.select("entry_id", F.inline(sides)).withColumns(
        {c: F.lit(0.0) for c in ("r12", "r13", "r21", "r23", "r31", "r32")}
    ).withColumn("is_ncs", F.lit(False))
    done = ref.normalize_coefficients(ref.centric_flags(reflections, ops))
    return done.select(
        "entry_id", "l_orderkey", "l_linenumber", "l_partkey", "centric",
        fixed("fwt", 6).alias("fwt"), fixed("phwt", 6).alias("phwt"),
        fixed("delfwt", 6).alias("delfwt"), fixed("phdelwt", 6).alias("phdelwt"),
    )


_add("normalized_coefficients", normalized_coefficients, f"""
WITH p AS (SELECT *, k = 0 OR (h = 0 AND k = 0 AND l = 0) AS centric, fwt IS NOT NULL AND fc_all IS NOT NULL AS whole,
    fwt * cos(radians(phwt)) AS a, fwt * sin(radians(phwt)) AS b, fc_all * cos(radians(phic_all)) AS c, fc_all * sin(radians(phic_all)) AS e
  FROM ({plain(REFLECTIONS)})),
n AS (SELECT *, CASE WHEN centric THEN (a + c) / 2 ELSE a END AS x, CASE WHEN centric THEN (b + e) / 2 ELSE b END AS y FROM p)
SELECT entry_id, l_orderkey, l_linenumber, l_partkey, centric,
  CASE WHEN whole THEN {fixed_sql("sqrt(x * x + y * y)", 6)} ELSE {fixed_sql("fwt", 6)} END AS fwt,
  CASE WHEN whole THEN {fixed_sql("degrees(atan2(y, x))", 6)} ELSE {fixed_sql("phwt", 6)} END AS phwt,
  CASE WHEN whole THEN {fixed_sql("sqrt((x - c) ** 2 + (y - e) ** 2)", 6)} ELSE {fixed_sql("delfwt", 6)} END AS delfwt,
  CASE WHEN whole THEN {fixed_sql("degrees(atan2(y - e, x - c))", 6)} ELSE {fixed_sql("phdelwt", 6)} END AS phdelwt
FROM n""")


# ---- sources -------------------------------------------------------------------
def web_page_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and documents as cached files: which are served pages, which usable."""
    pages = table(spark, sf_dir, "pages").selectExpr("concat('page', page_id) AS name", "concat('  ', html) AS body")
    docs = table(spark, sf_dir, "documents").selectExpr("concat('doc', doc_id) AS name", "CASE WHEN doc_id % 9 = 0 THEN '' ELSE text END AS body")
    files = pages.unionByName(docs).select("name", F.substring("body", 1, 64).alias("head"), F.octet_length("body").alias("length"))
    return files.select("name", src.looks_like_page("head", "length").alias("page"), src.usable("head", "length").alias("usable"))


_add("web_page_reject", web_page_reject, """
WITH f AS (SELECT 'page' || page_id AS name, '  ' || html AS body FROM pages UNION ALL
  SELECT 'doc' || doc_id, CASE WHEN doc_id % 9 = 0 THEN '' ELSE text END FROM documents),
j AS (SELECT *, regexp_matches(lower(substring(body, 1, 64)), '^\\s*(<!doctype|<html|<[?]xml)') AND strlen(body) <= 1048576 AS page FROM f)
SELECT name, page, strlen(body) > 0 AND NOT page AS usable FROM j""")


def best_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names built from orders: the best candidate per entry and kind."""
    names = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS entry_id",
        "concat('/data/', o_custkey, '/', o_custkey, CASE o_orderkey % 6 WHEN 0 THEN '_final.mtz' WHEN 1 THEN '_final.mtz.gz' WHEN 2 THEN '_final.cif'"
        " WHEN 3 THEN '_final.pdb' WHEN 4 THEN '_final.cif.gz' ELSE '.txt' END) AS path",
    )
    return src.best_files(src.with_choice(names))


_add("best_files", best_files, """
WITH f AS (SELECT o_custkey AS c, o_orderkey % 6 AS q FROM orders),
r AS (SELECT c, CASE WHEN q <= 1 THEN 'mtz' ELSE 'coordinates' END AS kind,
    CASE q WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 4 THEN 1 ELSE 2 END AS p,
    CASE q WHEN 0 THEN '_final.mtz' WHEN 1 THEN '_final.mtz.gz' WHEN 2 THEN '_final.cif' WHEN 3 THEN '_final.pdb' ELSE '_final.cif.gz' END AS s FROM f WHERE q < 5)
SELECT CAST(c AS VARCHAR) AS entry_id, kind, arg_min('/data/' || c || '/' || c || s, p) AS path FROM r GROUP BY ALL""")


def complete_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS entry_id",
        "concat(o_custkey, CASE o_orderkey % 6 WHEN 0 THEN '_final.mtz' WHEN 2 THEN '_final.cif' ELSE '.txt' END) AS path",
    )
    return src.complete_entries(src.with_choice(names))


_add("complete_entries", complete_entries, """
SELECT CAST(o_custkey AS VARCHAR) AS entry_id FROM orders GROUP BY o_custkey
HAVING bool_or(o_orderkey % 6 = 0) AND bool_or(o_orderkey % 6 = 2)""")


def id_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts read as id lists: distinct tokens and whether they are ids."""
    return src.id_tokens(table(spark, sf_dir, "documents"), "text").select("token", "valid")


_add("id_tokens", id_tokens, """
WITH t AS (SELECT unnest(regexp_split_to_array(regexp_replace(text, '#[^\\n]*', ' ', 'g'), '[, \\t\\n\\f\\r\\x0b]+')) AS token FROM documents)
SELECT DISTINCT CASE WHEN regexp_full_match(token, '[A-Za-z0-9]{4}') THEN lower(token) ELSE token END AS token,
  regexp_full_match(token, '[A-Za-z0-9]{4}') AS valid FROM t WHERE token <> ''""")


def atom_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written as coordinate records, order by order, and read back."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS entry_id",
        "(CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 10000 + l_suppkey AS position",
        "CASE WHEN l_partkey % 4 = 0 THEN 'MODEL        1' ELSE concat('ATOM  ', lpad(CAST(l_suppkey AS STRING), 5, ' '), '  ', rpad(concat('O', l_linenumber), 3, ' '),"
        " l_returnflag, 'HIS', ' A', lpad(CAST(l_partkey % 9999 AS STRING), 4, ' '), '    ', repeat(' ', 23), lpad(CAST(l_discount AS STRING), 6, ' '), repeat(' ', 16), ' O') END AS line",
    )
    return src.atom_records(lines).select(
        "entry_id", "position", "model_index", "serial", "atom_name", "altloc", "residue_name", "chain_id",
        "residue_number", "insertion_code", "occupancy_raw", "element", "source_order",
    )


_add("atom_records", atom_records, """
WITH l AS (SELECT *, (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 10000 + l_suppkey AS position FROM lineitem),
n AS (SELECT *, greatest(count(*) FILTER (l_partkey % 4 = 0) OVER (PARTITION BY l_orderkey ORDER BY position) - 1, 0) AS m FROM l)
SELECT l_orderkey AS entry_id, position, CAST(m AS INT) AS model_index, CAST(l_suppkey AS INT) AS serial, 'O' || l_linenumber AS atom_name,
  l_returnflag AS altloc, 'HIS' AS residue_name, 'A' AS chain_id, CAST(l_partkey % 9999 AS INT) AS residue_number, '' AS insertion_code,
  CAST(l_discount AS VARCHAR) AS occupancy_raw, 'O' AS element,
  row_number() OVER (PARTITION BY l_orderkey, m ORDER BY position) AS source_order
FROM n WHERE l_partkey % 4 <> 0""")


def statistics_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as residue-statistics tables, one per customer, with a header each."""
    header = " ".join(src.STATISTICS_COLUMNS)
    body = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS entry_id", "o_orderkey + 1 AS position",
        "CASE WHEN o_orderkey % 19 = 0 THEN concat('_ ', repeat('n/a ', 36), '1 1')"
        " WHEN o_orderkey % 17 = 0 THEN concat('ZN A ', o_orderkey, ' ', repeat('bad ', 36), '1 A 1')"
        " WHEN o_orderkey % 5 = 0 THEN concat('HOH 0 ', o_orderkey % 9999, ' ', repeat('1.5 ', 36), '1 ', o_orderkey + 1)"
        " ELSE concat('ZN A ', o_orderkey % 9999, ' ', repeat(concat(CASE WHEN o_orderkey % 3 = 0 THEN 'n/a' ELSE '2.25' END, ' '), 36), '1 A ', o_orderkey + 1) END AS line",
    )
    tops = body.select("entry_id").distinct().select("entry_id", F.lit(0).cast("long").alias("position"), F.lit(header).alias("line"))
    return body.unionByName(tops)


def residue_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, rejects = src.statistics_rows(statistics_lines(spark, sf_dir))
    good = rows.select("entry_id", "position", "RT", "CP", "RN", F.col("ZDa"), "NR", F.lit("").alias("problem"))
    bad = rejects.select(
        "entry_id", "position", *[F.lit(None).cast("string").alias(c) for c in ("RT", "CP", "RN")],
        F.lit(None).cast("double").alias("ZDa"), F.lit(None).cast("int").alias("NR"), "problem",
    )
    return good.unionByName(bad)


_add("residue_statistics", residue_statistics, """
SELECT CAST(o_custkey AS VARCHAR) AS entry_id, o_orderkey + 1 AS position,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'HOH' ELSE 'ZN' END AS "RT",
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN '' ELSE 'A' END AS "CP",
  CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey % 9999 AS VARCHAR) END AS "RN",
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 1.5e0 WHEN o_orderkey % 3 <> 0 THEN 2.25e0 END AS "ZDa",
  CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey + 1 AS INT) END AS "NR",
  CASE WHEN o_orderkey % 17 = 0 THEN 'nonnumeric_metric' ELSE '' END AS problem
FROM orders WHERE o_orderkey % 19 <> 0""")


def literature_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as lines of a distance table; repeated and broken lines are rejects."""
    lines = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS position",
        "CASE WHEN p_partkey % 50 = 0 THEN '# note' WHEN p_partkey % 41 = 0 THEN concat(p_brand, ' O') WHEN p_partkey % 37 = 0 THEN concat(p_brand, ' O ', p_size, ' x 0.1')"
        " WHEN p_partkey % 29 = 0 THEN concat(p_brand, ' O ', p_size, ' 2.1 0') ELSE concat(p_brand, ' O ', p_size, ' 2.5 0.1') END AS line",
    )
    rows, rejects = src.literature_rows(lines)
    kept = rows.groupBy(F.lit("kept").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("residue", "donor", "metal").alias("keys"))
    lost = rejects.groupBy(F.col("problem").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("position").alias("keys"))
    return kept.unionByName(lost)


_add("literature_scan", literature_scan, """
WITH l AS (SELECT p_partkey AS i, p_brand, p_size, CASE WHEN p_partkey % 50 = 0 THEN 'skip' WHEN p_partkey % 41 = 0 THEN 'wrong_field_count'
  WHEN p_partkey % 37 = 0 THEN 'unreadable_value' WHEN p_partkey % 29 = 0 THEN 'non_positive_value' ELSE 'ok' END AS s FROM part),
d AS (SELECT *, CASE WHEN s = 'ok' AND row_number() OVER (PARTITION BY s, p_brand, p_size ORDER BY i) > 1 THEN 'duplicate_key' WHEN s = 'ok' THEN 'kept' ELSE s END AS kind FROM l WHERE s <> 'skip')
SELECT kind, count(*) AS n, count(DISTINCT CASE WHEN kind = 'kept' THEN p_brand || '/' || p_size ELSE CAST(i AS VARCHAR) END) AS keys FROM d GROUP BY kind""")


def json_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties read through a schema; every tenth text is cut short."""
    events = table(spark, sf_dir, "events").withColumn(
        "text", F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    )
    parsed = src.properties(events, "text", "k int")
    limit = ref.resolution_limit(F.col("properties.k").cast("double"), F.col("value"), F.lit(1.5))
    return parsed.select("event_id", F.col("properties.k").alias("k"), limit.alias("resolution"))


_add("json_properties", json_properties, """
WITH e AS (SELECT event_id, value, CASE WHEN event_id % 10 <> 0 THEN CAST(json_extract(props, '$.k') AS INT) END AS k FROM events)
SELECT event_id, k, CASE WHEN coalesce(k, 0) <> 0 AND value > 0 THEN value ELSE 1.5e0 END AS resolution FROM e""")


# ---- streaming -----------------------------------------------------------------
def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table as a file stream."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"


def _orders_as_inputs(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CAST(o_custkey AS STRING) AS entry_id", "CAST(o_orderkey AS STRING) AS metal_site_id",
        "CASE WHEN o_orderkey % 11 <> 0 THEN abs(o_totalprice - 250000D) / 40000D END AS rszd_abs",
        "CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice / 200000D END AS geometry_rms_zbond",
    )


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive as a stream and are ranked against the even orders' distribution."""
    frozen = cut_lineage(value_histogram(_orders_as_inputs(table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0"))))
    folder = _workspace(spark, "score")
    jobs.score_batches(
        _orders_as_inputs(_stream(spark, sf_dir, "orders")), frozen, f"{folder}/scores", f"{folder}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/scores").select(
        "metal_site_id", "density_score", "geometry_score", "site_score", "site_level"
    )


_add("stream_score", stream_score, f"""
WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 <> 0 THEN abs(o_totalprice - 250000e0) / 40000e0 END AS d,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice / 200000e0 END AS g FROM orders),
v AS (SELECT *, {exact_sql("d", 3)} AS d3, {exact_sql("g", 3)} AS g3 FROM s),
fd AS (SELECT d3 AS v, count(*) AS n, sum(count(*)) OVER (ORDER BY d3) AS u FROM v WHERE k % 2 = 0 AND d3 IS NOT NULL GROUP BY d3),
fg AS (SELECT g3 AS v, count(*) AS n, sum(count(*)) OVER (ORDER BY g3) AS u FROM v WHERE k % 2 = 0 AND g3 IS NOT NULL GROUP BY g3),
x AS (SELECT v.k, 100e0 * ((SELECT sum(n) FROM fd) - CASE WHEN f.v = v.d3 THEN f.u - 0.5e0 * f.n ELSE coalesce(f.u, 0) END) / (SELECT sum(n) FROM fd) AS r
      FROM v ASOF LEFT JOIN fd f ON v.d3 >= f.v WHERE v.d3 IS NOT NULL),
y AS (SELECT v.k, 100e0 * ((SELECT sum(n) FROM fg) - CASE WHEN f.v = v.g3 THEN f.u - 0.5e0 * f.n ELSE coalesce(f.u, 0) END) / (SELECT sum(n) FROM fg) AS r
      FROM v ASOF LEFT JOIN fg f ON v.g3 >= f.v WHERE v.g3 IS NOT NULL),
z AS (SELECT v.*, {exact_sql("x.r", 6)} AS ds, {exact_sql("y.r", 6)} AS gs FROM v LEFT JOIN x ON x.k = v.k LEFT JOIN y ON y.k = v.k)
SELECT CAST(k AS VARCHAR) AS metal_site_id, ds AS density_score, gs AS geometry_score, least(ds, gs) AS site_score,
  CASE WHEN d IS NULL AND g IS NULL THEN 'INCOMPLETE' WHEN coalesce(d >= 6, FALSE) OR coalesce(g >= 2, FALSE) OR (coalesce(d >= 3, FALSE) AND coalesce(g >= 1, FALSE)) THEN 'SUSPECT'
    WHEN coalesce(d >= 3, FALSE) OR coalesce(g >= 1, FALSE) THEN 'REVIEW' ELSE 'PASS' END AS site_level
FROM z""")


def stream_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive as a stream and are classified without a distribution."""
    folder = _workspace(spark, "classify")
    verdicts = jobs.classify_stream(_orders_as_inputs(_stream(spark, sf_dir, "orders")))
    jobs.collect_cohort(verdicts, f"{folder}/scores", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/scores").select("metal_site_id", "density_level", "geometry_level", "verdict_reason")


_add("stream_classify", stream_classify, """
WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 <> 0 THEN abs(o_totalprice - 250000e0) / 40000e0 END AS d,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice / 200000e0 END AS g FROM orders),
l AS (SELECT k, CASE WHEN d IS NULL THEN 'INCOMPLETE' WHEN d < 3 THEN 'PASS' WHEN d < 6 THEN 'REVIEW' ELSE 'SUSPECT' END AS dl,
    CASE WHEN g IS NULL THEN 'INCOMPLETE' WHEN g < 1 THEN 'PASS' WHEN g < 2 THEN 'REVIEW' ELSE 'SUSPECT' END AS gl FROM s)
SELECT CAST(k AS VARCHAR) AS metal_site_id, dl AS density_level, gl AS geometry_level,
  CASE WHEN dl = 'INCOMPLETE' AND gl = 'INCOMPLETE' THEN 'no_assessable_evidence' WHEN dl = 'SUSPECT' AND gl = 'SUSPECT' THEN 'density_and_geometry_suspect'
    WHEN dl = 'SUSPECT' THEN 'density_suspect' WHEN gl = 'SUSPECT' THEN 'geometry_suspect' WHEN dl = 'REVIEW' AND gl = 'REVIEW' THEN 'review_plus_review'
    WHEN dl = 'REVIEW' THEN 'density_review' WHEN gl = 'REVIEW' THEN 'geometry_review' ELSE 'all_available_components_pass' END AS verdict_reason
FROM l""")


def stream_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live counts of event types, the final state after the whole stream arrived."""
    folder = _workspace(spark, "status")
    counts = jobs.status_stream(_stream(spark, sf_dir, "events"), ["event_type"])

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/counts")

    counts.writeStream.outputMode("complete").foreachBatch(keep).option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/counts")


_add("stream_status_counts", stream_status_counts, "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")


def _waves(spark: SparkSession, rows: DataFrame, folder: str, wave: int) -> DataFrame:
    """Write the rows of one wave and return the folder of all waves as a stream."""
    rows.write.parquet(f"{folder}/wave={wave}")
    return spark.readStream.schema(rows.schema).parquet(f"{folder}/wave=*")


def stream_score_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive in three batches that repeat sites, inside a batch and across batches."""
    orders = table(spark, sf_dir, "orders")
    frozen = cut_lineage(value_histogram(_orders_as_inputs(orders.where("o_orderkey % 2 = 0"))))
    folder = _workspace(spark, "repeats")
    for wave in range(3):
        own = orders.where(F.col("o_orderkey") % 3 <= wave).withColumn(
            "o_totalprice", F.col("o_totalprice") + 1000.0 * wave)
        twice = own.where("o_orderkey % 5 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 60000.0)
        arriving = _waves(spark, _orders_as_inputs(own.unionByName(twice)), f"{folder}/in", wave)
        jobs.score_batches(arriving, frozen, f"{folder}/scores", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/scores").select(
        "metal_site_id", "density_score", "geometry_score", "site_score", F.col("batch").cast("long").alias("batch"))


_add("stream_score_repeats", stream_score_repeats, f"""
WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 <> 0 THEN abs(o_totalprice - 250000e0) / 40000e0 END AS d,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice / 200000e0 END AS g FROM orders WHERE o_orderkey % 2 = 0),
h AS (SELECT {exact_sql("d", 3)} AS d3, {exact_sql("g", 3)} AS g3 FROM s),
came AS (
  SELECT o_orderkey AS k, w AS batch, o_totalprice + 1000e0 * w + 60000e0 * t AS p
  FROM orders, (VALUES (0), (1), (2)) AS waves(w), (VALUES (0), (1)) AS times(t)
  WHERE o_orderkey % 3 = w AND (t = 0 OR o_orderkey % 5 = 0)
),
named AS (
  SELECT *, CASE WHEN k % 11 <> 0 THEN abs(p - 250000e0) / 40000e0 END AS d, CASE WHEN k % 7 <> 0 THEN p / 200000e0 END AS g FROM came
),
kept AS (
  SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY k ORDER BY d NULLS FIRST, g NULLS FIRST) = 1
),
v AS (SELECT *, {exact_sql("d", 3)} AS d3, {exact_sql("g", 3)} AS g3 FROM kept),
fd AS (SELECT d3 AS v, count(*) AS n, sum(count(*)) OVER (ORDER BY d3) AS u FROM h WHERE d3 IS NOT NULL GROUP BY d3),
fg AS (SELECT g3 AS v, count(*) AS n, sum(count(*)) OVER (ORDER BY g3) AS u FROM h WHERE g3 IS NOT NULL GROUP BY g3),
x AS (SELECT v.k, 100e0 * ((SELECT sum(n) FROM fd) - CASE WHEN f.v = v.d3 THEN f.u - 0.5e0 * f.n ELSE coalesce(f.u, 0) END) / (SELECT sum(n) FROM fd) AS r
      FROM v ASOF LEFT JOIN fd f ON v.d3 >= f.v WHERE v.d3 IS NOT NULL),
y AS (SELECT v.k, 100e0 * ((SELECT sum(n) FROM fg) - CASE WHEN f.v = v.g3 THEN f.u - 0.5e0 * f.n ELSE coalesce(f.u, 0) END) / (SELECT sum(n) FROM fg) AS r
      FROM v ASOF LEFT JOIN fg f ON v.g3 >= f.v WHERE v.g3 IS NOT NULL),
z AS (SELECT v.*, {exact_sql("x.r", 6)} AS ds, {exact_sql("y.r", 6)} AS gs FROM v LEFT JOIN x ON x.k = v.k LEFT JOIN y ON y.k = v.k)
SELECT CAST(k AS VARCHAR) AS metal_site_id, ds AS density_score, gs AS geometry_score, least(ds, gs) AS site_score, batch FROM z""")


def stream_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs accumulate over two waves; the cohort is refused, frozen, and then left alone."""
    folder = _workspace(spark, "cohort")
    inputs = _orders_as_inputs(table(spark, sf_dir, "orders")).withColumns({
        "score_inputs_status": F.lit("complete"), "context_warning": F.lit(False),
        "context_warning_reasons": F.lit("")})
    rows = manifest(spark, sf_dir)
    late = F.col("status").isin("skip", "error") | F.col("retryable")
    finished = rows.withColumns({
        "status": F.when(late, F.lit("ok")).otherwise(F.col("status")), "retryable": F.lit(False)})
    steps = []
    first = F.col("metal_site_id").cast("long") % 3 != 0
    for step, (wave, told) in enumerate([(inputs.where(first), rows), (inputs.where(~first), finished), (None, finished)]):
        if wave is not None:
            arriving = _waves(spark, wave, f"{folder}/in", step)
            jobs.collect_cohort(arriving, f"{folder}/inputs", f"{folder}/checkpoint").awaitTermination()
        outcome = jobs.freeze_cohort(
            spark, f"{folder}/inputs", f"{folder}/scores", f"{folder}/reference", told)
        steps.append((step, *(outcome.get(c) for c in (
            "score_status", "score_recoverable_entries", "input_row_count", "input_entry_count",
            "density_reference_size", "geometry_reference_size"))))
    return spark.createDataFrame(
        steps, "step int, score_status string, score_recoverable_entries long, input_row_count long,"
        " input_entry_count long, density_reference_size long, geometry_reference_size long")


_add("stream_cohort", stream_cohort, f"""
WITH m AS ({plain(MANIFEST)}),
t AS (SELECT count(*) FILTER (status = 'skip' OR (status = 'partial' AND retryable)
  OR (status = 'error' AND reason_text <> 'deterministic_processing_error')) AS open FROM m),
c AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS e, count(*) FILTER (o_orderkey % 11 <> 0) AS d,
  count(*) FILTER (o_orderkey % 7 <> 0) AS g FROM orders)
SELECT 0 AS step, 'not_finalized_incomplete_run' AS score_status, open AS score_recoverable_entries,
  CAST(NULL AS BIGINT) AS input_row_count, CAST(NULL AS BIGINT) AS input_entry_count,
  CAST(NULL AS BIGINT) AS density_reference_size, CAST(NULL AS BIGINT) AS geometry_reference_size FROM t
UNION ALL SELECT 1, 'finalized', 0, n, e, d, g FROM c
UNION ALL SELECT 2, 'already_finalized', 0, n, e, d, g FROM c""")


def stream_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of results: the second replaces whole customers in the stored orders."""
    store = EntryStore(spark, _workspace(spark, "replace"), ("sites", "manifest"))
    orders = table(spark, sf_dir, "orders").selectExpr("CAST(o_custkey AS STRING) AS entry_id", "o_orderkey", "o_orderstatus")
    entries = manifest(spark, sf_dir).select("entry_id", "status")
    everyone = orders.select("entry_id").distinct()
    store.commit({"sites": orders.where("o_orderstatus <> 'P'"), "manifest": entries}, everyone, 0)
    store.commit({"sites": orders.where("o_orderstatus = 'P'"), "manifest": entries}, entries.where("status = 'skip'"), 1)
    return store.read("sites")


_add("stream_replace", stream_replace, f"""
WITH m AS ({plain(MANIFEST)}), s AS (SELECT k FROM m WHERE status = 'skip')
SELECT CAST(o_custkey AS VARCHAR) AS entry_id, o_orderkey, o_orderstatus FROM orders
WHERE (o_orderstatus = 'P') = (o_custkey IN (SELECT k FROM s))""")


#: Results of customers in three waves: retries, entries computed anew, and two results of one entry.
RESULTS = """
SELECT CAST(c_custkey AS STRING) AS entry_id, w AS attempt, 'config-a' AS analysis_config_id,
  CASE WHEN w = 0 AND c_custkey % 5 = 0 THEN 'partial' WHEN w = 1 AND c_custkey % 4 = 0 THEN 'error' ELSE 'ok' END AS status,
  w = 0 AND c_custkey % 5 = 0 AS retryable
FROM {customer} CROSS JOIN (SELECT explode(sequence(0, 3)) AS w)
WHERE w = 0 OR (w IN (1, 2) AND c_custkey % 5 = 0) OR (w = 3 AND c_custkey % 7 = 0)
"""


def stream_replace_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of results and a replayed one replace entries in two tables and the manifest."""
    folder = _workspace(spark, "tables")
    store = EntryStore(spark, f"{folder}/store", ("sites", "bonds", "manifest"), buckets=16)
    orders = table(spark, sf_dir, "orders").selectExpr("CAST(o_custkey AS STRING) AS entry_id", "o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    results = derived(spark, sf_dir, RESULTS)

    def stage(final: DataFrame) -> dict[str, DataFrame]:
        sites = orders.join(final.select("entry_id", "attempt"), "entry_id")
        return {"sites": sites, "bonds": sites.join(lines, "o_orderkey").select(
            "entry_id", "o_orderkey", "l_linenumber", "attempt")}

    def run(arriving: DataFrame) -> None:
        jobs.replace_stream(arriving, stage, store, f"{folder}/checkpoint").awaitTermination()

    for wave, attempts in enumerate(((0,), (1, 2), (3,))):
        arriving = _waves(spark, results.where(F.col("attempt").isin(*attempts)), f"{folder}/in", wave)
        run(arriving)
    # the last batch's commit record is lost: the stream runs it again, the store skips it
    target, system = tables._hadoop_path(spark, f"{folder}/checkpoint/commits/2")
    system.delete(target, False)
    run(arriving)
    counted = [
        store.read(name).groupBy("entry_id").agg(
            F.count(F.lit(1)).alias("rows"), F.min("attempt").alias("first"), F.max("attempt").alias("last")
        ).select(F.lit(name).alias("kind"), "entry_id", "rows", "first", "last")
        for name in ("sites", "bonds", "manifest")]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


_add("stream_replace_tables", stream_replace_tables, """
WITH r AS (SELECT c_custkey AS k, w, NOT (w = 0 AND c_custkey % 5 = 0) AND NOT (w = 1 AND c_custkey % 4 = 0) AS final
  FROM customer, (VALUES (0), (1), (2), (3)) AS waves(w)
  WHERE w = 0 OR (w IN (1, 2) AND c_custkey % 5 = 0) OR (w = 3 AND c_custkey % 7 = 0)),
batch AS (SELECT *, row_number() OVER (PARTITION BY k, CASE WHEN w = 0 THEN 0 WHEN w < 3 THEN 1 ELSE 2 END ORDER BY w DESC) AS i FROM r),
m AS (SELECT k, max(w) AS w FROM batch WHERE i = 1 AND final GROUP BY k),
t AS (
  SELECT 'manifest' AS kind, k, w FROM m
  UNION ALL SELECT 'sites', k, w FROM m JOIN orders ON o_custkey = k
  UNION ALL SELECT 'bonds', k, w FROM m JOIN orders ON o_custkey = k JOIN lineitem ON l_orderkey = o_orderkey)
SELECT kind, CAST(k AS VARCHAR) AS entry_id, count(*) AS rows, CAST(min(w) AS INTEGER) AS first, CAST(max(w) AS INTEGER) AS last
FROM t GROUP BY kind, k""")
