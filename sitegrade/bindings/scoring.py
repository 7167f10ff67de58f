"""Scoring queries: orders are sites, line items are their contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.bindings.common import (
    CONTACTS, REFERENCE, SITES, Query, derived, exact_sql, fixed, fixed_sql, plain, table,
)
from sitegrade.functions import scoring as fs
from sitegrade.functions.geometry import bond_zscore, is_outlier
from sitegrade.functions.rounding import decimal_text, with_rounded
from sitegrade.operators import distribution as dist
from sitegrade.operators.bonds import bond_summary
from sitegrade.operators.lookup import lookup_with_fallback
from sitegrade.operators.score_inputs import (
    complete_site_count, duplicate_keys, excess_entries, prepare_score_inputs,
)
from sitegrade.plans.score import POLICY_JSON, score_inputs_against
from sitegrade.session import cut_lineage

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_MISSING_TEXT = ("entry_id", "metal_site_id")

# ---- shared SQL pieces ---------------------------------------------------------
_CONTACTS = plain(CONTACTS)
_REFERENCE = plain(REFERENCE)
_SITES = plain(SITES)
_SCORED_CTE = f"""
contacts AS ({_CONTACTS}), reference AS ({_REFERENCE}), sites AS ({_SITES}),
coarse AS (SELECT kind, max(mu) AS fallback FROM reference GROUP BY kind),
bonds AS (
  SELECT c.*, r.mu, r.sigma, coalesce(r.mu, f.fallback) AS target,
         CASE WHEN r.mu IS NOT NULL THEN 'exact' WHEN f.fallback IS NOT NULL
              THEN 'element_fallback' ELSE 'missing' END AS reference_kind,
         CASE WHEN sqrt(c.precision_index * c.precision_index + r.sigma * r.sigma) > 0
              THEN (c.observed - r.mu)
                   / sqrt(c.precision_index * c.precision_index + r.sigma * r.sigma) END AS z
  FROM contacts c LEFT JOIN reference r ON c.brand = r.brand AND c.kind = r.kind
  LEFT JOIN coarse f ON c.kind = f.kind
)"""


def contact_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as bond rows with reference values and raw z-scores."""
    contacts = derived(spark, sf_dir, CONTACTS)
    reference = derived(spark, sf_dir, REFERENCE)
    found = lookup_with_fallback(
        contacts, reference, {"brand": "brand", "kind": "kind"}, {"kind": "kind"}
    )
    z = bond_zscore("observed", "mu", "sigma", "precision_index")
    return found.withColumn("zscore", z).withColumns(
        {
            "score_eligible": F.col("zscore").isNotNull(),
            "reference_covered": F.col("mu").isNotNull(),
            "multi_donor_detected": F.col("line_status") == "F",
        }
    )


def standard_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same contacts with every column the score-input join expects."""
    owner = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("long").alias("site"),
        F.col("o_custkey").cast("string").alias("entry_id"),
    )
    bonds = contact_bonds(spark, sf_dir).join(owner, "site")
    warning = F.array_compact(F.array(
        F.when(F.abs("zscore") >= 6, F.lit("suspect_multi_donor_group")),
        F.when((F.col("reference_kind") == "missing"), F.lit("declared_non_typical_donor")),
    ))
    return bonds.withColumns(
        {
            "metal_site_id": F.col("site").cast("string"),
            "metal_resname": F.col("brand"),
            "parent_type": F.when(F.col("kind") == "ECONOMY", "ion").otherwise("other"),
            "context_warning_reasons": warning,
            "context_warning": F.size(warning) > 0,
            **{c: F.lit(None).cast("int") for c in (
                "metal_model_index", "metal_chain_index", "metal_residue_index",
                "metal_atom_index")},
        }
    )


def standard_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as site rows with every column the score-input join expects."""
    text = (
        "category", "density_observation_id", "density_scope", "coordinate_mapping_status",
        "metal_resname", "metal_chain", "metal_resnum", "metal_atom", "metal_element",
        "metal_icode", "metal_altloc",
    )
    whole = (
        "density_shared_site_count", "metal_model_index", "metal_chain_index",
        "metal_residue_index", "metal_atom_index", "suspect_multi_donor_residue_group_count",
    )
    return derived(spark, sf_dir, SITES).withColumns(
        {
            "zd_minus": -F.abs("zd_main"),
            "zd_plus": F.abs("zd_main"),
            "density_is_shared": F.lit(None).cast("boolean"),
            "context_warning": F.col("o_orderstatus") == "P",
            "context_warning_reasons": F.when(
                F.col("o_orderstatus") == "P", F.array(F.lit("zero_occupancy_neighbor"))
            ).otherwise(F.array().cast("array<string>")),
            **{c: F.lit(None).cast("string") for c in text},
            **{c: F.lit(None).cast("int") for c in whole},
        }
    )


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score inputs of the whole cohort: every selected or bonded site once."""
    return prepare_score_inputs(
        standard_sites(spark, sf_dir), standard_bonds(spark, sf_dir)
    )


#: The cohort in SQL: sites with their aggregated contacts, three-decimal keys.
_COHORT_CTE = f"""{_SCORED_CTE},
summed AS (
  SELECT site, count(*) AS assigned, count(mu) AS covered, count(z) AS scored,
         sqrt(avg(z * z)) AS rms
  FROM bonds WHERE site IN (SELECT site FROM sites) GROUP BY site
),
chosen AS (SELECT * FROM sites WHERE selected_metal_site_status = 'selected'),
cohort_raw AS (
  SELECT coalesce(s.entry_id, o.entry_id) AS entry_id, coalesce(s.site, b.site) AS site,
         s.site IS NOT NULL AS is_site, abs(s.zd_main) AS rszd_abs, b.rms,
         coalesce(b.assigned, 0) AS assigned, coalesce(b.covered, 0) AS covered,
         coalesce(b.scored, 0) AS scored, s.metal_coordinates_valid AS valid
  FROM chosen s FULL OUTER JOIN summed b ON s.site = b.site
  LEFT JOIN sites o ON o.site = b.site
),
cohort AS (
  SELECT *, {exact_sql("rszd_abs", 3)} AS d3,
         {exact_sql(exact_sql("rms", 6), 3)} AS g3
  FROM cohort_raw
)"""


def _cohort_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort with its RMS at six decimals, so both engines share histogram keys."""
    return with_rounded(
        cohort(spark, sf_dir), {"geometry_rms_zbond": ("geometry_rms_zbond", 6)}
    )


# ---- levels --------------------------------------------------------------------
def score_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = derived(spark, sf_dir, SITES)
    measured = sites.select(
        "site",
        F.abs("zd_main").alias("rszd_abs"),
        F.when(F.col("site") % 7 != 0, F.abs("zd_main") / 2.5).alias("rms"),
    )
    return (
        fs.with_verdict(measured, "rszd_abs", "rms")
        .withColumn("saturated", fs.is_saturated("rszd_abs"))
        .drop("rszd_abs", "rms")
    )


QUERIES["score_levels"] = score_levels
ORACLES["score_levels"] = f"""
WITH s AS (SELECT site, abs(zd_main) AS d,
                  CASE WHEN site % 7 <> 0 THEN abs(zd_main) / 2.5e0 END AS g
           FROM ({_SITES})),
l AS (SELECT site, d,
   CASE WHEN d IS NULL THEN 'INCOMPLETE' WHEN d < 3 THEN 'PASS' WHEN d < 6 THEN 'REVIEW'
        ELSE 'SUSPECT' END AS density_level,
   CASE WHEN g IS NULL THEN 'INCOMPLETE' WHEN g < 1 THEN 'PASS' WHEN g < 2 THEN 'REVIEW'
        ELSE 'SUSPECT' END AS geometry_level FROM s),
m(density_level, geometry_level, site_level, verdict_reason) AS (VALUES
 ('INCOMPLETE','INCOMPLETE','INCOMPLETE','no_assessable_evidence'),
 ('INCOMPLETE','PASS','PASS','all_available_components_pass'),
 ('INCOMPLETE','REVIEW','REVIEW','geometry_review'),
 ('INCOMPLETE','SUSPECT','SUSPECT','geometry_suspect'),
 ('PASS','INCOMPLETE','PASS','all_available_components_pass'),
 ('PASS','PASS','PASS','all_available_components_pass'),
 ('PASS','REVIEW','REVIEW','geometry_review'),
 ('PASS','SUSPECT','SUSPECT','geometry_suspect'),
 ('REVIEW','INCOMPLETE','REVIEW','density_review'),
 ('REVIEW','PASS','REVIEW','density_review'),
 ('REVIEW','REVIEW','SUSPECT','review_plus_review'),
 ('REVIEW','SUSPECT','SUSPECT','geometry_suspect'),
 ('SUSPECT','INCOMPLETE','SUSPECT','density_suspect'),
 ('SUSPECT','PASS','SUSPECT','density_suspect'),
 ('SUSPECT','REVIEW','SUSPECT','density_suspect'),
 ('SUSPECT','SUSPECT','SUSPECT','density_and_geometry_suspect'))
SELECT site, l.density_level, l.geometry_level, site_level,
  CASE WHEN l.density_level <> 'INCOMPLETE' AND l.geometry_level <> 'INCOMPLETE'
         THEN 'density_and_geometry'
       WHEN l.density_level <> 'INCOMPLETE' THEN 'density_only'
       WHEN l.geometry_level <> 'INCOMPLETE' THEN 'geometry_only'
       ELSE 'no_assessable_evidence' END AS evidence_basis,
  verdict_reason, coalesce(d >= 99.9, FALSE) AS saturated
FROM l JOIN m ON l.density_level = m.density_level AND l.geometry_level = m.geometry_level
"""


# ---- reference lookup ----------------------------------------------------------
def reference_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contact_bonds(spark, sf_dir).select(
        "contact_id",
        "reference_kind",
        fixed("target").alias("target"),
        fixed(
            F.when(
                F.col("target").isNotNull(),
                F.least(F.lit(vocab.SEARCH_RADIUS), F.col("target") + 0.75),
            )
        ).alias("cutoff"),
        fixed("zscore").alias("zscore"),
        is_outlier("zscore").alias("outlier"),
    )


QUERIES["reference_fallback"] = reference_fallback
ORACLES["reference_fallback"] = f"""
WITH {_SCORED_CTE}
SELECT contact_id, reference_kind, {fixed_sql("target")} AS target,
       {fixed_sql("CASE WHEN target + 0.75e0 < 4 THEN target + 0.75e0 WHEN target IS NOT NULL THEN 4e0 END")}
         AS cutoff,
       {fixed_sql("z")} AS zscore, abs(z) >= 6 AS outlier
FROM bonds
"""


# ---- bond summary --------------------------------------------------------------
def site_bond_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = bond_summary(contact_bonds(spark, sf_dir), ["site"], ["contact_order"])
    rounded = [
        "geometry_coverage", "geometry_rms_zbond", "geometry_max_abs_zbond",
        "geometry_mean_abs_zbond", "geometry_mean_signed_zbond",
    ]
    return summary.select(*[fixed(c).alias(c) if c in rounded else F.col(c) for c in summary.columns])


_IS_DECLARED = "declared_connection"
_IS_INFERRED = "coordination_status = 'inferred'"
QUERIES["site_bond_summary"] = site_bond_summary
ORACLES["site_bond_summary"] = f"""
WITH {_SCORED_CTE},
worst AS (
  SELECT site, contact_id, neighbor_resname, neighbor_chain, neighbor_resnum, neighbor_atom,
         CASE WHEN {_IS_DECLARED} THEN 'declared' WHEN {_IS_INFERRED} THEN 'inferred'
              ELSE '' END AS source
  FROM bonds WHERE z IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY site ORDER BY abs(z) DESC, contact_order) = 1
),
agg AS (
  SELECT site, count(*) AS assigned_contact_count,
    count(mu) AS reference_covered_contact_count, count(z) AS geometry_bond_count,
    {fixed_sql("count(mu) / count(*)")} AS geometry_coverage,
    {fixed_sql("sqrt(avg(z * z))")} AS geometry_rms_zbond,
    {fixed_sql("max(abs(z))")} AS geometry_max_abs_zbond,
    {fixed_sql("avg(abs(z))")} AS geometry_mean_abs_zbond,
    {fixed_sql("avg(z)")} AS geometry_mean_signed_zbond,
    count(*) FILTER ({_IS_DECLARED}) AS declared_contact_count,
    count(*) FILTER ({_IS_INFERRED}) AS inferred_contact_count,
    count(z) FILTER ({_IS_DECLARED}) AS declared_scored_bond_count,
    count(z) FILTER ({_IS_INFERRED}) AS inferred_scored_bond_count,
    count(*) FILTER (line_status = 'F') AS multi_donor_contact_count
  FROM bonds GROUP BY site
)
SELECT a.*, w.contact_id AS worst_bond, w.source AS worst_bond_source,
  w.neighbor_resname AS worst_bond_neighbor_resname,
  w.neighbor_chain AS worst_bond_neighbor_chain,
  w.neighbor_resnum AS worst_bond_neighbor_resnum,
  w.neighbor_atom AS worst_bond_neighbor_atom,
  CASE WHEN declared_scored_bond_count > 0 AND inferred_scored_bond_count > 0
         THEN 'declared_and_inferred'
       WHEN declared_scored_bond_count > 0 THEN 'declared_only'
       WHEN inferred_scored_bond_count > 0 THEN 'inferred_only'
       ELSE 'none' END AS geometry_contact_basis
FROM agg a LEFT JOIN worst w ON a.site = w.site
"""


# ---- full outer join -----------------------------------------------------------
def score_inputs_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort(spark, sf_dir).select(
        "entry_id",
        "metal_site_id",
        "selected_metal_site_status",
        "category",
        fixed("rszd", 5).alias("rszd"),
        fixed("rszd_abs", 5).alias("rszd_abs"),
        "density_saturated",
        "assigned_contact_count",
        "reference_covered_contact_count",
        "geometry_bond_count",
        fixed("geometry_coverage").alias("geometry_coverage"),
        fixed("geometry_rms_zbond").alias("geometry_rms_zbond"),
        "context_warning",
        F.array_join("context_warning_reasons", "|").alias("context_warning_reasons"),
        "score_inputs_status",
        F.array_join("score_inputs_missing_reasons", "|").alias("missing_reasons"),
    )


QUERIES["score_inputs_full_outer"] = score_inputs_full_outer
ORACLES["score_inputs_full_outer"] = f"""
WITH {_COHORT_CTE},
noted AS (
  SELECT site, bool_or(abs(z) >= 6) AS far, bool_or(reference_kind = 'missing') AS lost,
         min(contact_order) FILTER (abs(z) >= 6) AS far_at,
         min(contact_order) FILTER (reference_kind = 'missing') AS lost_at,
         arg_min(kind, contact_order) AS first_kind
  FROM bonds GROUP BY site
)
SELECT c.entry_id, CAST(c.site AS VARCHAR) AS metal_site_id,
  CASE WHEN is_site THEN 'selected' ELSE 'selected_without_density_row' END
    AS selected_metal_site_status,
  CASE WHEN NOT is_site THEN CASE WHEN n.first_kind = 'ECONOMY' THEN 'metal' ELSE '' END END AS category,
  CASE WHEN is_site THEN {fixed_sql(exact_sql("s.zd_main", 12), 5)} END AS rszd,
  {fixed_sql(exact_sql("rszd_abs", 12), 5)} AS rszd_abs,
  CASE WHEN is_site THEN coalesce(rszd_abs >= 99.9, FALSE) END AS density_saturated,
  assigned AS assigned_contact_count, covered AS reference_covered_contact_count,
  scored AS geometry_bond_count,
  {fixed_sql("CASE WHEN assigned > 0 THEN covered / assigned ELSE 0e0 END")} AS geometry_coverage,
  {fixed_sql("rms")} AS geometry_rms_zbond,
  CASE WHEN is_site THEN s.o_orderstatus = 'P' ELSE coalesce(far, FALSE) OR coalesce(lost, FALSE) END AS context_warning,
  CASE WHEN is_site THEN CASE WHEN s.o_orderstatus = 'P' THEN 'zero_occupancy_neighbor' ELSE '' END
       WHEN coalesce(far, FALSE) AND coalesce(lost, FALSE) THEN
            CASE WHEN far_at <= lost_at THEN 'suspect_multi_donor_group|declared_non_typical_donor'
                 ELSE 'declared_non_typical_donor|suspect_multi_donor_group' END
       WHEN coalesce(far, FALSE) THEN 'suspect_multi_donor_group'
       WHEN coalesce(lost, FALSE) THEN 'declared_non_typical_donor' ELSE '' END AS context_warning_reasons,
  CASE WHEN rszd_abs IS NOT NULL AND scored > 0 THEN 'complete'
       WHEN rszd_abs IS NOT NULL THEN 'density_only'
       WHEN scored > 0 THEN 'geometry_only' ELSE 'unscorable' END AS score_inputs_status,
  concat_ws('|',
    CASE WHEN is_site AND valid = FALSE THEN 'non_finite_metal_coordinates' END,
    CASE WHEN rszd_abs IS NULL THEN 'rszd_unavailable' END,
    CASE WHEN NOT is_site THEN 'density_row_unavailable' END,
    CASE WHEN is_site AND assigned = 0 THEN 'no_assigned_contacts' END,
    CASE WHEN assigned > 0 AND covered = 0 THEN 'no_geometry_reference'
         WHEN assigned > 0 AND scored < covered THEN 'zbond_unavailable_for_reference' END,
    CASE WHEN assigned > 0 AND covered < assigned THEN 'partial_geometry_coverage' END)
    AS missing_reasons
FROM cohort c LEFT JOIN sites s ON s.site = c.site LEFT JOIN noted n ON n.site = c.site
"""


# ---- placeholders --------------------------------------------------------------
def _entry_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as entries: five sites wanted for key multiples of five, else none."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("entry_id"),
        (F.col("c_custkey") % 5 * 4).cast("int").alias("n_metals"),
        F.when(F.col("c_custkey") % 3 == 0, "bond_stage_failure").alias("missing_reason"),
    )


def placeholder_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = complete_site_count(cohort(spark, sf_dir), _entry_targets(spark, sf_dir))
    return complete.select(
        "entry_id",
        "metal_site_id",
        "metal_atom_index",
        "selected_metal_site_status",
        "score_inputs_status",
        F.array_join("score_inputs_missing_reasons", "|").alias("missing_reasons"),
    )


_MISSING_SQL = """concat_ws('|',
    CASE WHEN is_site AND valid = FALSE THEN 'non_finite_metal_coordinates' END,
    CASE WHEN rszd_abs IS NULL THEN 'rszd_unavailable' END,
    CASE WHEN NOT is_site THEN 'density_row_unavailable' END,
    CASE WHEN is_site AND assigned = 0 THEN 'no_assigned_contacts' END,
    CASE WHEN assigned > 0 AND covered = 0 THEN 'no_geometry_reference'
         WHEN assigned > 0 AND scored < covered THEN 'zbond_unavailable_for_reference' END,
    CASE WHEN assigned > 0 AND covered < assigned THEN 'partial_geometry_coverage' END,
    CASE WHEN CAST(entry_id AS BIGINT) % 3 = 0 THEN 'bond_stage_failure' END)"""
_STATUS_SQL = """CASE WHEN rszd_abs IS NOT NULL AND scored > 0 THEN 'complete'
       WHEN rszd_abs IS NOT NULL THEN 'density_only'
       WHEN scored > 0 THEN 'geometry_only' ELSE 'unscorable' END"""
QUERIES["placeholder_completion"] = placeholder_completion
ORACLES["placeholder_completion"] = f"""
WITH {_COHORT_CTE},
have AS (SELECT entry_id, count(*) AS n FROM cohort GROUP BY entry_id),
gaps AS (
  SELECT CAST(c_custkey AS VARCHAR) AS entry_id, c_custkey,
         unnest(generate_series(coalesce(n, 0) + 1, c_custkey % 5 * 4)) AS place
  FROM customer LEFT JOIN have ON entry_id = CAST(c_custkey AS VARCHAR)
)
SELECT entry_id, CAST(site AS VARCHAR) AS metal_site_id, CAST(NULL AS VARCHAR) AS metal_atom_index,
  CASE WHEN is_site THEN 'selected' ELSE 'selected_without_density_row' END AS selected_metal_site_status,
  {_STATUS_SQL} AS score_inputs_status, {_MISSING_SQL} AS missing_reasons
FROM cohort
UNION ALL
SELECT entry_id, NULL, 'unresolved-' || place, 'selected_site_unresolved', 'unscorable',
  'rszd_unavailable|site_identity_unavailable|site_evidence_unavailable'
  || CASE WHEN c_custkey % 3 = 0 THEN '|bond_stage_failure' ELSE '' END
FROM gaps
"""


def placeholder_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = excess_entries(cohort(spark, sf_dir), _entry_targets(spark, sf_dir))
    return found.select("entry_id", "have", F.col("n_metals").cast("long").alias("n_metals"))


QUERIES["placeholder_excess"] = placeholder_excess
ORACLES["placeholder_excess"] = f"""
WITH {_COHORT_CTE}
SELECT entry_id, count(*) AS have, CAST(CAST(entry_id AS BIGINT) % 5 * 4 AS BIGINT) AS n_metals
FROM cohort WHERE CAST(entry_id AS BIGINT) IN (SELECT c_custkey FROM customer)
GROUP BY entry_id HAVING count(*) > CAST(entry_id AS BIGINT) % 5 * 4
"""


# ---- histogram and ranks -------------------------------------------------------
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dist.value_histogram(_cohort_keys(spark, sf_dir))


QUERIES["value_histogram"] = value_histogram
ORACLES["value_histogram"] = f"""
WITH {_COHORT_CTE}
SELECT 'density' AS component, d3 AS value, count(*) AS count FROM cohort WHERE d3 IS NOT NULL GROUP BY d3
UNION ALL
SELECT 'geometry', g3, count(*) FROM cohort WHERE g3 IS NOT NULL GROUP BY g3
"""


def component_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dist.component_sizes(dist.value_histogram(_cohort_keys(spark, sf_dir)))


QUERIES["component_sizes"] = component_sizes
ORACLES["component_sizes"] = f"""
WITH {_COHORT_CTE}
SELECT 'density' AS component, count(DISTINCT d3) AS distinct_value_count,
       CAST(count(d3) AS BIGINT) AS reference_size FROM cohort
UNION ALL SELECT 'geometry', count(DISTINCT g3), count(g3) FROM cohort
"""

_RANKS_CTE = """
ranked AS (
  SELECT *,
    100e0 * ((SELECT count(d3) FROM cohort)
      - (CASE WHEN d3 IS NULL THEN NULL ELSE rank() OVER (PARTITION BY d3 IS NULL ORDER BY d3) - 1 END)
      - 0.5e0 * count(*) OVER (PARTITION BY d3)) / (SELECT count(d3) FROM cohort) AS d_rank,
    100e0 * ((SELECT count(g3) FROM cohort)
      - (CASE WHEN g3 IS NULL THEN NULL ELSE rank() OVER (PARTITION BY g3 IS NULL ORDER BY g3) - 1 END)
      - 0.5e0 * count(*) OVER (PARTITION BY g3)) / (SELECT count(g3) FROM cohort) AS g_rank
  FROM cohort
)"""


def average_rank_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = cut_lineage(_cohort_keys(spark, sf_dir))
    ranked = dist.rank_against(inputs, dist.value_histogram(inputs), same_cohort=True)
    return ranked.select(
        "metal_site_id",
        fixed("density_rank").alias("density_rank"),
        fixed("geometry_rank").alias("geometry_rank"),
    )


QUERIES["average_rank_score"] = average_rank_score
ORACLES["average_rank_score"] = f"""
WITH {_COHORT_CTE}, {_RANKS_CTE}
SELECT CAST(site AS VARCHAR) AS metal_site_id, {fixed_sql("d_rank")} AS density_rank,
       {fixed_sql("g_rank")} AS geometry_rank FROM ranked
"""


def rank_unseen_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = cut_lineage(_cohort_keys(spark, sf_dir))
    even = F.col("metal_site_id").cast("long") % 2 == 0
    frozen = dist.value_histogram(inputs.where(even))
    return dist.rank_against(inputs.where(~even), frozen).select(
        "metal_site_id",
        fixed("density_rank").alias("density_rank"),
        fixed("geometry_rank").alias("geometry_rank"),
    )


QUERIES["rank_unseen_values"] = rank_unseen_values
ORACLES["rank_unseen_values"] = f"""
WITH {_COHORT_CTE},
frozen_d AS (SELECT d3 AS v, count(*) AS n, sum(count(*)) OVER (ORDER BY d3) AS upto
             FROM cohort WHERE site % 2 = 0 AND d3 IS NOT NULL GROUP BY d3),
frozen_g AS (SELECT g3 AS v, count(*) AS n, sum(count(*)) OVER (ORDER BY g3) AS upto
             FROM cohort WHERE site % 2 = 0 AND g3 IS NOT NULL GROUP BY g3),
asked AS (SELECT * FROM cohort WHERE site % 2 = 1),
with_d AS (SELECT a.site, a.d3, CASE WHEN f.v = a.d3 THEN f.upto - 0.5e0 * f.n
                  ELSE coalesce(f.upto, 0) END AS passed
           FROM asked a ASOF LEFT JOIN frozen_d f ON a.d3 >= f.v),
with_g AS (SELECT a.site, a.g3, CASE WHEN f.v = a.g3 THEN f.upto - 0.5e0 * f.n
                  ELSE coalesce(f.upto, 0) END AS passed
           FROM asked a ASOF LEFT JOIN frozen_g f ON a.g3 >= f.v),
sizes AS (SELECT (SELECT sum(n) FROM frozen_d) AS nd, (SELECT sum(n) FROM frozen_g) AS ng)
SELECT CAST(a.site AS VARCHAR) AS metal_site_id,
  CASE WHEN a.d3 IS NOT NULL THEN {fixed_sql("100e0 * (nd - d.passed) / nd")} END AS density_rank,
  CASE WHEN a.g3 IS NOT NULL THEN {fixed_sql("100e0 * (ng - g.passed) / ng")} END AS geometry_rank
FROM asked a LEFT JOIN with_d d ON a.site = d.site LEFT JOIN with_g g ON a.site = g.site, sizes
"""


# ---- flagship ------------------------------------------------------------------
def final_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The prepared inputs are a table of their own: counted once, ranked once.
    inputs = cut_lineage(_cohort_keys(spark, sf_dir))
    scored = score_inputs_against(inputs, dist.value_histogram(inputs), same_cohort=True)
    return scored.select(
        "entry_id",
        "metal_site_id",
        "density_level",
        "density_score",
        "geometry_level",
        "geometry_score",
        "site_level",
        "site_score",
        "evidence_basis",
        "verdict_reason",
    )


_LEVELS_CTE = f"""
levelled AS (
  SELECT *, {exact_sql("rms", 6)} AS g6,
    CASE WHEN rszd_abs IS NULL THEN 'INCOMPLETE' WHEN rszd_abs < 3 THEN 'PASS'
         WHEN rszd_abs < 6 THEN 'REVIEW' ELSE 'SUSPECT' END AS dl,
    CASE WHEN rms IS NULL THEN 'INCOMPLETE' WHEN {exact_sql("rms", 6)} < 1 THEN 'PASS'
         WHEN {exact_sql("rms", 6)} < 2 THEN 'REVIEW' ELSE 'SUSPECT' END AS gl,
    CASE WHEN rszd_abs >= 99.9 THEN 0e0 ELSE {exact_sql("d_rank", 6)} END AS ds,
    {exact_sql("g_rank", 6)} AS gs
  FROM ranked
)"""
QUERIES["final_verdict"] = final_verdict
ORACLES["final_verdict"] = f"""
WITH {_COHORT_CTE}, {_RANKS_CTE}, {_LEVELS_CTE}
SELECT entry_id, CAST(site AS VARCHAR) AS metal_site_id, dl AS density_level,
  ds AS density_score, gl AS geometry_level, gs AS geometry_score,
  CASE WHEN dl = 'INCOMPLETE' AND gl = 'INCOMPLETE' THEN 'INCOMPLETE'
       WHEN 'SUSPECT' IN (dl, gl) OR (dl = 'REVIEW' AND gl = 'REVIEW') THEN 'SUSPECT'
       WHEN 'REVIEW' IN (dl, gl) THEN 'REVIEW' ELSE 'PASS' END AS site_level,
  CASE WHEN ds IS NULL THEN gs WHEN gs IS NULL THEN ds WHEN ds < gs THEN ds ELSE gs END AS site_score,
  CASE WHEN dl <> 'INCOMPLETE' AND gl <> 'INCOMPLETE' THEN 'density_and_geometry'
       WHEN dl <> 'INCOMPLETE' THEN 'density_only' WHEN gl <> 'INCOMPLETE' THEN 'geometry_only'
       ELSE 'no_assessable_evidence' END AS evidence_basis,
  CASE WHEN dl = 'INCOMPLETE' AND gl = 'INCOMPLETE' THEN 'no_assessable_evidence'
       WHEN dl = 'SUSPECT' AND gl = 'SUSPECT' THEN 'density_and_geometry_suspect'
       WHEN dl = 'SUSPECT' THEN 'density_suspect' WHEN gl = 'SUSPECT' THEN 'geometry_suspect'
       WHEN dl = 'REVIEW' AND gl = 'REVIEW' THEN 'review_plus_review'
       WHEN dl = 'REVIEW' THEN 'density_review' WHEN gl = 'REVIEW' THEN 'geometry_review'
       ELSE 'all_available_components_pass' END AS verdict_reason
FROM levelled
"""


# ---- identity, invariants, provenance ------------------------------------------
def distribution_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dist.fingerprint(dist.value_histogram(_cohort_keys(spark, sf_dir)), POLICY_JSON)


_HIST_CTE = """
hist AS (
  SELECT 'density' AS component, CAST(round(d3 * 1000) AS BIGINT) AS m, count(*) AS n
  FROM cohort WHERE d3 IS NOT NULL GROUP BY d3
  UNION ALL
  SELECT 'geometry', CAST(round(g3 * 1000) AS BIGINT), count(*) FROM cohort WHERE g3 IS NOT NULL GROUP BY g3
)"""
QUERIES["distribution_fingerprint"] = distribution_fingerprint
ORACLES["distribution_fingerprint"] = f"""
WITH {_COHORT_CTE}, {_HIST_CTE},
b AS (SELECT component, CAST(floor(m / 1000) AS BIGINT) AS bucket,
        sha256(string_agg(component || ',' || m || ',' || n, chr(10) ORDER BY m)) AS line
      FROM hist GROUP BY 1, 2),
t AS (SELECT component, CAST(floor(bucket / 1000) AS BIGINT) AS top,
        sha256(string_agg(line, chr(10) ORDER BY bucket)) AS line FROM b GROUP BY 1, 2)
SELECT sha256('{POLICY_JSON}' || chr(10) || string_agg(line, chr(10) ORDER BY component, top))
  AS fingerprint FROM t
"""


def distribution_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram with planted defects, so every rule has rows to find."""
    hist = dist.value_histogram(_cohort_keys(spark, sf_dir))
    milli = F.round(F.col("value") * 1000).cast("long")
    spoiled = hist.withColumns(
        {
            "value": F.when(milli % 7 == 0, -F.col("value") - 1).otherwise(F.col("value")),
            "component": F.when(milli % 5 == 0, F.lit("other")).otherwise(F.col("component")),
            "count": F.when(milli % 11 == 0, F.lit(0).cast("long")).otherwise(F.col("count")),
        }
    )
    return dist.violations(spoiled).select(
        "component", "value", "count", "rule"
    )


QUERIES["distribution_violations"] = distribution_violations
ORACLES["distribution_violations"] = f"""
WITH {_COHORT_CTE}, {_HIST_CTE},
s AS (SELECT CASE WHEN m % 5 = 0 THEN 'other' ELSE component END AS component,
        CASE WHEN m % 7 = 0 THEN -(m / 1000e0) - 1 ELSE m / 1000e0 END AS value,
        CASE WHEN m % 11 = 0 THEN 0 ELSE n END AS count FROM hist)
SELECT component, value, count, 'invalid_value' AS rule FROM s WHERE value < 0
UNION ALL SELECT component, value, count, 'invalid_count' FROM s WHERE count < 1
UNION ALL SELECT component, value, count, 'unknown_component' FROM s WHERE component = 'other'
UNION ALL SELECT component, value, max(count), 'duplicate_value' FROM s
  GROUP BY component, value HAVING count(*) > 1
"""


def cohort_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dist.cohort_summary(cohort(spark, sf_dir))


QUERIES["cohort_provenance"] = cohort_provenance
ORACLES["cohort_provenance"] = f"""
WITH {_COHORT_CTE}
SELECT count(*) AS input_row_count, count(DISTINCT entry_id) AS input_entry_count,
  count(DISTINCT CASE WHEN rszd_abs IS NOT NULL OR rms IS NOT NULL THEN entry_id END) AS scorable_entry_count
FROM cohort
"""


def input_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dist.status_histogram(cohort(spark, sf_dir))


QUERIES["input_status_counts"] = input_status_counts
ORACLES["input_status_counts"] = f"""
WITH {_COHORT_CTE}
SELECT {_STATUS_SQL} AS status, count(*) AS count FROM cohort GROUP BY 1
"""


def sorted_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = dist.value_histogram(_cohort_keys(spark, sf_dir))
    return hist.orderBy("component", "value").select(
        "component", decimal_text("value", 3).alias("value_text"), "count"
    )


QUERIES["sorted_distribution"] = sorted_distribution
ORACLES["sorted_distribution"] = f"""
WITH {_COHORT_CTE}, {_HIST_CTE}
SELECT component, CASE WHEN m % 1000 = 0 THEN printf('%d', m // 1000)
   ELSE rtrim(printf('%.3f', m / 1000e0), '0') END AS value_text, n AS count
FROM hist ORDER BY component, m
"""


def exact_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    x = F.col("l_extendedprice") / F.col("l_quantity") * F.col("l_tax") / 7
    rounded = with_rounded(
        lines, {"r3": (x, 3), "r6": (x, 6), "half": (F.col("l_tax") / 16, 3)}
    )
    return rounded.select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").alias("line"),
        "r3", "r6", "half",
    )


QUERIES["exact_rounding"] = exact_rounding
ORACLES["exact_rounding"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS line,
  {exact_sql("x", 3)} AS r3, {exact_sql("x", 6)} AS r6, {exact_sql("h", 3)} AS half
FROM (SELECT *, l_extendedprice / l_quantity * l_tax / 7 AS x, l_tax / 16 AS h FROM lineitem)
"""


def repeated_site_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


QUERIES["duplicate_keys"] = repeated_site_keys
ORACLES["duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
"""
