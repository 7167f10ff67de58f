"""Atom inventory queries over the derived atoms, documents and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.bindings.common import (
    ATOMS, Query, derived, exact_sql, fixed, fixed_sql, plain, table,
)
from sitegrade.functions.geometry import precision_index, precision_reason
from sitegrade.functions.ids import residue_id
from sitegrade.functions.rounding import with_rounded
from sitegrade.operators import inventory as inv
from sitegrade.session import stored

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_METALS = ", ".join(f"'{m}'" for m in vocab.METALS)
_ELEMENTS = ", ".join(f"'{e}'" for e in vocab.ELEMENTS)
#: Audited atoms in SQL: occupancy status and value, element, first model only.
ATOMS_CTE = f"""
deposited AS ({plain(ATOMS)}),
audited AS (
  SELECT * EXCLUDE (element),
    CASE WHEN element IN ({_ELEMENTS}) THEN element END AS element,
    coalesce(CASE WHEN element IN ({_ELEMENTS}) THEN element END, '') AS element_key,
    CASE WHEN element IS NULL THEN 'missing' WHEN element IN ({_ELEMENTS}) THEN 'valid'
         ELSE 'invalid' END AS element_status,
    coalesce(element IN ('H', 'D'), FALSE) AS is_hydrogen,
    CASE WHEN occupancy_raw = '' THEN 'missing' WHEN occupancy_raw = 'nan' THEN 'invalid_non_finite'
         WHEN NOT regexp_matches(occupancy_raw, '^[0-9]+[.][0-9]+$') THEN 'invalid_non_numeric'
         WHEN CAST(occupancy_raw AS DOUBLE) > 1 THEN 'invalid_range' ELSE 'valid' END AS occupancy_status,
    CASE WHEN regexp_matches(occupancy_raw, '^[0-9]+[.][0-9]+$') THEN CAST(occupancy_raw AS DOUBLE) END AS occupancy
  FROM deposited
),
records AS (SELECT *, occupancy_status = 'valid' AS ok FROM audited WHERE model_index = 0),
source AS (
  SELECT * FROM records
  QUALIFY row_number() OVER (
    PARTITION BY entry_id, chain_index, residue_index, atom_name, altloc, element_key
    ORDER BY ok DESC, CASE WHEN ok THEN occupancy END DESC, source_order) = 1
)"""
#: Residue selections and contact atoms in SQL.
SELECTION_CTE = f"""{ATOMS_CTE},
labelled AS (
  SELECT entry_id, chain_index, residue_index, altloc,
         avg(CASE WHEN ok THEN occupancy END) AS mean
  FROM source WHERE altloc <> '' GROUP BY ALL
),
best AS (
  SELECT *, max(mean) OVER (PARTITION BY entry_id, chain_index, residue_index) AS top,
         count(*) OVER (PARTITION BY entry_id, chain_index, residue_index) AS n_labels
  FROM labelled
),
chosen AS (
  SELECT entry_id, chain_index, residue_index,
    coalesce(min(CASE WHEN top - mean <= 1e-12 THEN altloc END), min(altloc)) AS selected_altloc,
    max(n_labels) AS n_labels, max(top) IS NULL AND max(n_labels) > 1 AS fallback
  FROM best GROUP BY ALL
),
selections AS (
  SELECT s.entry_id, s.chain_index, s.residue_index,
    coalesce(any_value(c.selected_altloc), '') AS selected_altloc,
    avg(CASE WHEN s.ok AND s.altloc = coalesce(c.selected_altloc, '') THEN s.occupancy END) AS mean,
    coalesce(any_value(c.n_labels), 0) > 1 AS alternatives,
    coalesce(any_value(c.fallback), FALSE) AS fallback,
    count(DISTINCT CASE WHEN s.element_key <> '' THEN s.atom_name || '/' || s.element_key END) AS sites
  FROM source s LEFT JOIN chosen c USING (entry_id, chain_index, residue_index)
  GROUP BY ALL
),
contact_pool AS (
  SELECT s.*, count(*) OVER w - 1 AS extra,
    row_number() OVER (PARTITION BY s.entry_id, s.chain_index, s.residue_index, s.atom_name
      ORDER BY s.altloc = '', s.ok DESC, CASE WHEN s.ok THEN s.occupancy END DESC, s.source_order) AS place
  FROM source s JOIN selections r USING (entry_id, chain_index, residue_index)
  WHERE s.altloc = '' OR s.altloc = r.selected_altloc
  WINDOW w AS (PARTITION BY s.entry_id, s.chain_index, s.residue_index, s.atom_name)
),
atoms AS (SELECT * EXCLUDE (place) FROM contact_pool WHERE place = 1)"""


def audited_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deposited records with audited occupancy and element."""
    return inv.with_element(inv.with_occupancy(derived(spark, sf_dir, ATOMS)))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the first model."""
    return inv.first_model(audited_atoms(spark, sf_dir))


def source_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-model records with exact duplicates collapsed, dealt by residue."""
    return inv.dedupe_records(records(spark, sf_dir).repartition(*inv.RESIDUE))


def selected_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atoms of the selected conformers: what contacts are searched among."""
    return inv.contact_atoms(source_atoms(spark, sf_dir))


# ---- record audit --------------------------------------------------------------
def occupancy_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        audited_atoms(spark, sf_dir)
        .groupBy("entry_id", "occupancy_status", "element_status")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("occupancy_valid").alias("usable"),
            fixed(F.max("occupancy")).alias("top"),
        )
    )


QUERIES["occupancy_audit"] = occupancy_audit
ORACLES["occupancy_audit"] = f"""
WITH {ATOMS_CTE}
SELECT entry_id, occupancy_status, element_status, count(*) AS n,
  count(*) FILTER (occupancy_status = 'valid') AS usable, {fixed_sql("max(occupancy)")} AS top
FROM audited GROUP BY ALL
"""


def model_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.model_counts(audited_atoms(spark, sf_dir))


QUERIES["model_counts"] = model_counts
ORACLES["model_counts"] = f"""
WITH {ATOMS_CTE}
SELECT entry_id, count(DISTINCT model_index) AS input_model_count,
  count(DISTINCT model_index) > 1 AS multi_model_structure FROM audited GROUP BY entry_id
"""


def record_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one text are one record; a quality label makes a record valid."""
    labelled = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    ranked = labelled.select(
        F.sha2("text", 256).alias("fingerprint"),
        "doc_id",
        F.col("doc_id").alias("source_order"),
        F.col("quality").cast("double").alias("occupancy"),
        F.col("quality").isNotNull().alias("occupancy_valid"),
    )
    return inv.dedupe_records(ranked, ["fingerprint"]).select(
        "fingerprint", "doc_id", "occupancy_valid", "occupancy"
    )


QUERIES["record_dedupe"] = record_dedupe
ORACLES["record_dedupe"] = """
SELECT sha256(text) AS fingerprint, doc_id, quality IS NOT NULL AS occupancy_valid,
       CAST(quality AS DOUBLE) AS occupancy
FROM documents LEFT JOIN labels USING (doc_id)
QUALIFY row_number() OVER (PARTITION BY sha256(text)
  ORDER BY quality IS NOT NULL DESC, quality DESC, doc_id) = 1
"""


def atom_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_atoms(spark, sf_dir).select(
        "entry_id", "chain_index", "residue_index", "atom_name", "altloc", "element_key",
        "source_order", "occupancy_status",
    )


QUERIES["atom_dedupe"] = atom_dedupe
ORACLES["atom_dedupe"] = f"""
WITH {ATOMS_CTE}
SELECT entry_id, chain_index, residue_index, atom_name, altloc, element_key, source_order,
  occupancy_status FROM source
"""


def duplicate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.duplicate_audit(records(spark, sf_dir))


QUERIES["duplicate_audit"] = duplicate_audit
ORACLES["duplicate_audit"] = f"""
WITH RECURSIVE {ATOMS_CTE},
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY entry_id, chain_index, residue_index, atom_name, altloc, element_key
    ORDER BY source_order) AS i
  FROM records
),
walk AS (
  SELECT entry_id, chain_index, residue_index, atom_name, altloc, element_key, i,
         ok AS k_ok, occupancy AS k_occ, x AS kx, y AS ky, z AS kz, FALSE AS conflict
  FROM placed WHERE i = 1
  UNION ALL
  SELECT p.entry_id, p.chain_index, p.residue_index, p.atom_name, p.altloc, p.element_key, p.i,
    CASE WHEN better THEN p.ok ELSE w.k_ok END, CASE WHEN better THEN p.occupancy ELSE w.k_occ END,
    CASE WHEN better THEN p.x ELSE w.kx END, CASE WHEN better THEN p.y ELSE w.ky END,
    CASE WHEN better THEN p.z ELSE w.kz END,
    coalesce(sqrt((p.x - w.kx) ** 2 + (p.y - w.ky) ** 2 + (p.z - w.kz) ** 2) > 0.001, FALSE)
  FROM walk w JOIN (
    SELECT * FROM placed) p
    ON p.entry_id = w.entry_id AND p.chain_index = w.chain_index
    AND p.residue_index = w.residue_index AND p.atom_name = w.atom_name AND p.altloc = w.altloc
    AND p.element_key = w.element_key AND p.i = w.i + 1,
    LATERAL (SELECT CASE WHEN p.ok <> w.k_ok THEN p.ok
                         WHEN p.ok AND p.occupancy <> w.k_occ THEN p.occupancy > w.k_occ
                         ELSE FALSE END AS better) b
)
SELECT entry_id, count(*) FILTER (i > 1) AS duplicate_atom_record_count,
  count(*) FILTER (conflict) AS duplicate_atom_coordinate_conflict_count
FROM walk GROUP BY entry_id
"""


# ---- conformers ----------------------------------------------------------------
def conformer_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as residues, return flags as conformers, discounts as occupancies."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("residue"),
        F.col("l_returnflag").alias("altloc"),
        (F.round(F.col("l_discount") * 100) / 10).alias("occupancy"),
    ).withColumn("occupancy_valid", F.col("occupancy") <= 1)
    chosen = inv.select_conformers(lines, ["residue"])
    return chosen.select(
        "residue", "selected_altloc", fixed("named_mean").alias("mean"),
        "alternative_conformers_present", "altloc_selection_fallback",
        F.array_join(F.array_sort(F.map_keys("altloc_options")), "|").alias("options"),
    )


QUERIES["conformer_choice"] = conformer_choice
ORACLES["conformer_choice"] = f"""
WITH means AS (
  SELECT l_orderkey AS residue, l_returnflag AS label,
    avg(CASE WHEN l_discount <= 0.1 THEN round(l_discount * 100) / 10e0 END)
      FILTER (round(l_discount * 100) / 10e0 <= 1) AS mean
  FROM lineitem GROUP BY ALL),
tops AS (SELECT *, max(mean) OVER (PARTITION BY residue) AS top FROM means)
SELECT residue,
  coalesce(min(label) FILTER (top - mean <= 1e-12), min(label)) AS selected_altloc,
  {fixed_sql("arg_min(mean, CASE WHEN top - mean <= 1e-12 THEN label END)")} AS mean,
  count(*) > 1 AS alternative_conformers_present,
  max(top) IS NULL AND count(*) > 1 AS altloc_selection_fallback,
  string_agg(label, '|' ORDER BY label) AS options
FROM tops GROUP BY residue
"""


def residue_selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.residue_selections(source_atoms(spark, sf_dir)).select(
        "entry_id", "chain_index", "residue_index", "selected_altloc",
        fixed("selected_conformer_mean_occupancy").alias("mean"),
        "alternative_conformers_present", "altloc_selection_fallback",
        "chemical_atom_site_count",
    )


QUERIES["residue_selections"] = residue_selections
ORACLES["residue_selections"] = f"""
WITH {SELECTION_CTE}
SELECT entry_id, chain_index, residue_index, selected_altloc, {fixed_sql("mean")} AS mean,
  alternatives AS alternative_conformers_present, fallback AS altloc_selection_fallback,
  sites AS chemical_atom_site_count FROM selections
"""


def contact_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected_atoms(spark, sf_dir).select(
        "entry_id", "chain_index", "residue_index", "atom_name", "altloc", "source_order",
        "extra_records",
    )


QUERIES["contact_atoms"] = contact_atoms
ORACLES["contact_atoms"] = f"""
WITH {SELECTION_CTE}
SELECT entry_id, chain_index, residue_index, atom_name, altloc, source_order,
  extra AS extra_records FROM atoms
"""


# ---- counts --------------------------------------------------------------------
def overfull_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.overfull_sites(source_atoms(spark, sf_dir)).select(
        "entry_id", "chain_index", "residue_index", "atom_name", "element_key", "judged",
        "overfull", F.col("excess").cast("double").alias("excess"),
    )


_OVERFULL_SQL = """
full_sites AS (
  SELECT entry_id, chain_index, residue_index, atom_name, element_key, bool_and(ok) AS judged,
    count(*) AS n, sum(CASE WHEN ok THEN CAST(occupancy AS DECIMAL(18, 6)) END) AS total,
    bool_or(is_hydrogen) AS h
  FROM source GROUP BY ALL
)"""
QUERIES["overfull_sites"] = overfull_sites
ORACLES["overfull_sites"] = f"""
WITH {ATOMS_CTE}, {_OVERFULL_SQL}
SELECT entry_id, chain_index, residue_index, atom_name, element_key, judged,
  CASE WHEN judged THEN n > 1 AND total > 1 END AS overfull,
  CASE WHEN judged AND n > 1 AND total > 1 THEN CAST(total - 1 AS DOUBLE) END AS excess
FROM full_sites
"""


def entry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = records(spark, sf_dir)
    counted = inv.entry_counts(raw, inv.dedupe_records(raw))
    return counted.withColumns(
        {
            "overfull_occupancy_excess": fixed("overfull_occupancy_excess"),
            "deposited_occupancy_weighted_atom_count": fixed(
                "deposited_occupancy_weighted_atom_count"
            ),
        }
    )


_COUNTS_SQL = f"""{ATOMS_CTE}, {_OVERFULL_SQL},
over_entries AS (
  SELECT entry_id, count(*) AS n, CAST(sum(total - 1) AS DOUBLE) AS excess,
    CAST(sum(CASE WHEN NOT h THEN total - 1 END) AS DOUBLE) AS heavy
  FROM full_sites WHERE judged AND n > 1 AND total > 1 GROUP BY entry_id
),
raw_counts AS (
  SELECT entry_id, count(*) FILTER (occupancy_status = 'missing') AS missing,
    count(*) FILTER (NOT ok AND occupancy_status <> 'missing') AS invalid,
    count(*) FILTER (NOT ok AND NOT is_hydrogen) AS unreadable
  FROM records GROUP BY entry_id
),
kept_counts AS (
  SELECT entry_id, count(*) FILTER (ok AND occupancy = 0) AS zero,
    count(*) FILTER (element_status <> 'valid') AS unknown,
    count(*) FILTER (x IS NULL OR y IS NULL OR z IS NULL) AS unplaced,
    coalesce(CAST(sum(CASE WHEN ok AND NOT is_hydrogen THEN CAST(occupancy AS DECIMAL(18, 6)) END) AS DOUBLE), 0) AS ni
  FROM source GROUP BY entry_id
),
entry_counts AS (
  SELECT r.*, k.* EXCLUDE (entry_id), coalesce(o.n, 0) AS over_n, coalesce(o.excess, 0) AS over_excess,
    unreadable > 0 OR (coalesce(heavy, 0) > 0 AND (ni <= 0 OR heavy > ni * 0.002e0)) AS failed
  FROM raw_counts r JOIN kept_counts k USING (entry_id) LEFT JOIN over_entries o USING (entry_id)
)"""
QUERIES["entry_counts"] = entry_counts
ORACLES["entry_counts"] = f"""
WITH {_COUNTS_SQL}
SELECT entry_id, missing AS missing_occupancy_count, invalid AS invalid_occupancy_count,
  zero AS zero_occupancy_atom_count, unknown AS unknown_element_atom_count,
  unplaced AS non_finite_coordinate_atom_count, over_n AS overfull_occupancy_site_count,
  {fixed_sql("over_excess")} AS overfull_occupancy_excess, failed AS occupancy_validation_failed,
  CASE WHEN NOT failed AND unknown = 0 THEN {fixed_sql("ni")} END
    AS deposited_occupancy_weighted_atom_count
FROM entry_counts
"""


def structure_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = audited_atoms(spark, sf_dir)
    joined = (
        inv.warning_counts(inv.first_model(everything))
        .join(inv.model_counts(everything), "entry_id")
        .withColumns(
            {
                "defaulted_count": F.lit(0),
                "mapping_failed": F.lit(False),
                "identifiers_packed": F.lit(False),
            }
        )
    )
    return inv.structure_warnings(joined).select(
        "entry_id", F.array_join("warning_codes", "|").alias("warning_codes")
    )


QUERIES["structure_warnings"] = structure_warnings
ORACLES["structure_warnings"] = f"""
WITH {SELECTION_CTE}, {_COUNTS_SQL.replace(ATOMS_CTE + ",", "", 1)},
repeats AS (
  SELECT entry_id, sum(n - 1) AS dup FROM (
    SELECT entry_id, count(*) AS n FROM records
    GROUP BY entry_id, chain_index, residue_index, atom_name, altloc, element_key)
  GROUP BY entry_id
),
moved AS (
  SELECT DISTINCT a.entry_id FROM records a JOIN records b
    USING (entry_id, chain_index, residue_index, atom_name, altloc, element_key)
  WHERE a.source_order < b.source_order
    AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) > 0.001
),
models AS (SELECT entry_id, count(DISTINCT model_index) AS m FROM audited GROUP BY entry_id),
extras AS (SELECT entry_id, sum(extra) AS x FROM atoms GROUP BY entry_id),
falls AS (SELECT entry_id, count(*) FILTER (fallback) AS f FROM selections GROUP BY entry_id)
SELECT c.entry_id, concat_ws('|',
  CASE WHEN m > 1 THEN 'multi_model_structure' END,
  CASE WHEN dup > 0 THEN 'duplicate_atom_records' END,
  CASE WHEN v.entry_id IS NOT NULL THEN 'duplicate_atom_coordinate_conflict' END,
  CASE WHEN x > 0 THEN 'malformed_duplicate_atom_names' END,
  CASE WHEN f > 0 THEN 'altloc_selection_fallback' END,
  CASE WHEN unknown > 0 THEN 'unknown_elements' END,
  CASE WHEN unplaced > 0 THEN 'non_finite_coordinates' END,
  CASE WHEN zero > 0 THEN 'zero_occupancy_atoms' END,
  CASE WHEN over_n > 0 THEN 'overfull_alternate_occupancy' END) AS warning_codes
FROM entry_counts c JOIN models USING (entry_id) LEFT JOIN repeats USING (entry_id)
LEFT JOIN moved v ON v.entry_id = c.entry_id LEFT JOIN extras USING (entry_id)
LEFT JOIN falls USING (entry_id)
"""


def entry_median_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the median reads its values several times
    return inv.entry_median_b(stored(selected_atoms(spark, sf_dir).select(
        "entry_id", "b_iso", "is_water", "is_hydrogen", "occupancy", "occupancy_valid")))


QUERIES["entry_median_b"] = entry_median_b
ORACLES["entry_median_b"] = f"""
WITH {SELECTION_CTE},
m AS (SELECT entry_id, median(b_iso) AS b FROM atoms
      WHERE NOT is_water AND NOT is_hydrogen AND NOT coalesce(ok AND occupancy = 0, FALSE)
      GROUP BY entry_id)
SELECT entry_id, {exact_sql("b", 3)} AS entry_nonwater_median_b_iso FROM m
"""


def metal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inv.metal_counts(selected_atoms(spark, sf_dir))


QUERIES["metal_counts"] = metal_counts
ORACLES["metal_counts"] = f"""
WITH {SELECTION_CTE}
SELECT entry_id,
  count(*) FILTER (element IN ({_METALS}) AND NOT coalesce(ok AND occupancy = 0, FALSE)) AS n_metals,
  count(*) FILTER (element IN ({_METALS}) AND ok AND occupancy = 0) AS zero_occupancy_metal_count
FROM atoms GROUP BY entry_id
"""


def early_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items per part as site counts, so the site limit and the empty case occur."""
    parts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_quantity") % 7 == 0).alias("n_metals"),
        F.count_if(F.col("l_quantity") == 50).alias("unknown_element_atom_count"),
    )
    entries = parts.select(
        F.col("l_suppkey").cast("string").alias("entry_id"),
        F.when(F.col("l_suppkey") % 3 == 0, F.lit(0)).otherwise(
            F.col("n_metals") + F.col("l_suppkey") % 40
        ).cast("long").alias("n_metals"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("unknown_element_atom_count"))
        .otherwise(F.lit(0)).cast("long").alias("unknown_element_atom_count"),
    )
    return inv.early_outcome(entries).withColumn(
        "reason_codes", F.array_join("reason_codes", "|")
    )


QUERIES["early_outcome"] = early_outcome
ORACLES["early_outcome"] = """
WITH e AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS entry_id,
    CASE WHEN l_suppkey % 3 = 0 THEN 0
         ELSE count(*) FILTER (l_quantity % 7 = 0) + l_suppkey % 40 END AS n,
    CASE WHEN l_suppkey % 2 = 0 THEN count(*) FILTER (l_quantity = 50) ELSE 0 END AS u
  FROM lineitem GROUP BY l_suppkey)
SELECT entry_id, CASE WHEN n = 0 AND u > 0 THEN 'partial' ELSE 'ok' END AS status,
  CAST(n AS BIGINT) AS n_metals,
  CASE WHEN n > 100 OR u = 0 THEN 0 END AS n_bonds, CASE WHEN n > 100 OR u = 0 THEN 0 END AS n_candidates,
  CASE WHEN n > 100 THEN 'metal_site_limit_exceeded' WHEN u > 0 THEN 'metal_presence_indeterminate'
       ELSE '' END AS reason_codes,
  CASE WHEN n = 0 AND u > 0 THEN 'cannot establish metal absence: ' || u
    || ' atom(s) have missing or invalid element symbols' ELSE '' END AS status_detail,
  n = 0 AND u = 0 AS no_metals, n > 100 AS metal_site_limit_exceeded
FROM e WHERE n > 100 OR n = 0
"""


def precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as entries: order counts as reflections, balances as volumes."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("top")
    )
    entries = table(spark, sf_dir, "customer").join(
        orders, F.col("c_custkey") == F.col("o_custkey"), "left"
    ).select(
        "c_custkey",
        (F.col("n_orders") * 1000.0).alias("reflections"),
        F.when(F.col("c_custkey") % 9 != 0, F.lit(0.21)).alias("r_free"),
        F.col("c_acctbal").alias("volume"),
        (F.col("top") / 100).alias("atoms"),
        (F.col("c_custkey") % 7 != 0).alias("has_source"),
        (F.col("c_custkey") % 17 != 0).alias("numeric"),
        (F.col("c_custkey") % 11 == 0).alias("failed"),
    )
    reason = precision_reason(
        F.col("has_source"), F.col("numeric"), F.col("failed"), F.col("reflections"),
        F.col("r_free"), F.col("volume"), F.col("atoms"),
    )
    found = entries.withColumn("reason", reason).withColumn(
        "raw",
        F.when(
            F.col("reason") == "", precision_index("atoms", "volume", "reflections", "r_free")
        ),
    )
    return with_rounded(found, {"dpi": ("raw", 4)}).select("c_custkey", "reason", "dpi")


QUERIES["precision_index"] = precision
ORACLES["precision_index"] = f"""
WITH e AS (
  SELECT c_custkey, n * 1000e0 AS refl, CASE WHEN c_custkey % 9 <> 0 THEN 0.21e0 END AS rfree,
    c_acctbal AS v, top / 100e0 AS ni
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top
                           FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey),
r AS (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN 'missing_dpi_metadata_source'
   WHEN c_custkey % 17 = 0 THEN 'invalid_dpi_metadata' WHEN c_custkey % 11 = 0 THEN 'invalid_occupancy'
   WHEN coalesce(refl, 0) <= 0 THEN 'missing_or_invalid_reflection_count'
   WHEN coalesce(rfree, 0) <= 0 THEN 'missing_or_invalid_rfree'
   WHEN coalesce(v, 0) <= 0 THEN 'missing_or_invalid_asu_volume'
   WHEN coalesce(ni, 0) <= 0 THEN 'invalid_dpi_atom_count' ELSE '' END AS reason FROM e),
d AS (SELECT *, CASE WHEN reason = '' THEN 1.28e0 * pow(ni, 0.5e0) * pow(v, 1e0 / 3)
        * pow(refl, -5e0 / 6) * rfree END AS raw FROM r)
SELECT c_custkey, reason, {exact_sql("raw", 4)} AS dpi FROM d
"""


def residue_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residue numbers written every way the decoder reads, and some it refuses."""
    key = F.col("o_orderkey")
    text = (
        F.when(key % 5 == 0, F.concat((key % 9999).cast("string"), F.lit("A")))
        .when(key % 5 == 1, F.concat((key % 9999).cast("string"), F.lit(":B")))
        .when(key % 5 == 2, F.concat(F.lit("A"), F.lpad((key % 1000).cast("string"), 3, "0")))
        .when(key % 5 == 3, F.concat(F.lit("-"), (key % 999).cast("string")))
        .otherwise(F.concat((key % 99).cast("string"), F.lit(":XY")))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("written"), residue_id(text).alias("residue_id")
    )


QUERIES["residue_ids"] = residue_ids
ORACLES["residue_ids"] = """
WITH w AS (SELECT o_orderkey, o_orderkey % 5 AS m,
  CASE o_orderkey % 5 WHEN 0 THEN (o_orderkey % 9999) || 'A' WHEN 1 THEN (o_orderkey % 9999) || ':B'
    WHEN 2 THEN 'A' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
    WHEN 3 THEN '-' || (o_orderkey % 999) ELSE (o_orderkey % 99) || ':XY' END AS written
  FROM orders)
SELECT o_orderkey, written, CASE m
  WHEN 0 THEN written
  WHEN 1 THEN replace(written, ':', '')
  WHEN 2 THEN CAST(10000 + (o_orderkey // 100 % 10) * 1296 + (o_orderkey // 10 % 10) * 36
              + o_orderkey % 10 AS VARCHAR)
  WHEN 3 THEN CAST(-(o_orderkey % 999) AS VARCHAR) END AS residue_id
FROM w
"""
