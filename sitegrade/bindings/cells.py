"""Queries of cell cleaning, lists, paths, gates and small table rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.bindings.common import Query, derived, plain, table
from sitegrade.functions import clean
from sitegrade.functions.ids import policy_digest, portable_path
from sitegrade.operators import catalog, conditions, density, distribution, inventory
from sitegrade.operators.contacts import with_neighbor_class
from sitegrade.operators.lookup import residue_classes

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _add(query: Query, sql: str) -> None:
    QUERIES[query.__name__] = query
    ORACLES[query.__name__] = sql


def boolean_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of flags by document; strict reading of those that are readable."""
    cells = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "CASE doc_id % 6 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'Yes ' WHEN 2 THEN 'no'"
        " WHEN 3 THEN '0' WHEN 4 THEN source END AS cell")
    return cells.select(
        "doc_id", clean.lenient_bool("cell").alias("lenient"), clean.tristate_bool("cell").alias("tristate"),
        F.when(F.col("doc_id") % 6 < 4, clean.strict_bool("cell", "cells")).alias("strict"))


_add(boolean_cells, """
SELECT doc_id, doc_id % 6 IN (0, 1) AS lenient,
  CASE WHEN doc_id % 6 IN (0, 1) THEN TRUE WHEN doc_id % 6 IN (2, 3) THEN FALSE END AS tristate,
  CASE WHEN doc_id % 6 IN (0, 1) THEN TRUE WHEN doc_id % 6 IN (2, 3) THEN FALSE END AS strict
FROM documents""")


def pipe_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists as pipe-separated text, back again, and their union in order."""
    docs = table(spark, sf_dir, "documents")
    items = F.array(F.col("lang"), F.when(F.col("doc_id") % 3 == 0, F.col("source")), F.lit("x"))
    more = F.array(F.col("source"), F.col("lang"), F.col("doc_id").cast("string"))
    joined = clean.pipe_join(items)
    return docs.select(
        "doc_id", joined.alias("joined"),
        F.size(clean.pipe_split(joined)).cast("long").alias("n_filled"),
        F.array_join(clean.ordered_union(more, F.array(F.lit("x"), F.col("lang"))), ",").alias("together"))


_add(pipe_lists, """
SELECT doc_id, lang || '|' || CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END || '|x' AS joined,
  CAST(CASE WHEN doc_id % 3 = 0 THEN 3 ELSE 2 END AS BIGINT) AS n_filled,
  source || ',' || lang || ',' || doc_id || ',x' AS together
FROM documents""")


def portable_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", portable_path("mirror", "url", F.col("page_id").cast("string")).alias("path"))


_add(portable_paths, "SELECT page_id, 'mirror/' || url || '/' || page_id AS path FROM pages")


def policy_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", policy_digest("policy-", F.col("props")).alias("digest"))


_add(policy_digests, """
SELECT event_id, 'policy-' || substring(sha256(props), 1, 20) AS digest FROM events""")


def merged_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histograms of both line states added up."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag AS component", "l_quantity / 8 AS value", "l_linestatus AS part")
    parts = [
        lines.where(F.col("part") == p).groupBy("component", "value").agg(F.count("*").alias("count"))
        for p in ("O", "F")]
    return distribution.merge_histograms(*parts)


_add(merged_histograms, """
SELECT l_returnflag AS component, l_quantity / 8 AS value, count(*) AS count
FROM lineitem WHERE l_linestatus IN ('O', 'F') GROUP BY ALL""")


def weighted_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    copies = F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey") % 4)
    return orders.select("o_orderkey", inventory.weighted_atom_count(F.col("o_custkey"), copies).alias("atoms"))


_add(weighted_atoms, "SELECT o_orderkey, o_custkey * (1 + o_custkey % 4) AS atoms FROM orders")


def unmapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as atoms; every seventh part has no source record."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_returnflag AS occupancy_status", "l_tax > 0 AS occupancy_valid",
        "l_partkey % 7 <> 0 AS found")
    return inventory.unmapped(lines, "found").drop("found").groupBy("occupancy_status", "occupancy_valid").agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


_add(unmapped_records, """
SELECT CASE WHEN l_partkey % 7 <> 0 THEN l_returnflag ELSE 'raw_mapping_failed' END AS occupancy_status,
  l_tax > 0 AND l_partkey % 7 <> 0 AS occupancy_valid, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys
FROM lineitem GROUP BY 1, 2""")


def site_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as residue rows with the summary of their order as site."""
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS site", "l_linenumber")
    sites = table(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0").selectExpr(
        "o_orderkey AS site", "o_totalprice AS explicit",
        "CASE WHEN o_custkey % 2 = 0 THEN o_totalprice * 2 END AS inclusive")
    return density.append_site_fields(lines, sites, ["site"], "explicit", "inclusive").groupBy("site").agg(
        F.count("*").alias("n"), F.max("geometry_coverage").alias("geometry_coverage"))


_add(site_fields, """
SELECT l_orderkey AS site, count(*) AS n,
  max(CASE WHEN o_custkey % 2 = 0 THEN o_totalprice * 2 ELSE o_totalprice END) AS geometry_coverage
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 5 <> 0 GROUP BY 1""")


def gated_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as atoms of customers: entries that finish early lose theirs."""
    entries = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS entry_id", "CAST(c_custkey % 130 AS INT) AS n_metals",
        "CAST(c_nationkey % 3 AS INT) AS unknown_element_atom_count")
    atoms = table(spark, sf_dir, "orders").selectExpr("CAST(o_custkey AS STRING) AS entry_id", "o_orderkey")
    return inventory.analyzable(atoms, inventory.early_outcome(entries)).groupBy("entry_id").agg(
        F.count("*").alias("n"))


_add(gated_atoms, f"""
SELECT CAST(o_custkey AS VARCHAR) AS entry_id, count(*) AS n FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer
  WHERE c_custkey % 130 > {vocab.MAX_METAL_SITES} OR c_custkey % 130 = 0)
GROUP BY 1""")


_NAMES = (*vocab.CANONICAL_HEMES, *vocab.CANONICAL_CLUSTERS)


def canonical_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records of reference cofactors, two never met, some of a wrong class."""
    names = ",".join(_NAMES)
    rows = table(spark, sf_dir, "part").selectExpr(
        f"split_part('{names}', ',', CAST(p_partkey % {len(_NAMES) - 2} + 1 AS INT)) AS component_id",
        "CASE WHEN p_size % 2 = 0 THEN 'heme' ELSE 'cluster' END AS structural_class")
    return catalog.canonical_conflicts(rows)


_add(canonical_conflicts, f"""
WITH e(n, component_id, expected) AS (VALUES {", ".join(
    f"({i + 1}, '{name}', '{'heme' if name in vocab.CANONICAL_HEMES else 'cluster'}')" for i, name in enumerate(_NAMES))}),
c AS (SELECT p_partkey % {len(_NAMES) - 2} + 1 AS n,
  CASE WHEN p_size % 2 = 0 THEN 'heme' ELSE 'cluster' END AS found FROM part)
SELECT component_id, expected, coalesce(found, '<absent>') AS found FROM e LEFT JOIN c USING (n)
WHERE found IS DISTINCT FROM expected""")


def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", clean.residue_name(F.concat(F.lit(" "), "p_name", F.lit("  "))).alias("name"))


_add(canonical_names, "SELECT p_partkey, upper(trim(p_name, ' ')) AS name FROM part")


def data_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a source can say of an entry, from three flags that may be unknown."""
    flags = table(spark, sf_dir, "labels").selectExpr(
        "doc_id", "CASE WHEN doc_id % 5 <> 0 THEN toxic = 1 END AS found",
        "CASE WHEN doc_id % 3 <> 0 THEN quality = 1 END AS parsed", "doc_id % 7 <> 0 AS present")
    return flags.select("doc_id", conditions.data_status("found", "parsed", "present").alias("status"))


_add(data_statuses, """
SELECT doc_id, CASE WHEN doc_id % 5 <> 0 AND toxic = 1 THEN 'available' WHEN doc_id % 7 = 0 THEN 'input_unavailable'
  WHEN doc_id % 3 <> 0 AND quality <> 1 THEN 'unparseable' ELSE 'not_reported' END AS status
FROM labels""")


# ---- residue classes -----------------------------------------------------------
#: Lines as neighbours: parts are components, every eleventh a residue of a common name.
NEIGHBORS = """
SELECT l_orderkey, l_linenumber, l_linestatus = 'F' AND l_tax = 0 AS n_is_water,
  CASE WHEN l_partkey % 11 = 0
       THEN split_part('A,DG,MSE,SEP,HIS,U,DT,SEC,ZZZ', ',', CAST(l_suppkey % 9 + 1 AS INT))
       ELSE concat('P', CAST(l_partkey AS STRING)) END AS n_residue_name
FROM {lineitem}
"""
#: The class table: some parts are in it, some in both classes, and it overrules a bundled name.
CLASSES = """
SELECT concat('P', CAST(p_partkey AS STRING)) AS residue_name, 'nucleotide' AS residue_class
FROM {part} WHERE p_partkey % 7 = 0
UNION ALL SELECT concat('P', CAST(p_partkey AS STRING)), 'amino_acid' FROM {part} WHERE p_partkey % 5 = 0
UNION ALL SELECT 'SEC', 'nucleotide' FROM {region} WHERE r_regionkey = 0
"""


def neighbor_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every neighbour's residue by the component table and the bundled names."""
    rows = derived(spark, sf_dir, NEIGHBORS)
    classes = residue_classes(spark, derived(spark, sf_dir, CLASSES))
    return with_neighbor_class(rows, classes).groupBy("n_residue_name", "neighbor_class").agg(
        F.count(F.lit(1)).alias("n"))


QUERIES["neighbor_classes"] = neighbor_classes
ORACLES["neighbor_classes"] = f"""
WITH r AS ({plain(NEIGHBORS)}), c AS (SELECT residue_name, max(residue_class) AS kind FROM ({plain(CLASSES)}) GROUP BY 1)
SELECT n_residue_name, CASE WHEN n_is_water THEN 'water' WHEN kind IS NOT NULL THEN kind
    WHEN n_residue_name IN ('A', 'DG', 'U', 'DT') THEN 'nucleotide' WHEN n_residue_name IN ('MSE', 'SEP', 'HIS') THEN 'amino_acid'
    ELSE 'other' END AS neighbor_class, count(*) AS n
FROM r LEFT JOIN c ON residue_name = n_residue_name GROUP BY ALL
"""
