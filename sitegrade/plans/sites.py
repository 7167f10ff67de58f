"""Columns of the site table that speak of the entry and the metal itself, not of contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import finite
from sitegrade.functions.geometry import fractionalize, precision_index, precision_reason, site_symmetry
from sitegrade.functions.rounding import with_rounded
from sitegrade.operators import contacts as con
from sitegrade.operators.density import component_class
from sitegrade.operators.inventory import entry_median_b, overfull_sites
from sitegrade.operators.radius import coincident_images

#: Terms of the precision index that every site row repeats.
TERMS = ("resolution", "r_free", "reflection_count", "asu_volume", "occupancy_weighted_atom_count",
         "deposited_occupancy_weighted_atom_count")
SYMMETRY = ("metal_special_position", "metal_site_symmetry_order",
            "metal_expected_crystallographic_occupancy", "metal_occupancy_matches_site_symmetry")


def entry_precision(entries: DataFrame) -> DataFrame:
    """Per entry the precision index, its terms, and why it is missing.

    ``entries`` holds ``entry_id``, the ``TERMS``, ``has_source``,
    ``metadata_numeric`` and ``occupancy_validation_failed``.
    """
    terms = [F.col(c) for c in ("reflection_count", "r_free", "asu_volume", "occupancy_weighted_atom_count")]
    judged = entries.withColumn("dpi_reason", precision_reason(
        F.col("has_source"), F.col("metadata_numeric"), F.col("occupancy_validation_failed"), *terms))
    raw = F.when(F.col("dpi_reason") == "", precision_index(
        "occupancy_weighted_atom_count", "asu_volume", "reflection_count", "r_free"))
    atoms = {c: (finite(c), 6) for c in TERMS[-2:]}
    return with_rounded(judged.withColumn("__raw", raw), {"dpi": ("__raw", 4), **atoms}).select(
        "entry_id", "dpi", "dpi_reason", *TERMS)


def metal_symmetry(
    metals: DataFrame, cells: DataFrame, operations: DataFrame,
    cutoff: float = vocab.SPECIAL_POSITION_CUTOFF,
) -> DataFrame:
    """Special position, site-symmetry order and expected occupancy of metals with ``m_`` columns."""
    matrix = cells.select("entry_id", "m11", "m12", "m13", "m22", "m23", "m33")
    axes = dict(zip(("lu", "lv", "lw"), fractionalize(*(F.col(f"m_{a}") for a in "xyz")), strict=True))
    points = metals.join(matrix, "entry_id").withColumns(axes).select(
        *con.SITE, "m_occupancy", "m_occupancy_valid", "lu", "lv", "lw")
    found = coincident_images(points, matrix, operations, cutoff)
    judged = site_symmetry("coincident", "operation_count", "m_occupancy", "m_occupancy_valid")
    return found.select(*con.SITE, *[judged[c].alias(c) for c in SYMMETRY])


def annotated_sites(
    sites: DataFrame, records: DataFrame, atoms: DataFrame, precision: DataFrame | None = None,
    cells: DataFrame | None = None, operations: DataFrame | None = None,
    structural: DataFrame | None = None, cutoff: float = vocab.SPECIAL_POSITION_CUTOFF,
) -> DataFrame:
    """The site table with the columns of the entry and of the metal.

    ``sites`` carries the key of a metal (``entry_id`` and its ``m_`` indices);
    ``records`` are first-model records, ``atoms`` the selected ones. Adds the
    terms of the precision index (from :func:`entry_precision`), the entry's
    median B, whether the metal's own alternates sum above one, its special
    position where symmetry is known, and the class of the component it belongs
    to (``structural``: residue_name, structural_class). What has no source is
    null. Every part is joined on the entry or the metal; none is gathered.
    """
    keys = list(con.SITE)
    metals = con._prefixed(atoms.where(con.is_metal()), "m_")
    chemical = {"chain_index": "m_chain_index", "residue_index": "m_residue_index", "atom_name": "m_atom_name",
                "element_key": "m_element"}
    full = overfull_sites(records).where(F.col("element_key").isin(*vocab.METALS)).withColumnsRenamed(
        chemical).select("entry_id", *chemical.values(), F.col("overfull").alias("metal_overfull_occupancy"))
    own = metals.join(full, ["entry_id", *chemical.values()], "left")
    # how many chemical sites the metal's residue has tells an ion from a larger component
    parts = atoms.groupBy("entry_id", F.col("chain_index").alias("m_chain_index"),
                          F.col("residue_index").alias("m_residue_index")).agg(F.count(F.lit(1)).alias("__parts"))
    own = own.join(parts, ["entry_id", "m_chain_index", "m_residue_index"], "left")
    if structural is None:
        own = own.withColumn("structural_class", F.lit(""))
    else:
        own = own.join(structural.select(
            F.col("residue_name").alias("m_residue_name"), "structural_class"), "m_residue_name", "left")
    kind = F.coalesce("structural_class", F.lit(""))
    own = own.withColumn("metal_component_class", component_class(
        kind == "cluster", kind == "heme", F.col("__parts")))
    if cells is not None and operations is not None:
        placed = metals.where("m_x IS NOT NULL AND m_y IS NOT NULL AND m_z IS NOT NULL")
        own = own.join(metal_symmetry(placed, cells, operations, cutoff), keys, "left")
    else:
        kinds = ("boolean", "bigint", "double", "boolean")
        own = own.withColumns({c: F.lit(None).cast(k) for c, k in zip(SYMMETRY, kinds, strict=True)})
    out = sites.join(
        own.select(*keys, "metal_overfull_occupancy", "metal_component_class", *SYMMETRY), keys, "left"
    ).join(entry_median_b(atoms), "entry_id", "left")
    if precision is None:
        return out
    return out.drop("dpi", "dpi_reason", *TERMS).join(precision, "entry_id", "left")
