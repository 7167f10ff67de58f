"""The numbers behind the warnings: one pass over the records."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitegrade.bindings.inventory import structure_warnings
from sitegrade.operators import inventory as inv
from test_plan_sizes import SF, _exchanges


def test_warnings_deal_the_records_once(spark):
    # records by residue, sums by entry, and models by entry in two steps
    assert _exchanges(structure_warnings(spark, SF)) <= 4


def test_numbers_equal_those_of_the_single_audits(spark):
    rows = [  # residue, atom, altloc, occupancy, order, x
        (0, "CA", "A", None, 1, 0.0), (0, "CA", "B", None, 2, 0.0), (0, "CB", "", 1.0, 3, None),
        (1, "N", "A", 0.7, 4, 0.0), (1, "N", "A", 0.7, 5, 0.5), (1, "N", "A", 0.9, 6, 0.5),
        (1, "N", "A", 0.2, 7, 0.5), (1, "N", "B", 0.5, 8, 0.0), (1, "N", "", 0.0, 9, 0.0),
        (2, "O", "", 0.0, 10, None), (2, "O", "", None, 11, None), (3, "S", "A", None, 12, 1.0)]
    records = spark.createDataFrame(
        rows, "residue_index int, atom_name string, altloc string, occupancy double, source_order long, x double"
    ).selectExpr(
        "IF(residue_index < 2, 'e', 'f') AS entry_id", "0 AS model_index", "0 AS chain_index", "*",
        "IF(atom_name = 'CB', '', 'C') AS element_key", "IF(atom_name = 'CB', 'missing', 'valid') AS element_status",
        "IF(occupancy IS NULL, 'missing', 'valid') AS occupancy_status", "x AS y", "x AS z",
        "occupancy IS NOT NULL AS occupancy_valid", "FALSE AS is_water", "FALSE AS is_hydrogen")
    source = inv.dedupe_records(records)
    selections = inv.residue_selections(source)
    expected = (
        inv.entry_counts(records, source).join(inv.duplicate_audit(records), "entry_id")
        .join(inv.contact_atoms(source, selections).groupBy("entry_id").agg(
            F.sum("extra_records").alias("malformed_duplicate_atom_name_count")), "entry_id")
        .join(selections.groupBy("entry_id").agg(
            F.count_if("altloc_selection_fallback").alias("fallback_count")), "entry_id"))
    found = inv.warning_counts(records)
    assert sorted(found.collect()) == sorted(expected.select(*found.columns).collect())
    assert {r.entry_id: r.fallback_count for r in found.collect()} == {"e": 1, "f": 0}
