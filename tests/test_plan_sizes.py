"""How much the shared steps move: exchanges of plans and copies of rows."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from sitegrade.bindings import links
from sitegrade.bindings.inventory import selected_atoms, source_atoms
from sitegrade.operators import contacts as con
from sitegrade.operators import declared as dec
from sitegrade.operators import inventory as inv
from sitegrade.operators import radius

SF = "/root/testdata/sf0.001"


def _exchanges(df) -> int:
    """Shuffles of rows in the plan before execution."""
    plan = df._jdf.queryExecution().sparkPlan()
    planned = df.sparkSession._jvm.org.apache.spark.sql.execution.QueryExecution.prepareExecutedPlan(
        df.sparkSession._jsparkSession, plan).toString()
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", planned))


def test_atoms_are_dealt_once_by_residue(spark):
    assert _exchanges(selected_atoms(spark, SF)) == 1


def test_selection_in_one_pass_equals_the_table_of_selections(spark):
    rows = [  # residue, atom, altloc, occupancy, order
        (0, "CA", "A", 0.4, 1), (0, "CA", "B", 0.6, 2), (0, "CB", "", 1.0, 3), (0, "CB", "B", 0.3, 4),
        (1, "N", "B", None, 5), (1, "N", "A", None, 6), (2, "O", "", None, 7), (2, "O", "", 0.5, 8),
        (3, "S", "A", 0.5, 9), (3, "S", "B", 0.5, 10)]
    atoms = spark.createDataFrame(
        rows, "residue_index int, atom_name string, altloc string, occupancy double, source_order long"
    ).selectExpr(
        "'e' AS entry_id", "0 AS model_index", "0 AS chain_index", "*", "'C' AS element_key",
        "occupancy IS NOT NULL AS occupancy_valid", "FALSE AS is_water")
    one = inv.contact_atoms(atoms)
    two = inv.contact_atoms(atoms, inv.residue_selections(atoms))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert sorted(r[0] for r in one.select("source_order").collect()) == [2, 4, 6, 8, 9]


def test_a_point_visits_eight_cells(spark):
    points = spark.range(200).select("id", *[
        (F.rand(i) * 40 - 20).alias(a) for i, a in enumerate("xyz")])
    visits = radius._visited(points, ["x", "y", "z"], 2 * 4.0).groupBy("id").count()
    assert visits.agg(F.max("count")).first()[0] <= 8


def test_partners_are_resolved_without_storing_the_connections(spark, monkeypatch):
    stored = []

    def cut(df):
        stored.append(df.columns)
        return df.localCheckpoint()

    monkeypatch.setattr(dec, "cut_lineage", cut)
    monkeypatch.setattr(links, "cut_lineage", cut)
    links.declared_outcomes(spark, SF).count()
    assert stored and not any("p1_atom" in columns or "p1" in columns for columns in stored)


def test_addresses_settled_inside_residues_equal_the_joined_ones(spark):
    source = source_atoms(spark, SF).localCheckpoint()
    chosen = inv.residue_selections(source)
    inside = dec._addresses(source, None, None, None)
    joined = dec._addresses(source, inv.contact_atoms(source, chosen), chosen, None)
    assert _exchanges(inside) < _exchanges(joined)
    a, b = (sorted(map(str, df.collect())) for df in (inside, joined))
    assert a and a == b


def _executed(df) -> str:
    """The physical plan before execution, with its exchanges and sorts."""
    plan = df._jdf.queryExecution().sparkPlan()
    return df.sparkSession._jvm.org.apache.spark.sql.execution.QueryExecution.prepareExecutedPlan(
        df.sparkSession._jsparkSession, plan).toString()


def test_duplicates_and_conformers_share_one_sort(spark):
    assert len(re.findall(r"- \*?(?:\(\d+\) )?Sort \[", _executed(selected_atoms(spark, SF)))) <= 2


def test_residue_groups_are_added_without_a_second_copy_of_the_contacts(spark):
    rows = [(1, 1, True, False), (1, 1, False, True), (1, 2, None, None), (2, 1, False, True), (2, 1, False, True)]
    contacts = spark.createDataFrame(
        rows, "site int, residue int, geometry_outlier boolean, geometry_consistent boolean")
    keys = ("site", "residue")
    added = con.with_groups(contacts, keys)
    assert "Join" not in _executed(added)
    joined = contacts.join(con.residue_groups(contacts, keys), list(keys)).select(added.columns)
    assert sorted(map(str, added.collect())) == sorted(map(str, joined.collect()))


def test_a_search_stores_only_the_atoms_and_columns_it_reads(spark):
    atoms = selected_atoms(spark, SF)
    kept = con.searched(atoms)
    assert 0 < kept.count() < atoms.count() and "occupancy_raw" not in kept.columns
    for side in (con.metals_of, con.donors_of):
        assert side(kept).exceptAll(side(atoms)).isEmpty() and side(kept).count() == side(atoms).count()
