"""The contact analysis on a literal site with known distances."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sitegrade.functions.geometry import orthogonal_matrix
from sitegrade.operators import declared as dec
from sitegrade.operators import inventory as inv
from sitegrade.operators.contacts import as_explicit, with_neighbor_class
from sitegrade.operators.lookup import literature, residue_classes
from sitegrade.plans.contacts import analyze_contacts
from sitegrade.session import cut_lineage

ATOMS = [
    # chain, residue, atom, residue name, atom name, element, occupancy, x, y, z
    (0, 0, 0, "ZN", "ZN", "ZN", "1.00", 0.0, 0.0, 0.0),
    (0, 1, 0, "HIS", "NE2", "N", "1.00", 2.03, 0.0, 0.0),
    (0, 2, 0, "ASP", "OD1", "O", "1.00", 0.0, 1.99, 0.0),
    (0, 2, 1, "ASP", "OD2", "O", "1.00", 0.0, 2.60, 0.9),
    (0, 3, 0, "HOH", "O", "O", "1.00", 0.0, 0.0, 2.09),
    (0, 4, 0, "TRP", "NE1", "N", "1.00", -2.2, 0.0, 0.0),
    (0, 5, 0, "GLU", "OE1", "O", "1.00", 0.0, -3.9, 0.0),
    (0, 6, 0, "GLU", "OE2", "O", "0.00", 0.0, -2.0, 0.0),
    (0, 7, 0, "FE", "FE", "FE", "1.00", 5.0, 0.0, 0.0),
    (0, 8, 0, "CD", "CD", "CD", "1.00", None, 0.0, 0.0),
]


@pytest.fixture(scope="module")
def atoms(spark):
    raw = spark.createDataFrame(
        [(*r[:6], r[6], *r[7:]) for r in ATOMS],
        "chain_index int, residue_index int, atom_index int, residue_name string, atom_name string,"
        " element string, occupancy_raw string, x double, y double, z double",
    ).withColumns(
        {
            "entry_id": F.lit("1abc"), "model_index": F.lit(0), "source_order": F.col("residue_index") * 10 + F.col("atom_index"),
            "chain_id": F.lit("A"), "resnum": (F.col("residue_index") + 1).cast("string"), "insertion_code": F.lit(""),
            "altloc": F.lit(""), "b_iso": F.lit(20.0) + F.col("residue_index"), "is_water": F.col("residue_name") == "HOH",
            "polymer_position": F.lit("M"),
        }
    )
    return inv.with_element(inv.with_occupancy(raw))


@pytest.fixture(scope="module")
def entries(spark):
    return spark.createDataFrame([("1abc", 0.1, "", True)], "entry_id string, dpi double, dpi_reason string, searched boolean")


def test_explicit_contacts(spark, atoms, entries):
    result = analyze_contacts(atoms, entries, literature(spark))
    bonds = {(r.metal_element, r.neighbor_atom): r for r in result.bonds.collect()}
    assert {b for m, b in bonds if m == "ZN"} == {"NE2", "OD1", "O"}
    assert bonds["ZN", "NE2"].zscore == 0.0 and bonds["ZN", "OD1"].distance == 1.99
    candidates = {(r.metal_element, r.neighbor_atom): r for r in result.candidates.collect()}
    assert candidates["ZN", "NE1"].eligibility_status == "non_typical_donor"
    assert candidates["ZN", "OE1"].eligibility_status == "outside_first_sphere"
    assert ("ZN", "OE2") not in candidates
    made = {r.contact_id for r in candidates.values() if r.assigned_as_bond}
    assert made == {r.contact_id for r in bonds.values()}
    sites = {r.m_element: r for r in result.sites.collect()}
    assert len(sites) == 3
    zn = sites["ZN"]
    assert zn.candidate_contact_count == 3 and zn.geometry_status == "plausible"
    assert zn.nearest_metal_site_id == "1abc:m0:c0:r7:a0" and zn.nearby_metal_count_6a == 1
    assert zn.context_warning_reasons == ["non_typical_first_sphere_candidate"]
    assert zn.generated_contact_scope is None
    assert zn.geometry_not_assessed_reason == "symmetry_search_unavailable"
    assert zn.donor_b_iso_count == 3 and zn.donor_median_b_iso == 22.0
    assert sites["CD"].geometry_not_assessed_reason == "non_finite_metal_coordinates"
    assert sites["FE"].candidate_contact_count == 0 and sites["FE"].geometry_status == "insufficient data"


def test_images_and_declarations(spark, atoms, entries):
    cell = spark.createDataFrame([("1abc", 30.0, 31.0, 32.0, 90.0, 90.0, 90.0)], "entry_id string, a double, b double, c double, alpha double, beta double, gamma double")
    cells = cell.withColumns(orthogonal_matrix(*[F.col(c) for c in ("a", "b", "c", "alpha", "beta", "gamma")]))
    ops = spark.createDataFrame(
        [("1abc", i, False, *map(float, r), *map(float, t)) for i, r, t in (
            (0, (1, 0, 0, 0, 1, 0, 0, 0, 1), (0, 0, 0)), (1, (-1, 0, 0, 0, -1, 0, 0, 0, 1), (0, 0, 0)))],
        "entry_id string, image_index int, is_ncs boolean, r11 double, r12 double, r13 double, r21 double, r22 double, r23 double, r31 double, r32 double, r33 double, t1 double, t2 double, t3 double",
    )
    links = spark.createDataFrame(
        [("1abc", 1, "LINK", "l1", "metalc", "same", "", 2.2, "A", "ZN", "1", "ZN", "", "A", "TRP", "5", "NE1", ""),
         ("1abc", 2, "LINK", "l2", "metalc", "same", "", 2.2, "A", "ZN", "1", "ZN", "", "A", "TRP", "99", "NE1", ""),
         ("1abc", 3, "LINK", "l3", "covale", "same", "", 1.3, "A", "HIS", "2", "NE2", "", "A", "ASP", "3", "OD1", "")],
        "entry_id string, position int, source string, connection_id string, connection_type string, asu string, link_id string, reported_distance double,"
        " p1_chain string, p1_resname string, p1_resnum string, p1_atom string, p1_altloc string, p2_chain string, p2_resname string, p2_resnum string, p2_atom string, p2_altloc string",
    )
    selections = inv.residue_selections(atoms)
    resolved = dec.resolve_partner(dec.resolve_partner(links, "p1", atoms, atoms, selections), "p2", atoms, atoms, selections)
    outcomes = dec.declared_outcomes(resolved)
    outcomes = cut_lineage(outcomes)
    assert {r.position: (r.outcome, r.issue) for r in outcomes.collect()} == {
        1: ("candidate", None), 2: ("unresolved", "LINK l2 partner unresolved"), 3: ("ignored", None)}
    declared = as_explicit(dec.declared_pairs(outcomes).drop("asu").withColumn("distance", F.lit(2.2)))
    with pytest.raises(ValueError, match="class table"):
        analyze_contacts(atoms, entries, literature(spark), cells, ops, declared)
    classes = spark.createDataFrame([], "residue_name string, residue_class string")
    result = analyze_contacts(atoms, entries, literature(spark), cells, ops, declared, classes)
    zn = result.sites.where("m_element = 'ZN'").first()
    # The two-fold axis runs through the metal: every off-axis donor appears twice.
    assert zn.explicit_candidate_contact_count == 4 and zn.candidate_contact_count == 6
    assert zn.generated_contact_scope == "crystallographic"
    assert zn.coordination_depends_on_crystallographic_symmetry is True
    bonds = result.bonds.where("metal_element = 'ZN'").collect()
    assert {b.symmetry_operation for b in bonds} == {"1_555", "2_555"}
    override = [b for b in bonds if b.neighbor_atom == "NE1"]
    assert [b.donor_rule_override for b in override] == ["declared_connection"]
    assert override[0].connection_id == "l1" and override[0].zscore is None


def test_residue_classes_come_from_the_component_table(spark):
    rows = spark.createDataFrame(
        [("PSU", False), ("5MC", False), ("HYP", False), ("HIS", False), ("DA", False), ("XYZ", False), ("DOD", True), (None, False)],
        "n_residue_name string, n_is_water boolean")
    table = spark.createDataFrame(
        [("PSU", "nucleotide"), ("5MC", "nucleotide"), ("5MC", "nucleotide"), ("HYP", "amino_acid")],
        "residue_name string, residue_class string")
    got = with_neighbor_class(rows, residue_classes(spark, table)).collect()
    assert sorted((r.n_residue_name or "", r.neighbor_class) for r in got) == [
        ("", "other"), ("5MC", "nucleotide"), ("DA", "nucleotide"), ("DOD", "water"), ("HIS", "amino_acid"),
        ("HYP", "amino_acid"), ("PSU", "nucleotide"), ("XYZ", "other")]


def test_component_table_reaches_both_tables(spark, atoms, entries):
    told = spark.createDataFrame([("TRP", "nucleotide")], "residue_name string, residue_class string")
    result = analyze_contacts(atoms, entries, literature(spark), components=told)
    assert {r.neighbor_class for r in result.candidates.where("neighbor_resname = 'TRP'").collect()} == {"nucleotide"}
    assert {r.neighbor_class for r in result.bonds.where("neighbor_resname = 'HIS'").collect()} == {"amino_acid"}


def test_entries_without_an_image_search_keep_the_explicit_scope(spark, atoms, entries):
    """A cell without a search, and a search without a cell: explicit scope, no repeats."""
    cell = spark.createDataFrame(
        [("1abc", 30.0, 31.0, 32.0, 90.0, 90.0, 90.0)],
        "entry_id string, a double, b double, c double, alpha double, beta double, gamma double")
    cells = cell.withColumns(
        orthogonal_matrix(*[F.col(c) for c in ("a", "b", "c", "alpha", "beta", "gamma")]))
    ops = spark.createDataFrame(
        [("1abc", i, False, *map(float, r), 0.0, 0.0, 0.0) for i, r in (
            (0, (1, 0, 0, 0, 1, 0, 0, 0, 1)), (1, (-1, 0, 0, 0, -1, 0, 0, 0, 1)))],
        "entry_id string, image_index int, is_ncs boolean, r11 double, r12 double, r13 double,"
        " r21 double, r22 double, r23 double, r31 double, r32 double, r33 double,"
        " t1 double, t2 double, t3 double")
    plain = analyze_contacts(atoms, entries, literature(spark)).sites.where("m_element = 'ZN'").first()
    for asked, have in ((False, cells), (True, cells.where("entry_id = '9zzz'"))):
        told = entries.withColumn("searched", F.lit(asked))
        result = analyze_contacts(atoms, told, literature(spark), have, ops)
        zn = result.sites.where("m_element = 'ZN'").first()
        assert zn.candidate_contact_count == plain.candidate_contact_count == 3
        assert zn.geometry_status == plain.geometry_status
        assert zn.context_warning == plain.context_warning
        assert zn.donor_b_iso_count == plain.donor_b_iso_count == 3
        assert zn.geometry_not_assessed_reason == "symmetry_search_unavailable"
        assert zn.symmetry_contact_count is None and zn.image_inclusive_geometry_status is None
        assert zn.nearest_metal_element == "FE"
        ids = [r.contact_id for r in result.candidates.collect()]
        assert len(ids) == len(set(ids)) == 7
