"""Which bonds the component catalog matches with atoms."""

from __future__ import annotations

from sitegrade.operators import catalog as cat


def test_bonds_of_components_without_wanted_atoms_leave_first(spark, monkeypatch):
    atoms = spark.createDataFrame(
        [("a", "S1", "S"), ("a", "F1", "FE"), ("a", "F2", "FE"), ("b", "C1", "C"), ("b", "O1", "O"),
         ("c", "S1", "S"), ("c", "S1", "S"), ("c", "F1", "FE")],
        "component_id string, atom_id string, element string")
    bonds = spark.createDataFrame(
        [("a", "S1", "F1"), ("a", "F2", "S1"), ("b", "C1", "O1"), ("c", "S1", "F1")],
        "component_id string, atom_id_1 string, atom_id_2 string")
    seen, both = [], cat.both_ways

    def counted(rows):
        seen.append({r.component_id for r in rows.collect()})
        return both(rows)

    monkeypatch.setattr(cat, "both_ways", counted)
    # a repeated atom row counts twice, as it always did
    assert {r[0] for r in cat.cluster_components(atoms, bonds).collect()} == {"a", "c"}
    assert cat.heme_components(atoms, bonds).collect() == []
    assert seen == [{"a", "c"}, set(), set()]
