"""What queries move and read again: plans before execution."""

from __future__ import annotations

from test_plan_sizes import SF, _executed

from sitegrade.bindings import evidence, inventory, links
from sitegrade.sources import files as src


def test_statistics_lines_are_read_before_they_meet_their_header(spark):
    rows, rejects = src.statistics_rows(links.statistics_lines(spark, SF))
    for df in (rows.select("entry_id", "ZDa"), rejects.select("entry_id", "problem")):
        above, joined, _ = _executed(df).partition("Join")
        assert joined and "fields#" not in above


def test_lines_before_the_header_and_under_a_wrong_one(spark):
    lines = spark.createDataFrame(
        [("a", 1, "  "), ("a", 2, " ".join(src.STATISTICS_COLUMNS)), ("a", 3, "ZN A 1"),
         ("b", 1, "RT CI"), ("b", 2, "ZN A 1"), ("c", 1, "\t" + " ".join(src.STATISTICS_COLUMNS)), ("c", 2, "ZN")],
        "entry_id string, position long, line string")
    rows, rejects = src.statistics_rows(lines)
    assert rows.isEmpty()
    assert sorted((r[0], r[1], r[3]) for r in rejects.collect()) == [
        ("a", 3, "wrong_field_count"), ("b", 2, "invalid_header"), ("c", 2, "invalid_header")]


def test_a_median_does_not_select_the_atoms_again(spark):
    assert "lineitem.parquet" not in _executed(inventory.entry_median_b(spark, SF))


def test_a_summary_does_not_mine_the_texts_again(spark):
    assert "documents.parquet" not in _executed(evidence.condition_summary(spark, SF))
