"""Declared connections are settled where their entry was dealt, and not stored on the way."""

from __future__ import annotations

from pyspark.sql import functions as F
from test_plan_sizes import _exchanges

from sitegrade.bindings import links
from sitegrade.operators import contacts as con
from sitegrade.operators import declared as dec
from sitegrade.session import stored_where_dealt

SF = "/root/testdata/sf0.001"


def _stored(monkeypatch):
    kept = []

    def cut(df):
        held = df.localCheckpoint()
        kept.append((df.columns, held.count()))
        return held

    monkeypatch.setattr(dec, "cut_lineage", cut)
    monkeypatch.setattr(links, "cut_lineage", cut)
    return kept


def test_placing_stores_neither_connections_nor_atoms(spark, monkeypatch):
    kept = _stored(monkeypatch)
    links.declared_images(spark, SF).count()
    assert sum(n for _, n in kept) == 0 and not any("m_x" in c or "x" in c for c, _ in kept)


def test_merging_declared_candidates_stores_only_what_the_merge_reads(spark, monkeypatch):
    kept = _stored(monkeypatch)
    links.merged_candidates(spark, SF).count()
    assert not any("m_x" in columns for columns, _ in kept)


def test_partners_meet_their_addresses_without_a_second_dealing(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        # metals and neighbours as stated, connections and records by entry
        assert _exchanges(links.outcomes(spark, SF)) <= 5
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_the_setting_is_put_back(spark):
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    left, right = (spark.range(50).selectExpr("id % 7 AS k", f"id AS {c}").repartition("k") for c in "ab")
    joined = stored_where_dealt(left.join(right.withColumnRenamed("b", "a"), ["k", "a"]))
    assert joined.count() == 50 and spark.conf.get(name) == before


def test_candidates_are_dealt_once_for_their_merge(spark):
    ints = [*con.SITE[1:], *con.DONOR, "image_index", "tx", "ty", "tz"]
    rows = spark.range(3).selectExpr(
        "'e' AS entry_id", *[f"0 AS {c}" for c in ints], "0D AS px", "0D AS py", "0D AS pz", "2D AS distance",
        "array('proximity_4A') AS sources", "TRUE AS donor_class_supported",
    ).withColumn("declared", F.lit(None).cast(con.DECLARED_TYPE))
    merged = con.merge_candidates(rows.limit(1), rows.withColumn("sources", F.array(F.lit("LINK"))))
    assert _exchanges(merged) == 1
    assert [r.sources for r in merged.collect()] == [["LINK", "proximity_4A"]]


def test_ids_given_in_the_form_of_new_ones_are_renamed_too(spark):
    rows = [("e", 1, "a"), ("e", 2, "a"), ("e", 3, "a_2"), ("e", 4, "a_2"), ("e", 5, ""), ("e", 6, "LINK_5"),
            ("e", 7, "a_2_3"), ("f", 1, "a")]
    df = spark.createDataFrame(rows, "entry_id string, position long, connection_id string").withColumn(
        "source", F.lit("LINK"))
    got = {(r.entry_id, r.position): r.connection_id for r in dec.unique_connection_ids(df).collect()}
    assert got == {("e", 1): "a", ("e", 2): "a_2", ("e", 3): "a_2_3", ("e", 4): "a_2_4", ("e", 5): "LINK_5",
                   ("e", 6): "LINK_5_6", ("e", 7): "a_2_3_7", ("f", 1): "a"}
