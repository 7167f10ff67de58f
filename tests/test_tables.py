"""Files, frozen references, jobs, resume rules, catalog and streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sitegrade.operators import catalog as cat
from sitegrade.operators import declared as dec
from sitegrade.operators import inventory as inv
from sitegrade.operators import runs
from sitegrade.plans import jobs
from sitegrade.sources import files as src
from sitegrade.sources import tables
from sitegrade.streaming import jobs as stream

INPUTS = "entry_id string, metal_site_id string, rszd_abs double, geometry_rms_zbond double, context_warning boolean, context_warning_reasons string, score_inputs_status string"


def _inputs(spark, n=40):
    rows = [
        (f"e{i % 5}", f"s{i}", None if i % 11 == 0 else (i % 8) / 1.3, None if i % 7 == 0 else (i % 5) / 2.2, False, "", "complete")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, INPUTS)


def test_reference_round_trip_and_tampering(spark, tmp_path):
    inputs, output, folder = (str(tmp_path / name) for name in ("inputs", "scores", "reference"))
    _inputs(spark).write.parquet(inputs)
    metadata = jobs.finalize(spark, inputs, output, folder)
    scores = spark.read.parquet(output)
    assert scores.count() == 40 and metadata["input_row_count"] == 40
    assert scores.where(F.col("site_score") != F.least("density_score", "geometry_score")).count() == 0
    tables.validate_scored(scores, metadata)
    with pytest.raises(tables.TableError, match="already contain"):
        tables.validate_score_inputs(scores)
    with pytest.raises(tables.TableError, match="another|different"):
        tables.validate_scored(scores, {**metadata, "cohort_id": "cohort-x"})
    again = str(tmp_path / "again")
    jobs.score(spark, inputs, again, folder)
    assert spark.read.parquet(again).exceptAll(scores).count() == 0
    frozen = spark.read.parquet(f"{folder}/distribution").withColumn("count", F.col("count") + 1)
    frozen.cache().count()
    changed = frozen.collect()
    spark.createDataFrame(changed, frozen.schema).write.mode("overwrite").parquet(f"{folder}/distribution")
    with pytest.raises(tables.TableError, match="does not match data"):
        tables.load_reference(spark, folder)
    with pytest.raises(tables.TableError, match="no completed"):
        tables.load_reference(spark, str(tmp_path / "nowhere"))
    assert jobs.choose_mode(spark, bonds=True, whole_database=False, folders=(folder,)) == ("reference", folder)
    assert jobs.choose_mode(spark, bonds=True, whole_database=False)[0] == "classification"
    assert jobs.choose_mode(spark, bonds=False, whole_database=True)[0] == "off"


MANIFEST = ("entry_id string, status string, retryable boolean, no_metals boolean, metal_site_limit_exceeded boolean,"
            " n_metals int, analysis_config_id string, engine string, reason_codes array<string>")


def test_finalize_records_its_manifest_and_refuses_mixtures(spark, tmp_path):
    def rows(configs, engine="1.0"):
        return spark.createDataFrame(
            [(f"e{i}", "partial" if i == 0 else "ok", False, i == 1, False, i, c, engine if i else "1.0", [])
             for i, c in enumerate(configs)], MANIFEST)

    table = _inputs(spark)
    found = tables.manifest_metadata(rows("aaaaa"), ["engine"], "a")
    assert found["source_entry_count"] == 5 and found["metal_bearing_entry_count"] == 4
    assert found["status_counts"] == {"ok": 4, "partial": 1} and found["software"] == {"engine": "1.0"}
    metadata = tables.write_reference(table, str(tmp_path / "one"), found).first()
    assert metadata["status_counts"] == {"ok": 4, "partial": 1}
    assert metadata["input_status_counts"] == {"complete": 40} and metadata["no_metals_entry_count"] == 1
    for configs, config_id, engine in (("aabaa", None, "1.0"), ("aaa", "b", "1.0"), ("", None, "1.0"), ("aaa", None, "2.0")):
        with pytest.raises(tables.TableError):
            tables.manifest_metadata(rows(configs, engine), ["engine"], config_id)
    # the same histogram and size, but other rows: another cohort
    renamed = table.withColumn("metal_site_id", F.concat("metal_site_id", F.lit("x")))
    other = tables.write_reference(renamed, str(tmp_path / "two")).first()
    assert other["reference_id"] == metadata["reference_id"] and other["cohort_id"] != metadata["cohort_id"]
    assert other["analysis_config_id"] is None
    shuffled = tables.write_reference(table.repartition(3), str(tmp_path / "three")).first()
    assert shuffled["cohort_id"] == metadata["cohort_id"]


def test_stream_scores_like_the_batch_job_and_once_per_site(spark, tmp_path):
    inputs, folder = str(tmp_path / "inputs"), str(tmp_path / "ref")
    table = _inputs(spark)
    table.write.parquet(inputs)
    tables.write_reference(table, folder)
    frozen, metadata = tables.load_reference(spark, folder)
    for _ in range(2):
        arriving = spark.readStream.schema(INPUTS).option("maxFilesPerTrigger", 2).parquet(inputs)
        stream.score_batches(arriving, frozen, str(tmp_path / "out"), str(tmp_path / "cp"), metadata=metadata).awaitTermination()
        table.limit(7).write.mode("append").parquet(inputs)
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    jobs.score(spark, inputs, str(tmp_path / "batch"), folder)
    want = spark.read.parquet(str(tmp_path / "batch")).dropDuplicates(["metal_site_id"])
    assert got.count() == 40
    assert got.select(want.columns).exceptAll(want).count() == 0


def test_csv_export_writes_published_text(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", True, 1.5, ["x", None, "y"]), ("b", None, float("nan"), [])],
        "id string, flag boolean, value double, items array<string>",
    )
    path = str(tmp_path / "out")
    tables.write_csv(df, path, ["id", "items", "flag", "value"])
    got = spark.read.option("header", True).csv(path)
    assert got.columns == ["id", "items", "flag", "value"]
    assert {tuple(r) for r in got.collect()} == {("a", "x||y", "true", "1.5"), ("b", None, None, None)}
    with pytest.raises(tables.TableError, match="unexpected"):
        tables.assert_schema(df, ["id", "flag"], "x")


def test_mirror_listing_choice_and_probe(spark, tmp_path):
    for name, body in {
        "ab/1abc/1abc_final.mtz": "data", "ab/1abc/1abc_final.cif": "<!DOCTYPE html>", "ab/1abc/1abc_final.pdb": "ATOM",
        "de/2def/2def_final.cif": "x", "zz/3xyz/3xyz_final.mtz": "x", "xy/3xyz/3xyz_final.mtz": "",
    }.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body)
    listed = src.list_files(spark, str(tmp_path), probe=True)
    good = src.with_choice(listed.where(src.usable("head", "length")))
    best = {(r.entry_id, r.kind): r.path.rsplit("/", 1)[1] for r in src.best_files(good).collect()}
    assert best == {("1abc", "mtz"): "1abc_final.mtz", ("1abc", "coordinates"): "1abc_final.pdb", ("2def", "coordinates"): "2def_final.cif"}
    assert [r[0] for r in src.complete_entries(good).collect()] == ["1abc"]


def test_id_list(spark, tmp_path):
    path = tmp_path / "ids.txt"
    path.write_text("1ABC, 2def  # note 9zzz\n1abc\n3ghi\ttoolong\n")
    got = sorted(src.read_id_list(spark, str(path)).collect(), key=lambda r: r.first_at)
    assert [(r.token, r.valid) for r in got] == [("1abc", True), ("2def", True), ("3ghi", True), ("toolong", False)]


def test_payload_cache(spark, tmp_path):
    good = {"pdb_id": "1ABC", "metadata_source": "api", "retrieved_at_utc": "t", "entry_revision_date": "", "entry_available": True, "conditions": [{"pH": "7"}]}
    for name, value in {"1abc": good, "2def": good, "3ghi": {"pdb_id": "3ghi"}}.items():
        folder = tmp_path / name[1:3]
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.json").write_text(json.dumps(value))
    from sitegrade.operators.conditions import valid_payloads
    assert [r.entry_id for r in valid_payloads(src.read_payloads(spark, str(tmp_path))).collect()] == ["1abc"]


def test_occupancy_and_conformers(spark):
    rows = [
        ("1abc", 0, 0, 0, 1, "N", "A", "N", "0.60"), ("1abc", 0, 0, 0, 2, "N", "B", "N", "0.6000000000000001"),
        ("1abc", 0, 0, 0, 3, "CA", "", "C", "1.00"), ("1abc", 0, 0, 0, 4, "CA", "A", "C", "abc"),
        ("1abc", 0, 0, 1, 5, "O", "X", "O", ""), ("1abc", 0, 0, 1, 6, "O", "Y", "O", "2"),
    ]
    df = spark.createDataFrame(
        rows, "entry_id string, model_index int, chain_index int, residue_index int, source_order int, atom_name string, altloc string, element string, occupancy_raw string"
    ).withColumns({"is_water": F.lit(False), **{a: F.lit(0.0) for a in "xyz"}})
    atoms = inv.with_element(inv.with_occupancy(df))
    assert [r[0] for r in atoms.orderBy("source_order").select("occupancy_status").collect()] == [
        "valid", "valid", "valid", "invalid_non_numeric", "missing", "invalid_range"]
    chosen = {r.residue_index: r for r in inv.residue_selections(atoms).collect()}
    assert chosen[0].selected_altloc == "A" and not chosen[0].altloc_selection_fallback
    assert chosen[1].selected_altloc == "X" and chosen[1].altloc_selection_fallback
    kept = inv.contact_atoms(atoms, inv.residue_selections(atoms))
    assert {(r.residue_index, r.atom_name, r.altloc) for r in kept.collect()} == {(0, "N", "A"), (0, "CA", "A"), (1, "O", "X")}


def test_connection_ids_stay_unique(spark):
    rows = [("e", 1, "LINK", "x"), ("e", 2, "LINK", "x"), ("e", 3, "LINK", "x_2"), ("e", 4, "LINK", "")]
    df = spark.createDataFrame(rows, "entry_id string, position int, source string, connection_id string")
    got = [r[0] for r in dec.unique_connection_ids(df).orderBy("position").select("connection_id").collect()]
    assert got == ["x", "x_2", "x_2_3", "LINK_4"]


def test_terminal_rows_and_header_difference(spark):
    rows = [("ok", None, []), ("partial", False, ["invalid_occupancy"]), ("partial", None, []), ("partial", False, ["retired"]), ("partial", True, []), ("error", False, [])]
    df = spark.createDataFrame(rows, "status string, retryable boolean, codes array<string>")
    assert [r[0] for r in df.select(runs.is_terminal("status", "retryable", "codes")).collect()] == [True, True, False, False, False, False]
    assert runs.header_difference(["a", "c"], ["a", "b"]) == "missing b; unexpected c"
    assert runs.header_difference(["b", "a"], ["a", "b"]) == "the same columns in a different order"


def test_heme_and_cluster(spark):
    ring = [f"r{i}" for i in range(24)]
    elements = {a: "N" if i % 6 == 0 else "C" for i, a in enumerate(ring)}
    atoms = [("HEM", a, e) for a, e in elements.items()] + [("HEM", "FE", "FE")]
    bonds = [("HEM", ring[i], ring[(i + 1) % 24]) for i in range(24)]
    bonds += [("HEM", "FE", a) for a, e in elements.items() if e == "N"]
    atoms += [("SF4", "S1", "S"), ("SF4", "FE1", "FE"), ("SF4", "FE2", "FE"), ("ZN", "ZN", "ZN")]
    bonds += [("SF4", "S1", "FE1"), ("SF4", "S1", "FE2")]
    # The same atoms as an open chain hold no core.
    atoms += [("OPN", a, e) for a, e in elements.items()] + [("OPN", "FE", "FE")]
    bonds += [("OPN", ring[i], ring[i + 1]) for i in range(23)] + [("OPN", "FE", a) for a, e in elements.items() if e == "N"]
    adf = spark.createDataFrame(atoms, "component_id string, atom_id string, element string")
    bdf = spark.createDataFrame(bonds, "component_id string, atom_id_1 string, atom_id_2 string")
    cdf = spark.createDataFrame([("HEM", "C20 N4 Fe"), ("SF4", "Fe2 S"), ("ZN", "Zn"), ("OPN", "?"), ("BNZ", "C6 H6")], "component_id string, formula string")
    got = {r.component_id: r.structural_class for r in cat.build_catalog(cdf, adf, bdf).collect()}
    assert got == {"HEM": "heme", "SF4": "cluster", "OPN": ""}


def test_bounded_detail(spark):
    df = spark.createDataFrame([("x" * 1000, "y" * 1000), ("", "short"), ("a", "")], "a string, b string")
    got = [r[0] for r in df.select(runs.joined_detail(F.col("a"), F.col("b"))).collect()]
    assert len(got[0]) == 300 and "more characters]; y" in got[0]
    assert got[1:] == ["short", "a"]
