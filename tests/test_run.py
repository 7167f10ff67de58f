"""The whole-run plan: options, the gate, failures that keep earlier rows, and resuming."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from sitegrade.bindings import contacts as bc
from sitegrade.bindings.inventory import source_atoms
from sitegrade.operators.lookup import literature
from sitegrade.plans import run
from sitegrade.session import cut_lineage
from sitegrade.streaming.store import EntryStore

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    few = F.regexp_extract("entry_id", r"(\d+)", 1).cast("int") < 8
    records = cut_lineage(source_atoms(spark, SF_DIR).where(few))
    entries = bc.cells(spark, SF_DIR).where(few).select(
        "entry_id", F.lit(0.1).alias("dpi"), F.lit("").alias("dpi_reason"), F.lit(False).alias("searched"))
    return run.RunInputs(records, cut_lineage(entries), literature(spark))


def _manifest(store):
    return {r.entry_id: r for r in store.read("manifest").collect()}


def test_caps_and_runs_without_bonds_resume(spark, tmp_path, inputs):
    store = EntryStore(spark, str(tmp_path), run.TABLES, buckets=4)
    ids = inputs.entries.select("entry_id")
    assert run.run_entries(spark, ids, inputs, store, 0, run.RunOptions(bonds=False, cap=3))
    first = _manifest(store)
    assert sorted(first) == ["e0", "e1", "e2"] and store.read("bonds").count() == 0
    assert run.run_entries(spark, ids, inputs, store, 1, run.RunOptions(bonds=False, resume=True, cap=2))
    assert sorted(_manifest(store)) == [f"e{i}" for i in range(5)]
    # a run with bonds takes entries again whose bonds were never searched
    assert run.run_entries(spark, ids, inputs, store, 2, run.RunOptions(resume=True, cap=4))
    rows = _manifest(store)
    assert all(rows[f"e{i}"].n_bonds is not None for i in range(4)) and len(rows) == 5
    counted = {r.entry_id: r.n for r in store.read("candidates").groupBy("entry_id").agg(F.count("*").alias("n")).collect()}
    assert all((counted.get(e, 0)) == (r.n_candidates or 0) for e, r in rows.items())


def test_failures_and_limits_stop_an_entry_before_the_joins(spark, tmp_path, inputs, monkeypatch):
    met = []
    plain = run.analyze_contacts

    def watched(atoms, *args):
        met.extend(r.entry_id for r in atoms.select("entry_id").distinct().collect())
        return plain(atoms, *args)

    monkeypatch.setattr(run, "analyze_contacts", watched)
    counts = {r.entry_id: r.n_metals for r in run.take_inventory(inputs.records)[0].collect()}
    limit = sorted(counts.values())[-2]
    over = {e for e, n in counts.items() if n > limit}
    assert over
    failures = spark.createDataFrame(
        [("e1", "bonds", "ValueError", "b"), ("e1", "bonds", "KeyError", "a"), ("e2", "input", "OSError", "x")], run.FAILURES)
    store = EntryStore(spark, str(tmp_path), run.TABLES, buckets=4)
    broken = run.RunInputs(inputs.records, inputs.entries, inputs.reference, failures=failures)
    ids = inputs.entries.select(F.upper("entry_id").alias("entry_id"))
    run.run_entries(spark, ids, broken, store, 0, run.RunOptions(site_limit=limit))
    assert not over & set(met) and not {"e1", "e2"} & set(met) and met
    rows = _manifest(store)
    assert all(rows[e].metal_site_limit_exceeded and rows[e].status == "ok" for e in over)
    if "e1" not in over:
        assert "bond_stage_failure" in rows["e1"].reason_codes and rows["e1"].retryable
        assert rows["e1"].status_detail.endswith("KeyError: a") and rows["e1"].n_bonds is None
        assert store.read("inventory").where("entry_id = 'e1'").count() == 1
    assert rows["e2"].status == "error" and rows["e2"].reason_codes == ["unexpected_processing_error"]
    kept = rows["e0"]
    run.run_entries(spark, ids, inputs, store, 1, run.RunOptions(site_limit=limit, resume=True))
    rows = _manifest(store)
    assert rows["e0"] == kept and not any(r.retryable for r in rows.values())
