"""A whole run: from atom records to stored tables and a manifest, entry by entry in all stages.

Stages are jobs over all entries at once, with a table each. What happened to an
entry is a row that travels along: entries that failed, or finished early, leave
before the next stage's joins, and keep what earlier stages found. The outcome of
a run replaces its entries in the stored tables in one step, so a run that dies
changes nothing, and the next one resumes from the stored manifest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import bounded_list, labels
from sitegrade.operators import contacts as con
from sitegrade.operators import inventory as inv
from sitegrade.operators import runs
from sitegrade.plans.contacts import analyze_contacts
from sitegrade.session import cut_lineage
from sitegrade.streaming.store import EntryStore

#: Tables of a run, by entry: the inventory of all, the rest of entries that got there.
TABLES = ("inventory", "sites", "bonds", "candidates", "manifest")
FAILURES = "entry_id string, stage string, error_class string, message string"


@dataclass(frozen=True)
class RunOptions:
    """What a run does: bonds or the inventory alone, new entries or also unfinished ones."""

    bonds: bool = True
    resume: bool = False  # leave finished entries of the stored manifest out
    retry_partials: bool = False  # a resumed run takes every partial entry again
    cap: int | None = None  # at most so many entries, those to leave out not counted
    site_limit: int = vocab.MAX_METAL_SITES
    config_id: str = ""


@dataclass(frozen=True)
class RunInputs:
    """The tables of a run; records are first-model atom records with exact repeats collapsed."""

    records: DataFrame
    entries: DataFrame  # entry_id, dpi, dpi_reason, searched
    reference: DataFrame
    cells: DataFrame | None = None
    operations: DataFrame | None = None
    declared: DataFrame | None = None
    components: DataFrame | None = None
    #: What readers could not read: entry_id, stage (input or bonds), error_class, message.
    failures: DataFrame | None = None


def take_inventory(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per entry, what decides how far it goes, and the selected atoms."""
    atoms = cut_lineage(inv.contact_atoms(records, inv.residue_selections(records)))
    unknown = records.groupBy("entry_id").agg(
        F.count_if(F.col("element_status") != "valid").alias("unknown_element_atom_count"),
        F.count(F.lit(1)).alias("record_count"))
    counts = unknown.join(inv.metal_counts(atoms), "entry_id", "left").fillna(
        0, ["n_metals", "zero_occupancy_metal_count"])
    warned = counts.withColumn("warning_codes", labels([
        (F.col("unknown_element_atom_count") > 0, "unknown_elements"),
        (F.col("zero_occupancy_metal_count") > 0, "zero_occupancy_metal_excluded"),
    ]))
    return warned, atoms


def _first_failure(inputs: RunInputs, spark: SparkSession, stage: str) -> DataFrame:
    """One failure per entry of a stage, the first by class and message."""
    if inputs.failures is None:
        return spark.createDataFrame([], FAILURES).select("entry_id", "error_class", "message")
    return inputs.failures.where(F.col("stage") == stage).groupBy("entry_id").agg(
        F.min(F.struct("error_class", "message")).alias("f")).select("entry_id", "f.*")


def _manifest_rows(rows: DataFrame, options: RunOptions) -> DataFrame:
    """The manifest's columns, whatever stage an entry reached."""
    return rows.withColumn("retryable", runs.is_retryable("status", "reason_codes")).select(
        "entry_id", "status", "retryable", "reason_codes", "warning_codes",
        runs.shortened(F.col("status_detail"), vocab.STATUS_DETAIL_CHARS).alias("status_detail"),
        *[F.col(c).cast("long").alias(c) for c in ("n_metals", "n_bonds", "n_candidates")],
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("no_metals", "metal_site_limit_exceeded")],
        F.lit(options.config_id).alias("analysis_config_id"))


def run_entries(
    spark: SparkSession, ids: DataFrame, inputs: RunInputs, store: EntryStore, run_number: int,
    options: RunOptions = RunOptions(),
) -> bool:
    """Run entries and commit their rows under ``run_number``; False if it was committed before.

    ``ids`` (entry_id) may hold entries without records: those are skipped for a
    missing input. Of a resumed run, an entry replaces its stored rows only with
    a final outcome; new entries are stored with any.
    """
    stored = store.read("manifest") if options.resume else None
    asked = ids.select(F.lower(F.trim("entry_id")).alias("entry_id")).distinct()
    if stored is not None:
        asked = runs.pending_entries(asked, runs.done_entries(
            stored, bonds_required=options.bonds, retry_partials=options.retry_partials), options.cap)
    elif options.cap is not None:
        asked = asked.orderBy("entry_id").limit(options.cap)
    asked = cut_lineage(asked)

    def of(rows: DataFrame, keys: DataFrame) -> DataFrame:
        return rows.join(keys.select("entry_id"), "entry_id", "left_semi")

    # stage 1: inputs
    unread = _first_failure(inputs, spark, "input").join(asked, "entry_id", "left_semi")
    readable = asked.join(unread, "entry_id", "left_anti")
    none = F.array().cast("array<string>")
    broken = unread.select(
        "entry_id", F.lit("error").alias("status"), F.array(runs.error_reason("error_class")).alias("reason_codes"),
        none.alias("warning_codes"), F.concat_ws(": ", "error_class", "message").alias("status_detail"))
    # stage 2: inventory, the gate of everything after it
    inventory, atoms = take_inventory(of(inputs.records, readable))
    inventory = cut_lineage(inventory)
    missing = readable.join(inventory, "entry_id", "left_anti").select(
        "entry_id", F.lit("skip").alias("status"), F.array(F.lit("missing_input")).alias("reason_codes"),
        none.alias("warning_codes"), F.lit("missing input: no records").alias("status_detail"))
    early = cut_lineage(inv.early_outcome(inventory, options.site_limit))
    finished = early.join(inventory.select("entry_id", "warning_codes"), "entry_id")
    going = inventory.join(early, "entry_id", "left_anti").select("entry_id", "n_metals", "warning_codes")
    outcome = finished.unionByName(broken, allowMissingColumns=True).unionByName(
        missing, allowMissingColumns=True)
    tables = {name: None for name in ("sites", "bonds", "candidates")}
    # stage 3: contacts of the entries that are left
    lost = con.metals_without_position(of(atoms, going))
    judged = going.join(lost.select("entry_id", F.col("message").alias("lost")), "entry_id", "left")
    if options.bonds:
        failed = of(_first_failure(inputs, spark, "bonds"), going)
        able = cut_lineage(going.join(failed, "entry_id", "left_anti").select("entry_id"))
        found = analyze_contacts(
            of(inv.analyzable(atoms, early).drop("extra_records"), able), of(inputs.entries, able), inputs.reference,
            None if inputs.cells is None else of(inputs.cells, able), inputs.operations,
            None if inputs.declared is None else of(inputs.declared, able), inputs.components)
        tables = {"sites": found.sites, "bonds": found.bonds, "candidates": cut_lineage(found.candidates)}
        uncovered = con.uncovered_pairs(tables["candidates"])
        numbers = {
            name: rows.groupBy("entry_id").agg(F.count(F.lit(1)).alias(f"n_{name}"))
            for name, rows in tables.items() if name != "sites"}
        judged = judged.join(uncovered, "entry_id", "left").join(
            failed.withColumnsRenamed({"error_class": "broke", "message": "why"}), "entry_id", "left")
        for name, counted in numbers.items():
            judged = judged.join(counted, "entry_id", "left").withColumn(
                f"n_{name}", F.when(F.col("broke").isNull(), F.coalesce(f"n_{name}", F.lit(0))))
    else:
        judged = judged.withColumns({
            "pairs": F.lit(None).cast("array<string>"), "broke": F.lit(None).cast("string"),
            "why": F.lit(None).cast("string"), "n_bonds": F.lit(None), "n_candidates": F.lit(None)})
    analyzed = judged.withColumn("reason_codes", labels([
        (F.col("lost").isNotNull(), "non_finite_metal_coordinates"),
        (F.size("pairs") > 0, "missing_first_sphere_reference"),
        (F.col("broke").isNotNull(), "bond_stage_failure"),
    ])).withColumns({
        "status": runs.entry_status("reason_codes"),
        "status_detail": F.concat_ws(
            "; ", "lost",
            F.when(F.size("pairs") > 0, F.concat(
                F.lit("no first-sphere reference for "), bounded_list(F.col("pairs"), 5))),
            F.when(F.col("broke").isNotNull(), F.concat_ws(": ", "broke", "why"))),
    }).drop("pairs", "lost", "broke", "why")
    manifest = cut_lineage(_manifest_rows(
        outcome.unionByName(analyzed, allowMissingColumns=True), options))
    # last: one step replaces the entries in every table
    final = manifest
    if stored is not None:
        known = stored.select("entry_id")
        final = cut_lineage(manifest.join(known, "entry_id", "left_anti").select("entry_id").unionByName(
            of(runs.replaceable(manifest), known)))
    staged = {"inventory": inventory, "manifest": manifest}
    for name, rows in tables.items():
        if rows is None:
            rows = store.read(name).limit(0) if stored is not None else spark.createDataFrame([], "entry_id string")
        staged[name] = rows
    return store.commit(staged, final, run_number)
