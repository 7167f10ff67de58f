"""Job entry points: finalize a cohort, score against a frozen one, classify."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitegrade.operators.runs import batch_tally
from sitegrade.operators.score_inputs import (
    complete_site_count, duplicate_keys, excess_entries, prepare_score_inputs,
)
from sitegrade.plans.score import (
    classify_inputs, resolve_reference, score_inputs_against, with_reference_columns,
)
from sitegrade.sources import tables

MODES = ("database", "reference", "classification", "off")


def prepare(spark: SparkSession, sites: DataFrame, bonds: DataFrame, entries: DataFrame, path: str) -> DataFrame:
    """Write the prepared score inputs of a run and return the stored table."""
    repeated = duplicate_keys(sites.where("selected_metal_site_status = 'selected'"),
                              ["entry_id", "metal_site_id"]).limit(1).collect()
    if repeated:
        raise tables.TableError(f"duplicate site key: {repeated[0].asDict()}")
    rows = prepare_score_inputs(sites, bonds)
    over = excess_entries(rows, entries).limit(1).collect()
    if over:
        raise tables.TableError(f"score inputs exceed the site count of {over[0]['entry_id']}")
    complete_site_count(rows, entries).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def finalize(
    spark: SparkSession, inputs_path: str, output_path: str, reference_folder: str,
    manifest: DataFrame | None = None, software: tuple[str, ...] = (), config_id: str | None = None,
) -> dict:
    """Freeze the cohort, then rank it against itself. Returns the metadata.

    With a manifest the job refuses while a retry could still add an entry, and
    where its rows come from several or from other configurations; its counts
    become part of the metadata.
    """
    provenance = None
    if manifest is not None:
        provenance = tables.manifest_metadata(manifest, software, config_id)
        unfinished = batch_tally(manifest).first()["recoverable_incompleteness"]
        if unfinished:
            raise tables.TableError(f"{unfinished} entries could still be added by a resume")
    inputs = tables.validate_score_inputs(spark.read.parquet(inputs_path))
    tables.write_reference(inputs, reference_folder, provenance)
    frozen, metadata = tables.load_reference(spark, reference_folder)
    scored = score_inputs_against(inputs, frozen, same_cohort=True)
    with_reference_columns(scored, metadata).write.mode("overwrite").parquet(output_path)
    return metadata


def score(spark: SparkSession, inputs_path: str, output_path: str, reference_folder: str) -> dict:
    """Score prepared rows against a frozen reference. Returns its metadata."""
    frozen, metadata = tables.load_reference(spark, reference_folder)
    inputs = tables.validate_score_inputs(spark.read.parquet(inputs_path))
    scored = with_reference_columns(score_inputs_against(inputs, frozen), metadata)
    scored.write.mode("overwrite").parquet(output_path)
    return metadata


def classify(spark: SparkSession, inputs_path: str, output_path: str) -> None:
    """Verdicts without ranks, when no reference exists."""
    inputs = tables.validate_score_inputs(spark.read.parquet(inputs_path))
    with_reference_columns(classify_inputs(inputs), None).write.mode("overwrite").parquet(output_path)


def choose_mode(
    spark: SparkSession, *, bonds: bool, whole_database: bool, explicit: str | None = None,
    folders: tuple[str, ...] = (),
) -> tuple[str, str | None]:
    """How a run is scored, and the reference it uses.

    Without contacts nothing is scored; a whole-database run builds its own
    reference; any other run ranks against the first reference found, an
    explicit one being required to exist, and otherwise only classifies.
    """
    def present(folder: str) -> bool:
        target, system = tables._hadoop_path(spark, tables.metadata_path(folder))
        return bool(system.exists(target))

    if not bonds:
        return "off", None
    if whole_database:
        return "database", None
    if explicit is not None and not present(explicit):
        raise tables.TableError(f"no completed score reference under {explicit}")
    found = resolve_reference([explicit, *folders], present)
    return ("reference", found) if found else ("classification", None)
