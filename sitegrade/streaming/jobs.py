"""Streaming scorer, live status counts, and idempotent replacement of entries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sitegrade.functions import scoring as fs
from sitegrade.operators.intervals import interval_index, rank_by_interval
from sitegrade.operators.runs import batch_tally, replaceable, status_counts
from sitegrade.plans import jobs as plans
from sitegrade.plans.score import score_ranked, with_reference_columns
from sitegrade.session import cut_lineage
from sitegrade.sources import tables
from sitegrade.streaming.store import EntryStore, KeyStore


def classify_stream(arriving: DataFrame) -> DataFrame:
    """Verdicts of arriving site rows without state and without a distribution."""
    missing = F.lit(None).cast("double")
    verdict = fs.with_verdict(arriving, "rszd_abs", "geometry_rms_zbond")
    return with_reference_columns(
        verdict.withColumns(
            {"density_score": missing, "geometry_score": missing, "site_score": missing}
        ),
        None,
    )


def score_batches(
    arriving: DataFrame, distribution: DataFrame, output: str, checkpoint: str,
    keys: Sequence[str] = ("entry_id", "metal_site_id"), metadata: dict | None = None,
) -> StreamingQuery:
    """Score a stream to Parquet, ranking unseen values exactly and each site once.

    The distribution is turned into its interval index once, before the stream
    starts; a batch only joins it. Of rows that repeat a site, the earliest
    batch's stays, within a batch the smallest in column order; sites of earlier
    batches are looked up in ``<output>-keys``, by the buckets of the batch's own
    sites. A batch is written under its own number, so a replay overwrites it.
    """
    index = cut_lineage(interval_index(distribution))
    seen = KeyStore(arriving.sparkSession, f"{output.rstrip('/')}-keys", keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = cut_lineage(seen.fresh(batch, batch_id))
        scored = with_reference_columns(score_ranked(rank_by_interval(fresh.drop("bucket"), index)), metadata)
        scored.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
        seen.add(fresh, batch_id)

    return (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def status_stream(arriving: DataFrame, columns: Sequence[str] = ("status",)) -> DataFrame:
    """Running entries per status: a stateful count for update or complete mode."""
    if list(columns) == ["status"]:
        return status_counts(arriving)
    return arriving.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


def collect_cohort(arriving: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append arriving score inputs to Parquet; a batch job freezes them once complete."""
    return (
        arriving.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def freeze_cohort(
    spark: SparkSession, inputs_path: str, output_path: str, reference_folder: str,
    manifest: DataFrame, software: tuple[str, ...] = (), config_id: str | None = None,
) -> dict:
    """Freeze an accumulated cohort once its run is complete; may be called again at any time.

    While a retry could still add an entry nothing is written:
    ``{"score_status": "not_finalized_incomplete_run", "score_recoverable_entries": n}``.
    Afterwards the reference and the scores are made once; a later call with the
    same rows leaves them, and one with other rows makes them anew.
    """
    unfinished = batch_tally(manifest).first()["recoverable_incompleteness"]
    if unfinished:
        return {"score_status": "not_finalized_incomplete_run", "score_recoverable_entries": unfinished}
    frozen = tables.frozen_cohort(spark, reference_folder, inputs_path)
    if frozen is not None and tables.exists(spark, f"{output_path}/_SUCCESS"):
        return {"score_status": "already_finalized", "score_recoverable_entries": 0, **frozen}
    metadata = plans.finalize(
        spark, inputs_path, output_path, reference_folder, manifest, software, config_id)
    return {"score_status": "finalized", "score_recoverable_entries": 0, **metadata}


def replace_stream(
    results: DataFrame, stage: Callable[[DataFrame], dict[str, DataFrame]], store: EntryStore,
    checkpoint: str, order: str = "attempt",
) -> StreamingQuery:
    """Replace entries in a store's tables as their results arrive.

    ``results`` is a stream of manifest rows. Of several results of an entry in
    one batch the one with the highest ``order`` counts. Only final outcomes
    replace: ``stage`` gets their rows and returns the new rows of every table
    but ``manifest``, which the results themselves fill.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        last = batch.groupBy("entry_id").agg(
            F.max_by(F.struct(*batch.columns), F.col(order)).alias("row")).select("row.*")
        last = cut_lineage(last)
        final = cut_lineage(last.join(replaceable(last), "entry_id", "left_semi").select(*batch.columns))
        store.commit({**stage(final), "manifest": final}, final, batch_id)

    return (
        results.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
