"""Scoring jobs: freeze a cohort, rank against it, or classify without one."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions import scoring as fs
from sitegrade.functions.rounding import SCORE_PLACES, with_rounded
from sitegrade.operators import distribution as dist

#: The scoring policy as canonical JSON: sorted keys, no spaces.
POLICY_JSON = json.dumps(vocab.SCORING_POLICY, sort_keys=True, separators=(",", ":"))
ANALYSIS_COLUMNS = (
    "density_level", "density_score", "geometry_level", "geometry_score", "site_level",
    "site_score", "evidence_basis", "verdict_reason", "score_reference_id",
    "score_cohort_id", "score_cohort_size", "density_reference_size",
    "geometry_reference_size",
)


def classify_inputs(inputs: DataFrame) -> DataFrame:
    """Levels and verdict of prepared rows; the three scores stay null."""
    missing = F.lit(None).cast("double")
    return fs.with_verdict(inputs, "rszd_abs", "geometry_rms_zbond").withColumns(
        {"density_score": missing, "geometry_score": missing, "site_score": missing}
    )


def score_inputs_against(
    inputs: DataFrame, distribution: DataFrame, *, same_cohort: bool = False
) -> DataFrame:
    """Levels, verdict and scores of prepared rows ranked in ``distribution``."""
    return score_ranked(dist.rank_against(inputs, distribution, same_cohort=same_cohort))


def score_ranked(ranked: DataFrame) -> DataFrame:
    """Levels, verdict and scores of rows that carry ``density_rank`` and ``geometry_rank``."""
    scored = with_rounded(
        ranked,
        {
            "density_score": (fs.density_score("rszd_abs", "density_rank"), SCORE_PLACES),
            "geometry_score": ("geometry_rank", SCORE_PLACES),
        },
    ).withColumn("site_score", fs.overall_score("density_score", "geometry_score"))
    return fs.with_verdict(scored, "rszd_abs", "geometry_rms_zbond").drop(
        "density_rank", "geometry_rank"
    )


def resolve_reference(candidates: list[str | None], has_reference) -> str | None:
    """The first folder that holds a completed reference, in the order given.

    Callers pass explicit, output and bundled folders in that order; an
    explicit folder without a reference is an error of theirs to raise.
    """
    return next((folder for folder in candidates if folder and has_reference(folder)), None)


def with_reference_columns(scored: DataFrame, metadata: dict | None) -> DataFrame:
    """Add the reference identity every scored row carries; null without one."""
    known = metadata or {}
    columns = {
        "score_reference_id": ("reference_id", "string"),
        "score_cohort_id": ("cohort_id", "string"),
        "score_cohort_size": ("input_row_count", "long"),
        "density_reference_size": ("density_reference_size", "long"),
        "geometry_reference_size": ("geometry_reference_size", "long"),
    }
    return scored.withColumns(
        {name: F.lit(known.get(key)).cast(kind) for name, (key, kind) in columns.items()}
    )
