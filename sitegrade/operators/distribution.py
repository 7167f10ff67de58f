"""Empirical distributions: histogram, reverse average rank, invariants, identity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade.functions.clean import finite
from sitegrade.functions.rounding import REFERENCE_PLACES, with_rounded
from sitegrade.operators.prefix import METRIC_WIDTHS, running_before
from sitegrade.session import cut_lineage

#: Component name -> input column of the standard score table.
COMPONENTS = {"density": "rszd_abs", "geometry": "geometry_rms_zbond"}


def observations(inputs: DataFrame, components: Mapping[str, str] = COMPONENTS) -> DataFrame:
    """One row per usable measurement: ``component`` and its three-decimal ``value``."""
    named = F.array(
        *[
            F.struct(F.lit(name).alias("component"), finite(column).alias("raw"))
            for name, column in components.items()
        ]
    )
    measured = inputs.select(F.inline(named)).where(F.col("raw") >= 0)
    return with_rounded(measured, {"value": ("raw", REFERENCE_PLACES)}).select(
        "component", "value"
    )


def value_histogram(
    inputs: DataFrame, components: Mapping[str, str] = COMPONENTS
) -> DataFrame:
    """The cohort distribution: ``component``, ``value``, ``count``.

    Saturated measurements are counted like any other.
    """
    return (
        observations(inputs, components)
        .groupBy("component", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def merge_histograms(*parts: DataFrame) -> DataFrame:
    """Add several histograms, re-keyed at reference precision."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return (
        with_rounded(merged, {"value": ("value", REFERENCE_PLACES)})
        .groupBy("component", "value")
        .agg(F.sum("count").alias("count"))
    )


def component_sizes(distribution: DataFrame) -> DataFrame:
    """Distinct values and observations per component."""
    return distribution.groupBy("component").agg(
        F.count(F.lit(1)).alias("distinct_value_count"),
        F.sum("count").alias("reference_size"),
    )


def rank_table(distribution: DataFrame, queried: DataFrame | None = None) -> DataFrame:
    """Reverse average rank of every distribution value and every queried value.

    ``score = 100 * (N - below - equal / 2) / N``. A queried value the
    distribution lacks enters with a zero count, so its ``below`` is the
    cumulative count of its neighbours. ``queried`` holds ``component, value``.
    """
    counts = distribution.select("component", "value", "count")
    if queried is not None:
        asked = queried.select("component", "value").distinct()
        counts = (
            counts.unionByName(asked.withColumn("count", F.lit(0).cast("long")))
            .groupBy("component", "value")
            .agg(F.sum("count").alias("count"))
        )
    placed = running_before(
        counts, ["component"], "value", "count", "below", METRIC_WIDTHS
    )
    # One row per component: the bound is the number of components.
    sizes = F.broadcast(
        distribution.groupBy("component").agg(F.sum("count").alias("size"))
    )
    return placed.join(sizes, "component", "left").select(
        "component",
        "value",
        F.col("count").alias("equal"),
        F.col("below").cast("long").alias("below"),
        "size",
        F.when(
            F.col("size") > 0,
            100.0
            * (F.col("size") - F.col("below") - 0.5 * F.col("count"))
            / F.col("size"),
        ).alias("score"),
    )


def rank_against(
    inputs: DataFrame,
    distribution: DataFrame,
    components: Mapping[str, str] = COMPONENTS,
    *,
    same_cohort: bool = False,
) -> DataFrame:
    """Add ``<component>_rank`` per component, ranked in ``distribution``.

    ``same_cohort`` promises that every input value is in the distribution, as
    when a cohort is ranked against itself; the query values then need no pass
    of their own. The join key repeats (many sites share a value), and adaptive
    execution either broadcasts the rank table once its size is known or splits
    the crowded values.
    """
    queried = None if same_cohort else observations(inputs, components)
    # Small by construction (distinct three-decimal values) and read once per
    # component, so it is written out rather than derived again for each join.
    ranks = cut_lineage(rank_table(distribution, queried))
    ranked = with_rounded(
        inputs,
        {
            f"__{name}_value": (F.when(F.col(column) >= 0, finite(column)), REFERENCE_PLACES)
            for name, column in components.items()
        },
    )
    for name in components:
        key = f"__{name}_value"
        side = ranks.where(F.col("component") == name).select(
            F.col("value").alias(key), F.col("score").alias(f"{name}_rank")
        )
        ranked = ranked.join(side, key, "left").drop(key)
    return ranked


def violations(distribution: DataFrame) -> DataFrame:
    """Rows breaking a distribution rule, with the rule's name.

    Values are finite and not negative, counts are at least one, components are
    known, and no (component, value) repeats. Order needs no check of its own:
    unique values sort strictly.
    """
    value, count = F.col("value"), F.col("count")
    rules = F.array(
        F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")) | (value < 0),
               F.lit("invalid_value")),
        F.when(count.isNull() | (count < 1), F.lit("invalid_count")),
        F.when(~F.col("component").isin(*COMPONENTS), F.lit("unknown_component")),
    )
    broken = distribution.select(
        "component", "value", "count",
        F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"),
    )
    repeated = (
        distribution.groupBy("component", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.max("count").alias("count"))
        .where("n > 1")
        .select("component", "value", "count", F.lit("duplicate_value").alias("rule"))
    )
    return broken.unionByName(repeated)


def _digest(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, "\n"), 256)


def fingerprint(distribution: DataFrame, policy_json: str) -> DataFrame:
    """One row, ``fingerprint``: a digest of the policy and every (value, count).

    Lines are digested per bucket of one unit, buckets per thousand, thousands
    per component, so no task ever holds the whole table. Each line is
    ``component,milli-value,count``, which has one spelling per row.
    """
    milli = F.round(F.col("value") * 1000).cast("long")
    lines = distribution.select(
        "component",
        milli.alias("milli"),
        F.concat_ws(",", "component", milli.cast("string"), F.col("count").cast("string")).alias("line"),
    )
    level = lines.withColumn("bucket", F.floor(F.col("milli") / 1000))
    level = level.groupBy("component", "bucket").agg(
        _digest(F.transform(
            F.array_sort(F.collect_list(F.struct("milli", "line"))), lambda s: s["line"]
        )).alias("line")
    )
    level = level.withColumn("top", F.floor(F.col("bucket") / 1000)).groupBy("component", "top").agg(
        _digest(F.transform(
            F.array_sort(F.collect_list(F.struct("bucket", "line"))), lambda s: s["line"]
        )).alias("line")
    )
    whole = level.groupBy().agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("component", "top", "line"))),
            lambda s: s["line"],
        ).alias("lines")
    )
    return whole.select(
        F.sha2(
            F.concat(F.lit(policy_json + "\n"), F.array_join("lines", "\n")), 256
        ).alias("fingerprint")
    )


def cohort_summary(inputs: DataFrame) -> DataFrame:
    """One row of cohort provenance: rows, entries, scorable entries."""
    entry = F.lower(F.trim("entry_id"))
    named = F.when(entry != "", entry)
    scorable = finite("rszd_abs").isNotNull() | finite("geometry_rms_zbond").isNotNull()
    return inputs.agg(
        F.count(F.lit(1)).alias("input_row_count"),
        F.count_distinct(named).alias("input_entry_count"),
        F.count_distinct(F.when(scorable, named)).alias("scorable_entry_count"),
    )


def status_histogram(inputs: DataFrame, status: str = "score_inputs_status") -> DataFrame:
    """Rows per status value."""
    return inputs.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("count"))
