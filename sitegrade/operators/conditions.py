"""Condition records and their per-entry summaries."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrade.functions import conditions as fc
from sitegrade.functions.clean import clean_placeholder, finite_text
from sitegrade.functions.ids import condition_id, entry_id
from sitegrade.operators.prefix import ordinal_within
from sitegrade.session import cut_lineage

CONTENT = ("method", "pH", "pH_range", "temperature_K", "temperature_details", "raw_details")
#: Condition column -> item of the deposited category.
GROW_ITEMS = {
    "crystal_id": "crystal_id", "method": "method", "pH": "pH", "pH_range": "pdbx_pH_range",
    "temperature_K": "temp", "temperature_details": "temp_details",
    "raw_details": "pdbx_details",
}
FLAGS = (
    "any_metal", "promiscuous_transition_metal", "ni_co_like_metal", "buffer_light_metal",
    "heavy_additive_phasing_metal", "sulfate", "cacodylate", "acetate",
)


def from_category(rows: DataFrame, items: Mapping[str, str] = GROW_ITEMS) -> DataFrame:
    """Condition rows of a deposited category: renamed, placeholders blanked."""
    return rows.select(
        entry_id("entry_id").alias("entry_id"), "position",
        *[clean_placeholder(item).alias(name) for name, item in items.items()],
    )


def from_remarks(files: DataFrame) -> DataFrame:
    """Condition rows of coordinate files given as ``entry_id, position, text``."""
    details = files.select(
        entry_id("entry_id").alias("entry_id"), "position",
        fc.remark_details("text").alias("raw_details"),
    ).where(F.col("raw_details") != "")
    return details.select(
        "entry_id", "position",
        F.lit("").alias("crystal_id"),
        fc.method_keyword("raw_details").alias("method"),
        fc.ph_value("raw_details").alias("pH"),
        fc.ph_range("raw_details").alias("pH_range"),
        fc.temperature_kelvin("raw_details").alias("temperature_K"),
        F.lit("").alias("temperature_details"),
        "raw_details",
    )


def number_conditions(rows: DataFrame) -> DataFrame:
    """Drop rows that say nothing and number the rest of each entry from one."""
    said = F.lit(False)
    for name in CONTENT:
        said = said | (F.trim(name) != "")
    numbered = ordinal_within(rows.where(said), ["entry_id"], "position", "ordinal")
    return numbered.withColumn("condition_id", condition_id("entry_id", "ordinal"))


def summarize_conditions(rows: DataFrame) -> DataFrame:
    """One row per entry: counts, pH and temperature ranges, metals and flags.

    Everything but the listed ids and texts is reduced row by row before the
    shuffle; texts are made distinct first, so a repeated text travels once.
    """
    searchable = F.concat_ws(" ", "method", "pH_range", "temperature_details", "raw_details")
    flags = fc.ingredient_flags("searchable")
    acid = lambda x: F.when((x >= 0) & (x <= 14), x)
    mined = rows.withColumn("searchable", searchable).withColumns(
        {
            "metals": fc.metals_in_text("searchable"),
            "ph_numbers": F.filter(
                F.transform(
                    F.concat(
                        F.array(finite_text("pH")),
                        F.transform(
                            F.regexp_extract_all("pH_range", F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1)),
                            lambda t: t.try_cast("double"),
                        ),
                    ),
                    acid,
                ),
                lambda x: x.isNotNull(),
            ),
            "kelvin": finite_text("temperature_K"),
            **flags,
        }
    )
    core = mined.groupBy("entry_id").agg(
        F.count(F.lit(1)).alias("condition_count"),
        F.min(F.array_min("ph_numbers")).alias("pH_min"),
        F.max(F.array_max("ph_numbers")).alias("pH_max"),
        F.min("kelvin").alias("temperature_min_K"),
        F.max("kelvin").alias("temperature_max_K"),
        *[F.bool_or(name).alias(name) for name in flags],
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("metals")))).alias("metals"),
    )
    texts = (
        rows.where(F.trim("raw_details") != "")
        .groupBy("entry_id", F.trim("raw_details").alias("text"))
        .agg(F.min("ordinal").alias("at"))
        .groupBy("entry_id")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("at", "text"))), lambda s: s["text"]
                ),
                " || ",
            ).alias("raw_text")
        )
    )
    joined = core.join(texts, "entry_id", "left")
    return joined.withColumns(
        {
            "raw_text": F.coalesce("raw_text", F.lit("")),
            "condition_ids": F.transform(
                F.sequence(F.lit(1).cast("long"), F.col("condition_count")),
                lambda n: condition_id("entry_id", n),
            ),
            **fc.metal_class_flags("metals"),
        }
    )


def data_status(summary_found: str, parsed: str, present: str):
    """available / not_reported / unparseable / input_unavailable from three flags."""
    return (
        F.when(F.coalesce(F.col(summary_found), F.lit(False)), F.lit("available"))
        .when(~F.coalesce(F.col(present), F.lit(False)), F.lit("input_unavailable"))
        .when(~F.coalesce(F.col(parsed), F.lit(True)), F.lit("unparseable"))
        .otherwise(F.lit("not_reported"))
    )


def choose_source(
    local: DataFrame, deposited: DataFrame, *, prefer_local: bool = False
) -> DataFrame:
    """Per entry, which of two summaries speaks: ``local`` or ``deposited``.

    Both carry ``entry_id`` and ``status``. Without a deposited record the
    local one stands. An available source beats an unavailable one; between
    equals the preferred one wins.
    """
    both = local.select("entry_id", F.col("status").alias("local_status")).join(
        deposited.select("entry_id", F.col("status").alias("deposited_status")),
        "entry_id", "full_outer",
    )
    mine = F.coalesce(F.col("local_status") == "available", F.lit(False))
    theirs = F.coalesce(F.col("deposited_status") == "available", F.lit(False))
    chosen = F.when(F.col("deposited_status").isNull(), F.lit("local"))
    if prefer_local:
        chosen = chosen.when(mine, F.lit("local"))
    chosen = (
        chosen.when(theirs, F.lit("deposited"))
        .when(mine, F.lit("local"))
        .otherwise(F.lit("local" if prefer_local else "deposited"))
    )
    return both.withColumn("chosen", chosen).withColumn(
        "status",
        F.when(F.col("chosen") == "local", F.col("local_status")).otherwise(
            F.col("deposited_status")
        ),
    )


PROVENANCE = ("source_format", "metadata_source", "retrieved_at_utc", "entry_revision_date")


@dataclass(frozen=True)
class ConditionSource:
    """What one source says: condition rows, and how each entry was read.

    ``rows`` holds ``entry_id, position`` and the condition columns; ``reads`` one
    row per entry the source knows: ``entry_id, present, parsed`` and provenance.
    """

    rows: DataFrame
    reads: DataFrame


def _source_status(numbered: DataFrame, reads: DataFrame) -> DataFrame:
    """Per entry of a source: its status, the number of its conditions, its provenance."""
    counts = numbered.groupBy("entry_id").agg(F.count(F.lit(1)).alias("__n"))
    known = reads.withColumn("entry_id", entry_id("entry_id")).join(counts, "entry_id", "left").withColumn(
        "__found", F.coalesce("__n", F.lit(0)) > 0)
    return known.withColumn("status", data_status("__found", "parsed", "present")).select(
        "entry_id", "status", *PROVENANCE)


def condition_context(
    entries: DataFrame, local: ConditionSource, deposited: ConditionSource, *, prefer_local: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The condition rows of each entry's winning source, and one summary row for every entry.

    An entry the local source does not know has no local input. Rows carry the
    provenance of their source. Entries without conditions get a summary with the
    reason as ``status``, zero conditions and unset flags.
    """
    asked = entries.select(entry_id("entry_id").alias("entry_id")).distinct()
    sources = {}
    for name, source in (("local", local), ("deposited", deposited)):
        numbered = cut_lineage(number_conditions(source.rows))
        sources[name] = numbered, cut_lineage(_source_status(numbered, source.reads))
    blank = {c: F.coalesce(c, F.lit("")) for c in PROVENANCE}
    here = asked.join(sources["local"][1], "entry_id", "left").withColumns(
        {"status": F.coalesce("status", F.lit("input_unavailable")), **blank})
    there = sources["deposited"][1].withColumns(blank)
    chosen = choose_source(here, there.join(asked, "entry_id", "left_semi"), prefer_local=prefer_local)
    told = [
        chosen.where(F.col("chosen") == name).select("entry_id", "chosen", "status").join(
            reads.drop("status"), "entry_id")
        for name, reads in (("local", here), ("deposited", there))]
    told = cut_lineage(told[0].unionByName(told[1]))
    rows = [
        sources[name][0].join(told.where(F.col("chosen") == name).drop("chosen", "status"), "entry_id")
        for name in ("local", "deposited")]
    won = cut_lineage(rows[0].unionByName(rows[1], allowMissingColumns=True))
    said = summarize_conditions(won)
    defaults = {"bigint": F.lit(0).cast("bigint"), "boolean": F.lit(False), "string": F.lit(""),
                "array<string>": F.array().cast("array<string>")}
    full = told.join(said, "entry_id", "left")
    # numbers that describe a range stay null where there is nothing to describe
    return won, full.withColumns({
        name: F.coalesce(name, defaults[kind]) for name, kind in said.dtypes
        if name != "entry_id" and kind in defaults})


def reconcile_requests(requested: DataFrame, responses: DataFrame) -> DataFrame:
    """One payload per requested entry; an entry without a response is unavailable."""
    asked = requested.select(entry_id("entry_id").alias("entry_id")).distinct()
    known = responses.withColumn("entry_id", entry_id("entry_id")).withColumn(
        "__found", F.lit(True)
    )
    return asked.join(known, "entry_id", "left").withColumn(
        "entry_available", F.coalesce("__found", F.lit(False))
    ).drop("__found")


def valid_payloads(payloads: DataFrame) -> DataFrame:
    """Cached payloads that name their own entry and carry every required field.

    ``payloads`` holds ``requested_id`` beside the parsed fields; a row that
    fails is a cache miss, never an error.
    """
    return payloads.where(
        (F.lower("entry_id") == F.lower("requested_id"))
        & F.col("entry_available").isNotNull()
        & F.col("conditions").isNotNull()
        & F.col("metadata_source").isNotNull()
        & F.col("retrieved_at_utc").isNotNull()
        & F.col("entry_revision_date").isNotNull()
    )


def cache_coverage(requested: DataFrame, payloads: DataFrame) -> DataFrame:
    """One row of counts: requested, hits, available, not reported, and so on."""
    joined = requested.select(entry_id("entry_id").alias("entry_id")).distinct().join(
        payloads.select("entry_id", "entry_available", "condition_count"), "entry_id", "left"
    )
    hit = F.col("entry_available").isNotNull()
    there = F.coalesce(F.col("entry_available"), F.lit(False))
    return joined.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(hit).alias("cache_hits"),
        F.count_if(there & (F.col("condition_count") > 0)).alias("available"),
        F.count_if(there & (F.col("condition_count") == 0)).alias("not_reported"),
        F.count_if(hit & ~there).alias("entry_unavailable"),
        F.count_if(~hit).alias("not_fetched"),
    )
