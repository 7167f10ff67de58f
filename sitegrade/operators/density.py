"""Residue statistics joined to coordinate residues and metal sites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade.functions.clean import first_label
from sitegrade.functions.ids import split_chain_conformer
from sitegrade.operators.prefix import exact_median, ordinal_within


def residue_category(in_catalog: Column, metals: Column, chemical_sites: Column) -> Column:
    """cofactor, metal or blank: what kind of target a residue is."""
    return first_label(
        [
            (in_catalog, "cofactor"),
            ((metals > 0) & (chemical_sites == 1), "metal"),
            (metals > 0, "cofactor"),
        ],
        "",
    )


def component_class(in_cluster: Column, in_heme: Column, chemical_sites: Column) -> Column:
    """The structural class of the component that carries a metal."""
    return first_label(
        [(in_cluster, "cluster"), (in_heme, "heme"), (chemical_sites == 1, "ion")], "other"
    )


def resolve_rows(
    rows: DataFrame,
    residues: DataFrame,
    identity: Sequence[str],
    chain: Sequence[str],
    order: str,
    number: str,
) -> DataFrame:
    """Join statistics rows to coordinate residues by author identity.

    A repeated identity is settled by the row's ordinal within its chain.
    ``identity`` and ``chain`` are columns of both sides (``chain`` a part of
    ``identity``), ``order`` an integer position of the residues in their
    chain, ``number`` the ordinal the rows carry. Adds ``residue_pos`` and
    ``mapping_status``: matched, coordinate_residue_not_found or ambiguous.
    """
    placed = ordinal_within(residues, list(chain), order, "chain_ordinal")
    multiplicity = residues.groupBy(*identity).agg(F.count(F.lit(1)).alias("matches"))
    side = placed.select(*identity, F.col(order).alias("residue_pos"), "chain_ordinal")
    unique = side.join(multiplicity.where("matches = 1"), list(identity), "left_semi")
    joined = rows.join(multiplicity, list(identity), "left")
    lone = joined.where(F.coalesce("matches", F.lit(0)) <= 1).join(
        unique.drop("chain_ordinal"), list(identity), "left"
    )
    repeated = joined.where(F.col("matches") > 1).join(
        side.withColumnRenamed("chain_ordinal", number), [*identity, number], "left"
    )
    return lone.unionByName(repeated.select(*lone.columns)).withColumn(
        "mapping_status",
        F.when(F.col("matches").isNull(), F.lit("coordinate_residue_not_found"))
        .when(F.col("residue_pos").isNull(), F.lit("ambiguous"))
        .otherwise(F.lit("matched")),
    ).drop("matches")


def keep_selected_conformers(rows: DataFrame, label: str, selected: str) -> DataFrame:
    """Rows of the selected conformer, with a status for labels that cannot be right.

    ``label`` is the ``chain:conformer`` text of a row, ``selected`` its
    residue's conformer (null when the residue was not found).
    """
    _, conformer, invalid = split_chain_conformer(label)
    chosen = F.coalesce(F.col(selected), F.lit(""))
    problem = first_label(
        [
            (invalid, "invalid_label"),
            (F.col(selected).isNull() & (conformer != ""), "unmatched_conformer"),
            ((chosen == "") & (conformer != ""), "conformer_without_selection"),
        ],
        "",
    )
    keeps = F.when(chosen != "", conformer == chosen).otherwise(F.lit(True))
    return rows.withColumn("problem", problem).where(keeps | (F.col("problem") != ""))


def fan_out(observations: DataFrame, metals: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per metal of an observed residue, with the number that share it.

    An observation without a metal keeps one diagnostic row.
    """
    shares = metals.groupBy(*on).agg(F.count(F.lit(1)).alias("shares"))
    joined = observations.join(metals, list(on), "left").join(shares, list(on), "left")
    count = F.coalesce(F.col("shares"), F.lit(0))
    return joined.withColumns(
        {
            "density_shared_site_count": count,
            "density_is_shared": count > 1,
            "selected_metal_site_status": F.when(count > 0, F.lit("selected")).otherwise(
                F.lit("no_selected_metal")
            ),
        }
    ).drop("shares")


def identification_codes(mapping: Column, site_status: Column) -> Column:
    """Reason code of a statistics row that failed to join; null otherwise."""
    return F.when(
        mapping == "coordinate_residue_not_found", F.lit("cofactor_coordinate_join_failed")
    ).when(site_status == "no_selected_metal", F.lit("cofactor_without_selected_metal"))


def missing_multiset(expected: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys expected more often than observed, with the number missing."""
    wanted = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("wanted"))
    seen = observed.groupBy(*keys).agg(F.count(F.lit(1)).alias("seen"))
    gap = F.col("wanted") - F.coalesce(F.col("seen"), F.lit(0))
    return wanted.join(seen, list(keys), "left").where(gap > 0).select(
        *keys, gap.alias("missing")
    )


def without_statistics(sites: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Selected sites no statistics row reports."""
    return sites.join(rows.select(*keys), list(keys), "left_anti")


def density_lookup(
    sites: DataFrame,
    rows: DataFrame,
    site: Sequence[str],
    author: Sequence[str],
    values: Sequence[str],
) -> DataFrame:
    """Values of the site's own row, else of the only row with its author identity."""
    own = rows.where(F.col(site[0]).isNotNull()).select(
        *site, *[F.col(v).alias(f"own_{v}") for v in values], F.lit(True).alias("__own")
    )
    named = rows.groupBy(*author).agg(
        F.count(F.lit(1)).alias("rows"), *[F.max(v).alias(f"named_{v}") for v in values]
    ).where(F.col("rows") == 1).drop("rows")
    joined = sites.join(own, list(site), "left").join(named, list(author), "left")
    has_own = F.coalesce(F.col("__own"), F.lit(False))
    return joined.select(
        *sites.columns,
        *[
            F.when(has_own, F.col(f"own_{v}")).otherwise(F.col(f"named_{v}")).alias(v)
            for v in values
        ],
    )


#: Density-context groups: name -> condition over ``is_target`` and ``is_water``.
CONTEXT_GROUPS: Mapping[str, str] = {
    "ordinary": "NOT is_target",
    "ordinary_nonwater": "NOT is_target AND NOT is_water",
    "water": "NOT is_target AND is_water",
}


def density_context(rows: DataFrame, key: str = "entry_id", z: str = "zd_all") -> DataFrame:
    """Per entry, how the residues that are not targets fit the density.

    ``rows`` carries ``is_target``, ``is_water`` and the z-score ``z``. Counts
    and exact medians for three groups; fractions are null without a value.
    """
    measured = rows.withColumn("__abs", F.abs(z))
    aggregates = [
        F.count(F.lit(1)).alias("residue_count_all"),
        F.count_if("is_target").alias("target_residue_count"),
    ]
    for name, rule in CONTEXT_GROUPS.items():
        inside = F.expr(rule)
        value = F.when(inside, F.col("__abs"))
        aggregates += [
            F.count_if(inside).alias(f"{name}_residue_count"),
            F.count(value).alias(f"{name}_rszd_count"),
            F.count_if(value >= 3).alias(f"{name}_abs_rszd_ge_3_count"),
            F.count_if(value >= 6).alias(f"{name}_abs_rszd_ge_6_count"),
        ]
    context = measured.groupBy(key).agg(*aggregates)
    grouped = measured.select(
        key, "__abs",
        F.explode(
            F.array_compact(F.array(*[
                F.when(F.expr(rule), F.lit(name)) for name, rule in CONTEXT_GROUPS.items()
            ]))
        ).alias("__group"),
    )
    medians = exact_median(grouped, [key, "__group"], "__abs", "median")
    wide = medians.groupBy(key).agg(
        *[
            F.max(F.when(F.col("__group") == name, F.col("median"))).alias(
                f"{name}_median_abs_rszd"
            )
            for name in CONTEXT_GROUPS
        ]
    )
    joined = context.join(wide, key, "left")
    return joined.withColumns(
        {
            f"{name}_abs_rszd_ge_{cut}_fraction": F.try_divide(
                F.col(f"{name}_abs_rszd_ge_{cut}_count"), F.col(f"{name}_rszd_count")
            )
            for name in CONTEXT_GROUPS
            for cut in (3, 6)
        }
    )


def with_defaults(entries: DataFrame, rows: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Exactly one row per entry: the computed one, or the stated defaults."""
    joined = entries.select(key).join(rows, key, "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def append_site_fields(
    rows: DataFrame, summaries: DataFrame, keys: Sequence[str], explicit: str, inclusive: str
) -> DataFrame:
    """Statistics rows with their site summary; coverage falls back to the explicit scope."""
    return rows.join(summaries, list(keys), "left").withColumn(
        "geometry_coverage", F.coalesce(F.col(inclusive), F.col(explicit))
    )
