"""Reference lookups: exact key first, a coarser key when it misses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.sources.files import literature_rows

def literature(spark: SparkSession) -> DataFrame:
    """The bundled distances: ``residue, donor, metal, mu, sigma``."""
    lines = spark.createDataFrame(
        list(enumerate(vocab.literature_lines())), "position int, line string")
    rows, _ = literature_rows(lines)
    return rows


def residue_classes(spark: SparkSession, table: DataFrame | None = None) -> DataFrame:
    """One row per component: ``residue_name, residue_class`` (nucleotide or amino_acid).

    ``table`` is the class table of all components, named in upper case; the few
    bundled names only fill in what it lacks. A component of both classes is a
    nucleotide.
    """
    bundled = spark.createDataFrame(
        [(n, "nucleotide") for n in vocab.NUCLEOTIDES]
        + [(n, "amino_acid") for n in (*vocab.AMINO_ACIDS, *vocab.MODIFIED_AMINO_ACIDS)],
        "residue_name string, residue_class string")
    if table is None:
        return bundled
    told = table.groupBy("residue_name").agg(F.max("residue_class").alias("residue_class"))
    return told.unionByName(bundled.join(told, "residue_name", "left_anti"))


def longest_target(reference: DataFrame, keys: Sequence[str], value: str = "mu") -> DataFrame:
    """The largest reference value per coarse key."""
    return reference.groupBy(*keys).agg(F.max(value).alias("fallback_target"))


def lookup_with_fallback(
    df: DataFrame,
    reference: DataFrame,
    exact_on: Mapping[str, str],
    fallback_on: Mapping[str, str],
) -> DataFrame:
    """Left-join ``reference`` on its exact key and on a coarser one.

    ``exact_on`` and ``fallback_on`` map columns of ``df`` to key columns of the
    reference. Adds ``mu``, ``sigma`` (exact only), ``target`` and
    ``reference_kind``: ``exact``, ``element_fallback`` or ``missing``.
    """
    exact = reference.select(
        *[F.col(right).alias(f"__x_{left}") for left, right in exact_on.items()], "mu", "sigma"
    )
    coarse = longest_target(reference, list(fallback_on.values())).select(
        *[F.col(right).alias(f"__f_{left}") for left, right in fallback_on.items()],
        "fallback_target",
    )
    on_exact = [F.col(left) == F.col(f"__x_{left}") for left in exact_on]
    on_coarse = [F.col(left) == F.col(f"__f_{left}") for left in fallback_on]
    joined = df.join(exact, on_exact, "left").join(coarse, on_coarse, "left")
    return joined.withColumns(
        {
            "target": F.coalesce(F.col("mu"), F.col("fallback_target")),
            "reference_kind": F.when(F.col("mu").isNotNull(), F.lit("exact"))
            .when(F.col("fallback_target").isNotNull(), F.lit("element_fallback"))
            .otherwise(F.lit("missing")),
        }
    ).select(*df.columns, "mu", "sigma", "target", "reference_kind")
