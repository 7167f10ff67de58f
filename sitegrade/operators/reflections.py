"""Reflection columns: resolution range, coefficient identity, normalization."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade.functions.clean import finite

MAP_COLUMNS = ("fwt", "phwt", "delfwt", "phdelwt")
MODEL_COLUMNS = ("fc_all", "phic_all")


def complex_parts(amplitude: str | Column, degrees: str | Column) -> Column:
    """A coefficient from its amplitude and phase in degrees."""
    a = F.col(amplitude) if isinstance(amplitude, str) else amplitude
    p = F.radians(F.col(degrees) if isinstance(degrees, str) else degrees)
    return F.struct((a * F.cos(p)).alias("re"), (a * F.sin(p)).alias("im"))


def amplitude_and_phase(value: str) -> tuple[Column, Column]:
    """Amplitude and phase in degrees of a coefficient column; phase 0 for zero."""
    re, im = F.col(f"{value}.re"), F.col(f"{value}.im")
    size = F.hypot(re, im)
    return size, F.when(size == 0, F.lit(0.0)).otherwise(F.degrees(F.atan2(im, re)))


def _all_finite(names: tuple[str, ...]) -> Column:
    ok = F.lit(True)
    for name in names:
        ok = ok & finite(name).isNotNull()
    return ok


def resolution_range(reflections: DataFrame) -> DataFrame:
    """Low and high resolution limit per entry, over rows complete in all map columns."""
    usable = reflections.where(_all_finite((*MAP_COLUMNS, "d")) & (F.col("d") > 0))
    return usable.groupBy("entry_id").agg(
        F.max("d").alias("resolution_low"), F.min("d").alias("resolution_high")
    )


def resolution_limit(low: Column, high: Column, from_data: Column) -> Column:
    """The metadata limit when both ends are stated and it is positive, else the data's."""
    stated = F.coalesce(finite(low) != 0, F.lit(False))
    return F.coalesce(F.when(stated & (finite(high) > 0), finite(high)), from_data)


def centric_flags(reflections: DataFrame, operations: DataFrame) -> DataFrame:
    """Add ``centric``: whether some operation of the entry maps hkl to -hkl.

    Reflections meet only their own entry's crystal operations. The test runs
    on the distinct indices, and joins back without a shuffle of its own.
    """
    indices = reflections.select("entry_id", "h", "k", "l").distinct()
    ops = operations.where(~F.col("is_ncs")).select(
        "entry_id", *[f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)]
    )
    met = indices.join(ops, "entry_id")
    flipped = F.lit(True)
    for j, index in enumerate(("h", "k", "l"), start=1):
        moved = F.col("h") * F.col(f"r1{j}") + F.col("k") * F.col(f"r2{j}") + F.col("l") * F.col(f"r3{j}")
        flipped = flipped & (moved == -F.col(index))
    flags = met.groupBy("entry_id", "h", "k", "l").agg(F.bool_or(flipped).alias("centric"))
    return reflections.join(flags, ["entry_id", "h", "k", "l"], "left").withColumn(
        "centric", F.coalesce("centric", F.lit(False))
    )


def _size(re: Column, im: Column) -> Column:
    return F.hypot(re, im)


def coefficient_residual(reflections: DataFrame) -> DataFrame:
    """Per entry, the largest scale-relative gap of ``FWT - FC = 2 DELFWT``.

    The scale is at least one electron and at least every term, since the
    difference of two large coefficients cannot be more exact than they are.
    """
    usable = reflections.where(_all_finite((*MAP_COLUMNS, *MODEL_COLUMNS))).select(
        "entry_id",
        complex_parts("fwt", "phwt").alias("o"),
        complex_parts("fc_all", "phic_all").alias("c"),
        complex_parts("delfwt", "phdelwt").alias("e"),
    )
    terms = usable.selectExpr(
        "entry_id",
        "hypot(o.re - c.re - 2 * e.re, o.im - c.im - 2 * e.im) AS gap",
        "greatest(1D, hypot(o.re - c.re, o.im - c.im), hypot(2 * e.re, 2 * e.im),"
        " hypot(o.re, o.im), hypot(c.re, c.im)) AS scale",
    )
    return terms.groupBy("entry_id").agg(
        F.count(F.lit(1)).alias("usable_reflections"),
        F.max(F.col("gap") / F.col("scale")).alias("max_residual"),
    )


def normalize_coefficients(flagged: DataFrame) -> DataFrame:
    """Map coefficients in the convention of the density statistics.

    Acentric reflections keep ``FWT`` and take ``FWT - FC`` as the difference;
    centric ones use the mean of ``FWT`` and ``FC``. Needs ``centric``; rows
    without every coefficient pass unchanged.
    """
    complete = _all_finite((*MAP_COLUMNS, *MODEL_COLUMNS))
    parts = flagged.withColumns(
        {
            "o": F.when(complete, complex_parts("fwt", "phwt")),
            "c": F.when(complete, complex_parts("fc_all", "phic_all")),
        }
    )
    half = lambda part: (
        F.when(F.col("centric"), (F.col(f"o.{part}") + F.col(f"c.{part}")) / 2).otherwise(F.col(f"o.{part}"))
    )
    mapped = parts.withColumn("n", F.when(complete, F.struct(half("re").alias("re"), half("im").alias("im"))))
    mapped = mapped.withColumn(
        "d2",
        F.when(complete, F.struct((F.col("n.re") - F.col("c.re")).alias("re"),
                                  (F.col("n.im") - F.col("c.im")).alias("im"))),
    )
    size, phase = amplitude_and_phase("n")
    d_size, d_phase = amplitude_and_phase("d2")
    return mapped.withColumns(
        {
            "fwt": F.coalesce(size, F.col("fwt")),
            "phwt": F.coalesce(phase, F.col("phwt")),
            "delfwt": F.coalesce(d_size, F.col("delfwt")),
            "phdelwt": F.coalesce(d_phase, F.col("phdelwt")),
        }
    ).drop("o", "c", "n", "d2")


def missing_columns(reflections: DataFrame) -> list[str]:
    """Map coefficient columns a reflection table lacks."""
    return [c for c in MAP_COLUMNS if c not in reflections.columns]
