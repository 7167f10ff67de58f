"""Ranks of arriving values from an index of value intervals, built once.

The axis of three-decimal values is cut into a fixed number of intervals:
32 thousandths wide at first, then a 1/512 of the value. For every interval the
index holds how many observations lie below it and the few distinct values
inside it, so a value is ranked by one equi-join on its interval, whether or not
the distribution knows the value, and nothing is sorted or summed again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegrade.functions.clean import finite
from sitegrade.functions.rounding import REFERENCE_PLACES, with_rounded
from sitegrade.operators.distribution import COMPONENTS

_FINE_BITS, _SMALL_BITS, _MANTISSA_BITS = 5, 15, 9
#: Intervals of the whole axis: equal ones below 2**15 thousandths, then 512 for each doubling.
INTERVALS = (1 << (_SMALL_BITS - _FINE_BITS)) + (63 - _SMALL_BITS) * (1 << _MANTISSA_BITS)


def interval_of(milli: Column) -> Column:
    """The interval of a value in thousandths, not negative."""
    exponent = F.length(F.bin(milli)) - 1
    top = F.call_function("shiftright", milli, exponent - _MANTISSA_BITS).bitwiseAND((1 << _MANTISSA_BITS) - 1)
    coarse = (1 << (_SMALL_BITS - _FINE_BITS)) + (exponent - _SMALL_BITS) * (1 << _MANTISSA_BITS) + top
    return F.when(milli < (1 << _SMALL_BITS), F.shiftright(milli, _FINE_BITS)).otherwise(coarse).cast("int")


def thousandths(value: Column) -> Column:
    """A value rounded to three decimals as a whole number."""
    return F.round(value * 1000).cast("long")


def interval_index(distribution: DataFrame) -> DataFrame:
    """(component, interval, below, held, size) of every interval of every component.

    ``below`` counts the observations of lower intervals, ``held`` lists the
    interval's own values with their counts, ``size`` counts all. A component
    has ``INTERVALS`` rows whatever the data, so one window sums each.
    """
    spark = distribution.sparkSession
    placed = distribution.withColumn("milli", thousandths(F.col("value")))
    filled = placed.withColumn("interval", interval_of(F.col("milli"))).groupBy("component", "interval").agg(
        F.sum("count").alias("inside"),
        F.array_sort(F.collect_list(F.struct("milli", "count"))).alias("held"))
    sizes = distribution.groupBy("component").agg(F.sum("count").alias("size"))
    every = sizes.withColumn("interval", F.explode(F.sequence(F.lit(0), F.lit(INTERVALS - 1))))
    before = Window.partitionBy("component").orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)
    return every.join(filled, ["component", "interval"], "left").select(
        "component", "interval", F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("below"),
        F.coalesce("held", F.array().cast("array<struct<milli:bigint,count:bigint>>")).alias("held"), "size")


def rank_by_interval(
    inputs: DataFrame, index: DataFrame, components: Mapping[str, str] = COMPONENTS
) -> DataFrame:
    """Add ``<component>_rank`` per component: the score of ``distribution.rank_against``."""
    ranked = with_rounded(inputs, {
        f"__{name}_value": (F.when(F.col(column) >= 0, finite(column)), REFERENCE_PLACES)
        for name, column in components.items()})
    for name in components:
        milli = F.col("__milli")
        side = index.where(F.col("component") == name).select(
            F.col("interval").alias("__interval"), "below", "held", "size")
        ranked = ranked.withColumn("__milli", thousandths(F.col(f"__{name}_value"))).withColumn(
            "__interval", interval_of(milli)).join(side, "__interval", "left")

        def counted(kept: Column) -> Column:
            return F.aggregate(kept, F.lit(0).cast("long"), lambda total, v: total + v["count"])

        below = F.col("below") + counted(F.filter("held", lambda v: v["milli"] < milli))
        equal = counted(F.filter("held", lambda v: v["milli"] == milli))
        ranked = ranked.withColumn(f"{name}_rank", F.when(
            F.col("size") > 0, 100.0 * (F.col("size") - below - 0.5 * equal) / F.col("size"))
        ).drop("__milli", "__interval", "below", "held", "size", f"__{name}_value")
    return ranked
