"""Running totals and ordinals without a single-task window.

A window ordered over a whole key pulls that key into one task. Here the order
axis is cut into buckets; each bucket gets its own window, bucket totals get
theirs one level up, and so on. Every window partition holds at most one
bucket, so a key with a third of all rows still spreads over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bucket widths for integer positions.
POSITION_WIDTHS = (10_000, 10_000)
#: Bucket widths for three-decimal measurements: at most 1,001 values each.
METRIC_WIDTHS = (1, 1_000)


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    amount: str,
    out: str,
    widths: Sequence[int] = POSITION_WIDTHS,
) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over rows of the key ordered before this one.

    ``order`` is numeric and unique within ``keys``. ``widths`` are the bucket
    widths per level, the first in units of ``order``, the next in buckets of
    the level below.
    """
    bucket = "__bucket"
    cut = df.withColumn(bucket, F.floor(F.col(order) / F.lit(widths[0])).cast("long"))
    inner = Window.partitionBy(*keys, bucket).orderBy(order)
    before = F.coalesce(
        F.sum(amount).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    local = cut.withColumn("__local", before)
    totals = cut.groupBy(*keys, bucket).agg(F.sum(amount).alias("__total"))
    if len(widths) > 1:
        shifted = running_before(
            totals.withColumnRenamed(bucket, "__pos"), keys, "__pos", "__total",
            "__offset", widths[1:],
        ).withColumnRenamed("__pos", bucket)
    else:
        outer = Window.partitionBy(*keys).orderBy(bucket) if keys else Window.orderBy(bucket)
        shifted = totals.withColumn(
            "__offset",
            F.coalesce(
                F.sum("__total").over(outer.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
    offsets = shifted.select(*keys, bucket, "__offset")
    joined = local.join(offsets, [*keys, bucket], "left") if keys else local.join(
        offsets, bucket, "left"
    )
    return joined.withColumn(
        out, F.col("__local") + F.coalesce(F.col("__offset"), F.lit(0))
    ).select(*df.columns, out)


def ordinal_within(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str,
    widths: Sequence[int] = POSITION_WIDTHS,
) -> DataFrame:
    """Add a one-based ordinal of each row within ``keys``, ordered by a unique integer."""
    counted = running_before(
        df.withColumn("__one", F.lit(1).cast("long")), keys, order, "__one", "__rank", widths
    )
    return counted.withColumn(out, (F.col("__rank") + 1).cast("long")).select(*df.columns, out)


def segment_index(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    is_marker: str,
    out: str,
    widths: Sequence[int] = POSITION_WIDTHS,
) -> DataFrame:
    """Add the number of marker rows at or before each row."""
    flagged = df.withColumn("__flag", F.col(is_marker).cast("long"))
    counted = running_before(flagged, keys, order, "__flag", "__before", widths)
    return counted.withColumn(out, F.col("__before") + F.col("__flag")).select(*df.columns, out)


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    widths: Sequence[int] = METRIC_WIDTHS,
) -> DataFrame:
    """The exact median of a numeric column per key; ``keys`` must not be empty.

    Values are first counted per distinct value, which shrinks a hot key to its
    distinct measurements before anything is ordered.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("__value"))
        .agg(F.count(F.lit(1)).alias("__count"))
    )
    placed = running_before(counts, keys, "__value", "__count", "__below", widths)
    totals = counts.groupBy(*keys).agg(F.sum("__count").alias("__size"))
    sized = placed.join(totals, list(keys))
    upto = F.col("__below") + F.col("__count")
    low_pos = F.floor((F.col("__size") - 1) / 2)
    high_pos = F.floor(F.col("__size") / 2)
    covers_low = (F.col("__below") <= low_pos) & (low_pos < upto)
    covers_high = (F.col("__below") <= high_pos) & (high_pos < upto)
    return (
        sized.where(covers_low | covers_high)
        .groupBy(*keys)
        .agg(
            (
                (F.max(F.when(covers_low, F.col("__value"))) + F.max(F.when(covers_high, F.col("__value"))))
                / 2
            ).alias(out),
            F.max("__size").alias(f"{out}_count"),
        )
    )


def running_best(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    rank: str,
    out: str,
    width: int = POSITION_WIDTHS[0],
) -> DataFrame:
    """Add ``out``: the smallest ``rank`` among rows of the key ordered before this one.

    ``rank`` may be a struct that carries further fields of its row. The order
    axis is cut into buckets as in :func:`running_before`.
    """
    cut = df.withColumn("__bucket", F.floor(F.col(order) / F.lit(width)).cast("long"))
    inner = Window.partitionBy(*keys, "__bucket").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    outer = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = (
        cut.groupBy(*keys, "__bucket")
        .agg(F.min(rank).alias("__best"))
        .withColumn("__earlier", F.min("__best").over(outer))
        .select(*keys, "__bucket", "__earlier")
    )
    return (
        cut.withColumn("__local", F.min(rank).over(inner))
        .join(earlier, [*keys, "__bucket"], "left")
        .withColumn(out, F.least("__local", "__earlier"))
        .select(*df.columns, out)
    )
