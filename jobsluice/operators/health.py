"""Health of sources by window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def health(events: DataFrame, window: Column, source: str, failed: Column, value: str, **most: Column) -> DataFrame:
    """Per window start and source: rows, share of failures, median and 95th percentile of a value, and maxima ``most``.

    Equal values are counted before the shuffle. The percentiles, linear between neighbours, are read off the counts
    in the order of the values, which Spark sorts and spills: no task holds the values of a group. Null sources and
    windows are groups; null values have no place in the percentiles.
    """
    counts = events.groupBy(window.alias("start"), source, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"), F.count_if(failed).alias("_f"), *[F.max(c).alias(name) for name, c in most.items()])
    group = Window.partitionBy("start", source)
    real = F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0)
    upto = F.sum(real).over(group.orderBy(F.col("_v").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_upto", upto).withColumn("_n", F.sum(real).over(group))

    def percentile(p: float) -> Column:
        place = (F.col("_n") - 1) * p
        low, high = (F.min(F.when(F.col("_upto") > end(place), F.col("_v"))) for end in (F.floor, F.ceil))
        return F.round(low + (high - low) * F.max(place - F.floor(place)), 6)

    return placed.groupBy("start", source).agg(
        F.sum("_c").alias("n"),
        F.round(F.sum("_f") / F.sum("_c"), 6).alias("error_share"),
        percentile(0.5).alias("p50"),
        percentile(0.95).alias("p95"),
        *[F.max(name).alias(name) for name in most],
    )
