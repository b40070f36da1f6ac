"""Gaps and islands, dilation and order checks: the building blocks of the detectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: str, mask: Column, aggregates: list[Column]) -> DataFrame:
    """Maximal runs of consecutive rows where ``mask`` holds: ``keys, start, stop`` (exclusive), ``length`` and aggregates.

    ``order`` must count rows without holes. A null mask is false. Two exchanges at most: the window's, which
    the aggregate's keys reuse.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    breaks = F.sum(F.when(F.coalesce(mask, F.lit(False)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = df.withColumn("__mask", F.coalesce(mask, F.lit(False))).withColumn("__island", breaks)
    spans = [F.min(order).cast("bigint").alias("start"), (F.max(order) + 1).cast("bigint").alias("stop"), F.count(F.lit(1)).alias("length")]
    return marked.where("__mask").groupBy(*keys, "__island").agg(*spans, *aggregates).drop("__island")


def dilate(mask: Column, keys: list[str], order: str, radius: int) -> Column:
    """The mask spread over ``radius`` rows before and after."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-radius, radius)
    return F.max(mask.cast("int")).over(w) == 1


def order_violations(df: DataFrame, keys: list[str], order: str, stamp: str) -> DataFrame:
    """Rows whose stamp is before that of the row read before them."""
    before = F.lag(stamp).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("previous_stamp_ns", before).where(F.col(stamp) < F.col("previous_stamp_ns")).select(*keys, order, "previous_stamp_ns", stamp)


def overlaps(df: DataFrame, keys: list[str], start: str, stop: str) -> DataFrame:
    """Spans that begin before the span sorted just before them has ended."""
    ended = F.lag(stop).over(Window.partitionBy(*keys).orderBy(start, stop))
    return df.withColumn("previous_stop", ended).where(F.col(start) < F.col("previous_stop"))
