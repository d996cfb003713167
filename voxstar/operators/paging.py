"""Page caps and totals of a captured search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def page_totals(pages: DataFrame, window: list[str], count: str = "result_count") -> DataFrame:
    """Results per search window."""
    return pages.groupBy(*window).agg(F.sum(count).alias("total"), F.count(F.lit(1)).alias("pages"))


def cap_pages(pages: DataFrame, window: list[str], page: str, max_count: int,
              count: str = "result_count", stride: int = 4096) -> DataFrame:
    """Pages a capture would keep: those fetched while fewer than ``max_count`` results had arrived.

    The running total is taken in two steps so that a window with very many
    pages is not sorted by one task: totals per stretch of ``stride`` page
    numbers, their running sum, then the running sum inside each stretch.
    Stretches that start at or past the cap are dropped before the second step.
    ``page`` must be unique within a window.
    """
    value = F.coalesce(F.col(count), F.lit(0))
    staged = pages.withColumn("_stretch", F.floor(F.col(page) / F.lit(stride)))
    before = Window.partitionBy(*window).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = (staged.groupBy(*window, "_stretch").agg(F.sum(value).alias("_sum"))
              .withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
              .filter(F.col("_start") < max_count)
              .drop("_sum"))
    inside = (Window.partitionBy(*window, "_stretch").orderBy(page)
              .rowsBetween(Window.unboundedPreceding, -1))
    seen = F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return (staged.join(starts, [*window, "_stretch"])
            .withColumn("fetched_before", seen)
            .filter((F.col("fetched_before") < max_count) & (value > 0))
            .drop("_stretch", "_start"))


def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    """The first ``n`` rows of an order; give a unique last order column."""
    return df.orderBy(*order).limit(n)
