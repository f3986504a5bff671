"""Statistics per session and across sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def metric_series(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """count, mean, interpolated median, population deviation, least and largest of the finite values; zeros if there are none."""
    v = F.col(value).cast("double")
    good = F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")), v)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return df.groupBy(*keys).agg(
        F.count(good).alias("n"),
        zero(F.avg(good)).alias("mean"),
        zero(F.percentile(good, 0.5)).alias("median"),
        zero(F.stddev_pop(good)).alias("stddev"),
        zero(F.min(good)).alias("least"),
        zero(F.max(good)).alias("largest"),
    )


def z_scores(df: DataFrame, keys: Sequence[str], value: str, out: str = "z") -> DataFrame:
    """Every row with its z score; 0 where the value is missing or nothing varies."""
    w = Window.partitionBy(*keys)
    v = F.col(value).cast("double")
    sigma = F.stddev_pop(v).over(w)
    return df.withColumn(out, F.coalesce(F.when(sigma > 0, (v - F.avg(v).over(w)) / sigma), F.lit(0.0)))


def size_shares(df: DataFrame, keys: Sequence[str], value: str, edges: Sequence[float] = (50, 200, 500)) -> DataFrame:
    """Shares of rows up to each edge and beyond the last."""
    v, n = F.col(value), F.count("*")
    low, parts = None, []
    for e in edges:
        inside = v <= e if low is None else (v > low) & (v <= e)
        parts.append((F.count_if(inside) / n).alias(f"upto_{e:g}"))
        low = e
    return df.groupBy(*keys).agg(*parts, (F.count_if(v > low) / n).alias(f"over_{low:g}"))


def cohort_stats(df: DataFrame, cohort: Sequence[str], value: str) -> DataFrame:
    """Each session against its cohort: z score and percent rank."""
    scored = z_scores(df, cohort, value, "cohort_z")
    if not cohort:
        raise ValueError("a cohort needs a key")
    return scored.withColumn("cohort_rank", F.percent_rank().over(Window.partitionBy(*cohort).orderBy(value)))


def truncated_median(df: DataFrame, keys: Sequence[str], value: str, fallback: int) -> DataFrame:
    """Median cut to a whole number; a missing or zero one takes the fallback."""
    median = F.floor(F.percentile(F.col(value), 0.5))
    return df.groupBy(*keys).agg(F.coalesce(F.nullif(median, F.lit(0)), F.lit(fallback)).cast("long").alias("median"))
