"""Interval sets per session: merge, union, intersection, gaps, clipping, containment.

Times are long milliseconds.  Merging needs one sort per session: an interval opens a new island when it starts after the
running maximum of all earlier ends, which is exact because a new island begins after every earlier end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.operators.joins import overlap


def merge_intervals(
    df: DataFrame,
    keys: Sequence[str],
    start: str = "start_ms",
    end: str = "end_ms",
    tol: int = 0,
    strict: bool = False,
    extra: Sequence[Column] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """Islands of intervals whose gap is at most ``tol`` (below ``tol`` if ``strict``); ``extra`` aggregates are added.

    Rows of zero or negative length are kept only if ``tol`` merging is asked for (``tol`` > 0 or ``strict``); the half-open
    union drops them.
    """
    rows = df if tol or strict else df.filter(F.col(end) > F.col(start))
    w = Window.partitionBy(*keys).orderBy(start, end, *order)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.col(start) - before
    opens = F.when(before.isNull(), 1).when((apart >= tol) if strict else (apart > tol), 1).otherwise(0)
    marked = rows.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(w))
    return (
        marked.groupBy(*keys, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_rows"), *extra)
        .drop("_island")
    )


def union_length(df: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Length of the union of half-open intervals, and how many separate pieces it has."""
    merged = merge_intervals(df, keys, start, end)
    return merged.groupBy(*keys).agg(F.sum(F.col(end) - F.col(start)).alias("union_ms"), F.count("*").alias("n_pieces"))


def intersect_length(
    a: DataFrame, b: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms", width: int = 3_600_000
) -> DataFrame:
    """Length of the intersection of two unions.  Pieces of a union do not overlap, so pairwise overlaps add up."""
    pieces_a, pieces_b = (merge_intervals(x, keys, start, end).drop("n_rows") for x in (a, b))
    pairs = overlap(pieces_a, pieces_b, keys, start, end, width=width, closed=False)
    length = F.least(F.col(end), F.col(f"b_{end}")) - F.greatest(F.col(start), F.col(f"b_{start}"))
    return pairs.groupBy(*keys).agg(F.sum(length).alias("common_ms"))


def clip(
    intervals: DataFrame, frames: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms", width: int = 3_600_000
) -> DataFrame:
    """Each interval cut to every frame that it meets."""
    pairs = overlap(intervals, frames, keys, start, end, width=width, closed=False)
    return pairs.select(
        *keys,
        F.greatest(F.col(start), F.col(f"b_{start}")).alias(start),
        F.least(F.col(end), F.col(f"b_{end}")).alias(end),
    )


def gaps(
    merged: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms", min_gap: int = 2000, origin: int | None = None
) -> DataFrame:
    """Holes longer than ``min_gap`` between consecutive rows; with ``origin``, also a leading one."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.lag(end).over(w)
    previous = before if origin is None else F.coalesce(before, F.lit(origin))
    kind = F.when(before.isNull(), "before_recording").when(F.col(start) - previous < 60_000, "recording_gap").otherwise("unknown")
    rows = merged.withColumn("gap_start", previous).withColumn("gap_end", F.col(start)).withColumn("gap_kind", kind)
    return rows.filter(F.col("gap_end") - F.col("gap_start") > min_gap).select(*keys, "gap_start", "gap_end", "gap_kind")


def missing_runs(df: DataFrame, keys: Sequence[str], seq: str, expected: Column | None = None) -> DataFrame:
    """Runs of sequence numbers that are absent between the least and the largest one (or ``expected``)."""
    top = F.max(seq) if expected is None else F.greatest(F.max(seq), F.max(expected))
    span = df.groupBy(*keys).agg(F.min(seq).alias("_lo"), top.alias("_hi"))
    wanted = span.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(seq))
    absent = wanted.join(df.select(*keys, seq).distinct(), [*keys, seq], "left_anti")
    w = Window.partitionBy(*keys).orderBy(seq)
    return (
        absent.withColumn("_run", F.col(seq) - F.row_number().over(w))
        .groupBy(*keys, "_run")
        .agg(F.min(seq).alias("first_missing"), F.max(seq).alias("last_missing"), F.count("*").alias("n_missing"))
        .drop("_run")
    )


def exclude_contained(
    a: DataFrame, b: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms"
) -> DataFrame:
    """Rows of ``a`` that lie in no single interval of ``b``.

    An interval of ``b`` that holds the row is found among those that start no later: the largest end so far decides, so
    one sorted window replaces the range join.
    """
    both = a.withColumn("_b_end", F.lit(None).cast("long")).withColumn("_is_a", F.lit(1)).unionByName(
        b.select(*keys, F.col(start), F.col(end).alias("_b_end")).withColumn("_is_a", F.lit(0)), allowMissingColumns=True
    )
    w = Window.partitionBy(*keys).orderBy(start, "_is_a").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max("_b_end").over(w)
    return both.withColumn("_reach", reach).filter((F.col("_is_a") == 1) & ~F.coalesce(F.col("_reach") >= F.col(end), F.lit(False))).select(a.columns)
