"""Order-dependent operators that plain windows express: islands, episodes, bursts, runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def island_ids(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, gap_ms: int, rule: str = "last", same: Sequence[str] = ()
) -> DataFrame:
    """Adds ``island``: a row opens a new one if it starts more than ``gap_ms`` after the end of the row before it
    (``rule`` "last") or of all rows before it ("max"), or if a column of ``same`` changes (NULLs are equal)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(end).over(w) if rule == "last" else F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = before.isNull() | (F.col(start) - before > gap_ms)
    for c in same:
        opens = opens | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    return df.withColumn("_opens", F.when(opens, 1).otherwise(0)).withColumn("island", F.sum("_opens").over(w)).drop("_opens")


def episodes(
    df: DataFrame, when: Column, keys: Sequence[str], order: Sequence[str], start: str = "start_ms", end: str = "end_ms", gap_ms: int = 22_000,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Episodes of rows where ``when`` holds: span, number of hits and union length of the hits."""
    hits = island_ids(df.filter(when), keys, order, start, end, gap_ms)
    # what a hit adds to the union of those that start before it; hits of no length add nothing
    span = F.when(F.col(end) > F.col(start), F.col(end))
    before = F.max(span).over(Window.partitionBy(*keys, "island").orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1))
    hits = hits.withColumn("_adds", F.greatest(F.lit(0), span - F.greatest(F.col(start), before)))
    return hits.groupBy(*keys, "island").agg(
        F.min(start).alias("t0_ms"), F.max(end).alias("t1_ms"), F.count("*").alias("n_hits"), *extra, F.sum("_adds").cast("bigint").alias("union_ms")
    )


def bursts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], at: str = "t_ms", gap_ms: int = 3000, least: int = 3, same: Sequence[str] = ()
) -> DataFrame:
    """Runs of at least ``least`` events no more than ``gap_ms`` apart, with the upper median of their gaps."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = island_ids(df, keys, order, at, at, gap_ms, same=same).withColumn("_before", F.lag(at).over(w))
    step = F.when(F.row_number().over(Window.partitionBy(*keys, "island").orderBy(*order)) > 1, F.col(at) - F.col("_before"))
    grouped = rows.withColumn("_step", step).groupBy(*keys, "island").agg(
        F.min(at).alias("t0_ms"), F.max(at).alias("t1_ms"), F.count("*").alias("n_events"), F.array_sort(F.collect_list("_step")).alias("_steps")
    )
    middle = F.get(F.col("_steps"), F.floor(F.size("_steps") / 2).cast("int"))
    return grouped.filter(F.col("n_events") >= least).withColumn("median_gap_ms", middle).drop("_steps")


def coalesce_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], same: Sequence[str], start: str, end: str, gap_ms: int) -> DataFrame:
    """Merges a row with the row before it if ``same`` is equal and it starts within ``gap_ms`` of their running end."""
    w = Window.partitionBy(*keys).orderBy(*order)
    change = F.lit(False)
    for c in same:
        change = change | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    first = F.row_number().over(w) == 1
    runs = df.withColumn("_new", (first | change).cast("int")).withColumn("_run", F.sum("_new").over(w)).drop("_new")
    islands = island_ids(runs, [*keys, "_run"], order, start, end, gap_ms, rule="max")
    return islands.groupBy(*keys, "_run", "island", *same).agg(
        F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_rows")
    ).drop("_run", "island")


def looked_back(flag: Column, keys: Sequence[str], at: str, window_ms: int) -> Column:
    """Whether a flagged row lies at or before the row, at most ``window_ms`` earlier."""
    w = Window.partitionBy(*keys).orderBy(at).rangeBetween(-window_ms, 0)
    return F.coalesce(F.max(flag).over(w), F.lit(False))


def filled_clock(df: DataFrame, keys: Sequence[str], seq: str, start: str, duration: str) -> DataFrame:
    """Chunks without a clock take their start from the last clocked chunk before them plus the durations between,
    else from the first clocked chunk after them minus the durations between, else from zero by cumulated durations."""
    w = Window.partitionBy(*keys).orderBy(seq)
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    run = F.coalesce(F.sum(duration).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = df.withColumn("_run", run)
    offset = F.when(F.col(start).isNotNull(), F.col(start) - F.col("_run"))
    rows = rows.withColumn("_offset", offset)
    shift = F.coalesce(F.last("_offset", ignorenulls=True).over(before), F.first("_offset", ignorenulls=True).over(after), F.lit(0))
    return rows.withColumn("filled_start", F.col("_run") + shift).drop("_run", "_offset")
