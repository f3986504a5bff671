"""Temporal joins with an equality key for Spark: time is cut into buckets, so no pair of rows is compared in vain.

Columns of the right side come out with the prefix ``b_``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefixed(df: DataFrame, keys: Sequence[str], prefix: str = "b_") -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keys])


def first_match(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def same_or_missing(a: Column, b: Column) -> Column:
    """Equality with NULL and the empty string as wildcards."""
    blank = lambda c: c.isNull() | (c.cast("string") == "")
    return blank(a) | blank(b) | (a == b)


def overlaps(a0: Column, a1: Column, b0: Column, b1: Column, pad: int = 0) -> Column:
    """Closed overlap, padded on both sides."""
    return (a0 - pad <= b1) & (b0 <= a1 + pad)


def follow(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    within_ms: int,
    a_end: str = "end_ms",
    b_start: str = "start_ms",
    lead_ms: int = 0,
    condition: Column | None = None,
    bucketed: bool = True,
) -> DataFrame:
    """Pairs with ``-lead_ms <= b.start - a.end <= within_ms``: A, then B soon after.

    B falls into one bucket, A into the buckets that its window touches, two as a rule.  Without buckets the rows of a key
    meet as they are: for small groups that are partitioned by the key already, which then need no exchange.
    """
    width = within_ms + lead_ms + 1
    if not bucketed:
        lag = F.col(f"b_{b_start}") - F.col(a_end)
        pairs = a.join(prefixed(b, keys).hint("merge"), list(keys)).filter((lag >= -lead_ms) & (lag <= within_ms))
        return pairs if condition is None else pairs.filter(condition)
    low, high = F.col(a_end) - lead_ms, F.col(a_end) + within_ms
    left = a.withColumn("_bucket", F.explode(F.sequence(F.floor(low / width), F.floor(high / width))))
    right = prefixed(b, keys).withColumn("_bucket", F.floor(F.col(f"b_{b_start}") / width))
    lag = F.col(f"b_{b_start}") - F.col(a_end)
    pairs = left.join(right, [*keys, "_bucket"]).filter((lag >= -lead_ms) & (lag <= within_ms)).drop("_bucket")
    return pairs if condition is None else pairs.filter(condition)


def overlap(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    start: str = "start_ms",
    end: str = "end_ms",
    pad_ms: int = 0,
    width: int = 3_600_000,
    closed: bool = True,
    condition: Column | None = None,
    bucketed: bool = True,
) -> DataFrame:
    """Pairs of overlapping intervals; each pair is met once, in the bucket where the later one starts (without buckets: see ``follow``)."""
    if not bucketed:
        lo, hi, b0, b1 = F.col(start) - pad_ms, F.col(end) + pad_ms, F.col(f"b_{start}"), F.col(f"b_{end}")
        meets = ((lo <= b1) & (b0 <= hi)) if closed else ((lo < b1) & (b0 < hi))
        pairs = a.join(prefixed(b, keys).hint("merge"), list(keys)).filter(meets)
        return pairs if condition is None else pairs.filter(condition)
    buckets = lambda lo, hi: F.explode(F.sequence(F.floor(lo / width), F.floor(F.greatest(lo, hi) / width)))
    left = a.withColumn("_bucket", buckets(F.col(start) - pad_ms, F.col(end) + pad_ms))
    right = prefixed(b, keys).withColumn("_bucket", buckets(F.col(f"b_{start}"), F.col(f"b_{end}")))
    lo, hi, b0, b1 = F.col(start) - pad_ms, F.col(end) + pad_ms, F.col(f"b_{start}"), F.col(f"b_{end}")
    meets = ((lo <= b1) & (b0 <= hi)) if closed else ((lo < b1) & (b0 < hi))
    once = F.col("_bucket") == F.floor(F.greatest(lo, b0) / width)
    pairs = left.join(right, [*keys, "_bucket"]).filter(once & meets).drop("_bucket")
    return pairs if condition is None else pairs.filter(condition)


def contains(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str = "t_ms", start: str = "start_ms", end: str = "end_ms",
    half_open: bool = False, width: int = 3_600_000,
) -> DataFrame:
    """Pairs of a point and an interval that holds it (closed, or half-open)."""
    right = prefixed(intervals, keys).withColumn(
        "_bucket", F.explode(F.sequence(F.floor(F.col(f"b_{start}") / width), F.floor(F.greatest(f"b_{start}", f"b_{end}") / width)))
    )
    left = points.withColumn("_bucket", F.floor(F.col(at) / width))
    inside = (F.col(at) >= F.col(f"b_{start}")) & ((F.col(at) < F.col(f"b_{end}")) if half_open else (F.col(at) <= F.col(f"b_{end}")))
    return left.join(right, [*keys, "_bucket"]).filter(inside).drop("_bucket")


def nearest(
    a: DataFrame, b: DataFrame, keys: Sequence[str], row: Sequence[str], at: str = "t_ms", tol_ms: int = 90_000, order: str = "ord",
    strict: bool = True,
) -> DataFrame:
    """For each row of ``a`` (named by ``row``) the nearest row of ``b`` within ``tol_ms``; the earliest in ``order`` wins ties."""
    width = tol_ms + 1
    left = a.withColumn("_bucket", F.explode(F.sequence(F.floor((F.col(at) - tol_ms) / width), F.floor((F.col(at) + tol_ms) / width))))
    right = prefixed(b, keys).withColumn("_bucket", F.floor(F.col(f"b_{at}") / width))
    dist = F.abs(F.col(f"b_{at}") - F.col(at))
    pairs = left.join(right, [*keys, "_bucket"]).withColumn("distance_ms", dist)
    pairs = pairs.filter(F.col("distance_ms") < tol_ms if strict else F.col("distance_ms") <= tol_ms).drop("_bucket")
    return first_match(pairs, [*keys, *row], ["distance_ms", f"b_{order}"])


def where_met(a: DataFrame, b: DataFrame, keys: Sequence[str], condition: Column, met: bool = True) -> DataFrame:
    """Rows of ``a`` that some row of ``b`` (its columns prefixed with ``b_``) with the same key meets ``condition`` with, or none."""
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns]).hint("merge")
    same = condition
    for k in keys:
        same = (F.col(k) == F.col(f"b_{k}")) & same
    return a.join(right, same, "left_semi" if met else "left_anti")


def locate(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], row: Sequence[str], at: str = "t_ms",
    start: str = "start_ms", end: str = "end_ms", label: str = "section_id", order: str = "ord",
) -> DataFrame:
    """The first interval (by ``order``) that holds the point, else the one with the nearest edge (first by ``order`` on ties).

    Points and the edges of intervals are put into one order by time, where the last edge before a point and the next one
    are windows.  Edges are numbered in that order, and an interval holds the points between two numbers: it is laid on the
    few nodes of a segment tree that make up this range, a point on the nodes above it, one a level, and the first interval of each node is a
    window again.  So the work grows with rows times the logarithm of a session's intervals, however they overlap, and
    nothing is moved after the one exchange by ``keys``.
    """
    o = F.col(order)
    edge_of = lambda at, turn: F.struct(F.col(at).alias("at"), F.lit(turn).alias("turn"), F.col(start).alias("lo"), F.col(end).alias("hi"), o.alias("o"), F.col(label).alias("label"))
    edges = intervals.select(*keys, F.explode(F.array(edge_of(start, 0), edge_of(end, 2))).alias("e"))
    both = points.select(*keys, *row, F.col(at).alias("_at"), F.lit(1).alias("_turn"), F.lit(None).cast(edges.schema["e"].dataType).alias("_e"))
    both = both.unionByName(edges.select(*keys, F.col("e.at").alias("_at"), F.col("e.turn").alias("_turn"), F.col("e").alias("_e")), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_at", "_turn")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    edge = lambda sign: F.when(F.col("_turn") != 1, F.struct((sign * F.col("_at")).alias("k"), F.col("_e.o").alias("o"), F.col("_e.label").alias("label")))
    # the last edge is the least of the negated times; the next one is the last in the opposite order
    back = Window.partitionBy(*keys).orderBy(F.desc("_at"), F.desc("_turn")).rowsBetween(Window.unboundedPreceding, -1)
    number = F.count(F.when(F.col("_turn") != 1, 1)).over(past)
    seen = both.withColumns({"_number": number, "_before": F.min(edge(-1)).over(past), "_after": F.min(edge(1)).over(back)})
    spans = both.filter("_turn != 1").withColumn("_number", number).groupBy(*keys, "_e.lo", "_e.hi", "_e.o", "_e.label").agg(
        F.min(F.when(F.col("_turn") == 0, F.col("_number"))).alias("i"), F.min(F.when(F.col("_turn") == 2, F.col("_number"))).alias("j")
    ).filter("j > i")
    # of the nodes [a, b] of a level that lie in (i, j], those whose parents do not
    node = "named_struct('level', l, 'x', x)"
    first, last = "shiftright(i + shiftleft(1L, l), l)", "shiftright(j + 1, l) - 1"
    nodes = f"""flatten(transform(sequence(0, int(log2(j - i))), l -> transform(
        filter(array(if({first} % 2 = 1, {first}, null), if(({last}) % 2 = 0, {last}, null)), x -> x is not null and {first} <= {last}), x -> {node})))"""
    laid = spans.select(*keys, F.struct("o", "label").alias("_in"), F.inline(F.expr(nodes)))
    rows = seen.filter("_turn = 1").select(*keys, *row, "_at", "_number", "_before", "_after")
    levels = F.expr("transform(if(_number > 0, sequence(0, int(log2(_number))), array(0)), l -> named_struct('level', l, 'x', shiftright(_number, l)))")
    asked = rows.select(*keys, *row, "_at", "_before", "_after", F.inline(levels), F.lit(True).alias("_asks"))
    on_node = Window.partitionBy(*keys, "level", "x")
    held = laid.unionByName(asked, allowMissingColumns=True).withColumn("_in", F.min("_in").over(on_node)).filter("_asks")
    one = held.groupBy(*keys, *row).agg(F.min("_in").alias("_in"), *[F.first(c).alias(c) for c in ("_at", "_before", "_after")])
    near = F.array_min(F.filter(F.array(
        F.when(F.col("_before").isNotNull(), F.struct((F.col("_at") + F.col("_before.k")).alias("d"), F.col("_before.o").alias("o"), F.col("_before.label").alias("label"))),
        F.when(F.col("_after").isNotNull(), F.struct((F.col("_after.k") - F.col("_at")).alias("d"), F.col("_after.o").alias("o"), F.col("_after.label").alias("label"))),
    ), lambda x: x.isNotNull()))
    found = one.filter(F.col("_in").isNotNull() | F.col("_before").isNotNull() | F.col("_after").isNotNull())
    chosen = F.when(F.col("_in").isNotNull(), F.col("_in.label")).otherwise(near["label"])
    return found.select(*keys, *row, chosen.alias(label), F.col("_in").isNotNull().alias("contained"))


def exclude_between(
    pairs: DataFrame, blockers: DataFrame, keys: Sequence[str], row: Sequence[str], low: str, high: str, at: str = "t_ms", width: int = 3_600_000
) -> DataFrame:
    """Pairs without a blocking event strictly between ``low`` and ``high``."""
    spans = pairs.select(*keys, *row, F.col(low).alias("start_ms"), F.col(high).alias("end_ms"))
    hit = contains(blockers.select(*keys, at), spans, keys, at, width=width)
    hit = hit.filter((F.col(at) > F.col("b_start_ms")) & (F.col(at) < F.col("b_end_ms")))
    blocked = hit.select(*keys, *[F.col(f"b_{c}").alias(c) for c in row]).distinct()
    return pairs.join(blocked, [*keys, *row], "left_anti")
