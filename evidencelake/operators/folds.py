"""Sequential operators whose state depends on earlier decisions.

Each folds a time-sorted array of the few rows of a session that take part (pastes, seeds, findings) with built-in higher-order
functions, so the work stays in the JVM and is spread by session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def listed(df: DataFrame, keys: Sequence[str], fields: Sequence[str | Column], out: str) -> DataFrame:
    """One sorted array of structs per session; the first fields decide the order."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def fold(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str | Column], init: Column, merge: Callable[[Column, Column], Column], out: str,
    finish: Callable[[Column], Column] | None = None,
) -> DataFrame:
    rows = listed(df, keys, fields, "_rows")
    done = F.aggregate("_rows", init, merge, finish) if finish else F.aggregate("_rows", init, merge)
    return rows.select(*keys, done.alias(out))


def cluster_by_largest(
    df: DataFrame, keys: Sequence[str], at: str = "t_ms", end: str = "end_ms", order: str = "ord", size: str = "chars", group: str = "element", gap_ms: int = 5000
) -> DataFrame:
    """A row joins the open cluster if it starts within ``gap_ms`` of its end and its group equals the group of the cluster's
    largest row (NULL equals anything); the largest row, first on ties, represents the cluster."""
    kind = f"struct<t0:bigint,t1:bigint,n:bigint,total:bigint,best_size:bigint,best_group:{dict(df.dtypes)[group]}>"
    init = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("open"))
    fields = [F.col(at).cast("bigint").alias("t"), F.col(order).alias("o"), F.col(end).cast("bigint").alias("e"), F.col(size).cast("bigint").alias("s"), F.col(group).alias("g")]

    def merge(acc: Column, x: Column) -> Column:
        cur = acc["open"]
        near = cur.isNotNull() & (x["t"] - cur["t1"] <= gap_ms)
        alike = x["g"].isNull() | cur["best_group"].isNull() | (x["g"] == cur["best_group"])
        joins = F.coalesce(near & alike, F.lit(False))
        larger = x["s"] > cur["best_size"]
        grown = F.struct(
            cur["t0"].alias("t0"), F.greatest(cur["t1"], x["e"]).alias("t1"), (cur["n"] + 1).alias("n"), (cur["total"] + x["s"]).alias("total"),
            F.when(larger, x["s"]).otherwise(cur["best_size"]).alias("best_size"), F.when(larger, x["g"]).otherwise(cur["best_group"]).alias("best_group"),
        )
        fresh = F.struct(x["t"].alias("t0"), x["e"].alias("t1"), F.lit(1).cast("bigint").alias("n"), x["s"].alias("total"), x["s"].alias("best_size"), x["g"].alias("best_group"))
        done = F.when(joins | cur.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(cur)))
        return F.struct(done.alias("done"), F.when(joins, grown).otherwise(fresh).alias("open"))

    closed = fold(df, keys, fields, init, merge, "clusters", lambda acc: F.concat(acc["done"], F.array(acc["open"])))
    return closed.select(*keys, F.explode("clusters").alias("c")).select(*keys, "c.*")


def greedy_pairs(
    a: DataFrame, b: DataFrame, keys: Sequence[str], eligible: Callable[[Column, Column], Column], cost: Callable[[Column, Column], Column],
    a_fields: Sequence[str], b_fields: Sequence[str], a_id: str, b_id: str, reach: Callable[[DataFrame], tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Each row of ``a``, in the order of ``a_fields``, takes the unused eligible row of ``b`` with the least cost, first on ties.

    ``reach`` gives the least and largest first field of ``b`` that a row of ``a`` can pair with.  Sessions are then cut where no
    window is open, as no decision before such a place touches one behind it, and each piece is folded by itself; taken
    rows leave the list of free ones.
    """
    types = dict(a.dtypes) | {f"b_{k}": v for k, v in b.dtypes}
    pair = f"struct<a:{types[a_id]},b:{types[f'b_{b_id}']}>"
    by = list(keys)
    if reach:
        low, high = reach(a)
        place = lambda df, lo, hi, side: df.withColumns({"_lo": lo, "_hi": hi, "_side": F.lit(side)})
        at = F.col(b_fields[0])
        both = place(a, low, high, 0).unionByName(place(b, at, at, 1), allowMissingColumns=True)
        w = Window.partitionBy(*keys).orderBy("_lo", "_side")
        opens = F.coalesce(F.col("_lo") > F.max("_hi").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
        both = both.withColumn("_opens", opens.cast("int")).withColumn("_piece", F.sum("_opens").over(w)).withColumnRenamed("_side", "_which")
        by = [*by, "_piece"]
    else:
        both = a.withColumn("_which", F.lit(0)).unionByName(b.withColumn("_which", F.lit(1)), allowMissingColumns=True)
    rows = lambda side, fields: F.array_sort(F.collect_list(F.when(F.col("_which") == side, F.struct(*fields))))
    both = both.groupBy(*by).agg(rows(0, a_fields).alias("_a"), rows(1, b_fields).alias("_b")).filter((F.size("_a") > 0) & (F.size("_b") > 0))
    init = F.struct(F.array().cast(f"array<{pair}>").alias("pairs"), F.col("_b").alias("free"))

    def merge(acc: Column, x: Column) -> Column:
        near = F.filter(acc["free"], lambda y: F.coalesce(eligible(x, y), F.lit(False)))
        best = F.array_min(F.transform(near, lambda y, i: F.struct(cost(x, y).alias("c"), i.alias("i"), y[b_id].alias("b"))))
        taken = F.struct(x[a_id].alias("a"), best["b"].alias("b"))
        rest = F.filter(acc["free"], lambda y: y[b_id] != best["b"])
        return F.when(best.isNull(), acc).otherwise(F.struct(F.concat(acc["pairs"], F.array(taken)).alias("pairs"), rest.alias("free")))

    done = both.select(*keys, F.explode(F.aggregate("_a", init, merge, lambda acc: acc["pairs"])).alias("p"))
    return done.select(*keys, F.col("p.a").alias(a_id), F.col("p.b").alias(f"b_{b_id}"))


def next_unused(a: DataFrame, b: DataFrame, keys: Sequence[str], at: str = "t_ms", order: str = "ord") -> DataFrame:
    """Each row of ``a`` takes the next row of ``b`` that is strictly later and unused (blur and focus).

    Which rows of ``a`` go without is known from a queue: a later row of ``b`` serves the rows of ``a`` in their order, one each.  So
    the number waiting is a running count with a floor at zero, and the n-th served row of ``a`` gets the n-th serving row of ``b``.
    """
    both = a.select(*keys, F.col(at).alias("_t"), F.col(order).alias("_o"), F.lit(1).alias("_step")).unionByName(
        b.select(*keys, F.col(at).alias("_t"), F.col(order).alias("_o"), F.lit(-1).alias("_step"))
    )
    w = Window.partitionBy(*keys).orderBy("_t", "_step", "_o").rowsBetween(Window.unboundedPreceding, 0)
    run = both.filter(F.col("_t").isNotNull()).withColumn("_sum", F.sum("_step").over(w))
    # a row of b that finds nobody waiting lowers the floor and serves nobody
    floor = run.withColumn("_floor", F.least(F.lit(0), F.min("_sum").over(w)))
    w0 = Window.partitionBy(*keys).orderBy("_t", "_step", "_o")
    served = floor.withColumn("_idle", (F.col("_step") == -1) & (F.col("_floor") < F.coalesce(F.lag("_floor").over(w0), F.lit(0)))).filter(~F.col("_idle"))
    number = F.row_number().over(Window.partitionBy(*keys, "_step").orderBy("_t", "_o"))
    ranked = served.withColumn("_n", number)
    first = ranked.groupBy(*keys, "_n").agg(
        F.max(F.when(F.col("_step") == 1, F.col("_o"))).alias(order), F.max(F.when(F.col("_step") == -1, F.col("_o"))).alias(f"b_{order}")
    )
    return first.filter(F.col(order).isNotNull() & F.col(f"b_{order}").isNotNull()).select(*keys, order, f"b_{order}")


def capped_clusters(
    df: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms", order: str = "ord", gap_ms: int = 30_000, span_ms: int = 90_000
) -> DataFrame:
    """A row joins the open cluster if it starts within ``gap_ms`` of its end and the whole span stays within ``span_ms``."""
    kind = "struct<t0:bigint,t1:bigint,n:bigint>"
    init = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("open"))
    fields = [F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e"), F.col(order).alias("o")]

    def merge(acc: Column, x: Column) -> Column:
        cur = acc["open"]
        end_ = F.greatest(cur["t1"], x["e"])
        joins = F.coalesce((x["s"] - cur["t1"] <= gap_ms) & (end_ - cur["t0"] <= span_ms), F.lit(False))
        grown = F.struct(cur["t0"].alias("t0"), end_.alias("t1"), (cur["n"] + 1).alias("n"))
        fresh = F.struct(x["s"].alias("t0"), x["e"].alias("t1"), F.lit(1).cast("bigint").alias("n"))
        done = F.when(joins | cur.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(cur)))
        return F.struct(done.alias("done"), F.when(joins, grown).otherwise(fresh).alias("open"))

    closed = fold(df, keys, fields, init, merge, "clusters", lambda acc: F.concat(acc["done"], F.array(acc["open"])))
    return closed.select(*keys, F.explode("clusters").alias("c")).select(*keys, "c.*")


def greedy_budget(
    df: DataFrame, keys: Sequence[str], score: str, cost: str, order: str, budget: float, most: int
) -> DataFrame:
    """By falling score, rows are taken unless they push the total cost past ``budget``; ``most`` rows at the end."""
    kind = f"struct<rank:int,id:{dict(df.dtypes)[order]}>"
    init = F.struct(F.array().cast(f"array<{kind}>").alias("taken"), F.lit(0.0).alias("total"))
    fields = [(-F.col(score)).alias("s"), F.col(order).alias("o"), F.col(cost).cast("double").alias("c")]

    def merge(acc: Column, x: Column) -> Column:
        fits = (acc["total"] + x["c"] <= budget) & (F.size(acc["taken"]) < most)
        row = F.struct((F.size(acc["taken"]) + 1).alias("rank"), x["o"].alias("id"))
        return F.when(fits, F.struct(F.concat(acc["taken"], F.array(row)).alias("taken"), (acc["total"] + x["c"]).alias("total"))).otherwise(acc)

    done = fold(df, keys, fields, init, merge, "taken", lambda acc: acc["taken"])
    return done.select(*keys, F.explode("taken").alias("t")).select(*keys, F.col("t.rank").alias("rank"), F.col("t.id").alias(order))
