"""Temporal joins, statistics, top-k and sequential operators over binding E."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from evidencelake.operators import folds, stats
from evidencelake.operators.joins import contains, exclude_between, first_match, follow, locate, nearest, overlap, same_or_missing
from evidencelake.plans.registry import HOUR, N, events, of_kind, query, spans, table


@query("""+ s AS (SELECT sk, k % 4 AS section_id, min(t_ms) AS start_ms, min(t_ms) + 40 * 3600000 AS end_ms, min(ord) AS ord FROM ev WHERE kind = 'signup' GROUP BY sk, k % 4),
    p AS (SELECT e.sk, e.ord, s.section_id, e.t_ms BETWEEN s.start_ms AND s.end_ms AS inside, s.ord AS so,
        CASE WHEN e.t_ms BETWEEN s.start_ms AND s.end_ms THEN 0 ELSE least(abs(e.t_ms - s.start_ms), abs(e.t_ms - s.end_ms)) END AS edge FROM ev e JOIN s USING (sk) WHERE e.kind = 'purchase')
    SELECT sk, ord, arg_min(section_id, (CASE WHEN inside THEN 0 ELSE 1 END, edge, so)) AS section_id, bool_or(inside) AS contained FROM p GROUP BY sk, ord""")
def j1_locate_section(spark, sf_dir):
    rows = events(spark, sf_dir)
    sections = of_kind(rows, "signup").groupBy("sk", (F.col("k") % 4).alias("section_id")).agg(
        F.min("t_ms").alias("start_ms"), (F.min("t_ms") + 40 * HOUR).alias("end_ms"), F.min("ord").alias("ord")
    )
    return locate(of_kind(rows, "purchase").select("sk", "ord", "t_ms"), sections, ["sk"], ["ord"])


@query("""SELECT e.sk, e.ord, arg_min(a.ord, (a.start_ms, a.ord)) AS chunk_ord, min(CASE WHEN a.ord IS NOT NULL THEN 1 ELSE 0 END) AS attributed,
    e.t_ms - arg_min(a.start_ms, (a.start_ms, a.ord)) AS local_ms FROM ev e LEFT JOIN iv a ON e.sk = a.sk AND a.kind = 'view' AND e.t_ms BETWEEN a.start_ms AND a.end_ms WHERE e.kind = 'error' GROUP BY e.sk, e.ord, e.t_ms""")
def j2_event_to_chunk(spark, sf_dir):
    rows = spans(spark, sf_dir)
    points = of_kind(rows, "error").select("sk", "ord", "t_ms")
    hits = contains(points, of_kind(rows, "view").select("sk", "ord", "start_ms", "end_ms"), ["sk"], width=24 * HOUR)
    best = first_match(hits, ["sk", "ord"], ["b_start_ms", "b_ord"]).select("sk", "ord", F.col("b_ord").alias("chunk_ord"), "b_start_ms")
    joined = points.join(best, ["sk", "ord"], "left")
    attributed = F.col("chunk_ord").isNotNull().cast("int")
    return joined.select("sk", "ord", "chunk_ord", attributed.alias("attributed"), (F.col("t_ms") - F.col("b_start_ms")).alias("local_ms"))


@query("""+ a AS (SELECT sk, ord, k % 4 AS sec, t_ms FROM ev WHERE kind = 'signup'), b AS (SELECT sk, ord, k % 4 AS sec, t_ms FROM ev WHERE kind = 'error')
    SELECT a.sk, a.ord, a.t_ms AS start_ms, coalesce(min(b.t_ms), a.t_ms) AS end_ms FROM a LEFT JOIN b ON a.sk = b.sk AND a.sec = b.sec AND b.t_ms >= a.t_ms GROUP BY a.sk, a.ord, a.t_ms""")
def j3_section_end(spark, sf_dir):
    """As-of forward: the first end at or after each start, by one window over both."""
    rows = of_kind(events(spark, sf_dir), "signup", "error").withColumn("sec", F.col("k") % 4)
    later = Window.partitionBy("sk", "sec").orderBy("t_ms").rangeBetween(0, Window.unboundedFollowing)
    end = F.min(F.when(F.col("kind") == "error", F.col("t_ms"))).over(later)
    return of_kind(rows.withColumn("end_ms", F.coalesce(end, "t_ms")), "signup").select("sk", "ord", F.col("t_ms").alias("start_ms"), "end_ms")


QWIN = """q AS (SELECT sk, ord, k % 3 AS sec, k % 10 AS qn, t_ms - CAST(floor(value * 360000) AS BIGINT) AS start_ms, t_ms AS end_ms FROM ev WHERE kind = 'click' AND value > 0)"""


def question_windows(spark, sf_dir):
    length = F.floor(F.col("value") * 360_000).cast("bigint")
    rows = of_kind(events(spark, sf_dir), "click").filter("value > 0")
    return rows.select("sk", "ord", (F.col("k") % 3).alias("sec"), (F.col("k") % 10).alias("qn"), (F.col("t_ms") - length).alias("start_ms"), F.col("t_ms").alias("end_ms"))


@query(f"""+ {QWIN} SELECT e.sk, e.ord, arg_min(q.qn, (q.start_ms, q.ord)) AS qn FROM ev e JOIN q ON e.sk = q.sk AND e.k % 3 = q.sec AND e.t_ms >= q.start_ms AND e.t_ms < q.end_ms
    WHERE e.kind = 'purchase' GROUP BY e.sk, e.ord""")
def j4_fact_to_question(spark, sf_dir):
    facts = of_kind(events(spark, sf_dir), "purchase").withColumn("sec", F.col("k") % 3).select("sk", "sec", "ord", "t_ms")
    hits = contains(facts, question_windows(spark, sf_dir), ["sk", "sec"], half_open=True, width=12 * HOUR)
    return first_match(hits, ["sk", "ord"], ["b_start_ms", "b_ord"]).select("sk", "ord", F.col("b_qn").alias("qn"))


@query(f"""+ {QWIN} SELECT e.sk, e.ord, arg_min(q.qn, (q.sec, q.qn, q.ord)) AS qn FROM (SELECT *, CASE WHEN k % 2 = 0 THEN k % 3 END AS sec FROM ev WHERE kind = 'error') e
    JOIN q ON e.sk = q.sk AND (e.sec IS NULL OR e.sec = q.sec) AND e.t_ms >= q.start_ms AND e.t_ms < q.end_ms GROUP BY e.sk, e.ord""")
def j5_time_to_question(spark, sf_dir):
    points = of_kind(events(spark, sf_dir), "error").withColumn("sec", F.when(F.col("k") % 2 == 0, F.col("k") % 3)).select("sk", "ord", "t_ms", "sec")
    hits = contains(points, question_windows(spark, sf_dir), ["sk"], half_open=True, width=12 * HOUR).filter(same_or_missing(F.col("sec"), F.col("b_sec")))
    return first_match(hits, ["sk", "ord"], ["b_sec", "b_qn", "b_ord"]).select("sk", "ord", F.col("b_qn").alias("qn"))


@query(f"""SELECT a.sk, a.ord, b.ord AS b_ord, b.t_ms - a.t_ms AS lag_ms FROM ev a JOIN ev b ON a.sk = b.sk AND a.kind = 'error' AND b.kind = 'purchase' AND b.t_ms - a.t_ms BETWEEN 0 AND {N}""")
def j6_follow_pairs(spark, sf_dir):
    rows = events(spark, sf_dir).filter("t_ms is not null").select("sk", "ord", "kind", "t_ms")
    pairs = follow(of_kind(rows, "error"), of_kind(rows, "purchase"), ["sk"], N, a_end="t_ms", b_start="t_ms")
    return pairs.select("sk", "ord", "b_ord", (F.col("b_t_ms") - F.col("t_ms")).alias("lag_ms"))


@query(f"""SELECT a.sk, a.ord, b.ord AS b_ord FROM iv a JOIN iv b ON a.sk = b.sk AND a.kind = 'error' AND b.kind = 'signup' AND a.start_ms - {HOUR} <= b.end_ms AND b.start_ms <= a.end_ms + {HOUR}""")
def j7_padded_overlap(spark, sf_dir):
    rows = spans(spark, sf_dir).select("sk", "ord", "kind", "start_ms", "end_ms")
    return overlap(of_kind(rows, "error"), of_kind(rows, "signup"), ["sk"], pad_ms=HOUR, width=24 * HOUR).select("sk", "ord", "b_ord")


@query(f"""SELECT a.sk, a.ord, b.ord AS b_ord, c.ord AS c_ord FROM ev a JOIN ev b ON a.sk = b.sk AND a.kind = 'view' AND b.kind = 'signup' AND b.t_ms - a.t_ms BETWEEN 0 AND {2 * N}
    JOIN ev c ON b.sk = c.sk AND c.kind = 'click' AND c.t_ms - b.t_ms BETWEEN 0 AND {2 * N}""")
def j8_triple(spark, sf_dir):
    rows = events(spark, sf_dir).select("sk", "ord", "kind", "t_ms")
    ab = follow(of_kind(rows, "view"), of_kind(rows, "signup"), ["sk"], 2 * N, a_end="t_ms", b_start="t_ms")
    ab = ab.select("sk", F.col("ord").alias("a_ord"), F.col("b_ord").alias("mid"), F.col("b_t_ms").alias("t_ms"))
    return follow(ab, of_kind(rows, "click"), ["sk"], 2 * N, a_end="t_ms", b_start="t_ms").select(
        "sk", F.col("a_ord").alias("ord"), F.col("mid").alias("b_ord"), F.col("b_ord").alias("c_ord")
    )


@query(f"""SELECT a.sk, a.ord, b.ord AS b_ord FROM ev a JOIN ev b ON a.sk = b.sk AND a.kind = 'view' AND b.kind = 'click' AND b.t_ms - a.t_ms BETWEEN 0 AND {3 * N}
    WHERE NOT EXISTS (SELECT 1 FROM ev x WHERE x.sk = a.sk AND x.kind = 'error' AND x.t_ms > a.t_ms AND x.t_ms < b.t_ms)""")
def j9_no_event_between(spark, sf_dir):
    rows = events(spark, sf_dir).select("sk", "ord", "kind", "t_ms")
    pairs = follow(of_kind(rows, "view"), of_kind(rows, "click"), ["sk"], 3 * N, a_end="t_ms", b_start="t_ms")
    return exclude_between(pairs, of_kind(rows, "error"), ["sk"], ["ord", "b_ord"], "t_ms", "b_t_ms", width=12 * HOUR).select("sk", "ord", "b_ord")


@query(f"""+ {QWIN} SELECT sk, ord FROM q WHERE NOT EXISTS (SELECT 1 FROM ev p WHERE p.sk = q.sk AND p.kind = 'purchase' AND p.t_ms BETWEEN q.start_ms AND q.end_ms)""")
def j10_no_paste_in_window(spark, sf_dir):
    windows = question_windows(spark, sf_dir)
    pastes = of_kind(events(spark, sf_dir), "purchase").select("sk", "t_ms")
    hit = contains(pastes, windows, ["sk"], width=12 * HOUR).select("sk", F.col("b_ord").alias("ord")).distinct()
    return windows.join(hit, ["sk", "ord"], "left_anti").select("sk", "ord")


@query("""+ w AS (SELECT DISTINCT sk, k FROM ev WHERE kind = 'click'), a AS (SELECT sk, k, arg_max(value, ord) AS v FROM ev WHERE kind = 'view' GROUP BY sk, k),
    s AS (SELECT sk, k, arg_max(value, ord) AS v FROM ev WHERE kind = 'purchase' GROUP BY sk, k)
    SELECT w.sk, w.k, coalesce(s.v, a.v) AS outcome, CASE WHEN s.v IS NOT NULL THEN 'submission' WHEN a.v IS NOT NULL THEN 'attempt' ELSE 'none' END AS origin
    FROM w LEFT JOIN a ON w.sk = a.sk AND w.k IS NOT DISTINCT FROM a.k LEFT JOIN s ON w.sk = s.sk AND w.k IS NOT DISTINCT FROM s.k""")
def j11_question_outcome(spark, sf_dir):
    rows = events(spark, sf_dir)
    last = lambda kind, out: of_kind(rows, kind).groupBy(F.col("sk"), F.col("k")).agg(F.max_by("value", "ord").alias(out))
    joined = of_kind(rows, "click").select("sk", "k").distinct().join(last("view", "a"), ["sk", "k"], "left").join(last("purchase", "s"), ["sk", "k"], "left")
    origin = F.when(F.col("s").isNotNull(), "submission").when(F.col("a").isNotNull(), "attempt").otherwise("none")
    return joined.select("sk", "k", F.coalesce("s", "a").alias("outcome"), origin.alias("origin"))


@query("""SELECT sk, k, arg_max(kind, ord) AS last_kind, arg_min(kind, ord) AS first_kind FROM ev GROUP BY sk, k""")
def j12_first_and_last(spark, sf_dir):
    return events(spark, sf_dir).groupBy("sk", "k").agg(F.max_by("kind", "ord").alias("last_kind"), F.min_by("kind", "ord").alias("first_kind"))


@query("""+ v AS (SELECT sk, ord, t_ms FROM ev WHERE kind = 'error'), f AS (SELECT sk, ord, t_ms FROM ev WHERE kind = 'signup')
    SELECT sk, ord, b_ord, distance_ms FROM (SELECT f.sk, f.ord, v.ord AS b_ord, abs(v.t_ms - f.t_ms) AS distance_ms,
        row_number() OVER (PARTITION BY f.sk, f.ord ORDER BY abs(v.t_ms - f.t_ms), v.ord) AS r FROM f JOIN v ON f.sk = v.sk AND abs(v.t_ms - f.t_ms) < 90000000) WHERE r = 1""")
def j15_nearest_violation(spark, sf_dir):
    rows = events(spark, sf_dir).select("sk", "ord", "kind", "t_ms")
    near = nearest(of_kind(rows, "signup"), of_kind(rows, "error"), ["sk"], ["ord"], tol_ms=25 * HOUR)
    return near.select("sk", "ord", "b_ord", "distance_ms")


@query("""+ l AS (SELECT doc_id, 'quality' AS path, CAST(quality AS VARCHAR) AS actual FROM labels UNION ALL SELECT doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM labels),
    c AS (SELECT d.doc_id, p.path, CAST(d.doc_id % 2 AS VARCHAR) AS cited FROM documents d, (VALUES ('quality'), ('toxic')) p(path))
    SELECT c.doc_id, count(*) AS n_cited, CAST(count_if(actual IS NULL) AS BIGINT) AS n_missing, CAST(coalesce(count_if(actual = cited), 0) AS BIGINT) AS n_valid FROM c LEFT JOIN l USING (doc_id, path) GROUP BY c.doc_id""")
def j16_citations(spark, sf_dir):
    """Cited values against long-form observations, re-aggregated per signal."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic"))
    actual = labels.unpivot(["doc_id"], ["quality", "toxic"], "path", "actual")
    paths = F.explode(F.array(F.lit("quality"), F.lit("toxic")))
    cited = table(spark, sf_dir, "documents").select("doc_id", paths.alias("path"), (F.col("doc_id") % 2).cast("string").alias("cited"))
    return cited.join(actual, ["doc_id", "path"], "left").groupBy("doc_id").agg(
        F.count("*").alias("n_cited"), F.count_if(F.col("actual").isNull()).alias("n_missing"), F.count_if(F.col("actual") == F.col("cited")).alias("n_valid")
    )


@query("""+ p AS (SELECT a.sk, a.ord, b.ord AS b_ord, b.kind, b.t_ms FROM ev a JOIN ev b ON a.sk = b.sk AND a.kind = 'signup' AND b.kind IN ('error', 'purchase') AND abs(a.t_ms - b.t_ms) <= 54000000),
    r AS (SELECT *, row_number() OVER (PARTITION BY sk, ord ORDER BY t_ms, b_ord) AS n FROM p) SELECT sk, ord, count(*) AS n_facts, count(DISTINCT kind) AS n_kinds FROM r WHERE n <= 8 GROUP BY sk, ord""")
def j18_facts_near_story(spark, sf_dir):
    rows = events(spark, sf_dir).select("sk", "ord", "kind", "t_ms").withColumn("start_ms", F.col("t_ms")).withColumn("end_ms", F.col("t_ms"))
    pairs = overlap(of_kind(rows, "signup"), of_kind(rows, "error", "purchase"), ["sk"], pad_ms=15 * HOUR, width=24 * HOUR)
    w = Window.partitionBy("sk", "ord").orderBy("b_t_ms", "b_ord")
    top = pairs.withColumn("n", F.row_number().over(w)).filter("n <= 8")
    return top.groupBy("sk", "ord").agg(F.count("*").alias("n_facts"), F.count_distinct("b_kind").alias("n_kinds"))


@query("""+ p AS (SELECT e.sk, e.ord, c.ord AS c_ord, greatest(e.start_ms, c.start_ms) - c.start_ms AS seek_ms, least(e.end_ms, c.end_ms) - c.start_ms AS stop_ms FROM iv e JOIN iv c ON e.sk = c.sk AND e.kind = 'signup' AND c.kind = 'view'
    AND e.start_ms <= c.end_ms AND c.start_ms <= greatest(e.end_ms, e.start_ms + 1)) SELECT sk, ord, count(*) AS n_segments, CAST(sum(stop_ms - seek_ms) AS BIGINT) AS clip_ms FROM p GROUP BY sk, ord""")
def j19_clip_segments(spark, sf_dir):
    rows = spans(spark, sf_dir).select("sk", "ord", "kind", "start_ms", "end_ms")
    asked = of_kind(rows, "signup").withColumn("real_end", F.col("end_ms")).withColumn("end_ms", F.greatest("end_ms", F.col("start_ms") + 1))
    pairs = overlap(asked, of_kind(rows, "view"), ["sk"], width=24 * HOUR)
    seek = F.greatest("start_ms", "b_start_ms") - F.col("b_start_ms")
    stop = F.least("real_end", "b_end_ms") - F.col("b_start_ms")
    return pairs.groupBy("sk", "ord").agg(F.count("*").alias("n_segments"), F.sum(stop - seek).alias("clip_ms"))


@query("""+ g AS (SELECT k AS sig, ord, t_ms, sk FROM ev WHERE kind = 'signup'), f AS (SELECT sk, k % 10 AS kk, min(t_ms) AS a, max(t_ms) + 1000 AS b FROM ev WHERE kind = 'purchase' GROUP BY sk, k % 10)
    SELECT g.sk, g.ord, least(g.t_ms, coalesce(f.a, g.t_ms)) AS start_ms, greatest(g.t_ms, coalesce(f.b, g.t_ms)) AS end_ms FROM g LEFT JOIN f ON g.sk = f.sk AND g.sig % 10 = f.kk""")
def j20_signal_span(spark, sf_dir):
    rows = events(spark, sf_dir)
    facts = of_kind(rows, "purchase").groupBy("sk", (F.col("k") % 10).alias("kk")).agg(F.min("t_ms").alias("a"), (F.max("t_ms") + 1000).alias("b"))
    joined = of_kind(rows, "signup").withColumn("kk", F.col("k") % 10).join(facts, ["sk", "kk"], "left")
    return joined.select("sk", "ord", F.least("t_ms", F.coalesce("a", "t_ms")).alias("start_ms"), F.greatest("t_ms", F.coalesce("b", "t_ms")).alias("end_ms"))


@query("""+ c AS (SELECT sk, ord, t_ms FROM ev WHERE kind = 'view'), r AS (SELECT ord, value FROM ev WHERE kind = 'view' AND k % 3 <> 0)
    SELECT c.sk, count(*) AS n_chunks, count(r.ord) AS n_covered, CAST(count_if(r.ord IS NULL) AS BIGINT) AS n_holes, count(r.ord) / count(*)::DOUBLE AS ratio FROM c LEFT JOIN r USING (ord) GROUP BY c.sk""")
def j21_coverage_holes(spark, sf_dir):
    rows = of_kind(events(spark, sf_dir), "view")
    stored = rows.filter("k % 3 <> 0").select("ord", F.col("value").alias("answer"), F.lit(1).alias("hit"))
    joined = rows.select("sk", "ord").join(stored, "ord", "left")
    n, covered = F.count("*"), F.count("hit")
    return joined.groupBy("sk").agg(n.alias("n_chunks"), covered.alias("n_covered"), (n - covered).alias("n_holes"), (covered / n).alias("ratio"))


@query("""+ e AS (SELECT * FROM iv WHERE kind = 'signup') SELECT e.sk, e.ord, count(DISTINCT w.ord) FILTER (w.kind = 'view') AS n_windows, coalesce(bool_or(w.kind = 'error'), false) AS has_gaze,
    max(CASE w.kind WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 ELSE 0 END) AS lane_rank FROM e JOIN iv w ON e.sk = w.sk AND e.start_ms <= w.end_ms AND w.start_ms <= e.end_ms AND w.kind <> 'signup' GROUP BY e.sk, e.ord""")
def j22_episode_context(spark, sf_dir):
    rows = spans(spark, sf_dir).select("sk", "ord", "kind", "start_ms", "end_ms")
    pairs = overlap(of_kind(rows, "signup"), rows.filter("kind <> 'signup'"), ["sk"], width=24 * HOUR)
    rank = F.when(F.col("b_kind") == "purchase", 2).when(F.col("b_kind") == "click", 1).otherwise(0)
    return pairs.groupBy("sk", "ord").agg(
        F.count_distinct(F.when(F.col("b_kind") == "view", F.col("b_ord"))).alias("n_windows"),
        F.bool_or(F.col("b_kind") == "error").alias("has_gaze"), F.max(rank).alias("lane_rank"),
    )


# statistics


@query("""SELECT sk, kind, count(*) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, round(stddev_pop(value), 6) AS stddev, min(value) AS least, max(value) AS largest FROM ev GROUP BY sk, kind""")
def a1_metric_series(spark, sf_dir):
    out = stats.metric_series(events(spark, sf_dir), ["sk", "kind"], "value")
    return out.select("sk", "kind", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "stddev")], "least", "largest")


@query("""+ z AS (SELECT sk, ord, (value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0) AS z FROM ev WINDOW w AS (PARTITION BY sk, kind)) SELECT sk, ord, round(coalesce(z, 0), 6) AS z FROM z""")
def a1_z_scores(spark, sf_dir):
    return stats.z_scores(events(spark, sf_dir), ["sk", "kind"], "value").select("sk", "ord", F.round("z", 6).alias("z"))


@query("""SELECT sk, count_if(value <= 50) / count(*)::DOUBLE AS upto_50, count_if(value > 50 AND value <= 200) / count(*)::DOUBLE AS upto_200,
    count_if(value > 200 AND value <= 500) / count(*)::DOUBLE AS upto_500, count_if(value > 500) / count(*)::DOUBLE AS over_500 FROM ev WHERE kind = 'purchase' GROUP BY sk""")
def a2_size_histogram(spark, sf_dir):
    return stats.size_shares(of_kind(events(spark, sf_dir), "purchase"), ["sk"], "value")


@query("""+ g AS (SELECT *, t_ms - lag(t_ms) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS gap FROM ev)
    SELECT sk, count(*) AS n_facts, CAST(count_if(kind = 'purchase') AS BIGINT) AS n_pastes, CAST(count_if(kind = 'click' AND k % 2 = 1) AS BIGINT) AS n_corrections, max(t_ms) - min(t_ms) AS span_ms,
    round(count_if(kind = 'purchase') / ((max(t_ms) - min(t_ms)) / 60000.0::DOUBLE), 9) AS pastes_per_minute, round(1 / (1 + stddev_pop(gap) / avg(gap)), 6) AS cadence FROM g GROUP BY sk""")
def a3_session_metrics(spark, sf_dir):
    w = Window.partitionBy("sk").orderBy("t_ms", "ord")
    rows = events(spark, sf_dir).withColumn("gap", F.col("t_ms") - F.lag("t_ms").over(w))
    pastes, span = F.count_if(F.col("kind") == "purchase"), F.max("t_ms") - F.min("t_ms")
    return rows.groupBy("sk").agg(
        F.count("*").alias("n_facts"), pastes.alias("n_pastes"), F.count_if((F.col("kind") == "click") & (F.col("k") % 2 == 1)).alias("n_corrections"),
        span.alias("span_ms"), F.round(pastes / (span / 60000.0), 9).alias("pastes_per_minute"),
        F.round(1 / (1 + F.stddev_pop("gap") / F.avg("gap")), 6).alias("cadence"),
    )


@query("""SELECT sk, k % 10 AS q, CAST(count_if(kind = 'purchase') AS BIGINT) AS pastes, CAST(count_if(kind = 'click') AS BIGINT) AS corrections FROM ev GROUP BY sk, k % 10""")
def a4_counts_by_question(spark, sf_dir):
    return events(spark, sf_dir).groupBy("sk", (F.col("k") % 10).alias("q")).agg(
        F.count_if(F.col("kind") == "purchase").alias("pastes"), F.count_if(F.col("kind") == "click").alias("corrections")
    )


@query("""+ s AS (SELECT sk, k % 4 AS sec, min(t_ms) AS t0 FROM ev WHERE kind = 'signup' GROUP BY 1, 2), d AS (SELECT sk, k % 4 AS sec, arg_min(t_ms, ord) AS t1 FROM ev WHERE kind = 'purchase' GROUP BY 1, 2)
    SELECT s.sk, s.sec, t1 - t0 AS latency_ms FROM s JOIN d ON s.sk = d.sk AND s.sec = d.sec""")
def a5_section_latency(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("sec", F.col("k") % 4)
    opened = of_kind(rows, "signup").groupBy("sk", "sec").agg(F.min("t_ms").alias("t0"))
    done = of_kind(rows, "purchase").groupBy("sk", "sec").agg(F.min_by("t_ms", "ord").alias("t1"))
    return opened.join(done, ["sk", "sec"]).select("sk", "sec", (F.col("t1") - F.col("t0")).alias("latency_ms"))


@query("""SELECT sk, count(*) AS total, CAST(count_if(value >= 10) AS BIGINT) AS available, count_if(value >= 10) / count(*)::DOUBLE AS ratio FROM ev WHERE kind = 'view' GROUP BY sk""")
def a6_coverage(spark, sf_dir):
    good = F.count_if(F.col("value") >= 10)
    return of_kind(events(spark, sf_dir), "view").groupBy("sk").agg(F.count("*").alias("total"), good.alias("available"), (good / F.count("*")).alias("ratio"))


@query("""SELECT sk, kind, CASE WHEN kind IN ('purchase') THEN 'paste' WHEN kind IN ('error') THEN 'focus' WHEN kind = 'click' AND k % 2 = 0 THEN 'mcq' ELSE 'other' END AS category, count(*) AS n FROM ev GROUP BY 1, 2, 3""")
def a7_fact_summary(spark, sf_dir):
    category = F.when(F.col("kind") == "purchase", "paste").when(F.col("kind") == "error", "focus").when((F.col("kind") == "click") & (F.col("k") % 2 == 0), "mcq").otherwise("other")
    return events(spark, sf_dir).groupBy("sk", "kind", category.alias("category")).agg(F.count("*").alias("n"))


@query("""SELECT sk, k % 4 AS section_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM iv WHERE kind = 'view' GROUP BY 1, 2""")
def a8_sections_from_artifacts(spark, sf_dir):
    return of_kind(spans(spark, sf_dir), "view").groupBy("sk", (F.col("k") % 4).alias("section_id")).agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))


@query("""SELECT sk, coalesce(nullif(CAST(floor(quantile_cont(end_ms - start_ms, 0.5)) AS BIGINT), 0), 60000) AS median FROM iv GROUP BY sk""")
def a9_truncated_median(spark, sf_dir):
    rows = spans(spark, sf_dir).withColumn("len", F.col("end_ms") - F.col("start_ms"))
    return stats.truncated_median(rows, ["sk"], "len", 60_000)


@query("""SELECT sk, count(*) AS n_events, CAST(count_if(kind = 'view') AS BIGINT) AS n_video, min(t_ms) AS first_ms, max(t_ms) AS last_ms,
    CASE WHEN count_if(kind = 'signup') = 0 THEN 'no_sections' WHEN count_if(kind = 'view') = 0 THEN 'no_video' ELSE 'ok' END AS issue FROM ev GROUP BY sk""")
def a10_sync_report(spark, sf_dir):
    views, signups = F.count_if(F.col("kind") == "view"), F.count_if(F.col("kind") == "signup")
    issue = F.when(signups == 0, "no_sections").when(views == 0, "no_video").otherwise("ok")
    return events(spark, sf_dir).groupBy("sk").agg(
        F.count("*").alias("n_events"), views.alias("n_video"), F.min("t_ms").alias("first_ms"), F.max("t_ms").alias("last_ms"), issue.alias("issue")
    )


@query("""+ r AS (SELECT sk, k, ord, CASE WHEN value < 20 THEN 'UNKNOWN' ELSE kind END AS leaf, value FROM ev)
    SELECT sk, k, coalesce(arg_min(leaf, ord) FILTER (leaf <> 'UNKNOWN'), 'UNKNOWN') AS leaf, max(value) AS confidence FROM r GROUP BY sk, k""")
def a11_merge_window_rows(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("leaf", F.when(F.col("value") < 20, "UNKNOWN").otherwise(F.col("kind")))
    first = F.min_by("leaf", F.when(F.col("leaf") != "UNKNOWN", F.col("ord")))
    known = F.count_if(F.col("leaf") != "UNKNOWN")
    return rows.groupBy("sk", "k").agg(F.when(known > 0, first).otherwise("UNKNOWN").alias("leaf"), F.max("value").alias("confidence"))


@query("""+ m AS (SELECT sk, sk % 5 AS cohort, CAST(count_if(kind = 'purchase') AS BIGINT) AS pastes FROM ev GROUP BY sk),
    z AS (SELECT *, (pastes - avg(pastes) OVER w) / nullif(stddev_pop(pastes) OVER w, 0) AS z, percent_rank() OVER (PARTITION BY cohort ORDER BY pastes) AS cohort_rank FROM m WINDOW w AS (PARTITION BY cohort))
    SELECT sk, cohort, pastes, round(coalesce(z, 0), 6) AS cohort_z, cohort_rank FROM z""")
def a14_cohort(spark, sf_dir):
    per = events(spark, sf_dir).groupBy("sk").agg(F.count_if(F.col("kind") == "purchase").alias("pastes")).withColumn("cohort", F.col("sk") % 5)
    return stats.cohort_stats(per, ["cohort"], "pastes").select("sk", "cohort", "pastes", F.round("cohort_z", 6).alias("cohort_z"), "cohort_rank")


@query("""SELECT sk, coalesce(avg(CASE WHEN (value >= 20)::INT + (k % 2 = 0)::INT + (kind <> 'view')::INT >= 2 THEN 1 ELSE 0 END), 1.0::DOUBLE) AS informative FROM ev GROUP BY sk""")
def a15_informative_ratio(spark, sf_dir):
    known = (F.col("value") >= 20).cast("int") + (F.col("k") % 2 == 0).cast("int") + (F.col("kind") != "view").cast("int")
    return events(spark, sf_dir).groupBy("sk").agg(F.coalesce(F.avg(F.when(known >= 2, 1).otherwise(0)), F.lit(1.0)).alias("informative"))


@query("""+ s AS (SELECT sk, sum(CASE WHEN value >= 80 THEN 3200 WHEN value >= 50 THEN 1800 ELSE 900 END * CASE kind WHEN 'error' THEN 100 WHEN 'purchase' THEN 60 ELSE 0 END) AS pts FROM ev GROUP BY sk)
    SELECT sk, CAST(least(900000, pts) AS BIGINT) AS points, CASE WHEN pts >= 560000 THEN 'high' WHEN pts >= 260000 THEN 'review' ELSE 'low' END AS band FROM s""")
def a16_composite_score(spark, sf_dir):
    """``a16_composite_score_whole`` has the sum before the cap, too."""
    return composite_score(events(spark, sf_dir)).drop("uncapped")


@query("""+ s AS (SELECT sk, sum(CASE WHEN value >= 80 THEN 3200 WHEN value >= 50 THEN 1800 ELSE 900 END * CASE kind WHEN 'error' THEN 100 WHEN 'purchase' THEN 60 ELSE 0 END) AS pts FROM ev GROUP BY sk)
    SELECT sk, CAST(least(900000, pts) AS BIGINT) AS points, CASE WHEN pts >= 560000 THEN 'high' WHEN pts >= 260000 THEN 'review' ELSE 'low' END AS band, CAST(pts AS BIGINT) AS uncapped FROM s""")
def a16_composite_score_whole(spark, sf_dir):
    return composite_score(events(spark, sf_dir))


def composite_score(rows):
    """Severity points times weight in whole ten-thousandths, capped at 90, with its band and the sum before the cap."""
    points = F.when(F.col("value") >= 80, 3200).when(F.col("value") >= 50, 1800).otherwise(900)
    weight = F.when(F.col("kind") == "error", 100).when(F.col("kind") == "purchase", 60).otherwise(0)
    total = F.sum(points * weight)
    band = F.when(total >= 560_000, "high").when(total >= 260_000, "review").otherwise("low")
    return rows.groupBy("sk").agg(F.least(F.lit(900_000), total).cast("bigint").alias("points"), band.alias("band"), total.cast("bigint").alias("uncapped"))


@query("""SELECT kind, count(DISTINCT k) AS n_types, array_to_string(list(DISTINCT k % 7 ORDER BY k % 7), ',') AS types FROM ev WHERE k IS NOT NULL GROUP BY kind""")
def a18_source_summary(spark, sf_dir):
    types = F.array_join(F.array_sort(F.collect_set(F.col("k") % 7)).cast("array<string>"), ",")
    return events(spark, sf_dir).filter("k is not null").groupBy("kind").agg(F.count_distinct("k").alias("n_types"), types.alias("types"))


@query("""SELECT sk, count(DISTINCT k) AS n_chunks FROM ev WHERE kind = 'view' GROUP BY sk""")
def a20_distinct_chunks(spark, sf_dir):
    return of_kind(events(spark, sf_dir), "view").groupBy("sk").agg(F.count_distinct("k").alias("n_chunks"))


@query("""SELECT sk, kind || ' x' || count(*) AS said, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS chars FROM ev GROUP BY sk, kind""")
def a21_narrative_counts(spark, sf_dir):
    return events(spark, sf_dir).groupBy("sk", "kind").agg(F.count("*").alias("n"), F.sum(F.floor("value")).alias("chars")).select(
        "sk", F.concat_ws(" x", "kind", F.col("n").cast("string")).alias("said"), "chars"
    )


# top-k and sequential operators


@query("""SELECT sk, ord FROM ev QUALIFY row_number() OVER (PARTITION BY sk ORDER BY t_ms, ord) <= 50""")
def k2_first_events(spark, sf_dir):
    w = Window.partitionBy("sk").orderBy("t_ms", "ord")
    return events(spark, sf_dir).withColumn("n", F.row_number().over(w)).filter("n <= 50").select("sk", "ord")


@query("""SELECT sk, kind, ord FROM iv QUALIFY row_number() OVER (PARTITION BY sk, kind, start_ms // 86400000, end_ms // 86400000 ORDER BY value DESC, ord) = 1""")
def k4_entry_dedup(spark, sf_dir):
    day = lambda c: F.floor(F.col(c) / (24 * HOUR))
    rows = spans(spark, sf_dir).withColumn("a", day("start_ms")).withColumn("b", day("end_ms"))
    return first_match(rows, ["sk", "kind", "a", "b"], [F.desc("value"), "ord"]).select("sk", "kind", "ord")


@query("""+ e AS (SELECT sk, k, count(DISTINCT kind) AS modalities, max(t_ms) - min(t_ms) AS span, min(t_ms) AS t0 FROM ev GROUP BY sk, k),
    r AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY modalities DESC, span DESC, t0) AS n FROM e)
    SELECT sk, t0, modalities, row_number() OVER (PARTITION BY sk ORDER BY t0) AS ep FROM r WHERE n <= 10""")
def k5_top_episodes(spark, sf_dir):
    per = events(spark, sf_dir).groupBy("sk", "k").agg(
        F.count_distinct("kind").alias("modalities"), (F.max("t_ms") - F.min("t_ms")).alias("span"), F.min("t_ms").alias("t0")
    )
    w = Window.partitionBy("sk").orderBy(F.desc("modalities"), F.desc("span"), "t0")
    top = per.withColumn("n", F.row_number().over(w)).filter("n <= 10")
    return top.select("sk", "t0", "modalities", F.row_number().over(Window.partitionBy("sk").orderBy("t0")).cast("bigint").alias("ep"))


@query("""+ r AS (SELECT sk, ord, floor(value) + 1 AS cost, row_number() OVER (PARTITION BY sk ORDER BY value DESC, ord) AS rn FROM ev WHERE kind = 'error'),
    st AS (SELECT DISTINCT sk, CAST(0 AS BIGINT) AS i, CAST(0 AS DOUBLE) AS total, 0 AS rank, CAST(NULL AS BIGINT) AS ord FROM r
    UNION ALL SELECT st.sk, st.i + 1, CASE WHEN total + cost <= 180 AND rank < 8 THEN total + cost ELSE total END, CASE WHEN total + cost <= 180 AND rank < 8 THEN rank + 1 ELSE rank END,
        CASE WHEN total + cost <= 180 AND rank < 8 THEN r.ord END FROM st JOIN r ON r.sk = st.sk AND r.rn = st.i + 1)
    SELECT sk, rank, ord FROM st WHERE ord IS NOT NULL""")
def k6_budgeted_moments(spark, sf_dir):
    """By falling value, events are taken while their seconds fit into 180; eight at most."""
    rows = of_kind(events(spark, sf_dir), "error").withColumn("cost", F.floor("value") + 1.0)
    return folds.greedy_budget(rows, ["sk"], "value", "cost", "ord", 180.0, 8)


@query("""+ e AS (SELECT sk, k, arg_max(ord, (value, -ord)) AS peak, arg_min(ord, (t_ms, ord)) AS first_ord, arg_max(ord, (t_ms, ord)) AS last_ord FROM ev WHERE kind = 'view' GROUP BY sk, k)
    SELECT sk, k, CASE WHEN peak = first_ord AND peak = last_ord THEN CAST(peak AS VARCHAR) WHEN peak = last_ord OR first_ord = last_ord THEN peak || ',' || first_ord WHEN peak = first_ord THEN peak || ',' || last_ord ELSE peak || ',' || first_ord || ',' || last_ord END AS anchors FROM e""")
def k7_proof_anchors(spark, sf_dir):
    per = of_kind(events(spark, sf_dir), "view").groupBy("sk", "k").agg(
        F.max_by("ord", F.struct(F.col("value"), (-F.col("ord")).alias("o"))).alias("peak"),
        F.min_by("ord", F.struct("t_ms", "ord")).alias("first"), F.max_by("ord", F.struct("t_ms", "ord")).alias("last"),
    )
    anchors = F.slice(F.array_distinct(F.array("peak", "first", "last")), 1, 3)
    return per.select("sk", "k", F.array_join(anchors.cast("array<string>"), ",").alias("anchors"))


@query("""SELECT sk, kind, array_to_string(list(ord ORDER BY ord)[1:5], ',') AS refs FROM ev GROUP BY sk, kind""")
def k8_prefix_limit(spark, sf_dir):
    refs = F.slice(F.array_sort(F.collect_list("ord")), 1, 5)
    return events(spark, sf_dir).groupBy("sk", "kind").agg(F.array_join(refs.cast("array<string>"), ",").alias("refs"))


@query(f"""+ r AS (SELECT sk, t_ms, CAST(floor(value) AS BIGINT) AS chars, k % 5 AS element, row_number() OVER (PARTITION BY sk ORDER BY t_ms, ord) AS rn FROM ev WHERE kind = 'purchase'),
    st AS (SELECT sk, rn AS i, rn AS c, t_ms AS t0, t_ms AS t1, CAST(1 AS BIGINT) AS n, chars AS total, chars AS best_size, element AS best_group FROM r WHERE rn = 1
    UNION ALL SELECT sk, rn, CASE WHEN j THEN c ELSE rn END, CASE WHEN j THEN t0 ELSE t_ms END, CASE WHEN j THEN greatest(t1, t_ms) ELSE t_ms END, CASE WHEN j THEN n + 1 ELSE 1 END,
        CASE WHEN j THEN total + chars ELSE chars END, CASE WHEN j THEN greatest(best_size, chars) ELSE chars END, CASE WHEN j AND chars <= best_size THEN best_group ELSE element END
        FROM (SELECT st.*, r.rn, r.t_ms, r.chars, r.element, coalesce(r.t_ms - st.t1 <= {60 * HOUR} AND (r.element IS NULL OR st.best_group IS NULL OR r.element = st.best_group), false) AS j
        FROM st JOIN r ON r.sk = st.sk AND r.rn = st.i + 1))
    SELECT sk, t0, t1, n, total, best_size, best_group FROM st QUALIFY row_number() OVER (PARTITION BY sk, c ORDER BY i DESC) = 1""")
def f1_paste_clusters(spark, sf_dir):
    rows = of_kind(events(spark, sf_dir), "purchase").select(
        "sk", "ord", "t_ms", F.col("t_ms").alias("end_ms"), F.floor("value").alias("chars"), (F.col("k") % 5).alias("element")
    )
    return folds.cluster_by_largest(rows, ["sk"], gap_ms=60 * HOUR)


def greedy_sql(a: str, b: str, near: str) -> str:
    """Rows of kind ``a`` in order take the unused row of kind ``b`` that is nearest in time: one step of recursion a row."""
    return f"""+ ga AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY t_ms, ord) AS rn FROM ev WHERE kind = '{a}'),
    st AS (SELECT DISTINCT sk, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS ord, CAST(NULL AS BIGINT) AS b_ord FROM ga
    UNION ALL SELECT sk, i + 1, CASE WHEN b IS NULL THEN used ELSE list_append(used, b) END, o, b FROM (
        SELECT st.sk, st.i, st.used, a.ord AS o, b.ord AS b, row_number() OVER (PARTITION BY st.sk ORDER BY CASE WHEN b.ord IS NULL THEN 1 ELSE 0 END, abs(b.t_ms - a.t_ms), b.t_ms, b.ord) AS pick
        FROM st JOIN ga a ON a.sk = st.sk AND a.rn = st.i + 1 LEFT JOIN ev b ON b.sk = a.sk AND b.kind = '{b}' AND {near} AND NOT list_contains(st.used, b.ord)) WHERE pick = 1)
    SELECT sk, ord, b_ord FROM st WHERE b_ord IS NOT NULL"""


@query(greedy_sql("purchase", "click", f"b.k % 5 = a.k % 5 AND b.t_ms - a.t_ms BETWEEN 0 AND {30 * HOUR} AND floor(b.value) * 10 >= floor(a.value) * 7"))
def f2_paste_delete_pairs(spark, sf_dir):
    """A deletion within 30 hours that removes at least 70 % of what a paste on the same element added; each is used once."""
    rows = events(spark, sf_dir).withColumn("element", F.col("k") % 5).withColumn("chars", F.floor("value")).select("sk", "ord", "kind", "t_ms", "element", "chars")
    near = lambda x, y: (y["element"] == x["element"]) & (y["t_ms"] >= x["t_ms"]) & (y["t_ms"] - x["t_ms"] <= 30 * HOUR) & (y["chars"] * 10 >= x["chars"] * 7)
    fields = ["t_ms", "ord", "element", "chars"]
    return folds.greedy_pairs(of_kind(rows, "purchase"), of_kind(rows, "click"), ["sk"], near, lambda x, y: y["t_ms"] - x["t_ms"], fields, fields, "ord", "ord", around(0, 30 * HOUR))


def around(before: int, after: int):
    """The window of times that a row can pair with."""
    return lambda a: (F.col("t_ms") - before, F.col("t_ms") + after)


@query(greedy_sql("error", "signup", "b.t_ms > a.t_ms"))
def f4_blur_focus_pairs(spark, sf_dir):
    rows = events(spark, sf_dir).select("sk", "ord", "kind", "t_ms")
    return folds.next_unused(of_kind(rows, "error"), of_kind(rows, "signup"), ["sk"])


@query(greedy_sql("view", "purchase", f"abs(b.t_ms - a.t_ms) <= {20 * HOUR}"))
def f5_gaze_input_pairs(spark, sf_dir):
    rows = events(spark, sf_dir).select("sk", "ord", "kind", "t_ms")
    near = lambda x, y: F.abs(y["t_ms"] - x["t_ms"]) <= 20 * HOUR
    return folds.greedy_pairs(of_kind(rows, "view"), of_kind(rows, "purchase"), ["sk"], near, lambda x, y: F.abs(y["t_ms"] - x["t_ms"]), ["t_ms", "ord"], ["t_ms", "ord"], "ord", "ord", around(20 * HOUR, 20 * HOUR))


@query(f"""+ r AS (SELECT sk, t_ms AS s, t_ms + {HOUR} AS e, row_number() OVER (PARTITION BY sk ORDER BY t_ms, ord) AS rn FROM ev WHERE kind = 'error'),
    st AS (SELECT sk, rn AS i, rn AS c, s AS t0, e AS t1, CAST(1 AS BIGINT) AS n FROM r WHERE rn = 1
    UNION ALL SELECT sk, rn, CASE WHEN j THEN c ELSE rn END, CASE WHEN j THEN t0 ELSE s END, CASE WHEN j THEN greatest(t1, e) ELSE e END, CASE WHEN j THEN n + 1 ELSE 1 END
        FROM (SELECT st.*, r.rn, r.s, r.e, r.s - st.t1 <= {30 * HOUR} AND greatest(st.t1, r.e) - st.t0 <= {90 * HOUR} AS j FROM st JOIN r ON r.sk = st.sk AND r.rn = st.i + 1))
    SELECT sk, t0, t1, n FROM st QUALIFY row_number() OVER (PARTITION BY sk, c ORDER BY i DESC) = 1""")
def f7_seed_clusters(spark, sf_dir):
    rows = of_kind(spans(spark, sf_dir), "error").withColumn("end_ms", F.col("start_ms") + HOUR)
    return folds.capped_clusters(rows, ["sk"], gap_ms=30 * HOUR, span_ms=90 * HOUR)


@query(greedy_sql("signup", "error", f"b.k % 2 = a.k % 2 AND abs(b.t_ms - a.t_ms) <= {90 * HOUR}"))
def f8_track_match(spark, sf_dir):
    """Each finding of track A takes the nearest compatible unused finding of track B within 90 hours."""
    rows = events(spark, sf_dir).select("sk", "ord", "kind", "t_ms", (F.col("k") % 2).alias("family"))
    near = lambda x, y: (x["family"] == y["family"]) & (F.abs(y["t_ms"] - x["t_ms"]) <= 90 * HOUR)
    fields = ["t_ms", "ord", "family"]
    return folds.greedy_pairs(of_kind(rows, "signup"), of_kind(rows, "error"), ["sk"], near, lambda x, y: F.abs(y["t_ms"] - x["t_ms"]), fields, fields, "ord", "ord", around(90 * HOUR, 90 * HOUR))
