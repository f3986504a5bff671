"""Interval-set and sequence operators over the event tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from evidencelake.operators import intervals, sequences
from evidencelake.plans.registry import HOUR, N, events, of_kind, query, spans, table

ISLANDS = """SELECT *, sum(opens) OVER (PARTITION BY sk ORDER BY start_ms, end_ms, ord) AS island FROM (
    SELECT *, CASE WHEN start_ms - max(end_ms) OVER (PARTITION BY sk ORDER BY start_ms, end_ms, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {tol}
        THEN 0 ELSE 1 END AS opens FROM {src})"""


@query("""+ m AS (%s) SELECT sk, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n_rows FROM m GROUP BY sk, island"""
       % ISLANDS.format(tol=0, src="iv WHERE end_ms > start_ms"))
def u4_merge_intervals(spark, sf_dir):
    return intervals.merge_intervals(spans(spark, sf_dir), ["sk"], order=["ord"])


@query("""+ m AS (%s), p AS (SELECT sk, min(start_ms) AS a, max(end_ms) AS b FROM m GROUP BY sk, island)
    SELECT sk, CAST(sum(b - a) AS BIGINT) AS union_ms, count(*) AS n_pieces FROM p GROUP BY sk""" % ISLANDS.format(tol=0, src="iv WHERE end_ms > start_ms"))
def u3_union_length(spark, sf_dir):
    return intervals.union_length(spans(spark, sf_dir), ["sk"])


@query("""+ m1 AS (%s), m2 AS (%s), p AS (SELECT sk, min(start_ms) AS a, max(end_ms) AS b FROM m1 GROUP BY sk, island),
    q AS (SELECT sk, min(start_ms) AS c, max(end_ms) AS d FROM m2 GROUP BY sk, island)
    SELECT p.sk, CAST(sum(least(b, d) - greatest(a, c)) AS BIGINT) AS common_ms FROM p JOIN q ON p.sk = q.sk AND a < d AND c < b GROUP BY p.sk"""
       % (ISLANDS.format(tol=0, src="iv WHERE end_ms > start_ms AND kind IN ('view', 'click')"), ISLANDS.format(tol=0, src="iv WHERE end_ms > start_ms AND kind IN ('purchase', 'error')")))
def u5_intersection_length(spark, sf_dir):
    rows = spans(spark, sf_dir)
    return intervals.intersect_length(of_kind(rows, "view", "click"), of_kind(rows, "purchase", "error"), ["sk"], width=24 * HOUR)


@query("""+ c AS (SELECT a.sk, greatest(a.start_ms, b.start_ms) AS start_ms, least(a.end_ms, b.end_ms) AS end_ms, a.ord FROM iv a JOIN iv b
        ON a.sk = b.sk AND a.kind = 'view' AND b.kind = 'click' AND a.start_ms < b.end_ms AND b.start_ms < a.end_ms),
    m AS (%s), p AS (SELECT sk, min(start_ms) AS a, max(end_ms) AS b FROM m GROUP BY sk, island)
    SELECT sk, CAST(sum(b - a) AS BIGINT) AS union_ms, count(*) AS n_pieces FROM p GROUP BY sk""" % ISLANDS.format(tol=0, src="c WHERE end_ms > start_ms"))
def u6_clipped_union(spark, sf_dir):
    rows = spans(spark, sf_dir)
    return intervals.union_length(intervals.clip(of_kind(rows, "view"), of_kind(rows, "click"), ["sk"], width=24 * HOUR), ["sk"])


@query("""+ m AS (%s) SELECT sk, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n_rows, array_to_string(list(ord ORDER BY ord), ',') AS chunk_ids,
    array_to_string(list(DISTINCT kind ORDER BY kind), ',') AS sections FROM m GROUP BY sk, island""" % ISLANDS.format(tol=N, src="iv"))
def w6_merged_segments(spark, sf_dir):
    extra = [
        F.array_join(F.array_sort(F.collect_list("ord")).cast("array<string>"), ",").alias("chunk_ids"),
        F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("sections"),
    ]
    return intervals.merge_intervals(spans(spark, sf_dir), ["sk"], tol=N, extra=extra, order=["ord"])


GAPS = """+ m AS (%s), p AS (SELECT sk, min(start_ms) AS a, max(end_ms) AS b FROM m GROUP BY sk, island),
    g AS (SELECT sk, lag(b) OVER (PARTITION BY sk ORDER BY a, b) AS gap_start, a AS gap_end FROM p)
    SELECT sk, gap_start, gap_end, CASE WHEN gap_end - gap_start < 60000 THEN 'recording_gap' ELSE 'unknown' END AS gap_kind
    FROM g WHERE gap_end - gap_start > 2000""" % ISLANDS.format(tol=0, src="iv WHERE end_ms > start_ms")


@query(GAPS)
def w7_segment_gaps(spark, sf_dir):
    return intervals.gaps(intervals.merge_intervals(spans(spark, sf_dir), ["sk"]), ["sk"])


@query("""SELECT sk, ord, start_ms - p AS gap_ms FROM (SELECT *, lag(end_ms) OVER (PARTITION BY sk ORDER BY start_ms, ord) AS p FROM iv) WHERE start_ms - p > 2000""")
def w8_span_gaps(spark, sf_dir):
    w = Window.partitionBy("sk").orderBy("start_ms", "ord")
    rows = spans(spark, sf_dir).withColumn("gap_ms", F.col("start_ms") - F.lag("end_ms").over(w))
    return rows.filter("gap_ms > 2000").select("sk", "ord", "gap_ms")


@query("""+ s AS (SELECT DISTINCT l_orderkey AS sk, CAST(l_linenumber AS BIGINT) AS seq FROM lineitem), r AS (SELECT sk, min(seq) AS lo, max(seq) AS hi FROM s GROUP BY sk),
    x AS (SELECT sk, unnest(range(lo, hi + 1)) AS seq FROM r), a AS (SELECT * FROM x ANTI JOIN s USING (sk, seq)),
    g AS (SELECT *, seq - row_number() OVER (PARTITION BY sk ORDER BY seq) AS run FROM a)
    SELECT sk, min(seq) AS first_missing, max(seq) AS last_missing, count(*) AS n_missing FROM g GROUP BY sk, run""")
def w9_missing_sequences(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sk"), F.col("l_linenumber").cast("bigint").alias("seq"))
    return intervals.missing_runs(lines, ["sk"], "seq")


@query("""+ p AS (SELECT *, CASE kind WHEN 'error' THEN 2 WHEN 'click' THEN 1 ELSE 0 END AS prio FROM iv),
    m AS (SELECT *, sum(opens) OVER (PARTITION BY sk ORDER BY start_ms, end_ms, ord) AS island FROM (
    SELECT *, CASE WHEN start_ms < max(end_ms) OVER (PARTITION BY sk ORDER BY start_ms, end_ms, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM p))
    SELECT sk, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n_rows, max(prio) AS prio FROM m GROUP BY sk, island""")
def w10_unknown_merge(spark, sf_dir):
    prio = F.when(F.col("kind") == "error", 2).when(F.col("kind") == "click", 1).otherwise(0)
    rows = spans(spark, sf_dir).withColumn("prio", prio)
    return intervals.merge_intervals(rows, ["sk"], tol=0, strict=True, extra=[F.max("prio").alias("prio")], order=["ord"])


EPISODES = """+ h AS (SELECT *, sum(opens) OVER (PARTITION BY sk ORDER BY start_ms, ord) AS ep FROM (SELECT *,
        CASE WHEN start_ms - lag(end_ms) OVER (PARTITION BY sk ORDER BY start_ms, ord) <= %d THEN 0 ELSE 1 END AS opens FROM iv WHERE kind IN ('view', 'click'))),
    u AS (SELECT *, sum(o2) OVER (PARTITION BY sk, ep ORDER BY start_ms, end_ms, ord) AS piece FROM (SELECT *,
        CASE WHEN start_ms <= max(end_ms) OVER (PARTITION BY sk, ep ORDER BY start_ms, end_ms, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS o2 FROM h WHERE end_ms > start_ms)),
    p AS (SELECT sk, ep, max(end_ms) - min(start_ms) AS len FROM u GROUP BY sk, ep, piece), l AS (SELECT sk, ep, sum(len) AS len FROM p GROUP BY sk, ep),
    e AS (SELECT sk, ep, min(start_ms) AS t0_ms, max(end_ms) AS t1_ms, count(*) AS n_hits FROM h GROUP BY sk, ep)
    SELECT e.sk, t0_ms, t1_ms, n_hits, CAST(coalesce(len, 0) AS BIGINT) AS union_ms FROM e LEFT JOIN l ON e.sk = l.sk AND e.ep = l.ep""" % (22 * HOUR)


@query(EPISODES)
def w1_episodes(spark, sf_dir):
    rows = spans(spark, sf_dir)
    out = sequences.episodes(rows, F.col("kind").isin("view", "click"), ["sk"], ["start_ms", "ord"], gap_ms=22 * HOUR)
    return out.select("sk", "t0_ms", "t1_ms", "n_hits", "union_ms")


@query("""+ h AS (SELECT *, sum(opens) OVER (PARTITION BY sk ORDER BY start_ms, ord) AS ep FROM (SELECT *,
        CASE WHEN start_ms - lag(end_ms) OVER (PARTITION BY sk ORDER BY start_ms, ord) <= 90 * 3600000 THEN 0 ELSE 1 END AS opens FROM iv WHERE kind = 'error'))
    SELECT sk, min(start_ms) AS t0_ms, max(end_ms) AS t1_ms, count(*) AS n_hits, arg_min(ord, (-value, ord)) AS peak_ord FROM h GROUP BY sk, ep""")
def w3_peak_episodes(spark, sf_dir):
    rows = sequences.island_ids(of_kind(spans(spark, sf_dir), "error"), ["sk"], ["start_ms", "ord"], "start_ms", "end_ms", 90 * HOUR)
    peak = F.min_by("ord", F.struct((-F.col("value")).alias("v"), F.col("ord")))
    return rows.groupBy("sk", "island").agg(
        F.min("start_ms").alias("t0_ms"), F.max("end_ms").alias("t1_ms"), F.count("*").alias("n_hits"), peak.alias("peak_ord")
    ).drop("island")


@query("""+ r AS (SELECT *, sum(n) OVER (PARTITION BY sk ORDER BY start_ms, ord) AS run FROM (SELECT *,
        CASE WHEN kind = lag(kind) OVER (PARTITION BY sk ORDER BY start_ms, ord) THEN 0 ELSE 1 END AS n FROM iv)),
    i AS (SELECT *, sum(o) OVER (PARTITION BY sk, run ORDER BY start_ms, ord) AS isl FROM (SELECT *,
        CASE WHEN start_ms - max(end_ms) OVER (PARTITION BY sk, run ORDER BY start_ms, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 22 * 3600000 THEN 0 ELSE 1 END AS o FROM r))
    SELECT sk, kind, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n_rows FROM i GROUP BY sk, run, isl, kind""")
def w4_cleared_coalesce(spark, sf_dir):
    return sequences.coalesce_runs(spans(spark, sf_dir), ["sk"], ["start_ms", "ord"], ["kind"], "start_ms", "end_ms", 22 * HOUR)


@query("""+ i AS (SELECT *, sum(o) OVER (PARTITION BY sk, k ORDER BY start_ms, end_ms, ord) AS isl FROM (SELECT *,
        CASE WHEN start_ms - lag(end_ms) OVER (PARTITION BY sk, k ORDER BY start_ms, end_ms, ord) <= 45 * 3600000 THEN 0 ELSE 1 END AS o FROM iv WHERE kind = 'view'))
    SELECT sk, k, min(start_ms) AS t0_ms, max(end_ms) AS t1_ms, CAST(least(sum(end_ms - start_ms), max(end_ms) - min(start_ms)) AS BIGINT) AS duration_ms FROM i GROUP BY sk, k, isl""")
def w5_direction_segments(spark, sf_dir):
    rows = sequences.island_ids(of_kind(spans(spark, sf_dir), "view"), ["sk", "k"], ["start_ms", "end_ms", "ord"], "start_ms", "end_ms", 45 * HOUR)
    length = F.least(F.sum(F.col("end_ms") - F.col("start_ms")), F.max("end_ms") - F.min("start_ms"))
    return rows.groupBy("sk", "k", "island").agg(F.min("start_ms").alias("t0_ms"), F.max("end_ms").alias("t1_ms"), length.alias("duration_ms")).drop("island")


@query("""+ c AS (SELECT sk, ord, row_number() OVER (PARTITION BY sk ORDER BY ord) AS seq, CAST(floor(value * 1000) AS BIGINT) AS dur, CASE WHEN kind IN ('view', 'error') THEN t_ms END AS clock FROM ev),
    r AS (SELECT *, coalesce(sum(dur) OVER (PARTITION BY sk ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM c),
    o AS (SELECT *, clock - run AS off FROM r)
    SELECT sk, seq, CAST(run + coalesce(last_value(off IGNORE NULLS) OVER (PARTITION BY sk ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(off IGNORE NULLS) OVER (PARTITION BY sk ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS BIGINT) AS filled_start FROM o""")
def w11_clock_fill(spark, sf_dir):
    seq = F.row_number().over(Window.partitionBy("sk").orderBy("ord")).cast("bigint")
    rows = events(spark, sf_dir).select(
        "sk", seq.alias("seq"), F.floor(F.col("value") * 1000).alias("dur"), F.when(F.col("kind").isin("view", "error"), F.col("t_ms")).alias("clock")
    )
    return sequences.filled_clock(rows, ["sk"], "seq", "clock", "dur").select("sk", "seq", "filled_start")


@query("""SELECT sk, ord, t_ms - p AS gap_ms FROM (SELECT *, lag(t_ms) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS p FROM ev WHERE kind IN ('click', 'purchase')) WHERE t_ms - p >= 36000000""")
def w12_activity_gaps(spark, sf_dir):
    w = Window.partitionBy("sk").orderBy("t_ms", "ord")
    rows = of_kind(events(spark, sf_dir), "click", "purchase").withColumn("gap_ms", F.col("t_ms") - F.lag("t_ms").over(w))
    return rows.filter(F.col("gap_ms") >= 10 * HOUR).select("sk", "ord", "gap_ms")


@query("""+ r AS (SELECT *, t_ms - lag(t_ms) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS step FROM ev WHERE kind = 'click'),
    i AS (SELECT *, sum(CASE WHEN step <= 30 * 3600000 THEN 0 ELSE 1 END) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS isl FROM r),
    s AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY sk, isl ORDER BY t_ms, ord) > 1 THEN step END AS inner_step FROM i),
    g AS (SELECT sk, min(t_ms) AS t0_ms, max(t_ms) AS t1_ms, count(*) AS n_events, list(inner_step ORDER BY inner_step) FILTER (inner_step IS NOT NULL) AS l FROM s GROUP BY sk, isl)
    SELECT sk, t0_ms, t1_ms, n_events, l[len(l) // 2 + 1] AS median_gap_ms FROM g WHERE n_events >= 3""")
def w13_answer_bursts(spark, sf_dir):
    return sequences.bursts(of_kind(events(spark, sf_dir), "click"), ["sk"], ["t_ms", "ord"], gap_ms=30 * HOUR).drop("island")


@query("""+ r AS (SELECT *, k % 3 AS q FROM ev WHERE kind = 'purchase'), i AS (SELECT *, sum(o) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS isl FROM (SELECT *,
        CASE WHEN t_ms - lag(t_ms) OVER (PARTITION BY sk ORDER BY t_ms, ord) <= 60 * 3600000 AND q IS NOT DISTINCT FROM lag(q) OVER (PARTITION BY sk ORDER BY t_ms, ord) THEN 0 ELSE 1 END AS o FROM r)),
    g AS (SELECT sk, isl, q, min(t_ms) AS t0_ms, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS chars FROM i GROUP BY sk, isl, q)
    SELECT sk, q, t0_ms, n, chars, CASE WHEN n >= 3 THEN 'mass_paste' ELSE 'external_paste' END AS event_type,
        CASE WHEN chars >= 500 THEN 'high' WHEN chars >= 200 THEN 'medium' ELSE 'low' END AS severity FROM g""")
def w14_mass_paste(spark, sf_dir):
    rows = of_kind(events(spark, sf_dir), "purchase").withColumn("q", F.col("k") % 3)
    rows = sequences.island_ids(rows, ["sk"], ["t_ms", "ord"], "t_ms", "t_ms", 60 * HOUR, same=["q"])
    grouped = rows.groupBy("sk", "island", "q").agg(F.min("t_ms").alias("t0_ms"), F.count("*").alias("n"), F.sum(F.floor("value")).alias("chars"))
    kind = F.when(F.col("n") >= 3, "mass_paste").otherwise("external_paste")
    severity = F.when(F.col("chars") >= 500, "high").when(F.col("chars") >= 200, "medium").otherwise("low")
    return grouped.select("sk", "q", "t0_ms", "n", "chars", kind.alias("event_type"), severity.alias("severity"))


@query("""+ f AS (SELECT *, max(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY sk ORDER BY t_ms RANGE BETWEEN 21600000 PRECEDING AND CURRENT ROW) AS m FROM ev)
    SELECT sk, ord, m = 1 AS has_precursor FROM f WHERE kind = 'purchase'""")
def w15_precursor(spark, sf_dir):
    flag = sequences.looked_back(F.col("kind") == "error", ["sk"], "t_ms", N)
    return of_kind(events(spark, sf_dir).withColumn("has_precursor", flag), "purchase").select("sk", "ord", "has_precursor")


@query("""SELECT sk, ord, nxt - t_ms AS idle_ms FROM (SELECT *, min(CASE WHEN kind = 'click' THEN t_ms END) OVER (PARTITION BY sk ORDER BY t_ms RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM ev)
    WHERE kind = 'error' AND nxt IS NOT NULL""")
def w16_idle_gaps(spark, sf_dir):
    later = Window.partitionBy("sk").orderBy("t_ms").rangeBetween(1, Window.unboundedFollowing)
    rows = events(spark, sf_dir).withColumn("nxt", F.min(F.when(F.col("kind") == "click", F.col("t_ms"))).over(later))
    return rows.filter("kind = 'error' and nxt is not null").select("sk", "ord", (F.col("nxt") - F.col("t_ms")).alias("idle_ms"))


@query("""SELECT * FROM (SELECT sk, ord, t_ms - lag(t_ms) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS interval_ms FROM ev WHERE kind = 'purchase') WHERE interval_ms IS NOT NULL""")
def w17_paste_intervals(spark, sf_dir):
    w = Window.partitionBy("sk").orderBy("t_ms", "ord")
    rows = of_kind(events(spark, sf_dir), "purchase").select("sk", "ord", (F.col("t_ms") - F.lag("t_ms").over(w)).alias("interval_ms"))
    return rows.filter("interval_ms is not null")


@query("""+ s AS (SELECT sk, k % 4 AS section, k AS q, max(t_ms) AS done, CAST(floor(max(value)) AS BIGINT) * 3600000 AS spent, count(*) AS n FROM ev WHERE kind = 'purchase' GROUP BY sk, k),
    b AS (SELECT sk, k % 4 AS section, min(t_ms) AS open_ms FROM ev GROUP BY sk, k % 4),
    d AS (SELECT sk, section, max(n) AS most FROM s GROUP BY sk, section),
    w AS (SELECT s.*, b.open_ms, lag(done) OVER (PARTITION BY s.sk, s.section ORDER BY done, q) AS before FROM s JOIN b USING (sk, section) JOIN d USING (sk, section) WHERE most <= 3)
    SELECT sk, section, q, greatest(open_ms, coalesce(before, open_ms), done - spent) AS start_ms, done AS end_ms FROM w""")
def w18_question_windows(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("section", F.col("k") % 4)
    sent = of_kind(rows, "purchase").groupBy("sk", "section", F.col("k").alias("q")).agg(
        F.max("t_ms").alias("done"), (F.floor(F.max("value")) * HOUR).alias("spent"), F.count("*").alias("n")
    )
    opened = rows.groupBy("sk", "section").agg(F.min("t_ms").alias("open_ms"))
    clean = sent.groupBy("sk", "section").agg(F.max("n").alias("most")).filter("most <= 3").drop("most")
    w = Window.partitionBy("sk", "section").orderBy("done", "q")
    joined = sent.join(opened, ["sk", "section"]).join(clean, ["sk", "section"]).withColumn("before", F.lag("done").over(w))
    start = F.greatest("open_ms", F.coalesce("before", "open_ms"), F.col("done") - F.col("spent"))
    return joined.select("sk", "section", "q", start.alias("start_ms"), F.col("done").alias("end_ms"))


@query("""SELECT conv_id, turn, length(text) - length(before) AS delta FROM (SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM (
    SELECT *, sum(CASE WHEN text <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS filled FROM conversations) WHERE filled > 0) WHERE before IS NOT NULL""")
def w19_previous_text(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumn("filled", F.sum(F.when(F.col("text") != "", 1).otherwise(0)).over(w)).filter("filled > 0")
    rows = rows.withColumn("before", F.lag("text").over(w)).filter("before is not null")
    return rows.select("conv_id", "turn", (F.char_length("text") - F.char_length("before")).cast("bigint").alias("delta"))


@query(EPISODES.replace("SELECT e.sk, t0_ms", "SELECT sk, t0_ms, lead(t0_ms) OVER (PARTITION BY sk ORDER BY t0_ms) - t1_ms AS next_gap_ms FROM (SELECT e.sk, t0_ms") + ")")
def w20_next_gap(spark, sf_dir):
    out = w1_episodes(spark, sf_dir)
    w = Window.partitionBy("sk").orderBy("t0_ms")
    return out.select("sk", "t0_ms", (F.lead("t0_ms").over(w) - F.col("t1_ms")).alias("next_gap_ms"))


@query("""+ q AS (SELECT sk, k, lag(k) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS p FROM ev WHERE kind = 'purchase'),
    s AS (SELECT sk, count(*) AS n_windows, CAST(count_if(k < p) AS BIGINT) AS reversals FROM q GROUP BY sk) SELECT * FROM s WHERE n_windows >= 3 AND reversals >= 2""")
def w21_submission_reversals(spark, sf_dir):
    w = Window.partitionBy("sk").orderBy("t_ms", "ord")
    rows = of_kind(events(spark, sf_dir), "purchase").withColumn("p", F.lag("k").over(w))
    return rows.groupBy("sk").agg(F.count("*").alias("n_windows"), F.count_if(F.col("k") < F.col("p")).alias("reversals")).filter("n_windows >= 3 and reversals >= 2")


@query("""SELECT sk, k, min(t_ms) AS first_ms, max(t_ms) AS last_ms, count(*) AS n FROM ev GROUP BY sk, k""")
def w22_times_by_sequence(spark, sf_dir):
    return events(spark, sf_dir).groupBy("sk", "k").agg(F.min("t_ms").alias("first_ms"), F.max("t_ms").alias("last_ms"), F.count("*").alias("n"))


@query("""SELECT a.sk, a.ord FROM iv a WHERE kind = 'error' AND NOT EXISTS (SELECT 1 FROM iv b WHERE b.sk = a.sk AND b.kind = 'view' AND b.start_ms <= a.start_ms AND b.end_ms >= a.end_ms)""")
def j23_uncontained(spark, sf_dir):
    rows = spans(spark, sf_dir)
    return intervals.exclude_contained(of_kind(rows, "error"), of_kind(rows, "view"), ["sk"]).select("sk", "ord")


@query("""+ g AS (SELECT sk, start_ms, end_ms FROM iv WHERE kind = 'error'), h AS (SELECT sk, start_ms, end_ms FROM iv WHERE kind = 'view'),
    k AS (SELECT g.* FROM g WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.sk = g.sk AND h.start_ms <= g.start_ms AND h.end_ms >= g.end_ms)),
    c AS (SELECT *, row_number() OVER () AS ord FROM (SELECT * FROM k UNION ALL SELECT * FROM h)), m AS (%s), p AS (SELECT sk, min(start_ms) AS a, max(end_ms) AS b FROM m GROUP BY sk, island)
    SELECT sk, CAST(sum(b - a) AS BIGINT) AS union_ms, count(*) AS n_pieces FROM p GROUP BY sk""" % ISLANDS.format(tol=0, src="c WHERE end_ms > start_ms"))
def u7_unknown_panel(spark, sf_dir):
    rows = spans(spark, sf_dir).select("sk", "kind", "start_ms", "end_ms")
    holes, seen = of_kind(rows, "error"), of_kind(rows, "view")
    return intervals.union_length(intervals.exclude_contained(holes, seen, ["sk"]).unionByName(seen), ["sk"])
