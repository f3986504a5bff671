"""Observed and deliberated tables over binding E: predicates, facts, findings, unions, episodes, stories and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidencelake.functions import urls
from evidencelake.operators import stats
from evidencelake.plans import deliberate, findings, observed, perception, review, risk_queries, timeline
from evidencelake.plans.decide_queries import GAP, OBS, observations
from evidencelake.plans.registry import HOUR, events, of_kind, query, spans

SPEECH = ("asking_for_answer", "invigilator_or_admin", "self_talk_or_thinking", "UNKNOWN", "silence", "casual_non_exam", "technical_exam_help", "reading_question", "discussing_solution")
CLASS_SQL = "CASE k % 9 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SPEECH)) + " END"


def pick(c, names):
    """The name at the remainder of ``c``."""
    return F.get(F.array(*map(F.lit, names)), (c % len(names)).cast("int"))


def known(spark, sf_dir, *kinds):
    rows = events(spark, sf_dir).filter("k is not null and t_ms is not null")
    return of_kind(rows, *kinds) if kinds else rows


KNOWN = "e AS (SELECT * FROM ev WHERE k IS NOT NULL AND t_ms IS NOT NULL)"


@query(f"""+ {KNOWN}, p AS (SELECT sk, ord, k % 7 <> 0 AS av, CASE k % 4 WHEN 0 THEN 'NONE' WHEN 1 THEN 'LOW' WHEN 2 THEN 'MEDIUM' ELSE 'HIGH' END AS tier, value / 100.0 AS conf, k % 5 = 0 AS obscured FROM e)
    SELECT sk, ord, av AND tier <> 'NONE' AND conf >= 0.3 AS usable, NOT av OR tier IN ('NONE', 'LOW') OR obscured AS capture_issue FROM p""")
def p10_p11_predicates(spark, sf_dir):
    k = F.col("k")
    available, tier = k % 7 != 0, pick(k, ("NONE", "LOW", "MEDIUM", "HIGH"))
    framing = F.when(k % 5 == 0, "obscured").otherwise("centered")
    return known(spark, sf_dir).select(
        "sk", "ord", observed.usable(available, tier, F.col("value") / 100.0).alias("usable"), observed.capture_issue(available, tier, framing).alias("capture_issue")
    )


@query(f"""+ {KNOWN}, p AS (SELECT sk, kind, {CLASS_SQL} AS c FROM e)
    SELECT sk, kind, bool_or(c IN ('asking_for_answer', 'discussing_solution')) AS integrity_speech, bool_or(c IN ('invigilator_or_admin', 'technical_exam_help')) AS admin_speech,
    count_if(c NOT IN ('UNKNOWN', 'silence')) > 0 AND NOT bool_or(c IN ('asking_for_answer', 'discussing_solution')) AS only_cleared_speech FROM p GROUP BY sk, kind""")
def p12_speech_classes(spark, sf_dir):
    rows = known(spark, sf_dir).withColumn("said", pick(F.col("k"), SPEECH))
    return rows.groupBy("sk", "kind").agg(*[c.alias(n) for n, c in observed.speech_classes(F.col("said")).items()])


@query(f"""+ {KNOWN} SELECT sk, ord, CASE k % 4 WHEN 0 THEN 'screen' WHEN 1 THEN 'UNKNOWN' ELSE 'off_screen' END AS gaze, 'w_' || t_ms AS window_id FROM e WHERE kind = 'view'""")
def p4_compact_windows(spark, sf_dir):
    return windows(spark, sf_dir).select("sk", "ord", "gaze", "window_id")


def windows(spark, sf_dir):
    k = F.col("k")
    yes = lambda c: F.when(c, "yes").otherwise("no")
    rows = known(spark, sf_dir, "view").select(
        "sk", "ord", F.concat(F.lit("w_"), F.col("t_ms").cast("string")).alias("window_id"), F.col("t_ms").alias("start_ms"), (F.col("t_ms") + F.floor(F.col("value") * 36_000).cast("bigint")).alias("end_ms"),
        (k % 11 != 0).alias("video_available"), (F.col("value") / 100).alias("confidence"), yes(k % 3 != 0).alias("face_present"), yes(k % 5 == 0).alias("second_person_visible"),
        yes(k % 7 == 0).alias("phone_visible"), pick(k, ("screen", "UNKNOWN", "left", "down")).alias("gaze"),
    )
    return observed.compact_windows(rows)


@query(f"""+ {KNOWN}, w AS (SELECT sk, ord, k, t_ms AS s, t_ms + CAST(floor(value * 36000) AS BIGINT) AS e FROM e WHERE kind = 'view' AND k % 11 <> 0 AND value / 100 >= 0.3),
    x AS (SELECT *, 'multiple_faces' AS event_type FROM w WHERE k % 5 = 0 UNION ALL SELECT *, 'phone_usage' FROM w WHERE k % 7 = 0 UNION ALL SELECT *, 'suspicious_eye_movement' FROM w WHERE k % 4 >= 2 UNION ALL SELECT *, 'no_candidate' FROM w WHERE k % 3 = 0),
    i AS (SELECT *, sum(f) OVER (PARTITION BY sk, event_type ORDER BY s, ord) AS isl FROM (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY sk, event_type ORDER BY s, ord) <= {22 * HOUR} THEN 0 ELSE 1 END AS f FROM x)),
    g AS (SELECT sk, event_type, min(s) AS t0_ms, arg_max(e, (s, ord)) AS t1_ms, arg_min(s, (s, ord)) AS fw FROM i GROUP BY sk, event_type, isl)
    SELECT sk, event_type, t0_ms, t1_ms, CASE WHEN event_type IN ('multiple_faces', 'phone_usage') THEN 'high' ELSE 'medium' END AS severity, 'video:w_' || fw AS evidence_ref FROM g WHERE event_type = 'no_candidate' OR t1_ms - t0_ms >= {HOUR}""")
def w2_legacy_episodes(spark, sf_dir):
    return observed.legacy_episodes(windows(spark, sf_dir), 22 * HOUR, HOUR)


@query(f"""+ {KNOWN}, s AS (SELECT DISTINCT sk, k % 3 AS section_id FROM e WHERE kind = 'signup')
    SELECT e.sk, e.ord, CASE e.kind WHEN 'signup' THEN 'SECTION_STARTED' ELSE 'CODE_SUBMISSION' END AS kind, e.t_ms AS start_ms, e.k % 3 AS section_id, CASE WHEN s.sk IS NOT NULL THEN 'type' || s.section_id END AS section_type
    FROM e LEFT JOIN s ON e.sk = s.sk AND e.k % 3 = s.section_id WHERE e.kind IN ('signup', 'purchase')""")
def p5_lifecycle_facts(spark, sf_dir):
    rows = known(spark, sf_dir).withColumns({"offset_ms": F.col("t_ms"), "raw_ms": F.col("t_ms"), "section_id": F.col("k") % 3})
    sections = known(spark, sf_dir, "signup").select("sk", (F.col("k") % 3).alias("section_id")).distinct()
    sections = sections.withColumn("section_type", F.concat(F.lit("type"), F.col("section_id").cast("string"))).withColumn("section_title", F.col("section_type"))
    got = observed.lifecycle_facts(rows, sections, {"signup": "SECTION_STARTED", "purchase": "CODE_SUBMISSION"})
    return got.select("sk", "ord", "kind", "start_ms", "section_id", "section_type")


T0_SQL = f"{KNOWN}, z AS (SELECT sk, min(t_ms) FILTER (kind = 'signup') AS t0 FROM e GROUP BY sk)"
#: Three sections a session: six hours each, from T0 on.
SECTIONS_SQL = f"sec AS (SELECT sk, i AS section_id, i AS so, CAST(i * {6 * HOUR} AS BIGINT) AS s, CAST(i * {6 * HOUR} + {5 * HOUR} AS BIGINT) AS f FROM z, range(3) t(i) WHERE t0 IS NOT NULL)"
LOCATED = "(SELECT x.sk, x.ord, arg_min(sec.section_id, (CASE WHEN x.t BETWEEN sec.s AND sec.f THEN 0 ELSE 1 END, CASE WHEN x.t BETWEEN sec.s AND sec.f THEN 0 ELSE least(abs(x.t - sec.s), abs(x.t - sec.f)) END, sec.so)) AS found FROM {src} x JOIN sec USING (sk) GROUP BY x.sk, x.ord)"


def clock(spark, sf_dir):
    return known(spark, sf_dir, "signup").groupBy("sk").agg(F.min("t_ms").alias("t0_ms"))


def sections(spark, sf_dir):
    i = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2).cast("bigint")))
    rows = clock(spark, sf_dir).select("sk", i.alias("section_id"))
    return rows.select("sk", "section_id", F.col("section_id").alias("ord"), (F.col("section_id") * (6 * HOUR)).alias("start_ms"), (F.col("section_id") * (6 * HOUR) + 5 * HOUR).alias("end_ms"))


@query(f"""+ {T0_SQL}, {SECTIONS_SQL}, h AS (SELECT e.*, greatest(0, e.t_ms - z.t0) AS t FROM e JOIN z USING (sk) WHERE e.t_ms - z.t0 BETWEEN -60000 AND {8 * HOUR})
    SELECT h.sk, h.ord, h.kind, h.t AS start_ms, CASE k % 3 WHEN 0 THEN 'client_reported' WHEN 1 THEN 'video_cv' ELSE 'rrweb_deterministic' END AS source, CASE WHEN k % 4 = 0 THEN 9 ELSE l.found END AS section_id
    FROM h LEFT JOIN {LOCATED.format(src='h')} l ON h.sk = l.sk AND h.ord = l.ord""")
def p6_client_events(spark, sf_dir):
    rows = known(spark, sf_dir).withColumn("signal_source", pick(F.col("k"), ("client_reported", "platform_cv", "page"))).withColumn("section_id", F.when(F.col("k") % 4 == 0, F.lit(9).cast("bigint")))
    return observed.hydrated(rows, clock(spark, sf_dir), sections(spark, sf_dir)).select("sk", "ord", "kind", "start_ms", "source", "section_id")


@query(f"""+ {T0_SQL}, {SECTIONS_SQL}, m AS (SELECT e.sk, e.ord, e.k, e.kind, CASE WHEN k % 2 = 0 THEN greatest(0, e.t_ms - coalesce(z.t0, 0)) ELSE k END AS t FROM e LEFT JOIN z USING (sk)), mv AS (SELECT * FROM m WHERE k % 2 = 0)
    SELECT m.sk, m.ord, m.kind, m.t AS start_ms, CASE WHEN k % 5 = 0 THEN 9 ELSE l.found END AS section_id FROM m LEFT JOIN {LOCATED.format(src='mv')} l ON m.sk = l.sk AND m.ord = l.ord""")
def p7_backfilled_facts(spark, sf_dir):
    k = F.col("k")
    rows = known(spark, sf_dir).select("sk", "ord", "kind", F.when(k % 2 == 0, 0).otherwise(k).cast("bigint").alias("start_ms"), F.col("t_ms").alias("raw_ms"), F.when(k % 5 == 0, F.lit(9).cast("bigint")).alias("section_id"))
    return observed.backfilled(rows, clock(spark, sf_dir), sections(spark, sf_dir)).select("sk", "ord", "kind", "start_ms", "section_id")


@query(f"""+ {KNOWN}, p AS (SELECT *, CASE WHEN kind = 'error' THEN 'phone_usage' ELSE 'gaze' END AS ek FROM e) SELECT sk, ord, ek AS kind FROM p WHERE k % 2 = 0 AND ek = 'phone_usage'""")
def p14_perception_episodes(spark, sf_dir):
    rows = known(spark, sf_dir).withColumn("source", F.when(F.col("k") % 2 == 0, "perception_episode").otherwise("fact")).withColumn("kind", F.when(F.col("kind") == "error", "phone_usage").otherwise("gaze"))
    return observed.perception_episodes(rows, ["phone_usage"]).select("sk", "ord", "kind")


@query(f"""+ {KNOWN} SELECT sk, ord, k % 3 <> 0 AND k % 5 <> 0 AND value > 10 AS verified FROM e""")
def p13_verified_questions(spark, sf_dir):
    k, end = F.col("k"), F.col("t_ms") + F.when(F.col("value") > 10, 1000).otherwise(0)
    return known(spark, sf_dir).select("sk", "ord", observed.verified_question(k % 3 != 0, k % 5 == 0, F.col("t_ms"), end).alias("verified"))


@query(f"""+ {KNOWN} SELECT sk, ord, CAST(CASE WHEN k % 3 = 0 THEN floor(value * 1000) WHEN k % 3 = 1 THEN 5 ELSE 0 END AS BIGINT) AS gap_ms, CAST(CASE WHEN k % 2 = 0 THEN floor(value) ELSE 0 END AS BIGINT) AS chars,
    CASE WHEN k % 4 = 0 AND floor(value) > 0 THEN value >= 30 WHEN k % 4 <= 1 THEN k % 3 = 2 WHEN k % 4 = 2 THEN true ELSE false END AS correct FROM e WHERE value >= 1""")
def x27_x29_detector_inputs(spark, sf_dir):
    """Scores for k % 4 = 0, passed tests for 1 (0 falls back to them where the score is 0), words for 2 and 3."""
    k, v = F.col("k"), F.col("value")
    none = F.lit(None).cast("double")
    gap = observed.gap_ms(F.when(k % 3 == 0, v * 1000), F.col("t_ms"), F.when(k % 3 == 1, F.col("t_ms") + 5))
    right = observed.is_correct(
        F.when(k % 4 == 0, 30.0).otherwise(none), F.when(k % 4 == 0, F.when(F.floor(v) > 0, v).otherwise(0.0)).otherwise(none), F.when(k % 4 <= 1, k % 3), F.when(k % 4 <= 1, 2), F.when(k % 4 == 2, "correct").otherwise("wrong")
    )
    return known(spark, sf_dir).filter("value >= 1").select("sk", "ord", gap.alias("gap_ms"), observed.paste_size(F.when(k % 2 == 0, v)).alias("chars"), right.alias("correct"))


@query(f"""+ {KNOWN} SELECT sk, k % 6 AS q, coalesce(arg_max(d, (t_ms, ord)) FILTER (d <> ''), NULL) AS difficulty, arg_min(d, (t_ms, ord)) = 'HARD' AS is_hard FROM (SELECT *, CASE k % 4 WHEN 0 THEN 'HARD' WHEN 1 THEN 'EASY' ELSE '' END AS d FROM e WHERE kind = 'click') GROUP BY sk, k % 6""")
def j12_difficulty(spark, sf_dir):
    rows = known(spark, sf_dir, "click").withColumn("q", F.col("k") % 6).withColumn("difficulty", F.when(F.col("k") % 4 == 0, "hard").when(F.col("k") % 4 == 1, "Easy"))
    return observed.difficulties(rows)


@query(f"""+ {KNOWN}, s AS (SELECT sk, k % 5 AS ref, CASE k % 3 WHEN 0 THEN 'section_score' WHEN 1 THEN 'section_time' ELSE 'question_accuracy' END AS metric, avg(value) AS v FROM e GROUP BY ALL),
    z AS (SELECT *, coalesce((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 0) AS z FROM s WINDOW w AS (PARTITION BY metric, ref))
    SELECT a.sk, a.ref, min(z) FILTER (metric = 'section_score') AS section_score_z, min(z) FILTER (metric = 'section_time') AS section_time_z, min(z) FILTER (metric = 'question_accuracy') AS question_accuracy_z, min(CASE WHEN metric = 'section_score' THEN 'section_score:' || z.ref END) AS score_ref
    FROM (SELECT DISTINCT sk, k % 7 AS ref FROM e WHERE kind = 'signup') a LEFT JOIN z ON a.sk = z.sk AND a.ref = z.ref GROUP BY a.sk, a.ref""")
def j13_cohort_lookup(spark, sf_dir):
    """z scores of all sessions by metric and reference, looked up for the references that a session asks for."""
    rows = known(spark, sf_dir).withColumn("ref", F.col("k") % 5).withColumn("metric", pick(F.col("k"), ("section_score", "section_time", "question_accuracy")))
    cohort = stats.z_scores(rows.groupBy("sk", "metric", "ref").agg(F.avg("value").alias("v")), ["metric", "ref"], "v")
    asked = known(spark, sf_dir, "signup").select("sk", (F.col("k") % 7).alias("ref")).distinct()
    return observed.cohort_lookup(asked, cohort)


@query(f"""+ {KNOWN}, s AS (SELECT sk, ord, k % 4 AS f, t_ms AS s0, t_ms + {6 * HOUR} AS s1 FROM e WHERE kind = 'signup'), c AS (SELECT DISTINCT sk, 'f' || k % 6 AS factor_id, t_ms AS t0_ms, t_ms + {HOUR} AS t1_ms, k % 10 AS q FROM e WHERE kind = 'error')
    SELECT DISTINCT s.sk, s.ord, c.factor_id, c.t0_ms, c.t1_ms, c.q FROM s JOIN c ON s.sk = c.sk AND (c.factor_id = 'f' || s.f OR (c.t0_ms <= s.s1 AND c.t1_ms >= s.s0))""")
def j17_supporting_factors(spark, sf_dir):
    name = lambda c: F.concat(F.lit("f"), c.cast("string"))
    stories = known(spark, sf_dir, "signup").select("sk", "ord", F.array(name(F.col("k") % 4)).alias("factor_ids"), F.col("t_ms").alias("start_ms"), (F.col("t_ms") + 6 * HOUR).alias("end_ms"))
    found = known(spark, sf_dir, "error").select("sk", name(F.col("k") % 6).alias("factor_id"), F.col("t_ms").alias("t0_ms"), (F.col("t_ms") + HOUR).alias("t1_ms"), (F.col("k") % 10).alias("q"))
    return observed.supporting_factors(stories, found)


@query(f"""+ {KNOWN}, p AS (SELECT sk, kind, ord, t_ms, CASE k % 4 WHEN 0 THEN '' ELSE 'said ' || k % 5 END AS s, CASE k % 3 WHEN 0 THEN 'UNKNOWN' ELSE 'en' END AS lang, k % 8 = 0 AS mix FROM e),
    d AS (SELECT sk, kind, s, min((t_ms, ord)) AS o FROM p WHERE s <> '' GROUP BY sk, kind, s), j AS (SELECT sk, kind, string_agg(s, ' ' ORDER BY o) AS said FROM d GROUP BY sk, kind)
    SELECT p.sk, p.kind, CASE WHEN length(any_value(coalesce(j.said, ''))) > 20 THEN rtrim(substr(any_value(coalesce(j.said, '')), 1, 19)) || '…' ELSE any_value(coalesce(j.said, '')) END AS said, max(CASE WHEN lang = 'en' THEN lang END) AS language, bool_or(mix) AS code_mixing
    FROM p LEFT JOIN j ON p.sk = j.sk AND p.kind = j.kind GROUP BY p.sk, p.kind""")
def a17_speech_proof(spark, sf_dir):
    k = F.col("k")
    rows = known(spark, sf_dir).select(
        "sk", "kind", "ord", F.col("t_ms").alias("start_ms"), F.when(k % 4 == 0, "  ").otherwise(F.concat(F.lit(" said "), (k % 5).cast("string"))).alias("summary"), F.when(k % 3 == 0, "UNKNOWN").otherwise("en").alias("language"),
        F.lit("silence").alias("speech_class"), F.when(k % 8 == 0, "yes").otherwise("no").alias("code_mixing"),
    )
    return observed.speech_proof(rows, ["sk", "kind"], 20).drop("speech_class")


@query(f"""+ {KNOWN}, m AS (SELECT sk, count(*) AS n, avg(value) AS mean FROM e WHERE kind = 'purchase' GROUP BY sk), c AS (SELECT sk, avg(CASE WHEN k % 2 = 0 THEN 1.0::DOUBLE ELSE 0 END) AS usable_ratio FROM e WHERE kind = 'view' GROUP BY sk)
    SELECT m.sk, n, mean, usable_ratio, 'v1' AS baseline_version FROM m LEFT JOIN c USING (sk)""")
def a22_baseline(spark, sf_dir):
    metrics = stats.metric_series(known(spark, sf_dir, "purchase"), ["sk"], "value").select("sk", "n", "mean")
    coverage = known(spark, sf_dir, "view").groupBy("sk").agg(F.avg((F.col("k") % 2 == 0).cast("double")).alias("usable_ratio"))
    return observed.baseline(metrics, coverage, "v1")


@query(f"""+ {KNOWN}, w AS (SELECT sk, count(*) AS total, count_if(k % 3 <> 0) AS covered, avg(CASE WHEN k % 2 = 0 THEN 1.0::DOUBLE ELSE 0 END) AS u FROM e WHERE kind = 'view' GROUP BY sk),
    s AS (SELECT sk, count(*) AS chunks, sum(1000 * (k % 5 + 1)) AS ms FROM e WHERE kind = 'error' GROUP BY sk), x AS (SELECT DISTINCT sk, CASE WHEN sk % 4 = 0 THEN 0 ELSE 100000 END AS d FROM e)
    SELECT x.sk, coalesce(covered, 0) AS covered, coalesce(total, 0) AS total, coalesce(total, 0) - coalesce(covered, 0) AS unknown, coalesce(nullif(u, 0), 1) AS usable_ratio, coalesce(covered, 0) = 0 AS video_absent,
    CASE WHEN coalesce(covered, 0) = 0 THEN '0% video (modality absent)' ELSE CAST(CAST(round_even(100.0::DOUBLE * covered / total, 0) AS BIGINT) AS VARCHAR) || '% video (' || covered || '/' || total || ' windows)' END AS video_label,
    CASE WHEN chunks > 0 THEN CASE WHEN d > 0 THEN CAST(CAST(round_even(100.0::DOUBLE * ms / d, 0) AS BIGINT) AS VARCHAR) || '% screen (' || chunks || ' chunks)' ELSE 'screen recording present (' || chunks || ' chunks)' END END AS screen_label
    FROM x LEFT JOIN w USING (sk) LEFT JOIN s USING (sk)""")
def a23_confidence_panel(spark, sf_dir):
    k = F.col("k")
    seen = known(spark, sf_dir, "view").select("sk", (k % 3 != 0).alias("covered"), (k % 2 == 0).alias("usable"))
    screens = known(spark, sf_dir, "error").select("sk", F.col("t_ms").alias("start_ms"), (F.col("t_ms") + 1000 * (k % 5 + 1)).alias("end_ms"))
    sessions = known(spark, sf_dir).select("sk", F.when(F.col("sk") % 4 == 0, 0).otherwise(100_000).alias("duration_ms")).distinct()
    return observed.confidence_panel(seen, screens, sessions)


@query(f"""+ {KNOWN}, p AS (SELECT sk, ord, t_ms, 1000 * (k % 7) + k % 3 AS len, k, CASE k % 3 WHEN 0 THEN 'question ' || k % 600 WHEN 1 THEN 'Q#' || k % 9 ELSE 'none' END AS label FROM e WHERE kind = 'view')
    SELECT sk, ord, t_ms + CAST(round_even(len / 2.0::DOUBLE, 0) AS BIGINT) AS frame_ms, CAST(round_even(len / 2.0::DOUBLE, 0) AS BIGINT) AS local_ms, 'screen seq ' || k AS clip_label, CASE WHEN k % 2 = 0 THEN 'given' ELSE 'own' END AS excerpt,
    CASE WHEN k % 5 = 1 THEN 7 WHEN k % 3 = 0 AND k % 600 BETWEEN 1 AND 499 THEN k % 600 WHEN k % 3 = 1 AND k % 9 > 0 THEN k % 9 END AS question FROM p""")
def x56_screen_proof(spark, sf_dir):
    k = F.col("k")
    label = F.when(k % 3 == 0, F.concat(F.lit("question "), (k % 600).cast("string"))).when(k % 3 == 1, F.concat(F.lit("Q#"), (k % 9).cast("string"))).otherwise("none")
    proof = observed.screen_proof(F.col("t_ms"), F.col("t_ms") + 1000 * (k % 7) + k % 3, F.when(k % 2 == 0, "given").otherwise(""), F.lit("own"), F.when(k % 5 == 1, 7).otherwise(0), label, k)
    return known(spark, sf_dir, "view").select("sk", "ord", proof.alias("p")).select("sk", "ord", "p.*")


@query(f"""+ {KNOWN}, f AS (SELECT sk, t_ms AS t0, t_ms + CAST(floor(value * 1000) AS BIGINT) AS t1, CASE k % 4 WHEN 0 THEN 'suspicious_eye_movement' WHEN 1 THEN 'phone_usage' WHEN 2 THEN 'multiple_faces' ELSE 'ok' END AS et, CASE k % 3 WHEN 0 THEN 'candidate' WHEN 1 THEN 'environment' END AS who FROM e WHERE kind = 'view' AND k % 5 <> 0),
    s AS (SELECT sk, ord, 'sig' || ord AS sig, t_ms AS s0, t_ms + {40 * HOUR} AS s1 FROM e WHERE kind = 'signup'), k AS (SELECT *, row_number() OVER () AS rid FROM f WHERE et <> 'ok' AND NOT (et = 'suspicious_eye_movement' AND t1 - t0 < 15000) AND (et <> 'phone_usage' OR coalesce(who, 'candidate') = 'candidate'))
    SELECT k.sk, 'tbobs_' || et || '_' || t0 || '_' || t1 AS card_id, CASE et WHEN 'phone_usage' THEN 'Phone usage (candidate)' WHEN 'suspicious_eye_movement' THEN 'Sustained gaze' ELSE 'Multiple faces' END || ' · ' || CAST(round_even((t1 - t0) / 1000.0::DOUBLE, 0) AS BIGINT) || 's' AS title,
    t0 AS t0_ms, t1 - t0 AS duration_ms, arg_min(s.sig, s.ord) AS nested_under FROM k LEFT JOIN s ON k.sk = s.sk AND t0 < s.s1 AND t1 > s.s0 GROUP BY rid, k.sk, et, t0, t1""")
def p18_observation_cards(spark, sf_dir):
    k = F.col("k")
    found = known(spark, sf_dir, "view").select(
        "sk", F.col("t_ms").alias("t0_ms"), (F.col("t_ms") + F.floor(F.col("value") * 1000).cast("bigint")).alias("t1_ms"), pick(k, ("suspicious_eye_movement", "phone_usage", "multiple_faces", "ok")).alias("event_type"),
        F.when(k % 3 == 0, "candidate").when(k % 3 == 1, "environment").alias("attribution"), F.when(k % 5 == 0, "cleared").otherwise("flagged").alias("verdict"),
    )
    stories = known(spark, sf_dir, "signup").select("sk", "ord", F.concat(F.lit("sig"), F.col("ord").cast("string")).alias("signal_id"), F.col("t_ms").alias("start_ms"), (F.col("t_ms") + 40 * HOUR).alias("end_ms"))
    return observed.observation_cards(found, stories)


@query(f"""+ {KNOWN}, r AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY t_ms, k, ord) AS place FROM e WHERE kind = 'error') SELECT sk, ord, place FROM r""")
def p19_screen_spans(spark, sf_dir):
    rows = known(spark, sf_dir).withColumn("start_ms", F.col("t_ms"))
    return observed.first_chunk(rows, "error", ["start_ms", "k", "ord"]).select("sk", "ord", "place")


@query(f"""+ {KNOWN}, a AS (SELECT sk, ord, CASE kind WHEN 'view' THEN 'video' WHEN 'error' THEN 'screen' END AS et, k % 9 AS c FROM e WHERE kind IN ('view', 'error')), c AS (SELECT DISTINCT sk, k % 9 AS c FROM e WHERE kind = 'signup')
    SELECT a.sk, a.ord, a.et AS evidence_type, CASE WHEN c.c IS NOT NULL THEN 'u' || c.c END AS url FROM a LEFT JOIN c ON a.sk = c.sk AND a.c = c.c""")
def s11_media_index(spark, sf_dir):
    kind = F.when(F.col("kind") == "view", "video").when(F.col("kind") == "error", "screenRecording").otherwise("keystrokeData")
    rows = known(spark, sf_dir).select("sk", "ord", kind.alias("kind"), (F.col("k") % 9).alias("chunk_id"))
    chunks = known(spark, sf_dir, "signup").select("sk", (F.col("k") % 9).alias("chunk_id")).distinct().withColumn("url", F.concat(F.lit("u"), F.col("chunk_id").cast("string"))).withColumn("section_id", F.lit(None).cast("string"))
    return timeline.media_index(rows, chunks).select("sk", "ord", "evidence_type", "url")


@query(f"""+ {KNOWN}, s AS (SELECT DISTINCT sk FROM e), l AS (SELECT sk, min(t_ms) AS a FROM e WHERE kind = 'signup' AND k % 2 = 0 GROUP BY sk), v AS (SELECT sk, min(t_ms) AS b FROM e WHERE kind = 'purchase' AND k % 3 = 0 GROUP BY sk), c AS (SELECT sk, min(t_ms) AS d FROM e WHERE kind = 'view' GROUP BY sk)
    SELECT coalesce(l.sk, v.sk, c.sk) AS sk, coalesce(a, b, d) AS t0_ms, CASE WHEN a IS NOT NULL THEN 'activity_logs' WHEN b IS NOT NULL THEN 'fallback_events' ELSE 'fallback_chunk_epoch' END AS t0_source FROM l FULL JOIN v ON l.sk = v.sk FULL JOIN c ON coalesce(l.sk, v.sk) = c.sk""")
def t2_origin_cascade(spark, sf_dir):
    log = known(spark, sf_dir, "signup").filter("k % 2 = 0").select("sk", F.col("t_ms").alias("t0_ms"))
    chunks = known(spark, sf_dir, "view").select("sk", F.col("t_ms").alias("start_ms"))
    return timeline.origin_cascade(log, known(spark, sf_dir, "purchase").filter("k % 3 = 0").select("sk", "t_ms"), chunks)


LENGTHS = ("log", "video", "screen", "pages", "event", "manifest")


@query(f"""+ {KNOWN}, m AS (SELECT sk, """ + ", ".join(f"coalesce(max(CASE WHEN kind = '{kind}' AND sk % {n} <> 0 THEN k END), 0) AS {name}" for name, kind, n in zip(LENGTHS, ("signup", "view", "error", "purchase", "click", "view"), (2, 3, 5, 1, 7, 1))) + """ FROM e GROUP BY sk)
    SELECT sk, CASE WHEN log > 0 THEN greatest(log, video, screen) WHEN video > 0 THEN greatest(video, screen) WHEN screen > 0 THEN screen ELSE greatest(pages, event, manifest) END AS duration_ms,
    CASE WHEN log > 0 THEN 'activity_logs' WHEN video > 0 THEN 'video_chunks' WHEN screen > 0 THEN 'screen_chunks' WHEN pages > 0 THEN 'rrweb_chunks' ELSE 'none' END AS duration_source FROM m""")
def t3_duration_cascade(spark, sf_dir):
    parts = zip(LENGTHS, ("signup", "view", "error", "purchase", "click", "view"), (2, 3, 5, 1, 7, 1), strict=True)
    lengths = known(spark, sf_dir).groupBy("sk").agg(*[F.max(F.when((F.col("kind") == kind) & (F.col("sk") % n != 0), F.col("k"))).alias(f"{name}_ms") for name, kind, n in parts])
    return timeline.duration_cascade(lengths)


@query(f"""+ {KNOWN}, s AS (SELECT sk, ord AS c FROM e WHERE kind = 'view'), a AS (SELECT sk, ord AS c, k % 5 AS n FROM e WHERE kind = 'view' AND k % 3 <> 0), b AS (SELECT s.sk, count(*) AS total, count_if(a.c IS NOT NULL) AS covered FROM s LEFT JOIN a ON s.sk = a.sk AND s.c = a.c GROUP BY s.sk)
    SELECT sk, total, covered, CAST(covered AS DOUBLE) / total AS coverage_ratio FROM b WHERE covered > 0""")
def t7_t8_t11_assembled_recordings(spark, sf_dir):
    """Spans with their answers, coverage per session, and which results may be stored for reuse."""
    cuts = known(spark, sf_dir, "view").select("sk", F.col("ord").alias("chunk_id"), "k")
    answers = cuts.filter("k % 3 != 0").select("sk", "chunk_id", F.lit(True).alias("reviewed"), F.when(F.col("k") % 2 == 0, 0.9).alias("confidence"))
    return timeline.worth_storing(timeline.coverage(timeline.reviewed(cuts.drop("k"), answers)))


@query(f"""+ o AS (SELECT *, t_ms AS start_ms, t_ms + 3600000 AS end_ms FROM ev WHERE kind = 'view'), x AS (SELECT *, 'external_resource_open' AS et FROM o WHERE k % 2 = 0 UNION ALL SELECT *, 'screen_external_paste' FROM o WHERE k % 3 = 0),
    i AS (SELECT *, sum(f) OVER (PARTITION BY sk, et ORDER BY start_ms, ord) AS isl FROM (SELECT *, CASE WHEN start_ms - lag(end_ms) OVER (PARTITION BY sk, et ORDER BY start_ms, ord) <= 324000000 THEN 0 ELSE 1 END AS f FROM x)),
    g AS (SELECT sk, et, arg_max((start_ms + end_ms) // 2, (value, -ord)) AS mid, max(value) AS c FROM i GROUP BY sk, et, isl), s AS (SELECT sk, CASE et WHEN 'external_resource_open' THEN 'SCREEN_EXTERNAL_RESOURCE' ELSE 'SCREEN_EXTERNAL_PASTE' END AS kind, mid AS start_ms, 'screen' AS origin, CAST(NULL AS BIGINT) AS ord FROM g),
    u AS (SELECT * FROM s UNION ALL SELECT sk, 'CODE_SUBMISSION', t_ms, 'log', ord FROM ev WHERE kind = 'purchase')
    SELECT sk, kind, start_ms, origin, row_number() OVER (PARTITION BY sk ORDER BY start_ms, kind, origin, ord NULLS FIRST) AS n FROM u""")
def m12_m13_fact_bundle(spark, sf_dir):
    """Facts of screen episodes and of log rows in one order; the page's own facts are left out in screen mode."""
    rows = of_kind(events(spark, sf_dir), "view").withColumn("start_ms", F.col("t_ms")).withColumn("end_ms", F.col("t_ms") + HOUR)
    rows = rows.withColumn("confidence", F.col("value")).withColumn("a", F.col("k") % 2 == 0).withColumn("b", F.col("k") % 3 == 0)
    made = observed.screen_facts(findings.screen(rows, {"a": "external_resource_open", "b": "screen_external_paste"}, 90 * HOUR)).select("sk", "kind", "start_ms").withColumn("ord", F.lit(None).cast("bigint"))
    logged = of_kind(events(spark, sf_dir), "purchase").select("sk", F.lit("CODE_SUBMISSION").alias("kind"), F.col("t_ms").alias("start_ms"), "ord")
    return observed.fact_bundle({"screen": made, "log": logged, "page": logged}, screen_mode=True).select("sk", "kind", "start_ms", "origin", "n")


@query(f"""+ {KNOWN}, u AS (SELECT sk, t_ms, CASE WHEN k % 2 = 0 THEN t_ms + 5 END AS end_ms, CASE kind WHEN 'purchase' THEN 'submission' ELSE 'fact' END AS source, CASE kind WHEN 'purchase' THEN 'CODE_SUBMISSION' ELSE 'WINDOW_BLUR' END AS kind, 'fact:' || ord AS evidence_ref FROM e WHERE kind IN ('purchase', 'error')
    UNION ALL SELECT sk, t_ms, t_ms + 9, 'sqb', 'SQB_WINDOW', 'sqb:s=' || k % 3 || ':q=' || k % 10 FROM e WHERE kind = 'click' UNION ALL SELECT sk, t_ms, t_ms + 7, 'perception_episode', 'phone_usage', 'v' || ord FROM e WHERE kind = 'view' UNION ALL SELECT sk, t_ms, t_ms + 8, 'screen_episode', 'ai', 's' || ord FROM e WHERE kind = 'signup') SELECT * FROM u""")
def u1_event_union(spark, sf_dir):
    return built_timeline(spark, sf_dir).select("sk", "t_ms", "end_ms", "source", "kind", "evidence_ref")


def built_timeline(spark, sf_dir):
    k, name = F.col("k"), lambda p: F.concat(F.lit(p), F.col("ord").cast("string")).alias("evidence_ref")
    kind = F.when(F.col("kind") == "purchase", "CODE_SUBMISSION").when(F.col("kind") == "error", "WINDOW_BLUR").otherwise("EDIT")
    section = (k % 3).cast("string").alias("section_id")
    facts = known(spark, sf_dir, "purchase", "error", "click").select("sk", "ord", kind.alias("kind"), F.col("t_ms").alias("start_ms"), (F.col("t_ms") + F.when(k % 2 == 0, 5).otherwise(0)).alias("end_ms"), section)
    questions = known(spark, sf_dir, "click").select("sk", F.col("t_ms").alias("start_ms"), (F.col("t_ms") + 9).alias("end_ms"), section, (k % 10).alias("q"))
    found = lambda of, p, length, what: known(spark, sf_dir, of).select("sk", F.col("t_ms").alias("t0_ms"), (F.col("t_ms") + length).alias("t1_ms"), F.lit(what).alias("event_type"), name(p))
    return observed.timeline(facts, questions, found("view", "v", 7, "phone_usage"), found("signup", "s", 8, "ai"))


@query(f"""+ {KNOWN} SELECT sk, ord, CASE kind WHEN 'view' THEN 'video' ELSE 'keystroke' END AS track FROM e WHERE kind IN ('view', 'purchase')""")
def u2_all_findings(spark, sf_dir):
    part = lambda kind: known(spark, sf_dir, kind).select("sk", "ord")
    return observed.all_of({"video": part("view"), "keystroke": part("purchase")})


@query(f"""+ {KNOWN}, h AS (SELECT sk, ord, t_ms AS s, t_ms + {HOUR} AS e, value, CASE WHEN k % 3 <> 0 THEN 'c' || k END AS c FROM e WHERE kind = 'view' AND k % 2 = 0), i AS (SELECT *, sum(f) OVER (PARTITION BY sk ORDER BY s, ord) AS isl FROM (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY sk ORDER BY s, ord) <= {22 * HOUR} THEN 0 ELSE 1 END AS f FROM h))
    SELECT sk, 'phone_usage' AS event_type, min(s) AS t0_ms, max(e) AS t1_ms, 'perception:w=' || string_agg('w' || ord, '+' ORDER BY s, ord) AS evidence_ref, count(*) AS occurrences, arg_max(c, (value, -s, -ord)) FILTER (c IS NOT NULL) AS peak_chunk, arg_max(s, (value, -s, -ord)) FILTER (c IS NOT NULL) AS frame_ms FROM i GROUP BY sk, isl""")
def v9_finding_rows(spark, sf_dir):
    k = F.col("k")
    hits = known(spark, sf_dir, "view").filter("k % 2 = 0").select(
        "sk", "ord", F.lit("phone_usage").alias("event_type"), F.concat(F.lit("w"), F.col("ord").cast("string")).alias("window_id"), F.when(k % 3 != 0, F.concat(F.lit("c"), k.cast("string"))).alias("chunk_id"),
        F.col("t_ms").alias("start_ms"), (F.col("t_ms") + HOUR).alias("end_ms"), F.col("value").alias("confidence"),
    )
    return observed.finding_rows(hits, 22 * HOUR)


@query(f"""+ {KNOWN} SELECT sk, 'external_paste' AS event_type, t_ms AS start_ms, t_ms + 1000 AS end_ms, CASE WHEN k % 2 = 0 THEN 'high' ELSE 'medium' END AS severity, 'moderate' AS strength, 'machine_facts:t=' || t_ms || '-' || t_ms + 1000 || 'ms' AS evidence_ref, 'candidate' AS attribution, 'flagged' AS verdict,
    'mf_ks_' || row_number() OVER (PARTITION BY sk ORDER BY t_ms, ord) - 1 AS id FROM e WHERE kind = 'purchase'""")
def v12_keystroke_rows(spark, sf_dir):
    none = F.lit(None).cast("string")
    rows = known(spark, sf_dir, "purchase").select("sk", "ord", F.lit("external_paste").alias("event_type"), F.col("t_ms").alias("start_ms"), (F.col("t_ms") + 1000).alias("end_ms"), F.when(F.col("k") % 2 == 0, "high").alias("severity"), none.alias("strength"))
    return observed.keystroke_rows(rows)


PERSON = OBS.format(kind="signup").replace("ob AS (SELECT *,", "ob AS (SELECT * REPLACE (CASE WHEN kind IN ('signup', 'purchase') THEN 'signup' ELSE kind END AS kind),")


@query(f"""+ {PERSON}, v AS (SELECT *, CASE WHEN d < 3 THEN 'cleared:brief_appearance' WHEN c3 > 0 AND NOT b7 THEN 'cleared:official' WHEN b5 AND b7 THEN 'flagged' WHEN b5 THEN 'cleared:no_help_seen' WHEN b2 AND d >= 30 THEN 'flagged' END AS verdict FROM epi)
    SELECT sk, CASE WHEN b5 THEN 'external_help' ELSE 'multiple_faces' END AS event_type, split_part(verdict, ':', 1) AS outcome, CASE WHEN verdict <> 'flagged' THEN split_part(verdict, ':', 2) END AS reason, CASE WHEN verdict = 'flagged' THEN CASE WHEN b5 THEN 'high' ELSE 'medium' END END AS severity, t0_ms, t1_ms, d AS dur_sec FROM v WHERE verdict IS NOT NULL""")
def v2_second_person(spark, sf_dir):
    k, no = F.col("k"), F.lit(False)
    rows = observations(spark, sf_dir).withColumn("kind", F.when(F.col("kind") == "purchase", "signup").otherwise(F.col("kind")))
    flags = {"person_visible": F.col("kind") == "signup", "interacting": k % 5 == 0, "passing": no, "adjacent": k % 2 == 0, "staff": k % 3 == 0, "admin_speech": no, "integrity_speech": k % 7 == 0, "gaze_away": no, "reflection": no}
    return findings.second_person(rows.withColumns(flags), GAP)


@query(f"""+ {OBS.format(kind='click')}, t AS (SELECT h.sk, h.ep, count_if(k % 2 = 0) AS said FROM hit h GROUP BY h.sk, h.ep)
    SELECT e.sk, 'discussing_solution_audio' AS event_type, CASE WHEN said = 0 THEN 'unknown' WHEN b7 THEN 'flagged' ELSE 'contextual' END AS outcome, CASE WHEN said = 0 THEN 'no_summary' WHEN NOT b7 THEN 'ordinary_speech' END AS reason, CASE WHEN said > 0 AND b7 THEN 'high' END AS severity, t0_ms, t1_ms, d AS dur_sec FROM epi e JOIN t ON e.sk = t.sk AND e.ep = t.ep WHERE d >= 2""")
def v6_speech(spark, sf_dir):
    rows = observations(spark, sf_dir).withColumn("speech", F.col("kind") == "click").withColumn("summary", F.when(F.col("k") % 2 == 0, F.concat(F.lit("said "), F.col("k").cast("string"))).otherwise(""))
    return findings.speech(rows, GAP)


@query(f"""+ {KNOWN}, s AS (SELECT sk, ord, t_ms AS t_ms, greatest(t_ms, t_ms + {HOUR}) AS end_ms, 'correlated_signal' AS origin, 'f' || k % 4 AS label, k % 5 <> 0 AS timed FROM e WHERE kind = 'error'
    UNION ALL SELECT sk, ord, t_ms, t_ms + 1000 * (k % 5), 'video_episode', 'phone_usage', true FROM e WHERE kind = 'view' AND k % 2 = 0
    UNION ALL SELECT sk, ord, t_ms, t_ms + 2000, 'video_episode', 'unknown_speech', true FROM e WHERE kind = 'signup' AND k % 2 = 0
    UNION ALL SELECT sk, ord, t_ms, t_ms, 'machine_fact', 'LARGE_PASTE', true FROM e WHERE kind = 'purchase') SELECT * FROM s""")
def r1_episode_seeds(spark, sf_dir):
    return seed_rows(spark, sf_dir).select("sk", "ord", "t_ms", "end_ms", "origin", "label", "timed")


def seed_rows(spark, sf_dir):
    k = F.col("k")
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    none = F.lit(None).cast("string")
    given = known(spark, sf_dir, "error").select("sk", "ord", F.col("t_ms").alias("t0_ms"), (F.col("t_ms") + HOUR).alias("t1_ms"), text("f", k % 4).alias("factor_id"), text("c:", F.col("ord")).alias("ref"), none.alias("section_id"), (k % 10).alias("q"), (k % 5 == 0).alias("cohort_only"))
    found = known(spark, sf_dir, "view").select("sk", "ord", F.col("t_ms").alias("t0_ms"), (F.col("t_ms") + 1000 * (k % 5)).alias("t1_ms"), F.lit("phone_usage").alias("event_type"), text("perception:w=w", F.col("ord")).alias("evidence_ref"), F.when(k % 2 == 0, "flagged").otherwise("cleared").alias("verdict"))
    unsure = known(spark, sf_dir, "signup").select("sk", "ord", F.col("t_ms").alias("t0_ms"), (F.col("t_ms") + 2000).alias("t1_ms"), none.alias("event_type"), F.when(k % 2 == 0, F.array(text("w", F.col("ord")))).otherwise(F.array().cast("array<string>")).alias("windows"), none.alias("reason"))
    facts = known(spark, sf_dir, "purchase", "click").select("sk", "ord", F.when(F.col("kind") == "purchase", "LARGE_PASTE").otherwise("EDIT").alias("kind"), F.col("t_ms").alias("start_ms"), F.lit(None).cast("bigint").alias("end_ms"), none.alias("section_id"), (k % 10).alias("q"))
    return deliberate.seeds(given, found, unsure, facts)


@query(f"""+ {KNOWN}, s AS (SELECT sk, ord, t_ms AS a, t_ms + {HOUR} AS b, 0 AS turn, 'correlated_signal' AS origin, k % 5 <> 0 AS timed FROM e WHERE kind = 'error' UNION ALL SELECT sk, ord, t_ms, t_ms + 1000 * (k % 5), 1, 'video_episode', true FROM e WHERE kind = 'view' AND k % 2 = 0
    UNION ALL SELECT sk, ord, t_ms, t_ms + 2000, 2, 'video_episode', true FROM e WHERE kind = 'signup' AND k % 2 = 0 UNION ALL SELECT sk, ord, t_ms, t_ms, 3, 'machine_fact', true FROM e WHERE kind = 'purchase'),
    r AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY a, b, turn, ord) AS rn FROM s WHERE timed),
    st AS (SELECT sk, rn AS i, rn AS c, a AS t0, b AS t1, origin AS o FROM r WHERE rn = 1 UNION ALL SELECT sk, rn, CASE WHEN j THEN c ELSE rn END, CASE WHEN j THEN t0 ELSE a END, CASE WHEN j THEN greatest(t1, b) ELSE b END, origin
        FROM (SELECT st.*, r.rn, r.a, r.b, r.origin, r.a <= st.t1 + {30 * HOUR} AND greatest(st.t1, r.b) - st.t0 <= {90 * HOUR} AS j FROM st JOIN r ON r.sk = st.sk AND r.rn = st.i + 1)),
    g AS (SELECT sk, c, min(t0) AS t0, max(t1) AS t1, count(DISTINCT o) AS m FROM st GROUP BY sk, c), k AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY sk ORDER BY m DESC, t1 - t0 DESC, t0) <= 10),
    f AS (SELECT k.sk, k.c, count(DISTINCT e.kind) AS kinds FROM k JOIN e ON e.sk = k.sk AND e.kind IN ('purchase', 'click') AND e.t_ms BETWEEN k.t0 AND k.t1 GROUP BY k.sk, k.c),
    w AS (SELECT k.sk, k.c, count(*) AS n FROM k JOIN e ON e.sk = k.sk AND e.kind = 'view' AND e.k % 3 = 0 AND e.t_ms <= k.t1 AND k.t0 <= e.t_ms + 500 GROUP BY k.sk, k.c),
    l AS (SELECT k.sk, k.c, CASE WHEN bool_or(e.k % 4 = 0) THEN 'red' WHEN bool_or(e.k % 4 = 1) THEN 'amber' ELSE 'green' END AS lane FROM k JOIN e ON e.sk = k.sk AND e.kind = 'click' AND e.k % 7 = 0 AND e.t_ms <= k.t1 AND k.t0 <= e.t_ms WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.sk = k.sk AND st.c = k.c AND st.o = 'correlated_signal') GROUP BY k.sk, k.c),
    u AS (SELECT k.sk, 'timed' AS scope, k.t0 AS t0_ms, k.t1 AS t1_ms, k.m AS modalities, coalesce(f.kinds, 0) AS n_kinds, l.lane, w.n AS n_met, 0 AS turn, k.t0 AS o1, 0 AS o2 FROM k LEFT JOIN f ON f.sk = k.sk AND f.c = k.c LEFT JOIN w ON w.sk = k.sk AND w.c = k.c LEFT JOIN l ON l.sk = k.sk AND l.c = k.c
        UNION ALL SELECT sk, 'session', 0, 0, 1, 0, NULL, NULL, 1, 0, ord FROM s WHERE NOT timed)
    SELECT sk, scope, t0_ms, t1_ms, modalities, n_kinds, n_met, lane, 'ep' || row_number() OVER (PARTITION BY sk ORDER BY turn, o1, o2) AS episode_id FROM u""")
def r2_episode_inventory(spark, sf_dir):
    """Ten timed episodes at most; unsure speech makes an episode amber where no chain gives its lane, which this check leaves out."""
    got = inventory(spark, sf_dir)
    return got.select(
        "sk", "scope", "t0_ms", "t1_ms", F.col("modalities").cast("bigint").alias("modalities"), F.size("fact_kinds").cast("bigint").alias("n_kinds"),
        F.when(F.exists("window_ids", lambda w: F.startswith(w, F.lit("v"))), F.size("window_ids").cast("bigint")).alias("n_met"), "lane", "episode_id",
    )


def inventory(spark, sf_dir):
    k = F.col("k")
    facts = known(spark, sf_dir, "purchase", "click").select("sk", "ord", "kind", F.col("t_ms").alias("start_ms"))
    seen = known(spark, sf_dir, "view").select("sk", F.concat(F.lit("v"), F.col("ord").cast("string")).alias("window_id"), F.col("t_ms").alias("start_ms"), (F.col("t_ms") + 500).alias("end_ms"), (k % 3 == 0).alias("eligible"))
    found = known(spark, sf_dir, "view").filter("k % 2 = 0").select("sk", F.lit("phone_usage").alias("event_type"), F.col("t_ms").alias("t0_ms"), F.col("t_ms").alias("t1_ms"), F.lit("strong").alias("strength"), F.lit(False).alias("gaze_diverted"))
    chains = known(spark, sf_dir, "click").filter("k % 7 = 0").select("sk", F.lit("none").alias("factor_id"), F.col("t_ms").alias("t0_ms"), F.col("t_ms").alias("t1_ms"), pick(k, ("red", "amber", "green", "green")).alias("lane"))
    seeds = seed_rows(spark, sf_dir).withColumn("lane", F.lit(None).cast("string"))
    return deliberate.inventory(seeds, facts, seen, found, chains, most=10, gap_ms=30 * HOUR, span_ms=90 * HOUR)


@query(f"""+ {KNOWN}, ep AS (SELECT sk, ord, 'ep' || ord AS id FROM e WHERE kind = 'signup'), a AS (SELECT *, k % 2 = 0 AS we FROM e WHERE kind = 'signup' AND k % 3 <> 0), m AS (SELECT sk, 'ep' || ord AS id, 's' || ord AS sid FROM e WHERE kind = 'signup' AND k % 4 = 0)
    SELECT ep.sk, ep.id AS episode_id, 'timed' AS scope, CASE WHEN a.ord IS NULL THEN '' ELSE 'sum' || a.ord END AS summary, CASE WHEN a.ord IS NULL THEN 'none' ELSE 'pasting' END AS behaviour, m.sid IS NOT NULL AS emits,
    CASE WHEN m.sid IS NOT NULL THEN NULL WHEN a.ord IS NULL THEN 'not adjudicated by model' WHEN NOT a.we THEN 'why' ELSE 'candidate signal did not pass deterministic validation' END AS reason, coalesce(m.sid, '') AS signals FROM ep LEFT JOIN a ON a.sk = ep.sk AND a.ord = ep.ord LEFT JOIN m ON m.sk = ep.sk AND m.id = ep.id""")
def r3_adjudication_entries(spark, sf_dir):
    name = lambda p: F.concat(F.lit(p), F.col("ord").cast("string"))
    rows = known(spark, sf_dir, "signup").withColumn("episode_id", name("ep"))
    said = rows.filter("k % 3 != 0").select("sk", "episode_id", name("sum").alias("summary"), F.lit("pasting").alias("behaviour"), (F.col("k") % 2 == 0).alias("will_emit"), F.lit("why").alias("reason"))
    emitted = rows.filter("k % 4 = 0").select("sk", "episode_id", name("s").alias("signal_id"))
    got = deliberate.entries(rows.select("sk", "episode_id", F.lit("timed").alias("scope")), said, emitted)
    return got.withColumn("signals", F.array_join("signal_ids", ",")).drop("signal_ids")


@query(f"""+ {KNOWN}, p AS (SELECT sk, CASE k % 3 WHEN 0 THEN 'honest' WHEN 1 THEN 'assisted' ELSE 'suspicious' END AS r, k % 4 AS s, CAST(floor(value) AS BIGINT) AS c FROM e WHERE kind IN ('signup', 'error'))
    SELECT sk, CASE WHEN count_if(r <> 'honest') = 0 THEN 'CLEAR' WHEN bool_or(r = 'assisted') AND count(DISTINCT s) FILTER (r <> 'honest') >= 2 THEN 'STRONG_EVIDENCE' ELSE 'REVIEW_REQUIRED' END AS category, coalesce(max(c) FILTER (r <> 'honest'), 0) AS confidence FROM p GROUP BY sk""")
def r20_category(spark, sf_dir):
    k = F.col("k")
    rows = known(spark, sf_dir, "signup", "error").select("sk", pick(k, ("honest", "assisted", "suspicious")).alias("resolution"), F.array((k % 4).cast("string")).alias("sources"), F.floor("value").alias("confidence"))
    return deliberate.category(rows)


@query(f"""+ {KNOWN} SELECT sk, ord, kind AS event_type, CASE WHEN k % 2 = 0 THEN k ELSE 0 END AS clip_start_ms, 0 AS clip_end_ms, 's' || k AS said FROM e WHERE kind = 'signup'""")
def r24_contextual_rows(spark, sf_dir):
    proof = F.struct(F.concat(F.lit("s"), F.col("k").cast("string")).alias("said"), F.lit("en").alias("language"), F.lit(False).alias("code_mixing"))
    rows = known(spark, sf_dir, "signup").select("sk", F.col("kind").alias("event_type"), F.col("ord").alias("t0_ms"), F.col("t_ms").alias("t1_ms"), F.when(F.col("k") % 2 == 0, F.col("k")).alias("clip_start_ms"), F.lit(None).cast("bigint").alias("clip_end_ms"), proof.alias("proof"))
    return deliberate.contextual_rows(rows).select("sk", F.col("t0_ms").alias("ord"), "event_type", "clip_start_ms", "clip_end_ms", "said")


@query(f"""+ {KNOWN}, p AS (SELECT *, CASE WHEN sk % 3 = 0 AND k % 2 = 0 THEN 'r' || k % 4 END AS r, CASE WHEN k % 5 <> 0 THEN 'h' || k % 6 ELSE 'label' END AS h FROM e WHERE kind = 'signup'),
    g AS (SELECT sk, r AS x, min(ord) AS o, 0 AS t FROM p WHERE r IS NOT NULL GROUP BY sk, r UNION ALL SELECT sk, h, min(ord), 1 FROM p GROUP BY sk, h), c AS (SELECT *, min(t) OVER (PARTITION BY sk) AS best FROM g)
    SELECT sk, array_to_string(list(x ORDER BY o)[1:5], ',') AS reasons FROM c WHERE t = best GROUP BY sk""")
def r25_key_reasons(spark, sf_dir):
    k = F.col("k")
    given = F.when((F.col("sk") % 3 == 0) & (k % 2 == 0), F.array(F.concat(F.lit("r"), (k % 4).cast("string"))))
    rows = known(spark, sf_dir, "signup").select("sk", "ord", given.alias("reasons"), F.when(k % 5 != 0, F.concat(F.lit("h"), (k % 6).cast("string"))).alias("headline"), F.lit("label").alias("label"))
    return deliberate.key_reasons(rows).select("sk", F.array_join("reasons", ",").alias("reasons"))


@query(f"""+ {KNOWN} SELECT sk, ord, 'Head ' || k AS headline, CASE k % 3 WHEN 0 THEN 'probable' ELSE 'suspicious' END AS severity, CASE WHEN k % 4 = 0 THEN 'Reviewer should inspect the attached proof.' ELSE 'why' END AS why, k || ',7' AS questions, CASE WHEN k % 2 = 0 THEN 'w' || k ELSE 'w1,w' || k END AS windows
    FROM e WHERE kind = 'signup' AND k % 5 <> 0 AND k % 7 <> 0""")
def s9_stories(spark, sf_dir):
    """Stories as JSON text: every fifth has no headline, every seventh repeats a detector's words, windows come as a list or in an object."""
    k = F.col("k").cast("string")
    anchors = F.when(F.col("k") % 2 == 0, F.concat(F.lit('[" "," w'), k, F.lit('"]'))).otherwise(F.concat(F.lit('{"windowIds":["w1","w'), k, F.lit('",""]}')))
    head = F.when(F.col("k") % 5 == 0, F.lit(" ")).otherwise(F.concat(F.lit("Head "), k))
    what = F.when(F.col("k") % 7 == 0, "seen within 30 ms) twice").otherwise("seen")
    raw = F.concat(
        F.lit('{"headline":"'), head, F.lit('","what_happened":"'), what, F.lit('","whyItMatters":"'), F.when(F.col("k") % 4 == 0, "").otherwise("why"), F.lit('","severity":"'), F.when(F.col("k") % 3 == 0, "Probable").otherwise("other"),
        F.lit('","involvedQuestions":['), k, F.lit(',"7","x",true],"proofAnchors":'), anchors, F.lit("}"),
    )
    rows = known(spark, sf_dir, "signup").select("sk", "ord", deliberate.story(raw).alias("s")).filter("s is not null")
    return rows.select("sk", "ord", "s.headline", "s.severity", "s.why", F.array_join(F.col("s.questions").cast("array<string>"), ",").alias("questions"), F.array_join("s.window_ids", ",").alias("windows"))


@query(f"""+ {KNOWN} SELECT sk, ord, CASE WHEN k % 2 = 0 THEN 'machine_fact,' ELSE '' END || CASE WHEN k % 3 = 0 THEN 'audio_observation' ELSE 'visual_observation' END AS sources, CASE WHEN k % 4 = 0 THEN 3 ELSE t_ms END AS start_ms, CASE WHEN k % 4 = 0 THEN 9 ELSE t_ms + 5 END AS end_ms,
    CASE WHEN k % 4 = 0 THEN 6.0::DOUBLE ELSE (2 * t_ms + 5) / 2.0::DOUBLE END AS mid_ms, CASE k % 3 WHEN 0 THEN 'screen_observation' WHEN 1 THEN 'machine_fact' ELSE 'visual_observation' END AS source FROM e WHERE kind = 'error'""")
def x37_x39_x40_x55_signal_scalars(spark, sf_dir):
    k, t = F.col("k"), F.col("t_ms").cast("string")
    none = F.array().cast("array<string>")
    seen = F.array(F.concat(F.lit("w_"), t, F.lit("_"), (F.col("t_ms") + 5).cast("string"), F.when(k % 3 == 0, ".audio.speechPresent=yes").otherwise(".hands.handCount=2")), F.lit("w1.people.x=y"))
    hints = F.when(k % 4 == 0, F.array(F.lit(9).cast("bigint"), F.lit(3).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    rows = known(spark, sf_dir, "error").withColumn("r", deliberate.time_range(hints, seen))
    kinds = deliberate.source_types(F.when(k % 2 == 0, F.array(F.lit("PASTE"))).otherwise(none), seen, none)
    return rows.select("sk", "ord", F.array_join(kinds, ",").alias("sources"), "r.start_ms", "r.end_ms", deliberate.midpoint(F.col("r.start_ms"), F.col("r.end_ms")).alias("mid_ms"), deliberate.finding_source(pick(k, ("screen", "keystroke", "video"))).alias("source"))


@query(f"""+ {KNOWN} SELECT sk, ord, CASE k % 3 WHEN 0 THEN k || ',7,2' WHEN 1 THEN k || '' ELSE '' END AS ints, CASE k % 2 WHEN 0 THEN 'a,b' ELSE 'one' END AS texts FROM e WHERE kind = 'click'""")
def x36_list_coercions(spark, sf_dir):
    k = F.col("k").cast("string")
    ints = F.when(F.col("k") % 3 == 0, F.concat(F.lit("["), k, F.lit(', " 7 ", 2.9, true, "x", null]'))).when(F.col("k") % 3 == 1, k).otherwise("true")
    texts = F.when(F.col("k") % 2 == 0, '[" a ", "", null, "b"]').otherwise(" one ")
    show = lambda c: F.array_join(c.cast("array<string>"), ",")
    return known(spark, sf_dir, "click").select("sk", "ord", show(deliberate.int_list(ints)).alias("ints"), show(deliberate.str_list(texts)).alias("texts"))


@query(f"""+ {KNOWN} SELECT sk, ord, CASE k % 3 WHEN 0 THEN t_ms // 1000 * 1000 - 19800000 WHEN 1 THEN t_ms // 1000 * 1000 + 250 ELSE t_ms END AS ms FROM e""")
def x10_submission_clock(spark, sf_dir):
    """Naive texts lose their fraction and are five and a half hours ahead; texts with a zone and numbers stay as they are."""
    at = F.timestamp_seconds(F.floor(F.col("t_ms") / 1000).cast("bigint"))
    text = F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss")
    value = F.when(F.col("k") % 3 == 0, F.concat(text, F.lit(".987"))).when(F.col("k") % 3 == 1, F.concat(text, F.lit(".250Z"))).otherwise(F.col("t_ms").cast("string"))
    return known(spark, sf_dir).select("sk", "ord", urls.submission_ms(value).alias("ms"))


@query(f"""+ {KNOWN} SELECT sk, ord, CASE WHEN k % 3 = 0 THEN CAST(k AS DOUBLE) END AS spent, CASE WHEN k % 2 = 0 THEN t_ms ELSE 0 END AS clock FROM e""")
def x52_x53_clocks(spark, sf_dir):
    k = F.col("k")
    spent = observed.time_spent(F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, (-k - 1).cast("string")).otherwise("soon"))
    chunk = F.concat(F.lit("video-"), F.when(k % 2 == 0, F.col("t_ms").cast("string")).otherwise("x"))
    return known(spark, sf_dir).select("sk", "ord", spent.alias("spent"), F.coalesce(urls.chunk_clock(chunk)["epoch_ms"], F.lit(0)).alias("clock"))


def behaviour_inputs(spark, sf_dir):
    """The detectors' events as they come from their sources: facts, question windows, camera findings (some cleared) and screen episodes."""
    rows = events(spark, sf_dir).filter("t_ms is not null").selectExpr("*", "string(k % 3) as section_id", "k % 10 as k10", "bigint(floor(value * 360000)) as length")
    rows = rows.withColumn("before_ms", F.expr("lag(t_ms) over (partition by sk, kind in ('click', 'purchase') order by t_ms, ord)"))
    fact = lambda when, kind, start="t_ms", q="k10": f"if({when}, named_struct('kind', '{kind}', 'start_ms', {start}, 'end_ms', t_ms, 'q', bigint({q}), 'chars', bigint(floor(value))), null)"
    made = [
        fact("kind = 'error'", "WINDOW_BLUR"), fact("kind = 'purchase'", "LARGE_PASTE"), fact("kind = 'purchase' and k % 2 = 0", "CODE_SUBMISSION"),
        fact("kind = 'click' and k % 2 = 0", "MCQ_ANSWER_SELECTED"), fact("kind = 'click' and k % 2 = 1", "TEXT_CORRECTION"),
        fact(f"kind in ('click', 'purchase') and t_ms - before_ms >= {10 * HOUR}", "ACTIVITY_GAP", "before_ms", "null"),
    ]
    facts = rows.selectExpr("sk", "ord", "section_id", f"inline(array_compact(array({', '.join(made)})))")
    questions = rows.filter("kind = 'click'").selectExpr("sk", "ord", "t_ms - length as start_ms", "t_ms as end_ms", "section_id", "k10 as q", "k % 5 = 0 as hard")
    seen = lambda when, kind, outcome="flagged": f"if({when}, named_struct('event_type', '{kind}', 'outcome', '{outcome}'), null)"
    camera = [
        seen("kind = 'view'", "suspicious_eye_movement"), seen("kind = 'view' and k % 3 = 0", "phone_usage"), seen("kind = 'view' and k % 3 = 1", "multiple_faces"),
        seen("kind = 'signup' and k % 2 = 0", "whispering"), seen("kind = 'signup' and k % 2 = 1", "discussing_solution_audio"), seen("kind = 'error'", "no_candidate"),
        seen("kind = 'click' and k % 7 = 0", "phone_usage", "cleared"),
    ]
    found = rows.selectExpr("sk", "t_ms as t0_ms", "t_ms + length as t1_ms", "concat('perc_', ord) as id", f"inline(array_compact(array({', '.join(camera)})))")
    screens = rows.filter("kind = 'view' and k % 4 = 1").selectExpr("sk", "'external_resource_open' as event_type", "t_ms as t0_ms", "t_ms + length as t1_ms", "0.9D as confidence", "t_ms + length div 2 as peak_ms")
    return facts, questions, found, screens


#: The bindings' tables, but bursts are of answers, as on a timeline.
ON_TIMELINE = risk_queries.TABLES.replace("FROM ev WHERE kind = 'click')", "FROM ev WHERE kind = 'click' AND k % 2 = 0)")


@query(f"+ {ON_TIMELINE}, {risk_queries.ALL_BEST} SELECT sk, factor_id, t0_ms, t1_ms, q, score_milli FROM best")
def t9_behaviour(spark, sf_dir):
    """All detectors over the timeline of stored facts, questions, camera findings and screen episodes."""
    facts, questions, found, screens = behaviour_inputs(spark, sf_dir)
    flagged = found.filter("outcome = 'flagged'").withColumn("evidence_ref", F.concat(F.lit("video:"), F.col("id")))
    return review.behaviour(facts, questions, flagged, screens, risk_queries.CONFIG)[1]


@query(f"""+ {ON_TIMELINE}, {risk_queries.ALL_BEST}, s AS (SELECT DISTINCT sk FROM ev), t AS (SELECT sk, CAST(least(100000, sum(score_milli)) AS BIGINT) AS m, count(*) AS n FROM best GROUP BY sk),
    fs AS (SELECT sk, count(*) AS n FROM (SELECT sk FROM blur UNION ALL SELECT sk FROM input UNION ALL SELECT sk FROM submission UNION ALL SELECT sk FROM correction UNION ALL SELECT sk FROM gap) GROUP BY sk),
    found AS (SELECT sk, count(*) AS n FROM (SELECT sk FROM gaze UNION ALL SELECT sk FROM phone UNION ALL SELECT sk FROM person UNION ALL SELECT sk FROM speech UNION ALL SELECT sk FROM absence UNION ALL SELECT sk FROM pt WHERE kind = 'click' AND k % 7 = 0) GROUP BY sk),
    scr AS (SELECT sk, count(*) AS n FROM pt WHERE kind = 'view' AND k % 4 = 1 GROUP BY sk), qs AS (SELECT sk, count(*) AS n FROM question GROUP BY sk)
    SELECT s.sk, coalesce(m, 0) AS total_milli, coalesce(t.n, 0) AS n_contributions, coalesce(fs.n, 0) AS n_facts, coalesce(found.n, 0) AS n_findings, coalesce(scr.n, 0) AS n_screens, coalesce(qs.n, 0) AS n_questions
    FROM s LEFT JOIN t USING (sk) LEFT JOIN fs USING (sk) LEFT JOIN found USING (sk) LEFT JOIN scr USING (sk) LEFT JOIN qs USING (sk)""")
def t12_review(spark, sf_dir):
    """The whole review of all sessions, checked by its score and the sizes of its sections."""
    whole = review.review(events(spark, sf_dir).select("sk").distinct(), *behaviour_inputs(spark, sf_dir), risk_queries.CONFIG)
    size = lambda c: F.size(c).cast("bigint")
    sizes = {"n_facts": "facts", "n_findings": "findings", "n_screens": "screen_episodes", "n_questions": "questions"}
    return whole.select("sk", "total_milli", "n_contributions", *[size(c).alias(n) for n, c in sizes.items()])


def perceived(spark, sf_dir):
    """Camera observations: phones in the hand or beside it, absent faces, people, speech, by kind and number."""
    k = F.col("k")
    kind = F.when(F.col("kind") == "view", "phone_visible").when(F.col("kind") == "error", "face_absent").when(F.col("kind") == "signup", "speech").when(F.col("kind") == "purchase", "second_person_present").otherwise("sustained_gaze")
    attrs = F.create_map(
        F.lit("objectInHand"), F.when((F.col("kind") == "view") & (k % 5 == 0), "phone").otherwise("UNKNOWN"), F.lit("speechContentClass"), F.when(F.col("kind") == "signup", pick(k, SPEECH)).otherwise("UNKNOWN"),
        F.lit("conversationSummaryEn"), F.when(k % 2 == 0, "talk").otherwise("UNKNOWN"), F.lit("secondPersonInteracting"), F.when((F.col("kind") == "purchase") & (k % 3 == 0), "yes").otherwise("UNKNOWN"),
    )
    rows = known(spark, sf_dir).select(
        "sk", "ord", F.concat(F.lit("c"), F.col("ord").cast("string")).alias("chunk_id"), F.col("t_ms").alias("start_ms"), (F.col("t_ms") + F.floor(F.col("value") * 360).cast("bigint") + 4000).alias("end_ms"), kind.alias("kind"), attrs.alias("attrs"),
        (F.col("value") / 100).alias("confidence"), pick(k, ("NONE", "LOW", "MEDIUM", "HIGH")).alias("tier"),
    )
    seen = perception.observations(rows, "ord")
    return seen.withColumn("phase", F.when(F.col("ord") % 7 == 0, "setup_verification").otherwise("live_exam"))


@query(f"""+ {KNOWN}, h AS (SELECT sk, ord, k, t_ms AS s, t_ms + CAST(floor(value * 360) AS BIGINT) + 4000 AS f FROM e WHERE kind = 'view' AND ord % 7 <> 0 AND k % 4 <> 0 AND value / 100 >= 0.3),
    i AS (SELECT *, sum(x) OVER (PARTITION BY sk ORDER BY s, ord) AS isl FROM (SELECT *, CASE WHEN s - lag(f) OVER (PARTITION BY sk ORDER BY s, ord) <= 22000 THEN 0 ELSE 1 END AS x FROM h))
    SELECT sk, CASE WHEN bool_or(k % 5 = 0) THEN 'flagged' ELSE 'cleared' END AS outcome, min(s) AS t0_ms, max(f) AS t1_ms FROM i GROUP BY sk, isl""")
def v8_video_findings(spark, sf_dir):
    """The camera driver from projected events to numbered findings; the oracle says what its phones are."""
    found = observed.video_findings(observed.observation_flags(perceived(spark, sf_dir)))
    return found.filter("event_type = 'phone_usage'").select("sk", "outcome", "t0_ms", "t1_ms")
