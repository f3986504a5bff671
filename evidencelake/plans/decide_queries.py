"""Classifiers, verdicts and scores over binding E."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidencelake.plans import decide, findings
from evidencelake.plans.registry import HOUR, events, of_kind, query, spans

GAP = 22 * HOUR

OBS = """ob AS (SELECT *, t_ms AS start_ms, t_ms + CAST(floor(value * 36000) AS BIGINT) AS end_ms FROM ev),
hit AS (SELECT *, sum(o) OVER (PARTITION BY sk ORDER BY start_ms, ord) AS ep FROM (SELECT *, CASE WHEN start_ms - lag(end_ms) OVER (PARTITION BY sk ORDER BY start_ms, ord) <= 79200000 THEN 0 ELSE 1 END AS o FROM ob WHERE kind = '{kind}')),
un AS (SELECT *, sum(o2) OVER (PARTITION BY sk, ep ORDER BY start_ms, end_ms, ord) AS piece FROM (SELECT *, CASE WHEN start_ms <= max(end_ms) OVER (PARTITION BY sk, ep ORDER BY start_ms, end_ms, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS o2 FROM hit WHERE end_ms > start_ms)),
ln AS (SELECT sk, ep, CAST(sum(l) AS BIGINT) AS len FROM (SELECT sk, ep, max(end_ms) - min(start_ms) AS l FROM un GROUP BY sk, ep, piece) GROUP BY sk, ep),
epi AS (SELECT h.sk, h.ep, min(start_ms) AS t0_ms, max(end_ms) AS t1_ms, count(*) AS n, CAST(count_if(k % 3 = 0) AS BIGINT) AS c3, bool_or(k % 5 = 0) AS b5, bool_or(k % 7 = 0) AS b7, bool_or(k % 2 = 0) AS b2,
    CAST(round_even(coalesce(any_value(len), 0) / 1000.0::DOUBLE, 0) AS BIGINT) AS d FROM hit h LEFT JOIN ln ON h.sk = ln.sk AND h.ep = ln.ep GROUP BY h.sk, h.ep)"""


def observations(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("start_ms", F.col("t_ms"))
    rows = rows.withColumn("end_ms", F.col("t_ms") + F.floor(F.col("value") * 36_000).cast("bigint"))
    k, kind = F.col("k"), F.col("kind")
    flags = {
        "face_absent": kind == "error", "capture_issue": k % 3 == 0, "left_seat": k % 5 == 0, "left_fully": k % 7 == 0,
        "phone_visible": kind == "view", "in_hand": k % 5 == 0, "earphone": kind == "click", "integrity_speech": k % 7 == 0, "speech": k % 2 == 0, "lip_mismatch": k % 5 == 0,
        "off_camera": F.lit(False), "ringtone": F.lit(False),
    }
    return rows.withColumns(flags)


@query(f"""+ {OBS.format(kind='error')}, v AS (SELECT *, 2 * c3 >= n AND NOT b5 AS mostly FROM epi)
    SELECT sk, CASE WHEN b5 AND NOT mostly AND d >= 5 THEN CASE WHEN b7 THEN 'left_examination_area' ELSE 'left_seat_body_present' END ELSE 'no_candidate' END AS event_type,
    CASE WHEN mostly OR d < 3 OR (b5 AND d < 5) THEN 'cleared' ELSE 'flagged' END AS outcome,
    CASE WHEN mostly THEN 'capture_quality_issue' WHEN d < 3 THEN 'brief_look_away' WHEN b5 AND d < 5 THEN 'brief_seat_movement' END AS reason,
    CASE WHEN mostly OR d < 3 OR (b5 AND d < 5) THEN NULL WHEN b5 AND b7 THEN 'high' WHEN b5 THEN CASE WHEN d >= 30 THEN 'high' ELSE 'medium' END WHEN d >= 120 THEN 'high' WHEN d >= 30 THEN 'medium' ELSE 'low' END AS severity,
    t0_ms, t1_ms, d AS dur_sec FROM v""")
def v1_face(spark, sf_dir):
    return findings.face(observations(spark, sf_dir), GAP)


@query(f"""+ {OBS.format(kind='view')} SELECT sk, 'phone_usage' AS event_type, CASE WHEN b5 THEN 'flagged' ELSE 'cleared' END AS outcome, CASE WHEN NOT b5 THEN 'not_in_hand' END AS reason,
    CASE WHEN b5 THEN CASE WHEN d >= 30 THEN 'high' ELSE 'medium' END END AS severity, t0_ms, t1_ms, d AS dur_sec FROM epi WHERE d >= 3""")
def v4_phone(spark, sf_dir):
    return findings.phone(observations(spark, sf_dir), GAP)


@query(f"""+ {OBS.format(kind='click')} SELECT sk, 'audio_wearable' AS event_type, CASE WHEN b7 OR (b2 AND b5) THEN 'flagged' ELSE 'cleared' END AS outcome, CASE WHEN NOT (b7 OR (b2 AND b5)) THEN 'no_contact' END AS reason,
    CASE WHEN b7 OR (b2 AND b5) THEN CASE WHEN d >= 30 THEN 'high' ELSE 'medium' END END AS severity, t0_ms, t1_ms, d AS dur_sec FROM epi WHERE d >= 3""")
def v5_wearable(spark, sf_dir):
    return findings.wearable(observations(spark, sf_dir), GAP)


@query("""+ o AS (SELECT *, t_ms AS start_ms, t_ms + 3600000 AS end_ms FROM ev WHERE kind = 'view'), x AS (SELECT *, 'external_resource' AS event_type FROM o WHERE k % 2 = 0 UNION ALL SELECT *, 'ai_assistant' FROM o WHERE k % 3 = 0),
    i AS (SELECT *, sum(f) OVER (PARTITION BY sk, event_type ORDER BY start_ms, ord) AS isl FROM (SELECT *, CASE WHEN start_ms - lag(end_ms) OVER (PARTITION BY sk, event_type ORDER BY start_ms, ord) <= 324000000 THEN 0 ELSE 1 END AS f FROM x))
    SELECT sk, event_type, min(start_ms) AS t0_ms, max(end_ms) AS t1_ms, max(value) AS confidence, arg_max((start_ms + end_ms) // 2, (value, -ord)) AS peak_ms FROM i GROUP BY sk, event_type, isl""")
def v10_screen(spark, sf_dir):
    rows = of_kind(events(spark, sf_dir), "view").withColumn("start_ms", F.col("t_ms")).withColumn("end_ms", F.col("t_ms") + HOUR)
    rows = rows.withColumn("confidence", F.col("value")).withColumn("a", F.col("k") % 2 == 0).withColumn("b", F.col("k") % 3 == 0)
    return findings.screen(rows, {"a": "external_resource", "b": "ai_assistant"}, 90 * HOUR)


MERGED = """f AS (SELECT sk, ord, kind, CASE k % 4 WHEN 0 THEN 'candidate' WHEN 1 THEN 'other_person' WHEN 2 THEN 'unclear' ELSE 'environment' END AS b_who, CASE WHEN k % 3 = 0 THEN 'candidate' ELSE 'unclear' END AS a_who,
    CASE WHEN k % 11 = 0 THEN 'setup_verification' ELSE 'live_exam' END AS phase, CASE WHEN value >= 60 THEN 'strong' WHEN value >= 20 THEN 'moderate' ELSE 'thin' END AS strength,
    CASE WHEN value >= 50 THEN 'high' WHEN value >= 15 THEN 'medium' ELSE 'low' END AS severity, CASE k % 5 WHEN 0 THEN 'sustain' WHEN 1 THEN 'needs_review' ELSE 'dismiss' END AS a_verdict,
    CASE WHEN k % 2 = 0 THEN 'corroborated' ELSE 'track_b_only' END AS status FROM ev WHERE k IS NOT NULL),
w AS (SELECT *, CASE WHEN b_who IN ('candidate', 'environment') THEN b_who WHEN b_who = 'other_person' THEN 'environment' ELSE a_who END AS who FROM f),
m AS (SELECT *, CASE WHEN status = 'corroborated' THEN CASE WHEN who = 'environment' OR phase = 'setup_verification' THEN 'cleared' WHEN a_verdict = 'sustain' OR (a_verdict = 'needs_review' AND strength = 'strong') THEN 'confirmed' WHEN a_verdict = 'needs_review' THEN 'ai_detected' ELSE 'cleared' END
    WHEN kind = 'error' THEN 'ai_detected' WHEN who = 'environment' OR phase = 'setup_verification' THEN 'cleared' WHEN strength = 'strong' AND severity = 'high' AND who = 'candidate' AND phase = 'live_exam' THEN 'confirmed' ELSE 'ai_detected' END AS verdict FROM w),
g AS (SELECT *, CASE WHEN verdict = 'cleared' OR who = 'environment' OR phase = 'setup_verification' THEN 0 WHEN verdict = 'confirmed' THEN 10000 WHEN status = 'corroborated' THEN 6000 ELSE 8500 END AS weight_10k FROM m)"""


def merged_findings(spark, sf_dir):
    k, v = F.col("k"), F.col("value")
    rows = events(spark, sf_dir).filter("k is not null").select(
        "sk", "ord", "kind", F.when(k % 4 == 0, "candidate").when(k % 4 == 1, "other_person").when(k % 4 == 2, "unclear").otherwise("environment").alias("b_who"),
        F.when(k % 3 == 0, "candidate").otherwise("unclear").alias("a_who"), F.when(k % 11 == 0, "setup_verification").otherwise("live_exam").alias("phase"),
        F.when(v >= 60, "strong").when(v >= 20, "moderate").otherwise("thin").alias("strength"), F.when(v >= 50, "high").when(v >= 15, "medium").otherwise("low").alias("severity"),
        F.when(k % 5 == 0, "sustain").when(k % 5 == 1, "needs_review").otherwise("dismiss").alias("a_verdict"), F.when(k % 2 == 0, "corroborated").otherwise("track_b_only").alias("status"),
    )
    c = F.col
    rows = rows.withColumn("who", decide.attribution(c("a_who"), c("b_who")))
    kind = F.when(c("kind") == "error", "external_help").otherwise(c("kind"))
    single = decide.single_verdict(kind, c("who"), c("phase"), c("strength"), c("severity"))
    both = decide.corroborated_verdict(c("a_verdict"), c("who"), c("phase"), c("strength"))
    rows = rows.withColumn("verdict", F.when(c("status") == "corroborated", both).otherwise(single))
    return rows.withColumn("weight_10k", decide.weight_10k(c("verdict"), c("who"), c("phase"), c("status")))


@query(f"""+ {MERGED} SELECT sk, ord, who, verdict, weight_10k, greatest(0, least(100, CASE strength WHEN 'strong' THEN 90 WHEN 'moderate' THEN 75 ELSE 55 END + CASE severity WHEN 'high' THEN 5 WHEN 'low' THEN -10 ELSE 0 END)) AS confidence FROM g""")
def r14_r17_merged_findings(spark, sf_dir):
    confidence = decide.track_confidence(F.col("strength"), F.col("severity"))
    return merged_findings(spark, sf_dir).select("sk", "ord", "who", "verdict", "weight_10k", confidence.alias("confidence"))


@query(f"""+ {MERGED}, s AS (SELECT sk, CAST(least(90, round_even(sum(CASE severity WHEN 'high' THEN 32 WHEN 'medium' THEN 18 ELSE 9 END * weight_10k) / 10000.0::DOUBLE, 0)) AS INT) AS total, CAST(count_if(weight_10k > 0) AS BIGINT) AS driving FROM g GROUP BY sk)
    SELECT *, CASE WHEN total >= 56 THEN 'Likely Violation' WHEN total >= 26 THEN 'Needs Review' ELSE 'Clear' END AS band FROM s""")
def a16_band(spark, sf_dir):
    """Over all findings nearly all sessions reach the cap; ``a16_band_whole`` has the sum before it."""
    return decide.composite(merged_findings(spark, sf_dir), ["sk"])


@query(f"""+ {MERGED}, s AS (SELECT sk, round_even(sum(CASE severity WHEN 'high' THEN 32 WHEN 'medium' THEN 18 ELSE 9 END * weight_10k) / 10000.0::DOUBLE, 0) AS points, CAST(count_if(weight_10k > 0) AS BIGINT) AS driving FROM g GROUP BY sk)
    SELECT sk, CAST(least(90, points) AS INT) AS total, driving, CASE WHEN points >= 56 THEN 'Likely Violation' WHEN points >= 26 THEN 'Needs Review' ELSE 'Clear' END AS band, CAST(points AS BIGINT) AS uncapped FROM s""")
def a16_band_whole(spark, sf_dir):
    return decide.composite(merged_findings(spark, sf_dir), ["sk"], uncapped=True)


@query(f"""+ {MERGED}, q AS (SELECT sk, avg(CASE WHEN value >= 20 THEN 1.0::DOUBLE ELSE 0 END) AS usable, avg(CASE WHEN k % 2 = 0 THEN 1.0::DOUBLE ELSE 0 END) AS informative FROM ev GROUP BY sk)
    SELECT g.sk, g.ord, least(g.ord % 101, CASE WHEN usable < 0.3 THEN 50 WHEN usable < 0.6 THEN 70 ELSE 100 END, CASE WHEN informative < 0.25 THEN 50 WHEN informative < 0.5 THEN 70 ELSE 100 END) AS confidence FROM g JOIN q USING (sk)""")
def r19_confidence_caps(spark, sf_dir):
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    quality = events(spark, sf_dir).groupBy("sk").agg(share(F.col("value") >= 20).alias("usable"), share(F.col("k") % 2 == 0).alias("informative"))
    rows = merged_findings(spark, sf_dir).join(quality, "sk")
    return rows.select("sk", "ord", decide.capped(F.col("ord") % 101, F.col("usable"), F.col("informative"), F.lit(True)).alias("confidence"))


@query("""+ s AS (SELECT sk, ord, k, kind, value FROM ev WHERE kind IN ('signup', 'error') AND k IS NOT NULL)
    SELECT sk, ord, CASE WHEN k % 13 = 0 THEN 'SignalTypeRule' WHEN k % 17 = 0 THEN 'EpisodeRefRule' WHEN k % 5 = 4 THEN 'CitationRule' WHEN k % 5 = 3 THEN 'SmartStudentGuard'
        WHEN k % 5 = 2 THEN 'UnknownRule' WHEN k % 5 = 1 AND k % 2 = 0 THEN 'ConjunctionRule' WHEN k % 5 = 1 THEN NULL WHEN kind = 'error' THEN 'NoFactInvention' END AS rejected_by FROM s""")
def r13_rule_chain(spark, sf_dir):
    """Signals built from the number k: one citation shape per remainder of five."""
    k = F.col("k")
    strings = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    none = strings()
    facts = F.when(k % 5 == 3, strings("TYPING_STARTED")).when(k % 5 == 0, F.when(F.col("kind") == "error", strings("INVENTED")).otherwise(strings("LARGE_PASTE"))).otherwise(none)
    gaze = F.when(k % 2 == 0, strings("w1.attention.gazeDirection=left")).otherwise(strings("w1.hands.objectInHand=phone"))
    seen = F.when(k % 5 == 2, strings("w1.audio.speechPresent=UNKNOWN")).when(k % 5 == 1, gaze).when(k % 5 == 0, strings("w1.attention.gazeDirection=left")).otherwise(none)
    rule = decide.rejection(
        k % 13 != 0, k % 17 != 0, F.lit(True), F.lit("collaboration"), facts, seen, none, none, none, strings("LARGE_PASTE", "TYPING_STARTED"), strings("w1"), none
    )
    rows = of_kind(events(spark, sf_dir), "signup", "error").filter("k is not null")
    return rows.select("sk", "ord", rule.alias("rejected_by"))


@query("""+ f AS (SELECT sk, ord, CASE k % 3 WHEN 0 THEN 'external_help' WHEN 1 THEN 'multiple_faces' ELSE 'phone_usage' END AS event_type, CASE WHEN k % 5 = 0 THEN 'unknown' ELSE 'flagged' END AS outcome, start_ms AS a, end_ms AS b
        FROM iv WHERE kind = 'view' AND k IS NOT NULL),
    g AS (SELECT *, outcome = 'flagged' AND event_type <> 'phone_usage' AND EXISTS (SELECT 1 FROM iv s WHERE s.kind = 'signup' AND s.sk = f.sk AND f.a < s.end_ms AND s.start_ms < f.b)
        AND NOT EXISTS (SELECT 1 FROM iv s WHERE s.kind = 'error' AND s.sk = f.sk AND f.a < s.end_ms AND s.start_ms < f.b) AS gone FROM f)
    SELECT sk, event_type, CASE WHEN gone THEN 'cleared' ELSE outcome END AS outcome, CASE WHEN gone THEN 'staff_speech' END AS reason, 'high' AS severity, a AS t0_ms, b AS t1_ms,
        CASE WHEN gone THEN greatest(1, CAST(round_even((b - a) / 1000.0::DOUBLE, 0) AS BIGINT)) ELSE CAST(0 AS BIGINT) END AS dur_sec FROM g""")
def v7_cross_modal_clearing(spark, sf_dir):
    """Findings of views, staff speech of sign-ups, integrity speech of errors."""
    rows = spans(spark, sf_dir)
    k = F.col("k")
    kind = F.when(k % 3 == 0, "external_help").when(k % 3 == 1, "multiple_faces").otherwise("phone_usage")
    found = of_kind(rows, "view").filter("k is not null").select(
        "sk", kind.alias("event_type"), F.when(k % 5 == 0, "unknown").otherwise("flagged").alias("outcome"), F.lit(None).cast("string").alias("reason"), F.lit("high").alias("severity"),
        F.col("start_ms").alias("t0_ms"), F.col("end_ms").alias("t1_ms"), F.lit(0).cast("bigint").alias("dur_sec"),
    )
    return findings.clear_by_staff(found, of_kind(rows, "signup"), of_kind(rows, "error"))
