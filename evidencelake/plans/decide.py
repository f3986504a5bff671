"""Reconciling finding tracks, validating proposed signals, and scoring, as Column expressions over finding and signal rows.

Scores stay whole numbers (ten-thousandths of a weight, hundredths of a confidence) until a report rounds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.functions.text import citation
from evidencelake.operators.joins import first_match

#: Fixed points and weights of the score.
SEVERITY_POINTS = {"high": 32, "medium": 18, "low": 9}
INTEGRITY_SPEECH = ("asking_for_answer", "receiving_dictation", "discussing_solution", "reciting_answer_choices")
DIVERTED = ("left", "right", "up", "away")
SPEED_FACTS = ("TYPING_STOPPED", "TYPING_STARTED")
SPEED_METRICS = ("typingSpeedWpm", "typingBurstCount", "typingBurstDurations")
SOLO_SCREEN_FACTS = ("SCREEN_EXTERNAL_RESOURCE", "SCREEN_AI_ASSISTANT_UI", "SCREEN_EXTERNAL_PASTE")
SIGNAL_TYPES = (
    "possible_external_consultation", "possible_second_person_involvement", "unauthorized_reference_usage", "abnormal_paste_workflow", "suspicious_focus_pattern",
    "abnormal_correction_pattern", "typing_cadence_mismatch", "inconsistent_interaction_sequence", "possible_audio_coaching", "possible_remote_dictation",
)
TIME_TOLERANCE_MS = 90_000


def attribution(a: Column, b: Column) -> Column:
    """Another person counts as environment; an unclear side takes the other's word."""
    folded = F.when(b == "other_person", "environment").otherwise(F.coalesce(b, F.lit("unclear")))
    other = F.when(a.isin("candidate", "environment", "unclear"), a).otherwise("unclear")
    known = folded.isin("candidate", "environment")
    return F.when(known, folded).otherwise(F.when(folded == "unclear", F.coalesce(other, F.lit("unclear"))).otherwise("unclear"))


def corroborated_verdict(a_verdict: Column, who: Column, phase: Column, strength: Column) -> Column:
    return (
        F.when((who == "environment") | (phase == "setup_verification"), "cleared")
        .when(a_verdict == "sustain", "confirmed")
        .when((a_verdict == "needs_review") & F.coalesce(strength == "strong", F.lit(False)), "confirmed")
        .when(a_verdict == "needs_review", "ai_detected")
        .otherwise("cleared")
    )


def single_verdict(event_type: Column, who: Column, phase: Column, strength: Column, severity: Column) -> Column:
    sure = (strength == "strong") & (severity == "high") & (who == "candidate") & (phase == "live_exam")
    return (
        F.when(event_type == "external_help", "ai_detected")
        .when((who == "environment") | (phase == "setup_verification"), "cleared")
        .when(F.coalesce(sure, F.lit(False)), "confirmed")
        .otherwise("ai_detected")
    )


def weight_10k(verdict: Column, who: Column, phase: Column, status: Column) -> Column:
    none = verdict.isin("cleared", "overturned", "unverified_signal") | (who == "environment") | (phase == "setup_verification") | (status == "track_a_only")
    return (
        F.when(none, 0)
        .when(verdict == "confirmed", 10_000)
        .when((verdict == "ai_detected") & (status == "corroborated"), 6_000)
        .when((verdict == "ai_detected") & (status == "track_b_only"), 8_500)
        .otherwise(0)
    )


def composite(findings: DataFrame, keys: list[str], uncapped: bool = False) -> DataFrame:
    """Severity points times weight, banker's-rounded, capped at 90, with its band; ``uncapped`` adds the sum before the cap."""
    points = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in SEVERITY_POINTS.items() for x in kv]), F.col("severity")), F.lit(9))
    rounded = F.bround(F.sum(points * F.col("weight_10k")) / 10_000.0)
    total = F.least(F.lit(90), rounded).cast("int")
    whole = [rounded.cast("bigint").alias("uncapped")] if uncapped else []
    scored = findings.groupBy(*keys).agg(total.alias("total"), F.count_if(F.col("weight_10k") > 0).alias("driving"), *whole)
    band = F.when(F.col("total") >= 56, "Likely Violation").when(F.col("total") >= 26, "Needs Review").otherwise("Clear")
    return scored.withColumn("band", band)


def track_confidence(strength: Column, severity: Column) -> Column:
    """In hundredths."""
    base = F.when(strength == "strong", 90).when(strength.isNull() | (strength == "moderate"), 75).when(strength == "thin", 55).otherwise(65)
    shift = F.when(severity == "high", 5).when(severity == "low", -10).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), base + shift))


def capped(confidence: Column, usable: Column, informative: Column, visual: Column) -> Column:
    """Confidence in hundredths after the capture and the content caps."""
    capture = F.when(usable < 0.30, 50).when(usable < 0.60, 70).otherwise(100)
    content = F.when(visual & (informative < 0.25), 50).when(visual & (informative < 0.50), 70).otherwise(100)
    return F.least(confidence, capture, content)


def scoreable(weight: Column, event_type: Column, duration_ms: Column) -> Column:
    return (weight > 0) & ~((event_type == "suspicious_eye_movement") & (duration_ms < 15_000))


def unified(signals: DataFrame, findings: DataFrame, sessions: DataFrame, allowed: DataFrame) -> DataFrame:
    """One recommendation per session.

    ``signals``: sk, signal_id, ord, signal_type, resolution, confidence (hundredths), sources (array), mid_ms (null: unknown).
    ``findings``: sk, finding_id, event_type, source, severity, strength, weight_10k, duration_ms, mid_ms.
    ``sessions``: sk, usable, informative.  ``allowed``: signal_type, event_type pairs that may be the same thing.
    """
    active = signals.filter("resolution != 'honest'")
    scored = findings.filter(scoreable(F.col("weight_10k"), F.col("event_type"), F.col("duration_ms")))
    scored = scored.withColumn("own", track_confidence(F.col("strength"), F.col("severity")))
    near = F.coalesce(F.abs(F.col("s_mid") - F.col("mid_ms")) <= TIME_TOLERANCE_MS, F.lit(True))
    known = active.select("sk", "signal_type", F.col("signal_id").alias("s_id"), F.col("ord").alias("s_ord"), F.col("confidence").alias("s_conf"), F.col("mid_ms").alias("s_mid"))
    pairs = scored.join(F.broadcast(allowed), "event_type").join(known, ["sk", "signal_type"]).filter(near)
    matched = first_match(pairs, ["sk", "finding_id"], ["s_ord"]).select("sk", "finding_id", "s_conf")
    both = scored.join(matched, ["sk", "finding_id"], "left")
    finding_conf = F.when(F.col("s_conf").isNotNull(), F.least(F.lit(98), F.greatest("s_conf", "own") + 5)).otherwise(F.col("own"))
    evidence = active.select("sk", "confidence", "sources", (F.col("resolution") == "assisted").alias("strong")).unionByName(
        both.select("sk", finding_conf.alias("confidence"), F.array("source").alias("sources"), F.col("s_conf").isNotNull().alias("strong"))
    )
    per = evidence.groupBy("sk").agg(
        F.max("confidence").alias("best"), F.bool_or("strong").alias("strong"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("kinds")
    )
    joined = sessions.join(per, "sk", "left")
    clear = F.floor(50 + 50 * F.least(F.greatest(F.lit(0.0), "usable"), F.greatest(F.lit(0.0), "informative")))
    category = F.when(F.col("best").isNull(), "CLEAR").when((F.size("kinds") >= 2) & F.col("strong"), "STRONG_EVIDENCE").otherwise("REVIEW_REQUIRED")
    visual = F.coalesce(F.arrays_overlap("kinds", F.array(F.lit("visual_observation"), F.lit("audio_observation"))), F.lit(False))
    final = capped(F.coalesce("best", clear).cast("int"), F.col("usable"), F.col("informative"), visual)
    return joined.select("sk", category.alias("category"), final.alias("confidence"), F.coalesce(F.size("kinds"), F.lit(0)).alias("n_kinds"))


# Validation of proposed signals: one failing rule, the first in this order, rejects.


def cited(observations: Column, path: str) -> Column:
    """The first cited value of a path, in lower case."""
    parsed = F.transform(observations, lambda r: citation(r))
    return F.lower(F.get(F.filter(parsed, lambda c: c["path"] == path), F.lit(0))["value"])


def solo_evidence(signal_type: Column, facts: Column, observations: Column, metrics: Column, factors: Column) -> Column:
    value = lambda path: cited(observations, path)
    speech = F.coalesce(value("audio.speechContentClass").isin(*INTEGRITY_SPEECH), F.lit(False))
    interacting = F.coalesce(value("people.secondPersonInteracting") == "yes", F.lit(False)) | F.coalesce(value("people.secondPersonActivity") == "speaking_to_candidate", F.lit(False))
    away = F.coalesce(value("attention.gazeDirection").isin(*DIVERTED), F.lit(False))
    seen = F.coalesce(value("people.secondPersonVisible") == "yes", F.lit(False))
    phone = F.coalesce(value("hands.objectInHand") == "phone", F.lit(False))
    any_of = lambda arr, names: F.coalesce(F.arrays_overlap(arr, F.array(*map(F.lit, names))), F.lit(False))
    workflow = (
        (signal_type == "abnormal_paste_workflow")
        & any_of(factors, ["deterministic_paste_workflow"])
        & (any_of(facts, ["LARGE_PASTE", "SCREEN_EXTERNAL_PASTE", "TEXT_CORRECTION"]) | any_of(metrics, ["largePasteCount", "largePasteSizes"]))
    )
    return phone | speech | any_of(facts, SOLO_SCREEN_FACTS) | (interacting & (speech | away)) | (seen & away & speech) | workflow


def rejection(
    allowed_type: Column, episode_ok: Column, values_ok: Column, signal_type: Column, facts: Column, observations: Column, metrics: Column,
    supports: Column, factors: Column, known_facts: Column, known_windows: Column, known_metrics: Column,
) -> Column:
    """Name of the first rule that a signal fails, null if it passes."""
    total = F.size(facts) + F.size(observations) + F.size(metrics)
    kinds = (F.size(facts) > 0).cast("int") + (F.size(observations) > 0).cast("int") + (F.size(metrics) > 0).cast("int")
    only = lambda arr, names: F.forall(arr, lambda x: x.isin(*names))
    speed = (F.size(facts) > 0) & only(facts, SPEED_FACTS) & (F.size(observations) == 0) & only(metrics, SPEED_METRICS)
    unknown = F.forall(observations, lambda r: F.upper(r).rlike(r"[:=.]UNKNOWN"))
    unsure = (F.size(supports) > 0) & F.forall(supports, lambda s: F.contains(F.lower(s), F.lit("unknown")))
    solo = solo_evidence(signal_type, facts, observations, metrics, factors)
    windows = F.transform(observations, lambda r: F.regexp_extract(r, r"^([^.]*)", 1))
    missing = lambda arr, known: F.size(F.array_except(arr, known)) > 0
    return (
        F.when(~allowed_type, "SignalTypeRule")
        .when(~episode_ok, "EpisodeRefRule")
        .when(~values_ok, "ValueResolutionRule")
        .when(total == 0, "CitationRule")
        .when(speed, "SmartStudentGuard")
        .when((F.size(observations) > 0) & (unknown | unsure), "UnknownRule")
        .when(F.when(solo, total < 1).otherwise((total < 2) | (kinds < 2)), "ConjunctionRule")
        .when(missing(facts, known_facts) | missing(F.filter(windows, lambda w: w != ""), known_windows) | missing(metrics, known_metrics), "NoFactInvention")
    )


def numbered(signals: DataFrame) -> DataFrame:
    """Survivors of each session as sig_{n}_{type}, in order."""
    n = F.row_number().over(Window.partitionBy("sk").orderBy("ord"))
    return signals.withColumn("signal_id", F.concat(F.lit("sig_"), n.cast("string"), F.lit("_"), F.col("signal_type")))


