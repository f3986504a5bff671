"""From observations and facts to the tables that detectors and episodes read: predicates, findings, facts and the event union.

Observations are rows of ``perception.observations`` (nine groups of fields) with sk, ord, window_id, chunk_id, start_ms, end_ms,
confidence, tier, video_available and phase.  Everything is a Column expression, a union or a grouping by session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.functions.text import question_number, seconds
from evidencelake.operators import sequences
from evidencelake.operators.joins import locate
from evidencelake.plans import findings, risk
from evidencelake.plans.timeline import SESSION_LIMIT_MS

#: Least confidence of a usable observation, and classes of speech (fixed values).
LEAST_CONFIDENCE = 0.3
INTEGRITY = ("asking_for_answer", "receiving_dictation", "discussing_solution", "reciting_answer_choices")
ADMIN = ("invigilator_or_admin", "technical_exam_help")
CONTEXT = (*ADMIN, "self_talk_or_thinking", "casual_non_exam", "reading_question")
#: Kinds of facts on the detectors' timeline, and log rows that become facts (fixed values).
TIMELINE_FACTS = (
    "WINDOW_BLUR", "WINDOW_FOCUS", "TAB_SWITCH", "LARGE_PASTE", "PASTE", "TEXT_CORRECTION", "ACTIVITY_GAP", "TYPING_STARTED", "TYPING_STOPPED",
    "SECTION_STARTED", "SECTION_COMPLETED", "SECTION_TERMINATED", "SECTION_TIMEOUT", "CODE_SUBMISSION", "QUESTION_ATTEMPTED", "MCQ_ANSWER_SELECTED",
    "MCQ_ANSWER_CHANGED", "TEST_RESULT_OBSERVED", "SCREEN_EXTERNAL_PASTE", "SCREEN_EXTERNAL_RESOURCE", "SCREEN_AI_ASSISTANT_UI",
    "SCREEN_SECONDARY_WORKSPACE", "SCREEN_FULLSCREEN_LOST",
)
SCREEN_FACTS = {
    "external_resource_open": "SCREEN_EXTERNAL_RESOURCE", "ai_assistant_ui_visible": "SCREEN_AI_ASSISTANT_UI", "secondary_workspace_visible": "SCREEN_SECONDARY_WORKSPACE",
    "fullscreen_exam_lost": "SCREEN_FULLSCREEN_LOST", "screen_external_paste": "SCREEN_EXTERNAL_PASTE",
}
LEGACY_GAP_MS, LEGACY_LEAST_MS = 22_000, 3_000


def is_in(c: Column, names: Sequence[str]) -> Column:
    return F.coalesce(c.isin(*names), F.lit(False))


def usable(available: Column, tier: Column, confidence: Column) -> Column:
    return F.coalesce(available & (tier != "NONE") & (confidence >= LEAST_CONFIDENCE), F.lit(False))


def capture_issue(available: Column, tier: Column, framing: Column) -> Column:
    return ~F.coalesce(available, F.lit(False)) | is_in(tier, ("NONE", "LOW")) | F.coalesce(framing == "obscured", F.lit(False))


def speech_classes(said: Column) -> dict[str, Column]:
    """Aggregates over an episode: any integrity speech, any official speech, and nothing but speech that needs no review."""
    told = said.isNotNull() & ~said.isin("UNKNOWN", "silence")
    harmless = F.coalesce(F.bool_and(F.when(told, said.isin(*CONTEXT))), F.lit(False))
    return {
        "integrity_speech": F.coalesce(F.bool_or(is_in(said, INTEGRITY)), F.lit(False)), "admin_speech": F.coalesce(F.bool_or(is_in(said, ADMIN)), F.lit(False)),
        "only_cleared_speech": harmless,
    }


def verified_question(timed: Column, fallback_end: Column, start: Column, end: Column) -> Column:
    return F.coalesce(timed & ~fallback_end & (end > start), F.lit(False))


def perception_episodes(timeline: DataFrame, kinds: Sequence[str]) -> DataFrame:
    return timeline.filter((F.col("source") == "perception_episode") & is_in(F.col("kind"), kinds))


def observation_flags(obs: DataFrame) -> DataFrame:
    """The columns that the classifiers of ``findings`` read, from the groups of fields."""
    yes = lambda c: F.coalesce(F.col(c) == "yes", F.lit(False))
    is_ = lambda c, *v: is_in(F.col(c), v)
    said, speech = F.col("audio.speech_content_class"), yes("audio.speech_present")
    answered, met = yes("people.candidate_responding_to_second_person"), yes("people.second_person_interacting")
    diverted = met & ~is_("attention.gaze_direction", "screen", "down", "UNKNOWN") & F.col("attention.gaze_direction").isNotNull()
    return obs.withColumns({
        "face_absent": is_("identity.face_present", "no"), "capture_issue": capture_issue(F.col("video_available"), F.col("tier"), F.col("environment.framing")),
        "left_seat": yes("body.left_seat"), "left_fully": is_("environment.framing", "obscured"),
        "person_visible": yes("people.second_person_visible"), "interacting": met | is_("people.second_person_activity", "speaking_to_candidate"),
        "passing": is_("people.second_person_activity", "passing_by", "idle", "UNKNOWN"), "adjacent": is_("people.second_person_position", "adjacent"),
        "staff": is_("people.second_person_role_cue", "invigilator_or_staff"), "reflection": is_("people.second_person_looks_like", "reflection"),
        "gaze_away": answered | diverted, "gaze": F.col("attention.gaze_direction"), "second_monitor": is_("attention.gaze_target", "secondary_monitor"),
        "recurrent": F.coalesce(~F.col("attention.repeated_gaze_pattern").isin("none", "UNKNOWN"), F.lit(False)),
        "phone_visible": yes("objects.phone_visible"), "in_hand": is_("hands.object_in_hand", "phone") | is_("hands.hand_location", "phone"),
        "earphone": yes("objects.headphones_visible") | yes("objects.earphone_visible"), "speech": speech,
        "integrity_speech": is_in(said, INTEGRITY), "admin_speech": is_in(said, ADMIN), "lip_mismatch": speech & is_("audio.speech_overlap_with_lips", "no"),
        "off_camera": speech & is_("audio.speech_source", "off_camera", "device_playback"), "ringtone": is_("audio.device_sounds", "call_ringtone"),
        "summary": F.trim(F.coalesce("audio.conversation_summary_en", F.lit(""))),
    })


#: What the classifiers read of an observation, beside its place.
FLAGS = (
    "face_absent", "capture_issue", "left_seat", "left_fully", "person_visible", "interacting", "passing", "adjacent", "staff", "reflection", "gaze_away", "gaze",
    "second_monitor", "recurrent", "phone_visible", "in_hand", "earphone", "speech", "integrity_speech", "admin_speech", "lip_mismatch", "off_camera", "ringtone", "summary",
)


def live_usable(obs: DataFrame) -> DataFrame:
    return obs.filter((F.col("phase") == "live_exam") & usable(F.col("video_available"), F.col("tier"), F.col("confidence")))


def video_findings(obs: DataFrame) -> DataFrame:
    """All camera findings of the observations' flags: six classifiers, cleared by staff speech, numbered in order of time."""
    rows = risk.gathered(live_usable(obs).select("sk", "ord", "start_ms", "end_ms", *FLAGS))  # every classifier reads them
    found = [f(rows) for f in (findings.face, findings.second_person, findings.gaze, findings.phone, findings.wearable, findings.speech)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    talk = rows.filter("speech").select("sk", "start_ms", "end_ms", "admin_speech", "integrity_speech")
    cleared = findings.clear_by_staff(every, talk.filter("admin_speech"), talk.filter("integrity_speech"))
    return numbered(cleared.filter("outcome in ('flagged', 'cleared')"), F.when(F.col("outcome") == "cleared", "perc_clr_").otherwise("perc_"), ["t0_ms", "t1_ms", "event_type", "reason"])


def numbered(rows: DataFrame, prefix: Column, order: Sequence[str], first: int = 1) -> DataFrame:
    """``rows`` with an ``id``: prefix and a running number per session."""
    n = F.row_number().over(Window.partitionBy("sk").orderBy(*order)) - 1 + first
    return rows.withColumn("id", F.concat(prefix, n.cast("string")))


def finding_rows(hits: DataFrame, gap_ms: int = 22_000) -> DataFrame:
    """Hits (sk, event_type, window_id, chunk_id, ord, start_ms, end_ms, confidence) to findings: span, reference, count, peak chunk and frame."""
    rows = sequences.island_ids(hits, ["sk", "event_type"], ["start_ms", "ord"], "start_ms", "end_ms", gap_ms)
    with_chunk = F.when(F.col("chunk_id").isNotNull(), F.struct(F.col("confidence"), (-F.col("start_ms")).alias("s"), (-F.col("ord")).alias("o")))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("start_ms", "ord", "window_id"))), lambda x: x["window_id"])
    return rows.groupBy("sk", "event_type", "island").agg(
        F.min("start_ms").alias("t0_ms"), F.max("end_ms").alias("t1_ms"), F.concat(F.lit("perception:w="), F.array_join(ids, "+")).alias("evidence_ref"),
        F.count("*").alias("occurrences"), F.max_by("chunk_id", with_chunk).alias("peak_chunk"), F.max_by("start_ms", with_chunk).alias("frame_ms"),
    ).drop("island")


def keystroke_rows(spans: DataFrame) -> DataFrame:
    """Rows (sk, event_type, start_ms, end_ms, severity, strength, ord; nulls take the defaults) as numbered findings of typing."""
    ref = F.concat(F.lit("machine_facts:t="), F.col("start_ms").cast("string"), F.lit("-"), F.col("end_ms").cast("string"), F.lit("ms"))
    rows = spans.select(
        "sk", "ord", "event_type", "start_ms", "end_ms", F.coalesce("severity", F.lit("medium")).alias("severity"), F.coalesce("strength", F.lit("moderate")).alias("strength"),
        ref.alias("evidence_ref"), F.lit("candidate").alias("attribution"), F.lit("flagged").alias("verdict"),
    )
    return numbered(rows, F.lit("mf_ks_"), ["start_ms", "ord"], first=0).drop("ord")


def compact_windows(obs: DataFrame) -> DataFrame:
    """What legacy episodes need of a window; a gaze that is neither on the screen nor unknown is off it."""
    gaze = F.when(F.col("gaze").isin("screen", "UNKNOWN"), F.col("gaze")).otherwise("off_screen")
    return obs.select("sk", "ord", "window_id", "start_ms", "end_ms", "video_available", "confidence", "face_present", "second_person_visible", "phone_visible", gaze.alias("gaze"))


def legacy_episodes(windows: DataFrame, gap_ms: int = LEGACY_GAP_MS, least_ms: int = LEGACY_LEAST_MS) -> DataFrame:
    """Episodes of four kinds over usable compact windows; short ones count only for an absent candidate."""
    named = F.array(
        F.when(F.col("second_person_visible") == "yes", "multiple_faces"), F.when(F.col("phone_visible") == "yes", "phone_usage"),
        F.when(F.col("gaze") == "off_screen", "suspicious_eye_movement"), F.when(F.col("face_present") == "no", "no_candidate"),
    )
    rows = windows.filter(F.col("video_available") & (F.col("confidence") >= LEAST_CONFIDENCE)).withColumn("event_type", F.explode(F.array_compact(named)))
    rows = sequences.island_ids(rows, ["sk", "event_type"], ["start_ms", "ord"], "start_ms", "end_ms", gap_ms)
    by_end = F.max_by("end_ms", F.struct("start_ms", "ord"))  # the last window closes the episode
    eps = rows.groupBy("sk", "event_type", "island").agg(F.min("start_ms").alias("t0_ms"), by_end.alias("t1_ms"), F.min_by("window_id", F.struct("start_ms", "ord")).alias("first_window"))
    kept = eps.filter((F.col("event_type") == "no_candidate") | (F.col("t1_ms") - F.col("t0_ms") >= least_ms))
    severity = F.when(F.col("event_type").isin("multiple_faces", "phone_usage"), "high").otherwise("medium")
    return kept.select("sk", "event_type", "t0_ms", "t1_ms", severity.alias("severity"), F.concat(F.lit("video:"), F.col("first_window")).alias("evidence_ref"))


def lifecycle_facts(anchors: DataFrame, sections: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Log rows of the named types as facts, with the type and title of their section."""
    table = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    rows = anchors.withColumn("fact", F.try_element_at(table, F.col("kind"))).filter("fact is not null")
    named = rows.join(sections.select("sk", "section_id", "section_type", "section_title"), ["sk", "section_id"], "left")
    return named.select("sk", "ord", F.col("fact").alias("kind"), F.col("offset_ms").alias("start_ms"), F.col("offset_ms").alias("end_ms"), "raw_ms", "section_id", "section_type", "section_title")


def hydrated(events: DataFrame, t0: DataFrame, sections: DataFrame) -> DataFrame:
    """Client events on the session's clock: from a minute before its start to eight hours after, never below 0, with source and section."""
    rows = events.join(t0.select("sk", "t0_ms"), "sk").withColumn("offset_ms", F.col("t_ms") - F.col("t0_ms"))
    rows = rows.filter(F.col("offset_ms").between(-60_000, SESSION_LIMIT_MS)).withColumn("offset_ms", F.greatest(F.lit(0), F.col("offset_ms")))
    source = F.when(F.col("signal_source") == "client_reported", "client_reported").when(F.col("signal_source") == "platform_cv", "video_cv").otherwise("rrweb_deterministic")
    found = locate(rows.select("sk", "ord", F.col("offset_ms").alias("t_ms")), sections, ["sk"], ["ord"]).select("sk", "ord", F.col("section_id").alias("found"))
    joined = rows.join(found, ["sk", "ord"], "left")
    return joined.select("sk", "ord", "kind", F.col("offset_ms").alias("start_ms"), F.col("t_ms").alias("raw_ms"), source.alias("source"), F.coalesce("section_id", "found").alias("section_id"))


def backfilled(facts: DataFrame, t0: DataFrame, sections: DataFrame) -> DataFrame:
    """Facts at 0 that know their raw clock move to it (never below 0) and take the section there, if they have none."""
    rows = facts.join(t0.select("sk", "t0_ms"), "sk", "left")
    moved = (F.col("start_ms") == 0) & F.col("raw_ms").isNotNull()
    rows = rows.withColumn("moved", moved).withColumn("start_ms", F.when(moved, F.greatest(F.lit(0), F.col("raw_ms") - F.coalesce("t0_ms", F.lit(0)))).otherwise(F.col("start_ms")))
    found = locate(rows.filter("moved").select("sk", "ord", F.col("start_ms").alias("t_ms")), sections, ["sk"], ["ord"]).select("sk", "ord", F.col("section_id").alias("found"))
    joined = rows.join(found, ["sk", "ord"], "left")
    return joined.select("sk", "ord", "kind", "start_ms", "raw_ms", F.coalesce("section_id", "found").alias("section_id"))


def screen_facts(episodes: DataFrame) -> DataFrame:
    """One fact per screen episode (``findings.screen``) at the middle of its most confident observation."""
    table = F.create_map(*[F.lit(x) for kv in SCREEN_FACTS.items() for x in kv])
    return episodes.select("sk", F.try_element_at(table, F.col("event_type")).alias("kind"), F.col("peak_ms").alias("start_ms"), F.col("peak_ms").alias("end_ms"), "confidence").filter("kind is not null")


def fact_bundle(parts: dict[str, DataFrame], screen_mode: bool) -> DataFrame:
    """All facts of a session in order of time, with their origin; page recordings and screen recordings exclude each other."""
    left_out = "page" if screen_mode else "screen"
    out = None
    for name, part in parts.items():
        if name != left_out:
            rows = part.withColumn("origin", F.lit(name))
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    n = F.row_number().over(Window.partitionBy("sk").orderBy("start_ms", "kind", "origin", "ord"))
    return out.withColumn("n", n)


def timeline(facts: DataFrame, questions: DataFrame, video: DataFrame, screen: DataFrame) -> DataFrame:
    """The detectors' events in one schema: facts of the timeline's kinds, question windows, flagged camera and screen findings.

    ``q``, ``chars`` and ``hard`` are taken along where the tables have them.
    """
    more = lambda df: [(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in (("q", "bigint"), ("chars", "bigint"), ("hard", "boolean"), ("ord", "bigint"))]
    point = F.when(F.col("end_ms") != F.col("start_ms"), F.col("end_ms"))
    submitted = F.when(F.col("kind") == "CODE_SUBMISSION", "submission").otherwise("fact")
    a = facts.filter(is_in(F.col("kind"), TIMELINE_FACTS)).select(
        "sk", F.col("start_ms").alias("t_ms"), point.alias("end_ms"), submitted.alias("source"), "kind", "section_id", F.concat(F.lit("fact:"), F.col("ord").cast("string")).alias("evidence_ref"), *more(facts),
    )
    b = questions.select(
        "sk", F.col("start_ms").alias("t_ms"), "end_ms", F.lit("sqb").alias("source"), F.lit("SQB_WINDOW").alias("kind"), "section_id",
        F.concat(F.lit("sqb:s="), F.col("section_id"), F.lit(":q="), F.col("q").cast("string")).alias("evidence_ref"), *more(questions),
    )
    found = lambda df, source: df.select("sk", F.col("t0_ms").alias("t_ms"), F.col("t1_ms").alias("end_ms"), F.lit(source).alias("source"), F.col("event_type").alias("kind"), "evidence_ref")
    return a.unionByName(b).unionByName(found(video, "perception_episode"), allowMissingColumns=True).unionByName(found(screen, "screen_episode"), allowMissingColumns=True)


def all_of(parts: dict[str, DataFrame]) -> DataFrame:
    """Findings, facts or artifacts of several tracks, one after the other, each with its track."""
    out = None
    for track, part in parts.items():
        rows = part.withColumn("track", F.lit(track))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def gap_ms(duration: Column, start: Column, end: Column) -> Column:
    return F.coalesce(F.when(duration > 0, F.floor(duration)), F.when(end > start, end - start), F.lit(0)).cast("bigint")


def paste_size(chars: Column) -> Column:
    return F.coalesce(F.floor(chars), F.lit(0)).cast("bigint")


def is_correct(most: Column, score: Column, passed: Column, total: Column, said: Column) -> Column:
    """By score where there is a positive maximum and a score other than 0, else by test cases, else by word."""
    scored = (most > 0) & F.nullif(score, F.lit(0)).isNotNull()
    return F.when(F.coalesce(scored, F.lit(False)), score >= most).when(F.coalesce((total > 0) & passed.isNotNull(), F.lit(False)), passed == total).otherwise(is_in(F.upper(said), ("CORRECT", "PASS")))


def time_spent(value: Column) -> Column:
    number = value.try_cast("double")
    return F.when(number >= 0, number)


def difficulties(attempts: DataFrame) -> DataFrame:
    """The difficulty of each question: the last one said, and whether the first one said is hard."""
    at = F.struct("t_ms", "ord")
    said = F.upper(F.coalesce("difficulty", F.lit("")))
    return attempts.groupBy("sk", "q").agg(
        F.max_by(said, F.when(said != "", at)).alias("difficulty"), (F.min_by(said, at) == "HARD").alias("is_hard")
    )


def cohort_lookup(asked: DataFrame, cohort: DataFrame) -> DataFrame:
    """z scores of each asked section or question: those of its score and time, by the reference's name.

    ``asked``: sk, ref.  ``cohort``: sk, metric, ref, z.  Where a reference is given twice the first by z counts.
    """
    name = F.concat_ws(":", "metric", "ref")
    wide = cohort.groupBy("sk", "ref").agg(
        *[F.min(F.when(F.col("metric") == m, F.col("z"))).alias(f"{m}_z") for m in ("section_score", "section_time", "question_accuracy")],
        F.min(F.when(F.col("metric") == "section_score", name)).alias("score_ref"),
    )
    return asked.join(wide, ["sk", "ref"], "left")


def baseline(facts_metrics: DataFrame, coverage: DataFrame, version: str) -> DataFrame:
    """Metrics of the facts, with coverage where windows exist."""
    return facts_metrics.join(coverage, "sk", "left").withColumn("baseline_version", F.lit(version))


def confidence_panel(windows: DataFrame, screens: DataFrame, sessions: DataFrame) -> DataFrame:
    """Covered and unknown windows, the usable share, and labels of how much was seen; a session without windows counts as unseen.

    ``windows``: sk, covered, usable.  ``screens``: sk, start_ms, end_ms.  ``sessions``: sk, duration_ms.
    """
    per = windows.groupBy("sk").agg(F.count("*").alias("total"), F.count_if("covered").alias("covered"), F.avg(F.col("usable").cast("double")).alias("usable_ratio"))
    screen = screens.groupBy("sk").agg(F.count("*").alias("chunks"), F.sum(F.greatest(F.lit(0), F.col("end_ms") - F.col("start_ms"))).alias("screen_ms"))
    rows = sessions.join(per, "sk", "left").join(screen, "sk", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    share = lambda a, b: F.bround(100.0 * a / b).cast("bigint").cast("string")
    video = F.when(zero("covered") == 0, "0% video (modality absent)").otherwise(
        F.concat(share(F.col("covered"), F.greatest(F.lit(1), F.col("total"))), F.lit("% video ("), F.col("covered").cast("string"), F.lit("/"), F.col("total").cast("string"), F.lit(" windows)"))
    )
    chunks = F.col("chunks").cast("string")
    screen_label = F.when(F.col("chunks") > 0, F.when(F.col("duration_ms") > 0, F.concat(share(F.col("screen_ms"), F.col("duration_ms")), F.lit("% screen ("), chunks, F.lit(" chunks)")))
        .otherwise(F.concat(F.lit("screen recording present ("), chunks, F.lit(" chunks)"))))
    return rows.select(
        "sk", zero("covered").alias("covered"), zero("total").alias("total"), (zero("total") - zero("covered")).alias("unknown"),
        F.coalesce(F.nullif("usable_ratio", F.lit(0.0)), F.lit(1.0)).alias("usable_ratio"), (zero("covered") == 0).alias("video_absent"), video.alias("video_label"), screen_label.alias("screen_label"),
    )


def speech_proof(hits: DataFrame, keys: Sequence[str], most: int = 400) -> DataFrame:
    """Per episode: distinct summaries in order (cut to ``most`` with an ellipsis), the commonest language and class, and whether codes mix."""
    texts = F.transform(F.array_sort(F.collect_list(F.when(F.trim("summary") != "", F.struct("start_ms", "ord", F.trim("summary").alias("s"))))), lambda x: x["s"])
    known = lambda c, *none: F.call_function("mode", F.when(~F.col(c).isin("UNKNOWN", *none), F.col(c)), F.lit(True))
    rows = hits.groupBy(*keys).agg(
        F.array_join(F.array_distinct(texts), " ").alias("said"), known("language").alias("language"), known("speech_class", "silence").alias("speech_class"),
        F.bool_or(F.coalesce(F.col("code_mixing") == "yes", F.lit(False))).alias("code_mixing"),
    )
    return rows.withColumn("said", F.when(F.char_length("said") > most, F.concat(F.rtrim(F.substring("said", 1, most - 1)), F.lit("…"))).otherwise(F.col("said")))


def screen_proof(start: Column, end: Column, excerpt: Column, own_excerpt: Column, number: Column, label: Column, sequence: Column) -> Column:
    """Where in a screen chunk to look: the middle (banker's rounding), a label, what was pasted and at which question."""
    local = F.greatest(F.lit(0), F.bround((end - start) / 2.0)).cast("bigint")
    return F.struct(
        (start + local).alias("frame_ms"), local.alias("local_ms"), F.concat(F.lit("screen seq "), sequence.cast("string")).alias("clip_label"),
        F.coalesce(F.nullif(excerpt, F.lit("")), own_excerpt).alias("excerpt"), F.coalesce(F.nullif(number, F.lit(0)), question_number(label)).alias("question"),
    )


def observation_cards(flagged: DataFrame, stories: DataFrame, least_gaze_ms: int = 15_000) -> DataFrame:
    """Cards of flagged findings: short gazes and other people's phones are left out; the first story that overlaps nests the card."""
    rows = flagged.filter((F.col("verdict") == "flagged") & (F.col("event_type") != "ok")).withColumn("duration_ms", F.greatest(F.lit(0), F.col("t1_ms") - F.col("t0_ms")))
    rows = rows.filter(~((F.col("event_type") == "suspicious_eye_movement") & (F.col("duration_ms") < least_gaze_ms)))
    rows = rows.filter((F.col("event_type") != "phone_usage") | F.col("attribution").isNull() | (F.col("attribution") == "candidate"))
    told = stories.select("sk", F.struct(F.col("ord").alias("o"), "signal_id", "start_ms", "end_ms").alias("story")).groupBy("sk").agg(F.array_sort(F.collect_list("story")).alias("stories"))
    nested = F.get(F.filter("stories", lambda s: (F.col("t0_ms") < s["end_ms"]) & (F.col("t1_ms") > s["start_ms"])), F.lit(0))["signal_id"]
    words = F.replace("event_type", F.lit("_"), F.lit(" "))
    said = F.when(F.col("event_type") == "phone_usage", "Phone usage (candidate)").when(F.col("event_type") == "suspicious_eye_movement", "Sustained gaze")
    title = F.coalesce(said, F.concat(F.upper(F.substring(words, 1, 1)), F.lower(F.expr("substring(replace(event_type, '_', ' '), 2)"))))
    joined = rows.join(told, "sk", "left")
    key = F.concat_ws("_", F.lit("tbobs"), "event_type", F.col("t0_ms").cast("string"), F.col("t1_ms").cast("string"))
    return joined.select("sk", key.alias("card_id"), F.concat(title, F.lit(" · "), seconds(F.col("duration_ms")).cast("bigint").cast("string"), F.lit("s")).alias("title"), "t0_ms", "duration_ms", nested.alias("nested_under"))


def supporting_factors(stories: DataFrame, contributions: DataFrame) -> DataFrame:
    """Contributions that a story names by factor, or whose time meets it; each once."""
    rows = contributions.withColumn("row", F.struct("factor_id", "t0_ms", "t1_ms", "q"))
    named = stories.select("sk", "ord", F.explode("factor_ids").alias("factor_id")).join(rows, ["sk", "factor_id"]).select("sk", "ord", "row")
    meets = (F.col("t0_ms") <= F.col("end_ms")) & (F.col("t1_ms") >= F.col("start_ms"))
    timed = stories.select("sk", "ord", "start_ms", "end_ms").join(rows, "sk").filter(meets).select("sk", "ord", "row")
    return named.unionByName(timed).distinct().select("sk", "ord", "row.*")


def first_chunk(chunks: DataFrame, kind: str, order: Sequence[str]) -> DataFrame:
    """Spans of one kind of artifact with their place: camera by sequence, screen by start and sequence."""
    rows = chunks.filter(F.col("kind") == kind)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("sk").orderBy(*order)))

