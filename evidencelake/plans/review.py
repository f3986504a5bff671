"""Whole sessions at once: from stored facts, questions and observations to contributions, scores and one nested document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.operators import sequences
from evidencelake.operators.stashes import stash
from evidencelake.plans import observed, report, risk, sweep

#: Which events of the timeline a detector's table holds (fixed values).
TABLES = {
    "blur": ("WINDOW_BLUR", "TAB_SWITCH"), "gap": ("ACTIVITY_GAP",), "paste": ("LARGE_PASTE", "PASTE"), "answer": ("MCQ_ANSWER_SELECTED", "MCQ_ANSWER_CHANGED"),
    "submission": ("CODE_SUBMISSION",), "correction": ("TEXT_CORRECTION",), "gaze": ("suspicious_eye_movement",), "phone": ("phone_usage",),
    "person": ("external_help", "multiple_faces"), "speech": ("discussing_solution_audio", "whispering"), "absence": ("no_candidate", "left_seat_body_present", "left_examination_area"),
    "question": ("SQB_WINDOW",),
}


def event_rows(timeline: DataFrame, config: risk.Config) -> DataFrame:
    """The timeline's events with their roles for the detectors, gathered once by session and written; a role's rows are numbered where they have no ord."""
    number = F.row_number().over(Window.partitionBy("sk").orderBy("t_ms", "source", "evidence_ref")).cast("bigint")
    role = "case " + " ".join(f"when kind in ({', '.join(map(repr, kinds))}) then '{name}'" for name, kinds in TABLES.items()) + " end"
    rows = risk.by_session(timeline.filter("t_ms is not null")).withColumn("ord", F.coalesce("ord", number))
    rows = rows.selectExpr(
        "sk", f"{role} as role", "ord", "t_ms as start_ms", "coalesce(end_ms, t_ms) as end_ms", "q", "section_id as sec", "chars", "hard", "kind = 'whispering' as whisper", "bigint(null) as n"
    ).filter("role is not null")
    answers = rows.filter("role = 'answer'").withColumnRenamed("start_ms", "t_ms")
    runs = sequences.bursts(answers, ["sk"], ["t_ms", "ord"], gap_ms=config.burst_gap)
    burst = runs.selectExpr("sk", "t0_ms as ord", "t0_ms as start_ms", "t1_ms as end_ms", "n_events as n")
    return stash(rows.unionByName(sweep.tag(burst, "burst")), "event-rows")


def event_tables(timeline: DataFrame, config: risk.Config | None = None) -> risk.EventTables:
    """The tables of single detectors, cut from one timeline."""
    config = config or risk.Config()
    return sweep.tables(event_rows(timeline, config), config)


def behaviour(facts: DataFrame, questions: DataFrame, flagged_video: DataFrame, screen_episodes: DataFrame, config: risk.Config | None = None) -> tuple[DataFrame, DataFrame]:
    """The timeline of all sources, and the best contributions of all detectors."""
    config = config or risk.Config()
    made = observed.screen_facts(screen_episodes)
    both = facts.unionByName(made, allowMissingColumns=True)
    shown = screen_episodes.withColumn("evidence_ref", F.concat(F.lit("screen:"), F.col("peak_ms").cast("string")))
    line = observed.timeline(both, questions, flagged_video, shown)
    return line, risk.dedupe(sweep.detect(event_rows(line, config), config), config.bucket).drop("bucket")


def review(
    sessions: DataFrame, facts: DataFrame, questions: DataFrame, found: DataFrame, episodes: DataFrame, config: risk.Config | None = None
) -> DataFrame:
    """One document per session: its score, contributions, findings and facts.

    ``found`` are the camera findings of ``observed.video_findings`` and ``episodes`` those of ``findings.screen``, as they were stored:
    each is read several times.
    """
    flagged = found.filter("outcome = 'flagged'").withColumn("evidence_ref", F.concat(F.lit("video:"), F.col("id")))
    _, best = behaviour(facts, questions, flagged, episodes, config)
    scored = sessions.join(risk.totals(best), "sk", "left").fillna(0, ["total_milli", "n_contributions", "n_factors"])
    parts = {
        "contributions": (best, ["t0_ms", "factor_id"]), "findings": (found, ["t0_ms", "id"]), "screen_episodes": (episodes, ["t0_ms", "event_type"]),
        "facts": (facts.select("sk", "start_ms", "ord", "kind"), ["start_ms", "ord"]), "questions": (questions.select("sk", "start_ms", "end_ms", "q"), ["start_ms", "q"]),
    }
    return report.assemble(scored, parts)
