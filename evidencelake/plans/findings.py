"""Episode classifiers: observations to flagged, cleared, unknown and contextual findings.

Observations have sk, ord, start_ms, end_ms and boolean or text columns; each classifier builds episodes of its predicate and
judges them by ordered conditions over their aggregates.  Durations are banker's-rounded seconds of the hits' union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.functions.text import seconds
from evidencelake.operators.sequences import episodes, island_ids

COLUMNS = ["sk", "event_type", "outcome", "reason", "severity", "t0_ms", "t1_ms", "dur_sec"]


def built(obs: DataFrame, when: Column, gap_ms: int, extra: list[Column]) -> DataFrame:
    out = episodes(obs, when, ["sk"], ["start_ms", "ord"], gap_ms=gap_ms, extra=extra)
    return out.withColumn("dur_sec", seconds(F.col("union_ms")).cast("long"))


def some(flag: str) -> Column:
    return F.bool_or(F.coalesce(F.col(flag), F.lit(False))).alias(flag)


def finish(eps: DataFrame, event_type: Column | str, verdict: Column, severity: Column | str) -> DataFrame:
    """``verdict`` is "flagged" or "outcome:reason"; null rows are dropped, as short glimpses are."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    rows = eps.withColumn("verdict", verdict).filter("verdict is not null")
    flagged = F.col("verdict") == "flagged"
    return rows.select(
        "sk", lit(event_type).alias("event_type"), F.substring_index("verdict", ":", 1).alias("outcome"),
        F.when(~flagged, F.substring_index("verdict", ":", -1)).alias("reason"), F.when(flagged, lit(severity)).alias("severity"), "t0_ms", "t1_ms", "dur_sec",
    )


def face(obs: DataFrame, gap_ms: int = 22_000) -> DataFrame:
    issues = F.count_if(F.coalesce(F.col("capture_issue"), F.lit(False)))
    eps = built(obs, F.col("face_absent"), gap_ms, [some("left_seat"), some("left_fully"), issues.alias("issues")])
    mostly = (2 * F.col("issues") >= F.col("n_hits")) & ~F.col("left_seat")
    d = F.col("dur_sec")
    verdict = (
        F.when(mostly, "cleared:capture_quality_issue").when(d < 3, "cleared:brief_look_away")
        .when(F.col("left_seat") & (d < 5), "cleared:brief_seat_movement").otherwise("flagged")
    )
    moved = F.col("left_seat") & ~mostly & (d >= 5)
    kind = F.when(moved & F.col("left_fully"), "left_examination_area").when(moved, "left_seat_body_present").otherwise("no_candidate")
    severity = F.when(moved & F.col("left_fully"), "high").when(moved, F.when(d >= 30, "high").otherwise("medium")).when(d >= 120, "high").when(d >= 30, "medium").otherwise("low")
    return finish(eps, kind, verdict, severity)


def second_person(obs: DataFrame, gap_ms: int = 22_000) -> DataFrame:
    flags = ["interacting", "passing", "adjacent", "staff", "admin_speech", "integrity_speech", "gaze_away"]
    only = F.bool_and(F.coalesce(F.col("reflection"), F.lit(False))).alias("all_reflection")
    eps = built(obs, F.col("person_visible"), gap_ms, [*map(some, flags), only])
    c, d = F.col, F.col("dur_sec")
    official = (c("staff") | c("admin_speech")) & ~c("integrity_speech")
    helped = c("gaze_away") | c("integrity_speech")
    verdict = (
        F.when(d < 3, "cleared:brief_appearance").when(c("all_reflection"), "cleared:reflection").when(official, "cleared:official")
        .when(c("interacting") & helped, "flagged").when(c("interacting"), "cleared:no_help_seen").when(c("passing"), "cleared:passing_by")
        .when(c("adjacent") & (d >= 30), "flagged")
    )
    kind = F.when(c("interacting"), "external_help").otherwise("multiple_faces")
    return finish(eps, kind, verdict, F.when(c("interacting"), "high").otherwise("medium"))


def gaze(obs: DataFrame, gap_ms: int = 22_000, segment_gap_ms: int = 45_000) -> DataFrame:
    off = F.coalesce(F.col("gaze").isin("left", "right", "down", "up", "away") & ~F.coalesce(F.col("second_monitor"), F.lit(False)), F.lit(False))
    mode = F.call_function("mode", F.col("gaze"), F.lit(True)).alias("direction")
    eps = built(obs, off, gap_ms, [mode, some("recurrent")])
    session = Window.partitionBy("sk")
    eps = eps.withColumn("n_eps", F.count("*").over(session)).withColumn("again", F.bool_or("recurrent").over(session))
    few = (F.col("n_eps") < 3) & ~F.col("again")
    cleared = eps.filter(few).groupBy("sk").agg(F.min("t0_ms").alias("t0_ms"), F.max("t1_ms").alias("t1_ms"), F.sum("dur_sec").alias("dur_sec"))
    cleared = finish(cleared, "suspicious_eye_movement", F.lit("cleared:isolated_glances"), "low")
    parts = island_ids(eps.filter(~few).drop("island"), ["sk", "direction"], ["t0_ms", "t1_ms"], "t0_ms", "t1_ms", segment_gap_ms)
    parts = parts.groupBy("sk", "direction", "island").agg(
        F.min("t0_ms").alias("t0_ms"), F.max("t1_ms").alias("t1_ms"),
        F.least(F.sum("dur_sec"), seconds(F.max("t1_ms") - F.min("t0_ms")).cast("long")).alias("dur_sec"), F.first("n_eps").alias("n_eps"),
    )
    total = F.sum("dur_sec").over(session)
    severity = F.when((F.col("n_eps") >= 8) | (F.col("total") >= 600), "high").when((F.col("n_eps") >= 5) | (F.col("total") >= 300), "medium").otherwise("low")
    return finish(parts.withColumn("total", total), "suspicious_eye_movement", F.lit("flagged"), severity).unionByName(cleared)


def phone(obs: DataFrame, gap_ms: int = 22_000) -> DataFrame:
    eps = built(obs, F.col("phone_visible"), gap_ms, [some("in_hand")])
    verdict = F.when(F.col("dur_sec") < 3, None).when(~F.col("in_hand"), "cleared:not_in_hand").otherwise("flagged")
    return finish(eps, "phone_usage", verdict, F.when(F.col("dur_sec") >= 30, "high").otherwise("medium"))


def wearable(obs: DataFrame, gap_ms: int = 22_000) -> DataFrame:
    flags = ["integrity_speech", "speech", "lip_mismatch", "off_camera", "ringtone"]
    eps = built(obs, F.col("earphone"), gap_ms, [*map(some, flags)])
    c = F.col
    contact = c("integrity_speech") | (c("speech") & (c("lip_mismatch") | c("off_camera") | c("ringtone")))
    verdict = F.when(c("dur_sec") < 3, None).when(~contact, "cleared:no_contact").otherwise("flagged")
    return finish(eps, "audio_wearable", verdict, F.when(c("dur_sec") >= 30, "high").otherwise("medium"))


def speech(obs: DataFrame, gap_ms: int = 22_000) -> DataFrame:
    said = F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("start_ms", "ord", "summary"))), lambda x: x["summary"])), " ")
    eps = built(obs, F.col("speech"), gap_ms, [some("integrity_speech"), said.alias("said")])
    verdict = F.when(F.col("dur_sec") < 2, None).when(F.col("said") == "", "unknown:no_summary").when(F.col("integrity_speech"), "flagged").otherwise("contextual:ordinary_speech")
    return finish(eps, "discussing_solution_audio", verdict, "high")


def clear_by_staff(findings: DataFrame, staff_speech: DataFrame, integrity: DataFrame) -> DataFrame:
    """Help and extra faces that overlap staff speech and no integrity speech are cleared.

    A finding overlaps one of a set of spans if, of those that start before its end, the latest end lies behind its start: one
    window over both sets and the findings, without pairs.
    """
    point = lambda df, at, **ends: df.withColumns({"_at": F.col(at), **{k: F.col(v) if v else F.lit(None).cast("bigint") for k, v in ends.items()}})
    rows = point(findings.withColumn("_finding", F.lit(True)), "t1_ms", _staff=None, _other=None)
    spans = point(staff_speech, "start_ms", _staff="end_ms", _other=None).unionByName(point(integrity, "start_ms", _staff=None, _other="end_ms"), allowMissingColumns=True)
    rows = rows.unionByName(spans.select("sk", "_at", "_staff", "_other"), allowMissingColumns=True)
    before = Window.partitionBy("sk").orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    meets = lambda ends: F.coalesce(F.max(ends).over(before) > F.col("t0_ms"), F.lit(False))
    rows = rows.withColumns({"_by_staff": meets("_staff"), "_by_other": meets("_other")}).filter("_finding")
    gone = F.col("_by_staff") & ~F.col("_by_other") & (F.col("outcome") == "flagged") & F.col("event_type").isin("external_help", "multiple_faces")
    whole = F.greatest(F.lit(1), seconds(F.col("t1_ms") - F.col("t0_ms"))).cast("bigint")
    instead = {"reason": F.lit("staff_speech"), "dur_sec": whole, "outcome": F.lit("cleared")}
    return rows.withColumn("_gone", F.coalesce(gone, F.lit(False))).withColumns({c: F.when(F.col("_gone"), v).otherwise(F.col(c)) for c, v in instead.items()}).select(COLUMNS)


def screen(obs: DataFrame, flags: dict[str, str], gap_ms: int = 90_000) -> DataFrame:
    """Episodes per flag column with the time of their most confident row; ``flags`` maps columns to event types."""
    names = F.array(*[F.when(F.coalesce(F.col(c), F.lit(False)), F.lit(t)) for c, t in flags.items()])
    rows = obs.withColumn("event_type", F.explode(F.array_compact(names)))
    rows = island_ids(rows, ["sk", "event_type"], ["start_ms", "ord"], "start_ms", "end_ms", gap_ms)
    peak = F.max_by(F.floor((F.col("start_ms") + F.col("end_ms")) / 2), F.struct(F.col("confidence"), (-F.col("ord")).alias("o")))
    return rows.groupBy("sk", "event_type", "island").agg(
        F.min("start_ms").alias("t0_ms"), F.max("end_ms").alias("t1_ms"), F.max("confidence").alias("confidence"), peak.alias("peak_ms")
    ).drop("island")


def rapid_typing(stopped: DataFrame) -> DataFrame:
    """Typing above 30 characters a second with three insertions or more, outside choice sections."""
    return stopped.filter((F.col("chars_per_second") > 30) & (F.col("insertions") >= 3) & (F.coalesce("section_type", F.lit("")) != "MCQ"))
