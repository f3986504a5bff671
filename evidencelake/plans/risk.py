"""Risk-factor detectors: temporal patterns over event tables, each a DataFrame of contributions.

A contribution is (sk, factor_id, t0_ms, t1_ms, q, score_milli): the factor's weight times an intensity in [0, 1], kept as whole
thousandths so that sums are exact.  Detectors take their thresholds from ``Config`` and never look across sessions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.operators import folds, joins
from evidencelake.operators.joins import first_match, overlaps, same_or_missing, where_met

#: Event tables are few rows a session and partitioned by it (see ``by_session``), so a session's rows meet without an exchange.
follow, overlap = partial(joins.follow, bucketed=False), partial(joins.overlap, bucketed=False)

#: Weights of the factors (fixed values).
WEIGHTS = {
    "paste_after_blur": 12, "idle_then_large_paste": 10, "video_overlap_paste": 14, "video_overlap_submission": 18, "gaze_off_then_input": 8,
    "improbable_hard_fast_paste": 20, "paste_on_coding_question": 8, "phone_fast_correct": 18, "phone_fast_mcq_answers": 16, "gaze_fast_correct": 14,
    "gaze_with_device": 16, "gaze_then_answer_commit": 10, "speech_then_correct_hard": 18, "whisper_then_paste": 16, "av_mismatch_then_input": 14,
    "gaze_off_then_speech_then_answer": 18, "blur_fast_correct": 16, "camera_absent_fast_correct": 16, "out_of_order_submission_hop": 8,
    "large_unattributed_gap": 6, "face_absent_then_paste": 14, "external_resource_then_paste": 14, "face_absent_during_input": 14,
    "gaze_then_correct_mcq_burst": 12, "speech_coaching_then_fast_correct": 18, "second_person_then_paste_or_correct": 16,
    "idle_gap_then_fast_correct": 14, "deterministic_paste_workflow": 16, "interact_speech_input_correct": 18,
}


@dataclass(frozen=True)
class Config:
    """Thresholds in milliseconds; the defaults are those of a live session."""

    blur_to_paste: int = 15_000
    idle_to_paste: int = 10_000
    pad: int = 5_000
    gaze_to_input: int = 20_000
    gaze_to_answer: int = 6_000
    device_pad: int = 8_000
    speech_lead: int = 5_000
    speech_to_question: int = 45_000
    speech_to_paste: int = 20_000
    speech_to_input: int = 15_000
    blur_to_question: int = 60_000
    gap_to_question: int = 10_000
    absence_to_paste: int = 15_000
    unattributed: int = 180_000
    correction_lead: int = 5_000
    correction_lag: int = 15_000
    bucket: int = 30_000
    large_chars: int = 200
    burst_gap: int = 3_000


@dataclass
class EventTables:
    """All tables have sk, ord, start_ms, end_ms; questions and pastes also q, sec, hard or chars."""

    blur: DataFrame
    gap: DataFrame
    paste: DataFrame
    answer: DataFrame
    submission: DataFrame
    correction: DataFrame
    gaze: DataFrame
    phone: DataFrame
    person: DataFrame
    speech: DataFrame
    absence: DataFrame
    question: DataFrame
    burst: DataFrame
    config: Config = field(default_factory=Config)


Detector = Callable[[EventTables], DataFrame]
DETECTORS: dict[str, Detector] = {}


def detector(f: Detector) -> Detector:
    """Registers a detector by its name; own detectors register the same way."""
    DETECTORS[f.__name__] = f
    return f


def by_session(rows: DataFrame) -> DataFrame:
    """The same rows, gathered once by session; rows without a session are left out, as they belong to none.

    All tables that are cut from the result share this one exchange, and what they are joined, windowed and grouped by
    begins with the session, so nothing is exchanged again.
    """
    return gathered(rows.filter("sk is not null"))


def gathered(rows: DataFrame) -> DataFrame:
    """The same rows, gathered once by session, those without one, too."""
    lists = rows.groupBy("sk").agg(F.collect_list(F.struct(*[c for c in rows.columns if c != "sk"])).alias("rows"))
    return lists.select("sk", F.inline("rows"))


def contribution(df: DataFrame, factor: str, intensity: Column | float, t0: str | Column, t1: str | Column, q: str | Column | None = None) -> DataFrame:
    amount = F.lit(intensity) if isinstance(intensity, float) else intensity
    score = F.floor(F.least(F.lit(1.0), F.greatest(F.lit(0.0), amount)) * float(1000 * WEIGHTS[factor])).cast("bigint")
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    question = F.lit(None).cast("bigint") if q is None else as_col(q).cast("bigint")
    return df.select("sk", F.lit(factor).alias("factor_id"), as_col(t0).alias("t0_ms"), as_col(t1).alias("t1_ms"), question.alias("q"), score.alias("score_milli"))


def faded(within: int, least: float) -> Column:
    """Falls from 1 to ``least`` as B comes later after A."""
    return F.greatest(F.lit(least), 1.0 - (F.col("b_start_ms") - F.col("end_ms")) / float(within))


def earliest(pairs: DataFrame) -> DataFrame:
    """Each B keeps its earliest A."""
    return first_match(pairs, ["sk", "b_ord"], ["start_ms", "ord"])


def inside(question: DataFrame, paste: DataFrame, met: bool) -> DataFrame:
    """Questions with or without a paste inside their window on the same question."""
    meets = overlaps(F.col("start_ms"), F.col("end_ms"), F.col("b_start_ms"), F.col("b_end_ms")) & same_or_missing(F.col("q"), F.col("b_q"))
    return where_met(question, paste, ["sk"], meets, met)


@detector
def d1_paste_after_blur(e: EventTables) -> DataFrame:
    pairs = follow(e.blur, e.paste, ["sk"], e.config.blur_to_paste, condition=same_or_missing(F.col("sec"), F.col("b_sec")))
    return contribution(earliest(pairs), "paste_after_blur", faded(e.config.blur_to_paste, 0.35), "start_ms", "b_start_ms", "b_q")


@detector
def d2_idle_then_large_paste(e: EventTables) -> DataFrame:
    pairs = follow(e.gap, e.paste, ["sk"], e.config.idle_to_paste)
    return contribution(earliest(pairs), "idle_then_large_paste", faded(e.config.idle_to_paste, 0.35), "start_ms", "b_start_ms", "b_q")


@detector
def d3_video_overlap(e: EventTables) -> DataFrame:
    seen = e.phone.unionByName(e.person)
    lag = F.col("start_ms") - F.col("b_end_ms")
    pastes = where_met(e.paste, e.blur, ["sk"], (lag >= 0) & (lag <= e.config.blur_to_paste))
    meet = lambda rows: overlap(seen, rows, ["sk"], pad_ms=e.config.pad)
    first = first_match(meet(pastes), ["sk", "ord"], ["b_start_ms", "b_ord"])
    return contribution(first, "video_overlap_paste", 0.8, "start_ms", "b_start_ms", "b_q").unionByName(
        contribution(meet(e.submission), "video_overlap_submission", 0.8, "start_ms", "b_start_ms", "b_q")
    )


@detector
def d4_gaze_off_then_input(e: EventTables) -> DataFrame:
    inputs = e.answer.unionByName(e.paste, allowMissingColumns=True)
    limit = e.config.gaze_to_input
    taken = folds.greedy_pairs(
        e.gaze.withColumn("a", F.struct("start_ms", "end_ms")), inputs.withColumn("b", F.struct("start_ms", "ord", "q")), ["sk"],
        lambda x, y: (y["start_ms"] >= x["end_ms"]) & (y["start_ms"] - x["end_ms"] <= limit),
        lambda x, y: y["start_ms"] - x["end_ms"], ["start_ms", "ord", "end_ms", "a"], ["start_ms", "ord", "b"], "a", "b",
        reach=lambda a: (F.col("start_ms"), F.col("end_ms") + limit),
    )
    joined = taken.select("sk", "a.start_ms", "a.end_ms", F.col("b_b.start_ms").alias("b_start_ms"), F.col("b_b.q").alias("b_q"))
    return contribution(joined, "gaze_off_then_input", faded(limit, 0.4), "start_ms", "b_start_ms", "b_q")


@detector
def d5_improbable_hard_fast_paste(e: EventTables) -> DataFrame:
    pairs = overlap(e.question.filter("hard"), e.paste, ["sk"], condition=same_or_missing(F.col("q"), F.col("b_q")))
    last = first_match(pairs, ["sk", "ord"], [F.desc("b_start_ms"), "b_ord"])
    return contribution(last, "improbable_hard_fast_paste", 0.9, "start_ms", "end_ms", "q")


@detector
def d6_paste_on_coding_question(e: EventTables) -> DataFrame:
    by = e.paste.groupBy("sk", "q").agg(
        F.count("*").alias("n"), F.max("chars").alias("most"), F.min("start_ms").alias("t0"), F.max("start_ms").alias("t1")
    ).filter((F.col("n") >= 2) | (F.col("most") >= e.config.large_chars))
    return contribution(by, "paste_on_coding_question", 0.5 + 0.2 * F.col("n"), "t0", "t1", "q")


@detector
def d7_phone_fast_correct(e: EventTables) -> DataFrame:
    return contribution(overlap(e.phone, e.question, ["sk"], pad_ms=e.config.pad), "phone_fast_correct", 0.85, "start_ms", "b_end_ms", "b_q")


@detector
def d8_phone_fast_mcq_answers(e: EventTables) -> DataFrame:
    pairs = overlap(e.phone, e.burst, ["sk"], pad_ms=e.config.pad)
    return contribution(pairs, "phone_fast_mcq_answers", 0.6 + 0.05 * F.col("b_n"), "start_ms", "b_end_ms")


@detector
def d9_gaze_fast_correct(e: EventTables) -> DataFrame:
    free = inside(e.question, e.paste, False)
    return contribution(overlap(e.gaze, free, ["sk"]), "gaze_fast_correct", 0.7, "start_ms", "b_end_ms", "b_q")


@detector
def d10_gaze_with_device(e: EventTables) -> DataFrame:
    return contribution(overlap(e.gaze, e.phone, ["sk"], pad_ms=e.config.device_pad), "gaze_with_device", 0.75, "start_ms", "b_end_ms")


@detector
def d11_gaze_then_answer_commit(e: EventTables) -> DataFrame:
    pairs = follow(e.gaze, e.answer, ["sk"], e.config.gaze_to_answer)
    near = first_match(pairs, ["sk", "ord"], ["b_start_ms", "b_ord"])
    near = near.select("sk", "start_ms", "end_ms", F.col("b_start_ms").alias("input_ms"), F.col("b_q").alias("input_q"))
    between = (F.col("b_start_ms") > F.col("end_ms")) & (F.col("b_start_ms") < F.col("input_ms"))
    free = where_met(near, e.blur, ["sk"], between, False)
    repeat = F.count("*").over(Window.partitionBy("sk"))
    return contribution(free.withColumn("n", repeat), "gaze_then_answer_commit", 0.5 + 0.1 * F.least(F.col("n"), F.lit(5)), "start_ms", "input_ms", "input_q")


@detector
def d12_speech_then_correct_hard(e: EventTables) -> DataFrame:
    pairs = follow(e.speech, e.question.filter("hard"), ["sk"], e.config.speech_to_question, lead_ms=e.config.speech_lead)
    return contribution(pairs, "speech_then_correct_hard", 0.8, "start_ms", "b_end_ms", "b_q")


@detector
def d13_whisper_then_paste(e: EventTables) -> DataFrame:
    return contribution(follow(e.speech.filter("whisper"), e.paste, ["sk"], e.config.speech_to_paste), "whisper_then_paste", 0.8, "start_ms", "b_start_ms", "b_q")


@detector
def d14_av_mismatch_then_input(e: EventTables) -> DataFrame:
    inputs = e.answer.unionByName(e.paste, allowMissingColumns=True)
    return contribution(follow(e.speech.filter("not whisper"), inputs, ["sk"], e.config.speech_to_input), "av_mismatch_then_input", 0.75, "start_ms", "b_start_ms", "b_q")


@detector
def d15_gaze_speech_answer(e: EventTables) -> DataFrame:
    talk = e.speech.select("sk", "ord", "start_ms", "end_ms")
    after = follow(e.gaze.select("sk", "ord", "start_ms", "end_ms"), talk, ["sk"], e.config.speech_to_paste)
    talks = after.select("sk", F.col("ord").alias("gaze_ord"), F.col("start_ms").alias("gaze_ms"), F.col("b_ord").alias("ord"), F.col("b_start_ms").alias("start_ms"))
    chain = follow(talks, e.answer, ["sk"], e.config.speech_to_question, a_end="start_ms")
    return contribution(chain, "gaze_off_then_speech_then_answer", 0.85, "gaze_ms", "b_start_ms", "b_q")


@detector
def d16_blur_fast_correct(e: EventTables) -> DataFrame:
    ends = lambda rows: rows.withColumn("start_ms", F.col("end_ms"))
    meet = lambda met: follow(e.blur, ends(inside(e.question, e.paste, met)), ["sk"], e.config.blur_to_question)
    return contribution(meet(False), "blur_fast_correct", 0.7, "start_ms", "b_end_ms", "b_q").unionByName(
        contribution(meet(True), "paste_after_blur", 0.95, "start_ms", "b_end_ms", "b_q")
    )


@detector
def d17_camera_absent_fast_correct(e: EventTables) -> DataFrame:
    meet = lambda met: overlap(e.absence, inside(e.question, e.paste, met), ["sk"])
    return contribution(meet(False), "camera_absent_fast_correct", 0.7, "start_ms", "b_end_ms", "b_q").unionByName(
        contribution(meet(True), "paste_after_blur", 0.9, "start_ms", "b_end_ms", "b_q")
    )


@detector
def d18_out_of_order_submission_hop(e: EventTables) -> DataFrame:
    w = Window.partitionBy("sk").orderBy("start_ms", "ord")
    back = e.submission.withColumn("down", F.col("q") < F.lag("q").over(w)).groupBy("sk").agg(
        F.count("*").alias("n"), F.count_if("down").alias("r"), F.min("start_ms").alias("t0"), F.max("start_ms").alias("t1")
    ).filter("n >= 3 and r >= 2")
    return contribution(back, "out_of_order_submission_hop", 0.4 + 0.15 * F.col("r"), "t0", "t1")


@detector
def d19_large_unattributed_gap(e: EventTables) -> DataFrame:
    by = e.question.groupBy("sk", "sec").agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("known")
    ).filter(F.col("end_ms") - F.col("start_ms") - F.col("known") >= e.config.unattributed)
    left = overlap(by, e.blur, ["sk"], pad_ms=e.config.bucket).select("sk", "sec", "start_ms", "end_ms").distinct()
    return contribution(left, "large_unattributed_gap", 0.6, "start_ms", "end_ms")


@detector
def d20_face_absent_then_paste(e: EventTables) -> DataFrame:
    return contribution(follow(e.absence, e.paste, ["sk"], e.config.absence_to_paste), "face_absent_then_paste", 0.75, "start_ms", "b_start_ms", "b_q")


@detector
def d21_external_resource_then_paste(e: EventTables) -> DataFrame:
    pairs = follow(e.person, e.paste, ["sk"], e.config.speech_to_paste, lead_ms=e.config.pad)
    return contribution(pairs, "external_resource_then_paste", 0.5 + F.least(F.lit(0.4), F.col("b_chars") / 200.0), "start_ms", "b_start_ms", "b_q")


@detector
def d22_face_absent_during_input(e: EventTables) -> DataFrame:
    inputs = e.answer.unionByName(e.paste, allowMissingColumns=True)
    return contribution(overlap(e.absence, inputs, ["sk"], pad_ms=e.config.pad), "face_absent_during_input", 0.7, "start_ms", "b_start_ms", "b_q")


@detector
def d23_gaze_then_correct_mcq_burst(e: EventTables) -> DataFrame:
    return contribution(overlap(e.gaze, e.burst, ["sk"]), "gaze_then_correct_mcq_burst", 0.65, "start_ms", "b_end_ms")


@detector
def d24_speech_coaching_then_fast_correct(e: EventTables) -> DataFrame:
    pad = e.config.speech_to_question
    meets = (F.col("start_ms") - pad <= F.col("b_end_ms")) & (F.col("b_start_ms") <= F.col("end_ms") + pad)
    pairs = follow(e.speech, e.question, ["sk"], pad, lead_ms=e.config.speech_lead, condition=meets)
    return contribution(pairs, "speech_coaching_then_fast_correct", 0.85, "start_ms", "b_end_ms", "b_q")


@detector
def d25_second_person_then_paste_or_correct(e: EventTables) -> DataFrame:
    pasted = contribution(follow(e.person, e.paste, ["sk"], e.config.absence_to_paste), "second_person_then_paste_or_correct", 0.8, "start_ms", "b_start_ms", "b_q")
    right = contribution(overlap(e.person, e.question, ["sk"]), "second_person_then_paste_or_correct", 0.8, "start_ms", "b_end_ms", "b_q")
    return pasted.unionByName(right)


@detector
def d26_idle_gap_then_fast_correct(e: EventTables) -> DataFrame:
    pairs = follow(e.gap, inside(e.question, e.paste, False), ["sk"], e.config.gap_to_question)
    return contribution(pairs, "idle_gap_then_fast_correct", 0.7, "start_ms", "b_end_ms", "b_q")


@detector
def d27_deterministic_paste_workflow(e: EventTables) -> DataFrame:
    near = follow(e.paste, e.correction, ["sk"], e.config.correction_lag, lead_ms=e.config.correction_lead)
    fixed = near.select("sk", "ord", "q", "start_ms").distinct()
    by = fixed.groupBy("sk", "q").agg(F.count("*").alias("n"), F.min("start_ms").alias("t0"), F.max("start_ms").alias("t1")).filter("n >= 2")
    session = e.correction.groupBy("sk").agg(F.count("*").alias("n"), F.min("start_ms").alias("t0"), F.max("start_ms").alias("t1")).filter("n >= 2")
    rest = where_met(session, by, ["sk"], F.lit(True), False)
    return contribution(by, "deterministic_paste_workflow", 0.9, "t0", "t1", "q").unionByName(contribution(rest, "deterministic_paste_workflow", 0.5, "t0", "t1"))


@detector
def d28_interact_speech_input_correct(e: EventTables) -> DataFrame:
    talk = e.person.unionByName(e.speech, allowMissingColumns=True)
    inputs = e.answer.unionByName(e.paste, allowMissingColumns=True)
    first = overlap(e.question, inputs, ["sk"], pad_ms=e.config.pad, condition=same_or_missing(F.col("q"), F.col("b_q")))
    answered = first.groupBy("sk", "ord", "start_ms", "end_ms", "q").agg(F.min("b_start_ms").alias("first_input"))
    pairs = overlap(talk, answered, ["sk"], pad_ms=e.config.pad)
    ready = pairs.filter(F.col("b_first_input") >= F.col("start_ms") - 2000)
    return contribution(ready, "interact_speech_input_correct", 0.85, "start_ms", "b_end_ms", "b_q")


def detect_all(e: EventTables, names: Sequence[str] | None = None) -> DataFrame:
    """The union of all registered detectors, or of those named."""
    out = None
    for name in DETECTORS if names is None else names:
        out = DETECTORS[name](e) if out is None else out.unionByName(DETECTORS[name](e))
    return out


def dedupe(contributions: DataFrame, bucket_ms: int) -> DataFrame:
    """The best contribution per factor, question (else session) and time bucket."""
    rows = contributions.withColumn("bucket", F.floor(F.col("t0_ms") / bucket_ms))
    return first_match(rows, ["sk", "factor_id", "q", "bucket"], [F.desc("score_milli"), "t0_ms", "t1_ms"])


def totals(contributions: DataFrame, cap: int = 100, raw: bool = False) -> DataFrame:
    """Capped score, number of contributions and of factors per session; ``raw`` adds the sum before the cap."""
    whole = F.sum("score_milli")
    more = [whole.cast("bigint").alias("raw_milli")] if raw else []
    return contributions.groupBy("sk").agg(
        F.least(F.lit(cap * 1000), whole).cast("bigint").alias("total_milli"), *more, F.count("*").alias("n_contributions"), F.count_distinct("factor_id").alias("n_factors")
    )


def lane(score_milli: Column, weight: Column) -> Column:
    share = score_milli / (1000.0 * weight)
    return F.when(share >= 0.75, "red").when(share >= 0.5, "amber").otherwise("green")
