"""Risk detectors over binding E: errors are blurs, purchases pastes, clicks answers and questions, views gazes (some with a phone or a helper)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.operators import sequences
from evidencelake.plans import risk, sweep
from evidencelake.plans.registry import HOUR, N, events, of_kind, query

CONFIG = risk.Config(
    blur_to_paste=N, idle_to_paste=N, pad=HOUR, gaze_to_input=N, gaze_to_answer=N, device_pad=HOUR, speech_lead=HOUR, speech_to_question=2 * N,
    speech_to_paste=2 * N, speech_to_input=N, blur_to_question=N, gap_to_question=N, absence_to_paste=N, unattributed=10 * HOUR, correction_lead=HOUR,
    correction_lag=N, bucket=24 * HOUR, large_chars=80, burst_gap=30 * HOUR,
)


def event_rows(spark, sf_dir) -> DataFrame:
    """Events with their roles, gathered by session once: an event has a row for each table that holds it."""
    rows = risk.by_session(events(spark, sf_dir).filter("t_ms is not null"))
    rows = rows.selectExpr("*", "k % 10 as q", "string(k % 3) as sec", "bigint(floor(value * 360000)) as length", "bigint(floor(value)) as chars", "k % 5 = 0 as hard", "k % 2 = 0 as whisper")

    def row(when: str, role: str, *has: str, start: str = "t_ms", end: str = "t_ms") -> str:
        extra = ", ".join(f"'{c}', cast({c if c in has else 'null'} as {kind})" for c, kind in sweep.EXTRA.items())
        return f"if({when}, named_struct('role', '{role}', 'start_ms', {start}, 'end_ms', {end}, {extra}), null)"

    span = "t_ms + length"
    roles = [
        row("kind = 'error'", "blur", "sec"), row("kind = 'error'", "absence", end=span), row("kind = 'purchase'", "paste", "q", "sec", "chars"),
        row("kind = 'purchase' and k % 2 = 0", "submission", "q"), row("kind = 'click' and k % 2 = 0", "answer", "q"), row("kind = 'click' and k % 2 = 1", "correction"),
        row("kind = 'click'", "question", "q", "sec", "hard", start="t_ms - length"), row("kind = 'view'", "gaze", end=span),
        row("kind = 'view' and k % 3 = 0", "phone", end=span), row("kind = 'view' and k % 3 = 1", "person", end=span), row("kind = 'signup'", "speech", "whisper", end=span),
    ]
    single = rows.selectExpr("sk", "ord", f"inline(array_compact(array({', '.join(roles)})))")
    single = single.select("sk", "role", "ord", "start_ms", "end_ms", *sweep.EXTRA)
    w = Window.partitionBy("sk").orderBy("t_ms", "ord")
    idle = of_kind(rows, "click", "purchase").withColumn("start_ms", F.lag("t_ms").over(w)).withColumn("end_ms", F.col("t_ms")).filter(F.col("end_ms") - F.col("start_ms") >= 10 * HOUR)
    runs = sequences.bursts(of_kind(rows, "click"), ["sk"], ["t_ms", "ord"], gap_ms=CONFIG.burst_gap)
    burst = runs.select("sk", F.col("t0_ms").alias("ord"), F.col("t0_ms").alias("start_ms"), F.col("t1_ms").alias("end_ms"), F.col("n_events").alias("n"))
    return single.unionByName(sweep.tag(idle.select("sk", "ord", "start_ms", "end_ms"), "gap")).unionByName(sweep.tag(burst, "burst"))


def event_tables(spark, sf_dir) -> risk.EventTables:
    return sweep.tables(event_rows(spark, sf_dir), CONFIG)


TABLES = """pt AS (SELECT *, t_ms AS start_ms, t_ms AS end_ms, k % 10 AS q, k % 3 AS sec, CAST(floor(value * 360000) AS BIGINT) AS len FROM ev),
sp AS (SELECT * REPLACE (t_ms + len AS end_ms) FROM pt),
blur AS (SELECT * FROM pt WHERE kind = 'error'), paste AS (SELECT *, CAST(floor(value) AS BIGINT) AS chars FROM pt WHERE kind = 'purchase'),
answer AS (SELECT * FROM pt WHERE kind = 'click' AND k % 2 = 0), submission AS (SELECT * FROM pt WHERE kind = 'purchase' AND k % 2 = 0),
correction AS (SELECT * FROM pt WHERE kind = 'click' AND k % 2 = 1), input AS (SELECT sk, ord, start_ms, end_ms, q FROM answer UNION ALL SELECT sk, ord, start_ms, end_ms, q FROM paste),
gaze AS (SELECT * FROM sp WHERE kind = 'view'), phone AS (SELECT * FROM gaze WHERE k % 3 = 0), person AS (SELECT * FROM gaze WHERE k % 3 = 1),
speech AS (SELECT *, k % 2 = 0 AS whisper FROM sp WHERE kind = 'signup'), absence AS (SELECT * FROM sp WHERE kind = 'error'),
question AS (SELECT * REPLACE (t_ms - len AS start_ms), k % 5 = 0 AS hard FROM pt WHERE kind = 'click'),
gap AS (SELECT sk, ord, p AS start_ms, t_ms AS end_ms FROM (SELECT *, lag(t_ms) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS p FROM ev WHERE kind IN ('click', 'purchase')) WHERE t_ms - p >= 36000000),
bi AS (SELECT *, sum(CASE WHEN step <= 108000000 THEN 0 ELSE 1 END) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS isl FROM (SELECT *, t_ms - lag(t_ms) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS step FROM ev WHERE kind = 'click')),
burst AS (SELECT sk, min(t_ms) AS ord, min(t_ms) AS start_ms, max(t_ms) AS end_ms, CAST(NULL AS BIGINT) AS q, count(*) AS n FROM bi GROUP BY sk, isl HAVING count(*) >= 3),
withp AS (SELECT DISTINCT a.sk, a.ord FROM question a JOIN paste b ON a.sk = b.sk AND a.q = b.q AND b.start_ms BETWEEN a.start_ms AND a.end_ms),
qfree AS (SELECT question.* FROM question ANTI JOIN withp USING (sk, ord)), qpaste AS (SELECT question.* FROM question SEMI JOIN withp USING (sk, ord))"""

EMIT = "SELECT sk, '{factor}' AS factor_id, {t0} AS t0_ms, {t1} AS t1_ms, CAST({q} AS BIGINT) AS q, CAST(floor(least(1.0::DOUBLE, greatest(0.0::DOUBLE, {intensity})) * {weight}::DOUBLE) AS BIGINT) AS score_milli FROM {src}"


def emit(src: str, factor: str, intensity: str, t0: str, t1: str, q: str = "NULL") -> str:
    number = f"{intensity}::DOUBLE" if intensity.replace(".", "").isdigit() else intensity
    return EMIT.format(src=src, factor=factor, intensity=number, t0=t0, t1=t1, q=q, weight=1000 * risk.WEIGHTS[factor])


PAIR = "a.sk, a.ord, a.start_ms, a.end_ms, b.ord AS b_ord, b.start_ms AS b_start_ms, b.end_ms AS b_end_ms, b.q AS b_q"


def then(a: str, b: str, within: int, lead: int = 0, more: str = "", cols: str = "", at: str = "start_ms") -> str:
    return f"(SELECT {PAIR}{cols} FROM {a} a JOIN {b} b ON a.sk = b.sk AND b.{at} - a.end_ms BETWEEN {-lead} AND {within} {more})"


def meet(a: str, b: str, pad: int = 0, more: str = "", cols: str = "") -> str:
    return f"(SELECT {PAIR}{cols} FROM {a} a JOIN {b} b ON a.sk = b.sk AND a.start_ms - {pad} <= b.end_ms AND b.start_ms <= a.end_ms + {pad} {more})"


def first(src: str, by: str, order: str) -> str:
    return f"(SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY sk, {by} ORDER BY {order}) = 1)"


def greedy(a: str, b: str, near: str, cost: str, order: str, ctes: str = "") -> str:
    """Each row of ``a`` in order takes the unused row of ``b`` with the least cost: (sk, ord, b_ord), one step of recursion a row."""
    return f"""{ctes}ga AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY {order}) AS rn FROM {a}),
    st AS (SELECT DISTINCT sk, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS ord, CAST(NULL AS BIGINT) AS b_ord FROM ga
    UNION ALL SELECT sk, i + 1, CASE WHEN b IS NULL THEN used ELSE list_append(used, b) END, o, b FROM (
        SELECT st.sk, st.i, st.used, a.ord AS o, b.ord AS b, row_number() OVER (PARTITION BY st.sk ORDER BY CASE WHEN b.ord IS NULL THEN 1 ELSE 0 END, {cost}, b.{order.split(', ')[0]}, b.ord) AS pick
        FROM st JOIN ga a ON a.sk = st.sk AND a.rn = st.i + 1 LEFT JOIN {b} b ON b.sk = a.sk AND {near} AND NOT list_contains(st.used, b.ord)) WHERE pick = 1)"""


GREEDY_D4 = greedy("gaze", "input", f"b.start_ms - a.end_ms BETWEEN 0 AND {N}", "b.start_ms - a.end_ms", "start_ms, ord")
D4_FROM = "(SELECT g.sk, g.start_ms, g.end_ms, x.start_ms AS b_start_ms, x.q AS b_q FROM st JOIN gaze g ON g.sk = st.sk AND g.ord = st.ord JOIN input x ON x.sk = st.sk AND x.ord = st.b_ord)"

FADE = "greatest({least}::DOUBLE, 1.0::DOUBLE - (b_start_ms - end_ms) / {within}::DOUBLE)"
FREE = "(SELECT p.*, count(*) OVER (PARTITION BY p.sk) AS n FROM {near} p WHERE NOT EXISTS (SELECT 1 FROM blur x WHERE x.sk = p.sk AND x.t_ms > p.end_ms AND x.t_ms < p.b_start_ms))"
c = CONFIG
SQL = {
    "d1_paste_after_blur": emit(first(then("blur", "paste", N, more="AND a.sec = b.sec"), "b_ord", "start_ms, ord"), "paste_after_blur", FADE.format(least=0.35, within=N), "start_ms", "b_start_ms", "b_q"),
    "d2_idle_then_large_paste": emit(first(then("gap", "paste", N), "b_ord", "start_ms, ord"), "idle_then_large_paste", FADE.format(least=0.35, within=N), "start_ms", "b_start_ms", "b_q"),
    "d3_video_overlap": emit(first(meet("(SELECT * FROM phone UNION ALL SELECT * FROM person)", f"(SELECT * FROM paste SEMI JOIN (SELECT sk, b_ord AS ord FROM {then('blur', 'paste', N)}) USING (sk, ord))", HOUR), "ord", "b_start_ms, b_ord"), "video_overlap_paste", "0.8", "start_ms", "b_start_ms", "b_q")
    + " UNION ALL " + emit(meet("(SELECT * FROM phone UNION ALL SELECT * FROM person)", "submission", HOUR), "video_overlap_submission", "0.8", "start_ms", "b_start_ms", "b_q"),
    "d4_gaze_off_then_input": emit(D4_FROM, "gaze_off_then_input", FADE.format(least=0.4, within=N), "start_ms", "b_start_ms", "b_q"),
    "d5_improbable_hard_fast_paste": emit(first(f"(SELECT {PAIR}, a.q FROM question a JOIN paste b ON a.sk = b.sk AND a.q = b.q AND a.hard AND b.start_ms BETWEEN a.start_ms AND a.end_ms)", "ord", "b_start_ms DESC, b_ord"), "improbable_hard_fast_paste", "0.9", "start_ms", "end_ms", "q"),
    "d6_paste_on_coding_question": emit("(SELECT sk, q, count(*) AS n, min(start_ms) AS t0, max(start_ms) AS t1 FROM paste GROUP BY sk, q HAVING count(*) >= 2 OR max(chars) >= 80)", "paste_on_coding_question", "0.5::DOUBLE + 0.2::DOUBLE * n", "t0", "t1", "q"),
    "d7_phone_fast_correct": emit(meet("phone", "question", HOUR), "phone_fast_correct", "0.85", "start_ms", "b_end_ms", "b_q"),
    "d8_phone_fast_mcq_answers": emit(meet("phone", "burst", HOUR, cols=", b.n AS b_n"), "phone_fast_mcq_answers", "0.6::DOUBLE + 0.05::DOUBLE * b_n", "start_ms", "b_end_ms"),
    "d9_gaze_fast_correct": emit(meet("gaze", "qfree"), "gaze_fast_correct", "0.7", "start_ms", "b_end_ms", "b_q"),
    "d10_gaze_with_device": emit(meet("gaze", "phone", HOUR), "gaze_with_device", "0.75", "start_ms", "b_end_ms"),
    "d11_gaze_then_answer_commit": emit(FREE.format(near=first(then("gaze", "answer", N), "ord", "b_start_ms, b_ord")), "gaze_then_answer_commit", "0.5::DOUBLE + 0.1::DOUBLE * least(n, 5)", "start_ms", "b_start_ms", "b_q"),
    "d12_speech_then_correct_hard": emit(then("speech", "question", 2 * N, HOUR, "AND b.hard"), "speech_then_correct_hard", "0.8", "start_ms", "b_end_ms", "b_q"),
    "d13_whisper_then_paste": emit(then("speech", "paste", 2 * N, more="AND a.whisper"), "whisper_then_paste", "0.8", "start_ms", "b_start_ms", "b_q"),
    "d14_av_mismatch_then_input": emit(then("speech", "input", N, more="AND NOT a.whisper"), "av_mismatch_then_input", "0.75", "start_ms", "b_start_ms", "b_q"),
    "d15_gaze_speech_answer": emit(f"(SELECT g.sk, g.start_ms, x.start_ms AS b_start_ms, x.q AS b_q FROM {then('gaze', 'speech', 2 * N)} g JOIN answer x ON g.sk = x.sk AND x.start_ms - g.b_start_ms BETWEEN 0 AND {2 * N})", "gaze_off_then_speech_then_answer", "0.85", "start_ms", "b_start_ms", "b_q"),
    "d16_blur_fast_correct": emit(then("blur", "qfree", N, at="end_ms"), "blur_fast_correct", "0.7", "start_ms", "b_end_ms", "b_q") + " UNION ALL " + emit(then("blur", "qpaste", N, at="end_ms"), "paste_after_blur", "0.95", "start_ms", "b_end_ms", "b_q"),
    "d17_camera_absent_fast_correct": emit(meet("absence", "qfree"), "camera_absent_fast_correct", "0.7", "start_ms", "b_end_ms", "b_q") + " UNION ALL " + emit(meet("absence", "qpaste"), "paste_after_blur", "0.9", "start_ms", "b_end_ms", "b_q"),
    "d18_out_of_order_submission_hop": emit("(SELECT sk, count_if(q < p) AS r, min(start_ms) AS t0, max(start_ms) AS t1 FROM (SELECT *, lag(q) OVER (PARTITION BY sk ORDER BY start_ms, ord) AS p FROM submission) GROUP BY sk HAVING count(*) >= 3 AND count_if(q < p) >= 2)", "out_of_order_submission_hop", "0.4::DOUBLE + 0.15::DOUBLE * r", "t0", "t1"),
    "d19_large_unattributed_gap": emit(f"(SELECT DISTINCT sk, sec, start_ms, end_ms FROM (SELECT a.* FROM (SELECT sk, sec, min(start_ms) AS start_ms, max(end_ms) AS end_ms, sum(end_ms - start_ms) AS known FROM question GROUP BY sk, sec) a JOIN blur b ON a.sk = b.sk AND a.end_ms - a.start_ms - a.known >= {10 * HOUR} AND a.start_ms - {24 * HOUR} <= b.end_ms AND b.start_ms <= a.end_ms + {24 * HOUR}))", "large_unattributed_gap", "0.6", "start_ms", "end_ms"),
    "d20_face_absent_then_paste": emit(then("absence", "paste", N), "face_absent_then_paste", "0.75", "start_ms", "b_start_ms", "b_q"),
    "d21_external_resource_then_paste": emit(then("person", "paste", 2 * N, HOUR, cols=", b.chars AS b_chars"), "external_resource_then_paste", "0.5::DOUBLE + least(0.4::DOUBLE, b_chars / 200.0::DOUBLE)", "start_ms", "b_start_ms", "b_q"),
    "d22_face_absent_during_input": emit(meet("absence", "input", HOUR), "face_absent_during_input", "0.7", "start_ms", "b_start_ms", "b_q"),
    "d23_gaze_then_correct_mcq_burst": emit(meet("gaze", "burst"), "gaze_then_correct_mcq_burst", "0.65", "start_ms", "b_end_ms"),
    "d24_speech_coaching_then_fast_correct": emit(then("speech", "question", 2 * N, HOUR, f"AND a.start_ms - {2 * N} <= b.end_ms AND b.start_ms <= a.end_ms + {2 * N}"), "speech_coaching_then_fast_correct", "0.85", "start_ms", "b_end_ms", "b_q"),
    "d25_second_person_then_paste_or_correct": emit(then("person", "paste", N), "second_person_then_paste_or_correct", "0.8", "start_ms", "b_start_ms", "b_q") + " UNION ALL " + emit(meet("person", "question"), "second_person_then_paste_or_correct", "0.8", "start_ms", "b_end_ms", "b_q"),
    "d26_idle_gap_then_fast_correct": emit(then("gap", "qfree", N), "idle_gap_then_fast_correct", "0.7", "start_ms", "b_end_ms", "b_q"),
    "d27_deterministic_paste_workflow": emit(f"(SELECT sk, q, min(start_ms) AS t0, max(start_ms) AS t1 FROM (SELECT DISTINCT a.sk, a.ord, a.q, a.start_ms FROM paste a JOIN correction b ON a.sk = b.sk AND b.start_ms - a.end_ms BETWEEN -{HOUR} AND {N}) GROUP BY sk, q HAVING count(*) >= 2)", "deterministic_paste_workflow", "0.9", "t0", "t1", "q")
    + " UNION ALL " + emit(f"(SELECT sk, min(start_ms) AS t0, max(start_ms) AS t1 FROM correction WHERE sk NOT IN (SELECT sk FROM (SELECT DISTINCT a.sk, a.ord, a.q FROM paste a JOIN correction b ON a.sk = b.sk AND b.start_ms - a.end_ms BETWEEN -{HOUR} AND {N}) GROUP BY sk, q HAVING count(*) >= 2) GROUP BY sk HAVING count(*) >= 2)", "deterministic_paste_workflow", "0.5", "t0", "t1"),
    "d28_interact_speech_input_correct": emit(f"(SELECT p.* FROM {meet('(SELECT sk, ord, start_ms, end_ms FROM person UNION ALL SELECT sk, ord, start_ms, end_ms FROM speech)', 'question', HOUR)} p JOIN (SELECT a.sk, a.ord, min(b.start_ms) AS f FROM question a JOIN input b ON a.sk = b.sk AND a.q = b.q AND a.start_ms - {HOUR} <= b.end_ms AND b.start_ms <= a.end_ms + {HOUR} GROUP BY a.sk, a.ord) i ON p.sk = i.sk AND p.b_ord = i.ord AND i.f >= p.start_ms - 2000)", "interact_speech_input_correct", "0.85", "start_ms", "b_end_ms", "b_q"),
}


def _register(name: str, f: risk.Detector) -> None:
    more = f", {GREEDY_D4}" if name == "d4_gaze_off_then_input" else ""
    query(f"+ {TABLES}{more} {SQL[name]}", name)(lambda spark, sf_dir: f(event_tables(spark, sf_dir)))


for _name, _f in risk.DETECTORS.items():
    _register(_name, _f)

BEST = "SELECT * FROM ({src}) QUALIFY row_number() OVER (PARTITION BY sk, factor_id, q, t0_ms // {bucket} ORDER BY score_milli DESC, t0_ms, t1_ms) = 1"
D1_BEST = BEST.format(src=SQL["d1_paste_after_blur"], bucket=24 * HOUR)


@query(f"+ {TABLES}, best AS ({D1_BEST}) SELECT sk, CAST(least(100000, sum(score_milli)) AS BIGINT) AS total_milli, count(*) AS n_contributions, count(DISTINCT factor_id) AS n_factors FROM best GROUP BY sk")
def flagship_risk_score(spark, sf_dir) -> DataFrame:
    """Leave, then paste within six hours: best score per question and day, capped total per session."""
    return risk.totals(risk.dedupe(risk.d1_paste_after_blur(event_tables(spark, sf_dir)), CONFIG.bucket))


@query(f"+ {TABLES} SELECT sk, factor_id, t0_ms, t1_ms, q, score_milli FROM ({D1_BEST})")
def k3_best_per_bucket(spark, sf_dir) -> DataFrame:
    return risk.dedupe(risk.d1_paste_after_blur(event_tables(spark, sf_dir)), CONFIG.bucket).drop("bucket")


ALL_SQL = " UNION ALL ".join(SQL[n] for n in risk.DETECTORS)
ALL_BEST = f"{GREEDY_D4}, best AS ({BEST.format(src=ALL_SQL, bucket=24 * HOUR)})"


@query(f"+ {TABLES}, {ALL_BEST} SELECT sk, CAST(least(100000, sum(score_milli)) AS BIGINT) AS total_milli, count(*) AS n_contributions, count(DISTINCT factor_id) AS n_factors FROM best GROUP BY sk")
def d30_all_detectors(spark, sf_dir) -> DataFrame:
    """All 28 detectors, deduped and totalled: one exchange of the events by session, and one of the contributions."""
    return risk.totals(risk.dedupe(sweep.detect(event_rows(spark, sf_dir), CONFIG), CONFIG.bucket))


@query(f"+ {TABLES}, {ALL_BEST} SELECT sk, CAST(least(100000, sum(score_milli)) AS BIGINT) AS total_milli, CAST(sum(score_milli) AS BIGINT) AS raw_milli, count(*) AS n_contributions, count(DISTINCT factor_id) AS n_factors FROM best GROUP BY sk")
def d30_every_detector(spark, sf_dir) -> DataFrame:
    """The same with the uncapped total, which tells sessions apart that the cap makes equal."""
    best = risk.dedupe(sweep.detect(event_rows(spark, sf_dir), CONFIG), CONFIG.bucket)
    return risk.totals(best, raw=True)


@query(f"+ {TABLES}, best AS ({D1_BEST}) SELECT factor_id, CASE WHEN score_milli / 12000.0::DOUBLE >= 0.75 THEN 'red' WHEN score_milli / 12000.0::DOUBLE >= 0.5 THEN 'amber' ELSE 'green' END AS lane, count(*) AS n FROM best GROUP BY 1, 2")
def a13_lanes(spark, sf_dir) -> DataFrame:
    best = risk.dedupe(risk.d1_paste_after_blur(event_tables(spark, sf_dir)), CONFIG.bucket)
    return best.withColumn("lane", risk.lane(F.col("score_milli"), F.lit(12))).groupBy("factor_id", "lane").agg(F.count("*").alias("n"))


CHAIN = f"""chain AS ({first(f'({SQL["d10_gaze_with_device"]})', 't0_ms // ' + str(24 * HOUR), 'score_milli DESC, t0_ms, t1_ms')}),
    hit AS (SELECT c.sk, c.t0_ms, c.t1_ms, x.kind, x.ord, x.t_ms FROM chain c JOIN pt x ON c.sk = x.sk AND x.t_ms BETWEEN c.t0_ms - 2000 AND c.t1_ms + 2000)"""


@query(f"+ {TABLES}, {CHAIN} SELECT sk, t0_ms, t1_ms, count(*) AS n_events, count(DISTINCT kind) AS n_modalities, arg_min(ord, (t_ms, ord)) FILTER (kind = 'signup') AS first_speech FROM hit GROUP BY sk, t0_ms, t1_ms")
def d29_candidate_chains(spark, sf_dir) -> DataFrame:
    from evidencelake.operators.joins import contains

    e = event_tables(spark, sf_dir)
    best = risk.dedupe(risk.d10_gaze_with_device(e), CONFIG.bucket).select("sk", "t0_ms", "t1_ms")
    spans = best.withColumn("start_ms", F.col("t0_ms") - 2000).withColumn("end_ms", F.col("t1_ms") + 2000)
    hit = contains(events(spark, sf_dir).filter("t_ms is not null"), spans, ["sk"], width=12 * HOUR)
    speech = F.min_by("ord", F.when(F.col("kind") == "signup", F.struct("t_ms", "ord")))
    return hit.groupBy("sk", F.col("b_t0_ms").alias("t0_ms"), F.col("b_t1_ms").alias("t1_ms")).agg(
        F.count("*").alias("n_events"), F.count_distinct("kind").alias("n_modalities"), speech.alias("first_speech")
    )
