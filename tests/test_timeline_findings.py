"""Timelines and classifiers on small hand-made sessions."""

from evidencelake.plans import decide, findings, timeline

T = 1_700_000_000_000


def log_rows(spark):
    rows = [
        ("s", 1, "ASSESSMENT_STARTED", T, {}), ("s", 2, "SECTION_STARTED", T + 10_000, {"sectionId": "a"}), ("s", 3, "SECTION_COMPLETED", T + 50_000, {"sectionId": "a"}),
        ("s", 4, "SECTION_STARTED", T + 60_000, {"sectionId": "b"}), ("s", 5, "ALL_SECTIONS_COMPLETED", T + 90_000, {}), ("r", 1, "OTHER", T + 5, {}),
    ]
    return spark.createDataFrame(rows, "sk string, ord int, kind string, t_ms bigint, metadata map<string,string>")


def test_master_timeline(spark):
    log = log_rows(spark)
    labels = spark.createDataFrame([("s", 0, "mcq"), ("s", 1, "coding")], "sk string, ord int, section_id string")
    names = [f"video-{T + 60_000}__60000", "video-unknown", f"video-{T + 185_000}__60000"]
    chunks = spark.createDataFrame([("s", "video", i, n, None, 60_000, None) for i, n in enumerate(names)], "sk string, prefix string, sequence int, chunk_id string, section_id string, duration_ms bigint, sidecar_role string")
    out = timeline.master(log, chunks, labels)
    head = {r["sk"]: r for r in out["header"].collect()}
    assert head["s"]["t0_ms"] == T and head["s"]["duration_ms"] == 185_000 and head["r"]["t0_ms"] == T + 5
    assert [(r["section_id"], r["start_ms"], r["end_ms"]) for r in out["sections"].orderBy("ord").collect()] == [("mcq", 10_000, 50_000), ("coding", 60_000, 60_000)]
    spans = {r["sequence"]: (r["start_ms"], r["end_ms"], r["quality"]) for r in out["artifacts"].collect()}
    assert spans == {0: (0, 60_000, "ok"), 1: (60_000, 120_000, "estimated"), 2: (125_000, 185_000, "ok")}
    assert [(r["start_ms"], r["end_ms"], r["n_rows"]) for r in out["segments"].collect()] == [(0, 185_000, 3)]
    events = {r["ord"]: r for r in out["events"].filter("sk = 's'").collect()}
    assert events[3]["chunk_id"] == names[0] and events[3]["local_ms"] == 50_000 and events[5]["chunk_id"] == "video-unknown"
    windows = timeline.perception_windows(out["artifacts"], out["sections"], spark.createDataFrame([("s", names[2], True)], "sk string, chunk_id string, covered boolean"))
    assert {r["sequence"]: (r["phase"], r["covered"]) for r in windows.collect()} == {0: ("setup_verification", False), 1: ("live_exam", False), 2: ("live_exam", True)}
    assert timeline.pending(out["artifacts"], spark.createDataFrame([("s", names[0])], "sk string, chunk_id string")).count() == 2


def test_reversed_edit_spans(spark):
    df = spark.createDataFrame([("s", 0, 10, 20), ("s", 1, None, None), ("s", 2, 50, 40)], "sk string, sequence int, start_ms bigint, end_ms bigint")
    assert [(r["start_ms"], r["end_ms"]) for r in timeline.edit_spans(df).orderBy("sequence").collect()] == [(10, 20), (20, 20), (40, 50)]


def observations(spark, rows):
    """rows: (start s, end s, flags)."""
    flags = ["face_absent", "capture_issue", "left_seat", "left_fully", "person_visible", "interacting", "passing", "adjacent", "staff", "admin_speech", "integrity_speech", "gaze_away", "reflection", "recurrent", "second_monitor", "speech"]
    data = [("s", i, a * 1000, b * 1000, x.get("gaze"), x.get("summary", ""), *[x.get(f, False) for f in flags]) for i, (a, b, x) in enumerate(rows)]
    return spark.createDataFrame(data, "sk string, ord int, start_ms bigint, end_ms bigint, gaze string, summary string, " + ", ".join(f"{f} boolean" for f in flags))


def outcomes(df):
    return {(r["event_type"], r["outcome"], r["reason"], r["severity"]) for r in df.collect()}


def test_face_and_person(spark):
    absent = {"face_absent": True}
    obs = observations(spark, [(0, 2, absent), (100, 140, absent), (300, 310, absent | {"left_seat": True}), (500, 520, absent | {"capture_issue": True})])
    assert outcomes(findings.face(obs)) == {
        ("no_candidate", "cleared", "brief_look_away", None), ("no_candidate", "flagged", None, "medium"), ("left_seat_body_present", "flagged", None, "medium"),
        ("no_candidate", "cleared", "capture_quality_issue", None),
    }
    seen = {"person_visible": True}
    obs = observations(spark, [(0, 10, seen | {"interacting": True, "gaze_away": True}), (100, 110, seen | {"staff": True}), (200, 240, seen | {"adjacent": True}), (400, 410, seen)])
    got = {(r["event_type"], r["outcome"], r["reason"]) for r in findings.second_person(obs).collect()}
    assert got == {("external_help", "flagged", None), ("multiple_faces", "cleared", "official"), ("multiple_faces", "flagged", None)}


def test_gaze_and_speech(spark):
    few = observations(spark, [(0, 20, {"gaze": "left"}), (100, 110, {"gaze": "up"})])
    assert [(r["outcome"], r["dur_sec"]) for r in findings.gaze(few).collect()] == [("cleared", 30)]
    many = observations(spark, [(i * 40, i * 40 + 10, {"gaze": "left"}) for i in range(5)])
    assert [(r["outcome"], r["severity"], r["t0_ms"], r["t1_ms"]) for r in findings.gaze(many).collect()] == [("flagged", "medium", 0, 170_000)]
    talk = observations(spark, [(0, 5, {"speech": True, "summary": "hi", "integrity_speech": True}), (100, 105, {"speech": True}), (200, 201, {"speech": True, "summary": "x"})])
    assert {(r["outcome"], r["reason"]) for r in findings.speech(talk).collect()} == {("flagged", None), ("unknown", "no_summary")}


def test_staff_speech_clears(spark):
    found = spark.createDataFrame([("s", "multiple_faces", "flagged", None, "medium", 0, 10, 1), ("s", "multiple_faces", "flagged", None, "medium", 50, 60, 1)], "sk string, event_type string, outcome string, reason string, severity string, t0_ms bigint, t1_ms bigint, dur_sec bigint")
    staff = spark.createDataFrame([("s", 5, 6), ("s", 55, 56)], "sk string, start_ms bigint, end_ms bigint")
    integrity = spark.createDataFrame([("s", 58, 59)], "sk string, start_ms bigint, end_ms bigint")
    assert sorted((r["t0_ms"], r["outcome"]) for r in findings.clear_by_staff(found, staff, integrity).collect()) == [(0, "cleared"), (50, "flagged")]


def test_unified_score(spark):
    signals = spark.createDataFrame([("a", "x1", 1, "possible_audio_coaching", "assisted", 80, ["audio_observation"], 1000)], "sk string, signal_id string, ord int, signal_type string, resolution string, confidence int, sources array<string>, mid_ms bigint")
    found = spark.createDataFrame([("a", "f1", "speech", "machine_fact", "high", "strong", 8500, 5000, 2000), ("b", "f2", "suspicious_eye_movement", "visual_observation", "low", None, 8500, 3000, 0)], "sk string, finding_id string, event_type string, source string, severity string, strength string, weight_10k int, duration_ms bigint, mid_ms bigint")
    sessions = spark.createDataFrame([("a", 0.9, 0.9), ("b", 0.8, 0.9), ("c", 0.2, 0.9)], "sk string, usable double, informative double")
    allowed = spark.createDataFrame([("possible_audio_coaching", "speech")], "signal_type string, event_type string")
    got = {r["sk"]: (r["category"], r["confidence"]) for r in decide.unified(signals, found, sessions, allowed).collect()}
    assert got == {"a": ("STRONG_EVIDENCE", 98), "b": ("CLEAR", 90), "c": ("CLEAR", 50)}


def test_every_detector_counts(spark):
    """The totals of all 28 detectors, the greedy pairing by plain loops."""
    from evidencelake.plans import risk
    from evidencelake.plans.catalog import QUERIES
    from evidencelake.plans.risk_queries import CONFIG, event_tables

    sf = "/root/testdata/sf0.001"
    e = event_tables(spark, sf)
    inputs = [(r["sk"], r["ord"], r["start_ms"], r["q"]) for df in (e.answer, e.paste) for r in df.select("sk", "ord", "start_ms", "q").collect()]
    used, rows = set(), []
    for g in sorted(e.gaze.collect(), key=lambda g: (g["start_ms"], g["ord"], g["end_ms"])):
        near = [x for x in inputs if x[0] == g["sk"] and x not in used and 0 <= x[2] - g["end_ms"] <= e.config.gaze_to_input]
        if near:
            best = min(near, key=lambda x: (x[2] - g["end_ms"], x[2], x[1]))
            used.add(best)
            rows.append((g["sk"], g["start_ms"], best[2], best[3]))
    greedy = risk.d4_gaze_off_then_input(e).collect()
    assert sorted(map(repr, rows)) == sorted(repr((r["sk"], r["t0_ms"], r["t1_ms"], r["q"])) for r in greedy) and rows
    contributions = [tuple(r[c] for c in ("sk", "factor_id", "q", "t0_ms", "score_milli")) for f in risk.DETECTORS.values() for r in f(e).collect()]
    best = {}
    for sk, factor, q, t0, score in contributions:
        key = (sk, factor, q, t0 // CONFIG.bucket)
        best[key] = max(best.get(key, 0), score)
    want = {}
    for (sk, factor, _, _), score in best.items():
        total, n, factors = want.get(sk, (0, 0, frozenset()))
        want[sk] = (total + score, n + 1, factors | {factor})
    got = {r["sk"]: (r["total_milli"], r["n_contributions"], r["n_factors"]) for r in QUERIES["d30_every_detector"](spark, sf).collect()}
    assert got == {sk: (min(100_000, total), n, len(factors)) for sk, (total, n, factors) in want.items()}
