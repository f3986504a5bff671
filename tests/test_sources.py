"""Request files, page-event chunks and stored answers, on invented rows."""

import gzip
import json
import zlib

import pytest
from pyspark.sql import functions as F

from evidencelake.functions import text as tx
from evidencelake.functions import urls
from evidencelake.sources import requests, responses, rrweb

T = 1_700_000_000_000


@pytest.fixture
def request_dir(tmp_path):
    base = {
        "candidateId": "c1", "assessmentId": "a1",
        "cameraRecordings": [f"https://h/cam/att1/{T}__60000.webm", f"https://h/cam/att2/{T + 60_000}__60000.webm"],
        "sessionRecordings": [f"https://h/v2/{T}__60000.json"],
        "activityTimeline": [{"eventType": "ASSESSMENT_STARTED", "timestamp": str(T), "order": "1"}, {"activityTypeEnum": "SECTION_STARTED", "creationDatetime": "2026-05-05 22:44:19", "order": "2"}],
        "sections": [{"examAttemptId": "att1", "examId": "e1", "sectionType": "MCQ", "title": "x"}, {"examAttemptId": "att2", "examId": "e2", "sectionType": "", "title": "My Coding"}],
    }
    bad = base | {"candidateId": "c2", "cameraRecordings": ["http://h/a.webm"]}
    mixed = base | {"candidateId": "c3", "sessionRecordings": [f"https://h/v2/{T}__1.json", f"https://h/v3/{T}__1.webm"]}
    for i, x in enumerate((base, bad, mixed)):
        (tmp_path / f"{i}.json").write_text(json.dumps(x))
    (tmp_path / "9.json").write_text("{not json")
    return str(tmp_path)


def test_requests(spark, request_dir):
    good, bad = requests.split(requests.scan(spark, request_dir))
    assert sorted(r["sk"] for r in good.select("sk").collect()) == ["a1/c1", "a1/c3"] and bad.count() == 2
    assert [r["section_id"] for r in requests.sections(good).filter("sk = 'a1/c1'").orderBy("ord").collect()] == ["mcq", "my-coding"]
    log = requests.activity(good).filter("sk = 'a1/c1'").orderBy("ord").collect()
    assert [(r["kind"], r["t_ms"]) for r in log] == [("ASSESSMENT_STARTED", T), ("SECTION_STARTED", 1778001259000)]
    chunks, rejected = requests.manifest(good)
    assert [(r["sk"], r["reason"]) for r in rejected.collect()] == [("a1/c3", "mixed_modes")]
    rows = {(r["prefix"], r["sequence"]): r for r in chunks.collect()}
    assert rows["video", 0]["section_id"] == "mcq" and rows["video", 1]["section_id"] == "my-coding"
    assert rows["video", 1]["chunk_id"] == f"video-{T + 60_000}__60000" and rows["keystrokeData", 0]["kind"] == "rrweb_chunk"


def test_page_events(spark, tmp_path):
    custom = {"type": 5, "timestamp": T, "data": {"tag": "x", "payload": {"data": {"data": "CAMERA_DISABLED", "message": "m"}}}}
    click = {"type": 3, "timestamp": T + 1, "data": {"source": 2, "type": 3}}
    node = {"type": 2, "childNodes": [{"type": 3, "textContent": " 3 / 5 test cases passed "}, {"type": 2, "childNodes": [{"type": 3, "textContent": "b"}]}]}
    added = {"type": 3, "timestamp": T + 2, "data": {"source": 0, "adds": [{"node": node}]}}
    packed = zlib.compress(json.dumps(click).encode()).decode("latin-1")
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(json.dumps({"events": [custom, packed, "x\x9cbroken", added]}).encode()))
    (tmp_path / "b.json").write_bytes(b'{"no": 1}')
    events = rrweb.scan(spark, str(tmp_path)).cache()
    assert events.filter("pos = -1").count() == 1 and events.filter("pos >= 0").count() == 3
    assert [(r["kind"], r["message"]) for r in rrweb.custom_facts(events).collect()] == [("CAMERA_BLOCKED", "m")]
    assert rrweb.right_clicks(events).count() == 1
    texts = events.filter("size(added) > 0").first()["added"]
    assert texts == ["3 / 5 test cases passed", "b"]
    assert events.filter("size(added) > 0").select(tx.test_passed(F.col("added")[0]).alias("n")).first()["n"] == 3


def test_camera_answers(spark):
    answer = "```json\n" + json.dumps({"chunkDurationMs": 1000, "captureQualityTier": "ODD", "events": [
        {"kind": "phone", "startMsLocal": -5, "endMsLocal": 2000, "confidence": 3}, {"kind": "zzz", "startMsLocal": 10, "endMsLocal": 20},
        {"kind": "speech", "startMsLocal": 0, "endMsLocal": 500, "attrs": {"language": "en"}}, {"kind": "phone", "startMsLocal": 9, "endMsLocal": 9}]}) + "\n```"
    stored = spark.createDataFrame([("s", "c", 100, 1000, answer), ("s", "d", 0, 1000, "no json")], "sk string, chunk_id string, start_ms bigint, duration_ms bigint, response string")
    rows = responses.speech_complete(responses.camera_events(stored, ["phone", "speech"])).orderBy("event_id").collect()
    assert [(r["kind"], r["start_ms"], r["end_ms"], r["confidence"], r["tier"]) for r in rows] == [
        ("phone", 100, 1100, 1.0, "MEDIUM"), ("other", 110, 120, 0.5, "MEDIUM"), ("speech", 100, 600, 0.5, "MEDIUM")
    ]
    assert rows[2]["attrs"]["speechPresent"] == "yes" and rows[2]["attrs"]["speechContentClass"] == "unclear" and rows[2]["attrs"]["language"] == "en"


def test_screen_answers(spark):
    good = json.dumps({"externalResourceLabels": ["x" * 100] * 12, "confidence": 0.9, "externalResourceVisible": "YES", "aiAssistantUiVisible": "maybe"})
    stored = spark.createDataFrame([("s", "a", 0, 10, good), ("s", "b", 0, 10, "oops")], "sk string, chunk_id string, start_ms bigint, duration_ms bigint, response string")
    rows = {r["chunk_id"]: r for r in responses.screen_observations(stored).collect()}
    assert len(rows["a"]["labels"]) == 10 and len(rows["a"]["labels"][0]) == 80 and rows["a"]["external_resource"] == "yes" and rows["a"]["ai_assistant"] == "UNKNOWN"
    assert not rows["b"]["video_available"] and rows["b"]["confidence"] == 0.0 and rows["b"]["labels"] == []


def test_adjudications(spark):
    body = json.dumps({"candidateSignals": [{"signalType": "x", "confidence": "0.7"}, {"signal_type": "y", "confidence": "high", "machineFactsCited": ["A"]}]})
    stored = spark.createDataFrame([("1", body), ("2", f"Sure: {body} done"), ("3", body[:-1]), ("4", "nothing")], "sk string, response string")
    got = sorted((r["sk"], r["ord"], r["signal_type"], r["confidence"]) for r in responses.adjudications(stored).collect())
    assert got == [(k, i, t, c) for k in "123" for i, (t, c) in enumerate([("x", 0.7), ("y", 0.5)])]


def test_scalar_cases(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first()["v"]
    lit = F.lit
    assert value(tx.is_autoformat(lit("a=1"), lit("a = 1;"))) and value(tx.question_number(lit("Question #12"))) == 12
    assert value(tx.question_number(lit("q 900"))) is None and value(tx.diff_excerpt(lit("abXcd"), lit("abYYcd"))) == "YY"
    assert value(tx.citation(lit("w1.audio.speech:yes")))["value"] == "yes" and value(tx.window_ids(lit("perception:w=a+ b +c"))) == ["a", "b", "c"]
    assert value(tx.seconds(lit(2500))) == 2 and value(tx.seconds(lit(3500))) == 4
    assert value(urls.path(lit("https://h/a%20b+c?x=1"))) == "/a b+c" and value(urls.chunk_section(lit("video-mcq-1700000000000"))) == "mcq"
    assert value(tx.input_role(lit("12 34"), lit(None).cast("boolean"), lit("coding"))) == "test_fixture"
    assert value(tx.grounded(F.array(lit("said the answer"), lit("x")), F.array(lit("He said the answer is 4")))) == ["said the answer"]
