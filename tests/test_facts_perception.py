"""Facts of edits and options, and the projection of camera events."""

from pyspark.sql import functions as F

from evidencelake.plans import answers, facts, perception

INPUT = "sk string, element string, section_type string, ord int, t_ms bigint, text string, is_checked boolean"


def test_edit_facts(spark):
    rows = [("s", "e", "coding", i, t, x, None) for i, (t, x) in enumerate([(0, ""), (10, "a" * 10), (5000, "a" * 70), (9000, "a" * 40), (9100, "a" * 40 + ";"), (20_000, "bb")])]
    out = facts.edit_facts(facts.edits(spark.createDataFrame(rows, INPUT))).orderBy("ord").collect()
    assert [r["kind"] for r in out] == ["TYPING_STARTED", "LARGE_PASTE", "TEXT_CORRECTION", "AUTOFORMAT", "TEXT_CORRECTION"]
    assert out[1]["excerpt"] == "a" * 60 and out[1]["locality"] == "append_at_end"
    stop = facts.typing_stopped(facts.edit_facts(facts.edits(spark.createDataFrame(rows, INPUT)))).first()
    assert (stop["peak"], stop["final"], stop["insertions"], stop["deletions"], stop["inserted"]) == (70, 2, 1, 2, 0)


def test_option_groups(spark):
    rows = [("s", "m", "A", 0, 0, "oa", True), ("s", "m", "B", 1, 1000, "ob", True), ("s", "m", "A", 2, 1005, "oa", False), ("s", "m", "C", 3, 50_000, "oc", True)]
    df = spark.createDataFrame(rows, "sk string, section_id string, element string, ord int, t_ms bigint, text string, is_checked boolean")
    got = {r["answer_group"]: (r["n_selected"], r["n_changes"]) for r in answers.option_groups(df).collect()}
    assert sum(n for n, _ in got.values()) == 3 and sum(c for _, c in got.values()) == 1


def test_projection(spark):
    rows = [("s", "c", 0, 10, "phone_in_hand", {}, 0.5, "HIGH"), ("s", "c", 20, 30, "other", {"objectInHand": "phone", "gazeDirection": "UNKNOWN"}, 0.5, "HIGH"), ("s", "c", 40, 50, "notes_visible", {"paperVisible": "no"}, 0.5, "HIGH")]
    df = spark.createDataFrame(rows, "sk string, chunk_id string, start_ms bigint, end_ms bigint, kind string, attrs map<string,string>, confidence double, tier string")
    got = perception.observations(df).orderBy("start_ms").collect()
    assert (got[0]["objects"]["phone_visible"], got[0]["hands"]["object_in_hand"], got[0]["hands"]["hand_location"], got[0]["window_id"]) == ("yes", "phone", "phone", "w_0_10")
    assert (got[1]["objects"]["phone_visible"], got[1]["hands"]["hands_visible"], got[1]["attention"]["gaze_direction"]) == ("yes", "yes", "UNKNOWN")
    assert (got[2]["objects"]["notebook_visible"], got[2]["objects"]["paper_visible"]) == ("UNKNOWN", "no")
    spans = spark.createDataFrame([("s", "c", 100, 200)], "sk string, chunk_id string, start_ms bigint, end_ms bigint")
    assert [r["start_ms"] for r in perception.session_times(perception.observations(df), spans).orderBy("start_ms").collect()] == [20, 40, 100]
    quiet = perception.quiet_chunks(spans).first()
    assert quiet["audio"]["speech_present"] == "UNKNOWN" and quiet["confidence"] == 0.7
    assert quiet.asDict(True)["objects"].keys() == got[0].asDict(True)["objects"].keys()


def test_reportable(spark):
    rows = [("LARGE_PASTE", "external", False, 60), ("LARGE_PASTE", "external", False, 40), ("LARGE_PASTE", None, None, 0), ("PASTE", "internal", False, 60), ("LARGE_PASTE", "external", True, 60)]
    df = spark.createDataFrame(rows, "kind string, origin string, reverted boolean, chars int")
    assert [r["v"] for r in df.select(facts.reportable(F.col("kind"), F.col("origin"), F.col("reverted"), F.col("chars")).alias("v")).collect()] == [True, False, True, False, False]


def test_option_links_follow_earlier_choices(spark):
    rows = [
        ("s", "q", "A", 0, 0, "a", False), ("s", "q", "B", 1, 50, "b", True),  # B joins the dropped A
        ("s", "q", "B", 2, 1000, "b", False), ("s", "q", "A", 3, 1100, "a", True),  # A, still without a group, joins B's: exactly at the limit
        ("s", "r", "C", 4, 1150, "c", True),  # another section
        ("s", None, "D", 5, 9000, "d", True), ("s", None, "E", 6, 9010, "e", False), ("s", None, "F", 7, 9011, "f", None),
        ("t", "q", "A", 0, 0, "a", True),
    ]
    df = spark.createDataFrame(rows, "sk string, section_id string, element string, ord int, t_ms bigint, text string, is_checked boolean")
    groups = answers.option_groups(df)
    got = {(r["sk"], r["answer_group"]): (r["n_selected"], r["n_changes"], r["first_ms"], r["last_ms"]) for r in groups.collect()}
    assert got == {("s", "A"): (2, 1, 50, 1100), ("s", "C"): (1, 0, 1150, 1150), ("s", "D"): (1, 1, 9000, 9000), ("t", "A"): (1, 0, 0, 0)}
    assert sorted((r["answer_group"], r["t_ms"]) for r in answers.changes(groups).collect()) == [("A", 1100), ("D", 9000)]
    assert answers.option_groups(df.filter("false")).count() == 0
    assert "Python" not in groups._jdf.queryExecution().executedPlan().toString()


def test_result_panels(spark):
    rows = [
        ("s", "a", "coding", 0, 0, ["2/3 test cases passed", "9/9"]), ("s", "a", "Coding SQL", 1, 10, ["Test cases run"]), ("s", "a", "coding", 2, 3010, ["4/5"]), ("s", "a", "coding", 3, 3011, ["5/5"]),
        ("s", "b", "coding", 4, 0, ["test case failed"]), ("s", "b", "coding", 5, 3001, ["1/2"]),  # too late: stays unknown
        ("s", None, "coding", 6, 0, ["test cases run"]), ("s", None, "coding", 7, 1, ["test cases failed "]), ("s", None, "coding", 8, 2, [" 0 / 7 ", ""]),
        ("s", "c", "mcq", 9, 0, ["1/1 test cases passed"]), ("s", "d", "coding", 10, 0, []), ("s", "d", "coding", 11, 0, ["3/4 left"]), ("s", "d", None, 12, 0, ["1/1 test case passed"]),
    ]
    df = spark.createDataFrame(rows, "sk string, section_id string, section_type string, ord int, t_ms bigint, texts array<string>")
    got = {r["ord"]: (r["start_ms"], r["end_ms"], r["passed"], r["total"], r["raw_text"]) for r in answers.test_results(df).collect()}
    assert got == {
        0: (0, 0, 2, 3, "2/3 test cases passed"), 1: (10, 3010, 4, 5, "Test cases run [count:4/5]"), 4: (0, 0, None, None, "test case failed"),
        7: (1, 2, 0, 7, "test cases failed [count:0 / 7]"),
    }
    assert answers.test_results(df.filter("false")).count() == 0
