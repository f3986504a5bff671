"""Location by segment tree beside a plain search, and the detector sweep beside the single detectors."""

import collections
import random
import re
import time

from pyspark.sql import functions as F

from evidencelake.operators.joins import locate
from evidencelake.plans import chain_queries, review, risk, sweep
from evidencelake.plans.risk_queries import CONFIG, event_rows, event_tables

SF = "/root/testdata/sf0.001"


def plain(points, sections):
    out = {}
    for sk, p, t in points:
        own = [s for s in sections if s[0] == sk]
        held = [s for s in own if s[2] <= t <= s[3]]
        if held:
            out[sk, p] = min((s[1], s[4]) for s in held)[1], True
        elif own:
            out[sk, p] = min((min(abs(t - s[2]), abs(t - s[3])), s[1], s[4]) for s in own)[2], False
    return out


def test_locate_among_overlapping_sections(spark):
    rng = random.Random(4)
    sections, points = [], []
    for sk in range(12):
        n = rng.choice([0, 1, 2, 7, 40])
        for k in range(n):
            start = rng.randrange(300)
            sections.append((sk, k, start, start + rng.choice([0, 1, 5, 60, 400]), f"s{sk}-{k}"))
        points += [(sk, p, rng.randrange(-20, 500)) for p in range(60)]
    a = spark.createDataFrame(points, "sk int, p int, t_ms bigint")
    b = spark.createDataFrame(sections, "sk int, ord int, start_ms bigint, end_ms bigint, section_id string")
    got = {(r["sk"], r["p"]): (r["section_id"], r["contained"]) for r in locate(a, b, ["sk"], ["p"]).collect()}
    assert got == plain(points, sections)


def test_locate_is_no_product_in_one_session(spark):
    n = 50_000
    b = spark.range(n).selectExpr("1 as sk", "id + 1 as ord", "id * 1000 as start_ms", "id * 1000 + 900 as end_ms", "string(id) as section_id")
    b = b.unionByName(spark.range(1).selectExpr("1 as sk", f"bigint({n + 1}) as ord", "bigint(0) as start_ms", f"bigint({n} * 1000) as end_ms", "'all' as section_id"))
    a = spark.range(2 * n).selectExpr("1 as sk", "id as p", "id * 500 + 450 as t_ms")
    start = time.time()
    got = locate(a, b, ["sk"], ["p"]).groupBy(F.col("section_id") == "all", "contained").count().collect()
    assert {tuple(r) for r in got} == {(False, True, n), (True, True, n)}
    assert time.time() - start < 120


def test_sweep_is_all_detectors(spark):
    e = event_tables(spark, SF)
    want = collections.Counter(map(tuple, risk.detect_all(e).collect()))
    assert collections.Counter(map(tuple, sweep.detect(event_rows(spark, SF), CONFIG).collect())) == want
    assert len({k[1] for k in want}) > 20


def test_sweep_of_separate_tables_and_of_none(spark):
    e = event_tables(spark, SF)
    rows = risk.by_session(sweep.tagged(e))
    names = ["sk", "factor_id", "q"]
    got, want = (x.groupBy(*names).agg(F.count("*"), F.sum("score_milli"), F.sum("t0_ms"), F.sum("t1_ms")).collect() for x in (sweep.detect(rows, CONFIG), sweep.detect(event_rows(spark, SF), CONFIG)))
    assert set(map(tuple, got)) == set(map(tuple, want))
    assert sweep.detect(rows.filter("false"), CONFIG).count() == 0


def test_behaviour_is_a_small_plan(spark):
    facts, questions, found, screens = chain_queries.behaviour_inputs(spark, SF)
    flagged = found.filter("outcome = 'flagged'").withColumn("evidence_ref", F.col("id"))
    _, best = review.behaviour(facts, questions, flagged, screens, CONFIG)
    start = time.time()
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert time.time() - start < 20
    assert len(re.findall(r"SortMergeJoin|HashJoin|NestedLoop", plan)) < 10
