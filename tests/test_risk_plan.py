"""The detectors' plan: events are read and exchanged once; sessions' rows meet without another exchange."""

import re

from evidencelake.plans import risk
from evidencelake.plans.risk_queries import CONFIG, event_tables


def test_detectors_share_one_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = risk.dedupe(risk.detect_all(event_tables(spark, "/root/testdata/sf0.001")), CONFIG.bucket)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    exchanges = set(re.findall(r"Exchange hashpartitioning\([^\n]*plan_id=\d+", plan))
    assert plan.count("ReusedExchange") > 70
    assert len({x for x in exchanges if "hashpartitioning(sk" in x and "factor_id" not in x}) <= 2
    assert len(exchanges) <= 3 and "BroadcastExchange" not in plan
