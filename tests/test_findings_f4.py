import re

from evidencelake.plans import catalog


def test_the_review_works_its_events_out_once(spark):
    df = catalog.QUERIES["t12_review"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    count = lambda name: len(re.findall(rf"(?<!\w){name}\b", plan))
    assert count("Relation") <= 25 and count("Window") <= 15  # 90 and 41 when each detector repeated the timeline
