"""Report assembly over binding E."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidencelake.plans import report, risk
from evidencelake.plans.registry import HOUR, events, of_kind, query, spans
from evidencelake.plans.risk_queries import CONFIG, D1_BEST, TABLES, event_tables


@query("""+ p AS (SELECT s.sk, s.ord, f.kind, f.t_ms, row_number() OVER (PARTITION BY s.sk, s.ord ORDER BY f.t_ms, f.ord) AS n FROM iv s JOIN ev f ON s.sk = f.sk AND s.kind = 'signup' AND f.kind IN ('error', 'purchase')
    AND s.start_ms - 15000 <= f.t_ms AND f.t_ms <= s.end_ms + 15000) SELECT DISTINCT sk, ord, kind, t_ms FROM p WHERE n <= 8""")
def r21_story_facts(spark, sf_dir):
    rows = spans(spark, sf_dir).select("sk", "ord", "kind", "start_ms", "end_ms")
    facts = of_kind(rows, "error", "purchase").withColumn("end_ms", F.col("start_ms"))
    return report.story_facts(of_kind(rows, "signup"), facts, width=24 * HOUR)


@query("""+ e AS (SELECT sk, ord, kind AS event_type, value, round_even(start_ms / 86400000.0::DOUBLE, 0) AS a, round_even(end_ms / 86400000.0::DOUBLE, 0) AS b FROM iv)
    SELECT sk, ord, event_type FROM e QUALIFY row_number() OVER (PARTITION BY sk, event_type, a, b ORDER BY value DESC, ord) = 1""")
def r22_timeline_entries(spark, sf_dir):
    rows = spans(spark, sf_dir).select("sk", "ord", F.col("kind").alias("event_type"), F.col("value").alias("confidence"), "start_ms", "end_ms")
    return report.timeline_entries(rows, 24 * HOUR).select("sk", "ord", "event_type")


@query(f"""+ {TABLES}, best AS ({D1_BEST}), c AS (SELECT sk, count(*) AS n_contributions FROM best GROUP BY sk), e AS (SELECT sk, count(*) AS n_errors, min(ord) AS first_error FROM ev WHERE kind = 'error' GROUP BY sk)
    SELECT s.sk, coalesce(n_contributions, 0) AS n_contributions, coalesce(n_errors, 0) AS n_errors, first_error FROM (SELECT DISTINCT sk FROM ev) s LEFT JOIN c ON s.sk = c.sk LEFT JOIN e ON s.sk = e.sk""")
def a19_bundle(spark, sf_dir):
    """The nested document of every session, checked by the sizes and heads of its sections."""
    best = risk.dedupe(risk.d1_paste_after_blur(event_tables(spark, sf_dir)), CONFIG.bucket).drop("bucket")
    errors = of_kind(events(spark, sf_dir), "error").select("sk", "ord", "t_ms")
    sessions = events(spark, sf_dir).select("sk").distinct()
    bundle = report.assemble(sessions, {"contributions": (best, ["t0_ms"]), "errors": (errors, ["ord"])})
    return bundle.select("sk", F.size("contributions").cast("bigint").alias("n_contributions"), F.size("errors").cast("bigint").alias("n_errors"), F.get("errors", F.lit(0))["ord"].alias("first_error"))
