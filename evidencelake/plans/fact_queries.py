"""Origins of pastes over binding E.

Clicks and views are pastes, errors corrections, sign-ups submissions, purchases copies.  Their texts are cut from one
passage at places that follow from number and id, some in capitals, some with other white space.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from evidencelake.plans import facts
from evidencelake.plans.registry import HOUR, events, query
from evidencelake.plans.scalar_queries import normal_sql

PASSAGE = "".join(f"value{i} = höhe({i * i}); " for i in range(60))
COPIED = 6 * HOUR
EXCERPT = f"""CASE WHEN ord % 7 = 0 THEN upper(x) WHEN ord % 5 = 0 THEN replace(x, ' ', chr(10) || chr(9)) || chr(13) || chr(10) WHEN ord % 11 = 0 THEN replace(x, ' ', chr(160)) ELSE x END"""
CUT = f"substr('{PASSAGE}', CAST(1 + (k * 41 + ord * 7) % 1100 AS INT), CAST(14 + ord % 67 AS INT))"
SOURCE = f"substr('{PASSAGE}', CAST(1 + (k * 13) % 900 AS INT), 120)"
STARTER = f"substr('{PASSAGE}', CAST(1 + (k % 3) * 90 AS INT), 70)"


def occurs(text: str) -> str:
    return f"(length(e) >= 20 AND length({text}) >= 20 AND (contains({text}, e) OR (length(e) >= 40 AND contains({text}, substr(e, 6, length(e) - 10)))))"


@query(f"""+ ft AS (SELECT sk, ord, t_ms, kind, sec, {EXCERPT} AS x FROM (SELECT *, CASE WHEN ord % 4 > 0 THEN ord % 3 END AS sec, {CUT} AS x FROM ev WHERE k IS NOT NULL AND t_ms IS NOT NULL AND kind IN ('click', 'view', 'error'))),
    su AS (SELECT sk, ord, t_ms, {SOURCE} AS source, {STARTER} AS starter FROM ev WHERE k IS NOT NULL AND t_ms IS NOT NULL AND kind = 'signup'),
    parts AS (SELECT sk, 0 AS p, t_ms, ord, source AS t FROM su UNION ALL SELECT sk, 1, t_ms, ord, x FROM ft WHERE length(x) >= 20),
    co AS (SELECT sk, {normal_sql("string_agg(t, chr(10) ORDER BY p, t_ms, ord)")} AS c FROM parts GROUP BY sk),
    so AS (SELECT sk, list({normal_sql('starter')}) AS st, list({normal_sql('source')}) AS su FROM su GROUP BY sk),
    pa AS (SELECT ft.sk, ord, t_ms, sec, CASE WHEN length(x) >= 20 THEN {normal_sql('x')} END AS e, row_number() OVER (PARTITION BY ft.sk ORDER BY t_ms, ord) AS rn FROM ft WHERE kind <> 'error'),
    ru AS (SELECT pa.*, CASE WHEN len(list_filter(st, lambda s: {occurs('s')})) > 0 THEN 'starter_code_match' WHEN len(list_filter(su, lambda s: {occurs('s')})) > 0 THEN 'own_submission_match'
        WHEN (length(c) - length(replace(c, e, ''))) / length(e) >= 2 THEN 'in_session_corpus_match' END AS early FROM pa LEFT JOIN co USING (sk) LEFT JOIN so USING (sk)),
    r AS (SELECT DISTINCT sk, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS ord, CAST(NULL AS BIGINT) AS t_ms, CAST(NULL AS BIGINT) AS sec, CAST(NULL AS VARCHAR) AS reason, []::VARCHAR[] AS seen FROM ru
      UNION ALL SELECT sk, rn, ord, t_ms, sec, CASE WHEN early IS NOT NULL THEN early WHEN again THEN 'duplicate_paste' END, CASE WHEN e IS NOT NULL AND (early IS NOT NULL OR NOT again) THEN list_append(seen, e) ELSE seen END
      FROM (SELECT ru.*, seen, coalesce(len(list_filter(seen, lambda p: p = e OR (length(e) >= 40 AND contains(e, p)) OR (length(p) >= 40 AND contains(p, e)))) > 0, false) AS again FROM r JOIN ru ON ru.sk = r.sk AND ru.rn = r.rn + 1)),
    w AS (SELECT r.sk, r.ord, r.t_ms, coalesce(reason, CASE WHEN EXISTS (SELECT 1 FROM ev c WHERE c.kind = 'purchase' AND c.sk = r.sk AND c.k IS NOT NULL AND r.t_ms - c.t_ms BETWEEN 0 AND {COPIED}
        AND (r.sec IS NULL OR c.ord % 4 = 0 OR c.ord % 3 = r.sec)) THEN 'preceding_copy' END) AS reason FROM r WHERE rn > 0)
    SELECT sk, ord, t_ms, CASE WHEN reason IS NULL THEN 'external' ELSE 'internal' END AS origin, reason FROM w""")
def f3_paste_origins(spark, sf_dir):
    rows = events(spark, sf_dir).filter("k is not null and t_ms is not null").withColumn("section_id", F.expr("case when ord % 4 > 0 then ord % 3 end"))
    cut = rows.filter("kind in ('click', 'view', 'error')").withColumn("x", F.expr(CUT)).withColumn("excerpt", F.expr(EXCERPT))
    kind = F.when(F.col("kind") == "error", "TEXT_CORRECTION").otherwise("LARGE_PASTE")
    edits = cut.select("sk", "ord", "t_ms", kind.alias("kind"), "section_id", "excerpt", F.array("excerpt").alias("texts"))
    sent = rows.filter("kind = 'signup'").select("sk", "ord", "t_ms", F.expr(STARTER).alias("starter"), F.expr(SOURCE).alias("source"))
    copies = rows.filter("kind = 'purchase'").select("sk", "t_ms", "section_id")
    return facts.paste_origins(edits, sent, copies, COPIED)
