"""Answers and result panels over binding E.

Options: clicks and purchases choose, views drop, by number; other rows are typing.  Panels: sign-ups hold a whole result, errors its
wording, clicks its counts, purchases both in one change.  Oracles follow the rules a row at a time by recursion.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from evidencelake.plans import answers
from evidencelake.plans.registry import HOUR, events, query

SWITCH, WITHIN = 40 * HOUR, 30 * HOUR
PREFIX = "00000000-0000-0000-0000-00000000000"

OPTIONS = f"""op AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY t_ms, ord) AS rn FROM (SELECT sk, ord, t_ms, 'o' || (k % 6) AS e, 's' || (ord % 2) AS s, '{PREFIX}' || (k % 5) AS txt, kind <> 'view' AS sel
    FROM ev WHERE k IS NOT NULL AND t_ms IS NOT NULL AND k % 11 <> 0 AND kind IN ('click', 'purchase', 'view')))"""


def put(rows: str, new: str) -> str:
    """SQL list with a struct in the place of the one with the same element, or behind the others."""
    return f"CASE WHEN len(list_filter({rows}, lambda y: y.e = e)) > 0 THEN list_transform({rows}, lambda y: CASE WHEN y.e = e THEN {new} ELSE y END) ELSE list_append({rows}, {new}) END"


RECENT, MEMBER = "{'e': e, 't': t_ms, 's': s}", "{'e': e, 'g': tgt}"
NEAR = f"lambda y: y.s = s AND t_ms - y.t <= {SWITCH}"
GROUPS = f"""{OPTIONS},
r AS (SELECT DISTINCT sk, CAST(0 AS BIGINT) AS rn, []::STRUCT(e VARCHAR, t BIGINT, s VARCHAR)[] AS ch, []::STRUCT(e VARCHAR, t BIGINT, s VARCHAR)[] AS dr, []::STRUCT(e VARCHAR, g VARCHAR)[] AS mem,
    []::STRUCT(g VARCHAR, o VARCHAR, s VARCHAR, c BIGINT, n BIGINT, a BIGINT, z BIGINT)[] AS gs FROM op
  UNION ALL SELECT sk, rn,
    CASE WHEN sel THEN {put('ch', RECENT)} WHEN hit IS NOT NULL THEN list_filter(ch, lambda y: y.e <> hit) ELSE ch END,
    CASE WHEN NOT sel THEN {put('dr', RECENT)} WHEN own IS NULL AND hit IS NOT NULL THEN list_filter(dr, lambda y: y.e <> hit) ELSE dr END,
    CASE WHEN (sel AND own IS NULL) OR (NOT sel AND hit IS NOT NULL AND tgt <> coalesce(own, e)) THEN {put('mem', MEMBER)} ELSE mem END,
    CASE WHEN NOT sel AND hit IS NOT NULL AND tgt <> coalesce(own, e) THEN list_transform(gs, lambda y: {{'g': y.g, 'o': y.o, 's': y.s, 'c': y.c + CASE WHEN y.g = tgt AND y.o <> txt THEN 1 ELSE 0 END, 'n': y.n, 'a': y.a, 'z': y.z}})
      WHEN NOT sel THEN gs
      WHEN len(list_filter(gs, lambda y: y.g = tgt)) > 0 THEN list_transform(gs, lambda y: CASE WHEN y.g = tgt THEN {{'g': y.g, 'o': txt, 's': y.s, 'c': y.c + CASE WHEN y.o <> txt THEN 1 ELSE 0 END, 'n': y.n + 1, 'a': y.a, 'z': t_ms}} ELSE y END)
      ELSE list_append(gs, {{'g': tgt, 'o': txt, 's': s, 'c': CAST(0 AS BIGINT), 'n': CAST(1 AS BIGINT), 'a': t_ms, 'z': t_ms}}) END
  FROM (SELECT *, CASE WHEN sel THEN coalesce(own, list_filter(mem, lambda y: y.e = hit)[1].g, hit, e) ELSE coalesce(list_filter(mem, lambda y: y.e = hit)[1].g, hit) END AS tgt
    FROM (SELECT op.*, ch, dr, mem, gs, list_filter(mem, lambda y: y.e = op.e)[1].g AS own, CASE WHEN op.sel THEN list_filter(dr, {NEAR})[1].e ELSE list_filter(ch, {NEAR})[1].e END AS hit FROM r JOIN op ON op.sk = r.sk AND op.rn = r.rn + 1))),
ag AS (SELECT sk, unnest(gs) AS g FROM (SELECT sk, arg_max(gs, rn) AS gs FROM r GROUP BY sk))"""


def options(spark, sf_dir):
    rows = events(spark, sf_dir).filter("k is not null and t_ms is not null")
    k, kind = F.col("k"), F.col("kind")
    text = F.when(k % 11 == 0, "").otherwise(F.concat(F.lit(PREFIX), (k % 5).cast("string")))
    checked = F.when(kind.isin("click", "purchase"), True).when(kind == "view", False)
    inputs = rows.select(
        "sk", "ord", "t_ms", F.concat(F.lit("o"), (k % 6).cast("string")).alias("element"), F.concat(F.lit("s"), (F.col("ord") % 2).cast("string")).alias("section_id"),
        F.lit("MCQ").alias("section_type"), text.alias("text"), checked.alias("is_checked"),
    )
    return answers.option_rows(inputs)


@query(f"+ {GROUPS} SELECT sk, g.g AS answer_group, g.s AS section_id, g.n AS n_selected, g.c AS n_changes, g.a AS first_ms, g.z AS last_ms FROM ag")
def f9_option_groups(spark, sf_dir):
    return answers.option_groups(options(spark, sf_dir), SWITCH)


@query(f"+ {OPTIONS} SELECT sk, ord, t_ms, s AS section_id, e AS element, txt AS option FROM op WHERE sel")
def m3_answer_selected(spark, sf_dir):
    return answers.selections(options(spark, sf_dir))


@query(f"+ {GROUPS} SELECT sk, g.g AS answer_group, g.s AS section_id, g.z AS t_ms, g.c AS n_changes FROM ag WHERE g.c >= 1")
def m4_answer_changed(spark, sf_dir):
    return answers.changes(answers.option_groups(options(spark, sf_dir), SWITCH))


@query(f"""+ mu AS (SELECT sk, ord, t_ms, k, 's' || (ord % 2) AS s, CASE kind WHEN 'signup' THEN 'full' WHEN 'purchase' THEN 'both' WHEN 'error' THEN 'panel' WHEN 'click' THEN 'count' END AS role FROM ev WHERE k IS NOT NULL AND t_ms IS NOT NULL AND k % 4 <> 0),
    q AS (SELECT *, row_number() OVER (PARTITION BY sk, s ORDER BY t_ms, ord) AS rn FROM mu WHERE role IS NOT NULL),
    r AS (SELECT DISTINCT sk, s, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS p_ord, CAST(NULL AS BIGINT) AS p_ms, CAST(NULL AS BIGINT) AS f_ord, CAST(NULL AS BIGINT) AS f_a, CAST(NULL AS BIGINT) AS f_z, CAST(NULL AS BIGINT) AS f_k, CAST(NULL AS VARCHAR) AS raw FROM q
      UNION ALL SELECT q.sk, q.s, q.rn, CASE WHEN role = 'panel' THEN q.ord WHEN role = 'count' AND NOT coalesce(q.t_ms - p_ms <= {WITHIN}, false) THEN p_ord END,
        CASE WHEN role = 'panel' THEN q.t_ms WHEN role = 'count' AND NOT coalesce(q.t_ms - p_ms <= {WITHIN}, false) THEN p_ms END,
        CASE WHEN role IN ('full', 'both') THEN q.ord WHEN role = 'count' AND q.t_ms - p_ms <= {WITHIN} THEN p_ord END, CASE WHEN role IN ('full', 'both') THEN q.t_ms WHEN role = 'count' AND q.t_ms - p_ms <= {WITHIN} THEN p_ms END, q.t_ms, q.k,
        CASE role WHEN 'full' THEN k || '/200 Test cases passed' WHEN 'both' THEN 'Test case failed [count:' || k || ' / 200]' ELSE 'test cases run [count:' || k || '/200]' END
      FROM r JOIN q ON q.sk = r.sk AND q.s = r.s AND q.rn = r.rn + 1)
    SELECT sk, s AS section_id, f_ord AS ord, f_a AS start_ms, f_z AS end_ms, f_k AS passed, CAST(200 AS BIGINT) AS total, raw AS raw_text FROM r WHERE f_ord IS NOT NULL
    UNION ALL SELECT sk, s, o, m, m, NULL, NULL, 'test cases run' FROM (SELECT sk, s, v.o AS o, v.m AS m FROM (SELECT sk, s, arg_max({{'o': p_ord, 'm': p_ms}}, rn) AS v FROM r GROUP BY sk, s)) WHERE o IS NOT NULL""")
def m2_test_results(spark, sf_dir):
    rows = events(spark, sf_dir).filter("k is not null and t_ms is not null")
    k, kind = F.col("k"), F.col("kind")
    n = k.cast("string")
    texts = (
        F.when(kind == "signup", F.array(F.lit(" "), F.concat(n, F.lit("/200 Test cases passed")))).when(kind == "purchase", F.array(F.lit("Test case failed"), F.concat(n, F.lit(" / 200 "))))
        .when(kind == "error", F.array(F.lit("test cases run"))).when(kind == "click", F.array(F.lit("x"), F.concat(n, F.lit("/200")))).otherwise(F.array(F.lit("other")))
    )
    changes = rows.select(
        "sk", "ord", "t_ms", F.concat(F.lit("s"), (F.col("ord") % 2).cast("string")).alias("section_id"), F.when(k % 4 == 0, "MCQ").otherwise("Coding round").alias("section_type"), texts.alias("texts")
    )
    return answers.test_results(changes, WITHIN)
