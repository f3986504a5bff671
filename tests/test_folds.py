"""Sequential operators against plain Python models, on random sessions."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from evidencelake.operators import folds


def sessions(seed, n=40):
    rng = random.Random(seed)
    rows, k = [], 0
    for sk in range(6):
        t = 0
        for _ in range(rng.randrange(0, n)):
            t += rng.choice([0, 500, 2000, 4999, 5000, 5001, 9000])
            k += 1
            rows.append((sk, k, t, t + rng.choice([0, 1000]), rng.randrange(1, 300), rng.choice([None, 1, 2, 3]), rng.choice("ab")))
    return rows


COLUMNS = "sk int, ord int, t_ms bigint, end_ms bigint, chars bigint, element int, kind string"


def model_clusters(rows, gap):
    out = []
    for sk in {r[0] for r in rows}:
        cur = None
        for _, o, t, e, c, g, _ in sorted((r for r in rows if r[0] == sk), key=lambda r: (r[2], r[1])):
            if cur and t - cur["t1"] <= gap and (g is None or cur["g"] is None or g == cur["g"]):
                cur["t1"], cur["n"], cur["total"] = max(cur["t1"], e), cur["n"] + 1, cur["total"] + c
                if c > cur["s"]:
                    cur["s"], cur["g"] = c, g
            else:
                if cur:
                    out.append((sk, *cur.values()))
                cur = {"t0": t, "t1": e, "n": 1, "total": c, "s": c, "g": g}
        if cur:
            out.append((sk, *cur.values()))
    return sorted(out, key=repr)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_clusters(spark, seed):
    rows = sessions(seed)
    df = spark.createDataFrame(rows, COLUMNS)
    got = folds.cluster_by_largest(df, ["sk"], gap_ms=5000).collect()
    assert sorted((tuple(r) for r in got), key=repr) == model_clusters(rows, 5000)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_greedy_and_next_unused(spark, seed):
    rows = sessions(seed)
    df = spark.createDataFrame(rows, COLUMNS).select("sk", "ord", "t_ms", "kind")
    a, b = df.filter("kind = 'a'"), df.filter("kind = 'b'")
    near = folds.greedy_pairs(
        a, b, ["sk"], lambda x, y: (y["t_ms"] - x["t_ms"] <= 6000) & (x["t_ms"] - y["t_ms"] <= 6000),
        lambda x, y: (y["t_ms"] - x["t_ms"]) * (y["t_ms"] - x["t_ms"]), ["t_ms", "ord"], ["t_ms", "ord"], "ord", "ord",
    )
    later = folds.next_unused(a, b, ["sk"])
    want_near, want_later = [], []
    for sk in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == sk), key=lambda r: (r[2], r[1]))
        for want, ok in ((want_near, lambda d: abs(d) <= 6000), (want_later, lambda d: d > 0)):
            used = set()
            for x in (r for r in own if r[6] == "a"):
                free = [(abs(y[2] - x[2]), i, y[1]) for i, y in enumerate(r for r in own if r[6] == "b") if y[1] not in used and ok(y[2] - x[2])]
                if free:
                    used.add(min(free)[2])
                    want.append((sk, x[1], min(free)[2]))
    assert sorted(map(tuple, near.collect())) == sorted(want_near)
    assert sorted(map(tuple, later.collect())) == sorted(want_later)


def test_budget_skips_and_goes_on(spark):
    df = spark.createDataFrame([(1, 1, 9.0, 100.0), (1, 2, 8.0, 90.0), (1, 3, 7.0, 80.0), (1, 4, 6.0, 0.5)], "sk int, ord int, score double, cost double")
    got = folds.greedy_budget(df, ["sk"], "score", "cost", "ord", 180.0, 8).collect()
    assert sorted((r["rank"], r["ord"]) for r in got) == [(1, 1), (2, 3)]


def test_capped_clusters(spark):
    df = spark.createDataFrame([(1, 1, 0, 40), (1, 2, 60, 70), (1, 3, 80, 95), (1, 4, 300, 301)], "sk int, ord int, start_ms bigint, end_ms bigint")
    got = folds.capped_clusters(df, ["sk"], gap_ms=30, span_ms=90).collect()
    assert sorted((r["t0"], r["t1"], r["n"]) for r in got) == [(0, 70, 2), (80, 95, 1), (300, 301, 1)]
