"""Thresholds hold at exactly N and not at N + 1; sessions never touch each other."""

from pyspark.sql import functions as F

from evidencelake.operators import intervals, joins, sequences


def test_follow_boundary(spark):
    a = spark.createDataFrame([(1, 1, 0, 1000), (2, 2, 0, 1000)], "sk int, ord int, start_ms bigint, end_ms bigint")
    b = spark.createDataFrame([(1, 10, 1000), (1, 11, 16000), (1, 12, 16001), (2, 13, 999)], "sk int, ord int, start_ms bigint")
    got = joins.follow(a, b, ["sk"], 15_000)
    assert sorted(r["b_ord"] for r in got.collect()) == [10, 11]


def test_overlap_once_across_buckets(spark):
    a = spark.createDataFrame([(1, 1, 0, 10_000_000)], "sk int, ord int, start_ms bigint, end_ms bigint")
    b = spark.createDataFrame([(1, 2, 5, 9_000_000), (1, 3, 10_000_000, 10_000_001), (1, 4, 10_000_001, 10_000_002)], "sk int, ord int, start_ms bigint, end_ms bigint")
    assert sorted(r["b_ord"] for r in joins.overlap(a, b, ["sk"], width=1000).collect()) == [2, 3]
    assert sorted(r["b_ord"] for r in joins.overlap(a, b, ["sk"], width=1000, closed=False).collect()) == [2]


def test_episode_gap(spark):
    rows = [(1, 1, 0, 10_000), (1, 2, 32_000, 33_000), (1, 3, 55_001, 60_000)]
    df = spark.createDataFrame(rows, "sk int, ord int, start_ms bigint, end_ms bigint")
    got = sequences.episodes(df, F.lit(True), ["sk"], ["start_ms", "ord"]).collect()
    assert sorted((r["t0_ms"], r["t1_ms"], r["n_hits"], r["union_ms"]) for r in got) == [(0, 33_000, 2, 11_000), (55_001, 60_000, 1, 4_999)]


def test_empty_and_zero_length(spark):
    df = spark.createDataFrame([(1, 5, 5), (1, 7, 6)], "sk int, start_ms bigint, end_ms bigint")
    assert intervals.union_length(df, ["sk"]).count() == 0
    assert intervals.merge_intervals(df.filter("false"), ["sk"]).count() == 0


def test_sessions_are_isolated(spark):
    rows = [(1, 0, 10), (1, 5, 20), (2, 3, 8)]
    df = spark.createDataFrame(rows, "sk int, start_ms bigint, end_ms bigint")
    both = {r["sk"]: r["union_ms"] for r in intervals.union_length(df, ["sk"]).collect()}
    assert both == {1: 20, 2: 5}


def test_excerpts_of_every_length_and_script(spark):
    """Short excerpts, excerpts without blanks and excerpts of which only the middle occurs, against all pairs."""
    import random

    from evidencelake.plans.scalar_queries import excerpts_in

    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    base = [" ".join(word(rng.randint(2, 9)) for _ in range(60)), word(300), "日本語" * 12 + "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(90)), word(20), "x" * 50, word(19)]
    items = [(i, e) for i, e in enumerate([s[j : j + n].strip() for s in base for n in (19, 20, 25, 39, 40, 41, 50, 80) for j in (0, 7, 31) if s[j : j + n].strip()])]
    items += [(1000 + i, "qqqqq" + base[0][j : j + 40].strip() + "zzzzz") for i, j in enumerate((0, 50, 90))] + [(2000, "eight words of a benchmark item that match")]
    docs = [(i, s) for i, s in enumerate(base)] + [(10, "so these eight words of a benchmark item that match here"), (11, ""), (12, None)]

    def holds(e, s):
        mid = e[5:-5]
        return len(e) >= 20 and len(s or "") >= 20 and (e in s or (len(e) >= 40 and len(mid) >= 20 and mid in s))

    got = sorted(tuple(r) for r in excerpts_in(spark.createDataFrame(items, "item_id bigint, e string"), spark.createDataFrame(docs, "doc_id bigint, s string")).collect())
    assert got == sorted((i, d) for i, e in items for d, s in docs if holds(e, s)) and (2000, 10) in got
