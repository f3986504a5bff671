"""Near-duplicates by brute force where ids are null or repeated, groups large, and texts of unequal length."""

import collections
import itertools

import numpy as np
from pyspark.sql import functions as F

from evidencelake.llm import ngram_join

SCHEMA = "doc_id bigint, text string"


def brute(rows):
    """(class id, links) of every row, each a document by itself."""
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    links, label = [0] * len(rows), list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
            links[a] += 1
            links[b] += 1
            old, new = label[b], label[a]
            label = [new if x == old else x for x in label]
    ids = collections.defaultdict(list)
    for i, (k, _) in enumerate(rows):
        ids[label[i]].append(k)
    least = {c: min((k for k in own if k is not None), default=None) for c, own in ids.items()}
    return [(k, least[label[i]], links[i]) for i, (k, _) in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=repr)


def check(spark, rows, text=False):
    df = spark.createDataFrame(rows, SCHEMA)
    got = ngram_join.near_duplicates(df).collect()
    assert ordered((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == ordered(brute(rows))


def text(rng, n):
    return [f"n{x}" for x in rng.integers(0, 10**9, n)]


def test_null_ids_lose_no_link(spark):
    rng = np.random.default_rng(1)
    a, b = " ".join(text(rng, 60)), " ".join(text(rng, 60))
    check(spark, [(None, a), (None, b), (1, a + " more"), (2, b + " more")])
    check(spark, [(None, a), (None, a), (None, b), (None, b + " more")])


def test_repeated_ids_lose_no_link(spark):
    rng = np.random.default_rng(2)
    a, b = " ".join(text(rng, 60)), " ".join(text(rng, 60))
    check(spark, [(5, a), (5, b), (7, b + " more"), (8, a + " more"), (5, b), (9, None), (9, "")])


def test_groups_of_unequal_sizes(spark, monkeypatch):
    """A chain of texts, each a little longer than the one before, in blocks of three."""
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rng = np.random.default_rng(3)
    words = text(rng, 400)
    rows = [(i, " ".join(words[: 40 + 9 * i])) for i in range(36)]
    for bucket in (1024, 2):
        monkeypatch.setattr(ngram_join, "BUCKET", bucket)
        check(spark, rows)


def test_templates_do_not_join(spark):
    """Texts that share half of their n-grams are candidates of one another now and then, and never linked."""
    rng = np.random.default_rng(4)
    frame = text(rng, 60)
    rows = [(i, " ".join([*frame, *text(rng, 60)])) for i in range(40)] + [(100 + i, " ".join([*frame, *text(rng, 4)])) for i in range(4)]
    check(spark, rows)
    assert ngram_join.least_agreement(100, 0.8) > 55


def test_one_of_each_class_stays(spark):
    rng = np.random.default_rng(5)
    a, b, c = (" ".join(text(rng, 60)) for _ in range(3))
    rows = [(None, a), (None, a), (3, b), (3, b), (4, b + " more"), (6, c), (6, a), (7, None), (None, ""), (None, c + " more"), (None, "x " + c)]
    df = spark.createDataFrame([(k, t, i, "t") for i, (k, t) in enumerate(rows)], f"{SCHEMA}, key bigint, times string")
    got = ngram_join.keep_first(df, ngram_join.classified(df))
    assert got.columns == df.columns
    assert ordered((r["doc_id"], r["text"]) for r in got.collect()) == ordered([(6, a), (3, b), (6, c), (7, None), (None, "")])
    assert ngram_join.keep_first(df.filter("false"), ngram_join.classified(df.filter("false"))).count() == 0


def test_hot_copies(spark):
    """A third of all rows are one text, half of these without an id."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 6 != 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one text of seven words that repeats").otherwise(F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.col("id").cast("string")) for i in range(8)])).alias("text"),
    )
    got = ngram_join.near_duplicates(df)
    assert got.filter("n_links = 999 and class_id = 3").count() == 1000 and got.filter("n_links = 0").count() == 2000
    assert ngram_join.keep_first(df, ngram_join.classified(df)).count() == 2001
