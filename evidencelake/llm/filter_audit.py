"""Interaction audit of document filters: what each of them removes, in every order, from one table of failure masks.

Each document fails some of the filters A to E; per part of the corpus only the counts of the 32 failure masks are kept.
``walk`` goes through all subsets of filters in Gray-code order: one filter is toggled at a time, which moves the counter of
active failures of just the masks that hold it, and with these the running survivors.  The 32 states are stored, and all
that any order of the filters does at any step is a difference of two of them.

The filters (words are maximal runs without blanks, case-sensitive): A, under 200 words; B, distinct words under half of
the words; C, over 3 % of the characters are A to Z; D, holds one of ``#$%&*|``; E, equal to the text of a smaller id,
wherever that row is and whatever becomes of it.

Defined results: a null text counts as empty, which fails A only (or E); a null part is the empty string; of rows with one id
and one text none is smaller than the other; a row without id fails E never and makes none fail; labels that
repeat count if any of them says so; documents without labels are neither good nor toxic; texts are told apart by SHA-256; an empty table gives an
empty result; of the documents only the three named columns are read, and doc_id, quality and toxic of the labels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 3
SYMBOLS = b"#$%&*|"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: What is counted per failure mask.
COUNTS = ("n", "good", "toxic")


def own_failures(text: bytes) -> int:
    """The bits of A to D for a text in UTF-8."""
    words = text.split()
    chars = len(text) - len(text.translate(None, bytes(range(0x80, 0xC0)))) if not text.isascii() else 0
    chars = len(text) - chars
    upper = len(text) - len(text.translate(None, UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > UPPER_PERCENT * chars) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def judged(docs: DataFrame, text: str = "text", ident: str = "doc_id", part: str = "lang") -> DataFrame:
    """id, part, SHA-256 of the text and the bits of A to D, for every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, masks = [], []
            for v in batch.column(2):
                t = v.as_py()
                digests.append(hashlib.sha256(t).digest())
                masks.append(own_failures(t))
            arrays = [pa.array(digests, type=pa.binary()), pa.array(masks, type=pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=["id", "part", "digest", "mask"])

    rows = docs.select(
        F.col(ident).cast("long").alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t")
    )
    return rows.mapInArrow(task, "id bigint, part string, digest binary, mask int")


def mask_cells(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents per failure mask, at most 32 rows a part.

    Rows meet by id once, for the labels, and then, counted, by text: each id sends at most one row, and equal texts are
    merged before the exchange, so a text that a third of all rows share arrives as a few rows from each task.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    rows = judged(docs, text, ident, part)
    named = rows.filter("id is not null").groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")).join(marks, "id", "left")
    kinds = ("digest", "part", "mask", "good", "toxic")
    named = named.fillna(False, ["good", "toxic"]).groupBy(*kinds).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first"))
    least = named.groupBy("digest").agg(F.min("first.id").alias("least"))
    known = named.join(least, "digest").withColumn("kept", F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(F.lit(0)))
    e = F.lit(1 << FILTERS.index("E"))
    counted = known.select(
        "part", "good", "toxic", F.inline(F.array(F.struct("mask", F.col("kept").alias("n")), F.struct(F.col("mask").bitwiseOR(e).alias("mask"), (F.col("n") - F.col("kept")).alias("n"))))
    )
    nameless = rows.filter("id is null").select("part", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "mask", F.lit(1).cast("long").alias("n"))
    number = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(F.lit(0))).alias(c)
    return counted.unionByName(nameless).filter("n > 0").groupBy("part", "mask").agg(F.sum("n").alias("n"), number("good"), number("toxic"))


def walk(cells: dict[int, tuple[int, ...]], filters: int = len(FILTERS)) -> list[tuple[int, ...]]:
    """Survivors (one number per count) of every subset of filters, by the subset's bits; ``cells`` has counts by failure mask."""
    failing = dict.fromkeys(cells, 0)
    alive = [sum(c) for c in zip(*cells.values(), strict=True)] if cells else [0] * len(COUNTS)
    states: list[tuple[int, ...]] = [()] * (1 << filters)
    states[0] = tuple(alive)
    active = 0
    for step in range(1, 1 << filters):
        bit = step & -step  # the bit in which the Gray codes of step and step - 1 differ
        active ^= bit
        change = 1 if active & bit else -1
        for mask, counts in cells.items():
            if mask & bit:
                was = failing[mask]
                failing[mask] = was + change
                if was == 0 or was + change == 0:
                    alive = [a - change * c for a, c in zip(alive, counts, strict=True)]
        states[active] = tuple(alive)
    return states


def steps(states: list[tuple[int, ...]], filters: str = FILTERS) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders and steps."""
    every = len(states) - 1
    bits = {f: 1 << i for i, f in enumerate(filters)}
    fails = {f: states[0][0] - states[b][0] for f, b in bits.items()}
    unique = {f: states[every ^ b][0] - states[every][0] for f, b in bits.items()}
    shapley = dict.fromkeys(filters, 0)
    out = []
    for order in permutations(filters):
        active = 0
        for k, f in enumerate(order, 1):
            before, active = states[active], active | bits[f]
            removed, good, toxic = (b - a for b, a in zip(before, states[active], strict=True))
            shapley[f] += removed
            out.append(("".join(order), k, states[active][0], removed, fails[f] - removed, unique[f], good, toxic, f))
    return [(*row[:-1], shapley[row[-1]]) for row in out]


NAMES = ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", part: str = "lang") -> DataFrame:
    """Per part, order of the filters and step: what stays, goes, went before, and what it costs."""

    def of_part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cells = {int(r.mask): tuple(int(getattr(r, c)) for c in COUNTS) for r in rows.itertuples()}
        out = pd.DataFrame(steps(walk(cells)), columns=list(NAMES))
        out.insert(0, "part", key[0])
        return out

    return mask_cells(docs, labels, text, ident, part).groupBy("part").applyInPandas(of_part, SCHEMA)


ORACLE = r"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), judged AS (
    SELECT part, doc_id,
           (len(w) < 200)::INT
           + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
           + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
           + 8 * regexp_matches(t, '[#$%&*|]')::INT
           + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
    FROM words
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), cells AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM judged LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), letters AS (
    SELECT substr('ABCDE', i, 1) AS f, (2 ** (i - 1))::INT AS bit FROM range(1, 6) r(i)
), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, k AS step, l.bit,
           (SELECT coalesce(sum(p.bit), 0) FROM letters p WHERE position(p.f IN substr(filter_order, 1, k - 1)) > 0)::INT AS before
    FROM orders, range(1, 6) r(k) JOIN letters l ON l.f = substr(filter_order, k, 1)
), counted AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""
