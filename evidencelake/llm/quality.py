"""Quality rules learned as a decision list (built-in functions only).

Each text gets statistics (words, symbols, repeated lines, repeated three-word windows, ...).  Sequential covering
over the labelled rows then grows one conjunction of thresholds at a time for "poor quality": each growing step is
one grouped count over binned statistics of the rows that the conjunction still covers, the condition with the
largest FOIL gain is added, and the conjunction is cut back to the prefix that does best on a held-out fold.
Covered rows leave and the next rule follows.  The list comes out as ordered ``F.when`` expressions.

Defined results: a null text counts as empty; texts without words have zero statistics and fail the base rule;
with no labelled rows the list is empty and the base rule alone decides; a row labelled twice counts by its mean
label, ties as good; repeated rows stay repeated; extra columns of the input are ignored by ``statistics`` and kept
by ``judge``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencelake.llm.common import SPACE, stash

FEATURES = ("n_words", "mean_word", "symbols_per_word", "dup_lines", "repeated_words", "upper_per_char", "distinct_words", "words_per_line", "bangs_per_word")
BINS = 32


def statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Base counts and the ratios that rules are made of, for whole texts."""
    words = F.filter(F.split("t", f"[{SPACE}]+"), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    windows = F.when(
        F.size("words") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    ranked = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    # starts of the windows found twice or more, then the length of the union of [start, start + 3)
    twice = F.filter("ranked", lambda x, i: (x.h == F.get("ranked", i - 1).h) | (x.h == F.get("ranked", i + 1).h))
    starts = F.array_sort(F.transform(twice, lambda x: x.i))
    covered = F.transform("starts", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("starts", i + 1) - p, F.lit(3))))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    counted = (
        docs.select(*keep, F.coalesce(text, F.lit("")).alias("t"))
        .withColumn("words", words)
        .withColumn("windows", windows)
        .withColumn("ranked", ranked)
        .withColumn("starts", starts)
        .withColumn("lines", lines)
        .select(
            *keep,
            F.char_length("t").cast("long").alias("n_chars"),
            F.size("words").cast("long").alias("n_words"),
            F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
            F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"),
            F.size("lines").cast("long").alias("n_lines"),
            F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
            F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_upper"),
            (F.char_length("t") - F.char_length(F.replace("t", F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
        )
    )
    return counted.select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word"),
        ratio("n_symbols", "n_words").alias("symbols_per_word"),
        ratio("n_dup_lines", "n_lines").alias("dup_lines"),
        ratio("n_repeat_words", "n_words").alias("repeated_words"),
        ratio("n_upper", "n_chars").alias("upper_per_char"),
        ratio("n_distinct", "n_words").alias("distinct_words"),
        ratio("n_words", "n_lines").alias("words_per_line"),
        ratio("n_bangs", "n_words").alias("bangs_per_word"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def learn(
    labelled: DataFrame,
    label: str = "poor",
    ident: str = "doc_id",
    max_rules: int = 8,
    max_conditions: int = 3,
    min_precision: float = 0.9,
    min_cover: int = 5,
) -> list[Rule]:
    """Ordered rules for ``label`` = 1 over all rows of ``labelled``; a third of the rows, by id, is the pruning fold."""
    cuts_row = labelled.select(
        *[F.percentile_approx(F.col(f).cast("double"), [i / BINS for i in range(BINS)], 2000).alias(f) for f in FEATURES]
    ).first()
    cuts = {f: sorted(set(cuts_row[f] or [])) for f in FEATURES}
    if not any(cuts.values()):
        return []

    def binned(feature: str) -> Column:
        value = F.col(feature).cast("double")
        below = F.filter(F.array(*map(F.lit, cuts[feature])), lambda t: t < value)
        return F.struct(F.lit(feature).alias("f"), F.size(below).alias("b"))

    bins = F.array(*[binned(f) for f in FEATURES if cuts[f]])
    fold = F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(3))
    rows = stash(labelled.select(*FEATURES, F.col(label).alias("y"), (fold == 2).alias("prune"), bins.alias("bins")), "labelled")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule = grow(rows, cuts, max_conditions, min_cover)
        rule, hits, misses = prune(rows, rule) if rule else ((), 0, 0)
        if not rule or hits + misses < min_cover or hits < min_precision * (hits + misses):
            break
        rules.append(rule)
        rows = rows.filter(~holds(rule))
    return rules


def grow(rows: DataFrame, cuts: dict[str, list[float]], max_conditions: int, min_cover: int) -> Rule:
    rule: Rule = ()
    while len(rule) < max_conditions:
        counted = (
            rows.filter(~F.col("prune") & holds(rule))
            .select("y", F.explode("bins").alias("x"))
            .groupBy("x.f", "x.b", "y")
            .count()
            .collect()  # at most features * bins * 2 rows
        )
        n: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0, 0])
        for r in counted:
            n[r["f"], r["b"]][r["y"]] += r["count"]
        whole = [sum(v[y] for (f, _), v in n.items() if f == next(iter(n))[0]) for y in (0, 1)]
        if not whole[1] or not whole[0]:
            break
        now, best = math.log2(whole[1] / sum(whole)), (0.0, None)
        for f, edges in cuts.items():
            low = [0, 0]
            for i, t in enumerate(edges):
                low = [low[y] + n[f, i][y] for y in (0, 1)]
                for above, (bad, good) in ((False, low), (True, [whole[y] - low[y] for y in (0, 1)])):
                    if good + bad < min_cover or not good:
                        continue
                    gain = good * (math.log2(good / (good + bad)) - now)
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(f, above, float(t)))
        if best[1] is None:
            break
        rule = (*rule, best[1])
    return rule


def prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix that does best on the pruning fold, with its right and wrong rows there."""
    sums = []
    for i in range(1, len(rule) + 1):
        hit = holds(rule[:i])
        sums += [F.count_if(hit & (F.col("y") == 1)).alias(f"p{i}"), F.count_if(hit & (F.col("y") == 0)).alias(f"n{i}")]
    r = rows.filter("prune").agg(*sums).first()
    value = lambda i: ((r[f"p{i}"] - r[f"n{i}"]) / max(1, r[f"p{i}"] + r[f"n{i}"]), r[f"p{i}"], -i)
    best = max(range(1, len(rule) + 1), key=value)
    return rule[:best], r[f"p{best}"], r[f"n{best}"]


def judge(rules: list[Rule]) -> Column:
    """The text of the first rule that holds, else null: an ordered conditional."""
    out = None
    for rule in rules:
        said = F.lit(" and ".join(map(str, rule)))
        out = F.when(holds(rule), said) if out is None else out.when(holds(rule), said)
    return F.lit(None).cast("string") if out is None else out.otherwise(F.lit(None))


def with_labels(stats: DataFrame, labels: DataFrame, quality: str = "quality") -> DataFrame:
    mean = labels.filter(F.col(quality).isNotNull()).groupBy("doc_id").agg(F.avg(quality).alias("q"))
    return stats.join(mean, "doc_id").withColumn("poor", (F.col("q") < 0.5).cast("int"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(docs: DataFrame, labels: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Statistics and verdict of every document: computed once, written, and read both for learning and judging."""
    stats = stash(statistics(docs, keep=keep), "text-statistics")
    rules = learn(with_labels(stats, labels))
    failed = stats.withColumn("base_failed", base_failed()).withColumn("rule", judge(rules))
    return failed.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"]
    return judged(docs, labels).select(*columns)
