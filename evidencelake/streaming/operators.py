"""Structured Streaming forms of the session operators.

Each takes and returns streaming (or batch) DataFrames; event time is a timestamp column, state is bounded by the watermark.
Rows later than the watermark are dropped, where a batch run would still count them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def arrivals_once(chunks: DataFrame, at: str = "ts", key: str = "chunk_id", late: str = "10 minutes") -> DataFrame:
    """Each chunk once, however often it arrives within the watermark."""
    return chunks.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def coverage(chunks: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks seen per session against the expected number; holes shrink as chunks arrive (update mode)."""
    seen = chunks.groupBy(*keys).agg(F.count("*").alias("n_covered"))
    return seen.join(expected, keys).withColumn("n_holes", F.greatest(F.lit(0), F.col("n_expected") - F.col("n_covered")))


def session_episodes(hits: DataFrame, keys: list[str], start: str = "ts", length_ms: str = "length_ms", gap_ms: int = 22_000, late: str = "10 minutes") -> DataFrame:
    """Episodes as session windows whose gap is each hit's own length plus ``gap_ms`` (and a millisecond, as an equal gap still merges)."""
    gap = F.concat((F.col(length_ms) + gap_ms + 1).cast("string"), F.lit(" milliseconds"))
    window = F.session_window(F.col(start), gap)
    out = hits.withWatermark(start, late).groupBy(*keys, window.alias("w")).agg(F.count("*").alias("n_hits"))
    return out.select(*keys, F.col("w.start").alias("t0"), (F.col("w.end") - F.expr(f"interval {gap_ms + 1} milliseconds")).alias("t1"), "n_hits")


def risk_buckets(contributions: DataFrame, keys: list[str], at: str = "ts", bucket: str = "30 seconds", late: str = "10 minutes") -> DataFrame:
    """The largest score per key and tumbling bucket."""
    out = contributions.withWatermark(at, late).groupBy(*keys, F.window(at, bucket).alias("w")).agg(F.max("score_milli").alias("score_milli"), F.count("*").alias("n"))
    return out.select(*keys, F.col("w.start").alias("bucket"), "score_milli", "n")


def follow_stream(a: DataFrame, b: DataFrame, keys: list[str], within: str = "15 seconds", late: str = "10 minutes") -> DataFrame:
    """Stream-stream join: B (b_ts) at or after A (ts), at most ``within`` later; both sides drop state by their watermarks."""
    left, right = a.withWatermark("ts", late), b.withWatermark("b_ts", late)
    right = right.select(*[F.col(k).alias(f"b_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"b_{k}"))
    near = (F.col("b_ts") >= F.col("ts")) & (F.col("b_ts") <= F.col("ts") + F.expr(f"interval {within}"))
    return left.join(right, same & near).drop(*[f"b_{k}" for k in keys])


TYPING = "sk string, element string, n_edits bigint, inserted bigint, peak bigint, first_ms bigint, last_ms bigint"


class TypingState(StatefulProcessor):
    """Running edit counts per element; an element that is idle for ``idle_ms`` of event time is emitted and forgotten."""

    def __init__(self, idle_ms: int = 4 * 3_600_000):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("typing", "n bigint, inserted bigint, peak bigint, length bigint, first bigint, last bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, inserted, peak, length, first, last = self.state.get() if self.state.exists() else (0, 0, 0, 0, None, None)
        for pdf in rows:
            for ts, text in sorted(zip(pdf["ts"], pdf["text"], strict=True), key=lambda x: x[0]):
                t, size = int(ts.timestamp() * 1000), len(text or "")
                n, peak = n + 1, max(peak, size)
                inserted += size - length if 0 < size - length < 50 else 0
                length, first, last = size, t if first is None else first, t
        self.state.update((n, inserted, peak, length, first, last))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last + self.idle_ms)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, inserted, peak, _, first, last = self.state.get()
        self.state.clear()
        yield pd.DataFrame([(str(key[0]), str(key[1]), n, inserted, peak, first, last)], columns=[c.split()[0] for c in TYPING.split(", ")])

    def close(self) -> None:
        pass


def typing_sessions(edits: DataFrame, idle_ms: int = 4 * 3_600_000, late: str = "10 minutes") -> DataFrame:
    """Edits (sk, element, ts, text) to one row per element and typing session, when it has gone idle."""
    return (
        edits.withWatermark("ts", late)
        .groupBy("sk", "element")
        .transformWithStateInPandas(TypingState(idle_ms), TYPING, outputMode="Append", timeMode="EventTime")
    )


class UnionLength:
    """Table function: union length of intervals given as rows (start, end), for use in SQL."""

    def __init__(self):
        self.spans: list[tuple[int, int]] = []

    def eval(self, row) -> None:
        if row["end_ms"] > row["start_ms"]:
            self.spans.append((row["start_ms"], row["end_ms"]))

    def terminate(self):
        total, reach = 0, None
        for a, b in sorted(self.spans):
            total += max(0, b - (a if reach is None else max(a, reach)))
            reach = b if reach is None else max(reach, b)
        yield (total,)


def register(spark) -> None:
    """Makes ``union_length_ms(TABLE(...) PARTITION BY ...)`` available in SQL."""
    spark.udtf.register("union_length_ms", F.udtf(UnionLength, returnType="union_ms bigint"))
