"""One nested document per session: each section is grouped on its own and joined by the session key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.operators.joins import first_match, overlap

STORY_PAD_MS = 15_000


def clips(events: DataFrame, media: DataFrame, width: int = 60_000) -> DataFrame:
    """(sk, ord, clip segments, key): the pieces of every media chunk that an event's span meets."""
    asked = events.withColumn("end_ms", F.greatest("end_ms", F.col("start_ms") + 1))
    pairs = overlap(asked, media, ["sk"], width=width)
    segment = F.struct(
        F.col("b_start_ms").alias("chunk_start_ms"), F.col("b_chunk_id").alias("chunk_id"), (F.greatest("start_ms", "b_start_ms") - F.col("b_start_ms")).alias("seek_ms"),
        (F.least("end_ms", "b_end_ms") - F.col("b_start_ms")).alias("stop_ms"),
    )
    grouped = pairs.groupBy("sk", "ord").agg(F.array_sort(F.collect_list(segment)).alias("segments"))
    key = F.substring(F.sha2(F.to_json("segments"), 256), 1, 16)
    return grouped.withColumn("clip_key", key)


def story_facts(stories: DataFrame, facts: DataFrame, most: int = 8, width: int = 60_000) -> DataFrame:
    """The first facts around each story, then one per kind and time."""
    pairs = overlap(stories, facts, ["sk"], pad_ms=STORY_PAD_MS, width=width)
    w = Window.partitionBy("sk", "ord").orderBy("b_start_ms", "b_ord")
    top = pairs.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).dropDuplicates(["sk", "ord", "b_kind", "b_start_ms"])
    return top.select("sk", "ord", F.col("b_kind").alias("kind"), F.col("b_start_ms").alias("t_ms"))


def timeline_entries(entries: DataFrame, bucket_ms: int = 30_000) -> DataFrame:
    """The most confident entry per type and rounded span."""
    cell = lambda c: F.bround(F.col(c) / float(bucket_ms))
    rows = entries.withColumn("_a", cell("start_ms")).withColumn("_b", cell("end_ms"))
    return first_match(rows, ["sk", "event_type", "_a", "_b"], [F.desc("confidence"), "ord"]).drop("_a", "_b")


def notes(rejected: DataFrame, pastes: DataFrame, coverage: DataFrame) -> DataFrame:
    """Rows in the candidate's favour: speed alone, no paste, good coverage."""
    speed = rejected.filter("rejected_by = 'SmartStudentGuard'").select("sk", F.lit("Fast work alone is no signal.").alias("note")).distinct()
    none = coverage.select("sk").join(pastes.select("sk").distinct(), "sk", "left_anti").select("sk", F.lit("No outside paste was recorded.").alias("note"))
    seen = coverage.filter("ratio >= 0.8").select("sk", F.lit("Most of the session was reviewed.").alias("note"))
    return speed.unionByName(none).unionByName(seen)


def collected(df: DataFrame, out: str, order: list[str]) -> DataFrame:
    """One sorted array of structs per session; the order columns come first."""
    fields = [*order, *[c for c in df.columns if c not in (*order, "sk")]]
    return df.groupBy("sk").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def assemble(sessions: DataFrame, parts: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """``sessions`` with every part as an array column; a session without rows of a part has an empty array."""
    out = sessions
    for name, (df, order) in parts.items():
        arrays = collected(df, name, order)
        kind = dict(arrays.dtypes)[name]
        out = out.join(arrays, "sk", "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return out
