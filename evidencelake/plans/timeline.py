"""Clocks and timelines: one master timeline per session from activity logs, media chunks and event times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.functions import urls
from evidencelake.operators import intervals, sequences
from evidencelake.operators.joins import contains, first_match

SESSION_LIMIT_MS = 8 * 3_600_000


def origin(log: DataFrame) -> DataFrame:
    """T0 per session: the start of the assessment, else the first row; the end of all sections where logged."""
    start = F.min_by("t_ms", F.when(F.col("kind") == "ASSESSMENT_STARTED", F.col("ord")))
    done = F.max(F.when(F.col("kind") == "ALL_SECTIONS_COMPLETED", F.col("t_ms")))
    return log.groupBy("sk").agg(F.coalesce(start, F.min_by("t_ms", "ord")).alias("t0_ms"), done.alias("done_ms"), F.max("t_ms").alias("last_ms"))


def anchors(log: DataFrame, t0: DataFrame) -> DataFrame:
    """Log rows on the session's clock, never before 0."""
    rows = log.join(t0.select("sk", "t0_ms"), "sk")
    return rows.select("sk", "ord", "kind", F.greatest(F.lit(0), F.col("t_ms") - F.col("t0_ms")).alias("offset_ms"), F.col("t_ms").alias("raw_ms"))


def section_spans(log: DataFrame, t0: DataFrame, labels: DataFrame) -> DataFrame:
    """The i-th section start takes the i-th label; it ends with the first end of its own section at or after it, else at once."""
    section = F.try_element_at("metadata", F.lit("sectionId"))
    rows = log.withColumn("section", section).filter(F.col("kind").isin("SECTION_STARTED", "SECTION_COMPLETED"))
    later = Window.partitionBy("sk", "section").orderBy("t_ms").rangeBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("end_ms", F.min(F.when(F.col("kind") == "SECTION_COMPLETED", F.col("t_ms"))).over(later)).filter("kind = 'SECTION_STARTED'")
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("sk").orderBy("t_ms", "ord")) - 1)
    named = rows.join(labels.select("sk", F.col("ord").alias("pos"), "section_id"), ["sk", "pos"], "left").join(t0.select("sk", "t0_ms"), "sk")
    return named.select(
        "sk", F.col("pos").alias("ord"), F.coalesce("section_id", "section").alias("section_id"), (F.col("t_ms") - F.col("t0_ms")).alias("start_ms"),
        (F.coalesce("end_ms", "t_ms") - F.col("t0_ms")).alias("end_ms"),
    )


def chunk_spans(chunks: DataFrame, t0: DataFrame, fallback_ms: int = 60_000) -> DataFrame:
    """Spans of media chunks on the session's clock: by the clock in their id, else by their neighbours' durations."""
    rows = chunks.filter("sidecar_role is null").withColumn("clock", urls.chunk_clock(F.col("chunk_id"))).join(t0.select("sk", "t0_ms"), "sk")
    rows = rows.withColumn("known", F.col("clock.start_ms") - F.col("t0_ms")).withColumn("len", F.coalesce("duration_ms", "clock.duration_ms", F.lit(fallback_ms)))
    filled = sequences.filled_clock(rows, ["sk", "prefix"], "sequence", "known", "len")
    start = F.greatest(F.lit(0), F.col("filled_start"))
    quality = F.when(F.col("known").isNotNull(), "ok").otherwise("estimated")
    return filled.select("sk", "prefix", "sequence", "chunk_id", "section_id", start.alias("start_ms"), (start + F.col("len")).alias("end_ms"), quality.alias("quality"))


def edit_spans(spans: DataFrame) -> DataFrame:
    """Edit-log spans in order: a span without a clock starts at the running end, a reversed one is turned round."""
    w = Window.partitionBy("sk").orderBy("sequence")
    low, high = F.least("start_ms", "end_ms"), F.greatest("start_ms", "end_ms")
    running = F.coalesce(F.max(high).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = F.greatest(F.lit(0), F.coalesce(low, running))
    return spans.withColumns({"start_ms": start, "end_ms": F.greatest(start, F.coalesce(high, running))})


def within_limit(events: DataFrame, limit_ms: int = SESSION_LIMIT_MS) -> DataFrame:
    return events.filter((F.col("offset_ms") <= limit_ms) & (F.col("offset_ms") >= 0))


def attributed(events: DataFrame, artifacts: DataFrame, width: int = 60_000) -> DataFrame:
    """Events with the first artifact, in registry order, that holds them, and their place in it."""
    spans = artifacts.select("sk", "chunk_id", "start_ms", "end_ms", F.row_number().over(Window.partitionBy("sk").orderBy("start_ms", "prefix", "sequence")).alias("reg"))
    hits = contains(events.select("sk", "ord", "offset_ms"), spans, ["sk"], at="offset_ms", width=width)
    best = first_match(hits, ["sk", "ord"], ["b_reg"]).select("sk", "ord", F.col("b_chunk_id").alias("chunk_id"), (F.col("offset_ms") - F.col("b_start_ms")).alias("local_ms"))
    return events.join(best, ["sk", "ord"], "left")


def first_events(events: DataFrame, most: int = 500) -> DataFrame:
    """The earliest events of each session: the report's limit, as a parameter."""
    w = Window.partitionBy("sk").orderBy("offset_ms", "ord")
    return events.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).drop("_n")


def durations(t0: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Session length: the logged end (or last row), stretched to the media's end."""
    media = artifacts.groupBy("sk").agg(F.max("end_ms").alias("media_ms"))
    logged = F.coalesce("done_ms", "last_ms") - F.col("t0_ms")
    return t0.join(media, "sk", "left").select("sk", F.greatest(logged, F.coalesce("media_ms", F.lit(0))).alias("duration_ms"))


def master(log: DataFrame, chunks: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
    """All timeline tables of a job: header, sections, artifacts, segments, gaps and events."""
    t0 = origin(log)
    artifacts = chunk_spans(chunks, t0)
    segments = intervals.merge_intervals(artifacts, ["sk", "prefix"], tol=5000, extra=[F.array_sort(F.collect_list("chunk_id")).alias("chunk_ids")])
    events = first_events(attributed(within_limit(anchors(log, t0)), artifacts))
    return {
        "header": t0.join(durations(t0, artifacts), "sk"), "sections": section_spans(log, t0, labels), "artifacts": artifacts, "segments": segments,
        "gaps": intervals.gaps(segments, ["sk", "prefix"], origin=0), "events": events, "missing": intervals.missing_runs(chunks, ["sk", "prefix"], "sequence"),
    }


def phase(start: Column, live_start: Column) -> Column:
    return F.when(start < live_start, "setup_verification").otherwise("live_exam")


def perception_windows(artifacts: DataFrame, sections: DataFrame, responses: DataFrame) -> DataFrame:
    """Every analysable chunk with its answer or as a hole; phase by the first section's start."""
    live = sections.groupBy("sk").agg(F.min("start_ms").alias("live_ms"))
    rows = artifacts.filter("end_ms - start_ms >= 1500").join(live, "sk", "left").join(responses, ["sk", "chunk_id"], "left")
    return rows.withColumn("phase", phase(F.col("start_ms"), F.coalesce("live_ms", F.lit(0)))).withColumn("covered", F.coalesce("covered", F.lit(False)))


def pending(artifacts: DataFrame, stored: DataFrame) -> DataFrame:
    """Chunks that still need an answer."""
    return artifacts.filter("end_ms - start_ms >= 1500").join(stored.select("sk", "chunk_id").distinct(), ["sk", "chunk_id"], "left_anti")


def origin_cascade(log_t0: DataFrame, events: DataFrame, chunks: DataFrame) -> DataFrame:
    """T0 of every session: the log's where it is positive, else the least event time, else the least clock of a video chunk, else 0; with its source."""
    low = lambda df, c, out: df.filter(F.col(c) > 0).groupBy("sk").agg(F.min(c).alias(out))
    rows = low(log_t0, "t0_ms", "log_ms").join(events.groupBy("sk").agg(F.min("t_ms").alias("event_ms")), "sk", "full")
    rows = rows.join(low(chunks, "start_ms", "chunk_ms"), "sk", "full")
    source = F.when(F.col("log_ms").isNotNull(), "activity_logs").when(F.col("event_ms").isNotNull(), "fallback_events").when(F.col("chunk_ms").isNotNull(), "fallback_chunk_epoch")
    return rows.select("sk", F.coalesce("log_ms", "event_ms", "chunk_ms", F.lit(0)).alias("t0_ms"), source.alias("t0_source"))


def duration_cascade(lengths: DataFrame) -> DataFrame:
    """Session length from the first source that has one: log (stretched to the media), video, screen, else pages, events and manifest.

    ``lengths``: sk, log_ms, video_ms, screen_ms, pages_ms, event_ms, manifest_ms; null counts as 0.
    """
    c = {n: F.coalesce(F.col(f"{n}_ms"), F.lit(0)) for n in ("log", "video", "screen", "pages", "event", "manifest")}
    length = (
        F.when(c["log"] > 0, F.greatest(c["log"], c["video"], c["screen"])).when(c["video"] > 0, F.greatest(c["video"], c["screen"])).when(c["screen"] > 0, c["screen"])
        .otherwise(F.greatest(c["pages"], c["event"], c["manifest"]))
    )
    source = F.when(c["log"] > 0, "activity_logs").when(c["video"] > 0, "video_chunks").when(c["screen"] > 0, "screen_chunks").when(c["pages"] > 0, "rrweb_chunks").otherwise("none")
    return lengths.select("sk", length.alias("duration_ms"), source.alias("duration_source"))


def media_index(artifacts: DataFrame, chunks: DataFrame) -> DataFrame:
    """Artifacts that are media, with the address and section of their chunk."""
    kind = F.when(F.col("kind") == "video", "video").when(F.col("kind").isin("screenRecording", "screen"), "screen")
    rows = artifacts.withColumn("evidence_type", kind).filter("evidence_type is not null")
    return rows.join(chunks.select("sk", "chunk_id", "url", "section_id"), ["sk", "chunk_id"], "left")


def reviewed(spans: DataFrame, answers: DataFrame, quiet_confidence: float = 0.7) -> DataFrame:
    """Every span of a recording with the answers stored for its chunk: quiet chunks are available with nothing seen, others without an answer are holes.

    ``answers``: sk, chunk_id, reviewed and event fields; a reviewed chunk may have none.
    """
    joined = spans.join(answers, ["sk", "chunk_id"], "left")
    there = F.coalesce(F.col("reviewed"), F.lit(False))
    return joined.withColumn("video_available", there).withColumn("confidence", F.when(there, F.coalesce("confidence", F.lit(quiet_confidence))).otherwise(F.lit(0.0)))


def coverage(rows: DataFrame) -> DataFrame:
    """Chunks, covered chunks and their share, per session."""
    per = rows.groupBy("sk", "chunk_id").agg(F.bool_or("video_available").alias("covered")).groupBy("sk").agg(F.count("*").alias("total"), F.count_if("covered").alias("covered"))
    return per.withColumn("coverage_ratio", F.col("covered") / F.greatest(F.lit(1), F.col("total")))


def worth_storing(bundles: DataFrame) -> DataFrame:
    """Bundles that may be stored and used again: some of the recording was seen, or there is none."""
    return bundles.filter((F.col("coverage_ratio") > 0) | (F.col("total") == 0))


def reused(wanted: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sessions whose version hash has a stored bundle, with it, and those that have to be assembled."""
    kept = stored.select("sk", "version_hash", "total", "covered", "coverage_ratio")
    return wanted.join(kept, ["sk", "version_hash"]), wanted.join(kept, ["sk", "version_hash"], "left_anti")
