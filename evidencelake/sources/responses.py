"""Stored model responses: text to typed events, observations and proposed signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAMERA = (
    "chunkId string, chunkDurationMs double, chunkFullyReviewed boolean, captureQualityTier string, "
    "events array<struct<kind: string, startMsLocal: double, endMsLocal: double, attrs: map<string,string>, confidence: double, summary: string>>"
)
SCREEN = "externalResourceLabels array<string>, pastedTextExcerpt string, visibleQuestionRef string, qualityCaveat string, confidence double, externalResourceVisible string, aiAssistantUiVisible string"
SIGNAL = "signalType string, signal_type string, episodeRef string, episode_ref string, confidence string, machineFactsCited array<string>, observationsCited array<string>, baselineMetricsCited array<string>"
ADJUDICATION = f"candidateSignals array<struct<{', '.join(x.replace(' ', ': ', 1) for x in SIGNAL.split(', '))}>>, episodeAnalysis array<struct<episodeId: string, willEmitSignal: boolean>>"


def unfenced(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), r"^```(?:json)?\s*|\s*```$", "")


def share(c: Column) -> Column:
    """Cut to [0, 1]; a missing one is one half."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))).otherwise(0.5)


def camera_events(stored: DataFrame, kinds: list[str]) -> DataFrame:
    """Events of stored camera answers; ``stored`` has sk, chunk_id, start_ms (of the chunk), duration_ms and response.

    Local times are cut to the chunk, empty ones dropped; unknown kinds become other; a missing confidence is one half.
    """
    raw = stored.withColumn("r", F.from_json(unfenced(F.col("response")), CAMERA, {"mode": "PERMISSIVE"})).filter("r is not null")
    length = F.coalesce(F.nullif(F.col("r.chunkDurationMs"), F.lit(0.0)), F.col("duration_ms").cast("double"), F.lit(60_000.0))
    rows = raw.select("sk", "chunk_id", F.col("start_ms").alias("chunk_start"), length.alias("len"), F.col("r.captureQualityTier").alias("tier"), F.posexplode("r.events").alias("pos", "e"))
    cut = lambda c: F.greatest(F.lit(0.0), F.least(F.col(c), F.col("len")))
    good = F.col("e.startMsLocal").isNotNull() & F.col("e.endMsLocal").isNotNull() & ~F.isnan("e.startMsLocal") & ~F.isnan("e.endMsLocal")
    rows = rows.filter(good).withColumn("a", cut("e.startMsLocal")).withColumn("b", cut("e.endMsLocal")).filter("b > a")
    whole = lambda c: F.bround(F.col(c)).cast("bigint")
    return rows.select(
        "sk", "chunk_id", F.concat(F.lit("e_"), "chunk_id", F.lit("_"), F.col("pos").cast("string")).alias("event_id"),
        F.when(F.col("e.kind").isin(kinds), F.col("e.kind")).otherwise("other").alias("kind"),
        (F.col("chunk_start") + whole("a")).alias("start_ms"), (F.col("chunk_start") + whole("b")).alias("end_ms"),
        F.greatest(F.lit(1), F.bround(F.col("b") - F.col("a")).cast("bigint")).alias("duration_ms"),
        F.coalesce("e.attrs", F.create_map().cast("map<string,string>")).alias("attrs"), F.col("e.summary").alias("summary"),
        share(F.col("e.confidence")).alias("confidence"),
        F.when(F.col("tier").isin("HIGH", "MEDIUM", "LOW", "NONE"), F.col("tier")).otherwise("MEDIUM").alias("tier"),
    )


def speech_complete(events: DataFrame) -> DataFrame:
    """Speech events say so in their attributes, and always have a summary and a class."""
    speech = F.col("kind") == "speech"
    known = F.coalesce(F.nullif(F.try_element_at("attrs", F.lit("speechContentClass")), F.lit("UNKNOWN")), F.lit("unclear"))
    said = F.coalesce(F.try_element_at("attrs", F.lit("speechSummary")), F.nullif("summary", F.lit("")), F.lit("Speech heard; content not summarised."))
    more = F.create_map(F.lit("speechPresent"), F.lit("yes"), F.lit("speechContentClass"), known, F.lit("speechSummary"), said)
    rest = F.map_filter("attrs", lambda k, v: ~k.isin("speechPresent", "speechContentClass", "speechSummary"))
    return events.withColumn("attrs", F.when(speech, F.map_concat(rest, more)).otherwise(F.col("attrs")))


def screen_observations(stored: DataFrame) -> DataFrame:
    """One row per screen chunk; an unreadable answer is a row without video and with confidence 0."""
    r = F.from_json(unfenced(F.col("response")), SCREEN, {"mode": "PERMISSIVE"})
    rows = stored.withColumn("r", r).withColumn("ok", F.coalesce(unfenced(F.col("response")).rlike(r"^\s*\{[\s\S]*\}\s*$"), F.lit(False)) & F.col("r").isNotNull())
    ternary = lambda c: F.when(F.lower(c).isin("yes", "no"), F.lower(c)).otherwise("UNKNOWN")
    left = lambda c, n: F.substring(c, 1, n)
    return rows.select(
        "sk", "chunk_id", "start_ms", (F.col("start_ms") + F.col("duration_ms")).alias("end_ms"), F.col("ok").alias("video_available"),
        F.coalesce(F.transform(F.slice("r.externalResourceLabels", 1, 10), lambda x: left(x, 80)), F.array().cast("array<string>")).alias("labels"),
        left(F.col("r.pastedTextExcerpt"), 300).alias("excerpt"), left(F.col("r.visibleQuestionRef"), 120).alias("question_ref"),
        left(F.col("r.qualityCaveat"), 240).alias("caveat"), ternary(F.col("r.externalResourceVisible")).alias("external_resource"), ternary(F.col("r.aiAssistantUiVisible")).alias("ai_assistant"),
        F.when(F.col("ok"), share(F.col("r.confidence"))).otherwise(0.0).alias("confidence"),
    )


def balanced_object(text: Column) -> Column:
    """The first balanced object in a text (braces inside strings apart), by a fold over its characters.

    State: depth, inside a string, after a backslash, place of the opening brace, place of the closing one.
    """
    start = F.struct(F.lit(0).alias("d"), F.lit(False).alias("s"), F.lit(False).alias("x"), F.lit(0).alias("a"), F.lit(0).alias("b"))

    def step(acc: Column, c: Column) -> Column:
        ch, at = c["c"], c["i"]
        quote = (ch == '"') & ~acc["x"] & (acc["d"] > 0)
        opens, closes = (ch == "{") & ~acc["s"], (ch == "}") & ~acc["s"] & (acc["d"] > 0)
        depth = acc["d"] + opens.cast("int") - closes.cast("int")
        new = F.struct(
            depth.alias("d"), F.when(quote, ~acc["s"]).otherwise(acc["s"]).alias("s"), (acc["s"] & (ch == "\\") & ~acc["x"]).alias("x"),
            F.when((acc["a"] == 0) & opens, at).otherwise(acc["a"]).alias("a"), F.when(closes & (depth == 0), at).otherwise(F.lit(0)).alias("b"),
        )
        return F.when(acc["b"] > 0, acc).otherwise(new)

    chars = F.transform(F.split(text, ""), lambda c, i: F.struct(c.alias("c"), (i + 1).alias("i")))
    place = F.aggregate(chars, start, step)
    return F.when(place["b"] > 0, F.substring(text, place["a"], place["b"] - place["a"] + 1))


def adjudications(stored: DataFrame) -> DataFrame:
    """(sk, ord, signal fields) of stored answers: as they are, else their first balanced object, else with a brace added."""
    body = unfenced(F.col("response"))
    parse = lambda c: F.from_json(F.when(F.startswith(F.trim(c), F.lit("{")), c), ADJUDICATION, {"mode": "PERMISSIVE"})
    fit = lambda c: F.when(parse(c)["candidateSignals"].isNotNull() | parse(c)["episodeAnalysis"].isNotNull(), parse(c))
    rows = stored.withColumn("r", F.coalesce(fit(body), fit(balanced_object(body)), fit(F.concat(body, F.lit("}")))))
    signals = rows.select("sk", F.posexplode("r.candidateSignals").alias("ord", "s"))
    confidence = F.coalesce(F.col("s.confidence").try_cast("double"), F.lit(0.5))
    some = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    return signals.select(
        "sk", "ord", F.coalesce("s.signalType", "s.signal_type").alias("signal_type"), F.coalesce("s.episodeRef", "s.episode_ref").alias("episode_ref"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence)).alias("confidence"), some(F.col("s.machineFactsCited")).alias("facts"),
        some(F.col("s.observationsCited")).alias("observations"), some(F.col("s.baselineMetricsCited")).alias("metrics"),
    )


def write_reports(reports: DataFrame, path: str) -> None:
    """JSON per session, nulls left out; the commit protocol makes the whole write atomic."""
    reports.write.mode("overwrite").option("ignoreNullFields", "true").json(path)
