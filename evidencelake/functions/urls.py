"""Scalar functions on recording URLs and clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IST_OFFSET_MS = 19_800_000


def path(url: Column) -> Column:
    """Path component, percent-decoded; a plus stays a plus."""
    raw = F.parse_url(url, F.lit("PATH"))
    return F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def kind(url: Column) -> Column:
    name = F.lower(path(url))
    return (
        F.when(name.rlike(r"__events\.json\.gz$"), "events_sidecar")
        .when(name.rlike(r"__metadata\.json\.gz$"), "metadata_sidecar")
        .when(name.rlike(r"/v3/.*\.webm$"), "screen_chunk")
        .when(name.rlike(r"__\d+\.json$"), "rrweb_chunk")
        .when(name.rlike(r"\d+\.json\.gz$"), "rrweb_gzip")
        .when(name.rlike(r"\.json$"), "rrweb_json")
        .when(name.rlike(r"\.webm$"), "camera_chunk")
        .otherwise("unknown")
    )


def duration_ms(url: Column) -> Column:
    found = F.regexp_extract(path(url), r"__(\d+)(?:__events|__metadata)?\.(?:webm|json(?:\.gz)?)$", 1)
    return F.nullif(found, F.lit("")).try_cast("bigint")


def chunk_id(prefix: Column, url: Column) -> Column:
    stem = F.regexp_replace(F.regexp_extract(path(url), r"([^/]*)$", 1), r"\.(webm|json|json\.gz)$", "")
    return F.concat_ws("-", prefix, F.when(stem != "", stem).otherwise(F.substring(F.sha2(url, 256), 1, 16)))


def chunk_clock(chunk: Column) -> Column:
    """(epoch_ms, duration_ms, start_ms) of "...-<13 digits>[__<duration>]...": the epoch is the end where a duration is given."""
    part = lambda i: F.nullif(F.regexp_extract(chunk, r"-(\d{13})(?:__(\d+))?", i), F.lit("")).try_cast("bigint")
    return F.struct(part(1).alias("epoch_ms"), part(2).alias("duration_ms"), (part(1) - F.coalesce(part(2), F.lit(0))).alias("start_ms"))


def chunk_section(chunk: Column) -> Column:
    return F.nullif(F.regexp_extract(chunk, r"^(video|keystrokeData|screenRecording)-([a-z_]+)-\d{13}", 2), F.lit(""))


def section_id(section_type: Column, title: Column, attempt: Column) -> Column:
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(F.lower(blank(section_type)), F.regexp_replace(F.lower(blank(title)), r"\s+", "-"), F.substring(attempt, 1, 8))


def epoch_ms(value: Column) -> Column:
    """Numbers as they are; ISO text with a zone as it says; naive text is five and a half hours ahead of UTC, whatever the session's zone."""
    number = F.when(value.rlike(r"^\d+(\.\d+)?$"), F.floor(value.try_cast("double")))
    zoned = value.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.coalesce(number, F.when(zoned, F.unix_millis(F.try_to_timestamp(value))).otherwise(naive_ms(value) - IST_OFFSET_MS)).cast("long")


def naive_ms(value: Column) -> Column:
    """Milliseconds of a text without a zone, read as UTC."""
    return F.unix_millis(F.try_to_timestamp(F.concat(F.trim(value), F.lit("Z"))))


def submission_ms(value: Column) -> Column:
    """As ``epoch_ms``; of a naive text the fraction of a second is dropped."""
    zoned = value.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return epoch_ms(F.when(zoned, value).otherwise(F.regexp_replace(value, r"(:\d{2})\.\d+$", "$1")))


def allowed_urls(urls: Column) -> Column:
    return F.coalesce((F.size(urls) >= 1) & F.forall(urls, lambda u: F.startswith(u, F.lit("https://"))), F.lit(False))
