"""Review requests: scan, validate, explode, number the recordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidencelake.functions import urls

SCHEMA = T.StructType([
    T.StructField("candidateId", T.StringType()),
    T.StructField("assessmentId", T.StringType()),
    T.StructField("cameraRecordings", T.ArrayType(T.StringType())),
    T.StructField("sessionRecordings", T.ArrayType(T.StringType())),
    T.StructField("activityTimeline", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("sections", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("examAttemptId", "examId", "sectionType", "title")]))),
    T.StructField("_corrupt", T.StringType()),
])


def scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per request file; unreadable ones keep their text in ``_corrupt``."""
    rows = spark.read.schema(SCHEMA).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.withColumn("sk", F.concat_ws("/", "assessmentId", "candidateId"))


def valid() -> Column:
    """Column: secure URLs, and at least one recording, log row and section."""
    some = lambda c: F.coalesce(F.size(c) >= 1, F.lit(False))
    safe = F.coalesce(F.forall("sessionRecordings", lambda u: F.startswith(u, F.lit("https://"))), F.lit(True))
    return F.col("_corrupt").isNull() & urls.allowed_urls(F.col("cameraRecordings")) & safe & some("activityTimeline") & some("sections")


def split(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined)."""
    marked = requests.withColumn("_ok", valid())
    return marked.filter("_ok").drop("_ok"), marked.filter("not _ok").drop("_ok")


def sections(requests: DataFrame) -> DataFrame:
    rows = requests.select("sk", F.posexplode("sections").alias("ord", "s"))
    return rows.select("sk", "ord", "s.*").withColumn("section_id", urls.section_id(F.col("sectionType"), F.col("title"), F.col("examAttemptId")))


def activity(requests: DataFrame) -> DataFrame:
    """Log rows of either spelling on one clock, in their own order."""
    rows = requests.select("sk", F.posexplode("activityTimeline").alias("pos", "m"))
    pick = lambda *names: F.coalesce(*[F.try_element_at("m", F.lit(n)) for n in names])
    return rows.select(
        "sk", pick("eventType", "activityTypeEnum", "activity_type_enum").alias("kind"), urls.epoch_ms(pick("timestamp", "creationDatetime", "creation_datetime")).alias("t_ms"),
        F.coalesce(pick("order").try_cast("int"), "pos").alias("ord"),
        F.coalesce(F.from_json(pick("metadata", "metadata_str"), "map<string,string>"), F.create_map().cast("map<string,string>")).alias("metadata"),
    )


def manifest(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunks, rejected sessions): every URL classified, numbered within its type, with duration, id and section.

    A session with an unknown URL, or with both screen chunks and edit logs, is rejected as a whole.
    """
    camera = requests.select("sk", F.posexplode("cameraRecordings").alias("pos", "url")).withColumn("prefix", F.lit("video"))
    session = requests.select("sk", F.posexplode_outer("sessionRecordings").alias("pos", "url")).filter("url is not null")
    kind = urls.kind(F.col("url"))
    screen = kind.isin("screen_chunk", "events_sidecar", "metadata_sidecar")
    session = session.withColumn("prefix", F.when(screen, "screenRecording").otherwise("keystrokeData"))
    rows = camera.unionByName(session).withColumn("kind", kind)
    mixed = rows.groupBy("sk").agg(
        F.bool_or(F.col("kind") == "unknown").alias("unknown"), F.bool_or(F.col("prefix") == "screenRecording").alias("screen"), F.bool_or(F.col("prefix") == "keystrokeData").alias("log")
    )
    bad = mixed.filter("unknown or (screen and log)").select("sk", F.when(F.col("unknown"), "unknown_url").otherwise("mixed_modes").alias("reason"))
    sidecar = F.when(F.col("kind").isin("events_sidecar", "metadata_sidecar"), F.regexp_replace("kind", "_sidecar", ""))
    rows = rows.join(bad, "sk", "left_anti").withColumn("sidecar_role", sidecar)
    w = Window.partitionBy("sk", "prefix").orderBy("pos")
    rows = rows.withColumn("sequence", F.row_number().over(w) - 1).withColumn("duration_ms", urls.duration_ms(F.col("url")))
    chunks = rows.withColumn("chunk_id", urls.chunk_id(F.col("prefix"), F.col("url")))
    return with_section(chunks, sections(requests)), bad


def with_section(chunks: DataFrame, section: DataFrame) -> DataFrame:
    """The first section whose attempt or exam id is a step of the URL's path, else the only section, else null."""
    parts = F.split(urls.path(F.col("url")), "/")
    ids = section.select("sk", F.col("ord").alias("s_ord"), "section_id", F.array("examAttemptId", "examId").alias("ids"))
    pairs = chunks.withColumn("parts", parts).join(ids, "sk", "left")
    hit = F.coalesce(F.arrays_overlap("parts", F.array_compact("ids")), F.lit(False))
    first = F.min_by("section_id", F.when(hit, F.col("s_ord")))
    only = F.when(F.count_distinct("s_ord") == 1, F.first("section_id"))
    chosen = pairs.groupBy("sk", "prefix", "sequence").agg(F.when(F.bool_or(hit), first).otherwise(only).alias("section_id"))
    return chunks.join(chosen, ["sk", "prefix", "sequence"], "left")
