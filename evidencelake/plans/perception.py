"""Camera events to observations: nine groups of fields that default to UNKNOWN, filled from attributes and from the event's kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Attribute names by group (fixed values); the field of a group is the attribute in snake case.
ATTRIBUTES = {
    "attention": (
        "gazeDirection", "gazeTarget", "gazeStable", "repeatedGazePattern", "attentionState",
    ),
    "identity": (
        "facePresent", "identityConsistent", "faceOccluded", "faceOrientation",
    ),
    "objects": (
        "phoneVisible", "notebookVisible", "paperVisible", "calculatorVisible", "headphonesVisible", "headphonesLink",
        "earphoneVisible", "earphoneLink", "secondScreenVisible", "unknownObjectVisible",
    ),
    "hands": (
        "handsVisible", "handCount", "handLocation", "handActivity", "objectInHand",
    ),
    "people": (
        "secondPersonVisible", "secondPersonInteracting", "candidateRespondingToSecondPerson", "secondPersonLooksLike",
        "secondPersonRoleCue", "secondPersonActivity", "secondPersonPosition", "secondPersonObjectInHand",
    ),
    "body": ("leftSeat",),
    "interaction": (
        "reachingOutsideFrame", "reachingDirection",
    ),
    "environment": (
        "settingType", "framing", "lightingCondition",
    ),
    "audio": (
        "speechPresent", "speechContentClass", "conversationSummaryEn", "speechSource", "speechOverlapWithLips",
        "speechLanguage", "speechStyle", "codeMixing", "backgroundVoices", "deviceSounds", "notablePhrasesOriginal",
    ),
}
#: What a kind of event implies where the attribute does not say (fixed values).
IMPLIED = {
    "facePresent": {"face_absent": "no"}, "leftSeat": {"leave_seat": "yes"}, "gazeDirection": {"sustained_gaze": "away"}, "speechPresent": {"speech": "yes"},
    "secondPersonVisible": {"second_person_present": "yes", "second_person_interaction": "yes"}, "secondPersonInteracting": {"second_person_interaction": "yes"},
    "phoneVisible": {"phone_visible": "yes", "phone_in_hand": "yes"}, "handsVisible": {"phone_in_hand": "yes"}, "objectInHand": {"phone_in_hand": "phone"},
    "handLocation": {"phone_in_hand": "phone"}, "headphonesVisible": {"headphones_visible": "yes"}, "earphoneVisible": {"earphone_visible": "yes"},
    "secondScreenVisible": {"second_screen_visible": "yes"}, "reachingOutsideFrame": {"reaching_outside_frame": "yes"},
}
FREE_TEXT = {"conversationSummaryEn", "notablePhrasesOriginal"}


def snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)


def given(name: str) -> Column:
    """The attribute's value, null where it is missing or UNKNOWN."""
    return F.nullif(F.try_element_at("attrs", F.lit(name)), F.lit("UNKNOWN"))


def leaf(name: str) -> Column:
    implied = [F.when(F.col("kind") == kind, F.lit(value)) for kind, value in IMPLIED.get(name, {}).items()]
    if name in ("handsVisible", "phoneVisible"):  # a phone in the hand shows both
        implied.insert(0, F.when(given("objectInHand") == "phone", F.lit("yes")))
    if name == "notebookVisible":
        implied.append(F.when((F.col("kind") == "notes_visible") & given("paperVisible").isNull(), F.lit("yes")))
    rest = [] if name in FREE_TEXT else [F.lit("UNKNOWN")]
    return F.coalesce(given(name), *implied, *rest) if implied or rest else given(name)


def groups() -> dict[str, Column]:
    return {g: F.struct(*[leaf(n).alias(snake(n)) for n in names]) for g, names in ATTRIBUTES.items()}


def unknown_groups() -> dict[str, Column]:
    """The same structs with nothing known."""
    blank = lambda n: F.lit(None).cast("string") if n in FREE_TEXT else F.lit("UNKNOWN")
    return {g: F.struct(*[blank(n).alias(snake(n)) for n in names]) for g, names in ATTRIBUTES.items()}


def observations(events: DataFrame, section: str | None = None) -> DataFrame:
    """One observation per event (sk, chunk_id, start_ms, end_ms, kind, attrs, confidence, tier)."""
    window = F.concat(F.lit("w_"), F.col("start_ms").cast("string"), F.lit("_"), F.col("end_ms").cast("string"))
    rows = events.withColumn("window_id", window).withColumn("video_available", F.lit(True))
    keep = ["sk", "chunk_id", "window_id", "start_ms", "end_ms", "confidence", "tier", "video_available", *([section] if section else [])]
    return rows.select(*keep, *[c.alias(g) for g, c in groups().items()])


def quiet_chunks(chunks: DataFrame) -> DataFrame:
    """A reviewed chunk without events is one available observation with nothing known."""
    window = F.concat(F.lit("w_"), F.col("start_ms").cast("string"), F.lit("_"), F.col("end_ms").cast("string"))
    return chunks.select(
        "sk", "chunk_id", window.alias("window_id"), "start_ms", "end_ms", F.lit(0.7).alias("confidence"), F.lit("MEDIUM").alias("tier"), F.lit(True).alias("video_available"),
        *[c.alias(g) for g, c in unknown_groups().items()],
    )


def session_times(obs: DataFrame, spans: DataFrame) -> DataFrame:
    """Observations that carry chunk-local times from 0 on a chunk that starts later move to the chunk's span."""
    rows = obs.join(spans.select("sk", "chunk_id", F.col("start_ms").alias("s0"), F.col("end_ms").alias("s1")), ["sk", "chunk_id"], "left")
    local = (F.col("start_ms") == 0) & (F.col("s0") > 0) & (F.col("end_ms") <= F.col("s1") - F.col("s0"))
    moved = {"start_ms": F.when(local, F.col("s0")).otherwise(F.col("start_ms")), "end_ms": F.when(local, F.col("s1")).otherwise(F.col("end_ms"))}
    return rows.withColumns(moved).drop("s0", "s1")
