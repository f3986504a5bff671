"""Recorded page events: chunk files to typed rows, and the facts that need no edit history."""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Raw tags and what they stand for (fixed values).
TAG_KINDS = {
    "USER_FACE_NOT_DETECTED_POPUP_APPEARED": "FACE_NOT_VISIBLE_WARNING", "USER_FACE_NOT_DETECTED": "FACE_NOT_VISIBLE_WARNING", "FACE_NOT_DETECTED": "FACE_NOT_VISIBLE_WARNING",
    "FACE_DETECTION_WARNING": "FACE_NOT_VISIBLE_WARNING", "USER_FACE_WARNING_DISMISSED": "FACE_WARNING_DISMISSED", "FACE_WARNING_DISMISSED": "FACE_WARNING_DISMISSED",
    "CAMERA_BLOCKED": "CAMERA_BLOCKED", "CAMERA_DISABLED": "CAMERA_BLOCKED", "USER_MOVED_OUT_OF_EXAM_WINDOW": "WINDOW_BLUR", "WINDOW_BLUR": "WINDOW_BLUR",
    "TAB_VISIBILITY_HIDDEN": "TAB_SWITCH", "TAB_SWITCH": "TAB_SWITCH", "WINDOW_FOCUS": "WINDOW_FOCUS", "TAB_VISIBILITY_VISIBLE": "WINDOW_FOCUS",
    "USER_EXITED_FULLSCREEN_MODE": "FULLSCREEN_EXIT", "FULLSCREEN_EXIT": "FULLSCREEN_EXIT", "FULLSCREEN_EXITED": "FULLSCREEN_EXIT", "COPY": "COPY", "PASTE": "PASTE",
    "MIC_DISABLED": "MIC_DISABLED", "MICROPHONE_DISABLED": "MIC_DISABLED", "SECOND_MONITOR_DETECTED": "SECOND_MONITOR_DETECTED",
    "NOISE_DETECTED_DURING_EXAM": "NOISE_DETECTED", "NOISE_DETECTED": "NOISE_DETECTED",
}

EVENT = (
    "type int, timestamp bigint, data struct<source int, id int, text string, isChecked boolean, type int, tag string, "
    "payload struct<data struct<data string, message string, image string>>, texts array<struct<id int, value string>>>"
)


def unpacked(raw: bytes) -> list[dict] | None:
    """Events of a chunk, gzip or plain; zlib elements are inflated, broken ones skipped; null if it is no event list."""
    try:
        body = json.loads(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)
    except (ValueError, OSError, EOFError, zlib.error):
        return None
    items = body.get("events") if isinstance(body, dict) else body
    if not isinstance(items, list):
        return None
    out = []
    for x in items:
        if isinstance(x, str):
            data = x.encode("latin-1", "ignore")
            if data[:1] != b"\x78" or data[1:2] not in (b"\x01", b"\x5e", b"\x9c", b"\xda"):
                continue
            try:
                x = json.loads(zlib.decompress(data))
            except (ValueError, zlib.error):
                continue
        if isinstance(x, dict):
            out.append(x)
    return out


def node_texts(node) -> list[str]:
    """Texts below a DOM node, depth first, without recursion limits."""
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            if x.get("type") == 3 and isinstance(x.get("textContent"), str) and x["textContent"].strip():
                out.append(x["textContent"].strip())
            stack.extend(reversed(x.get("childNodes") or []))
    return out


def decode(files: DataFrame) -> DataFrame:
    """Rows of the binary file source to (path, pos, event as JSON, added texts); a file that is no event list gives pos -1."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                events = unpacked(raw.as_py() or b"")
                rows = [(-1, None, [])] if events is None else [
                    (i, json.dumps(e), [t for a in (e.get("data") or {}).get("adds") or [] for t in node_texts(a.get("node"))] if isinstance(e.get("data"), dict) else []) for i, e in enumerate(events)
                ]
                arrays = [pa.array([path] * len(rows)), *[pa.array([r[i] for r in rows], type=t) for i, t in ((0, pa.int32()), (1, pa.string()), (2, pa.list_(pa.string())))]]
                yield pa.RecordBatch.from_arrays(arrays, names=["path", "pos", "event", "added"])

    rows = files.select("path", "content").mapInArrow(task, "path string, pos int, event string, added array<string>")
    return rows.withColumn("e", F.from_json("event", EVENT)).select("path", "pos", "added", "e.*")


def scan(spark: SparkSession, folder: str) -> DataFrame:
    return decode(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder))


def kind_of(tag):
    table = F.create_map(*[F.lit(x) for kv in TAG_KINDS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, tag), F.lit("UNKNOWN"))


def custom_facts(events: DataFrame) -> DataFrame:
    """Custom events by their tag, nested or plain, with the message."""
    tag = F.coalesce(F.nullif(F.col("data.payload.data.data"), F.lit("")), F.col("data.tag"))
    return events.filter("type = 5").select("path", "pos", F.col("timestamp").alias("t_ms"), kind_of(tag).alias("kind"), F.col("data.payload.data.message").alias("message"))


def right_clicks(events: DataFrame) -> DataFrame:
    return events.filter("type = 3 and data.source = 2 and data.type = 3").select("path", "pos", F.col("timestamp").alias("t_ms"), F.lit("RIGHT_CLICK").alias("kind"))
