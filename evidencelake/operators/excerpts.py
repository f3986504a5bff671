"""Where short excerpts occur in long texts, by keys that both share instead of comparing every excerpt with every text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Grams of 10 characters; a window of 20 characters holds 11 of them and is keyed by the least of their hashes.
GRAM, WINDOW = 10, 20
#: Long texts are cut into blocks of this many characters, each followed by the next block's first ``OVERHANG``.
BLOCK, OVERHANG = 1024, 600
#: Characters hashed at a time.
FLUSH = 1_000_000


def window_keys(text: str):
    """(hashes of the grams, least hash of every window) of a text of at least ``WINDOW`` characters, as numpy arrays."""
    import numpy as np

    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    h = np.zeros(len(c) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + c[j : j + len(h)]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h, over_eleven(np.minimum, h)


def over_eleven(pick, h):
    two = pick(h[:-1], h[1:])
    four = pick(two[:-2], two[2:])
    eight = pick(four[:-4], four[4:])
    return pick(eight[:-3], eight[3:])


def keyed_places(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep``, key and place: every gram of column ``t`` that is the least of a window, with where it begins (from 0).

    Equal windows have equal least grams at equal distances, so two texts that share a window share a key, whatever stands around it.
    Texts under 20 characters (and null ones) have no window and give no row.
    """

    def task(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            stops = np.cumsum([len(t) for t in texts])
            rows, keys, places, first = [], [], [], 0
            while first < len(texts):  # many texts at a time, as one
                begin = int(stops[first - 1]) if first else 0
                after = max(first + 1, int(np.searchsorted(stops, begin + FLUSH, side="right")))
                h, least = window_keys("".join(texts[first:after]))
                ends = stops[first:after] - begin
                of = np.searchsorted(ends, np.arange(len(h)), side="right")
                least[np.arange(len(least)) + WINDOW > ends[of[: len(least)]]] = 0  # windows that reach into the next text
                # a gram is the least of a window if the largest of its windows' least hashes is its own
                reached = over_eleven(np.maximum, np.concatenate([np.zeros(GRAM, np.uint64), least, np.zeros(GRAM, np.uint64)]))
                place = np.flatnonzero(reached == h)
                place = place[place + GRAM <= ends[of[place]]]
                rows.append(first + of[place])
                keys.append(h[place].view(np.int64))
                places.append((place - np.append(0, ends)[of[place]]).astype(np.int32))
                first = after
            if rows:
                kept = batch.select(list(keep)).take(pa.array(np.concatenate(rows)))
                columns = [*kept.columns, pa.array(np.concatenate(keys)), pa.array(np.concatenate(places))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "key", "place"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.filter(F.char_length("t") >= WINDOW).select(*keep, "t").mapInArrow(task, f"{kinds}, key bigint, place int")


def blocks_of(texts: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """keys, block (from 0), t: a text cut into blocks in one pass, each with the beginning of the next."""
    pieces = texts.select(*keys, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("p"))
    whole = F.transform("p", lambda piece, i: F.concat(piece, F.coalesce(F.substring(F.get("p", i + 1), 1, OVERHANG), F.lit(""))))
    return pieces.select(*keys, F.posexplode(whole).alias("block", "t")).withColumn("block", F.col("block").cast("bigint"))


def occurrences(needles: DataFrame, blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, e, block, t, place: every occurrence of ``needle`` in a block with equal keys.

    ``needles``: keys, e (what the needle stands for), needle (20 to ``OVERHANG`` characters; shorter ones are not looked up).
    ``blocks``: keys, block (bigint, a name of the block; blocks of one name are all looked at), t.
    """
    heads = keyed_places(needles.select(*keys, "e", "needle", F.substring("needle", 1, WINDOW).alias("t")), [*keys, "e", "needle"])
    heads = heads.withColumnRenamed("place", "ahead")
    found = keyed_places(blocks, [*keys, "block"]).join(heads, [*keys, "key"]).withColumn("place", F.col("place") - F.col("ahead"))
    found = found.filter("place >= 0").select(*keys, "block", "e", "needle", "place").distinct()
    same = F.substring(F.col("t"), F.col("place") + 1, F.char_length("needle")) == F.col("needle")
    return found.join(blocks, [*keys, "block"]).filter(same).select(*keys, "e", "block", "t", "place")
