"""Sharding by histogram sort: near-equal bytes per shard with one exchange of the rows.

Rows get a 63-bit key: 39 bits of the text's hash, then 24 bits of the id's hash, so equal texts lie side by side.
Splitters are found by rounds: each round counts the exact bytes below 4096 candidate boundaries inside every open
interval, over all partitions, and keeps for each splitter the one interval that holds its target.  A splitter is
settled as soon as a candidate meets the tolerance, so a group of equal texts is cut only if the tolerance asks
for it (the last rounds can cut inside a group, by id).  Only counters reach the driver, at most
(shards - 1) * 4096 a round.

Defined results: a null text has size 1 (no bytes plus one) and CRC 0; rows equal in id and text cannot be told
apart and stay in one shard; slots are dense from 0 in key order; an empty table gives an empty result; columns
named like an output of the operator are replaced, others pass through.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.llm.common import free_name, nested_position, stash

KEY_BITS, ID_BITS, STEP = 63, 24, 12


def shard_key(text: Column, ident: Column) -> Column:
    high = F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 25), ID_BITS)
    return high.bitwiseOR(F.shiftrightunsigned(F.xxhash64(ident, F.coalesce(text, F.lit(""))), 64 - ID_BITS))


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[int]:
    """Key boundaries between shards; ``keys`` has ``key`` and ``size``."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    targets = [total * j // shards for j in range(1, shards)]
    allowed = tolerance * total / shards
    found: dict[int, int] = {}
    #: for each open target: the interval's first key and the exact bytes below it
    open_at = dict.fromkeys(range(len(targets)), (0, 0))
    shift = KEY_BITS
    while open_at and shift:
        outer, shift = shift, max(0, shift - STEP)
        cells = sorted({lo >> outer for lo, _ in open_at.values()})
        inside = keys if outer == KEY_BITS else keys.filter(F.shiftright("key", outer).isin(cells))
        counted = inside.groupBy(F.shiftright("key", shift).alias("cell")).agg(F.sum("size").alias("size")).collect()
        sizes = sorted((r["cell"], r["size"]) for r in counted)
        for j, (lo, below) in list(open_at.items()):
            own = [(c, s) for c, s in sizes if c << shift >> outer == lo >> outer]
            ends = [below, *accumulate((s for _, s in own), initial=below)][1:]
            at = min(max(bisect_right(ends, targets[j]) - 1, 0), len(own) - 1)
            candidates = [(abs(ends[at] - targets[j]), own[at][0] << shift), (abs(ends[at + 1] - targets[j]), (own[at][0] + 1) << shift)]
            error, boundary = min(candidates)
            if error <= allowed or not shift:
                found[j] = boundary
                del open_at[j]
            else:
                open_at[j] = (own[at][0] << shift, ends[at])
    return [min(found[j], (1 << KEY_BITS) - 1) for j in sorted(found)]


def shard(
    df: DataFrame, shards: int = 8, tolerance: float = 0.001, text: str = "text", ident: str = "doc_id"
) -> DataFrame:
    """``df`` plus ``size``, ``shard`` (0 to ``shards`` - 1) and ``slot`` (dense from 0 in each shard)."""
    df = df.drop("size", "shard", "slot")
    key = free_name(df, "shard_key")
    keyed = df.withColumn("size", byte_size(F.col(text))).withColumn(key, shard_key(F.col(text), F.col(ident)))
    keys = stash(keyed.select(F.col(key).alias("key"), "size"), "shard-keys")
    bounds = splitters(keys, shards, tolerance) if keys.take(1) else []
    rows = keys.count()
    cell = F.shiftright("key", KEY_BITS - STEP)
    per_cell = keys.groupBy(cell.alias("cell")).count()
    heavy = [r["cell"] for r in per_cell.filter(F.col("count") > max(1, rows // 256)).collect()]  # 256 at most

    def place(k: Column) -> list[Column]:
        at = F.shiftright(k, KEY_BITS - STEP)
        spread = F.shiftright(k, ID_BITS - 8).bitwiseAND(255)
        return [
            nested_position(k, bounds).cast("int").alias("shard"),
            at.alias("cell"),
            (F.when(at.isin(heavy), spread).otherwise(0) if heavy else F.lit(0)).alias("part"),
        ]

    names = ["shard", "cell", "part"]
    before = Window.partitionBy("shard").orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each cell, split cell and shard: at most 2 ** STEP + 256 * 256 + shards
    counts = keys.select(*place(F.col("key"))).groupBy(*names).count()
    starts = counts.select(
        *[F.col(n).alias(f"at_{n}") for n in names], F.coalesce(F.sum("count").over(before), F.lit(0)).alias("at_start")
    )
    spot = free_name(df, "spot")
    placed = keyed.withColumn(spot, F.struct(*place(F.col(key))))
    joined = placed.join(
        F.broadcast(starts),
        (placed[f"{spot}.shard"] == F.col("at_shard"))
        & (placed[f"{spot}.cell"] == F.col("at_cell"))
        & (placed[f"{spot}.part"] == F.col("at_part")),
    )
    w = Window.partitionBy(*[f"at_{n}" for n in names]).orderBy(key, ident)
    return (
        joined.withColumn("slot", (F.col("at_start") + F.row_number().over(w) - 1).cast("long"))
        .withColumn("shard", F.col("at_shard"))
        .drop(key, spot, "at_start", *[f"at_{n}" for n in names])
    )


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write one folder a shard, rows in slot order inside each file."""
    placed = shard(df, **options)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_report(docs: DataFrame) -> DataFrame:
    """The query's result under law ``bytes``."""
    rows = docs.select("doc_id", "text").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return shard(rows, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
