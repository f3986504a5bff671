"""MinHash near-deduplication with tensored tables, verified on full shingle sets.

A table's key is a pair of smaller hashes, one from each of two collections of m: m * m tables come from 2 * m minimum-hash
bands, where plain banding hashes every table's rows anew, so that the minhash work is about the square root of it.  Two
texts that agree in a band of either collection meet in a table; ``choose_collections`` takes m for the recall wanted at the threshold.

Equal texts, known by two 64-bit hashes, are one node.  Nodes that meet in a table and whose minimum hashes and sizes allow a
link form candidate groups.  Each group is verified on whole sets, first every node with the group's least node: where all are
linked with it, as in a large group of near copies, the group is done in linear time.  The nodes that are not (open ones) are
intersected with all others of their group, in tasks of two blocks.  Links become components.

Defined results: words are runs without blanks, A to Z count as small; a text with fewer than five words is one shingle; a null, empty or
blank text has no shingles, links with nothing, not even its like, and is kept; documents with equal shingle sets are linked;
an id may be null or repeated, each row is a document by itself; a component's id is the least of its ids, null if
all are null, and a row without id is kept only then; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencelake.llm.common import stash
from evidencelake.llm.graph import components
from evidencelake.llm.ngram_join import FINER, Bands, WordHashes, block_pairs, groups, keyed, ngrams, verified

N, THRESHOLD, RECALL, MAX_TABLES = 5, 0.85, 0.9995, 81


def choose_collections(threshold: float, recall: float, most: int, rows: int = FINER) -> int:
    """m, the bands of ``rows`` hashes in each collection: the chance that a pair at the threshold agrees in a band of both is ``recall``."""
    m = 1
    while (1 - (1 - threshold**rows) ** m) ** 2 < recall:
        m += 1
    if m * m > most:
        raise ValueError(f"{m * m} tables for a recall of {recall} at {threshold}; at most {most} are wanted")
    return m


def shingles(hashes: WordHashes, text: bytes, n: int) -> np.ndarray:
    return np.unique(ngrams(hashes.of(text.lower()), n))


def signatures(docs: DataFrame, text: str, ident: str, n: int, m: int) -> DataFrame:
    """id, two hashes of the text, size of its set, the 2 * m band hashes and the low 16 bits of all minimum hashes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, banded = WordHashes(), Bands(2 * m, FINER)
        for batch in batches:
            sizes, found, low = [], [], []
            for v in batch.column(3):
                grams = shingles(hashes, v.as_py(), n)
                least = banded.least(grams)
                sizes.append(len(grams))
                found.append(banded.of(least) if len(grams) else [])
                low.append(least.astype(np.uint16).tobytes() if len(grams) else b"")
            arrays = [pa.array(sizes, type=pa.int64()), pa.array(found, type=pa.list_(pa.int64())), pa.array(low, type=pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names=["id", "t1", "t2", "size", "halves", "low"])

    return keyed(docs, text, ident).mapInArrow(task, "id bigint, t1 bigint, t2 bigint, size bigint, halves array<bigint>, low binary")


def table_keys(m: int) -> Column:
    """The m * m pairs of a band of the first collection and one of the second, the second's running faster."""
    first, second = F.slice("halves", 1, m), F.slice("halves", m + 1, m)
    return F.flatten(F.transform(first, lambda a: F.transform(second, lambda b: F.xxhash64(a, b))))


def made_of(m: int):
    """Whether the g-th band is one of the pair at a position of ``table_keys``."""
    return lambda pos, g: (F.floor(pos / m) == g) if g < m else (pos % m == g - m)


def hub_links(sets: DataFrame, threshold: float) -> DataFrame:
    """(node, grp, linked) of all nodes but their groups' least, which each is intersected with."""
    hubs = sets.filter("node = grp").select(F.col("grp").alias("hub"), F.col("grams").alias("hub_grams"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                one, two = (np.frombuffer(x.as_py(), dtype=np.uint64) for x in (a, b))
                common = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(common >= threshold * (len(one) + len(two) - common) - 1e-6)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(linked, type=pa.bool_())], names=["node", "grp", "linked"])

    met = sets.filter("node != grp").hint("merge").join(hubs, F.col("grp") == F.col("hub")).select("node", "grp", "grams", "hub_grams")
    return met.mapInArrow(task, "node bigint, grp bigint, linked boolean")


def near_dedup(docs: DataFrame, text: str = "text", ident: str = "doc_id", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row: ident, n_shingles, component_id and kept."""
    m = choose_collections(threshold, recall, MAX_TABLES)
    signed = stash(signatures(docs, text, ident, n, m), "signatures")
    nodes = signed.filter("size > 0").groupBy("t1", "t2").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("halves").alias("halves"), F.first("low").alias("low")
    )
    nodes = stash(nodes.withColumn("node", F.monotonically_increasing_id()), "distinct-texts")
    grouped = groups(nodes.withColumn("bands", table_keys(m)), threshold, 2 * m * FINER, made_of(m))
    members = grouped.withColumnRenamed("root", "grp").join(nodes.select("node", "size", "least", "t1", "t2"), "node")
    members = stash(members, "members")
    sets = stash(full_sets(docs, members, text, ident, n), "member-sets")
    star = stash(hub_links(sets.select("node", "grp", "grams"), threshold), "hub-links")
    # groups with an open node: it meets all others of its group but the hub
    loose = stash(star.filter("not linked").select("grp").distinct(), "loose-groups")
    rest = members.select("node", "grp", "size").join(loose, "grp").join(star.select("node", "linked"), "node").select("node", "grp", "size", (~F.col("linked")).alias("open"))
    pairs = block_pairs(rest, threshold).join(sets.select("node", "grams"), "node").withColumn("copies", F.lit(1).cast("long"))
    met = verified(pairs.select("grp", "lo", "hi", "node", "blk", "copies", "grams"), threshold)
    edges = star.filter("linked").select(F.col("node").alias("a"), F.col("grp").alias("b")).unionByName(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = components(edges, "components")
    classes = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct()).join(nodes.select("node", "least", "t1", "t2"), "node")
    heads = stash(classes.groupBy("root").agg(F.min("least").alias("component")), "component-ids")
    of_text = classes.join(heads, "root").select("node", "component")
    per_text = nodes.select("node", "t1", "t2", "least", "copies").join(of_text, "node", "left").filter("copies > 1 or component is not null")
    per_text = stash(per_text.select(F.col("t1").alias("n1"), F.col("t2").alias("n2"), F.coalesce("component", "least").alias("component")), "components-of-texts")
    out = signed.select("id", "t1", "t2", "size").join(per_text, (F.col("t1") == F.col("n1")) & (F.col("t2") == F.col("n2")), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(ident), F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def full_sets(docs: DataFrame, members: DataFrame, text: str, ident: str, n: int) -> DataFrame:
    """(node, grp, grams: sorted 64-bit shingle hashes) of the members, from the text of the row with a node's least id."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingles(hashes, v.as_py(), n).tobytes() for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, type=pa.binary())], names=["node", "grp", "grams"])

    texts = keyed(docs, text, ident).withColumnsRenamed({"t1": "d1", "t2": "d2", "id": "d"})
    chosen = texts.hint("merge").join(members, (F.col("d1") == F.col("t1")) & (F.col("d2") == F.col("t2"))).filter(F.col("d").eqNullSafe(F.col("least")))
    # rows that are equal in id and text give a node's set more than once
    return chosen.select("node", "grp", "t").mapInArrow(task, "node bigint, grp bigint, grams binary").dropDuplicates(["node"])
