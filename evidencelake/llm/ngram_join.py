"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

Texts become sets of hashed n-grams of words (five by default).  The numbers of bands and rows are chosen for a target
recall at the threshold.  Equal texts, known by two 64-bit hashes, are one node, whatever their ids.  Nodes that share a band
hash meet in its bucket, where pairs whose sizes or whose minimum hashes rule out the threshold are passed over; each node sends one edge to the least
node it may be linked with, and connected components of these edges are the groups inside which all links must lie.
A bucket of more than ``BUCKET`` nodes, such as a template line makes, is split first by triples of the other minimum hashes, which
all linked pairs but one in a thousand million share; what is still as large then is a group of near copies.  Each group meets in tasks of at most two blocks of about ``BLOCK`` nodes,
cut by the sets' sizes, where all n-gram sets are intersected exactly as one sparse matrix product.  Tasks emit per node
its number of links and one edge to the least node it is linked with, not pairs, so the result is linear in the nodes
while no link is lost.

Defined results: a null text counts as empty; a text without words has no n-grams and no links, even to its like; a text
with fewer words than n is one n-gram; documents with equal texts are linked; an id may be null or repeated, each row is a
document by itself; the id of a class or text is the least of its ids, null if all are null; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencelake.llm.common import free_name, stash
from evidencelake.llm.graph import components
from evidencelake.llm.groups import runs_of

N, THRESHOLD, RECALL, MAX_HASHES, SEED = 5, 0.8, 0.9995, 128, 5
#: Nodes in a block; a task of the verification holds the sets of two blocks at most.
BLOCK = 256
#: Nodes in a bucket whose minimum hashes are compared by one task; a larger bucket is split by further hashes.
BUCKET = 1024
#: Minimum hashes in each further key.
FINER = 3
NO_ID = -(1 << 63)


def choose_bands(threshold: float, recall: float, most: int) -> tuple[int, int]:
    """(bands, rows): the longest rows for which the bands needed for ``recall`` at ``threshold`` stay within ``most`` hashes."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


class WordHashes(dict):
    """64-bit hashes of words, remembered in bounded number."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out

    def of(self, text: bytes) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows in order; of all words at once if they are fewer."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = mixed(out) + words[k : k + len(out)]
    return mixed(out)


class Bands:
    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        self.mult = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def least(self, grams: np.ndarray) -> np.ndarray:
        """The least value of each hash function."""
        least = np.full(len(self.mult), np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(grams), 4096):
            part = grams[at : at + 4096, None] * self.mult + self.add
            least = np.minimum(least, (part ^ (part >> np.uint64(33))).min(axis=0))
        return least

    def of(self, least: np.ndarray) -> list[int]:
        rows = least.reshape(self.bands, self.rows)
        out = np.arange(self.bands, dtype=np.uint64)
        for k in range(self.rows):
            out = mixed(out) + rows[:, k]
        return mixed(out).view(np.int64).tolist()


def signatures(docs: DataFrame, text: str, ident: str, n: int, bands: int, rows: int) -> DataFrame:
    """id, two hashes of the text, number of n-grams, band hashes and the low 16 bits of all hashes, for every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, banded = WordHashes(), Bands(bands, rows)
        for batch in batches:
            sizes, found, low = [], [], []
            for v in batch.column(3):
                grams = np.unique(ngrams(hashes.of(v.as_py()), n))
                least = banded.least(grams)
                sizes.append(len(grams))
                found.append(banded.of(least) if len(grams) else [])
                low.append(least.astype(np.uint16).tobytes() if len(grams) else b"")
            arrays = [pa.array(sizes, type=pa.int32()), pa.array(found, type=pa.list_(pa.int64())), pa.array(low, type=pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names=["id", "t1", "t2", "size", "bands", "low"])

    return keyed(docs, text, ident).mapInArrow(task, "id bigint, t1 bigint, t2 bigint, size int, bands array<bigint>, low binary")


def text_keys(text: str) -> list[Column]:
    """The two hashes by which texts are told apart."""
    t = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2")]


def keyed(docs: DataFrame, text: str, ident: str) -> DataFrame:
    return docs.select(F.col(ident).cast("long").alias("id"), *text_keys(text), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))


def least_agreement(hashes: int, threshold: float, risk: float = 1e-6) -> int:
    """The number of equal hashes that two sets with this similarity miss with no more than the chance ``risk``."""
    below, k = 0.0, 0
    while (below := below + math.comb(hashes, k) * threshold**k * (1 - threshold) ** (hashes - k)) <= risk:
        k += 1
    return k


def close_edges(rows: DataFrame, threshold: float, hashes: int) -> DataFrame:
    """(a, b) from each node of a bucket to the least node it may be linked with; ``rows`` has band, node, size, low.

    Nodes of a bucket may be linked if their sizes and their hashes allow it.  That keeps texts which only share a band by
    chance, or a template, from growing into one group.
    """
    least = least_agreement(hashes, threshold)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs_of(batches, 1):
            node, size = run.column(1).to_numpy(), run.column(2).to_numpy()
            low = np.frombuffer(b"".join(run.column(3).to_pylist()), np.uint16).reshape(len(node), -1)
            linked = np.zeros((len(node), len(node)), bool)
            for i in range(0, len(node), 64):
                part = slice(i, i + 64)
                linked[part] = (low[part, None, :] == low[None, :, :]).sum(axis=2) >= least
                linked[part] &= np.minimum(size[part, None], size[None, :]) >= threshold * np.maximum(size[part, None], size[None, :]) - 1e-6
            label = least_labels(linked, node)
            moved = label != node
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(label[moved])], names=["a", "b"])

    return rows.repartition("band").sortWithinPartitions("band").mapInArrow(task, "a bigint, b bigint")


def least_labels(linked: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The least node that each node reaches over links."""
    order = np.argsort(node)
    linked = linked[order][:, order]
    label = np.arange(len(node))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(node)).min(axis=1, initial=len(node)))
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.empty_like(node)
    out[order] = node[order][label]
    return out


def rows_of_band(rows: int) -> Callable[[Column, int], Column]:
    """Whether the g-th run of ``FINER`` hashes holds hashes of the band at a position."""
    return lambda pos, g: (F.lit(FINER * (g + 1)) > pos * rows) & (F.lit(FINER * g) < (pos + 1) * rows)


def buckets(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (node, band) of the bands with two nodes or more, plus their least node (hub) and number (n)."""
    hubs = rows.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top"), F.count("*").alias("n")).filter("hub != top")
    return stash(rows.join(hubs.select("band", "hub", "n"), "band"), name)


def compared(shared: DataFrame, nodes: DataFrame, threshold: float, hashes: int) -> DataFrame:
    """Edges inside the buckets that one task compares."""
    small = shared.filter(F.col("n") <= BUCKET).select("node", "band").join(nodes.select("node", "size", "low"), "node")
    return close_edges(small.select("band", "node", "size", "low"), threshold, hashes)


def groups(nodes: DataFrame, threshold: float, hashes: int, holds: Callable[[Column, int], Column]) -> DataFrame:
    """(node, root) of the candidate groups with two nodes or more; ``nodes`` has node, size, bands, low.

    ``holds`` tells which runs of ``FINER`` hashes a band's key is made of: these split its bucket no further.
    """
    shared = buckets(nodes.select("node", F.explode("bands").alias("band")), "shared-bands")
    hot = shared.filter(F.col("n") > BUCKET).select("node", "band").join(nodes.select("node", "bands", "low"), "node")
    pos = F.array_position("bands", F.col("band")) - 1
    key = lambda g: F.xxhash64("band", F.lit(g), F.substring("low", 2 * FINER * g + 1, 2 * FINER))
    finer = F.array(*[F.when(~holds(pos, g), key(g)) for g in range(hashes // FINER)])
    split = buckets(hot.select("node", F.explode(F.array_compact(finer)).alias("band")), "split-bands")
    dense = split.filter(F.col("n") > BUCKET).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    edges = compared(shared, nodes, threshold, hashes).unionByName(compared(split, nodes, threshold, hashes)).unionByName(dense)
    found = components(edges, "candidate-groups")
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def verified(sets: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) per node and pair of blocks; ``sets`` has grp, lo, hi, node, blk, copies, grams."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs_of(batches, 3):
            lo, hi = run.column(1)[0].as_py(), run.column(2)[0].as_py()
            node, first = np.unique(run.column(3).to_numpy(), return_index=True)
            grams = [np.frombuffer(run.column(6)[i].as_py(), dtype=np.uint64) for i in first.tolist()]
            copies, block = run.column(5).to_numpy()[first], run.column(4).to_numpy()[first]
            linked = links_of(grams, threshold)
            if lo != hi:
                linked &= block[:, None] != block[None, :]
            else:
                np.fill_diagonal(linked, False)
            arrays = [pa.array(node), pa.array(linked.astype(np.int64) @ copies), pa.array(least_labels(linked, node))]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "links", "root"])

    spread = sets.repartition("grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi")
    return spread.mapInArrow(task, "node bigint, links bigint, root bigint")


def links_of(grams: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets have Jaccard similarity ``threshold`` or more, exactly."""
    sizes = np.array([len(g) for g in grams])
    every, inverse, seen = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(grams)), sizes)
    shared = seen[inverse] > 1
    column = np.cumsum(seen > 1)[inverse][shared] - 1
    owner = owner[shared]
    common = np.zeros((len(grams), len(grams)), dtype=np.float32)
    width = 4096
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (at, at + width))
        part = np.zeros((len(grams), width), dtype=np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    return (common >= threshold * union - 1e-6) & (common > 0)


def block_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """``members`` (node, grp, size, ...) once for each pair of blocks they have to meet in: plus lo, hi and blk.

    A group of more than ``BLOCK`` nodes is cut by size class, each class into blocks of about ``BLOCK`` nodes.  Sizes of
    linked texts differ by less than one step between classes, so a block meets its own class and the two beside it.  Where
    ``members`` has a column open, two nodes meet only if one of them is open.
    """
    if "open" not in members.columns:
        members = members.withColumn("open", F.lit(True))
    # what is joined to the members is written first: small tables are broadcast by their size, and a hot group's members are split otherwise
    total = stash(members.groupBy("grp").agg(F.count("*").alias("total")), "group-sizes")
    step = F.floor(F.log(F.col("size")) / F.lit(-math.log(threshold))).cast("int") if threshold < 1 else F.col("size")
    rows = members.join(total, "grp").withColumn("cls", F.when(F.col("total") > BLOCK, step).otherwise(F.lit(0)))
    cells = rows.groupBy("grp", "cls", "open").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    beside = cells.select("grp", "blocks", F.struct("cls", "open").alias("other"), F.explode(F.sequence(F.col("cls") - 1, F.col("cls") + 1)).alias("cls"))
    own = cells.withColumnRenamed("blocks", "own_blocks").join(beside, ["grp", "cls"]).filter(F.col("open") | F.col("other.open")).groupBy("grp", "cls", "open", "own_blocks")
    met = rows.join(stash(own.agg(F.collect_list(F.struct("other", "blocks")).alias("near")), "group-blocks"), ["grp", "cls", "open"])
    code = lambda cls, is_open, blk: (F.shiftleft(2 * cls.cast("long") + is_open.cast("long"), 32) + blk).cast("long")
    blk = F.pmod(F.xxhash64("node"), F.col("own_blocks").cast("long"))
    others = F.flatten(F.transform("near", lambda c: F.transform(F.sequence(F.lit(0), c["blocks"] - 1), lambda b: code(c["other"]["cls"], c["other"]["open"], b))))
    spread = met.withColumn("blk", code(F.col("cls"), F.col("open"), blk)).withColumn("with", F.explode(others))
    return spread.withColumn("lo", F.least("blk", "with")).withColumn("hi", F.greatest("blk", "with")).drop("total", "cls", "open", "own_blocks", "near", "with")


def classified(
    docs: DataFrame, text: str = "text", ident: str = "doc_id", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """Per row: id, t1, t2 (its text's hashes), class_id, rep_id, n_links and first.

    ``first`` marks the one text and id of each class that comes first: by id, null last, then by the text's hashes.  Rows
    that are equal in both are all marked.
    """
    bands, rows = choose_bands(threshold, recall, MAX_HASHES)
    signed = stash(signatures(docs, text, ident, n, bands, rows), "signatures")
    nodes = signed.filter("size > 0").groupBy("t1", "t2").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("low").alias("low")
    )
    nodes = stash(nodes.withColumn("node", F.monotonically_increasing_id()), "distinct-texts")
    grouped = groups(nodes, threshold, bands * rows, rows_of_band(rows))
    members = grouped.withColumnRenamed("root", "grp").join(nodes.select("node", "copies", "size", "least", "t1", "t2"), "node")
    members = stash(members, "members")

    def set_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, done = WordHashes(), set()
        for batch in batches:
            keep, found = [], []
            for i, (node, v) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                if node not in done:  # rows that are equal in id and text
                    if len(done) > 10_000:
                        done.clear()
                    done.add(node)
                    keep.append(i)
                    found.append(np.unique(ngrams(hashes.of(v.as_py()), n)).tobytes())
            arrays = [batch.column(0).take(pa.array(keep, type=pa.int64())), pa.array(found, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "grams"])

    # of the rows with a text, the one with the least id is looked up
    texts = keyed(docs, text, ident).withColumnsRenamed({"t1": "d1", "t2": "d2", "id": "d"})
    chosen = texts.hint("merge").join(members, (F.col("d1") == F.col("t1")) & (F.col("d2") == F.col("t2"))).filter(F.col("d").eqNullSafe(F.col("least")))
    sets = chosen.select("node", "t").mapInArrow(set_task, "node bigint, grams binary")
    pairs = block_pairs(members.select("node", "grp", "size", "copies"), threshold).join(sets, "node")
    found = stash(verified(pairs.select("grp", "lo", "hi", "node", "blk", "copies", "grams"), threshold), "verified-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "classes")
    classes = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct()).join(nodes.select("node", "least", "t1", "t2"), "node")
    order = F.struct(F.isnull("least").alias("no_id"), "least", "t1", "t2")
    heads = classes.groupBy("root").agg(F.min(order).alias("head"))
    of_node = classes.select("node", "root").join(stash(heads, "class-heads"), "root").select("node", "head")
    per_text = nodes.join(links, "node", "left").join(of_node, "node", "left").filter("copies > 1 or head is not null")
    head = F.coalesce("head", order)
    per_text = per_text.select(
        F.col("t1").alias("n1"), F.col("t2").alias("n2"), F.col("least").alias("rep_id"), head["least"].alias("class_id"),
        ((head["t1"] == F.col("t1")) & (head["t2"] == F.col("t2"))).alias("leads"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    out = signed.select("id", "t1", "t2").join(stash(per_text, "classes-of-texts"), (F.col("t1") == F.col("n1")) & (F.col("t2") == F.col("n2")), "left")
    alone = F.col("n1").isNull()
    return out.select(
        "id", "t1", "t2",
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("id")).otherwise(F.col("rep_id")).alias("rep_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("leads") & F.col("id").eqNullSafe(F.col("rep_id")))).alias("first"),
    )


def near_duplicates(
    docs: DataFrame, text: str = "text", ident: str = "doc_id", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """Per row: ident, class_id (least id of its class), rep_id (least id with this text) and n_links (other documents linked to it)."""
    return classified(docs, text, ident, n, threshold, recall).select(F.col("id").alias(ident), "class_id", "rep_id", "n_links")


def keep_first(docs: DataFrame, classes: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """One row of each class in ``classes`` (a result of ``classified`` for ``docs``), in the columns of ``docs``.

    Of rows that are equal in id and text one stays.
    """
    firsts = classes.filter("first").groupBy("id", "t1", "t2").agg(F.count("*").alias("times"))
    firsts = firsts.select(F.coalesce("id", F.lit(NO_ID)).alias("key"), "t1", "t2", "times")
    key, t1, t2, times = (free_name(docs, c) for c in ("key", "t1", "t2", "times"))
    rows = docs.withColumns({key: F.coalesce(F.col(ident).cast("long"), F.lit(NO_ID)), **dict(zip((t1, t2), text_keys(text), strict=True))})
    joined = rows.join(firsts.toDF(key, t1, t2, times), [key, t1, t2])
    once = joined.filter(F.col(times) == 1)
    return once.unionByName(joined.filter(F.col(times) > 1).dropDuplicates([key, t1, t2])).select(docs.columns)
