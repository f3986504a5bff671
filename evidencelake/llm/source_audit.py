"""Divergence audit of sources: exact distances between the term distributions of all sources of a language.

Every language keeps the terms that occur in enough of its documents.  A group (a source of a language, or the language
itself) counts each kept term, and its counts form segment trees over term ids.  ``Forest`` builds them hash-consed: leaves
of one count and nodes of equal children exist once, so equal stretches of two groups, above all those where neither has
an occurrence, are one node.  Two trees are walked at the same time and the price of a pair of nodes is remembered, so every
pair of equal nodes is priced once, for all groups with the same number of occurrences.

Term ids: terms are dealt to blocks of about ``BLOCK`` by a hash, and numbered inside a block by falling frequency, which
puts the terms that most groups lack side by side.  A block has a tree per group.  Groups of a language are dealt to tiles
of ``TILE``; a task holds the trees of one block and two tiles, whatever the number of sources and terms, and emits a part
of the price of each pair of groups, which Spark adds up.

Defined results: a null text, language or source counts as ''; a group of texts without terms has count 0 everywhere; a
language without kept terms has pairs of value 0; repeated rows count each; an empty table gives an empty result; only the
three columns are read.  All arithmetic is exact in integers.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.llm.common import stash
from evidencelake.llm.groups import runs_of

MIN_DOCS, SCALE, TOP = 10, 1_000_000_000, 10
#: Terms in a block and groups in a tile, about: what a task holds.
BLOCK, TILE = 2048, 64
#: Distinct terms that a task gathers before it sends their counts on.
GATHERED = 250_000
#: A task's occurrences and documents of a term are one number; the documents are above these bits.
DOC_BITS = 40
DOC = 1 << DOC_BITS
#: All ASCII but letters separates terms; A to Z become small.
FOLD = bytes((c | 0x20) if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term; every group has a row with term '' besides."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, int]] = {}
        names = ["lang", "source", "term", "n", "docs"]

        def sent() -> Iterator[pa.RecordBatch]:
            for (a, b), found in held.items():
                terms, packed = pa.array(found.keys(), type=pa.binary()).cast(pa.string()), np.fromiter(found.values(), np.int64, len(found))
                for at in range(0, len(terms), 10_000):
                    part = terms.slice(at, 10_000)
                    own = packed[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.repeat(a, len(part)), pa.repeat(b, len(part)), part, pa.array(own & (DOC - 1)), pa.array(own >> DOC_BITS)], names=names)
            held.clear()

        gathered = 0
        for batch in batches:
            for a, b, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = held.setdefault((a, b), {b"": 0})
                before, get = len(found), found.get
                for term, n in Counter(v.as_py().translate(FOLD).split()).items():
                    found[term] = get(term, 0) + n + DOC
                gathered += len(found) - before
                if gathered > GATHERED:
                    gathered = 0
                    yield from sent()
        yield from sent()

    empty = F.lit("")
    rows = docs.select(F.coalesce(F.col(lang), empty).alias("lang"), F.coalesce(F.col(source), empty).alias("source"), F.coalesce(F.col(text), empty).cast("binary").alias("t"))
    found = rows.mapInArrow(task, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class Forest:
    """Hash-consed segment trees over positions 0 to ``size`` - 1, and prices of pairs of their nodes.

    Nodes are numbers; a leaf stands for a count, 0 for the absence of positions.  A tree is as high as the size asks for.
    Prices are remembered for one pair of denominators at a time.
    """

    def __init__(self, size: int):
        self.height = max(size - 1, 0).bit_length()
        self.size = size
        self.ids: dict[tuple, int] = {}
        #: (left, right), or (count, -1) for leaves.
        self.nodes: list[tuple[int, int]] = [(0, 0)]
        self.memo: dict[tuple[int, int], dict[tuple[int, int], int]] = {}
        self.empties: dict[tuple[int, int], int] = {}

    def leaf(self, count: int) -> int:
        return self._id((0, count), (count, -1))

    def join(self, level: int, left: int, right: int) -> int:
        return self._id((level, left, right), (left, right)) if left or right else 0

    def _id(self, key: tuple, node: tuple[int, int]) -> int:
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.nodes)
            self.nodes.append(node)
        return found

    def empty(self, level: int, n: int) -> int:
        """A node of this level over ``n`` positions, the rest absent, without occurrences."""
        if n <= 0:
            return 0
        if (level, n) not in self.empties:
            half = 1 << (level - 1) if level else 0
            self.empties[level, n] = self.join(level, self.empty(level - 1, min(n, half)), self.empty(level - 1, n - half)) if level else self.leaf(0)
        return self.empties[level, n]

    def tree(self, counts: dict[int, int]) -> int:
        """The root of the tree with these counts by position, 0 where there is none."""
        order = sorted(at for at, n in counts.items() if n)

        def build(level: int, start: int, lo: int, hi: int) -> int:
            if lo == hi:
                return self.empty(level, min(self.size - start, 1 << level))
            if not level:
                return self.leaf(counts[order[lo]])
            middle = start + (1 << (level - 1))
            cut = bisect_left(order, middle, lo, hi)
            return self.join(level, build(level - 1, start, lo, cut), build(level - 1, middle, cut, hi))

        return build(self.height, 0, 0, len(order)) if self.size else 0

    def price(self, a: int, b: int, na: int, nb: int) -> int:
        """Sum of (p - q)^2 // (p + q) over the positions of nodes ``a`` and ``b``, with the groups' denominators."""
        if na > nb:
            a, b, na, nb = b, a, nb, na
        if a == b and na == nb:
            return 0
        if (na, nb) not in self.memo:
            self.memo = {(na, nb): {}}
        memo = self.memo[na, nb]
        key = (a, b) if na < nb or a <= b else (b, a)
        found = memo.get(key)
        if found is None:
            (al, ar), (bl, br) = self.nodes[a], self.nodes[b]
            if not a:
                found = 0
            elif ar == -1:
                found = divergence(share(al, na), share(bl, nb))
            else:
                found = self.price(al, bl, na, nb) + self.price(ar, br, na, nb)
            memo[key] = found
        return found

    def over(self, a: int, whole: int, na: int, nb: int, at: int = 0, level: int | None = None) -> Iterator[tuple[int, int]]:
        """(position, price) of the leaves where ``a`` has occurrences and the larger share; empty subtrees are passed over."""
        level = self.height if level is None else level
        if not a or a == self.empties.get((level, 1 << level)):
            return
        if level == 0:
            p, q = share(self.nodes[a][0], na), share(self.nodes[whole][0], nb)
            if self.nodes[a][0] and p > q:
                yield at, divergence(p, q)
            return
        (al, ar), (wl, wr) = self.nodes[a], self.nodes[whole]
        yield from self.over(al, wl, na, nb, at, level - 1)
        yield from self.over(ar, wr, na, nb, at + (1 << (level - 1)), level - 1)


def share(count: int, denominator: int) -> int:
    return 1 + SCALE * (count + 2) // denominator


def divergence(p: int, q: int) -> int:
    return (p - q) * (p - q) // (p + q)


def block_rows(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """What tasks need: a row per (lang, block, lo, hi: tiles), group and kept term with an occurrence, and one per group with its denominator.

    Columns lang, blk, lo, hi, tile, whole (of the language itself), source, at (-1: the group's own row), n (there the
    denominator N + 2 V), term (of the language's rows) and size (terms of the block).
    """
    kept = counts.filter("term != ''").groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("total")).filter(F.col("d") >= min_docs)
    kept = stash(kept.select("lang", "term", "total"), "kept-terms")
    langs = counts.groupBy("lang").agg(F.lit(0).alias("none")).join(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("total")), "lang", "left")
    langs = langs.select("lang", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("total", F.lit(0)).alias("total"))
    langs = stash(langs.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / BLOCK)).cast("int")), "languages")
    in_block = Window.partitionBy("lang", "blk").orderBy(F.desc("total"), "term")
    placed = kept.join(langs.select("lang", "blocks"), "lang").withColumn("blk", F.pmod(F.xxhash64("term"), F.col("blocks").cast("long")).cast("int"))
    placed = stash(placed.select("lang", "term", "total", "blk", (F.row_number().over(in_block) - 1).alias("at")), "placed-terms")
    rows = counts.filter("term != ''").join(placed.select("lang", "term", "blk", "at"), ["lang", "term"]).select("lang", "source", "blk", "at", "n")
    rows = stash(rows, "kept-counts")
    sums = rows.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = counts.filter("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs.select("lang", "v", "blocks"), "lang")
    # tiles by a hash: a language has as many as its groups need, and pairs of tiles are a small table
    tiles = stash(groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "tiles")
    tile = F.pmod(F.xxhash64("source"), F.col("tiles").cast("long")).cast("int")
    groups = groups.join(tiles, "lang").withColumn("tile", tile).withColumn("denominator", F.coalesce("n", F.lit(0)) + 2 * F.col("v"))
    groups = stash(groups.select("lang", "source", "tile", "tiles", "denominator", "blocks"), "groups")
    sizes = placed.groupBy("lang", "blk").agg(F.count("*").cast("int").alias("size"))
    own = groups.select("lang", "source", "tile", "tiles", "denominator", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("blk"))
    no_term = F.lit(None).cast("string").alias("term")
    own = own.join(sizes, ["lang", "blk"], "left").select("lang", "blk", "tile", "tiles", F.lit(False).alias("whole"), "source", F.lit(-1).alias("at"), F.col("denominator").alias("n"), no_term, F.coalesce("size", F.lit(0)).alias("size"))
    counted = rows.join(groups.select("lang", "source", "tile", "tiles"), ["lang", "source"]).select("lang", "blk", "tile", "tiles", F.lit(False).alias("whole"), "source", "at", "n", no_term, F.lit(0).alias("size"))
    met = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda x: F.struct(F.least("tile", x).alias("lo"), F.greatest("tile", x).alias("hi")))
    spread = own.unionByName(counted).select("lang", "blk", "tile", "whole", "source", "at", "n", "term", "size", F.inline(met))
    # the language's own counts go to each tile once
    wide = langs.join(tiles, "lang").select("lang", "v", F.col("total").alias("all"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    # a small table by its size on disk: the terms of a language stay where they are
    wide = placed.join(stash(wide, "language-tiles"), "lang")
    wide = wide.select("lang", "blk", "tile", F.lit(True).alias("whole"), F.lit("").alias("source"), "at", F.col("total").alias("n"), "term", F.lit(0).alias("size"), F.col("tile").alias("lo"), F.col("tile").alias("hi"))
    lang_own = langs.join(tiles, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("blk"), "v", "total", "tiles")
    lang_own = lang_own.select("lang", "blk", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.lit(True).alias("whole"), F.lit("").alias("source"), F.lit(-1).alias("at"), (F.col("total") + 2 * F.col("v")).alias("n"), no_term, F.lit(0).alias("size"))
    lang_own = lang_own.withColumns({"lo": F.col("tile"), "hi": F.col("tile")})
    return spread.unionByName(wide).unionByName(lang_own)


def priced(rows: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, part, source, item, value) per block: parts of the price of each pair of sources, and the block's first terms of each source."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs_of(batches, 4):
            lang, lo, hi = run.column(0)[0].as_py(), run.column(2)[0].as_py(), run.column(3)[0].as_py()
            group = [(w, t, s) for w, t, s in zip(run.column(5).to_pylist(), run.column(4).to_pylist(), run.column(6).to_pylist(), strict=True)]
            at, n = run.column(7).to_pylist(), run.column(8).to_pylist()
            below: dict[tuple, int] = {}
            counts: dict[tuple, dict[int, int]] = {}
            terms: dict[int, str] = {}
            size = max(run.column(10).to_pylist())
            for g, x, c, term in zip(group, at, n, run.column(9).to_pylist(), strict=True):
                if x < 0:
                    below[g] = c
                    counts.setdefault(g, {})
                else:
                    counts.setdefault(g, {})[x] = c
                    if g[0]:
                        terms[x] = term
            forest = Forest(size)
            roots = {g: forest.tree(c) for g, c in counts.items()}
            out: list[tuple[str, str, str, int]] = []
            plain = sorted((g for g in roots if not g[0]), key=below.__getitem__)  # equal denominators follow one another
            for i, g in enumerate(plain):
                for h in plain[i + 1 :]:
                    if lo == hi or g[1] != h[1]:
                        price = forest.price(roots[g], roots[h], below[g], below[h])
                        out += [("pair", g[2], h[2], price), ("pair", h[2], g[2], price)]
            if lo == hi:
                whole = next(g for g in roots if g[0])
                for g in plain:
                    found = ((-price, terms[x].encode(), terms[x]) for x, price in forest.over(roots[g], roots[whole], below[g], below[whole]))
                    out += [("term", g[2], term, -price) for price, _, term in heapq.nsmallest(top, found)]
            part, source, item, value = zip(*out, strict=True) if out else ((), (), (), ())
            arrays = [pa.array([lang] * len(out), type=pa.string()), *(pa.array(x, type=pa.string()) for x in (part, source, item)), pa.array(value, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "part", "source", "item", "value"])

    keys = ["lang", "blk", "lo", "hi"]
    dealt = rows.select(*keys, "tile", "whole", "source", "at", "n", "term", "size").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(task, "lang string, part string, source string, item string, value bigint")


def divergences(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): all other sources by distance, and the ``top`` terms that set a source apart."""
    counts = stash(term_counts(docs, text, lang, source), "term-counts")
    parts = stash(priced(block_rows(counts, min_docs), top), "priced-blocks")
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    found = pairs.unionByName(parts.filter("part = 'term'").select(pairs.columns))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", rank).filter((F.col("part") == "pair") | (F.col("rank") <= top))


ORACLE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), occurrences AS (
    SELECT row_id, lang, source, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS total FROM occurrences GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10
), langs AS (
    SELECT d.lang, count(DISTINCT k.term)::HUGEINT AS v, coalesce((SELECT sum(total) FROM kept WHERE kept.lang = d.lang), 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang FROM docs) d LEFT JOIN kept k ON k.lang = d.lang GROUP BY d.lang
), counts AS (
    SELECT lang, source, term, count(*)::HUGEINT AS c FROM occurrences SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT g.lang, g.source, coalesce(sum(c), 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts USING (lang, source) GROUP BY g.lang, g.source
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
           1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (g.n + 2 * l.v) AS p,
           1 + (1000000000::HUGEINT * (k.total + 2)) // (l.n + 2 * l.v) AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), priced AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), rows_of AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN priced p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM rows_of
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
