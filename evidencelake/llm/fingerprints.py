"""Canonical exact digests of documents (built-in functions only).

A text is brought to canonical form (Unicode NFKC, full case folding, runs of Unicode white space to one blank, ends
trimmed) and hashed with four differently salted ``xxhash64``: 256 bits, written as 64 hex digits.  Rows that
share the 256 bits form a bucket; a grouping by the canonical bytes themselves checks every bucket with more
than one row, and in a bucket with differing bytes every row gets a SHA-256 suffix, so that unequal texts never share a
fingerprint and equal texts always do.

Defined results: a null text counts as empty; empty and all-blank texts share one fingerprint; repeated rows stay
repeated; null ids sort first; rows with the same id are ordered by a hash of the text; an empty table gives an empty result;
extra columns pass through, whatever their names, unless an output column of the operator has the same name, which then wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.llm.common import free_name, stash

#: Cells of the bounded pre-filters of the byte comparison: at most this many longs are broadcast.
PREFILTER = 1 << 18
NO_ID = -(1 << 63)


def canonical(text: Column) -> Column:
    """NFKC, case fold, NFKC of what that gave, white space (the Unicode property) folding; null counts as empty."""
    compose = lambda t: F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), t, F.lit(True))
    folded = F.call_function("reflect", F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(F.coalesce(text, F.lit(""))), F.lit(True))
    return F.trim(F.regexp_replace(compose(folded), r"\p{IsWhite_Space}+", " "))


def wide_hash(canon: Column) -> Column:
    """256 bits as four longs."""
    return F.array(*[F.xxhash64(F.lit(salt), canon) for salt in (11, 23, 47, 89)])


def as_hex(wide: Column) -> Column:
    return F.concat(*[F.lpad(F.hex(F.get(wide, i)), 16, "0") for i in range(4)])


def cell(wide: Column) -> Column:
    return F.pmod(F.get(wide, 0), F.lit(PREFILTER))


def cells(wides: DataFrame) -> DataFrame:
    """The cells that the hashes in the first column fall into: at most PREFILTER longs whatever the input, so they may be broadcast."""
    return F.broadcast(wides.select(cell(F.col(wides.columns[0])).alias("cell")).distinct())


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` plus ``out``: equal for two rows exactly if their canonical texts are equal."""
    kept = [c for c in df.columns if c != out]
    canon, wide = free_name(df, "canon"), free_name(df, "wide")
    hashed = df.withColumn(canon, canonical(F.col(f"`{text}`"))).withColumn(wide, wide_hash(F.col(canon)))
    wides = hashed.select(F.col(wide).alias("wide"))
    mixed = differing_bytes(hashed.select(F.col(canon).alias("canon"), F.col(wide).alias("wide")), wides)
    found = marked(hashed, [wide], [F.sha2(F.col(canon), 256)], mixed)
    return found.select(*[F.col(f"`{c}`") for c in kept], F.col(found.columns[-1]).alias(out))


def differing_bytes(texts: DataFrame, wides: DataFrame) -> DataFrame:
    """Hashes (wide) that stand for more than one canonical text among ``texts`` (canon, wide); empty short of a collision.

    Hashes alone are counted first, so that text is shuffled only for buckets with several rows, and equal bytes
    are merged before the shuffle: a group that holds a third of all rows sends one row per task.
    """
    repeated = wides.groupBy("wide").count().filter("count > 1").select("wide")
    bytes_seen = texts.join(cells(repeated), cell(F.col("wide")) == F.col("cell"), "left_semi").groupBy("wide", "canon").count()
    return bytes_seen.groupBy("wide").count().filter("count > 1").select("wide")


def marked(rows: DataFrame, wides: list[str], digests: list[Column], mixed: DataFrame) -> DataFrame:
    """``rows`` plus a fingerprint per column of ``wides``: its hex, with the digest behind it where the hash is in ``mixed``.

    Only rows whose cell holds such a hash are joined with ``mixed``; all others, hot groups among them, stay where they are.
    """
    mixed = stash(mixed, "mixed-buckets")
    near = [free_name(rows, f"near{i}") for i in range(len(wides))]
    held = rows
    for w, n in zip(wides, near, strict=True):
        held = held.join(cells(mixed).withColumnRenamed("cell", n), cell(F.col(w)) == F.col(n), "left")
    is_clean = F.coalesce(*[F.col(n) for n in near]).isNull()
    names = [free_name(rows, f"mark{i}") for i in range(len(wides))]
    clean = held.filter(is_clean).select(*rows.columns, *[as_hex(F.col(w)).alias(m) for w, m in zip(wides, names, strict=True)])
    other = held.filter(~is_clean)
    for w, d, m in zip(wides, digests, names, strict=True):
        both = free_name(other, "both")
        other = other.join(mixed.withColumnRenamed("wide", both), F.col(w) == F.col(both), "left")
        other = other.withColumn(m, F.concat_ws(":", as_hex(F.col(w)), F.when(F.col(both).isNotNull(), d))).drop(both)
    return clean.unionByName(other.select(clean.columns))


def order_links(rows: DataFrame) -> DataFrame:
    """Distinct (key, t1) of ``rows`` (key, t1, n) with times, and prev: the key, t1 and n before it (before the first: the last).

    Only keys are moved: they are cut into ranges, shifted by one row inside a range, and each range takes the last row of
    the one before it.
    """
    distinct = rows.groupBy("key", "t1").agg(F.count("*").alias("times"), F.max("n").alias("n"))
    ranged = stash(distinct.repartitionByRange("key", "t1").withColumn("part", F.spark_partition_id()), "ordered-keys")
    row = F.struct("key", "t1", "n")
    in_order = Window.orderBy("part")  # a row per range, as many as there are shuffle partitions
    ends = ranged.groupBy("part").agg(F.max(row).alias("last"))
    last = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = ends.select("part", F.coalesce(F.lag("last").over(in_order), last).alias("before"))
    shifted = ranged.withColumn("prev", F.lag(row).over(Window.partitionBy("part").orderBy("key", "t1")))
    return shifted.join(before, "part").select("key", "t1", "times", F.coalesce("prev", "before").alias("prev"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """The query's result: fingerprints of each text, of its edited text, likenesses (1 if equal, else 0), and the next document's id.

    A text is moved once, to its key; from there it sends the row before it the beginning that this one's edit needs.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64(text).alias("t1"), text.alias("text"))
    links = stash(order_links(base.select("key", "t1", F.char_length("text").alias("n"))), "order-links")
    held = base.hint("merge").join(links, ["key", "t1"])
    # rows that are equal in id and text are kept once, with their number
    rows = held.filter("times = 1").unionByName(held.filter("times > 1").dropDuplicates(["key", "t1"]))
    gifts = rows.select(
        F.col("prev.key").alias("to_key"), F.col("prev.t1").alias("to_t1"), F.expr("left(text, cast(prev.n div 4 as int))").alias("head"),
        F.col("key").alias("next_key"), F.col("t1").alias("next_t1"), F.col("doc_id").alias("next_doc_id"),
    )
    met = rows.hint("merge").join(gifts, (F.col("key") == F.col("to_key")) & (F.col("t1") == F.col("to_t1")))
    # of r equal rows the last is followed by the next text, the others by the same text
    own = F.struct(F.expr("left(text, cast(char_length(text) div 4 as int))").alias("head"), F.col("key").alias("next_key"), F.col("t1").alias("next_t1"), F.col("doc_id").alias("next_doc_id"))
    after = F.concat(F.array(F.struct("head", "next_key", "next_t1", "next_doc_id")), F.array_repeat(own, (F.col("times") - 1).cast("int")))
    spread = met.filter("times = 1").select("doc_id", "key", "t1", "text", "head", "next_key", "next_t1", "next_doc_id").unionByName(
        met.filter("times > 1").select("doc_id", "key", "t1", "text", F.inline(after))
    )
    cut = F.expr("left(text, cast(char_length(text) - char_length(text) div 4 as int))")
    judged = (
        spread.withColumn("edited", F.concat(cut, "head"))
        .withColumn("canon", canonical(F.col("text")))
        .withColumn("edited_canon", canonical(F.col("edited")))
        .withColumn("wide", wide_hash(F.col("canon")))
        .withColumn("edited_wide", wide_hash(F.col("edited_canon")))
        .select(
            "doc_id", "key", "t1", "next_key", "next_t1", "next_doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            "wide", "edited_wide", F.sha2("canon", 256).alias("sha"), F.sha2("edited_canon", 256).alias("edited_sha"),
            ((F.col("wide") == F.col("edited_wide")) & (F.col("canon") == F.col("edited_canon"))).cast("double").alias("near_edited"),
        )
    )
    judged = stash(judged, "fingerprints")
    nexts = judged.select(F.col("key").alias("next_key"), F.col("t1").alias("next_t1"), F.col("wide").alias("next_wide"), F.col("sha").alias("next_sha"))
    judged_next = judged.join(nexts.dropDuplicates(["next_key", "next_t1"]), ["next_key", "next_t1"])
    near_next = ((F.col("wide") == F.col("next_wide")) & (F.col("sha") == F.col("next_sha"))).cast("double")
    # bytes are compared among the texts; edited texts, which are nowhere stored, by their SHA-256
    texts = base.select(canonical(F.col("text")).alias("canon")).withColumn("wide", wide_hash(F.col("canon")))
    every = judged.select("wide", F.xxhash64("sha").alias("d")).unionByName(judged.select(F.col("edited_wide").alias("wide"), F.xxhash64("edited_sha").alias("d")))
    by_digest = every.groupBy("wide").agg(F.min("d").alias("least"), F.max("d").alias("most")).filter("least != most").select("wide")
    mixed = differing_bytes(texts, judged.select("wide")).unionByName(by_digest).distinct()
    found = marked(judged_next.withColumn("near_next", near_next), ["wide", "edited_wide"], [F.col("sha"), F.col("edited_sha")], mixed)
    names = dict(zip(found.columns[-2:], ("fingerprint", "edited_fingerprint"), strict=True))
    return found.withColumnsRenamed(names).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "next_doc_id")
