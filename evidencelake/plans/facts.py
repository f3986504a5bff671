"""Machine facts from input events of recorded pages.

Edits of an element are compared with the text before by windows; answers and result panels are in ``answers``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.functions.text import diff_excerpt, input_role, is_autoformat, locality, normalised
from evidencelake.operators.excerpts import BLOCK, blocks_of, occurrences
from evidencelake.operators.folds import listed
from evidencelake.plans import risk

#: Fixed thresholds.
PASTE_CHARS, CORRECTION_CHARS, AUTOFORMAT_MS, SWITCH_MS, COPY_MS, PAIR_MS, CORPUS_CHARS = 50, 10, 500, 100, 120_000, 5_000, 20


def inputs_by_role(inputs: DataFrame) -> DataFrame:
    """Input rows from an element's first text on, with their role and the text before."""
    w = Window.partitionBy("sk", "element").orderBy("t_ms", "ord")
    rows = inputs.withColumn("_filled", F.sum(F.when(F.col("text") != "", 1).otherwise(0)).over(w)).filter("_filled > 0").drop("_filled")
    return rows.withColumn("role", input_role(F.col("text"), F.col("is_checked"), F.col("section_type"))).withColumn("before", F.lag("text").over(w))


def edits(inputs: DataFrame) -> DataFrame:
    """Typing rows (sk, element, section_type, ord, t_ms, text, is_checked) with the text before and the change in length."""
    rows = inputs_by_role(inputs)
    typed = rows.filter("role = 'real_typing'")
    own = Window.partitionBy("sk", "element").orderBy("t_ms", "ord")
    typed = typed.withColumn("n", F.row_number().over(own)).withColumn("since_ms", F.col("t_ms") - F.lag("t_ms").over(own))
    return typed.withColumn("delta", F.char_length("text") - F.char_length("before"))


def edit_facts(typed: DataFrame) -> DataFrame:
    """One fact per row: start of typing, autoformat, large paste, correction, else a plain edit."""
    auto = (F.abs("delta") < PASTE_CHARS) & (F.col("since_ms") < AUTOFORMAT_MS) & is_autoformat(F.col("before"), F.col("text"))
    kind = (
        F.when(F.col("n") == 1, "TYPING_STARTED").when(F.coalesce(auto, F.lit(False)), "AUTOFORMAT").when(F.col("delta") >= PASTE_CHARS, "LARGE_PASTE")
        .when(F.col("delta") <= -CORRECTION_CHARS, "TEXT_CORRECTION").otherwise("EDIT")
    )
    rows = typed.withColumn("kind", kind)
    paste = F.col("kind") == "LARGE_PASTE"
    return rows.withColumn("excerpt", F.when(paste, diff_excerpt(F.col("before"), F.col("text")))).withColumn("locality", F.when(paste, locality(F.col("before"), F.col("text"))))


def typing_stopped(facts: DataFrame) -> DataFrame:
    """Per element: span, inserted characters (pastes apart), counts, lengths and characters a second to one place."""
    counted = F.col("kind") != "AUTOFORMAT"
    gain = F.when(counted & (F.col("delta") > 0) & (F.col("delta") < PASTE_CHARS), F.col("delta"))
    out = facts.groupBy("sk", "element").agg(
        F.min("t_ms").alias("start_ms"), F.max("t_ms").alias("end_ms"), F.coalesce(F.sum(gain), F.lit(0)).alias("inserted"),
        F.count_if(counted & (F.col("delta") > 0)).alias("insertions"), F.count_if(counted & (F.col("delta") < 0)).alias("deletions"),
        F.max(F.char_length("text")).alias("peak"), F.max_by(F.char_length("text"), F.struct("t_ms", "ord")).alias("final"),
    )
    length = (F.col("end_ms") - F.col("start_ms")) / 1000.0
    return out.withColumn("chars_per_second", F.when(length > 0, F.bround(F.col("inserted") / length, 1)).otherwise(0.0))


def session_corpus(facts: DataFrame, submissions: DataFrame) -> DataFrame:
    """(sk, t): a session's submitted sources, then its texts of ``CORPUS_CHARS`` or more, in order, normalised and joined by blanks.

    One row and string per session.  Texts of white space alone add nothing.
    """
    sent = submissions.filter("source != ''").select("sk", F.lit(0).alias("part"), "t_ms", "ord", F.lit(0).alias("i"), F.col("source").alias("text"))
    texts = facts.filter(F.col("kind").isin("LARGE_PASTE", "TEXT_CORRECTION")).select("sk", F.lit(1).alias("part"), "t_ms", "ord", F.posexplode("texts").alias("i", "text"))
    parts = sent.unionByName(texts.filter(F.char_length("text") >= CORPUS_CHARS)).withColumn("text", normalised(F.col("text"))).filter("text != ''")
    return listed(parts, ["sk"], ["part", "t_ms", "ord", "i", "text"], "rows").select("sk", F.array_join(F.transform("rows", lambda r: r["text"]), " ").alias("t"))


def paste_origins(facts: DataFrame, submissions: DataFrame, copies: DataFrame, copy_ms: int = COPY_MS) -> DataFrame:
    """Where each large paste comes from, by the first rule that holds: sk, ord, t_ms, origin, reason (null: from outside).

    ``facts``: sk, ord, t_ms, kind, section_id, excerpt (its first 300 characters count), texts (array of the edit's texts, the
    excerpt among them).  ``submissions``: sk, ord, t_ms, starter, source.  ``copies``: sk, t_ms, section_id.  Rows without a session
    are left out; (sk, ord) is unique.

    1, 2: the excerpt stands in a starter text or in a submitted source.  3: it stands at least twice, not overlapping, in the
    session's corpus.  4: an earlier paste's excerpt is the same, or one holds the other and has 40 characters.  5: a copy
    in the same section (or without one) lies at most ``copy_ms`` before.  Rules 1 to 4 need an excerpt of 20 characters.

    Rules 1 to 4 look up an index of all texts of the session: each excerpt meets only blocks that share the key of its first
    window of 20 characters.  An excerpt held by another one stands twice in the corpus, as both are in it, so rule 3 has
    it; what rule 4 adds are later pastes that hold an earlier one, and no list of accepted pastes has to be kept in order.
    Excerpts of under 20 characters once white space is folded have no window and are searched for in their session's texts one by one.
    """
    # each is read several times, but cut and exchanged once
    facts = risk.by_session(facts.filter("kind in ('LARGE_PASTE', 'TEXT_CORRECTION')").select("sk", "ord", "t_ms", "kind", "section_id", "excerpt", "texts"))
    submissions = risk.by_session(submissions.select("sk", "ord", "t_ms", "starter", "source"))
    rows = facts.filter("kind = 'LARGE_PASTE'").select("sk", "ord", "t_ms", "section_id", F.substring("excerpt", 1, 300).alias("excerpt"))
    rows = rows.withColumn("e", F.when(F.char_length("excerpt") >= CORPUS_CHARS, normalised(F.col("excerpt")))).drop("excerpt")
    texts = rows.filter("e is not null").groupBy("sk", "e").agg(F.min(F.struct("t_ms", "ord")).alias("first"))
    n = F.char_length("e")
    middle = F.when(n >= 40, F.substring(F.col("e"), F.lit(6), n - 10)).otherwise(F.col("e"))
    needles = texts.select("sk", "e", "first", F.explode(F.array(*[F.struct(F.lit(b).alias("bag"), t.alias("needle")) for b, t in (("starter", middle), ("source", middle), ("corpus", F.col("e")), ("paste", F.col("e")))])).alias("x"))
    needles = needles.filter(n >= CORPUS_CHARS).select("sk", "x.bag", F.struct("e", "first").alias("e"), "x.needle")

    sent = submissions.select("sk", F.explode(F.array(*[F.struct(F.lit(b).alias("bag"), normalised(F.col(b)).alias("s")) for b in ("starter", "source")])).alias("x"))
    sent = sent.select("sk", "x.*").filter(F.char_length("s") >= CORPUS_CHARS).groupBy("sk", "bag").agg(F.array_join(F.array_sort(F.collect_set("s")), "\n").alias("s"))
    corpus = session_corpus(facts, submissions)
    holders = texts.filter(n >= 40).select("sk", F.lit("paste").alias("bag"), F.xxhash64("e").alias("block"), F.col("e").alias("t"))
    long_texts = sent.unionByName(corpus.select("sk", F.lit("corpus").alias("bag"), F.col("t").alias("s")))
    bag = lambda b: F.col("bag") == b
    hits = occurrences(needles, blocks_of(long_texts, ["sk", "bag"], "s").unionByName(holders), ["sk", "bag"]).select("sk", "bag", "e.*", "t", F.when(bag("corpus"), F.col("block") * BLOCK + F.col("place")).alias("at"))
    short = texts.filter(n < CORPUS_CHARS)
    times = (F.char_length("t") - F.char_length(F.replace("t", F.col("e"), F.lit("")))) / F.nullif(n, F.lit(0))
    often = short.join(corpus, "sk").filter(F.coalesce(times >= 2, F.lit(True))).select("sk", F.lit("often").alias("bag"), "e", "first", F.lit(None).cast("string").alias("t"), F.lit(None).cast("bigint").alias("at"))
    held = short.join(holders, "sk").filter(F.contains("t", F.col("e"))).select("sk", "bag", "e", "first", "t", F.lit(None).cast("bigint").alias("at"))
    # a hit speaks for its excerpt, but one in another excerpt speaks for that one
    said = hits.unionByName(often).unionByName(held).filter(~bag("paste") | (F.col("t") != F.col("e"))).withColumn("e", F.when(bag("paste"), F.col("t")).otherwise(F.col("e")))
    found = said.groupBy("sk", "e").agg(
        F.bool_or(bag("starter")).alias("starter"), F.bool_or(bag("source")).alias("own"),
        (F.bool_or(bag("often")) | F.coalesce(F.max("at") - F.min("at") >= F.any_value(n), F.lit(False))).alias("twice"),
        F.min(F.when(bag("paste"), F.col("first"))).alias("held_first"),
    )

    # the last copy without a section, in the row's section, or (for a row without one) anywhere, as running maxima
    both = rows.select("sk", "t_ms", "section_id", "ord", "e").unionByName(copies.select("sk", "t_ms", "section_id", F.col("t_ms").alias("c")), allowMissingColumns=True)
    c, section = F.col("c"), F.col("section_id")
    anywhere, there = Window.partitionBy("sk").orderBy("t_ms"), Window.partitionBy("sk", "section_id").orderBy("t_ms")
    last = F.when(section.isNull(), F.max(c).over(anywhere)).otherwise(F.greatest(F.max(F.when(section.isNull(), c)).over(anywhere), F.max(c).over(there)))
    rows = both.withColumn("copied", F.col("t_ms") - last <= copy_ms).filter("ord is not null")

    out = rows.join(found, ["sk", "e"], "left")
    reason = (
        F.when(F.col("starter"), "starter_code_match").when(F.col("own"), "own_submission_match").when(F.col("twice"), "in_session_corpus_match")
        .when(F.col("held_first") < F.struct("t_ms", "ord"), "duplicate_paste").when(F.col("copied"), "preceding_copy")
    )
    return out.select("sk", "ord", "t_ms", F.when(reason.isNotNull(), "internal").otherwise("external").alias("origin"), reason.alias("reason"))


def reportable(kind, origin, reverted, chars):
    """A large or plain paste from outside that stayed; a large one with a known size below the limit is not."""
    small = (kind == "LARGE_PASTE") & (chars > 0) & (chars < PASTE_CHARS)
    return kind.isin("LARGE_PASTE", "PASTE") & (F.coalesce(origin, F.lit("external")) != "internal") & ~F.coalesce(reverted, F.lit(False)) & ~F.coalesce(small, F.lit(False))
