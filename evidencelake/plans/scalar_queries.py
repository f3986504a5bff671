"""Scalar functions and machine facts over names built from the test tables.

Chunk URLs are built from events, text edits are the turns of a conversation, citations and responses come from events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.functions import text, urls
from evidencelake.operators.excerpts import window_keys
from evidencelake.plans import facts
from evidencelake.plans.registry import HOUR, events, of_kind, query, spans, table

#: A URL per event: five shapes by kind.
URL_SQL = """u AS (SELECT sk, ord, k, kind, t_ms, CASE kind WHEN 'view' THEN 'https://h.example.com/cam/a' || sk || '/' || t_ms || '__' || (k + 1) * 1000 || '.webm'
    WHEN 'click' THEN 'https://h.example.com/v3/' || t_ms || '__' || (k + 1) * 1000 || '.webm?sig=x' WHEN 'purchase' THEN 'https://h.example.com/v2/' || t_ms || '__' || (k + 1) * 1000 || '.json'
    WHEN 'error' THEN 'http://h.example.com/v3/' || t_ms || '__events.json.gz' ELSE 'https://h.example.com/log/' || t_ms || '.json.gz' END AS url FROM ev WHERE k IS NOT NULL)"""


def chunk_urls(spark, sf_dir):
    t, d = F.col("t_ms").cast("string"), ((F.col("k") + 1) * 1000).cast("string")
    h = "https://h.example.com/"
    url = (
        F.when(F.col("kind") == "view", F.concat(F.lit(h + "cam/a"), F.col("sk").cast("string"), F.lit("/"), t, F.lit("__"), d, F.lit(".webm")))
        .when(F.col("kind") == "click", F.concat(F.lit(h + "v3/"), t, F.lit("__"), d, F.lit(".webm?sig=x")))
        .when(F.col("kind") == "purchase", F.concat(F.lit(h + "v2/"), t, F.lit("__"), d, F.lit(".json")))
        .when(F.col("kind") == "error", F.concat(F.lit("http://h.example.com/v3/"), t, F.lit("__events.json.gz")))
        .otherwise(F.concat(F.lit(h + "log/"), t, F.lit(".json.gz")))
    )
    return events(spark, sf_dir).filter("k is not null").withColumn("url", url)


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages""")
def x1_url_path(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(urls.path(F.col("url")), F.lit("")).alias("path"))


@query(f"""+ {URL_SQL} SELECT ord, CASE kind WHEN 'view' THEN 'camera_chunk' WHEN 'click' THEN 'screen_chunk' WHEN 'purchase' THEN 'rrweb_chunk' WHEN 'error' THEN 'events_sidecar' ELSE 'rrweb_gzip' END AS chunk_kind FROM u""")
def x2_url_kind(spark, sf_dir):
    return chunk_urls(spark, sf_dir).select("ord", urls.kind(F.col("url")).alias("chunk_kind"))


@query(f"""+ {URL_SQL} SELECT ord, CASE WHEN kind IN ('view', 'click', 'purchase') THEN (k + 1) * 1000 END AS duration_ms FROM u""")
def x3_duration(spark, sf_dir):
    return chunk_urls(spark, sf_dir).select("ord", urls.duration_ms(F.col("url")).alias("duration_ms"))


@query(f"""+ {URL_SQL} SELECT ord, 'video-' || t_ms || '__' || (k + 1) * 1000 AS chunk_id FROM u WHERE kind = 'view'""")
def x4_chunk_id(spark, sf_dir):
    rows = chunk_urls(spark, sf_dir).filter("kind = 'view'")
    return rows.select("ord", urls.chunk_id(F.lit("video"), F.col("url")).alias("chunk_id"))


@query(f"""+ {URL_SQL} SELECT ord, t_ms AS epoch_ms, (k + 1) * 1000 AS duration_ms, t_ms - (k + 1) * 1000 AS start_ms FROM u WHERE kind = 'view'""")
def x6_chunk_clock(spark, sf_dir):
    rows = chunk_urls(spark, sf_dir).filter("kind = 'view'")
    return rows.select("ord", urls.chunk_clock(urls.chunk_id(F.lit("video"), F.col("url"))).alias("c")).select("ord", "c.*")


@query("""SELECT ord, CASE WHEN k % 2 = 0 THEN kind ELSE NULL END AS section FROM ev WHERE k IS NOT NULL""")
def x7_chunk_section(spark, sf_dir):
    prefix = F.when(F.col("k") % 2 == 0, F.lit("video-")).otherwise(F.lit("audio-"))
    chunk = F.concat(prefix, F.col("kind"), F.lit("-"), F.col("t_ms").cast("string"))
    return events(spark, sf_dir).filter("k is not null").select("ord", urls.chunk_section(chunk).alias("section"))


@query("""SELECT event_id AS ord, epoch_us(ts) // 1000 // 1000 * 1000 - 19800000 AS naive_ms, epoch_us(ts) // 1000 // 1000 * 1000 AS zoned_ms FROM events""")
def x9_activity_clock(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    text_ = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return rows.select(F.col("event_id").alias("ord"), urls.epoch_ms(text_).alias("naive_ms"), urls.epoch_ms(F.concat(F.replace(text_, F.lit(" "), F.lit("T")), F.lit("Z"))).alias("zoned_ms"))


TURNS = """t AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)"""


def turns(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").withColumn("before", F.lag("text").over(w)).withColumn("n", F.row_number().over(w))


@query(f"""+ {TURNS} SELECT conv_id, turn, regexp_replace(before, '[\\s{{}}()\\[\\]<>;,''"]', '', 'g') = regexp_replace(text, '[\\s{{}}()\\[\\]<>;,''"]', '', 'g') AS same_skeleton,
    CASE WHEN starts_with(text, before) THEN 'append_at_end' ELSE 'mid_document_replace' END AS locality FROM t WHERE before IS NOT NULL""")
def x16_x17_edit_shape(spark, sf_dir):
    rows = turns(spark, sf_dir).filter("before is not null")
    return rows.select(
        "conv_id", "turn", text.is_autoformat(F.col("before"), F.col("text")).alias("same_skeleton"), text.locality(F.col("before"), F.col("text")).alias("locality")
    )


@query("""SELECT conv_id, turn, substr(text, 20, 60) AS excerpt FROM conversations WHERE length(text) > 120""")
def x18_paste_excerpt(spark, sf_dir):
    """The middle that was inserted: the text before the edit lacks characters 20 to 79, fenced off by marks on both sides."""
    rows = table(spark, sf_dir, "conversations").filter(F.char_length("text") > 120)
    begin, middle, end = F.substring("text", 1, 19), F.substring("text", 20, 60), F.expr("substring(text, 80)")
    before, after = F.concat(begin, F.lit("\u0001\u0002"), end), F.concat(begin, F.lit("\u0001"), middle, F.lit("\u0002"), end)
    return rows.select("conv_id", "turn", text.diff_excerpt(before, after).alias("excerpt"))


def normal_sql(column: str) -> str:
    return f"trim(regexp_replace(lower({column}), '{text.SPACE}+', ' ', 'g'), ' ')"


@query(f"""+ b AS (SELECT item_id, {normal_sql('text')} AS e FROM benchmark), d AS (SELECT doc_id, {normal_sql('text')} AS s FROM documents)
    SELECT item_id, doc_id FROM b, d WHERE length(e) >= 20 AND length(s) >= 20 AND (contains(s, e) OR (length(e) >= 40 AND length(substr(e, 6, length(e) - 10)) >= 20 AND contains(s, substr(e, 6, length(e) - 10))))""")
def x20_excerpt_containment(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", text.normalised(F.col("text")).alias("e"))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.normalised(F.col("text")).alias("s"))
    return excerpts_in(items, docs)


def excerpts_in(items: DataFrame, docs: DataFrame) -> DataFrame:
    """(item_id, doc_id) of excerpts ``e`` in texts ``s``, both normalised.

    A text that holds an excerpt holds the excerpt's middle (below 40 characters the whole of it), of 20 characters at
    least.  Every text is keyed by the least hash of the 11 grams of 10 characters in each of its windows of 20, and an excerpt by that of
    its middle's first window, so texts meet by equality, not pairwise, and none is missed.
    """
    items, docs = items.filter(F.char_length("e") >= 20), docs.filter(F.char_length("s") >= 20)
    middle = F.when(F.char_length("e") >= 40, F.substring("e", 6, 20)).otherwise(F.substring("e", 1, 20))
    excerpts = keyed(items.select("item_id", middle.alias("t")), "item_id").join(items, "item_id").select("item_id", "key", "e")
    # at most 2 ** 18 cells whatever the input, so they may be broadcast: most keys of texts go no further while excerpts are few
    cell = F.pmod("key", F.lit(1 << 18)).alias("cell")
    cells = F.broadcast(excerpts.select(cell).distinct())
    keys = keyed(docs.select("doc_id", F.col("s").alias("t")), "doc_id").select("doc_id", "key", cell).join(cells, "cell", "left_semi")
    found = keys.join(excerpts, "key").select("item_id", "doc_id", "e").distinct()
    hits = found.join(docs, "doc_id").filter(text.excerpt_in(F.col("e"), F.col("s")))
    return hits.select("item_id", "doc_id")


def keyed(rows: DataFrame, ident: str) -> DataFrame:
    """(ident, key): the distinct least hashes of each text's windows of 20 characters; ``rows`` has ident and t."""

    def task(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            at, keys = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                least = np.unique(window_keys(t)[1])
                at.append(np.full(len(least), i))
                keys.append(least.view(np.int64))
            if at:
                names = batch.column(0).take(pa.array(np.concatenate(at)))
                yield pa.RecordBatch.from_arrays([names, pa.array(np.concatenate(keys))], names=["ident", "key"])

    kind = rows.schema[ident].dataType.simpleString()
    return rows.select(ident, "t").mapInArrow(task, f"ident {kind}, key bigint").withColumnRenamed("ident", ident)


@query("""SELECT ord, CASE WHEN k BETWEEN 1 AND 499 THEN CAST(k AS INT) END AS question FROM ev WHERE k IS NOT NULL""")
def x23_question_number(spark, sf_dir):
    label = F.when(F.col("k") % 2 == 0, F.concat(F.lit("Question "), F.col("k").cast("string"))).otherwise(F.concat(F.lit("see q#"), F.col("k").cast("string"), F.lit(" now")))
    return events(spark, sf_dir).filter("k is not null").select("ord", text.question_number(label).alias("question"))


@query("""SELECT ord, CAST(round_even(t_ms % 100000 / 1000.0::DOUBLE, 0) AS BIGINT) AS sec FROM ev""")
def x24_bankers_seconds(spark, sf_dir):
    return events(spark, sf_dir).select("ord", text.seconds(F.col("t_ms") % 100_000).cast("bigint").alias("sec"))


@query("""SELECT ord, 'w_' || ord AS window_id, 'audio.' || kind AS path, CASE WHEN k % 2 = 0 THEN 'yes' END AS value FROM ev WHERE k IS NOT NULL""")
def x32_citation_parse(spark, sf_dir):
    value = F.when(F.col("k") % 2 == 0, F.lit("=yes")).otherwise(F.lit(""))
    ref = F.concat(F.lit("w_"), F.col("ord").cast("string"), F.lit(".audio."), F.col("kind"), value)
    return events(spark, sf_dir).filter("k is not null").select("ord", text.citation(ref).alias("c")).select("ord", "c.*")


@query("""SELECT sk, kind, array_to_string(list_distinct_ordered, ',') AS ids FROM (SELECT sk, kind, list(k ORDER BY f) AS list_distinct_ordered FROM (SELECT sk, kind, k, min(ord) AS f FROM ev WHERE k IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2)""")
def x34_x35_window_ids(spark, sf_dir):
    ordered = F.array_sort(F.collect_list(F.struct("ord", F.col("k").cast("string").alias("k"))))
    per = events(spark, sf_dir).filter("k is not null").groupBy("sk", "kind").agg(F.concat(F.lit("perception:w="), F.array_join(F.transform(ordered, lambda x: x.k), "+")).alias("ref"))
    return per.select("sk", "kind", F.array_join(text.ordered_distinct(text.window_ids(F.col("ref"))), ",").alias("ids"))


@query("""SELECT sk, substr(sha256('v1|' || string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord)), 1, 16) AS version_hash FROM ev GROUP BY sk""")
def x41_version_hash(spark, sf_dir):
    ids = F.array_join(F.array_sort(F.collect_list("ord")).cast("array<string>"), ",")
    return events(spark, sf_dir).groupBy("sk").agg(F.substring(F.sha2(F.concat_ws("|", F.lit("v1"), ids), 256), 1, 16).alias("version_hash"))


@query("""SELECT a.sk, a.ord, CASE WHEN a.end_ms - a.start_ms <= 18000000 THEN a.start_ms WHEN a.end_ms - a.start_ms <= 108000000 THEN (a.start_ms + a.end_ms) // 2
    ELSE coalesce((SELECT min(b.t_ms) FROM ev b WHERE b.sk = a.sk AND b.kind = 'error' AND b.t_ms BETWEEN a.start_ms AND a.end_ms), a.start_ms) END AS anchor_ms FROM iv a WHERE a.kind = 'signup'""")
def x44_clip_anchor(spark, sf_dir):
    from evidencelake.operators.joins import contains

    rows = spans(spark, sf_dir).select("sk", "ord", "kind", "t_ms", "start_ms", "end_ms")
    signals = of_kind(rows, "signup").select("sk", "ord", "start_ms", "end_ms")
    first = contains(of_kind(rows, "error").select("sk", "t_ms"), signals, ["sk"], width=24 * HOUR).groupBy("sk", F.col("b_ord").alias("ord")).agg(F.min("t_ms").alias("first_ms"))
    length = F.col("end_ms") - F.col("start_ms")
    anchor = F.when(length <= 5 * HOUR, F.col("start_ms")).when(length <= 30 * HOUR, F.floor((F.col("start_ms") + F.col("end_ms")) / 2)).otherwise(F.coalesce("first_ms", "start_ms"))
    return signals.join(first, ["sk", "ord"], "left").select("sk", "ord", anchor.alias("anchor_ms"))


# machine facts over text edits


#: Every turn of a conversation is an edit of one field, followed at once by the same text with a blank behind it (a formatter's change).
EDITS_SQL = """inp AS (SELECT conv_id AS sk, turn * 2 AS ord, turn * 1000 AS t, text FROM conversations WHERE text <> '' UNION ALL SELECT conv_id, turn * 2 + 1, turn * 1000 + 100, text || ' ' FROM conversations WHERE text <> ''),
    b AS (SELECT *, lag(text) OVER w AS before, row_number() OVER w AS n, t - lag(t) OVER w AS since FROM inp WINDOW w AS (PARTITION BY sk ORDER BY t, ord)), d AS (SELECT *, length(text) - length(before) AS delta FROM b),
    f AS (SELECT *, CASE WHEN n = 1 THEN 'TYPING_STARTED' WHEN abs(delta) < 50 AND since < 500 AND regexp_replace(before, '[\\s{}()\\[\\]<>;,''"]', '', 'g') = regexp_replace(text, '[\\s{}()\\[\\]<>;,''"]', '', 'g') THEN 'AUTOFORMAT'
        WHEN delta >= 50 THEN 'LARGE_PASTE' WHEN delta <= -10 THEN 'TEXT_CORRECTION' ELSE 'EDIT' END AS kind FROM d)"""


def typed_edits(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").filter("text != ''")
    both = rows.select(F.col("conv_id").alias("sk"), "turn", F.explode(F.array(F.struct(F.lit(0).alias("i"), F.col("text").alias("v")), F.struct(F.lit(1).alias("i"), F.concat("text", F.lit(" ")).alias("v")))).alias("x"))
    none = F.lit(None)
    inputs = both.select("sk", F.lit("field").alias("element"), none.cast("string").alias("section_type"), (2 * F.col("turn") + F.col("x.i")).alias("ord"), (1000 * F.col("turn") + 100 * F.col("x.i")).alias("t_ms"), F.col("x.v").alias("text"), none.cast("boolean").alias("is_checked"))
    return facts.edit_facts(facts.edits(inputs))


@query(f"""+ {EDITS_SQL} SELECT sk, ord, kind, delta FROM f""")
def m5_m8_edit_facts(spark, sf_dir):
    return typed_edits(spark, sf_dir).select("sk", "ord", "kind", F.col("delta").cast("bigint").alias("delta"))


@query(f"""+ {EDITS_SQL}, g AS (SELECT *, kind <> 'AUTOFORMAT' AS counted FROM f)
    SELECT sk, min(t) AS start_ms, max(t) AS end_ms, CAST(coalesce(sum(delta) FILTER (counted AND delta > 0 AND delta < 50), 0) AS BIGINT) AS inserted, CAST(count_if(counted AND delta > 0) AS BIGINT) AS insertions, CAST(count_if(counted AND delta < 0) AS BIGINT) AS deletions,
    max(length(text)) AS peak, arg_max(length(text), (t, ord)) AS final FROM g GROUP BY sk""")
def m9_typing_stopped(spark, sf_dir):
    return facts.typing_stopped(typed_edits(spark, sf_dir)).select("sk", "start_ms", "end_ms", "inserted", "insertions", "deletions", F.col("peak").cast("bigint").alias("peak"), F.col("final").cast("bigint").alias("final"))


@query("""+ a AS (SELECT sk, ord, t_ms, k, CASE WHEN kind = 'signup' THEN 'full' WHEN kind = 'error' THEN 'anchor' WHEN kind = 'click' THEN 'count' END AS role FROM ev),
    r AS (SELECT *, sum(CASE WHEN role IN ('full', 'anchor') THEN 1 ELSE 0 END) OVER (PARTITION BY sk ORDER BY t_ms, ord) AS run FROM a WHERE role IS NOT NULL),
    o AS (SELECT sk, run, ord, t_ms FROM r WHERE role = 'anchor'), c AS (SELECT sk, run, k, t_ms, row_number() OVER (PARTITION BY sk, run ORDER BY t_ms, ord) AS n FROM r WHERE role = 'count')
    SELECT o.sk, o.ord, CASE WHEN c.t_ms - o.t_ms <= 108000000 THEN c.k END AS passed FROM o LEFT JOIN c ON o.sk = c.sk AND o.run = c.run AND c.n = 1""")
def f10_test_result_pairing(spark, sf_dir):
    """An anchor waits for the next count in its run; a full match ends the run; late or missing counts stay unknown."""
    role = F.when(F.col("kind") == "signup", "full").when(F.col("kind") == "error", "anchor").when(F.col("kind") == "click", "count")
    w = Window.partitionBy("sk").orderBy("t_ms", "ord")
    rows = events(spark, sf_dir).withColumn("role", role).filter("role is not null")
    rows = rows.withColumn("run", F.sum(F.when(F.col("role") != "count", 1).otherwise(0)).over(w))
    inner = Window.partitionBy("sk", "run").orderBy("t_ms", "ord")
    rows = rows.withColumn("next_t", F.lead("t_ms").over(inner)).withColumn("next_k", F.lead("k").over(inner)).filter("role = 'anchor'")
    return rows.select("sk", "ord", F.when(F.col("next_t") - F.col("t_ms") <= 30 * HOUR, F.col("next_k")).alias("passed"))
