"""Episodes for deliberation: seeds, the inventory with ids, adjudication entries; proposed stories and signals as they come from outside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.functions.text import citation, window_ids
from evidencelake.operators import folds

#: Kinds of facts that seed an episode, and what a story must not repeat of a detector's own words (fixed values).
SEED_FACTS = (
    "LARGE_PASTE", "WINDOW_BLUR", "TAB_SWITCH", "ACTIVITY_GAP", "CODE_SUBMISSION", "SCREEN_EXTERNAL_PASTE", "SCREEN_EXTERNAL_RESOURCE",
    "SCREEN_AI_ASSISTANT_UI", "SCREEN_SECONDARY_WORKSPACE", "SCREEN_FULLSCREEN_LOST",
)
TEMPLATES = (
    r"suspicious_eye_movement\s+co-occurs", r"within\s+\d+\s*ms\)", r"median gap \d+ms", r"no external paste — answered fast after looking off-screen",
    r"overlapping rapid MCQ burst", r"factorId[=:]",
)
STORY_DEFAULTS = {"why": "Reviewer should inspect the attached proof.", "honest": "An innocent explanation may still apply."}
MERGE_GAP_MS, MOST_SPAN_MS, MOST_TIMED, MOST_REFS = 30_000, 90_000, 40, 12
NOT_ADJUDICATED, NOT_VALID = "not adjudicated by model", "candidate signal did not pass deterministic validation"


def seeds(contributions: DataFrame, findings: DataFrame, unknowns: DataFrame, facts: DataFrame) -> DataFrame:
    """One seed per contribution, flagged finding, unknown speech with windows, and fact of ten kinds.

    ``timed`` is false for contributions that rest on the cohort alone or have no time.  Ends are never before starts.
    """
    none = F.array().cast("array<string>")
    text = lambda c: F.col(c).cast("string")
    made = {
        "contributions": contributions.select(
            "sk", "ord", F.col("t0_ms").alias("t_ms"), F.greatest("t0_ms", "t1_ms").alias("end_ms"), F.lit("correlated_signal").alias("origin"), F.col("factor_id").alias("label"),
            F.array(text("ref")).alias("refs"), "section_id", "q", none.alias("hints"), F.lit(None).cast("string").alias("lane"),
            (~F.coalesce(F.col("cohort_only"), F.lit(False)) & ((F.col("t0_ms") > 0) | (F.col("t1_ms") > 0))).alias("timed"),
        ),
        "findings": findings.filter("verdict = 'flagged'").select(
            "sk", "ord", F.col("t0_ms").alias("t_ms"), F.greatest("t0_ms", "t1_ms").alias("end_ms"), F.lit("video_episode").alias("origin"), F.col("event_type").alias("label"),
            F.array("evidence_ref").alias("refs"), F.lit(None).cast("string").alias("section_id"), F.lit(None).cast("bigint").alias("q"),
            F.when(F.startswith("evidence_ref", F.lit("perception:w=")), window_ids(F.col("evidence_ref"))).otherwise(none).alias("hints"), F.lit(None).cast("string").alias("lane"), F.lit(True).alias("timed"),
        ),
        "unknowns": unknowns.filter(F.size("windows") > 0).select(
            "sk", "ord", F.col("t0_ms").alias("t_ms"), F.greatest("t0_ms", "t1_ms").alias("end_ms"), F.lit("video_episode").alias("origin"), F.coalesce("event_type", F.lit("unknown_speech")).alias("label"),
            F.array(F.concat(F.lit("perception:w="), F.array_join("windows", "+")), F.concat(F.lit("unknown:"), F.coalesce("reason", F.lit("provisional")))).alias("refs"),
            F.lit(None).cast("string").alias("section_id"), F.lit(None).cast("bigint").alias("q"), F.col("windows").alias("hints"), F.lit("amber").alias("lane"), F.lit(True).alias("timed"),
        ),
        "facts": facts.filter(F.col("kind").isin(*SEED_FACTS)).select(
            "sk", "ord", F.col("start_ms").alias("t_ms"), F.coalesce("end_ms", "start_ms").alias("end_ms"), F.lit("machine_fact").alias("origin"), F.col("kind").alias("label"),
            F.array(F.concat(F.lit("fact:"), text("ord"))).alias("refs"), "section_id", "q", none.alias("hints"), F.lit(None).cast("string").alias("lane"), F.lit(True).alias("timed"),
        ),
    }
    out = None
    for turn, rows in enumerate(made.values()):
        rows = rows.withColumn("turn", F.lit(turn))
        out = rows if out is None else out.unionByName(rows)
    return out


def clustered(timed: DataFrame, gap_ms: int = MERGE_GAP_MS, span_ms: int = MOST_SPAN_MS) -> DataFrame:
    """Seeds with the number of their cluster: as ``folds.capped_clusters``, keeping the members."""
    fields = ["t_ms", "end_ms", "turn", "ord", *[c for c in timed.columns if c not in ("sk", "t_ms", "end_ms", "turn", "ord")]]
    init = F.struct(F.lit(None).cast("bigint").alias("t0"), F.lit(None).cast("bigint").alias("t1"), F.lit(0).alias("c"), F.array().cast("array<int>").alias("out"))

    def merge(acc: Column, x: Column) -> Column:
        end = F.greatest(acc["t1"], x["end_ms"])
        joins = F.coalesce((x["t_ms"] <= acc["t1"] + gap_ms) & (end - acc["t0"] <= span_ms), F.lit(False))
        number = F.when(joins, acc["c"]).otherwise(acc["c"] + 1)
        return F.struct(
            F.when(joins, acc["t0"]).otherwise(x["t_ms"]).cast("bigint").alias("t0"), F.when(joins, end).otherwise(x["end_ms"]).cast("bigint").alias("t1"),
            number.alias("c"), F.concat(acc["out"], F.array(number)).alias("out"),
        )

    rows = folds.listed(timed, ["sk"], fields, "seeds").withColumn("clusters", F.aggregate("seeds", init, merge, lambda acc: acc["out"]))
    return rows.select("sk", F.explode(F.arrays_zip("seeds", "clusters")).alias("z")).select("sk", F.col("z.clusters").alias("cluster"), "z.seeds.*")


def in_order(value: Column, when: Column | None = None) -> Column:
    """Distinct values of a cluster in the order of its seeds; empty ones are left out."""
    row = F.struct("t_ms", "end_ms", "turn", "ord", value.alias("v"))
    keep = value.isNotNull() if when is None else value.isNotNull() & when
    return F.array_distinct(F.filter(F.transform(F.array_sort(F.collect_list(F.when(keep, row))), lambda x: x["v"]), lambda v: v != ""))


def inventory(
    seed_rows: DataFrame, facts: DataFrame, windows: DataFrame, findings: DataFrame, chains: DataFrame, most: int = MOST_TIMED, gap_ms: int = MERGE_GAP_MS, span_ms: int = MOST_SPAN_MS
) -> DataFrame:
    """Episodes ep1..n of each session: the ``most`` timed ones with the most origins (then the longest), in order of time, then session-wide ones.

    ``windows``: sk, window_id, start_ms, end_ms, eligible.  ``findings``: sk, event_type, t0_ms, t1_ms, strength, gaze_diverted.
    ``chains``: sk, factor_id, t0_ms, t1_ms, lane.
    """
    timed = clustered(seed_rows.filter("timed"), gap_ms, span_ms)
    order = F.struct("t_ms", "end_ms", "turn", "ord")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), order))
    refs = F.slice(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("t_ms", "end_ms", "turn", "ord", "refs"))), lambda x: x["refs"]))), 1, MOST_REFS)
    hints = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("t_ms", "end_ms", "turn", "ord", "hints"))), lambda x: x["hints"])))
    eps = timed.groupBy("sk", "cluster").agg(
        F.min("t_ms").alias("t0_ms"), F.max("end_ms").alias("t1_ms"), in_order(F.col("origin")).alias("origins"),
        in_order(F.col("label"), F.col("origin") == "correlated_signal").alias("factor_ids"), in_order(F.col("label"), F.col("origin") == "video_episode").alias("video_types"),
        refs.alias("refs"), hints.alias("hints"), first("section_id").alias("section_id"), first("q").alias("q"), F.bool_or(F.coalesce(F.col("lane") == "amber", F.lit(False))).alias("amber"),
    )
    eps = eps.withColumn("modalities", F.size("origins"))
    rank = F.row_number().over(Window.partitionBy("sk").orderBy(F.desc("modalities"), F.desc(F.col("t1_ms") - F.col("t0_ms")), "t0_ms"))
    eps = eps.withColumn("rank", rank).filter(F.col("rank") <= most).drop("rank")
    keys = ["sk", "cluster"]
    span = eps.select(*keys, "t0_ms", "t1_ms", "factor_ids")
    held = facts.select("sk", F.col("start_ms").alias("f_ms"), F.col("ord").alias("f_ord"), "kind")
    kinds = span.join(held, "sk").filter(F.col("f_ms").between(F.col("t0_ms"), F.col("t1_ms"))).groupBy(*keys).agg(
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("f_ms", "f_ord", "kind"))), lambda x: x["kind"])).alias("fact_kinds")
    )
    seen = windows.select("sk", "window_id", F.col("start_ms").alias("w0"), F.col("end_ms").alias("w1"), "eligible")
    met = span.join(seen.filter("eligible"), "sk").filter((F.col("w0") <= F.col("t1_ms")) & (F.col("t0_ms") <= F.col("w1")))
    met = met.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("w0", "window_id"))), lambda x: x["window_id"]).alias("met"))
    known = seen.groupBy("sk").agg(F.collect_set("window_id").alias("known"))
    chain = chains.select("sk", "factor_id", F.col("t0_ms").alias("c0"), F.col("t1_ms").alias("c1"), F.col("lane").alias("chain_lane"))
    meets = (F.col("c0") <= F.col("t1_ms")) & (F.col("t0_ms") <= F.col("c1")) & ((F.size("factor_ids") == 0) | F.array_contains("factor_ids", F.col("factor_id")))
    lane = F.when(F.bool_or(F.col("chain_lane") == "red"), "red").when(F.bool_or(F.col("chain_lane") == "amber"), "amber").otherwise(F.min("chain_lane"))
    lanes = span.join(chain, "sk").filter(meets).groupBy(*keys).agg(lane.alias("chain_lane"))
    found = findings.select("sk", "event_type", F.col("t0_ms").alias("f0"), F.col("t1_ms").alias("f1"), "strength", "gaze_diverted")
    near = span.join(found, "sk").filter((F.col("f0") <= F.col("t1_ms")) & (F.col("t0_ms") <= F.col("f1")))
    hint = F.when(F.col("strength").isNotNull(), F.concat_ws(":", "event_type", "strength"))
    strengths = near.groupBy(*keys).agg(F.array_sort(F.collect_set(hint)).alias("strength_hints"), F.bool_or(F.coalesce("gaze_diverted", F.lit(False))).alias("gaze_diverted"))
    joined = eps.join(kinds, keys, "left").join(met, keys, "left").join(lanes, keys, "left").join(strengths, keys, "left").join(known, "sk", "left")
    none = F.array().cast("array<string>")
    empty = lambda c: F.coalesce(c, none)
    whole = joined.select(
        "sk", F.lit("timed").alias("scope"), "t0_ms", "t1_ms", "origins", "factor_ids", "video_types", empty("fact_kinds").alias("fact_kinds"),
        F.coalesce("met", F.array_intersect("hints", F.coalesce("known", none))).alias("window_ids"), "refs", "modalities", "section_id", "q",
        F.coalesce("chain_lane", F.when(F.col("amber"), "amber")).alias("lane"), empty("strength_hints").alias("strength_hints"),
        F.coalesce("gaze_diverted", F.lit(False)).alias("gaze_diverted"), F.lit(0).alias("turn"), F.lit(None).cast("bigint").alias("ord"),
    )
    wide = seed_rows.filter("not timed").select(
        "sk", F.lit("session").alias("scope"), F.lit(0).cast("bigint").alias("t0_ms"), F.lit(0).cast("bigint").alias("t1_ms"), F.array("origin").alias("origins"), F.array("label").alias("factor_ids"),
        none.alias("video_types"), none.alias("fact_kinds"), none.alias("window_ids"), F.array_distinct("refs").alias("refs"), F.lit(1).alias("modalities"), "section_id", "q",
        F.lit(None).cast("string").alias("lane"), none.alias("strength_hints"), F.lit(False).alias("gaze_diverted"), F.lit(1).alias("turn"), F.col("ord").cast("bigint").alias("ord"),
    )
    number = F.row_number().over(Window.partitionBy("sk").orderBy("turn", "t0_ms", "ord"))
    return whole.unionByName(wide).withColumn("episode_id", F.concat(F.lit("ep"), number.cast("string"))).drop("turn", "ord")


def entries(episodes: DataFrame, adjudicated: DataFrame, emitted: DataFrame) -> DataFrame:
    """Every episode with what was said of it, the signals it emitted, and why it emitted none.

    ``adjudicated``: sk, episode_id, summary, behaviour, will_emit, reason.  ``emitted``: sk, episode_id, signal_id.
    """
    signals = emitted.groupBy("sk", "episode_id").agg(F.array_sort(F.collect_list("signal_id")).alias("signal_ids"))
    rows = episodes.join(adjudicated.withColumn("said", F.lit(True)), ["sk", "episode_id"], "left").join(signals, ["sk", "episode_id"], "left")
    emits = F.coalesce(F.size("signal_ids") > 0, F.lit(False))
    reason = F.when(~emits, F.when(F.col("said") & ~F.col("will_emit"), F.col("reason")).when(F.col("said"), F.lit(NOT_VALID)).otherwise(F.lit(NOT_ADJUDICATED)))
    return rows.select(
        "sk", "episode_id", "scope", F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("behaviour", F.lit("none")).alias("behaviour"), emits.alias("emits"),
        reason.alias("reason"), F.coalesce("signal_ids", F.array().cast("array<string>")).alias("signal_ids"),
    )


def int_list(raw: Column) -> Column:
    """A JSON number or list as whole numbers: digit strings count, booleans and other text do not."""
    items = F.coalesce(F.from_json(raw, "array<string>"), F.when(raw.rlike(r"^-?\d+(\.\d+)?$"), F.array(raw)), F.array().cast("array<string>"))
    number = lambda x: F.when(F.trim(x).rlike(r"^-?\d+(\.\d+)?$"), F.floor(F.trim(x).try_cast("double")).cast("bigint"))
    return F.array_compact(F.transform(items, number))


def str_list(raw: Column) -> Column:
    """A JSON string or list as trimmed texts that are not blank."""
    single = F.when(raw.rlike(r"^[^\[{]"), F.array(F.trim(raw)))
    items = F.coalesce(F.from_json(raw, "array<string>"), single, F.array().cast("array<string>"))
    return F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def window_list(raw: Column) -> Column:
    """Window ids of a list whose items are texts or objects with windowId."""
    items = F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>"))
    of = lambda x: F.when(F.startswith(x, F.lit("{")), F.coalesce(F.get_json_object(x, "$.windowId"), F.get_json_object(x, "$.window_id"))).otherwise(F.nullif(F.trim(x), F.lit("")))
    return F.array_compact(F.transform(items, of))


def story(raw: Column) -> Column:
    """A proposed story as a struct; null without a headline or an account, and where it repeats a detector's own words."""
    at = lambda *names: F.trim(F.coalesce(*[F.get_json_object(raw, f"$.{n}") for n in names], F.lit("")))
    headline, what = at("headline"), at("whatHappened", "what_happened")
    why, honest = at("whyItMatters", "why_it_matters"), at("honestAlternative", "honest_alternative")
    anchors = F.coalesce(F.get_json_object(raw, "$.proofAnchors"), F.get_json_object(raw, "$.proof_anchors"))
    listed = F.startswith(anchors, F.lit("["))
    part = lambda camel, snake: F.coalesce(F.get_json_object(anchors, f"$.{camel}"), F.get_json_object(anchors, f"$.{snake}"))
    severity = F.lower(at("severity"))
    echo = F.concat_ws("\n", headline, what, why).rlike("(?i)" + "|".join(TEMPLATES))
    windows = F.when(F.coalesce(listed, F.lit(False)), window_list(anchors)).otherwise(str_list(part("windowIds", "window_ids")))
    whole = F.struct(
        headline.alias("headline"), what.alias("what"), F.coalesce(F.nullif(why, F.lit("")), F.lit(STORY_DEFAULTS["why"])).alias("why"),
        F.coalesce(F.nullif(honest, F.lit("")), F.lit(STORY_DEFAULTS["honest"])).alias("honest"), F.when(severity.isin("probable", "weak"), severity).otherwise("suspicious").alias("severity"),
        int_list(F.coalesce(F.get_json_object(raw, "$.involvedQuestions"), F.get_json_object(raw, "$.involved_questions"))).alias("questions"), windows.alias("window_ids"),
        int_list(part("seekMsHints", "seek_ms_hints")).alias("seek_ms"), str_list(part("factorIds", "factor_ids")).alias("factor_ids"),
    )
    return F.when((headline != "") & (what != "") & ~echo, whole)


def source_types(facts: Column, observations: Column, metrics: Column) -> Column:
    """Kinds of evidence that a signal cites; one citation of audio makes its observations audio."""
    audio = F.exists(observations, lambda r: F.startswith(F.coalesce(citation(r)["path"], F.lit("")), F.lit("audio.")))
    return F.array_compact(F.array(
        F.when(F.size(facts) > 0, "machine_fact"), F.when(F.size(observations) > 0, F.when(audio, "audio_observation").otherwise("visual_observation")),
        F.when(F.size(metrics) > 0, "statistical_baseline"),
    ))


def time_range(seek_ms: Column, observations: Column) -> Column:
    """(start, end) of a signal: its hints, else the windows w_{start}_{end} that it cites; null without either."""
    part = lambda i: lambda r: F.nullif(F.regexp_extract(r, r"^w_(-?\d+)_(-?\d+)", i), F.lit("")).try_cast("bigint")
    starts, ends = (F.array_compact(F.transform(observations, part(i))) for i in (1, 2))
    hinted = F.size(seek_ms) > 0
    return F.when(hinted, F.struct(F.array_min(seek_ms).alias("start_ms"), F.array_max(seek_ms).alias("end_ms"))).when(
        F.size(starts) > 0, F.struct(F.array_min(starts).alias("start_ms"), F.array_max(ends).alias("end_ms"))
    )


def midpoint(start: Column, end: Column) -> Column:
    """The middle of a span; 0 where a side is missing."""
    return F.coalesce((start + end) / 2.0, F.lit(0.0))


def finding_source(source: Column) -> Column:
    return F.when(source == "screen", "screen_observation").when(source == "keystroke", "machine_fact").otherwise("visual_observation")


def category(signals: DataFrame) -> DataFrame:
    """Per session, from the signals alone: CLEAR without an active one, STRONG_EVIDENCE if one is assisted and two kinds of evidence meet."""
    active = F.col("resolution") != "honest"
    per = signals.groupBy("sk").agg(
        F.count_if(active).alias("n"), F.coalesce(F.bool_or(F.when(active, F.col("resolution") == "assisted")), F.lit(False)).alias("assisted"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.when(active, F.col("sources")))))).alias("kinds"), F.coalesce(F.max(F.when(active, F.col("confidence"))), F.lit(0)).alias("confidence"),
    )
    said = F.when(F.col("n") == 0, "CLEAR").when(F.col("assisted") & (F.col("kinds") >= 2), "STRONG_EVIDENCE").otherwise("REVIEW_REQUIRED")
    return per.select("sk", said.alias("category"), "confidence")


def contextual_rows(events: DataFrame) -> DataFrame:
    """Contextual speech with its proof flattened; missing clips are 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return events.select("sk", "event_type", "t0_ms", "t1_ms", zero("clip_start_ms"), zero("clip_end_ms"), "proof.said", "proof.language", "proof.code_mixing")


def key_reasons(signals: DataFrame, most: int = 5) -> DataFrame:
    """Per session the reasons given, in order, or else the distinct headlines of its signals."""
    given = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", "reasons"))), lambda x: F.coalesce(x["reasons"], F.array().cast("array<string>"))))
    heads = F.transform(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("headline", "label").alias("h")))), lambda x: x["h"])
    rows = signals.groupBy("sk").agg(F.array_distinct(F.filter(given, lambda r: r != "")).alias("given"), F.array_distinct(F.array_compact(heads)).alias("heads"))
    return rows.select("sk", F.slice(F.when(F.size("given") > 0, F.col("given")).otherwise(F.col("heads")), 1, most).alias("reasons"))
