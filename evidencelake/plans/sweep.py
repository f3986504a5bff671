"""All risk detectors in a few passes over one tagged event table.

Every event of a session is one row with a role.  What a detector compares are two windows of time, one around an event A
and one of an event B: "B soon after A" is a window behind A's end and a point, an overlap is two spans.  ``Rule`` says which roles
and windows meet, and one join serves all rules; two more prepare what rules ask of single rows, and serve the detectors
that look at three events.

The results are those of the detectors in ``risk``, row by row.  Rows are told apart inside a role by ``ord``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.operators import folds
from evidencelake.plans import risk

HOUR = 3_600_000
INPUT, SEEN = ("answer", "paste"), ("phone", "person")
#: Columns of a tagged row beside sk, role, ord and its span; rows lack those that their role has no use for.
EXTRA = {"q": "bigint", "sec": "string", "chars": "bigint", "hard": "boolean", "whisper": "boolean", "n": "bigint"}
FLAGS = {"pasted": "boolean", "first_input": "bigint", "after_blur": "boolean", "last_blur": "bigint"}
BASE = {"role": "string", "ord": "bigint", "start_ms": "bigint", "end_ms": "bigint"}

SAME_Q = "(q is null or b_q is null or q = b_q)"
SAME_SEC = "(sec is null or b_sec is null or sec = '' or b_sec = '' or sec = b_sec)"


#: A bound of a rule's window.
WINDOW = re.compile(r"(start_ms|end_ms)(?: ([+-]) (\d+))?")


@dataclass(frozen=True)
class Rule:
    """A of the roles ``a`` meets B of the roles ``b`` where their windows touch and ``where`` holds.

    Conditions and amounts are SQL over the columns of A and, with the prefix b_, of B; as text they cost a plan no calls.
    """

    name: str
    a: tuple[str, ...]
    b: tuple[str, ...]
    a_window: tuple[str, str]
    b_window: tuple[str, str]
    width: int
    where: str = ""
    factor: str = ""
    intensity: str = "0D"
    t0: str = "start_ms"
    t1: str = "b_start_ms"
    q: str = "b_q"
    #: Of the pairs with equal values in these columns the first in this order (two numbers) is kept, and then only if ``still`` holds.
    pick: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    still: str = "true"

    def gives(self, factor: str, intensity: str, t0: str = "start_ms", t1: str = "b_start_ms", q: str = "b_q") -> Rule:
        return replace(self, factor=factor, intensity=intensity, t0=t0, t1=t1, q=q)

    def first(self, by: str, *order: str, still: str = "true") -> Rule:
        return replace(self, pick=(by,), order=order, still=still)


def roles(x: str | Sequence[str]) -> tuple[str, ...]:
    return (x,) if isinstance(x, str) else tuple(x)


def follow(name: str, a, b, within: int, lead: int = 0, where: str = "", at: str = "start_ms") -> Rule:
    return Rule(name, roles(a), roles(b), (f"end_ms - {lead}", f"end_ms + {within}"), (at, at), within + lead + 1, where)


def overlap(name: str, a, b, pad: int = 0, where: str = "") -> Rule:
    return Rule(name, roles(a), roles(b), (f"start_ms - {pad}", f"end_ms + {pad}"), ("start_ms", "end_ms"), max(HOUR, 2 * pad), where)


def tag(rows: DataFrame, role: str) -> DataFrame:
    """``rows`` in the columns of tagged rows."""
    has = set(rows.columns)
    column = lambda c, t: f"cast({c if c in has else 'null'} as {t}) as {c}"
    return rows.selectExpr("sk", f"'{role}' as role", *[column(c, t) for c, t in (BASE | EXTRA).items() if c != "role"])


def tagged(e: risk.EventTables) -> DataFrame:
    """The tables of ``e`` as one."""
    out = None
    for role in (f for f in e.__dataclass_fields__ if f != "config"):
        part = tag(getattr(e, role), role)
        out = part if out is None else out.unionByName(part)
    return out


def tables(rows: DataFrame, config: risk.Config) -> risk.EventTables:
    """Tagged rows cut into the tables of single detectors."""
    names = [f for f in risk.EventTables.__dataclass_fields__ if f != "config"]
    return risk.EventTables(**{role: rows.filter(F.col("role") == role).drop("role") for role in names}, config=config)


def met(rows: DataFrame, rules: Sequence[Rule], columns: Sequence[str], b_columns: Sequence[str] | None = None) -> DataFrame:
    """(sk, rule, columns of A, columns of B with b_, by default the same): each pair of each rule once.

    A row is laid into the buckets of time that its rules' windows touch; A and B meet in a bucket, and are compared in the
    one where the later window starts.  The join's key is session, rule and bucket, so a session of any length is spread.
    """

    own = [list(dict.fromkeys([*c, "start_ms", "end_ms"])) for c in (columns, columns if b_columns is None else b_columns)]

    def laid(side: int) -> DataFrame:
        # an entry travels with its rule's number; the rule's name, windows and width are looked up again behind the join
        entries: dict[str, list[str]] = {}
        for i, r in enumerate(rules):
            for role in (r.a, r.b)[side]:
                lo, hi = (r.a_window, r.b_window)[side]
                entries.setdefault(role, []).append(f"named_struct('rule', {i}, 'lo', bigint({lo}), 'hi', bigint({hi}), 'width', bigint({r.width}))")
        wanted = "case role " + " ".join(f"when '{role}' then array({', '.join(found)})" for role, found in entries.items()) + " end"
        spread = rows.filter(F.col("role").isin(*entries)).selectExpr("sk", *own[side], f"inline({wanted})")
        return spread.withColumn("bucket", F.expr("explode(sequence(floor(lo / width), floor(greatest(lo, hi) / width)))")).drop("lo", "hi", "width")

    keys = ["sk", "rule", "bucket"]
    pairs = laid(0).join(laid(1).selectExpr(*keys, *[f"{c} as b_{c}" for c in own[1]]), keys)
    look_up = lambda values: f"element_at(array({', '.join(map(str, values))}), rule + 1)"

    def window(side: int, end: int) -> str:
        parts = [WINDOW.fullmatch((r.a_window, r.b_window)[side][end]) for r in rules]
        at_end = look_up(["true" if p[1] == "end_ms" else "false" for p in parts])
        prefix = ("", "b_")[side]
        return f"(if({at_end}, {prefix}end_ms, {prefix}start_ms) + {look_up([f'bigint({p[2] or chr(43)}{p[3] or 0})' for p in parts])})"

    lo, hi, b_lo, b_hi, width = window(0, 0), window(0, 1), window(1, 0), window(1, 1), look_up([f"bigint({r.width})" for r in rules])
    touch = f"{lo} <= {b_hi} and {b_lo} <= {hi} and floor(greatest({lo}, {b_lo}) / {width}) = bucket"
    wheres = " ".join(f"when {i} then {r.where}" for i, r in enumerate(rules) if r.where)
    pairs = pairs.filter(f"{touch} and {f'case rule {wheres} else true end' if wheres else 'true'}")
    pairs = pairs.withColumn("rule", F.expr(look_up([f"'{r.name}'" for r in rules])))
    return pairs.select("sk", "rule", *own[0], *[f"b_{c}" for c in own[1]])


def used(rules: Sequence[Rule], columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """The columns of A and those of B that the rules' conditions, picks and amounts name."""
    text = " ".join(" ".join((r.where, r.intensity, r.t0, r.t1, r.q, *r.pick, *r.order, r.still)) for r in rules)
    named = set(re.findall(r"\w+", text)) | {"ord", "b_ord"}
    return [c for c in columns if c in named], [c for c in columns if f"b_{c}" in named]


def by_rule(values: dict[str, str], otherwise: str = "null") -> str:
    """An SQL expression that depends on the pair's rule."""
    return "case rule " + " ".join(f"when '{name}' then {value}" for name, value in values.items()) + f" else {otherwise} end" if values else otherwise


def flagged(rows: DataFrame, c: risk.Config) -> DataFrame:
    """Tagged rows with what detectors ask of single rows.

    pasted and first_input of questions (a paste inside; the first input around it), after_blur of pastes, last_blur: the
    start of the last blur before a row.
    """
    rules = [
        overlap("pasted", "question", "paste", where=SAME_Q),
        overlap("first_input", "question", INPUT, c.pad, where=SAME_Q),
        follow("after_blur", "blur", "paste", c.blur_to_paste),
    ]
    pairs = met(rows, rules, ["role", "ord", "start_ms", "end_ms", "q"])
    marks = pairs.selectExpr(
        "sk", "if(rule = 'after_blur', b_role, role) as role", "if(rule = 'after_blur', b_ord, ord) as ord", "if(rule = 'pasted', true, null) as pasted",
        "if(rule = 'first_input', b_start_ms, null) as first_input", "if(rule = 'after_blur', true, null) as after_blur", "true as mark",
    )
    both = rows.withColumn("mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    own = Window.partitionBy("sk", "role", "ord")
    none = F.lit(False)
    held = both.withColumns({"pasted": F.coalesce(F.max("pasted").over(own), none), "first_input": F.min("first_input").over(own), "after_blur": F.coalesce(F.max("after_blur").over(own), none)})
    earlier = Window.partitionBy("sk").orderBy("start_ms").rangeBetween(Window.unboundedPreceding, -1)
    return held.filter("not mark").drop("mark").withColumn("last_blur", F.max(F.when(F.col("role") == "blur", F.col("start_ms"))).over(earlier))


def faded(within: int, least: float) -> str:
    return f"greatest({least}D, 1D - (b_start_ms - end_ms) / {float(within)}D)"


def pair_rules(c: risk.Config) -> list[Rule]:
    """The detectors that compare two events."""
    free, pasted, end = "not b_pasted", "b_pasted", "b_end_ms"
    coaching = c.speech_to_question
    around = f"start_ms - {coaching} <= b_end_ms and b_start_ms <= end_ms + {coaching}"
    return [
        follow("d1", "blur", "paste", c.blur_to_paste, where=SAME_SEC).first("b_ord", "start_ms", "ord").gives("paste_after_blur", faded(c.blur_to_paste, 0.35)),
        follow("d2", "gap", "paste", c.idle_to_paste).first("b_ord", "start_ms", "ord").gives("idle_then_large_paste", faded(c.idle_to_paste, 0.35)),
        overlap("d3_paste", SEEN, "paste", c.pad, where="b_after_blur").first("ord", "b_start_ms", "b_ord").gives("video_overlap_paste", "0.8D"),
        overlap("d3_submission", SEEN, "submission", c.pad).gives("video_overlap_submission", "0.8D"),
        overlap("d5", "question", "paste", where=f"hard and {SAME_Q}").first("ord", "-b_start_ms", "b_ord").gives("improbable_hard_fast_paste", "0.9D", t1="end_ms", q="q"),
        overlap("d7", "phone", "question", c.pad).gives("phone_fast_correct", "0.85D", t1=end),
        overlap("d8", "phone", "burst", c.pad).gives("phone_fast_mcq_answers", "0.6D + 0.05D * b_n", t1=end, q="null"),
        overlap("d9", "gaze", "question", where=free).gives("gaze_fast_correct", "0.7D", t1=end),
        overlap("d10", "gaze", "phone", c.device_pad).gives("gaze_with_device", "0.75D", t1=end, q="null"),
        follow("d11", "gaze", "answer", c.gaze_to_answer).first("ord", "b_start_ms", "b_ord", still="coalesce(b_last_blur <= end_ms, true)")
        .gives("gaze_then_answer_commit", "0.5D + 0.1D * least(left_over, 5)"),
        follow("d12", "speech", "question", c.speech_to_question, c.speech_lead, where="b_hard").gives("speech_then_correct_hard", "0.8D", t1=end),
        follow("d13", "speech", "paste", c.speech_to_paste, where="whisper").gives("whisper_then_paste", "0.8D"),
        follow("d14", "speech", INPUT, c.speech_to_input, where="not whisper").gives("av_mismatch_then_input", "0.75D"),
        follow("d16_free", "blur", "question", c.blur_to_question, where=free, at="end_ms").gives("blur_fast_correct", "0.7D", t1=end),
        follow("d16_pasted", "blur", "question", c.blur_to_question, where=pasted, at="end_ms").gives("paste_after_blur", "0.95D", t1=end),
        overlap("d17_free", "absence", "question", where=free).gives("camera_absent_fast_correct", "0.7D", t1=end),
        overlap("d17_pasted", "absence", "question", where=pasted).gives("paste_after_blur", "0.9D", t1=end),
        overlap("d19", "stretch", "blur", c.bucket).first("ord", "b_start_ms", "b_ord").gives("large_unattributed_gap", "0.6D", t1="end_ms", q="null"),
        follow("d20", "absence", "paste", c.absence_to_paste).gives("face_absent_then_paste", "0.75D"),
        follow("d21", "person", "paste", c.speech_to_paste, c.pad).gives("external_resource_then_paste", "0.5D + least(0.4D, b_chars / 200D)"),
        overlap("d22", "absence", INPUT, c.pad).gives("face_absent_during_input", "0.7D"),
        overlap("d23", "gaze", "burst").gives("gaze_then_correct_mcq_burst", "0.65D", t1=end, q="null"),
        follow("d24", "speech", "question", coaching, c.speech_lead, where=around).gives("speech_coaching_then_fast_correct", "0.85D", t1=end),
        follow("d25_paste", "person", "paste", c.absence_to_paste).gives("second_person_then_paste_or_correct", "0.8D"),
        overlap("d25_question", "person", "question").gives("second_person_then_paste_or_correct", "0.8D", t1=end),
        follow("d26", "gap", "question", c.gap_to_question, where=free).gives("idle_gap_then_fast_correct", "0.7D", t1=end),
        overlap("d28", ("person", "speech"), "question", c.pad, where="b_first_input >= start_ms - 2000").gives("interact_speech_input_correct", "0.85D", t1=end),
    ]


def contributions(pairs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """What pairs give, each by its rule."""
    of = lambda f: by_rule({r.name: f(r) for r in rules})
    score = of(lambda r: f"floor(least(1D, greatest(0D, {r.intensity})) * {float(1000 * risk.WEIGHTS[r.factor])}D)")
    return pairs.selectExpr(
        "sk", of(lambda r: f"'{r.factor}'") + " as factor_id", of(lambda r: r.t0) + " as t0_ms", of(lambda r: r.t1) + " as t1_ms",
        f"bigint({of(lambda r: r.q)}) as q", f"bigint({score}) as score_milli",
    )


def picked(pairs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All pairs of rules without a pick, the first pair of each group of the others; ``left_over``: how many of a rule stay in the session."""
    by = ", ".join(by_rule({r.name: c for r in rules if c in r.pick or not r.pick}) for c in ("ord", "b_ord"))
    order = ", ".join(by_rule({r.name: r.order[i] for r in rules if r.pick}) for i in (0, 1))
    rows = pairs.withColumn("place", F.expr(f"row_number() over (partition by sk, rule, {by} order by {order})"))
    picks = ", ".join(f"'{r.name}'" for r in rules if r.pick)
    rows = rows.filter(f"place = 1 or rule not in ({picks})").filter(by_rule({r.name: r.still for r in rules if r.pick}, "true")).drop("place")
    return rows.withColumn("left_over", F.expr("count(*) over (partition by sk, rule)"))


def stretches(rows: DataFrame, c: risk.Config) -> DataFrame:
    """Sections whose questions leave a long time unaccounted for."""
    by = rows.filter("role = 'question'").groupBy("sk", "sec").agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("known")
    ).filter(F.col("end_ms") - F.col("start_ms") - F.col("known") >= c.unattributed)
    return tag(by.withColumn("ord", F.row_number().over(Window.partitionBy("sk").orderBy("sec"))), "stretch")


def of_one_kind(rows: DataFrame, c: risk.Config) -> DataFrame:
    """The detectors that look at pastes, submissions or corrections alone, or at pastes with a correction near (d6, d18, d27)."""
    emit, sums = risk.contribution, [F.count("*").alias("n"), F.min("start_ms").alias("t0"), F.max("start_ms").alias("t1")]
    pastes = rows.filter("role = 'paste'").groupBy("sk", "q").agg(*sums, F.max("chars").alias("most")).filter((F.col("n") >= 2) | (F.col("most") >= c.large_chars))
    w = Window.partitionBy("sk").orderBy("start_ms", "ord")
    back = rows.filter("role = 'submission'").withColumn("down", F.col("q") < F.lag("q").over(w)).groupBy("sk").agg(*sums, F.count_if("down").alias("r")).filter("n >= 3 and r >= 2")
    near = met(rows, [follow("d27", "paste", "correction", c.correction_lag, c.correction_lead)], ["ord", "start_ms", "end_ms", "q"])
    fixed = near.select("sk", "ord", "q", "start_ms").distinct().groupBy("sk", "q").agg(*sums).filter("n >= 2")
    session = rows.filter("role = 'correction'").groupBy("sk").agg(*sums).filter("n >= 2")
    both = fixed.withColumn("of_q", F.lit(True)).unionByName(session.withColumn("of_q", F.lit(False)), allowMissingColumns=True)
    both = both.withColumn("any_q", F.max("of_q").over(Window.partitionBy("sk"))).filter("of_q or not any_q")
    flow = F.when(F.col("of_q"), F.lit(0.9)).otherwise(F.lit(0.5))
    return (
        emit(pastes, "paste_on_coding_question", 0.5 + 0.2 * F.col("n"), "t0", "t1", "q")
        .unionByName(emit(back, "out_of_order_submission_hop", 0.4 + 0.15 * F.col("r"), "t0", "t1"))
        .unionByName(emit(both, "deterministic_paste_workflow", flow, "t0", "t1", "q"))
    )


def gaze_then_input(rows: DataFrame, c: risk.Config) -> DataFrame:
    """Each gaze takes the nearest input that no earlier one took (d4)."""
    limit = c.gaze_to_input
    inputs = rows.filter(F.col("role").isin(*INPUT)).select("sk", "start_ms", "ord", F.struct("start_ms", "ord", "q").alias("b"))
    gaze = rows.filter("role = 'gaze'").select("sk", "start_ms", "end_ms", "ord", F.struct("start_ms", "end_ms").alias("a"))
    taken = folds.greedy_pairs(
        gaze, inputs, ["sk"], lambda x, y: (y["start_ms"] >= x["end_ms"]) & (y["start_ms"] - x["end_ms"] <= limit), lambda x, y: y["start_ms"] - x["end_ms"],
        ["start_ms", "ord", "end_ms", "a"], ["start_ms", "ord", "b"], "a", "b", reach=lambda a: (F.col("start_ms"), F.col("end_ms") + limit),
    )
    pairs = taken.select("sk", "a.start_ms", "a.end_ms", F.col("b_b.start_ms").alias("b_start_ms"), F.col("b_b.q").alias("b_q"))
    return risk.contribution(pairs, "gaze_off_then_input", F.expr(faded(limit, 0.4)), "start_ms", "b_start_ms", "b_q")


def gaze_speech_answer(rows: DataFrame, c: risk.Config) -> DataFrame:
    """A gaze, then speech, then an answer (d15)."""
    first = met(rows, [follow("talk", "gaze", "speech", c.speech_to_paste)], ["ord", "start_ms", "end_ms"])
    talks = first.select("sk", F.lit("talk").alias("role"), F.col("b_start_ms").alias("end_ms"), "start_ms")
    answers = rows.filter("role = 'answer'").select("sk", "role", "start_ms", "end_ms", "q")
    chain = met(talks.unionByName(answers, allowMissingColumns=True), [follow("d15", "talk", "answer", c.speech_to_question)], ["start_ms", "end_ms", "q"])
    return risk.contribution(chain, "gaze_off_then_speech_then_answer", 0.85, "start_ms", "b_start_ms", "b_q")


def detect(rows: DataFrame, config: risk.Config) -> DataFrame:
    """The contributions of all 28 detectors to tagged rows that are gathered by session (``risk.by_session``)."""
    known = flagged(rows, config)
    known = known.unionByName(stretches(rows, config), allowMissingColumns=True)
    rules = pair_rules(config)
    out = contributions(picked(met(known, rules, *used(rules, [*BASE, *EXTRA, *FLAGS])), rules), rules)
    return out.unionByName(of_one_kind(rows, config)).unionByName(gaze_then_input(rows, config)).unionByName(gaze_speech_answer(rows, config))
