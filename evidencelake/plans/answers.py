"""Answers and result panels of recorded pages: choices among options, and test results put together from several changes.

A session's option rows are folded in order with built-in higher-order functions, as a link depends on which earlier choices are
still free; panels need no fold, as a window of counts between openers says the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.functions.text import TEST_RESULT
from evidencelake.operators.folds import fold
from evidencelake.plans.facts import SWITCH_MS, inputs_by_role

#: Fixed patterns and times of result panels.
PANEL = r"(?i)test\s+cases?\s+(?:passed|failed|run)"
COUNT_ONLY = r"^(\d+)\s*/\s*(\d+)\z"
PANEL_MS = 3_000

RECENT = "array<struct<e:string,t:bigint,s:string>>"
MEMBERS = "array<struct<e:string,g:string>>"
GROUPS = "array<struct<g:string,option:string,s:string,changes:bigint,n:bigint,first:bigint,last:bigint>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def found(rows: Column, when: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(rows, when), F.lit(0))


def put(rows: Column, new: Column) -> Column:
    """``rows`` with ``new`` in the place of the row of the same element, or else behind the others."""
    same = lambda r: r["e"] == new["e"]
    return F.when(F.exists(rows, same), F.transform(rows, lambda r: F.when(same(r), new).otherwise(r))).otherwise(F.concat(rows, F.array(new)))


def without(rows: Column, element: Column) -> Column:
    return F.filter(rows, lambda r: r["e"] != element)


def option_rows(inputs: DataFrame) -> DataFrame:
    """The input rows that choose or drop an option."""
    return inputs_by_role(inputs).filter("role = 'mcq_radio'")


def selections(options: DataFrame) -> DataFrame:
    """One fact per choice of an option."""
    return options.filter("is_checked").select("sk", "ord", "t_ms", "section_id", "element", F.col("text").alias("option"))


def option_groups(options: DataFrame, switch_ms: int = SWITCH_MS) -> DataFrame:
    """Option rows (sk, section_id, element, ord, t_ms, text, is_checked) to answer groups with selections and changes.

    A dropped option joins the group of the first choice in its section at most ``switch_ms`` earlier, and uses that choice up; a
    chosen option without a group does the same with the first dropped one.  A change is another text than the group's last
    one.  Rows with an unknown ``is_checked`` are none of these; unknown sections are one section.
    """

    def step(acc: Column, x: Column) -> Column:
        near = lambda r: r["s"].eqNullSafe(x["s"]) & (x["t"] - r["t"] <= switch_ms)
        hit = F.when(x["on"], found(acc["dropped"], near)).otherwise(found(acc["chosen"], near))["e"]
        group = lambda e: found(acc["members"], lambda m: m["e"] == e)["g"]
        seen = F.struct(hit.alias("hit"), group(x["e"]).alias("own"))
        return let(seen, lambda s: let(F.coalesce(group(s["hit"]), s["hit"]), lambda other: F.when(x["on"], chosen(acc, x, s, other)).otherwise(dropped(acc, x, s, other))))

    def state(chosen: Column, dropped: Column, members: Column, groups: Column) -> Column:
        return F.struct(chosen.alias("chosen"), dropped.alias("dropped"), members.alias("members"), groups.alias("groups"))

    def recent(x: Column) -> Column:
        return F.struct(x["e"].alias("e"), x["t"].alias("t"), x["s"].alias("s"))

    def member(x: Column, g: Column) -> Column:
        return F.struct(x["e"].alias("e"), g.alias("g"))

    def dropped(acc: Column, x: Column, s: Column, other: Column) -> Column:
        moves = s["hit"].isNotNull() & (other != F.coalesce(s["own"], x["e"]))
        changed = lambda g: F.when((g["g"] == other) & (g["option"] != x["text"]), g.withField("changes", g["changes"] + 1)).otherwise(g)
        return state(
            F.when(s["hit"].isNotNull(), without(acc["chosen"], s["hit"])).otherwise(acc["chosen"]), put(acc["dropped"], recent(x)),
            F.when(moves, put(acc["members"], member(x, other))).otherwise(acc["members"]), F.when(moves, F.transform(acc["groups"], changed)).otherwise(acc["groups"]),
        )

    def chosen(acc: Column, x: Column, s: Column, other: Column) -> Column:
        links = s["own"].isNull() & s["hit"].isNotNull()
        return let(F.coalesce(s["own"], other, x["e"]), lambda g: state(
            put(acc["chosen"], recent(x)), F.when(links, without(acc["dropped"], s["hit"])).otherwise(acc["dropped"]),
            F.when(s["own"].isNull(), put(acc["members"], member(x, g))).otherwise(acc["members"]), counted(acc["groups"], x, g),
        ))

    def counted(groups: Column, x: Column, g: Column) -> Column:
        one = F.lit(1).cast("bigint")
        new = F.struct(g.alias("g"), x["text"].alias("option"), x["s"].alias("s"), F.lit(0).cast("bigint").alias("changes"), one.alias("n"), x["t"].alias("first"), x["t"].alias("last"))
        more = lambda r: F.struct(
            r["g"].alias("g"), x["text"].alias("option"), r["s"].alias("s"), (r["changes"] + F.when(r["option"] != x["text"], 1).otherwise(0)).alias("changes"),
            (r["n"] + 1).alias("n"), r["first"].alias("first"), x["t"].alias("last"),
        )
        there = F.exists(groups, lambda r: r["g"] == g)
        return F.when(there, F.transform(groups, lambda r: F.when(r["g"] == g, more(r)).otherwise(r))).otherwise(F.concat(groups, F.array(new)))

    rows = options.filter("is_checked is not null and element is not null")
    fields = [
        F.col("t_ms").cast("bigint").alias("t"), F.col("ord").alias("o"), F.col("element").cast("string").alias("e"), F.col("section_id").cast("string").alias("s"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("is_checked").alias("on"),
    ]
    empty = lambda kind: F.array().cast(kind)
    init = state(empty(RECENT), empty(RECENT), empty(MEMBERS), empty(GROUPS))
    done = fold(rows, ["sk"], fields, init, step, "groups", lambda acc: acc["groups"])
    names = {"g": "answer_group", "s": "section_id", "n": "n_selected", "changes": "n_changes", "first": "first_ms", "last": "last_ms"}
    return done.select("sk", F.explode("groups").alias("g")).select("sk", *[F.col(f"g.{a}").alias(b) for a, b in names.items()])


def changes(groups: DataFrame) -> DataFrame:
    """One fact per answer group whose answer changed, at its last choice."""
    return groups.filter("n_changes >= 1").select("sk", "answer_group", "section_id", F.col("last_ms").alias("t_ms"), "n_changes")


def test_results(mutations: DataFrame, within_ms: int = PANEL_MS) -> DataFrame:
    """Page changes (sk, section_id, section_type, ord, t_ms, texts) of coding sections to observed test results.

    A change that holds the wording and the counts is a result.  Wording alone waits for the first later change with counts alone,
    at most ``within_ms`` later, unless another result or wording comes first; the last wording of a section that never met its
    counts gives a result with unknown counts.  Unknown sections are one section.
    """
    texts = F.filter(F.transform("texts", lambda t: F.trim(t)), lambda t: t != "")
    first = lambda pattern: found(F.col("texts"), lambda t: t.rlike(pattern))
    rows = mutations.filter(F.col("section_type").rlike("(?i)coding")).withColumn("texts", texts)
    rows = rows.withColumns({"full": first(TEST_RESULT), "panel": first(PANEL), "count": first(COUNT_ONLY)})
    role = F.when(F.col("full").isNotNull() | (F.col("panel").isNotNull() & F.col("count").isNotNull()), "whole").when(F.col("panel").isNotNull(), "panel").when(F.col("count").isNotNull(), "count")
    rows = rows.withColumn("role", role).filter("role is not null").withColumn("key", F.coalesce("section_id", F.lit("unknown")))
    section = Window.partitionBy("sk", "key")
    rows = rows.withColumn("run", F.sum((F.col("role") != "count").cast("int")).over(section.orderBy("t_ms", "ord")))
    run = Window.partitionBy("sk", "key", "run").orderBy("t_ms", "ord")
    rows = rows.withColumns({"later": F.lead("count").over(run), "later_ms": F.lead("t_ms").over(run), "last_run": F.max("run").over(section)}).filter("role <> 'count'")
    meets = (F.col("role") == "panel") & F.coalesce(F.col("later_ms") - F.col("t_ms") <= within_ms, F.lit(False))
    counts = F.when(meets, F.col("later")).when(F.col("role") == "whole", F.coalesce("full", "count"))
    number = lambda i: F.when(F.col("full").isNotNull(), F.regexp_extract("full", TEST_RESULT, i)).otherwise(F.regexp_extract("counts", COUNT_ONLY, i)).try_cast("bigint")
    joined = F.concat("panel", F.lit(" [count:"), "counts", F.lit("]"))
    rows = rows.withColumn("counts", counts).filter((F.col("role") == "whole") | meets | (F.col("run") == F.col("last_run")))
    return rows.select(
        "sk", "section_id", "ord", F.col("t_ms").alias("start_ms"), F.when(meets, F.col("later_ms")).otherwise(F.col("t_ms")).alias("end_ms"),
        number(1).alias("passed"), number(2).alias("total"), F.coalesce("full", joined, "panel").alias("raw_text"),
    )
