"""Scalar functions on text edits, labels and citations, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed patterns of the input roles.
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
UI_LABEL = "NO INPUT REQUIRED FOR THIS QUESTION"
DIGITS_ONLY = r"^[\d\s.,;:\-+\[\](){}]+$"
TEST_RESULT = r"(?i)(\d+)\s*/\s*(\d+)\s+test\s+cases?\s+passed"


def input_role(text: Column, is_checked: Column, section_type: Column) -> Column:
    code = F.lower(section_type).isin("coding", "sql", "html")
    return (
        F.when(text == "", "editor_snapshot")
        .when(text.rlike(UUID) & is_checked.isNotNull(), "mcq_radio")
        .when(F.trim(text) == UI_LABEL, "ui_label")
        .when(code & text.rlike(DIGITS_ONLY), "test_fixture")
        .otherwise("real_typing")
    )


def skeleton(text: Column) -> Column:
    return F.regexp_replace(text, r"""[\s{}()\[\]<>;,'"]""", "")


def is_autoformat(before: Column, after: Column) -> Column:
    return skeleton(before) == skeleton(after)


def locality(before: Column, after: Column) -> Column:
    return F.when(F.startswith(after, before), "append_at_end").otherwise("mid_document_replace")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading characters are equal, by halving: each step compares the next characters only."""
    steps = F.array(*[F.lit(1 << k) for k in range(24, -1, -1)])

    def searched(x: Column) -> Column:
        same = lambda lo, step: F.substring(x["a"], lo + 1, step) == F.substring(x["b"], lo + 1, step)
        return F.aggregate(steps, F.lit(0), lambda lo, step: F.when((lo + step <= x["n"]) & same(lo, step), lo + step).otherwise(lo))

    return bound(F.struct(a.alias("a"), b.alias("b"), F.least(F.char_length(a), F.char_length(b)).alias("n")), searched)


def diff_excerpt(before: Column, after: Column, most: int = 300) -> Column:
    """The appended tail, else what is left of ``after`` without the common beginning and end."""

    def excerpt(x: Column) -> Column:
        tail = F.substring(x["b"], F.char_length(x["a"]) + 1, F.char_length(x["b"]))
        left = lambda c, head: F.substring(x[c], head + 1, F.char_length(x[c])).alias(c)
        rest = bound(common_prefix(x["a"], x["b"]), lambda head: F.struct(left("a", head), left("b", head)))
        middle = bound(rest, lambda r: F.substring(r["b"], F.lit(1), F.char_length(r["b"]) - common_prefix(F.reverse(r["a"]), F.reverse(r["b"]))))
        return F.substring(F.when(F.startswith(x["b"], x["a"]), tail).otherwise(middle), F.lit(1), F.lit(most))

    return bound(F.struct(before.alias("a"), after.alias("b")), excerpt)


#: White space of Unicode, as a class that both Java and RE2 read.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def normalised(text: Column) -> Column:
    """Lower case, white space of any kind and length as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), SPACE + "+", " "))


def excerpt_in(excerpt: Column, source: Column) -> Column:
    """Both normalised: at least 20 characters each; the excerpt, or from 40 on its middle, occurs in the source."""
    n = F.char_length(excerpt)
    middle = F.substring(excerpt, F.lit(6), n - 10)
    long_enough = (n >= 20) & (F.char_length(source) >= 20)
    return long_enough & (F.contains(source, excerpt) | ((n >= 40) & (F.char_length(middle) >= 20) & F.contains(source, middle)))


def test_passed(text: Column) -> Column:
    """How many test cases passed, by the text of a result panel."""
    return F.nullif(F.regexp_extract(text, TEST_RESULT, 1), F.lit("")).try_cast("int")


def question_number(label: Column) -> Column:
    """From "question 7", "q#7" and the like, else the first free number of one to three digits; 1 to 499 counts."""
    named = F.nullif(F.regexp_extract(label, r"(?i)\bq(?:uestion)?[#:]?\s*(\d+)", 1), F.lit(""))
    free = F.nullif(F.regexp_extract(label, r"\b(\d{1,3})\b", 1), F.lit(""))
    n = F.coalesce(named, free).try_cast("int")
    return F.when(n.between(1, 499), n)


def is_unknown(value: Column) -> Column:
    return value.isNull() | (F.upper(F.trim(value)) == "UNKNOWN")


def citation(ref: Column) -> Column:
    """windowId.field.path[= or :]value as a struct."""
    pattern = r"^([^.=:]+)\.([^=:]+)(?:[=:](.*))?$"
    part = lambda i: F.nullif(F.regexp_extract(ref, pattern, i), F.lit(""))
    return F.struct(part(1).alias("window_id"), part(2).alias("path"), part(3).alias("value"))


def window_ids(ref: Column) -> Column:
    """Ids of "perception:w=a+b+c"."""
    body = F.regexp_extract(ref, r"w=(.*)$", 1)
    return F.filter(F.transform(F.split(body, r"\+"), lambda x: F.trim(x)), lambda x: x != "")


def ordered_distinct(values: Column) -> Column:
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def seconds(ms: Column) -> Column:
    """Banker's rounding to whole seconds."""
    return F.bround(ms / 1000.0)


def reviewer_prose(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def grounded(quotes: Column, summaries: Column) -> Column:
    """Quotes of 8 characters or more that stand in a summary, or hold a summary's first 80 characters."""
    known = lambda q: F.exists(summaries, lambda s: F.contains(s, q) | F.contains(q, F.substring(s, F.lit(1), F.lit(80))))
    return F.filter(quotes, lambda q: (F.char_length(q) >= 8) & known(q))
