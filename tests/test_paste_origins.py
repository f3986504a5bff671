"""Origins of pastes against a plain model that walks each session in order."""

import random
import re
from collections import defaultdict

from evidencelake.operators.excerpts import blocks_of, occurrences
from evidencelake.plans import facts

FACTS = "sk string, ord int, t_ms bigint, kind string, section_id string, excerpt string, texts array<string>"
SENT = "sk string, ord int, t_ms bigint, starter string, source string"
COPIES = "sk string, t_ms bigint, section_id string"


def normal(text):
    return re.sub(r"\s+", " ", text.strip().lower())


def within(excerpt, source):
    e, s = normal(excerpt), normal(source or "")
    return min(len(excerpt), len(e), len(s)) >= 20 and (e in s or (len(e) >= 40 and e[5:-5] in s))


def model(rows, sent, copies):
    out, by = {}, defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    for sk, own in by.items():
        own.sort(key=lambda r: (r[2], r[1]))
        subs = sorted((s for s in sent if s[0] == sk), key=lambda s: (s[2], s[1]))
        parts = [s[4] for s in subs if s[4]] + [t for r in own for t in r[6] or [] if t is not None and len(t) >= 20]
        corpus, seen = normal("\n".join(parts)), []
        for _, ord_, t, kind, sec, x, _ in own:
            if kind != "LARGE_PASTE":
                continue
            reason, long = None, x is not None and len(x) >= 20
            if long and any(within(x, s[3]) for s in subs):
                reason = "starter_code_match"
            elif long and any(within(x, s[4]) for s in subs):
                reason = "own_submission_match"
            elif long and corpus.count(normal(x)) >= 2:
                reason = "in_session_corpus_match"
            elif long and any(p == normal(x) or (len(normal(x)) >= 40 and p in normal(x)) or (len(p) >= 40 and normal(x) in p) for p in seen):
                reason = "duplicate_paste"
            if long and reason != "duplicate_paste":
                seen.append(normal(x))
            if not reason and any(c[0] == sk and 0 <= t - c[1] <= 120_000 and (sec is None or c[2] in (None, sec)) for c in copies):
                reason = "preceding_copy"
            out[sk, ord_] = ("internal" if reason else "external", reason)
    return out


def origins(spark, rows, sent, copies):
    got = facts.paste_origins(spark.createDataFrame(rows, FACTS), spark.createDataFrame(sent, SENT), spark.createDataFrame(copies, COPIES)).collect()
    assert len({(r["sk"], r["ord"]) for r in got}) == len(got)
    return {(r["sk"], r["ord"]): (r["origin"], r["reason"]) for r in got}


def test_rules(spark):
    e = "select alpha, beta from gamma where delta"
    paste = lambda n, t, x, sec=None: ("s", n, t, "LARGE_PASTE", sec, x, [x])
    rows = [
        paste(1, 0, e), paste(2, 10, e.upper() + "\n"), paste(3, 200_000, "unique words nobody wrote before", "x"), paste(4, 300_000, "starter text of twenty chars"),
        paste(5, 500_000, "small piece of text 1"), paste(6, 500_001, "before it small piece of text 1 and much after it"), paste(7, 500_002, "much after it before it"), paste(8, 900_000, "ab" * 10),
        paste(9, 900_001, " " * 25), paste(10, 900_002, "a                     b"), paste(11, 900_003, None), paste(12, 320_000, "another one that nobody wrote", "y"),
        (None, 1, 0, "LARGE_PASTE", None, e, [e]), ("t", 1, 0, "LARGE_PASTE", None, "the only paste of session t", None),
    ]
    sent = [("s", 50, 1, "// starter   text of twenty CHARS here", None), ("s", 51, 2, "", "short"), ("u", 1, 1, e, e)]
    copies = [("s", 199_000, "x"), ("s", 150_000, "z"), ("s", 320_001, None)]
    got = origins(spark, rows, sent, copies)
    assert got == model([r for r in rows if r[0]], sent, copies)
    assert [got["s", n][1] for n in (1, 2, 3, 4, 5, 6, 9)] == ["in_session_corpus_match"] * 2 + ["preceding_copy", "starter_code_match", "in_session_corpus_match", "duplicate_paste", "in_session_corpus_match"]
    assert got["t", 1] == ("external", None)


def test_random_sessions(spark):
    rnd = random.Random(5)
    words = ["if", "else:", "return", "größe", "x", "=", "f(x)", "\n", "\t", "  ", "ZAHL", "for", "　", "end\n"]
    passage = " ".join(rnd.choice(words) + str(rnd.randint(0, 30)) for _ in range(500))

    def piece(least, most):
        at, n = rnd.randrange(len(passage)), rnd.randint(least, most)
        text = passage[at : at + n]
        return text.upper() if rnd.random() < 0.2 else text.replace(" ", "\n ") if rnd.random() < 0.2 else text

    rows, sent, copies = [], [], []
    for sk in range(25):
        for n in range(rnd.randint(1, 40)):
            x = rnd.choice([piece(0, 25), piece(15, 60), piece(15, 60), piece(50, 300), None, " " * 30, "a" + " " * 20 + "b", "ab" * rnd.randint(10, 30)])
            texts = [x] if rnd.random() < 0.6 else [None, piece(0, 40), piece(0, 3000), x]
            rows.append((f"s{sk}", n, rnd.randint(0, 30) * 50_000, rnd.choice(["LARGE_PASTE", "LARGE_PASTE", "TEXT_CORRECTION"]), rnd.choice([None, "a", "b"]), x, texts))
        for n in range(rnd.randint(0, 2)):
            sent.append((f"s{sk}", 100 + n, n, rnd.choice([None, "", piece(0, 200)]), rnd.choice([None, "", piece(0, 2000)])))
        copies += [(f"s{sk}", rnd.randint(0, 30) * 50_000, rnd.choice([None, "a", "b"])) for _ in range(rnd.randint(0, 2))]
    got = origins(spark, rows, sent, copies)
    assert got == model(rows, sent, copies)
    assert {r for _, r in got.values()} == {None, "starter_code_match", "own_submission_match", "in_session_corpus_match", "duplicate_paste", "preceding_copy"}
    assert origins(spark, [], [], []) == {}


def test_occurrences_are_all_found(spark):
    rnd = random.Random(3)
    text = "".join(rnd.choice("ab ") for _ in range(5000)) + "aaaa" * 30
    cuts = [(i, i + rnd.randint(20, 60)) for i in range(0, 4900, 97)] + [(1010, 1040), (1023, 1050), (5000, 5025)]
    needles = spark.createDataFrame([("s", text[i:j], text[i:j]) for i, j in cuts], "sk string, e string, needle string")
    blocks = blocks_of(spark.createDataFrame([("s", text), ("u", text)], "sk string, t string"), ["sk"], "t")
    got = {(r["e"], r["block"] * 1024 + r["place"]) for r in occurrences(needles, blocks, ["sk"]).filter("sk = 's'").collect()}
    assert got == {(text[i:j], m.start()) for i, j in cuts for m in re.finditer(f"(?={re.escape(text[i:j])})", text)}
