"""White space of all kinds in fingerprints, and secrets behind an equals sign, planted by encoding and length."""

import base64
import random

import numpy as np

from evidencelake.llm import fingerprints, secret_scan

SPACES = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def test_every_white_space_is_folded(spark):
    rows = [(i, f"Alpha{chr(c)}{chr(c)}beta{chr(c)}") for i, c in enumerate(SPACES)] + [(100, " alpha BETA"), (101, "alphabeta"), (102, "alpha​beta")]
    marks = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {marks[i] for i in range(len(SPACES))} == {marks[100]}
    assert len({marks[100], marks[101], marks[102]}) == 3


def test_secrets_behind_an_equals_sign(spark):
    rng = random.Random(8)
    key = lambda n: base64.b64encode(rng.randbytes(n)).decode().rstrip("=")
    forms = ["see {}", "sig={}", "GET https://host/list?key={}&page=2", "export TOKEN_VALUE={}", 'x="{}"']
    words = "the quick brown fox jumps over the lazy dog and runs home".split()
    rows, planted = [], {}
    for i in range(150):
        secret = key(rng.choice([24, 30, 48]))
        before = " ".join(rng.choices(words, k=30)) + " "
        text = before + forms[i % len(forms)].format(secret) + " " + " ".join(rng.choices(words, k=30))
        rows.append((i, text))
        at = text.index(secret)
        planted[i] = (at, at + len(secret))
    rows += [(1000 + i, " ".join(rng.choices(words, k=40)) + " internationalization/misunderstandings_everywhere-notwithstanding") for i in range(50)]
    found = {r["doc_id"]: r["spans"] for r in secret_scan.secret_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    hit = [i for i, (a, b) in planted.items() if any(int(s.split(":")[1]) <= a + 1 and int(s.split(":")[2]) >= b - 1 for s in found[i].split(",") if s)]
    assert len(hit) >= 0.9 * len(planted)
    for k, form in enumerate(forms):
        assert sum(i % len(forms) == k for i in hit) >= 0.8 * len(planted) / len(forms), form
    assert sum(bool(found[1000 + i]) for i in range(50)) <= 5


def test_one_rule_for_all_strata():
    rng = np.random.default_rng(2)
    ordinary = rng.integers(0, 50, (3, 40))
    found = np.zeros((3, 40), int)
    assert secret_scan.all_cuts(found, ordinary, 0.05) == {}
    found[1, 0] = 500
    found[2, 30] = 3
    ordinary[1, :5] = 0
    cuts = secret_scan.all_cuts(found, ordinary, 0.05)
    assert cuts == {1: 0}
    p = (1 + np.cumsum(ordinary, axis=1)) / (1 + ordinary.sum(axis=1, keepdims=True))
    flat = sorted((p[s, b], found[s, b]) for s in range(3) for b in range(40) if found[s, b])
    total, rank, last = found.sum(), 0, None
    for value, n in flat:
        rank += n
        if value <= 0.05 * rank / total:
            last = value
    assert last == p[1, 0]
