"""The randomness battery and its false-discovery control against plain versions."""

import math
import string

import numpy as np

from evidencelake.llm import secret_scan as ss

BASE64 = string.ascii_letters + string.digits + "+/"


def plain_agreement(token, encoding):
    """The three tests symbol by symbol; the chi-squared tail by numeric integration."""
    _, alphabet, groups = ss.ENCODINGS[encoding]
    body = token.rstrip("=")
    body = body.replace("-", "+").replace("_", "/") if encoding == "base64" else body.lower()
    n, size = len(body), len(alphabet)
    x = sum((sum(c in g for c in body) - n * len(g) / size) ** 2 / (n * len(g) / size) for g in groups)
    df = len(groups) - 1
    grid = np.linspace(x, x + 400, 400_001)
    density = np.exp((df / 2 - 1) * np.log(np.maximum(grid, 1e-12)) - grid / 2 - math.lgamma(df / 2) - df / 2 * math.log(2))
    uniform = float(np.trapezoid(density, grid))
    values = [alphabet.index(c) for c in body]
    high = [v >= size // 2 for v in values]
    ones, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    if 0 < ones < n:
        mean = 1 + 2 * ones * (n - ones) / n
        runs_p = math.erfc(abs(runs - mean) / math.sqrt((mean - 1) * (mean - 2) / (n - 1)) / math.sqrt(2))
    else:
        runs_p = 2.0 ** (1 - n)
    centre = [v - (size - 1) / 2 for v in values]
    r = sum(a * b for a, b in zip(centre, centre[1:], strict=False)) / sum(c * c for c in centre)
    return min(1.0, 3 * min(uniform, runs_p, math.erfc(abs(r) * math.sqrt(n / 2))))


def test_battery_against_plain_tests():
    rng = np.random.default_rng(1)
    for encoding in ss.NAMES:
        alphabet = list(ss.ENCODINGS[encoding][1])
        for n in (20, 25, 48, 130):
            for skew in (None, 3):
                p = None if skew is None else rng.dirichlet(np.full(len(alphabet), 1 / skew))
                token = "".join(rng.choice(alphabet, n, p=p))
                mine, plain = ss.randomness(token, encoding), plain_agreement(token, encoding)
                assert abs(mine - plain) < 2e-3 * plain + 1e-8, (token, encoding)


def test_tails():
    x = np.array([0.0, 1.0, 2.0, 4.0])
    assert np.allclose(ss.erfc(x), [math.erfc(v) for v in x], rtol=1e-4)
    assert np.allclose(ss.chi2_tail(np.array([3.841]), 1), 0.05, atol=1e-4) and np.allclose(ss.chi2_tail(np.array([24.996]), 15), 0.05, atol=1e-4)


def test_random_tokens_agree():
    rng = np.random.default_rng(2)
    for encoding in ss.NAMES:
        alphabet = list(ss.ENCODINGS[encoding][1])
        found = np.array([ss.randomness("".join(rng.choice(alphabet, 40)), encoding) for _ in range(400)])
        assert (found > 0.05).mean() > 0.93
    assert ss.randomness("thisisanordinarylongwordthatgoeson", "base64") < 1e-5


def test_encodings():
    assert [ss.encoding_of(t) for t in ("0123456789abcdef", "ABCDEFGH2345", "abcdefgh", "aB3+/_-", "12345678901234567890", "a.b")] == [
        "hex", "base32", "letters", "base64", None, None,
    ]


def test_step_up_keeps_false_discoveries_rare():
    """Ordinary and random tokens in all mixtures: few of the reported ones are ordinary, and most random ones are reported."""
    rng = np.random.default_rng(3)
    ordinary = ss.prior()[ss.stratum_of("base64", 20)]
    share = ordinary / ordinary.sum()
    false, reported, random, caught = 0, 0, 0, 0
    for _ in range(200):
        n, k = int(rng.integers(1, 400)), int(rng.integers(0, 60))
        plain = rng.choice(len(share), n, p=share)
        secret = ss.bins(np.minimum(1.0, 3 * rng.random((k, 3)).min(axis=1))) if k else np.zeros(0, int)
        found = np.bincount(np.concatenate([plain, secret]), minlength=len(share))
        cut = ss.step_up(found, ordinary, 0.01)
        if cut is not None:
            false += int((plain <= cut).sum())
            caught += int((secret <= cut).sum())
            reported += int((plain <= cut).sum() + (secret <= cut).sum())
        random += k
    assert false <= 0.02 * reported and caught > 0.85 * random
    assert ss.step_up(np.zeros_like(ordinary), ordinary, 0.01) is None


def test_added_spans(spark):
    rng = np.random.default_rng(4)
    upper = "".join(rng.choice(list(string.ascii_uppercase), 28))
    lower = "".join(rng.choice(list(string.ascii_lowercase + "234567"), 52))
    mixed = "".join(rng.choice(list(BASE64), 44))
    plain = "Donaudampfschifffahrtsgesellschaft an-ordinary-slug-of-a-long-page some_identifier_of_a_long_name 12345678901234567890123 https://example.com/one/path/to/somewhere/else"
    rows = [(1, f"x {upper} y"), (2, f"x {mixed} y"), (3, plain), (4, None), (5, ""), (6, f"{lower}, {lower}"), (None, f"{mixed}=")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as base", "'x' as maybe", "2 as ground", "3 as found", "4 as bin")
    got = ss.scan(df)
    assert set(df.columns) <= set(got.columns) and got.select("base", "maybe", "ground").distinct().collect() == [(1, "x", 2)]
    spans = {r["doc_id"]: r["spans"] for r in got.collect()}
    assert spans[1] == "random:2:30" and spans[2] == "random:2:46" and spans[6] == "random:0:52,random:54:106" and spans[None] == "random:0:45"
    assert spans[3] == spans[4] == spans[5] == ""


def test_background_counts_every_text(spark):
    """The background of a table is that of its parts, whatever the partitions."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    texts = [r["text"] or "" for r in docs.collect()]
    joined = "".join(w for t in texts for w in t.split() if len(w) < ss.LEAST_RANDOM).encode("ascii", "ignore")
    whole = ss.fresh_counts()
    ss.background(joined, whole)
    assert whole.sum() > 3 * len(joined) // 40 and (whole.sum(axis=1) > 0).all()
    for encoding, k in (("base64", 0), ("base32", 3)):
        s = ss.NAMES.index(encoding) * len(ss.LENGTHS) + k
        assert np.cumsum(whole[s])[20] < 0.05 * whole[s].sum()
