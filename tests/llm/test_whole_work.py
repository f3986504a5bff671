"""Work that was cut once and must not be again: runs of matches that are partly covered, units, and the start of the language model."""

import numpy as np

from evidencelake.llm import lm, substring


def test_a_run_with_one_seed_outside_is_kept_whole():
    p = np.arange(60)
    doc, src = np.zeros(60, np.int64), np.ones(60, np.int64)
    outside = [(0, 0, 63)]  # the last seed, words 59 to 63, ends one word behind it
    assert substring.uncovered(doc, src, p, p + 7, outside).all()
    assert not substring.uncovered(doc, src, p, p + 7, [(0, 0, 64)]).any()
    assert substring.uncovered(doc, src, p, p + 7, []).all()


def test_a_covering_chain_has_enough_equal_words():
    wrong = 1 - substring.IDENTITY
    # at the identity's limit, with gaps of one length in both texts: no such chain with fewer equal words covers anything
    assert substring.SOLID >= 1 - wrong - 2 * substring.GAP_COST * wrong


def test_units_grow_with_the_corpus():
    sizes = [lm.shortlist(n) for n in (0, 1 << 20, 1 << 24, 1 << 27, 1 << 30, 1 << 60)]
    assert sizes == sorted(sizes) and sizes[3] == 2 * sizes[2] and sizes[4] == 4 * sizes[2] and sizes[-1] == lm.HEAD


def test_start_of_the_model_is_bounded(spark, monkeypatch):
    """Copies of one text, and one very long text, neither exceed the sample nor fall out of it altogether."""
    monkeypatch.setattr(lm, "START_TOKENS", 20_000)
    monkeypatch.setattr(lm, "EPOCHS", 1)
    monkeypatch.setattr(lm, "PIECE_BYTES", 1 << 9)
    seen = []
    monkeypatch.setattr(lm.Trainer, "add", lambda self, units: seen.append(len(units)))
    texts = [("alpha beta gamma delta " * 20).encode()] * 1500 + [("one two three " * 20_000).encode(), b""]
    df = spark.createDataFrame([(bytearray(t),) for t in texts], "t binary")
    lm.started(df, lm.vocabulary(lm.count_tokens(df)))
    assert 10_000 < sum(seen) < 30_000
