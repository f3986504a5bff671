import numpy as np

from evidencelake.llm import lm


def test_a_training_step_prices_all_groups_at_once(monkeypatch):
    calls = []
    whole = lm.Trainer.contrast
    monkeypatch.setattr(lm.Trainer, "contrast", lambda self, *x: calls.append(1) or whole(self, *x))
    rng = np.random.default_rng(4)
    trainer = lm.Trainer(lm.Model(rng.integers(1, 50, 900).astype(float)), 1)
    before = trainer.model.flat()
    trainer.add(rng.integers(0, 900, 3000))
    trainer.flush()
    assert len(calls) == 2  # groups, members of all groups
    start, moved = lm.Model(np.ones(900)), np.abs(trainer.model.flat() - before)
    at = 0
    for p in start.parameters:  # every kind of parameter has learned
        assert moved[at : at + p.size].max() > 1e-3
        at += p.size


def test_scores_far_below_single_precision():
    model = lm.Model(np.full(100, 1.0))
    model.member_bias -= 200
    model.group_bias += 200
    padded = np.array([model.units] * lm.CONTEXT + [3, 4, 5])
    found = model.log10(padded, np.arange(lm.CONTEXT, len(padded)))
    assert np.isfinite(found).all() and (found < 0).all()


def test_texts_are_looked_up_once_for_training_and_scoring(spark, monkeypatch):
    calls = []
    whole = lm.prepared
    monkeypatch.setattr(lm, "prepared", lambda *x: calls.append(1) or whole(*x))
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.4, rng.integers(0, 400)) % 3000) for _ in range(40)]
    docs = spark.createDataFrame([*enumerate(texts), (40, None), (None, "w1 w2")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.score_report(docs).collect()}
    assert len(got) == 42 and len(calls) == 1
    vocab, model, counts, rows = lm.learned(docs)
    for r in lm.scored(rows, model, counts).collect():
        units = lm.numbered(lm.tokens(([*texts, ""][r["ident"]] if r["ident"] is not None else "w1 w2").encode()), vocab)[1]
        own = sum(model.log10(*x).sum() for x in lm.laid([units], model.units))
        assert r["n_tokens"] == len(units) and own + 1e-4 > r["score"] and np.isfinite(r["score"])  # shared units' tokens come on top
    for most in (1 << 16, (1 << 16) + 1):
        units = np.array([0, 5, most - 1])
        assert (lm.unpacked(lm.pa.scalar(lm.packed(units, most)), most) == units).all()


def test_short_rows_taken_as_one_are_the_same_sums():
    rng = np.random.default_rng(7)
    for n in (1, 63, 64, 200, 3000):
        a, b, w = (rng.normal(size=(k, lm.DIM)).astype(np.float32) for k in (n, n, 1))
        out, step = b.copy(), np.empty_like(a)
        lm.add_weighted(out, a, w[0], step)
        assert (out == b + a * w[0]).all()
        assert np.allclose(lm.column_products(a, b, step), (a.astype(float) * b).sum(axis=0), atol=1e-2)
        rows, total = rng.integers(0, 50, n), np.zeros((50, lm.DIM), np.float32)
        lm.add_rows(total, rows, a)
        assert np.allclose(total, np.stack([a[rows == i].sum(axis=0) for i in range(50)]), atol=1e-3)
    cdf = np.cumsum(np.full((3, 10), 0.1), axis=1)
    trainer = lm.Trainer(lm.Model(np.ones(30)), 1)
    drawn = np.random.default_rng([lm.SEED, 1]).random((3, lm.SHARED))
    assert (trainer.noise(cdf) == [np.minimum(np.searchsorted(c, x), 9) for c, x in zip(cdf, drawn, strict=True)]).all()
    with np.errstate(over="raise", invalid="raise", divide="raise"):
        assert np.allclose(lm.chance(np.array([-100, 0, 100], np.float32), 1), [1, 0.5, 0])
