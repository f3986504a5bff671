"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words are hashed into a fixed number of embedding rows.  Filters of several widths slide over the words, each
filter's largest value over the whole text is kept (max pooling), and a logistic layer turns these into a score.
Beginnings of words are hashed too, so that unseen forms of a known stem are met.
Training starts on the driver with a bounded sample of labelled rows (``SAMPLE``), half of it toxic where there are
enough.  Where that leaves labelled rows out, every task then goes on with all those it reads, and the tasks' parameters are
averaged, ``PASSES`` times.  The logistic scale at natural prevalence and a flagging threshold for each language are calibrated
on all labelled rows that are kept for it, by sums and running counts in Spark.  Scoring is one pass without a shuffle: the product of a word's embedding
and every filter column is kept for the words that a task has met, so a text is scored by look-ups over all of its words.

Language, source, id and labels are never inputs of a score; language only picks the threshold of ``flagged``.

Defined results: a null text counts as empty; a text without words pools to zeros and gets the score of that; with no
labelled rows, or one class only, every score is the (smoothed) share of toxic labels; repeated rows stay repeated;
ids pass through, null included, and count as not held out; a row labelled twice is toxic if its mean label is 0.5
or more; of rows that share a labelled id the first text is learned from; only the named columns are read.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.llm.common import stash

#: Labelled rows that the start of the training takes to the driver at most.
SAMPLE = 3000
#: Passes over all labelled rows after the start, rows of a task, about, and pieces in which embeddings are averaged.
PASSES, SHARE, PIECES = 2, 2048, 64
ROWS, WIDTH, FILTERS, SPANS = 1 << 16, 16, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY, SEED = 8, 32, 0.1, 1e-4, 7
#: A word's embedding is the sum of the rows of the word itself and of its beginnings of these lengths.
BEGINNINGS = (3, 4, 5, 6, 7)
EDGES = ".,;:!?\"'()[]{}|#$%&*-_"


def word_rows(word: str) -> list[int]:
    """Embedding rows of a word; 0, which stays empty, where the word is no longer than a beginning."""
    w = word.strip(EDGES)
    parts = [w + "\n", *[w[:n] if len(w) > n else "" for n in BEGINNINGS]]
    return [zlib.crc32(x.encode()) % (ROWS - 1) + 1 if x.strip() else 0 for x in parts]


class Words(dict):
    """Numbers distinct words from 1 on (0 is the space around a text) and holds their embedding rows."""

    def __init__(self):
        super().__init__()
        self.rows: list[list[int]] = [[0] * (1 + len(BEGINNINGS))]

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self.rows)
        self.rows.append(word_rows(word))
        return number

    def numbers(self, text: str) -> np.ndarray:
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class Cnn:
    embed: np.ndarray
    filters: list[np.ndarray]  # for each span: span, WIDTH, FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fresh(cls) -> Cnn:
        rng = np.random.default_rng(SEED)
        embed = rng.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32)
        embed[0] = 0
        filters = [rng.normal(0, 0.3 / np.sqrt(s), (s, WIDTH, FILTERS)).astype(np.float32) for s in SPANS]
        out = rng.normal(0, 0.3, FILTERS * len(SPANS)).astype(np.float32)
        return cls(embed, filters, [np.zeros(FILTERS, np.float32) for _ in SPANS], out)

    def columns(self) -> np.ndarray:
        """Every filter's weights at every place of its span, side by side."""
        return np.concatenate([f[k] for f in self.filters for k in range(len(f))], axis=1)

    def pool(self, numbers: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest value of each filter over the text, at least 0, and where it stands (-1: nowhere above 0).

        ``products`` has each word's embedding times ``columns()``; row 0 is zero.
        """
        values, places, at = [], [], 0
        for span, bias in zip(SPANS, self.bias, strict=True):
            if not len(numbers):
                values.append(np.zeros(FILTERS, np.float32))
                places.append(np.full(FILTERS, -1))
                continue
            padded = np.concatenate([numbers, np.zeros(max(0, span - len(numbers)), np.int64)])
            n = len(padded) - span + 1
            made = products[padded[:n], at : at + FILTERS]
            for k in range(1, span):
                made = made + products[padded[k : k + n], at + k * FILTERS : at + (k + 1) * FILTERS]
            at += span * FILTERS
            top = made.argmax(axis=0)
            best = made[top, np.arange(FILTERS)] + bias
            values.append(np.maximum(best, 0))
            places.append(np.where(best > 0, top, -1))
        return np.concatenate(values), places

    def raw(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.out + self.out_bias

    def score(self, pooled: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.raw(pooled) + b, -30, 30)))


class Scorer:
    """Pools texts with a table of products for the words met so far, bounded in number."""

    def __init__(self, model: Cnn, limit: int = 150_000):
        self.model, self.limit, self.columns = model, limit, model.columns()
        self.clear()

    def clear(self) -> None:
        self.words = Words()
        #: one table a place of a span, so that look-ups read rows that lie together
        self.products = [np.zeros((1024, FILTERS), np.float32) for _ in range(sum(SPANS))]
        self.done = 1

    def pooled(self, text: str) -> np.ndarray:
        """As ``Cnn.pool``, without the places."""
        if len(self.words.rows) > self.limit:
            self.clear()
        numbers, size = self.words.numbers(text), len(self.words.rows)
        if size > self.done:
            new = self.model.embed[np.array(self.words.rows[self.done : size])].sum(axis=1) @ self.columns
            for i, table in enumerate(self.products):
                if size > len(table):
                    table = self.products[i] = np.concatenate([table, np.zeros((2 * size - len(table), FILTERS), np.float32)])
                table[self.done : size] = new[:, i * FILTERS : (i + 1) * FILTERS]
            self.done = size
        if not len(numbers):
            return np.zeros(FILTERS * len(SPANS), np.float32)
        out, at = [], 0
        for span, bias in zip(SPANS, self.model.bias, strict=True):
            padded = numbers if len(numbers) >= span else np.concatenate([numbers, np.zeros(span - len(numbers), np.int64)])
            n = len(padded) - span + 1
            made = self.products[at].take(padded[:n], axis=0)
            for k in range(1, span):
                made += self.products[at + k].take(padded[k : k + n], axis=0)
            at += span
            out.append(np.maximum(made.max(axis=0) + bias, 0))
        return np.concatenate(out)


@dataclass
class Steps:
    """What Adagrad has summed up so far, and how often each embedding row was moved."""

    embed: np.ndarray = field(default_factory=lambda: np.full(ROWS, 1e-3, np.float32))
    filters: list[np.ndarray] = field(default_factory=lambda: [np.full((s, WIDTH, FILTERS), 1e-3, np.float32) for s in SPANS])
    bias: list[np.ndarray] = field(default_factory=lambda: [np.full(FILTERS, 1e-3, np.float32) for _ in SPANS])
    out: np.ndarray = field(default_factory=lambda: np.full(FILTERS * len(SPANS), 1e-3, np.float32))
    out_bias: float = 1e-3
    moves: np.ndarray = field(default_factory=lambda: np.zeros(ROWS, np.float32))


def train(texts: list[str], labels: np.ndarray, model: Cnn | None = None, steps: Steps | None = None, epochs: int = EPOCHS, seed: int = SEED) -> Cnn:
    """Adagrad on the logistic loss; only words and filters that won the pooling move.  A given model and its steps go on."""
    model, steps = model or Cnn.fresh(), steps or Steps()
    words, rng = Words(), np.random.default_rng(seed)
    docs = [words.numbers(t) for t in texts]
    rows_of = np.array(words.rows)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            # words of this batch, numbered anew with 0 kept for the space around a text
            own, inverse = np.unique(np.concatenate([np.zeros(1, np.int64), *[docs[i] for i in part]]), return_inverse=True)
            vectors = model.embed[rows_of[own]].sum(axis=1)
            products = vectors @ model.columns()
            local = np.split(inverse[1:], np.cumsum([len(docs[i]) for i in part])[:-1])
            pools = [model.pool(x, products) for x in local]
            pooled = np.stack([p for p, _ in pools])
            error = 1 / (1 + np.exp(-np.clip(model.raw(pooled), -30, 30))) - labels[part]
            grad_out = error @ pooled / len(part) + DECAY * model.out
            grad_pool = np.outer(error, model.out).astype(np.float32) / len(part)
            grad_words = np.zeros_like(vectors)
            for s, span in enumerate(SPANS):
                grad_f, grad_b = DECAY * model.filters[s], np.zeros(FILTERS, np.float32)
                for j, numbers in enumerate(local):
                    live = np.flatnonzero(pools[j][1][s] >= 0)
                    if not len(live):
                        continue
                    g = grad_pool[j, s * FILTERS + live]
                    grad_b[live] += g
                    for k in range(span):
                        where = pools[j][1][s][live] + k
                        won = np.where(where < len(numbers), numbers[np.minimum(where, len(numbers) - 1)], 0)
                        grad_f[k][:, live] += vectors[won].T * g
                        np.add.at(grad_words, won, (model.filters[s][k][:, live] * g).T)
                steps.filters[s] += grad_f**2
                model.filters[s] -= RATE * grad_f / np.sqrt(steps.filters[s])
                steps.bias[s] += grad_b**2
                model.bias[s] -= RATE * grad_b / np.sqrt(steps.bias[s])
            moved = np.flatnonzero(np.abs(grad_words).sum(axis=1))
            rows, spot = np.unique(rows_of[own[moved]], return_inverse=True)
            grads = np.zeros((len(rows), WIDTH), np.float32)
            np.add.at(grads, spot.reshape(len(moved), -1), grad_words[moved][:, None, :])
            grads[rows == 0] = 0
            steps.moves[rows] += 1
            steps.embed[rows] += (grads**2).mean(axis=1)
            model.embed[rows] -= RATE * grads / np.sqrt(steps.embed[rows])[:, None]
            steps.out += grad_out**2
            model.out -= RATE * grad_out / np.sqrt(steps.out)
            steps.out_bias += float(error.mean()) ** 2
            model.out_bias -= RATE * float(error.mean()) / np.sqrt(steps.out_bias)
    return model


def improved(rows: DataFrame, model: Cnn, steps: Steps, turn: int) -> Cnn:
    """The model after every task has gone on with all the rows (text, y) that it reads.

    Embeddings are averaged by how often a task moved them, the rest by the tasks' rows.
    """
    sent = rows.sparkSession.sparkContext.broadcast((model, steps))  # a few MB whatever the input
    dense = lambda m: np.concatenate([x.ravel() for x in (*m.filters, *m.bias, m.out, np.array([m.out_bias]))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, before = sent.value
        own, steps, number = copy.deepcopy(start), copy.deepcopy(before), TaskContext.get().partitionId()
        steps.moves[:] = 0
        done, texts, y = 0, [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            y += batch.column(1).to_pylist()
            if len(texts) >= SHARE:
                train(texts, np.array(y, np.float32), own, steps, 1, SEED + turn)
                done, texts, y = done + len(texts), [], []
        if texts:
            train(texts, np.array(y, np.float32), own, steps, 1, SEED + turn)
            done += len(texts)
        if done:
            moved = (own.embed - start.embed) * steps.moves[:, None]
            found = [np.concatenate([w, x.ravel()]) for w, x in zip(np.array_split(steps.moves, PIECES), np.array_split(moved, PIECES), strict=True)]
            found.append(np.concatenate([[done], done * dense(own)]))
            yield pieces([(i, number, x) for i, x in enumerate(found)])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                x = np.frombuffer(data.as_py())
                held[i] = held[i] + x if i in held else x
        yield pieces([(i, 0, x) for i, x in held.items()])

    def pieces(found: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.binary())
        columns = [[f[0] for f in found], [f[1] for f in found], [f[2].astype(np.float64).tobytes() for f in found]]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=["piece", "task", "data"])

    schema = "piece int, task int, data binary"
    sums = rows.select("text", "y").mapInArrow(task, schema).repartition("piece").sortWithinPartitions("piece", "task").mapInArrow(total, schema)
    new, groups = copy.deepcopy(model), np.array_split(np.arange(ROWS), PIECES)
    for r in sums.collect():  # the size of one model
        x = np.frombuffer(r["data"])
        if r["piece"] < PIECES:
            own = groups[r["piece"]]
            new.embed[own] += (x[len(own) :].reshape(-1, WIDTH) / np.maximum(x[: len(own)], 1)[:, None]).astype(np.float32)
            continue
        at, x = 0, x[1:] / x[0]
        for part in (*new.filters, *new.bias, new.out):
            part[:] = x[at : at + part.size].reshape(part.shape)
            at += part.size
        new.out_bias = float(x[-1])
    return new


def calibrate(model: Cnn, rows: DataFrame) -> None:
    """Logistic scale at natural prevalence (Newton's steps), then per language the threshold with the best F1, on all ``rows`` (text, lang, y)."""
    held = stash(raw_scores(rows, model, keep=("lang", "y")), "raw-scores")
    w, raw, y = np.array([1.0, 0.0]), F.col("raw"), F.col("y")
    for _ in range(30):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), float(w[0]) * raw + float(w[1])))))
        both = held.select("raw", "y", p.alias("p")).withColumn("v", F.col("p") * (1 - F.col("p")))
        sums = both.agg(*[F.sum(F.expr(x)) for x in ("v * raw * raw", "v * raw", "v", "(p - y) * raw", "p - y")]).first()
        if sums[0] is None:
            return
        hess = np.array([[sums[0], sums[1]], [sums[1], sums[2]]]) + 0.05 * np.eye(2)
        step = np.linalg.solve(hess, np.array(sums[3:]) + 0.05 * (w - [1.0, 0.0]))
        w -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    model.scale = (round(float(max(w[0], 1e-3)), 6), round(float(w[1]), 6))
    each = held.select(F.explode(F.array_distinct(F.array(F.coalesce("lang", F.lit("")), F.lit("")))).alias("g"), "raw", "y")
    counts = each.groupBy("g", "raw").agg(F.count("*").alias("n"), F.sum("y").alias("hits"))
    # running counts: over at most 4001 bins of scores first, then inside a bin
    counts = counts.withColumn("bin", F.greatest(F.lit(-2000), F.least(F.lit(2000), F.floor(raw * 16))))
    whole, higher = Window.partitionBy("g"), Window.partitionBy("g").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = counts.groupBy("g", "bin").agg(F.sum("n").alias("bn"), F.sum("hits").alias("bh"))
    running = lambda c: F.coalesce(F.sum(c).over(higher), F.lit(0))
    bins = bins.select("g", "bin", running("bn").alias("n0"), running("bh").alias("h0"), F.sum("bn").over(whole).alias("all"), F.sum("bh").over(whole).alias("toxic"))
    inside = Window.partitionBy("g", "bin").orderBy(F.desc("raw"))
    places = counts.join(bins.filter("toxic > 0 and toxic < all"), ["g", "bin"])
    f1 = 2 * (F.col("h0") + F.sum("hits").over(inside)) / (F.col("n0") + F.sum("n").over(inside) + F.col("toxic"))
    best = places.withColumn("f1", f1).groupBy("g").agg(F.max_by("raw", F.struct("f1", "raw")).alias("best"))
    after = counts.join(best, "g").groupBy("g", "best").agg(F.max(F.when(raw < F.col("best"), raw)).alias("after"))
    chance = lambda x: 1 / (1 + np.exp(-np.clip(model.scale[0] * x + model.scale[1], -30, 30)))
    for r in after.collect():  # a row a language
        model.thresholds[r["g"]] = float((chance(r["best"]) + (chance(r["after"]) if r["after"] is not None else 0.0)) / 2)


def fold(ident: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(folds))


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Cnn:
    """Learns from all labelled rows whose remainder is not 1: remainder 0 trains, remainder 2 calibrates."""
    mean = labels.filter("toxic is not null").groupBy("doc_id").agg(F.avg("toxic").alias("y"))
    mean = mean.select("doc_id", (F.col("y") >= 0.5).cast("int").alias("y")).filter(fold("doc_id", 3) != 1)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang").filter(fold("doc_id", 3) != 1)
    # of rows that share an id the first text counts
    known = texts.join(mean, "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct("text", "lang")).alias("d"))
    known = stash(known.select("doc_id", "d.text", "d.lang", "y", fold("doc_id", 3).cast("int").alias("part")), "labelled")
    fitting, holding = known.filter("part = 0"), known.filter("part = 2")
    counts = {r["y"]: r["count"] for r in fitting.groupBy("y").count().collect()}
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    if not clean or not toxic:
        model = Cnn.fresh()
        model.out[:] = 0
        model.out_bias = float(np.log((toxic + 0.5) / (clean + 0.5)))
        return model
    # at most ``limit`` rows start; their ids are chosen first, so that only the chosen texts are moved
    first = lambda y: fitting.filter(F.col("y") == y).select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(SEED))).limit(limit // 2)
    rows = fitting.join(F.broadcast(first(1).unionByName(first(0))), "doc_id").select("doc_id", "text", "y").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["text"]))
    steps = Steps()
    model = train([r["text"] for r in rows], np.array([r["y"] for r in rows], dtype=np.float32), steps=steps)
    if max(clean, toxic) > limit // 2:
        dealt = fitting.repartition(-(-(clean + toxic) // SHARE), "doc_id").sortWithinPartitions("doc_id")
        for turn in range(1, PASSES + 1):
            model = improved(dealt, model, steps, turn)
    calibrate(model, holding)
    return model


def raw_scores(docs: DataFrame, model: Cnn, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang"), chances: bool = False) -> DataFrame:
    """``keep`` plus ``raw`` (with ``chances``: ``score``): one pass over whole texts."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few MB whatever the input
    fields = [docs.schema[c] for c in keep]
    name = "score" if chances else "raw"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", {name} double"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        value = sent.value.score if chances else sent.value.raw
        for batch in batches:
            scores = [float(value(scorer.pooled(t.as_py() or ""))) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(scores, type=pa.float64())], names=[*keep, name])

    return docs.select(*keep, text).mapInArrow(task, schema)


def score(docs: DataFrame, model: Cnn, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """``keep`` plus ``score``: one pass over whole texts."""
    return raw_scores(docs, model, text, keep, chances=True)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)
    scored = score(docs, model)
    overall = model.thresholds.get("", 0.7)
    table = F.create_map(*[F.lit(x) for kv in sorted({"": overall, **model.thresholds}.items()) for x in kv])
    threshold = F.coalesce(F.try_element_at(table, F.col("lang")), F.lit(overall))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        threshold.alias("lang_threshold"),
        (F.col("score") >= threshold).alias("flagged"),
    )
