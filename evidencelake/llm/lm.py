"""Language-model scoring with a log-bilinear neural model trained by noise-contrastive estimation.

Every token with at least ``LEAST_COUNT`` occurrences in training is a unit with vectors of its own (the most frequent ones, as many as ``shortlist``
grants for that many training tokens; the end of a text always); all other tokens share ``SUFFIXES`` units by a hash of their last two bytes.  The context of a token is the
``CONTEXT`` units before it.  Their vectors, each weighted by its position, are summed into one prediction vector q:

    q = sum over i of position[i] * context_vector[unit i before]
    P(unit | context) = softmax over groups (q . group + bias)  *  softmax over the group's members (q . member + bias)
    P(token | context) = P(unit | context) * (count + 0.5) / (unit's count + 0.5 * (unit's types + 1))

(the last factor only for units that tokens share).  About the square root of the number of units is the number of groups,
so normalised log-probabilities of a block of tokens are two short batched matrix products.

Training is noise-contrastive estimation in numpy: at either level the token's group (member) is told apart from
``NOISE`` samples of its unigram distribution.  The driver starts the model on a bounded sample (about ``START_TOKENS`` tokens, in pieces of at most ``PIECE_BYTES``,
so that neither one long text nor many copies of one text can exceed it); then every task goes on
with all training tokens it reads, and the tasks' parameters are averaged by their numbers of tokens, in pieces that Spark shuffles.
What is gathered grows with the input: counts of all tokens, units with the cube root of the training tokens up to the head's size, and steps of training over every token.

Counting, training, scoring and the look-up of rare tokens are Spark jobs: the ``HEAD`` most frequent tokens travel to the tasks,
all other tokens meet their counts in a join on their hash.  What is collected is bounded by these parameters.

Defined results: a null text counts as empty; an empty text is its end token alone; unseen tokens have count 0; with no
training rows every count is 0 and the model is near uniform; rows with a null id train the model and are not held out;
repeated rows count again; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import copy
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencelake.llm.common import stash

SHORTLIST, LEAST_COUNT, SUFFIXES, HEAD = 1 << 13, 50, 256, 1 << 18
#: Training tokens for which SHORTLIST tokens have vectors; twice as many for eight times the tokens.
SHORTLIST_TOKENS = 1 << 24
END = b""  # no word is empty, so this stands for the end of a text
CONTEXT, DIM, NOISE, SHARED, SEED = 6, 16, 10, 16, 11
#: Tokens of a training step, and tokens scored at a time.
STEP = 1 << 14
#: Rows for each vector from which on a step adds up runs of equal rows.
FEW = 32
#: Rows of group scores held at a time, and rows that short operations on each take as one.
BLOCK, WIDE = 1 << 10, 64
RATE, START_TOKENS, EPOCHS, PIECE_BYTES = 0.1, 1_000_000, 4, 1 << 13
#: Pieces in which parameters are averaged.
PIECES = 64
#: Distinct tokens that a counting task holds before it sends them on.
COUNTER_LIMIT = 300_000
#: Counts are binned by sixteenths of a power of two to find how many tokens the head has room for.
FINE = 16


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z only); bytes split at the six ASCII blanks only."""
    return text.lower().split()


def shortlist(train_tokens: int) -> int:
    """How many tokens may have vectors of their own."""
    return min(HEAD, max(SHORTLIST, round(SHORTLIST * (train_tokens / SHORTLIST_TOKENS) ** (1 / 3))))


def suffix_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SUFFIXES


def token_hash(word: bytes) -> int:
    """64 bits, signed, as Spark's longs are."""
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


@dataclass
class Vocabulary:
    """What every scoring task needs: the head of the vocabulary and the units' totals."""

    numbers: dict[bytes, int]  # head token -> number
    counts: np.ndarray  # by number
    units: np.ndarray  # by number
    own: int  # units 0 .. own - 1 are single tokens, the rest suffixes
    train_tokens: int
    types: int
    unit_counts: np.ndarray
    unit_types: np.ndarray

    @property
    def base_norm(self) -> float:
        return np.log10(self.train_tokens + 0.5 * (self.types + 1))

    @property
    def unit_norm(self) -> np.ndarray:
        return np.log10(self.unit_counts + 0.5 * (self.unit_types + 1))


class Model:
    """Parameters of the log-bilinear model; unit u is member u // groups of group u % groups."""

    def __init__(self, unit_counts: np.ndarray):
        self.units = len(unit_counts)
        self.groups = max(1, round(self.units**0.5))
        self.members = -(-self.units // self.groups)
        held = np.zeros(self.groups * self.members)
        held[: self.units] = unit_counts + 0.5
        mass = np.ascontiguousarray(held.reshape(self.members, self.groups).T)  # a row of a group's members is a view
        self.size = np.bincount(np.arange(self.units) % self.groups, minlength=self.groups)  # members that are there
        self.group_share = mass.sum(axis=1) / mass.sum()
        self.member_share = mass / mass.sum(axis=1, keepdims=True)
        rng = np.random.default_rng(SEED)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.context = small(self.units + 1, DIM)  # the last: before a text
        self.position = np.ones((CONTEXT, DIM), np.float32) / CONTEXT
        self.group, self.member = small(self.groups, DIM), small(self.groups, self.members, DIM)
        self.group_bias = np.log(self.group_share).astype(np.float32)
        self.member_bias = np.log(np.maximum(self.member_share, 1e-30)).astype(np.float32)

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.context, self.position, self.group, self.member, self.group_bias, self.member_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for p in self.parameters:
            p[...] = values[at : at + p.size].reshape(p.shape)
            at += p.size

    def predictions(self, padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context vectors of all places and the prediction vector at each; the first CONTEXT places of a text have none of their own."""
        held = self.context.take(padded, axis=0)
        out, step = np.zeros_like(held), np.empty_like(held)
        for i in range(CONTEXT):
            add_weighted(out[i + 1 :], held[: -i - 1], self.position[i], step)
        return held, out

    def log10(self, padded: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """log10 P(unit | context) at the places ``inside``, in order."""
        unit = padded[inside]
        group, member = (unit % self.groups).astype(np.uint16), unit // self.groups
        order = np.argsort(group, kind="stable")
        group, member = group[order], member[order]
        q = self.predictions(padded)[1].take(inside.take(order), axis=0)
        row = group * np.int64(self.members) + member
        found = np.einsum("ij,ij->i", q, self.group.take(group, axis=0)) + self.group_bias.take(group)
        found += np.einsum("ij,ij->i", q, self.member.reshape(-1, DIM).take(row, axis=0)) + self.member_bias.take(row)
        total = np.empty(len(q), np.float32)
        for at in range(0, len(q), BLOCK):
            total[at : at + BLOCK] = log_total(q[at : at + BLOCK], self.group, self.group_bias)
        found -= total
        for g, own in segments(group):
            total[own] = log_total(q[own], self.member[g, : self.size[g]], self.member_bias[g, : self.size[g]])
        found -= total
        out = np.empty(len(unit))
        out[order] = found
        return out / np.log(10)


def laid(texts: list[np.ndarray], before: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' units one after the other, each behind CONTEXT units of its context, and the places of its own; long texts come in pieces."""
    held: list[np.ndarray] = []
    inside: list[np.ndarray] = []
    size = 0
    for units in texts:
        lead = np.full(CONTEXT, before)
        for at in range(0, len(units), STEP):
            piece = units[at : at + STEP]
            held += [lead, piece]
            inside.append(np.arange(size + CONTEXT, size + CONTEXT + len(piece)))
            size += CONTEXT + len(piece)
            lead = piece[-CONTEXT:] if len(piece) >= CONTEXT else lead
            if size >= STEP:
                yield np.concatenate(held), np.concatenate(inside)
                held, inside, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(inside)


def segments(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values of a sorted array."""
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):  # noqa: B905
        if b > a:
            yield int(keys[a]), slice(a, b)


def add_weighted(out: np.ndarray, rows: np.ndarray, weight: np.ndarray, step: np.ndarray) -> None:
    """Add the rows, times one weight for each column, to as many rows of ``out``; WIDE rows are taken as one long row."""
    n = len(rows) - len(rows) % WIDE
    if n:
        wide, product = (x[:n].reshape(-1, WIDE * DIM) for x in (out, step))
        wide += np.multiply(rows[:n].reshape(-1, WIDE * DIM), np.tile(weight, WIDE), out=product)
    out[n:] += rows[n:] * weight


def column_products(a: np.ndarray, b: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Sums of the products of both arrays' columns; WIDE rows are taken as one long row."""
    n = len(a) - len(a) % WIDE
    out = np.einsum("ij,ij->j", a[n:], b[n:])
    if n:
        out += np.multiply(a[:n], b[:n], out=step[:n]).reshape(-1, WIDE * DIM).sum(axis=0).reshape(WIDE, DIM).sum(axis=0)
    return out


def log_total(q: np.ndarray, vectors: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials of each row's products with the vectors and the bias."""
    scores = q @ vectors.T
    with np.errstate(over="ignore"):
        total = np.exp(scores, out=scores) @ np.exp(bias)
    if len(total) and not (1e-20 < total.min() and total.max() < 1e30):  # near or beyond what single precision holds
        scores = q @ vectors.T + bias
        most = scores.max(axis=1, keepdims=True)
        return np.log(np.exp(scores - most).sum(axis=1)) + most[:, 0]
    return np.log(total)


class Trainer:
    """Adagrad steps of noise-contrastive estimation; noise is drawn anew for every step and shared by its tokens."""

    def __init__(self, model: Model, seed: int, sums: list[np.ndarray] | None = None):
        self.model, self.rng = model, np.random.default_rng([SEED, seed & 0xFFFFFFFF])
        self.sums = [x.copy() for x in sums] if sums else [np.full_like(p, 1e-2) for p in model.parameters]
        self.tokens, self.waiting, self.held = 0, [], 0
        self.group_cdf, self.member_cdf = np.cumsum(model.group_share), np.cumsum(model.member_share, axis=1)
        against = lambda share: np.log(NOISE * np.maximum(share, 1e-30)).astype(np.float32)
        self.group_odds, self.member_odds = against(model.group_share), against(model.member_share)

    def add(self, units: np.ndarray) -> None:
        self.waiting.append(units)
        self.held += len(units)
        if self.held >= STEP:
            self.flush()

    def flush(self) -> None:
        for padded, inside in laid(self.waiting, self.model.units):
            self.step(padded, inside)
        self.waiting, self.held = [], 0

    def contrast(self, q: np.ndarray, vectors: np.ndarray, bias: np.ndarray, odds: np.ndarray, own: np.ndarray, runs: list[slice], noise: np.ndarray) -> tuple:
        """Slopes of q, vectors and bias for telling the rows ``own`` from noise, a row of ``noise`` for each run of q, with these log odds."""
        mine, level, far = vectors.take(own, axis=0), odds - bias, vectors[noise]
        data = chance(level.take(own) - np.einsum("ij,ij->i", q, mine), 1) - 1
        other = np.empty((len(q), SHARED), np.float32)
        for run, x, base in zip(runs, -far, level[noise], strict=True):
            part = np.matmul(q[run], x.T, out=other[run])
            part += base
        other = chance(other, NOISE / SHARED)
        slope_q, slope_v, pull = data[:, None] * mine, np.zeros_like(vectors), np.empty_like(far)
        for i, (run, x) in enumerate(zip(runs, far, strict=True)):
            slope_q[run] += other[run] @ x
            np.matmul(other[run].T, q[run], out=pull[i])
        if len(vectors) * FEW < len(own):
            new = np.flatnonzero(np.append(True, own[1:] != own[:-1]))  # they are sorted
            slope_v[own[new]] = np.add.reduceat(np.multiply(data[:, None], q, out=mine), new)
        else:
            add_rows(slope_v, own, np.multiply(data[:, None], q, out=mine))
        add_rows(slope_v, noise.ravel(), pull.reshape(-1, DIM))
        slope_b = np.bincount(own, data, len(odds))
        slope_b += np.bincount(noise.ravel(), np.add.reduceat(other, [run.start for run in runs]).ravel(), len(odds))
        return slope_q, slope_v, slope_b.astype(np.float32)

    def noise(self, cdf: np.ndarray) -> np.ndarray:
        """Samples of the distributions with these sums, a row for each."""
        drawn = self.rng.random((len(cdf), SHARED))
        return np.minimum((cdf[:, None] < drawn[:, :, None]).sum(axis=2), cdf.shape[1] - 1)

    def step(self, padded: np.ndarray, inside: np.ndarray) -> None:
        m, sums = self.model, self.sums
        held, q = m.predictions(padded)
        units = padded[inside]
        row = units % m.groups * m.members + units // m.groups  # the member's, groups one after the other
        order = np.argsort(row.astype(np.uint16 if m.groups * m.members < 1 << 16 else np.int32), kind="stable")
        inside, row = inside.take(order), row.take(order)
        q, group = q.take(inside, axis=0), row // m.members
        noise = self.noise(self.group_cdf[None])
        slope_q, slope_v, slope_b = self.contrast(q, m.group, m.group_bias, self.group_odds, group, [slice(0, len(q))], noise)
        adagrad(m.group, sums[2], slope_v)
        adagrad(m.group_bias, sums[4], slope_b)
        found = list(segments(group))
        groups = np.array([g for g, _ in found])
        noise = groups[:, None] * m.members + self.noise(self.member_cdf[groups])
        vectors, bias = m.member.reshape(-1, DIM), m.member_bias.reshape(-1)
        more, slope_v, slope_b = self.contrast(q, vectors, bias, self.member_odds.reshape(-1), row, [own for _, own in found], noise)
        slope_q += more
        adagrad(vectors, sums[3].reshape(-1, DIM), slope_v)
        adagrad(bias, sums[5].reshape(-1), slope_b)
        back = np.zeros_like(held)
        back[inside] = slope_q
        slopes = np.zeros_like(held)
        step = np.empty_like(held)
        for i in range(CONTEXT):
            add_weighted(slopes[: -i - 1], back[i + 1 :], m.position[i], step)
        position = np.stack([column_products(back[i + 1 :], held[: -i - 1], step) for i in range(CONTEXT)])
        order = np.argsort(padded.astype(np.uint16 if m.units < 1 << 16 else np.int32), kind="stable")
        found = padded.take(order)
        new = np.append(True, found[1:] != found[:-1])
        rank = np.empty_like(order)
        rank[order] = np.cumsum(new) - 1
        slope = np.zeros((rank[order[-1]] + 1, DIM), np.float32)
        add_rows(slope, rank, slopes)
        adagrad(m.context, sums[0], slope, found[new])
        adagrad(m.position, sums[1], position)
        self.tokens += len(units)


def add_rows(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add each of the values to its row of a contiguous array, in order."""
    base, at = rows * DIM, np.empty((min(BLOCK, len(rows)), DIM), np.int64)
    for i in range(0, len(rows), BLOCK):
        held = values[i : i + BLOCK]
        np.add(base[i : i + BLOCK, None], np.arange(DIM), out=at[: len(held)])
        np.add.at(total.reshape(-1), at[: len(held)].ravel(), held.ravel())


def chance(x: np.ndarray, most: float) -> np.ndarray:
    """``most`` / (1 + exp(x)), in place."""
    with np.errstate(over="ignore"):  # beyond what single precision holds: 0
        np.exp(x, out=x)
    x += 1
    return np.divide(np.float32(most), x, out=x)


def adagrad(values: np.ndarray, sums: np.ndarray, slope: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
    more = sums[rows] + slope * slope
    sums[rows] = more
    change = np.multiply(slope, np.float32(RATE))
    change /= np.sqrt(more, out=more)
    values[rows] -= change


def training(docs: DataFrame, ident: str) -> Column:
    return F.coalesce(fold(ident) != 1, F.lit(True))


def fold(ident: str) -> Column:
    return F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(5))


def count_tokens(texts: DataFrame) -> DataFrame:
    """hash, word, suffix and count of every token of ``texts`` (one binary column)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(tokens(value.as_py()))
                if len(seen) > COUNTER_LIMIT:
                    yield sent(seen)
                    seen.clear()
            seen[END] += batch.num_rows
        yield sent(seen)

    def sent(seen: Counter[bytes]) -> pa.RecordBatch:
        words = list(seen)
        columns = [
            pa.array([token_hash(w) for w in words], type=pa.int64()),
            pa.array(words, type=pa.binary()),
            pa.array([suffix_of(w) for w in words], type=pa.int32()),
            pa.array(list(seen.values()), type=pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["h", "word", "suffix", "c"])

    rows = texts.mapInArrow(task, "h bigint, word binary, suffix int, c bigint")
    return rows.groupBy("h", "word", "suffix").agg(F.sum("c").alias("c")).filter("c > 0")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals by suffix (bounded) and the head, at most ``HEAD`` tokens and the end."""
    totals = counts.groupBy("suffix").agg(F.sum("c").alias("n"), F.count("*").alias("types")).collect()
    suffix_counts, suffix_types = np.zeros(SUFFIXES, np.int64), np.zeros(SUFFIXES, np.int64)
    for r in totals:
        suffix_counts[r["suffix"]], suffix_types[r["suffix"]] = r["n"], r["types"]
    n, types = int(suffix_counts.sum()), int(suffix_types.sum())
    # the least bin of counts with which at most HEAD tokens qualify, so that no task has to send more than its share of them
    fine = F.floor(F.log2("c") * FINE)
    room, floor = HEAD, None
    for r in sorted(counts.groupBy(fine.alias("bin")).count().collect(), key=lambda r: -r["bin"]):  # at most 64 * FINE bins
        room -= r["count"]
        if room < 0:
            break
        floor = r["bin"]
    inside = fine >= floor if floor is not None else F.lit(False)
    top = counts.filter(inside | (F.col("h") == token_hash(END))).select("word", "c").toArrow()
    found = sorted(zip(top["c"].to_pylist(), top["word"].to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    found.sort(key=lambda x: x[1] != END)  # the end is always a unit of its own
    words = [w for _, w in found]
    head_counts = np.array([c for c, _ in found], dtype=np.int64)
    own = min(shortlist(n), sum(c >= LEAST_COUNT or w == END for c, w in found))
    suffixes = np.array([suffix_of(w) for w in words], dtype=np.int64)
    units = np.where(np.arange(len(words)) < own, np.arange(len(words)), own + suffixes)
    np.subtract.at(suffix_counts, suffixes[:own], head_counts[:own])
    np.subtract.at(suffix_types, suffixes[:own], 1)
    unit_counts = np.concatenate([head_counts[:own], suffix_counts])
    unit_types = np.concatenate([np.ones(own, np.int64), suffix_types])
    return Vocabulary({w: i for i, w in enumerate(words)}, head_counts, units, own, n, types, unit_counts, unit_types)


def numbered(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Numbers in the head (-1: not there), units with the end's unit last, and places outside the head."""
    numbers = np.fromiter(map(vocab.numbers.get, words, repeat(-1)), np.int64, len(words))
    units = np.append(vocab.units[numbers] if len(vocab.units) else np.zeros(len(words), np.int64), 0)
    rare = np.flatnonzero(numbers < 0).tolist()
    for i in rare:
        units[i] = vocab.own + suffix_of(words[i])
    end = vocab.numbers.get(END)
    units[-1] = vocab.units[end] if end is not None else vocab.own + suffix_of(END)
    return numbers, units, rare


def started(texts: DataFrame, vocab: Vocabulary) -> Trainer:
    """The model trained on a sample of the texts with about ``START_TOKENS`` tokens, in its trainer."""
    trainer, rng = Trainer(Model(vocab.unit_counts), 0), np.random.default_rng(SEED)
    if not vocab.train_tokens:
        return trainer
    sent = texts.sparkSession.sparkContext.broadcast(vocab)

    share = min(1.0, START_TOKENS / vocab.train_tokens)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        for batch in batches:
            found = []
            for value in batch.column(0):
                data = value.as_buffer()
                last = max(0, data.size - 1) // PIECE_BYTES
                for i in np.flatnonzero(rng.random(last + 1) < share).tolist():
                    piece = data[i * PIECE_BYTES : (i + 1) * PIECE_BYTES].to_pybytes()
                    units = numbered(tokens(piece), sent.value)[1].astype(np.int32)
                    # words that a cut may have split, and an end where the text goes on, are left out
                    found.append(units[1 if i else 0 : len(units) if i == last else -2].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, type=pa.binary())], names=["units"])

    found = sorted(x.as_py() for x in texts.mapInArrow(task, "units binary").filter("length(units) > 0").toArrow()["units"])
    held = [np.frombuffer(x, np.int32).astype(np.int64) for x in found]
    for _ in range(EPOCHS):
        for i in rng.permutation(len(held)):
            trainer.add(held[i])
        trainer.flush()
    return trainer


def improved(texts: DataFrame, start: Trainer) -> Model:
    """The model after every task has gone on with all the units of ``texts`` (one binary column) that it reads: the mean of theirs, by tokens."""
    model = start.model
    sent = texts.sparkSession.sparkContext.broadcast((model, start.sums))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sums = sent.value
        model = copy.deepcopy(model)
        trainer = Trainer(model, TaskContext.get().partitionId() + 1, sums)  # steps go on as short as they have become
        for batch in batches:
            for value in batch.column(0):
                trainer.add(unpacked(value, model.units))
        trainer.flush()
        if trainer.tokens:
            yield pieces([(trainer.tokens, trainer.tokens * x.astype(np.float64)) for x in np.array_split(model.flat(), PIECES)])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for i, n, data in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                n0, x0 = held.get(i, (0, 0.0))
                held[i] = (n0 + n, x0 + np.frombuffer(data))
        for i, x in held.items():
            yield pieces([x], i)

    def pieces(found: list[tuple[int, np.ndarray]], first: int = 0) -> pa.RecordBatch:
        arrays = [pa.array(range(first, first + len(found)), type=pa.int32()), pa.array([n for n, _ in found], type=pa.int64())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([x.tobytes() for _, x in found], type=pa.binary())], names=["piece", "n", "data"])

    schema = "piece int, n bigint, data binary"
    sums = texts.mapInArrow(task, schema).repartition("piece").mapInArrow(total, schema).collect()  # the size of one model
    if sums:
        out = copy.deepcopy(model)
        out.load(np.concatenate([np.frombuffer(r["data"]) / r["n"] for r in sorted(sums, key=lambda r: r["piece"])]))
        return out
    return model


def packed(units: np.ndarray, most: int) -> bytes:
    """Units, of which there are ``most``, in two bytes each if these hold them."""
    return units.astype(np.uint16 if most <= 1 << 16 else np.int32).tobytes()


def unpacked(value: pa.BinaryScalar, most: int) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint16 if most <= 1 << 16 else np.int32).astype(np.int64)


def prepared(docs: DataFrame, vocab: Vocabulary, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Every text's units, its numbers but for what the model and the rare tokens add, and hashes of these; stored, for training and scoring."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab)  # bounded by HEAD
    kept = docs.schema[ident]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = sent.value
        key, base_norm, unit_norm = TaskContext.get().partitionId() << 33, vocab.base_norm, vocab.unit_norm
        seen = np.log10(vocab.counts + 0.5)
        shared = np.where(np.arange(len(seen)) < vocab.own, 0.0, seen - unit_norm[vocab.units]) if len(seen) else seen
        known_in_head = (vocab.counts > 0).astype(np.int64)
        end = vocab.numbers.get(END)

        def done(first: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64()] * 3 + [pa.float64()] * 2 + [pa.binary(), pa.list_(pa.int64())]
            arrays = [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            names = ["ident", "train", "key", "n_tokens", "head_known", "head_base", "head_score", "units", "tail"]
            return pa.RecordBatch.from_arrays([first.column(0), first.column(1), *arrays], names=names)

        for batch in batches:
            rows, first, size = [], 0, 0
            for i, value in enumerate(batch.column(2)):
                words = tokens(value.as_py())
                numbers, units, rare = numbered(words, vocab)
                found = numbers[numbers >= 0]
                n = len(words) + 1
                base = seen[found].sum() + (seen[end] if end is not None else np.log10(0.5)) - n * base_norm
                rest = shared[found].sum() - (unit_norm[units[rare]].sum() if rare else 0.0)
                rest += shared[end] if end is not None else np.log10(0.5) - unit_norm[units[-1]]
                known = int(known_in_head[found].sum()) + (end is not None)
                rows.append((key, n, known, float(base), float(rest), packed(units, len(unit_norm)), [token_hash(words[j]) for j in rare]))
                key, size = key + 1, size + n
                if size > 4 * STEP:
                    yield done(batch.slice(first, i + 1 - first), rows)
                    rows, first, size = [], i + 1, 0
            if rows:
                yield done(batch.slice(first), rows)

    schema = (
        f"ident {kept.dataType.simpleString()}, train boolean, key bigint, n_tokens bigint, head_known bigint, head_base double, "
        "head_score double, units binary, tail array<bigint>"
    )
    rows = docs.select(F.col(ident).alias("ident"), training(docs, ident).alias("train"), F.coalesce(text, F.lit("")).cast("binary").alias("t"))
    return stash(rows.mapInArrow(task, schema), "lm-units")


def learned(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> tuple[Vocabulary, Model, DataFrame, DataFrame]:
    """Vocabulary, model, the stored counts of all training tokens (h, c), and the stored units of all texts."""
    texts = docs.filter(training(docs, ident)).select(F.coalesce(text, F.lit("")).cast("binary").alias("t"))
    counts = stash(count_tokens(texts), "token-counts")
    vocab = vocabulary(counts)
    rows = prepared(docs, vocab, text, ident)
    model = improved(rows.filter("train").select("units"), started(texts, vocab))
    # written as it is joined: a hash that many held-out texts share and no training text holds is split over tasks
    return vocab, model, stash(counts.groupBy("h").agg(F.sum("c").alias("c")), "hash-counts"), rows


def fit(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> tuple[Vocabulary, Model, DataFrame]:
    """Vocabulary, model, and the stored counts of all training tokens (h, c)."""
    return learned(docs, text, ident)[:3]


def score(docs: DataFrame, vocab: Vocabulary, model: Model, counts: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """ident, n_tokens, n_known, base_score, score of every text."""
    return scored(prepared(docs, vocab, text, ident), model, counts).withColumnRenamed("ident", ident)


def scored(rows: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """ident, n_tokens, n_known, base_score, score of every text of ``prepared``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value

        def done(first: pa.RecordBatch, texts: list[np.ndarray]) -> pa.RecordBatch:
            scores = np.concatenate([model.log10(*x) for x in laid(texts, model.units)])
            own = np.add.reduceat(scores, np.cumsum([0, *map(len, texts[:-1])]))
            return first.set_column(first.num_columns - 1, "own", pa.array(own))

        for batch in batches:
            texts, first, size = [], 0, 0
            for i, value in enumerate(batch.column(batch.num_columns - 1)):
                texts.append(unpacked(value, model.units))
                size += len(texts[-1])
                if size > 4 * STEP:
                    yield done(batch.slice(first, i + 1 - first), texts)
                    texts, first, size = [], i + 1, 0
            if texts:
                yield done(batch.slice(first), texts)

    tail = rows.select("key", F.explode("tail").alias("h")).join(counts, "h", "left")
    sums = tail.groupBy("key").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_log"), F.count("c").alias("tail_known")
    )
    rest = F.coalesce("tail_log", F.lit(0.0))
    kept = rows.select("ident", "key", "n_tokens", "head_known", "head_base", "head_score", "units")
    schema = f"ident {rows.schema['ident'].dataType.simpleString()}, key bigint, n_tokens bigint, head_known bigint, head_base double, head_score double, own double"
    return kept.mapInArrow(task, schema).join(sums, "key", "left").select(
        "ident",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        (F.col("head_base") + rest).alias("base_score"),
        (F.col("head_score") + F.col("own") + rest).alias("score"),
    )


def score_report(docs: DataFrame) -> DataFrame:
    vocab, model, counts, rows = learned(docs)
    return scored(rows, model, counts).withColumnRenamed("ident", "doc_id").select(
        "doc_id",
        F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(vocab.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
