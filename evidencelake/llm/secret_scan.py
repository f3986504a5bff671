"""Secret scans: fixed patterns and a randomness test battery.

Fixed kinds (assignments, access keys, hex runs) are matched as they are.  Beyond them, every long run of encoded
characters is a candidate; its encoding (hex, letters of one case, base32, base64) is inferred, and three tests ask how well it agrees with
uniformly random characters of that alphabet: a chi-squared test of alphabet uniformity, a runs test about the middle of the
alphabet and a lag-one serial correlation.  The smallest p value, times three, is the candidate's agreement.

What is reported are rejections of "this is ordinary text".  The distribution of the agreement under that hypothesis is
measured: the characters of the corpus' own shorter words, brought to each alphabet and cut to the least length of each
length class, go through the same battery, all of them, beside ``PRIOR`` strings drawn from English letter frequencies, so that
small inputs have a background too.  A candidate's p value is the share of the background of its encoding and length class
that agrees with randomness at least as well.  Benjamini and Hochberg's step-up rule, applied once to the p values of all candidates of the
corpus, then decides which are reported, so that about a share ``fdr`` of these at most is ordinary text.  Short candidates need better agreement than long ones, as ordinary text of their length often agrees.  Counts per
stratum and agreement bin, bounded in number, are all that leaves the tasks for that.

Defined results: a null text counts as empty; an empty text has no spans; spans count code points, end exclusive; a
reported candidate never overlaps a fixed one; a run of digits alone has no encoding, as numbers are as random; repeated rows stay
repeated; an empty table gives an empty result; other columns pass through, whatever their names, and output columns win over columns of the same name.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencelake.llm.common import free_name, stash

#: Fixed patterns, least lengths and order of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX, LEAST_RANDOM = 8, 16, 32, 20

#: A value may stand behind an equals sign, as in query strings and settings.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
#: Letters that make up most of ordinary text.
COMMON, RARE = "etaoinsrhl", "bcdfgjkmpquvwxyz"
#: Shape, alphabet, and the groups of symbols that the chi-squared test counts: those that ordinary text uses unequally.
ENCODINGS = {
    "hex": (re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)"), "0123456789abcdef", list("0123456789abcdef")),
    "letters": (re.compile(r"(?:[A-Z]+|[a-z]+)=*"), "abcdefghijklmnopqrstuvwxyz", [COMMON, RARE]),
    "base32": (re.compile(r"(?:[A-Z2-7]+|[a-z2-7]+)=*"), "abcdefghijklmnopqrstuvwxyz234567", [COMMON, RARE, "234567"]),
    "base64": (
        re.compile(r"[A-Za-z0-9+/_-]+=*"),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
        ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", COMMON, RARE, "0123456789", "+/"],
    ),
}
NAMES = list(ENCODINGS)
#: Least lengths of the length classes.
LENGTHS = (20, 25, 32, 40, 64, 128)
#: Agreement is counted in bins of a twentieth of a decimal order; below 1e-30 it is one bin.
BINS_PER_ORDER, ORDERS = 20, 30
#: Background strings of each stratum that do not come from the corpus, and their letters' frequencies in English a to z, in tenths of a percent.
PRIOR = 5000
FREQUENCIES = [82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1]
#: Characters of background text that are judged at a time.
BLOCK = 1 << 20


def _table(encoding: str) -> tuple[bytes, bytes]:
    """Byte translation to symbol numbers, and the bytes outside the alphabet."""
    alphabet = ENCODINGS[encoding][1]
    number = {c: i for i, c in enumerate(alphabet)}
    if encoding == "base64":
        number |= {"-": 62, "_": 63}
    else:
        number |= {c.upper(): i for c, i in number.items()}
    held = {ord(c): i for c, i in number.items()}
    return bytes(held.get(i, 0) for i in range(256)), bytes(i for i in range(256) if i not in held)


def _groups(encoding: str) -> tuple[np.ndarray, np.ndarray]:
    """The group of each symbol, and the share of each group in the alphabet."""
    _, alphabet, groups = ENCODINGS[encoding]
    return np.array([next(i for i, g in enumerate(groups) if c in g) for c in alphabet]), np.array([len(g) for g in groups]) / len(alphabet)


TABLES = {name: _table(name) for name in NAMES}
GROUPS = {name: _groups(name) for name in NAMES}
_STEP = 0.004
_LOG_ERFC = np.array([math.log10(math.erfc(i * _STEP)) for i in range(int(26 / _STEP))])


def erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function of values >= 0, from a table; 1e-296 and less is one value."""
    at = np.minimum(x / _STEP, len(_LOG_ERFC) - 1.001)
    i = at.astype(np.int64)
    return 10 ** (_LOG_ERFC[i] + (at - i) * (_LOG_ERFC[i + 1] - _LOG_ERFC[i]))


def encoding_of(token: str) -> str | None:
    """The narrowest alphabet that fits; a run of digits has none."""
    if token.rstrip("=").isdigit():
        return None
    return next((name for name, (shape, _, _) in ENCODINGS.items() if shape.fullmatch(token)), None)


def chi2_tail(x: np.ndarray, df: int) -> np.ndarray:
    """Upper tail of chi-squared, by the recurrence in steps of two degrees of freedom."""
    half = np.clip(np.asarray(x, float) / 2, 1e-12, 690)
    if df % 2:
        total, term, k = erfc(np.sqrt(half)), np.exp(-half) / np.sqrt(math.pi * half), 0.5
    else:
        total, term, k = np.exp(-half), np.exp(-half), 1.0
    # each two degrees of freedom more add one term half ** k / gamma(k + 1)
    for _ in range((df - 1) // 2):
        term = term * half / k
        total = total + term
        k += 1
    return np.minimum(1.0, total)


def battery(values: np.ndarray, encoding: str) -> np.ndarray:
    """Agreement of each row of symbol numbers with "uniformly random in this alphabet": three p values, the least of them times three."""
    (m, n), group, shares = values.shape, *GROUPS[encoding]
    size, cells = len(group), len(shares)
    seen = np.bincount((group[values] + np.arange(m)[:, None] * cells).ravel(), minlength=m * cells).reshape(m, cells)
    expected = n * shares
    uniform = chi2_tail(((seen - expected) ** 2 / expected).sum(axis=1), cells - 1)
    # runs about the middle of the alphabet
    high = values >= size // 2
    ones, runs = high.sum(axis=1), 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 1 + 2.0 * ones * (n - ones) / n
    spread = np.sqrt(np.maximum(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
    runs_p = np.where((ones > 0) & (ones < n), erfc(np.abs(runs - mean) / spread / math.sqrt(2)), 2.0 ** (1 - n))
    # serial correlation at lag one, under independence near normal with variance 1 / n
    centre = values.astype(np.float32) - np.float32((size - 1) / 2)
    power = np.einsum("ij,ij->i", centre, centre)
    serial = np.einsum("ij,ij->i", centre[:, 1:], centre[:, :-1]) / power
    serial_p = erfc(np.abs(serial) * math.sqrt(n) / math.sqrt(2))
    return np.clip(3 * np.minimum(np.minimum(uniform, runs_p), serial_p), 1e-300, 1.0)


def numbers(token: str, encoding: str) -> np.ndarray:
    return np.frombuffer(token.rstrip("=").encode().translate(TABLES[encoding][0]), np.uint8)


def randomness(token: str, encoding: str) -> float:
    """Agreement of one token."""
    return float(battery(numbers(token, encoding)[None, :], encoding)[0])


def bins(agreement: np.ndarray) -> np.ndarray:
    """Bin 0 agrees best."""
    return np.minimum(ORDERS * BINS_PER_ORDER, np.floor(-np.log10(agreement) * BINS_PER_ORDER + 1e-9)).astype(np.int64)


def stratum_of(encoding: str, length: int) -> int:
    """Encoding and length class as one number."""
    return NAMES.index(encoding) * len(LENGTHS) + sum(length >= x for x in LENGTHS[1:])


def background(text: bytes, counts: np.ndarray) -> None:
    """Add the agreement bins of ``text``, brought to each alphabet and cut to each length, to ``counts`` (strata x bins)."""
    for e, encoding in enumerate(NAMES):
        table, outside = TABLES[encoding]
        values = np.frombuffer(text.translate(table, outside), np.uint8)
        for k, length in enumerate(LENGTHS):
            rows = len(values) // length
            step = max(1, BLOCK // length)
            for at in range(0, rows, step):
                part = values[at * length : min(rows, at + step) * length].reshape(-1, length)
                counts[e * len(LENGTHS) + k] += np.bincount(bins(battery(part, encoding)), minlength=counts.shape[1])


def fresh_counts() -> np.ndarray:
    return np.zeros((len(NAMES) * len(LENGTHS), ORDERS * BINS_PER_ORDER + 1), np.int64)


@lru_cache(maxsize=1)
def prior() -> np.ndarray:
    """Counts of ``PRIOR`` background strings of each stratum: words of letters with a capital or a digit now and then."""
    rng, counts = np.random.default_rng(17), fresh_counts()
    for e, encoding in enumerate(NAMES):
        kept = [c for c in range(26) if encoding != "hex" or c < 6]
        share = np.array(FREQUENCIES, float)[kept]
        for k, length in enumerate(LENGTHS):
            letters = rng.choice(np.array(kept, np.uint8), (PRIOR, length), p=share / share.sum()) + np.uint8(97)
            letters[rng.random(letters.shape) < 0.03] -= np.uint8(32)
            digit = rng.random(letters.shape) < 0.02
            letters[digit] = rng.integers(50, 56, int(digit.sum()), dtype=np.uint8)
            values = np.frombuffer(letters.tobytes().translate(TABLES[encoding][0]), np.uint8).reshape(PRIOR, length)
            counts[e * len(LENGTHS) + k] += np.bincount(bins(battery(values, encoding)), minlength=counts.shape[1])
    return counts


def base_spans(text: str, longest: int) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end), in order."""
    out = []
    lower = text.lower()
    if "passw" in lower or "secret" in lower or "token" in lower or "api" in lower:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if longest >= LEAST_HEX:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, encoding) of what the battery has to judge."""
    out = []
    for m in CANDIDATE.finditer(text):
        if (enc := encoding_of(m[0])) and not any(s < m.end() and m.start() < e for s, _, e in taken):
            out.append((m.start(), m.end(), enc))
    return out


def judged(found: list[tuple[int, str, int, int, str]]) -> dict[int, list[dict]]:
    """(row, token, start, end, encoding) to the candidates of each row, with stratum and bin; equal lengths are judged together."""
    alike, out = defaultdict(list), defaultdict(list)
    for row, token, start, end, enc in found:
        values = numbers(token, enc)
        alike[enc, len(values)].append((row, start, end, values))
    for (enc, length), own in alike.items():
        for at in range(0, len(own), 1024):
            part = own[at : at + 1024]
            for (row, start, end, _), b in zip(part, bins(battery(np.stack([v for *_, v in part]), enc)).tolist(), strict=True):
                out[row].append({"start": start, "end": end, "stratum": stratum_of(enc, length), "bin": b})
    return out


def scan(df: DataFrame, text: str = "text", fdr: float = 0.01, keep_text: bool = True) -> DataFrame:
    """``df`` plus n_assign, n_access, n_hex, base_sha256, found (array of spans) and spans (the same as a string)."""
    added = ["n_assign", "n_access", "n_hex", "base_sha256", "found", "spans"]
    df = df.drop(*[c for c in added if c != text])
    base_, maybe, ground = (free_name(df, c) for c in ("base", "maybe", "ground"))
    fields = [f for f in df.schema if f.name != text]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in [*fields, *[df.schema[text]] * keep_text]]
        + ["n_assign bigint", "n_access bigint", "n_hex bigint", "base_sha256 string"]
        + [f"{base_} array<struct<start:int,rank:int,end:int>>", f"{maybe} array<struct<start:int,end:int,stratum:int,bin:int>>"]
        + [f"{ground} array<struct<stratum:int,bin:int,n:bigint>>"]
    )
    place = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))
    candidate = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("stratum", pa.int32()), ("bin", pa.int32())]))
    counted = pa.list_(pa.struct([("stratum", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, bases, found, seen, ordinary = [], [], [], [], fresh_counts(), []
            held = 0
            for row, value in enumerate(batch.column(batch.num_columns - 1)):
                t = value.as_py() or ""
                words = t.split()
                longest = max(map(len, words), default=0)
                base = base_spans(t, longest)
                said = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
                counts.append([sum(k == i for _, k, _ in base) for i in range(3)])
                digests.append(hashlib.sha256(said.encode()).hexdigest())
                bases.append([{"start": s, "rank": k, "end": e} for s, k, e in base])
                if longest >= LEAST_RANDOM:
                    found += [(row, t[s:e], s, e, enc) for s, e, enc in candidates(t, base)]
                    words = [w for w in words if len(w) < LEAST_RANDOM]
                ordinary.append("".join(words))
                held += len(ordinary[-1])
                if held > BLOCK:
                    background("".join(ordinary).encode("ascii", "ignore"), seen)
                    ordinary, held = [], 0
            background("".join(ordinary).encode("ascii", "ignore"), seen)
            own = judged(found)
            grounds = [None] * batch.num_rows
            if batch.num_rows:
                grounds[0] = [{"stratum": s, "bin": b, "n": n} for s, b, n in zip(*(x.tolist() for x in (*seen.nonzero(), seen[seen.nonzero()])), strict=True)]
            arrays = [pa.array([c[i] for c in counts], type=pa.int64()) for i in range(3)]
            arrays += [pa.array(digests, type=pa.string()), pa.array(bases, type=place)]
            arrays += [pa.array([own.get(i, []) for i in range(batch.num_rows)], type=candidate), pa.array(grounds, type=counted)]
            columns = batch.columns if keep_text else batch.columns[:-1]
            kept = [*batch.schema.names[: len(columns)], "n_assign", "n_access", "n_hex", "base_sha256", base_, maybe, ground]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], names=kept)

    ordered = df.select(*[F.col(f"`{f.name}`") for f in fields], F.col(f"`{text}`"))
    scanned = stash(ordered.mapInArrow(task, schema), "secret-candidates")
    cuts = reported_bins(scanned, maybe, ground, fdr)
    random = F.transform(
        F.filter(maybe, lambda c: c.bin <= cut_of(c, cuts)), lambda c: F.struct(c.start.alias("start"), F.lit(3).alias("rank"), c.end.alias("end"))
    )
    every = F.array_sort(F.concat(base_, random))
    kind = F.array(*map(F.lit, KINDS))
    named = lambda s: F.struct(F.get(kind, s["rank"]).alias("kind"), s.start.alias("start"), s.end.alias("end"))
    said = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    return scanned.withColumn("found", F.transform(every, named)).withColumn("spans", said).drop(base_, maybe, ground)


def reported_bins(scanned: DataFrame, maybe: str, ground: str, fdr: float) -> dict[int, int]:
    """Per stratum, the last agreement bin whose candidates are reported; at most strata x bins counts are collected."""

    def counts(column: str, n: Column) -> np.ndarray:
        rows = scanned.select(F.explode(column).alias("c")).groupBy("c.stratum", "c.bin").agg(F.sum(n).alias("n")).collect()
        out = fresh_counts()
        for r in rows:
            out[r["stratum"], r["bin"]] = r["n"]
        return out

    found, ordinary = counts(maybe, F.lit(1)), counts(ground, F.col("c.n")) + prior()
    return all_cuts(found, ordinary, fdr)


def all_cuts(found: np.ndarray, ordinary: np.ndarray, fdr: float) -> dict[int, int]:
    """Per stratum (a row), the last bin that one step-up rule over all of them reports: p is the share of a stratum's ``ordinary`` in this bin or a better one."""
    p = (1 + np.cumsum(ordinary, axis=1)) / (1 + ordinary.sum(axis=1, keepdims=True))
    held = found > 0
    levels, at = np.unique(p[held], return_inverse=True)
    rank = np.cumsum(np.bincount(at, weights=found[held], minlength=len(levels)))
    passed = np.flatnonzero(levels <= fdr * rank / max(1, found.sum()))
    if not len(passed):
        return {}
    reported = held & (p <= levels[passed[-1]])
    return {s: int(np.flatnonzero(reported[s])[-1]) for s in np.flatnonzero(reported.any(axis=1)).tolist()}


def step_up(found: np.ndarray, ordinary: np.ndarray, fdr: float) -> int | None:
    """The last bin that the rule reports where there is one stratum."""
    return all_cuts(found[None], ordinary[None], fdr).get(0)


def cut_of(candidate: Column, cuts: dict[int, int]) -> Column:
    if not cuts:
        return F.lit(-1)
    table = F.create_map(*[F.lit(x) for kv in sorted(cuts.items()) for x in kv])
    return F.coalesce(F.try_element_at(table, candidate.stratum), F.lit(-1))


def redact(scanned: DataFrame, text: str = "text") -> DataFrame:
    """Every span in ``found`` replaced by ``[kind]``; overlapping spans are cut once."""
    t = F.coalesce(text, F.lit(""))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(t, acc["at"] + 1, F.greatest(F.lit(0), s.start - acc["at"]))
        mark = F.when(s.end > acc["at"], F.concat(F.lit("["), s.kind, F.lit("]"))).otherwise("")
        return F.struct(F.concat(acc["out"], kept, mark).alias("out"), F.greatest(acc["at"], s.end).alias("at"))

    cut = F.aggregate("found", start, step, lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.char_length(t))))
    return scanned.withColumn(text, F.when(F.size("found") > 0, cut).otherwise(F.col(text)))


def secret_report(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text")
    return scan(rows, keep_text=False).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
