"""BPE encoding and decoding with an index of pair occurrences.

In each task, the distinct words of a run of texts that the task has not met before are laid out in one array of
symbols.  An index maps every adjacent pair that has a merge rank to all its positions in that array.  Active ranks
are applied in ascending order: all occurrences of the pair merge, and the lists of the pairs to their left and
right are updated.  Words never touch each other, so this gives each word the same symbols as merging it alone.
The vocabulary file is a parameter; it holds the merges, and nothing is trained.

Defined results: a null text counts as empty; an empty text has no ids and the digests of nothing; the special
tokens of the vocabulary are recognised inside a text; repeated rows stay repeated; ids pass through unchanged,
null included; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencelake.llm.splitting import Splitter

#: Characters of text whose new words are encoded together, and words that a worker remembers at most.
RUN_CHARS, CACHE_WORDS = 3_000_000, 300_000
#: Fixed by the vocabulary's file: what counts as a word, and the same for the standard library's matcher.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
QUICK = r"[^\W\d_]+|'(?:[stmd]|re|ve|ll)|\d|(?:[^\s\w]+|_+)+"


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PairIndexBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.final = np.array([vocab[c + suffix] for c in chars], dtype=np.int64)
        #: pair -> (rank, merged id); a pair is first * 2 ** 20 + second
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges[vocab[a] << 20 | vocab[b]] = (rank, vocab[a + b])
        self.by_rank = list(self.merges)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = Splitter(WORD, QUICK, self.specials)
        self.token = {i: t.encode() for t, i in (vocab | self.specials).items()}
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def normalise(self, text: str) -> str:
        if not text.isascii():
            # one character at a time, so a final sigma is not special
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def words(self, text: str) -> list[str]:
        return self.splitter.words(text, self.normalise)

    def learn_words(self, words: set[str]) -> None:
        """Encode words not met before; afterwards ``known`` has their ids and decoded text."""
        new = [w for w in words if w not in self.known]
        for w in [w for w in new if w[0] == "\0" and w[1:] in self.specials]:
            i = self.specials[w[1:]]
            self.known[w] = (i.to_bytes(4, "little"), self.token[i])
        new = [w for w in new if w not in self.known]
        if not new:
            return
        raw = [w.encode() for w in new]
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        symbols = self.inner[flat]
        symbols[ends - 1] = self.final[flat[ends - 1]]
        merged = self.merge(symbols, ends)
        alive = merged >= 0
        counts = np.add.reduceat(alive, np.concatenate([[0], ends[:-1]]))
        ids = merged[alive].astype("<u4")
        packed, at, token = ids.tobytes(), 0, self.token
        each = ids.tolist()
        for w, n in zip(new, counts.tolist(), strict=True):
            self.known[w] = (packed[4 * at : 4 * (at + n)], b" ".join([token[i] for i in each[at : at + n]]))
            at += n

    def merge(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``symbols`` with merged pairs at their first position and -1 where a symbol went."""
        size, merges = len(symbols), self.merges
        after = np.arange(1, size + 1)
        after[ends - 1] = -1
        before = np.arange(-1, size - 1)
        before[np.concatenate([[0], ends[:-1]])] = -1
        inside = np.flatnonzero(after >= 0)
        pairs = symbols[inside] << 20 | symbols[inside + 1]
        order = np.argsort(pairs, kind="stable")
        values, starts = np.unique(pairs[order], return_index=True)
        where = np.split(inside[order], starts[1:])
        index = {int(p): x.tolist() for p, x in zip(values.tolist(), where, strict=True) if p in merges}
        active = [merges[p][0] for p in index]
        heapq.heapify(active)
        sym, nxt, prv = symbols.tolist(), after.tolist(), before.tolist()
        rank_of, lists = merges.get, index.get
        while active:
            pair = self.by_rank[heapq.heappop(active)]
            first, second, whole = pair >> 20, pair & 0xFFFFF, merges[pair][1]
            for p in sorted(index.pop(pair)):
                q = nxt[p]
                if sym[p] != first or q < 0 or sym[q] != second:
                    continue
                sym[p], sym[q] = whole, -1
                nxt[p] = right = nxt[q]
                left = prv[p]
                # the pairs to the right and to the left are new: note where they stand
                made = []
                if right >= 0:
                    prv[right] = p
                    made.append((whole << 20 | sym[right], p))
                if left >= 0:
                    made.append((sym[left] << 20 | whole, left))
                for code, at in made:
                    if (held := lists(code)) is not None:
                        held.append(at)
                    elif (rank := rank_of(code)) is not None:
                        index[code] = [at]
                        heapq.heappush(active, rank[0])
        return np.array(sym, dtype=np.int64)

    def encode_all(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Packed ids and decoded text of each text."""
        for run in runs(texts):
            split = [self.words(t) for t in run]
            self.learn_words(set().union(*split))
            known = self.known
            for words in split:
                found = [known[w] for w in words]
                yield b"".join([x[0] for x in found]), b" ".join([x[1] for x in found])
            if len(known) > CACHE_WORDS:
                known.clear()


def runs(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of about RUN_CHARS characters together."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= RUN_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


@lru_cache(maxsize=2)
def loaded(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


def encode(df: DataFrame, path: str, text: str = "text", ident: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Per row: ``ident``, n_tokens, ids (packed unsigned 32 bits), decoded and their digests."""
    kept = [f for f in df.schema if f.name == ident][0]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for batch in batches:
            rows = []
            for ids, decoded in model.encode_all(batch.column(1).to_pylist()):
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
                rows.append((*row, ids, decoded.decode()) if with_ids else row)
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            arrays = [batch.column(0), *[pa.array(c, type=t) for c, t in zip(columns, types, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["ident", *names])

    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
    types = [pa.int64(), pa.string(), pa.string()] + [pa.binary(), pa.string()] * with_ids
    schema = f"ident {kept.dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_ids
    rows = df.select(F.col(ident).alias("ident"), F.coalesce(text, F.lit("")).alias("t"))
    return rows.mapInArrow(task, schema).withColumnRenamed("ident", ident)
