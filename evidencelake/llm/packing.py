"""Vector bin packing of token sequences.

A bin (training sequence) has three limits at once: tokens, segments and loss-bearing tokens.  Each task tokenises
its rows and keeps a small pool of items; the next item for the open bin is the one with the largest dot product of
its size vector and the bin's free capacity vector, both in shares of the limits, among those that fit.  If none
fits, an item is cut at the free space and its rest goes back to the pool, so bins come out full; what is left at
the end of a task is cut into sequences whose lengths are powers of two, which need no padding.  No shuffle: tasks
pack what they read, and a lost task is simply run again with the same result.

An item is the ids of a text and a closing id.  Its first ``prompt`` tokens bear no loss (documents: the first
token, which nothing predicts; instruction data: the prompt).

Defined results: a null text counts as empty and packs as the closing id alone; repeated rows are packed again; ids
pass through, null included; an empty table gives no pieces; only the named columns are read.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencelake.llm.bpe import CACHE_WORDS, byte_characters
from evidencelake.llm.splitting import Splitter

assert sys.byteorder == "little" and array("I").itemsize == 4, "packed ids are little-endian and 32 bits wide"

POOL = 256
#: Fixed by the vocabulary's file: what counts as a word, and the same for the standard library's matcher.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
QUICK = r" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]+|_+)+|\s+(?!\S)|\s+"


class WordIds(dict):
    """Packed ids of texts.  Each distinct word is encoded once and remembered, in bounded number."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = Splitter(WORD, QUICK, specials)
        # byte-level vocabularies number their tokens by merge rank, so the ids serve as ranks
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in specials}
        self.encode = tiktoken.Encoding("words", pat_str=WORD, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def __missing__(self, word: str) -> bytes:
        if word[0] == "\0" and word[1:] in self.splitter.specials:
            ids = [self.splitter.specials[word[1:]]]
        else:
            ids = self.encode(word.encode())
        self[word] = out = array("I", ids).tobytes()
        return out

    def packed(self, text: str) -> bytes:
        if len(self) > CACHE_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, self.splitter.words(text)))


@lru_cache(maxsize=2)
def loaded(path: str) -> WordIds:
    return WordIds(path)


class Packer:
    """Fills one bin at a time from a pool of items; ``pieces`` gathers what has been placed."""

    def __init__(self, first_bin: int, tokens: int, segments: int, loss: int):
        self.limit = np.array([tokens, segments, loss], dtype=np.float64)
        self.items: list[list] = []  # [ident, ids, start, prompt, document tokens]
        self.sizes = np.zeros((2 * POOL, 3))
        self.bin, self.used, self.offset = first_bin, np.zeros(3), 0
        self.pieces: list[tuple] = []

    def size(self, start: int, length: int, prompt: int) -> tuple[int, int, int]:
        return length, 1, max(0, start + length - max(start, prompt))

    def add(self, ident, ids: bytes, prompt: int) -> None:
        total, start, tokens = len(ids) // 4, 0, int(self.limit[0])
        while total - start >= tokens and self.size(start, tokens, prompt)[2] <= self.limit[2]:
            self.close()  # nothing is open unless the pool has been drained
            self.put(ident, ids, start, tokens, total, prompt)
            self.close()
            start += tokens
        if start < total:
            self.push([ident, ids[4 * start :], start, prompt, total])
            if len(self.items) >= POOL:
                self.drain(POOL // 2)

    def push(self, item: list) -> None:
        self.sizes[len(self.items)] = self.size(item[2], len(item[1]) // 4, item[3])
        self.items.append(item)

    def take(self, i: int) -> list:
        item, last = self.items[i], self.items.pop()
        if i < len(self.items):
            self.items[i], self.sizes[i] = last, self.sizes[len(self.items)]
        return item

    def put(self, ident, ids: bytes, start: int, length: int, total: int, prompt: int, at: int = 0) -> None:
        """The piece of ``length`` ids from ``start``; ``ids`` begins at ``at`` of its document."""
        loss = self.size(start, length, prompt)
        self.pieces.append((ident, start, length, ids[4 * (start - at) : 4 * (start - at + length)], total, self.bin, self.offset, loss[2]))
        self.used = self.used + loss
        self.offset += length

    def close(self) -> None:
        if self.offset:
            self.bin, self.used, self.offset = self.bin + 1, np.zeros(3), 0

    def drain(self, keep: int) -> None:
        """Fill bins until ``keep`` items are left; a bin that is open at the end is only left open if ``keep`` is 0."""
        while len(self.items) > keep or self.offset:
            free = self.limit - self.used
            if not self.items or free.min() < 1:
                self.close()
                if len(self.items) <= keep:
                    return
                continue
            sizes = self.sizes[: len(self.items)]
            fits = (sizes <= free).all(axis=1)
            if fits.any():
                gain = np.where(fits, (sizes / self.limit) @ (free / self.limit), -1.0)
                ident, ids, start, prompt, total = self.take(int(gain.argmax()))
                self.put(ident, ids, start, len(ids) // 4, total, prompt, start)
                continue
            ident, ids, start, prompt, total = self.take(int(sizes[:, 0].argmax()))
            length = int(min(free[0], max(0, prompt - start) + free[2], len(ids) // 4))
            self.put(ident, ids, start, length, total, prompt, start)
            self.push([ident, ids[4 * length :], start + length, prompt, total])

    def finish(self) -> None:
        """Pack the rest: whole bins while they fill up, then sequences of power-of-two lengths."""
        while sum(len(x[1]) for x in self.items) // 4 >= self.limit[0]:
            self.drain(max(0, len(self.items) - 1))
        self.close()
        while self.items:
            rest = sum(len(x[1]) for x in self.items) // 4
            room = 1 << (min(rest, int(self.limit[0])).bit_length() - 1)
            while room and self.items and self.used[1] < self.limit[1]:
                ident, ids, start, prompt, total = self.take(len(self.items) - 1)
                free = int(self.limit[2] - self.used[2])
                length = min(room, len(ids) // 4, max(0, prompt - start) + free)
                if length:
                    self.put(ident, ids, start, length, total, prompt, start)
                    room -= length
                if length < len(ids) // 4:
                    self.push([ident, ids[4 * length :], start + length, prompt, total])
                if not length:
                    break
            self.close()


def pack(
    df: DataFrame,
    path: str,
    text: str = "text",
    ident: str = "doc_id",
    prompt: Column | None = None,
    max_tokens: int = 1024,
    max_segments: int = 64,
    max_loss: int = 1024,
    closing_id: int = 0,
) -> DataFrame:
    """Per piece: ident, start, length, ids (little-endian, 32 bits each), doc_tokens, sequence_id, offset, loss_tokens.

    ``prompt``: a column with the text that comes before ``text`` in the item and bears no loss.
    """
    kept = [f for f in df.schema if f.name == ident][0]
    closing, has_prompt = closing_id.to_bytes(4, "little"), prompt is not None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = loaded(path), Packer(TaskContext.get().partitionId() << 32, max_tokens, max_segments, max_loss)
        for batch in batches:
            idents, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            heads = batch.column(2).to_pylist() if has_prompt else [""] * batch.num_rows
            for ident_, head, text_ in zip(idents, map(words.packed, heads), texts, strict=True):
                packer.add(ident_, head + words.packed(text_) + closing, max(1, len(head) // 4))
            yield out(packer)
        packer.finish()
        yield out(packer)

    def out(packer: Packer) -> pa.RecordBatch:
        columns = list(zip(*packer.pieces, strict=True)) if packer.pieces else [[] for _ in names]
        packer.pieces = []
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names)

    names = ["ident", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(kept.dataType), *[pa.binary() if n == "ids" else pa.int64() for n in names[1:]]]
    schema = ", ".join(f"{n} {kept.dataType.simpleString() if n == 'ident' else 'binary' if n == 'ids' else 'bigint'}" for n in names)
    columns = [F.col(ident).alias("ident"), F.coalesce(text, F.lit("")).alias("t")]
    if has_prompt:
        columns.append(F.coalesce(prompt, F.lit("")).alias("p"))
    return df.select(*columns).mapInArrow(task, schema).withColumnRenamed("ident", ident)


def packing_report(docs: DataFrame, path: str) -> DataFrame:
    """The documents query's result: pieces with a digest of their ids instead of the ids."""
    pieces = pack(docs, path).withColumn("ids_crc32", F.crc32("ids"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")


def exchanges(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, prompt and answer: every turn of the assistant, with the turns before it back to the assistant's last as its prompt.

    Turns without text count as empty; turns that no answer follows are not trained on and left out; a conversation is
    taken to fit a task, as its window does.
    """
    own = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    answer = F.col("role") == "assistant"
    number = F.coalesce(F.sum(answer.cast("int")).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn("number", number)
    said = F.struct("turn", "role", "text")
    both = rows.groupBy("conv_id", "number").agg(F.array_sort(F.collect_list(said)).alias("said")).filter(F.exists("said", lambda s: s.role == "assistant"))
    last = F.element_at("said", -1)
    before = F.transform(F.slice("said", 1, F.size("said") - 1), lambda s: s.text)
    return both.select("conv_id", last["turn"].alias("turn"), F.array_join(before, "\n").alias("prompt"), last["text"].alias("answer"))


def pack_conversations(conversations: DataFrame, path: str, max_tokens: int = 1024, max_segments: int = 4, max_loss: int = 800) -> DataFrame:
    """Instruction data: prompts bear no loss, answers and the closing ids do; no sequence holds more than 4 segments or 800 such tokens."""
    items = exchanges(conversations).withColumn("item", F.struct("conv_id", "turn"))
    pieces = pack(items, path, "answer", "item", F.col("prompt"), max_tokens, max_segments, max_loss)
    return pieces.select(
        "item.conv_id", "item.turn", "start", "length", F.crc32("ids").alias("ids_crc32"), F.col("doc_tokens").alias("item_tokens"), "sequence_id", "offset", "loss_tokens"
    )
